"""Entries, fields and macros of BibTeX text, cut by expressions that follow braces and quotes.

Java has no recursive patterns, so nesting is written out to DEPTH levels. All repetitions are
possessive: a text is read once, without going back and without using the stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import WHITESPACE, let, newline_strip, whitespace_strip, without

#: Levels of braces that are followed; a deeper value is cut by what stands after its end.
DEPTH = 10

#: Entries that are no records.
ASIDES = ("comment", "preamble", "string")
_ASIDE = rf"(?i:{'|'.join(ASIDES)})"
KEY = r"[\w.:+-]++"

#: A new entry beyond doubt: one of the asides, or a type with a cite key and a comma.
START = rf"@\s*+(?:{_ASIDE}\s*+[{{(]|[A-Za-z]++\s*+[{{(]\s*+[^\s,{{}}=\"]*+\s*+,)"


def _nested(chunk: str) -> str:
    """Text with balanced braces; `chunk` is what may stand in it apart from braces."""
    inside = rf"(?:{chunk})*+"
    for _ in range(DEPTH):
        inside = rf"(?:{chunk}|\{{{inside}\}})*+"
    return inside


def _entry() -> str:
    # A line that starts an entry ends a value whose brace was never closed, so what such a value
    # costs ends there too.
    line = rf"\n(?!\s*+{START})"
    braced = _nested(rf"[^{{}}\n]++|{line}")
    quoted = rf"\"(?:[^\"{{}}\n]++|{line}|\{{{braced}\}})*+\""
    chunk = rf"[^(){{}}\"\n]++|{line}|{quoted}|\"|\{{{braced}\}}"
    in_parentheses = rf"(?:{chunk}|\((?:{chunk})*+\))*+"
    stray = rf"(?!\s*+(?:\}}|,\s*+{KEY}\s*+=))"
    return (
        rf"@\s*+[A-Za-z]++\s*+(?:\{{{braced}\}}{stray}|\({in_parentheses}\){stray}"
        rf"|[{{(](?:[^@]++|(?!{START})@)*+)"
    )


#: An entry with balanced braces, in braces or parentheses. One that is not balanced (or looks
#: closed too early, as a field follows) goes on to the next start of an entry.
ENTRY = _entry()
HAS_RECORD = rf"@\s*+(?!{_ASIDE}\s*+[{{(])[A-Za-z]++\s*+[{{(]"

_HEAD = r"^[A-Za-z]++\s*+[{(](?:\s*+[^,={}\"]*+,)?+"
_CITE_KEY = r"^[A-Za-z]++\s*+[{(]\s*+([^,={}\"]*+),"

_BRACED = rf"\{{{_nested('[^{}]++')}\}}"
_QUOTED = rf"\"(?:[^\"{{}}]++|{_BRACED})*+\""
_PART = rf"(?:{_BRACED}|{_QUOTED}|{KEY})"
_NEXT = rf",\s*+(?:{KEY}\s*+=|$)"
_CLOSED = (
    rf"(?:{_BRACED}|{_QUOTED})(?:\s*+#\s*+{_PART})*+"
    rf"(?=\s*+(?:$|{_NEXT}|,[^,{{}}\"]*+(?:,|$)))"
)
_BARE = rf"(?![{{\"])(?:#\s*+(?:{_QUOTED}|{_BRACED})|(?!{_NEXT}).)*+"
_OPEN = rf"(?:(?![}}\"]\s*+,\s*+{KEY}\s*+=).)*+"

#: `key = value`: the value closed by its own brace or quote, bare up to a comma before a key, or,
#: where braces or quotes do not match, up to one that a comma and a key follow.
FIELD = rf"(?s){KEY}\s*+=\s*+(?:{_CLOSED}|{_BARE}|{_OPEN})"
_SUM = rf"(?s)^\s*+{_PART}(?:\s*+#\s*+{_PART})*+\s*+$"


def entries(text: Column) -> Column:
    """Array of the entries of a file, each without its at-sign and its line ends."""
    found = F.regexp_extract_all(text, F.lit(ENTRY), F.lit(0))
    return F.transform(found, lambda e: F.ltrim(newline_strip(F.substring(e, 2, 1 << 30))))


def entry_type(entry: Column) -> Column:
    return F.lower(F.regexp_extract(entry, r"^([A-Za-z]+)", 1))


def records_of(all_entries: Column) -> Column:
    return F.filter(all_entries, lambda e: ~entry_type(e).isin(*ASIDES))


def cite_key(entry: Column) -> Column:
    return F.nullif(whitespace_strip(F.regexp_extract(entry, _CITE_KEY, 1)), F.lit(""))


def field_parts(entry: Column) -> Column:
    """Array of `key = value` texts."""
    body = F.regexp_replace(F.regexp_replace(entry, _HEAD, ""), r"[})]\s*+,?\s*+$", "")
    return F.regexp_extract_all(body, F.lit(FIELD), F.lit(0))


def key_of(part: Column) -> Column:
    return F.lower(whitespace_strip(F.substring_index(part, "=", 1)))


def _plain(raw: Column) -> Column:
    """A value without its quotes and any braces."""
    quoted = F.startswith(raw, F.lit('"'))
    bare = F.when(quoted, F.regexp_replace(raw, r'^"|"?\s*\}?\s*$', "")).otherwise(raw)
    return whitespace_strip(without(bare, "{", "}"))


def value_of(part: Column, macros: Column) -> Column:
    """The value, its parts between `#` joined, and names in it replaced from `macros`.

    A value with a name that `macros` (which may be null) does not have is left as written.
    """

    def meaning(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - 2)
        known = F.try_element_at(macros, F.lower(piece))
        return (
            F.when(F.startswith(piece, F.lit("{")) | F.startswith(piece, F.lit('"')), inner)
            .when(F.regexp_like(piece, F.lit(r"^\d+$")), piece)
            .otherwise(known)
        )

    def joined(pieces: Column) -> Column:
        whole = ~F.exists(pieces, lambda p: p.isNull())
        return F.when(whole, whitespace_strip(without(F.array_join(pieces, ""), "{", "}")))

    def value(raw: Column) -> Column:
        bare = ~(F.startswith(raw, F.lit("{")) | F.startswith(raw, F.lit('"')))
        parts = F.transform(F.regexp_extract_all(raw, F.lit(f"(?s){_PART}"), F.lit(0)), meaning)
        total = F.when(F.regexp_like(raw, F.lit(_SUM)), let(parts, joined))
        summed = F.contains(raw, F.lit("#")) | (macros.isNotNull() & bare)
        return F.when(summed, F.coalesce(total, _plain(raw))).otherwise(_plain(raw))

    after = F.substring(part, F.locate("=", part) + 1, F.lit(1 << 30))
    return let(F.ltrim(after, F.lit(WHITESPACE)), value)


def macros_of(all_entries: Column) -> Column:
    """Map of the macros that `@string` entries define, names in lower case; null without any.

    A definition may use earlier ones; of a name defined again the last definition counts.
    """
    definitions = F.filter(all_entries, lambda e: entry_type(e) == "string")
    parts = F.flatten(F.transform(definitions, field_parts))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def define(known: Column, part: Column) -> Column:
        others = F.map_filter(known, lambda k, _: k != key_of(part))
        return F.map_concat(others, F.create_map(key_of(part), value_of(part, known)))

    table = F.aggregate(parts, empty, define)
    return F.when(F.exists(all_entries, lambda e: entry_type(e) == "string"), table)
