"""HTML entities to characters, as an expression over the pieces of a text between ampersands."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import let

#: Names that also count without a semicolon, at the start of a longer name; the longest first.
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
_REFERENCE = r"^(#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32}+;?)"
_REPLACEMENT = "�"
_TOO_LARGE = 0x110000


#: Names with their texts as one literal, of which Spark makes a map when it plans.
_NAMED = "\x01".join(f"{name}\x02{text}" for name, text in sorted(html5.items()))

#: The entities that pages are full of, each with the text it stands for, `&` last.
_COMMON = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "nbsp": "\u00a0", "amp": "&"}


def _windows_1252(code: int) -> str:
    """What browsers read numbers 128 to 159 as: bytes of that code page, where it has them."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _character(code: Column) -> Column:
    low = F.array(*[F.lit(_windows_1252(c)) for c in range(0x80, 0xA0)])
    control = (
        code.between(0x01, 0x08) | (code == 0x0B) | code.between(0x0E, 0x1F) | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code >= _TOO_LARGE), _REPLACEMENT)
        .when(code.between(0x80, 0x9F), F.get(low, (code - 0x80).cast("int")))
        .when(control, F.lit(""))
        .otherwise(wide)
    )


def _number(reference: Column) -> Column:
    digits = F.regexp_extract(reference, r"^#[xX]?0*+([0-9a-fA-F]*+)", 1)
    hexadecimal = F.regexp_like(reference, F.lit("^#[xX]"))
    short = F.when(F.length(digits) <= 7, F.when(digits == "", "0").otherwise(digits))
    value = F.when(hexadecimal, F.conv(short, 16, 10)).otherwise(short).cast("long")
    return F.coalesce(value, F.lit(_TOO_LARGE).cast("long"))


def unescape(text: Column) -> Column:
    """`text` with its entities as characters, the way browsers read them; what is none stays.

    Texts with common entities alone are decoded by replacing these.
    """
    simple = text
    for name, character in _COMMON.items():
        simple = F.replace(simple, F.lit(f"&{name};"), F.lit(character))
    other = F.regexp_like(text, F.lit(rf"&(?!(?:{'|'.join(_COMMON)});)"))
    names = F.str_to_map(F.lit(_NAMED), F.lit("\x01"), F.lit("\x02"))
    return (
        F.when(~F.contains(text, F.lit("&")), text)
        .when(~other, simple)
        .otherwise(let(names, lambda known: _any_entity(text, known)))
    )


def _any_entity(text: Column, names: Column) -> Column:
    bare = rf"^({'|'.join(_BARE)})"

    def named(reference: Column) -> Column:
        def by_start(start: Column) -> Column:
            rest = F.substr(reference, F.length(start) + 1)
            whole = F.concat(F.try_element_at(names, start), rest)
            return F.when(start == "", F.concat(F.lit("&"), reference)).otherwise(whole)

        return F.coalesce(F.try_element_at(names, reference), let(F.regexp_extract(reference, bare, 1), by_start))

    def piece(part: Column, position: Column) -> Column:
        def decoded(reference: Column) -> Column:
            rest = F.substr(part, F.length(reference) + 1)
            meaning = (
                F.when(reference == "", F.lit("&"))
                .when(F.startswith(reference, F.lit("#")), let(_number(reference), _character))
                .otherwise(named(reference))
            )
            return F.concat(meaning, rest)

        return F.when(position == 0, part).otherwise(let(F.regexp_extract(part, _REFERENCE, 1), decoded))

    return F.array_join(F.transform(F.split(text, "&", -1), piece), "")


def unescape_nested(cells: Column) -> Column:
    """As `unescape`, for lists of lists."""
    has_entity = F.exists(cells, lambda cell: F.exists(cell, lambda s: F.contains(s, F.lit("&"))))
    decoded = F.transform(cells, lambda cell: F.transform(cell, unescape))
    return F.when(has_entity, decoded).otherwise(cells)
