"""Bulk citation exports to articles.

The default grammar follows braces and quotes. `compat=True` gives the literal splitting of the
feeds' first readers, with its losses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import bibtex
from shelfmark.functions.text import (
    newline_strip,
    pieces_after,
    whitespace_strip,
    without,
    year_cast,
)
from shelfmark.schemas import CITATION_FIELDS

# Fixed value: the sentence a failed export holds.
BAD_EXPORT = "A problem occurred trying to deliver text citation data"


@dataclass(frozen=True)
class Dialect:
    """Literal delimiters of a feed, used with `compat=True` only."""

    record_mark: str
    skipped_pieces: int
    field_mark: str


DIALECT_A = Dialect("@", 2, "}, ")
DIALECT_B = Dialect("@article", 1, "},")
DIALECTS = {"a": DIALECT_A, "b": DIALECT_B}

def is_bad_export(value: Column) -> Column:
    return F.contains(value, F.lit(BAD_EXPORT))


def filter_bad_export(exports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exports to parse, and rejected ones to fetch again.

    Rejected are those that hold the sentence of failure, no text, or no record to cut out.
    """
    bad = export_problem(F.col("value")).isNotNull()
    return exports.where(~bad), exports.where(bad).drop("value")


def export_problem(value: Column) -> Column:
    """Why an export is rejected, or null."""
    no_record = ~F.regexp_like(value, F.lit(bibtex.HAS_RECORD))
    return F.when(value.isNull(), "no text").when(is_bad_export(value), "failed export").when(no_record, "no record")


def _with_macros(exports: DataFrame, dialect: str, compat: bool, outer: bool = False) -> DataFrame:
    """`record_pieces`, and the macros of a record's file; with `outer`, a row also for no records."""
    kept = [c for c in exports.columns if c != "value"]
    explode = F.posexplode_outer if outer else F.posexplode
    if compat:
        rules = DIALECTS[dialect]
        pieces = F.split(newline_strip(F.col("value")), rf"\Q{rules.record_mark}\E")
        records = pieces_after(pieces, rules.skipped_pieces)
        return exports.select(*kept, explode(records).alias("record_ordinal", "record"))
    cut = exports.select(*kept, bibtex.entries(F.col("value")).alias("_entries"))
    found = F.col("_entries")
    # Macros are resolved once per file: beside explode they would be resolved again for each record,
    # from a copy of all entries of the file.
    files = cut.select(*kept, "_entries", bibtex.macros_of(found).alias("_macros"))
    return files.select(*kept, explode(bibtex.records_of(found)).alias("record_ordinal", "record"), "_macros")


def record_pieces(exports: DataFrame, dialect: str = "a", compat: bool = False) -> DataFrame:
    """One row per record: `(file_name, issue_url, record_ordinal, record)`.

    The columns of `exports` other than its text are kept.
    """
    return _with_macros(exports, dialect, compat).drop("_macros")


def _last_of_each_key(entries: str) -> Column:
    """Entries sorted by key and position hold each key's last one right before the next key."""
    later = F.col(entries)
    return F.filter(
        later, lambda e, i: F.coalesce(F.get(later, i + 1)["key"] != e["key"], F.lit(True))
    )


def citation_records(
    exports: DataFrame, dialect: str = "a", compat: bool = False, outer: bool = False
) -> DataFrame:
    """Records with their type, cite key and a map of all fields; of a repeated key the last counts.

    By default values may hold what elsewhere starts an entry or ends a field, as long as braces and
    quotes match, and macros are resolved by file; see `shelfmark.functions.bibtex`.
    """
    return parsed_records(_with_macros(exports, dialect, compat, outer), dialect, compat)


def parsed_records(pieces: DataFrame, dialect: str = "a", compat: bool = False) -> DataFrame:
    """`citation_records` of records already cut: rows `record` and, by default, `_macros`."""
    record = F.col("record")
    if compat:
        brace, comma = F.locate("{", record), F.locate(",", record)
        kind = F.when(brace > 0, F.substring(record, F.lit(1), brace - 1)).otherwise(
            F.substring(record, F.lit(1), F.length(record) - 1)
        )
        body = F.substring(record, comma + 1, F.length(record))
        parts = F.split(without(body, "{"), rf"\Q{DIALECTS[dialect].field_mark}\E")
        cite_key = F.lit(None).cast("string")
    else:
        kind, parts, cite_key = bibtex.entry_type(record), bibtex.field_parts(record), bibtex.cite_key(record)

    def entry(part: Column, position: Column) -> Column:
        if compat:
            halves = F.split(without(part, "{", "}"), "=")
            key, value = whitespace_strip(F.get(halves, F.lit(0))), whitespace_strip(F.get(halves, F.lit(1)))
        else:
            key, value = bibtex.key_of(part), bibtex.value_of(part, F.col("_macros"))
        return F.struct(key.alias("key"), position.alias("position"), value.alias("value"))

    with_field = F.filter(F.transform(parts, entry), lambda e: e["value"].isNotNull())
    kept = [c for c in pieces.columns if c not in ("record", "_macros")]
    parsed = pieces.select(
        *kept, kind.alias("type"), cite_key.alias("cite_key"), F.sort_array(with_field).alias("_entries")
    )
    fields = F.map_from_entries(
        F.transform(
            _last_of_each_key("_entries"),
            lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")),
        )
    )
    return parsed.withColumn("fields", fields).drop("_entries")


def articles_of(records: DataFrame, compat: bool = False) -> DataFrame:
    """Project records on the article schema. `url` may also come as `stable_url`."""
    fields = F.col("fields")
    names = ("type", "issue_url", "file_name", "record_ordinal", "cite_key", "fields")
    carried = [c for c in records.columns if c not in names]

    def field(name: str) -> Column:
        spellings = (name, name.upper()) if compat else (name,)
        return F.coalesce(*[F.try_element_at(fields, F.lit(s)) for s in spellings])

    modelled = [*CITATION_FIELDS, "stable_url", "year"]
    if compat:
        modelled += [name.upper() for name in modelled]
    columns = {name: field(name) for name in CITATION_FIELDS}
    columns["url"] = F.coalesce(columns["url"], field("stable_url"))
    return records.select(
        *carried,
        "issue_url",
        "file_name",
        "record_ordinal",
        "type",
        "cite_key",
        *[column.alias(name) for name, column in columns.items()],
        year_cast(field("year")).alias("year"),
        F.map_filter(fields, lambda key, _: ~key.isin(modelled)).alias("extra"),
    )


def bibtex_parse(exports: DataFrame, dialect: str = "a", compat: bool = False) -> DataFrame:
    """Exports `(file_name, issue_url, value)` to articles, in one narrow stage."""
    return articles_of(citation_records(exports, dialect, compat), compat)


def parse_or_reject(exports: DataFrame, dialect: str = "a", compat: bool = False) -> DataFrame:
    """Articles, and a row with a `problem` for each export that gives none, in one pass over the texts.

    A `problem` that the exports have already, such as a file of no issue, rejects them too.
    """
    value = F.col("value")
    earlier = F.col("problem") if "problem" in exports.columns else F.lit(None).cast("string")
    # The text of a rejected export goes, so that it is not parsed.
    judged = exports.withColumn("problem", F.coalesce(earlier, export_problem(value)))
    judged = judged.withColumn("value", F.when(F.col("problem").isNull(), value))
    return articles_of(citation_records(judged, dialect, compat, outer=True), compat)
