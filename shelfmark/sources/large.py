"""Exports too large for one row, read in pieces, and many small ones gathered into a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions import bibtex
from shelfmark.functions.urls import issue_url_of_file_a
from shelfmark.operators.skew import lookup
from shelfmark.sources.files import file_name

_AT = ("path", "block", "at")


def _pieces(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files cut before each at-sign that begins a line; Spark deals one file's pieces to many tasks.

    `block` is where the task's part of the file begins, `at` grows along it. Both depend on the
    files and settings alone, so a second scan finds the same.
    """
    rows = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("lineSep", "\n@")
        .text(path)
        .select(
            file_name().alias("file_name"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
    )
    # A file's first piece has its own sign, if any; the others lost theirs to the cut.
    parted = F.concat(F.lit("@"), "value")
    cut, own = (F.regexp_like(text, F.lit(f"^{bibtex.START}")) for text in (parted, F.col("value")))
    return rows.select(
        "file_name", *_AT, (cut | own).alias("begins"), F.when(cut, parted).otherwise(F.col("value")).alias("value")
    )


def _homes(marked: DataFrame) -> DataFrame:
    """For each piece that begins no entry, the place of the last one before it that does.

    Only places move: first within a part of a file, then over the few rows that part ends with.
    """
    own = F.when(F.col("begins"), F.struct("block", "at"))
    along = Window.partitionBy("path", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = marked.withColumn("home", F.last(own, ignorenulls=True).over(along))
    ends = marked.where("begins").groupBy("path", "block").agg(F.max(F.struct("block", "at")).alias("end"))
    blocks = marked.select("path", "block").distinct().join(ends, ["path", "block"], "left")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("earlier", F.last("end", ignorenulls=True).over(before)).drop("end")
    joined = placed.where(~F.col("begins")).join(blocks, ["path", "block"])
    return joined.select(*_AT, F.coalesce("home", "earlier").alias("home"))


def scan_export_stretches(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """`(file_name, path, block, at, value)`: files in stretches of whole entries, one or a few each.

    A stretch begins where a line begins an entry beyond doubt, as in `bibtex.ENTRY`, so no entry is
    cut. A line that begins with an at-sign otherwise goes with the text before it. A file may be of
    any size; a single entry must stay under Spark's 2 GB.
    """
    pieces = _pieces(spark, path, pattern)
    marked = pieces.select(*_AT, "begins")
    begun = pieces.where("begins").drop("begins")
    if marked.where(~F.col("begins")).isEmpty():
        return begun
    # Lines that look like entries and are none: few beside all. What precedes a file's first entry
    # is a stretch of its own, at its beginning.
    strays = pieces.join(_homes(marked), list(_AT))
    parts = strays.select(
        "file_name", "path", F.coalesce("home.block", F.lit(-1)).alias("block"), F.coalesce("home.at", F.lit(-1)).alias("at"),
        F.struct(F.col("block").alias("b"), F.col("at").alias("a"), "value").alias("part"),
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["value"]), "\n@")
    tails = parts.groupBy("file_name", "path", "block", "at").agg(joined.alias("tail"))
    whole = begun.join(tails.drop("file_name"), list(_AT), "left")
    whole = whole.withColumn("value", F.concat_ws("\n@", "value", "tail")).drop("tail")
    return whole.unionByName(tails.where("at < 0").withColumnRenamed("tail", "value"))


def split_records(stretches: DataFrame, issue_url: Column | None = None) -> DataFrame:
    """`file_name, issue_url, place, record, _macros`: a row per record, `place` in order within a file.

    Macros are gathered by file from its `@string` entries, wherever in it they stand.
    """
    url = issue_url_of_file_a(F.col("file_name")) if issue_url is None else issue_url
    entries = stretches.select(
        "file_name", "path", url.alias("issue_url"), "block", "at",
        F.posexplode(bibtex.entries(F.col("value"))).alias("pos", "record"),
    )
    entries = entries.withColumn("place", F.struct("block", "at", "pos")).drop("block", "at", "pos")
    kind = bibtex.entry_type(F.col("record"))
    strings = entries.where(kind == "string").groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("place", "record"))).alias("defined")
    )
    macros = strings.select("path", bibtex.macros_of(F.transform("defined", lambda d: d["record"])).alias("_macros"))
    records = entries.where(~kind.isin(*bibtex.ASIDES))
    return lookup(records, macros, "path").drop("path")


def compact_exports(
    spark: SparkSession, path: str, table: str, checkpoint_dir: str, pattern: str = "*.txt", files_per_batch: int = 100_000
) -> None:
    """Gather the files that have come since the last call into the Parquet table `table`.

    Rows are `(file_name, modified, value)`. The file source knows what it has read by path, so
    nothing is read twice, and a batch that failed is written again as a whole. Spark packs small
    files into tasks by size, and each task writes one file. A single file over 2 GB is for
    `scan_export_stretches`.
    """
    texts = (
        spark.readStream.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path, wholetext=True)
        .select(file_name().alias("file_name"), F.col("_metadata.file_modification_time").alias("modified"), "value")
    )
    sink = texts.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir)
    sink.trigger(availableNow=True).start(table).awaitTermination()


def compacted_exports(spark: SparkSession, table: str, issue_url: Column | None = None) -> DataFrame:
    """`(file_name, issue_url, value)` of the gathered files, as `scan_exports` gives it."""
    rows = spark.read.schema("file_name string, modified timestamp, value string").parquet(table)
    url = issue_url_of_file_a(F.col("file_name")) if issue_url is None else issue_url
    return rows.select("file_name", url.alias("issue_url"), "value")
