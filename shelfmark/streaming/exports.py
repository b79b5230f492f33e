"""Incremental load of citation exports with Structured Streaming.

Each run takes the files that arrived since the last one. A batch is one run of a store keyed by
issue: an issue's rows come from its newest file, and what a batch writes again changes nothing.
The file source knows files by path: an export fetched again needs a new file name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.urls import issue_url_of_file_a
from shelfmark.operators.citations import parse_or_reject
from shelfmark.operators.select import missing_issues
from shelfmark.schemas import ARTICLES
from shelfmark.sources.files import file_name, named_issue
from shelfmark.streaming.store import FOLD_AFTER, RunStore

_ARRIVAL = [T.StructField("arrived", T.TimestampType()), T.StructField("batch", T.LongType())]
_STORED = T.StructType([*ARTICLES.fields, *_ARRIVAL, T.StructField("problem", T.StringType())])
_REJECTED = T.StructType([*[ARTICLES[n] for n in ("file_name", "issue_url")], *_ARRIVAL, _STORED["problem"]])


def article_store(spark: SparkSession, table: str) -> RunStore:
    """The articles by issue; a rejected export is a row with a problem, which replaces nothing."""
    return RunStore(spark, f"{table}/articles", _STORED, "issue_url", ("arrived", "file_name"), "problem IS NULL")


def _rejected_store(spark: SparkSession, table: str) -> RunStore:
    return RunStore(spark, f"{table}/rejected", _REJECTED, "batch")


def read_exports(
    spark: SparkSession, path: str, pattern: str = "*.txt", files_per_batch: int = 100_000
) -> DataFrame:
    """Stream of `(file_name, issue_url, value, arrived)`, so many files a batch.

    A file fetched again is named `<issue file id>~<anything>.txt`; the issue is what precedes `~`.
    """
    files = (
        spark.readStream.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path, wholetext=True)
        .select(
            file_name().alias("file_name"),
            F.col("_metadata.file_modification_time").alias("arrived"),
            "value",
        )
    )
    stem = F.regexp_replace("file_name", r"~[^~]*\.txt$", ".txt")
    return files.select("file_name", issue_url_of_file_a(stem).alias("issue_url"), "value", "arrived")


def stream_exports(
    exports: DataFrame,
    table: str,
    checkpoint_dir: str,
    dialect: str = "a",
    issues: DataFrame | None = None,
    file_id: Column | None = None,
    fold_after: int = FOLD_AFTER,
) -> StreamingQuery:
    """Parse a stream of exports into `table` until all that has arrived is done.

    Where a file name does not tell its issue, as with dialect b, `issues` and the name `file_id` of
    an issue's file do; files of no issue or of several are rejected. A batch reads its texts once:
    articles and rejected files are rows of one write. After `fold_after` batches these are folded
    into one table of the live rows.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        numbered = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        if issues is not None:
            numbered = named_issue(numbered, issues, file_id)
        store, rejects = article_store(spark, table), _rejected_store(spark, table)
        written = store.write(parse_or_reject(numbered, dialect), batch_id)
        rejected = written.where("problem IS NOT NULL").select(*_REJECTED.names)
        rejects.write(rejected, batch_id)
        store.fold(fold_after)
        rejects.fold(fold_after)

    return (
        exports.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def current_articles(spark: SparkSession, table: str) -> DataFrame:
    """Articles of the newest good file of each issue."""
    return article_store(spark, table).current().select(*ARTICLES.names)


def rejected_exports(spark: SparkSession, table: str) -> DataFrame:
    """Every rejected file of every batch."""
    return _rejected_store(spark, table).current()


def stream_resume(spark: SparkSession, issues: DataFrame, table: str) -> DataFrame:
    """Issues still to be fetched: those without articles so far."""
    return missing_issues(issues, current_articles(spark, table))
