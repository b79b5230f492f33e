"""Arrival of each issue's files, kept as state per issue while names stream in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.skew import lookup
from shelfmark.sources.files import file_name
from shelfmark.streaming.store import FOLD_AFTER, RunStore

_STATE = T.StructType(
    [
        T.StructField("stem", T.StringType()),
        T.StructField("export_at", T.TimestampType()),
        T.StructField("archive_at", T.TimestampType()),
        T.StructField("n_exports", T.LongType()),
        T.StructField("n_archives", T.LongType()),
    ]
)

EXPORTS = (".txt", ".bib")
ARCHIVES = (".zip",)


def read_arrivals(spark: SparkSession, path: str, files_per_batch: int = 100_000) -> DataFrame:
    """Stream of `(name, arrived)` of the exports and archives in a folder; no content is read."""
    kinds = ",".join(e.removeprefix(".") for e in (*EXPORTS, *ARCHIVES))
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", f"*.{{{kinds}}}")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select(file_name().alias("name"), F.col("modificationTime").alias("arrived"))
    )


def stem_of(name: Column) -> Column:
    """The part of a file name that names its issue: without extension and the mark of a repeat."""
    return F.regexp_replace(name, r"(~[^~]*)?\.\w+$", "")


def _is(name: Column, extensions: tuple[str, ...]) -> Column:
    return F.regexp_like(name, F.lit(rf"({'|'.join('[.]' + e.removeprefix('.') for e in extensions)})$"))


def arrivals_of(names: DataFrame) -> DataFrame:
    """`stem`, when its newest export and archive came (null: not yet) and how many did.

    Works on a table and on a stream `(name, arrived)`; other files do not count. A stream keeps a
    row of state per issue, for good: an archive may come years after the export.
    """
    export, archive = _is(F.col("name"), EXPORTS), _is(F.col("name"), ARCHIVES)
    return (
        names.where(export | archive)
        .groupBy(stem_of(F.col("name")).alias("stem"))
        .agg(
            F.max(F.when(export, F.col("arrived"))).alias("export_at"),
            F.max(F.when(archive, F.col("arrived"))).alias("archive_at"),
            F.count_if(export).alias("n_exports"),
            F.count_if(archive).alias("n_archives"),
        )
    )


def _store(spark: SparkSession, table: str) -> RunStore:
    return RunStore(spark, table, _STATE, "stem")


def stream_arrivals(
    names: DataFrame, table: str, checkpoint_dir: str, fold_after: int = FOLD_AFTER
) -> StreamingQuery:
    """Bring `table` up to date with the names that have arrived; issues without news are not written."""

    def load(batch: DataFrame, batch_id: int) -> None:
        store = _store(batch.sparkSession, table)
        store.write(batch, batch_id)
        store.fold(fold_after)

    return (
        arrivals_of(names)
        .writeStream.outputMode("update")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def arrived(spark: SparkSession, table: str) -> DataFrame:
    """What `arrivals_of` gives for all names so far."""
    return _store(spark, table).current()


def issue_arrivals(issues: DataFrame, arrivals: DataFrame, stem: Column) -> DataFrame:
    """`issues` with the arrival of their files; `stem` is the name of an issue's files."""
    keyed = issues.withColumn("stem", stem)
    with_files = lookup(keyed, arrivals, "stem").drop("stem")
    zero = F.lit(0).cast("long")
    return with_files.withColumns({n: F.coalesce(n, zero) for n in ("n_exports", "n_archives")})
