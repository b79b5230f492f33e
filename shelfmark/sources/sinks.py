"""Tables and reports the jobs write."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.holdings import completeness_gate, held_totals
from shelfmark.sources.marks import Marks


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite `path`. CSV holds arrays, maps and structs as JSON."""
    if fmt == "csv":
        nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")]
        df.withColumns({name: F.to_json(name) for name in nested}).write.mode("overwrite").option("escape", '"').csv(path, header=True)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def sink_issues(issues: DataFrame, path: str) -> None:
    write_table(issues, path)


def sink_records(records: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(records, path, fmt)


def sink_record_load(records: DataFrame, path: str) -> None:
    """Sound records and quarantined ones, split by one write so that pages are parsed once.

    Read either side with a filter on `quarantined`, which selects a folder.
    """
    marked = records.withColumn("quarantined", F.col("problem").isNotNull())
    marked.write.mode("overwrite").partitionBy("quarantined").parquet(path)


@dataclass(frozen=True)
class GateResult:
    complete: bool
    complete_by_count: bool
    issue_rows: int
    issues: int
    issues_with_articles: int
    missing: int


def sink_articles(
    articles: DataFrame, issues: DataFrame, path: str, staging: str, compat: bool = False
) -> GateResult:
    """Replace the table at `path` only if every issue has articles.

    The articles are written once, to `staging`, which the gate reads and which then takes the place
    of `path`. An incomplete run leaves `path` as it was and the articles in `staging`.
    """
    write_table(articles, staging)
    staged = articles.sparkSession.read.schema(articles.schema).parquet(staging)
    result = GateResult(**completeness_gate(issues, staged).first().asDict())
    if result.complete_by_count if compat else result.complete:
        publish(articles.sparkSession, staging, path)
    return result


def sink_citation_load(
    loaded: DataFrame, issues: DataFrame, path: str, compat: bool = False, versioned: bool = False
) -> GateResult:
    """Articles and rejected exports of one pass over the texts; the articles published if complete.

    `loaded` has rows with a `problem` for rejected exports (`parse_or_reject`), which go to
    `path/rejected`. The articles take the place of `path/articles` by renaming or, with `versioned`,
    become its next version: readers (`files.published`) then see the one before or this one, with no
    moment between, also in stores where renaming is a copy.
    """
    spark, root = loaded.sparkSession, path.rstrip("/")
    folder = f"load-{uuid.uuid4().hex}"
    home = f"{root}/articles" if versioned else f"{root}/staging"
    staged = f"{home}/data/{folder}"
    marked = loaded.withColumn("rejected", F.col("problem").isNotNull())
    marked.write.partitionBy("rejected").parquet(staged)
    good = f"{staged}/rejected=false"
    if "rejected=false" not in Marks(spark, home).names(f"data/{folder}"):
        # No rows, no folder.
        spark.createDataFrame([], loaded.schema).write.parquet(good)
    rejects = spark.read.schema(marked.schema).parquet(staged).where("rejected")
    write_table(rejects.select("issue_url", "file_name", "problem"), f"{root}/rejected")
    articles = spark.read.schema(loaded.schema).parquet(good)
    result = GateResult(**completeness_gate(issues, articles).first().asDict())
    if result.complete_by_count if compat else result.complete:
        if versioned:
            publish_version(spark, f"{folder}/rejected=false", home)
        else:
            publish(spark, good, f"{root}/articles")
    return result


#: Versions of a published table that stay for readers that have begun.
VERSIONS_KEPT = 2


def publish_version(spark: SparkSession, folder: str, path: str) -> None:
    """Make `path/data/<folder>` the version of `path` that `published` finds.

    Older versions but one go, and with them data that none names.
    """
    marks = Marks(spark, path)
    marks.put("versions", max([0, *marks.numbers("versions")]) + 1, folder)
    kept = {marks.read("versions", n).split("/")[0] for n in marks.keep_newest("versions", VERSIONS_KEPT)}
    for name in marks.names("data"):
        if name not in kept:
            marks.remove(f"data/{name}")


def publish(spark: SparkSession, staging: str, path: str) -> None:
    """Put the table at `staging` in the place of `path` by renaming.

    The old table stands aside until the new one is in place, and returns if that fails.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, here, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (staging, path, f"{path.rstrip('/')}.old"))
    fs = here.getFileSystem(conf)
    if not fs.exists(here) and fs.exists(old):
        fs.rename(old, here)
    had = fs.exists(here)
    fs.mkdirs(here.getParent())
    if had:
        fs.delete(old, True)
        if not fs.rename(here, old):
            raise OSError(f"{path} cannot be moved aside")
    if not (fs.exists(new) and fs.rename(new, here)):
        if had:
            fs.rename(old, here)
        raise OSError(f"{staging} cannot be moved to {path}")
    fs.delete(old, True)


def sink_report(per_issue: DataFrame, path: str, floor: int) -> None:
    """The table per issue and, beside it, the totals; totals are read off the written table."""
    write_table(per_issue, f"{path}/per_issue")
    written = per_issue.sparkSession.read.parquet(f"{path}/per_issue")
    write_table(held_totals(written, floor), f"{path}/totals")
