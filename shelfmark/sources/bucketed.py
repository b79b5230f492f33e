"""Articles and listings of files bucketed by file name: audits that follow join them in place.

A store is a folder. `bucket_articles` and `bucket_listings` write the two tables with as many
buckets on the same columns, the name and the sub-key of a hot name, so that neither side of a join
is shuffled again. Folders are written once. The mark of the listings names both tables: a reader sees
the old pair or the new one. A store has one writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.urls import pdf_name
from shelfmark.operators.holdings import file_key, manifest
from shelfmark.operators.skew import copied, hot_keys, spread
from shelfmark.sources.marks import Marks

ON = ("_name", "_salt")
#: Pairs of tables that stay readable; older ones are removed.
VERSIONS = 2


def _table(folder: str) -> str:
    return f"shelfmark_{folder}"


def _buckets(folder: str) -> int:
    """Folders are `<kind>_<buckets>_<id>`, listings with their articles' id in front."""
    return int(folder.split("_")[1])


def _write(df: DataFrame, path: str, folder: str) -> None:
    """One file a bucket, sorted: a shuffle by the same hash sends each bucket to one task."""
    buckets = _buckets(folder)
    (
        df.repartition(buckets, *ON)
        .write.format("parquet")
        .bucketBy(buckets, *ON)
        .sortBy(*ON)
        .option("path", f"{path}/data/{folder}")
        .saveAsTable(_table(folder))
    )


def _read(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The table of a folder, entered in the session's catalog where another session wrote it."""
    name = _table(folder)
    if not spark.catalog.tableExists(name):
        place = f"{path}/data/{folder}"
        columns = ", ".join(
            f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
            for f in spark.read.parquet(place).schema.fields
        )
        on = ", ".join(ON)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({on}) SORTED BY ({on})"
            f" INTO {_buckets(folder)} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def bucket_articles(
    articles: DataFrame, path: str, buckets: int | None = None, ignore_case: bool = False
) -> None:
    """Write `articles` by file name. They count once `bucket_listings` has followed.

    `buckets`: the session's shuffle partitions, if None; choose it for the table's whole life.
    """
    spark = articles.sparkSession
    marks = Marks(spark, path)
    path = marks.qualified()
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"articles_{count}_{uuid.uuid4().hex}"
    named = articles.withColumn("_name", file_key(pdf_name(F.col("url")), ignore_case))
    hot = hot_keys(named.select("_name"), "_name")
    hot.write.parquet(f"{path}/data/{folder}_hot")
    hot = spark.read.schema(hot.schema).parquet(f"{path}/data/{folder}_hot")
    _write(spread(named, "_name", hot), path, folder)
    marks.put("articles", max(marks.numbers("articles"), default=0) + 1, folder)


def bucket_listings(
    held: DataFrame, remote: DataFrame | None, path: str, ignore_case: bool = False
) -> None:
    """Write the files held, here and remotely, beside the newest articles, and publish the pair."""
    spark = held.sparkSession
    marks = Marks(spark, path)
    path = marks.qualified()
    articles = _newest(marks, "articles")
    folder = f"{articles}_listing_{uuid.uuid4().hex}"
    hot = spark.read.schema("_name string, _salts int").parquet(f"{path}/data/{articles}_hot")
    _write(copied(manifest(held, remote, ignore_case), "_name", hot), path, folder)
    marks.put("listings", max(marks.numbers("listings"), default=0) + 1, folder)
    _remove_old(spark, marks)


def _newest(marks: Marks, kind: str) -> str:
    found = marks.numbers(kind)
    if not found:
        raise ValueError(f"{marks.path} has no {kind}")
    return marks.read(kind, found[-1])


def _articles_of(listing: str) -> str:
    return listing.split("_listing_")[0]


def _remove_old(spark: SparkSession, marks: Marks) -> None:
    listings = {marks.read("listings", n) for n in marks.keep_newest("listings", VERSIONS)}
    articles = {marks.read("articles", n) for n in marks.keep_newest("articles", 1)}
    articles |= {_articles_of(x) for x in listings}
    kept = listings | articles | {f"{x}_hot" for x in articles}
    for folder in {*marks.names("data")} - kept:
        spark.sql(f"DROP TABLE IF EXISTS {_table(folder)}")
        marks.remove(f"data/{folder}")


def _pair(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    marks = Marks(spark, path)
    path, listing = marks.qualified(), _newest(marks, "listings")
    return _read(spark, path, _articles_of(listing)), _read(spark, path, listing)


def with_holdings(spark: SparkSession, path: str) -> DataFrame:
    """Each article with `held` and `remote`, as `operators.holdings.with_holdings` gives them."""
    articles, listing = _pair(spark, path)
    return articles.join(listing, [*ON], "left").drop(*ON).withColumns(
        {flag: F.coalesce(flag, F.lit(False)) for flag in ("held", "remote")}
    )


def holdings_semi(spark: SparkSession, path: str) -> DataFrame:
    """Articles whose file is held."""
    articles, listing = _pair(spark, path)
    return articles.join(listing.where("held"), [*ON], "left_semi").drop(*ON)


def pending_anti(spark: SparkSession, path: str) -> DataFrame:
    """Articles whose file is not held."""
    articles, listing = _pair(spark, path)
    return articles.join(listing.where("held"), [*ON], "left_anti").drop(*ON)
