"""Files and tables the jobs read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas
from shelfmark.functions.text import whitespace_strip, year_cast
from shelfmark.functions.urls import issue_url_of_file_a
from shelfmark.sources.marks import Marks


def published(spark: SparkSession, path: str) -> str:
    """The folder of the newest version of a table published by versions; other paths as they are."""
    marks = Marks(spark, path)
    found = marks.numbers("versions")
    return f"{marks.path}/data/{marks.read('versions', found[-1])}" if found else path


def scan_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A Parquet, ORC, JSON or CSV table with a given schema; nothing is inferred.

    A CSV file's columns go by the names in its header, in any order and case.
    """
    if fmt == "csv":
        return by_header(spark.read.csv(path, header=True, enforceSchema=False, escape='"'), schema)
    return spark.read.schema(schema).format(fmt).load(published(spark, path))


# Other names of columns in older tables.
OTHER_NAMES = {"issue_text": ("Jstor_issue_text", "Elsevier_issue_text"), "url": ("stable_url",)}


def by_header(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of text as those of `schema`, found by name; one that is absent is null.

    Whole numbers may be written `1946.0`; arrays, maps and structs are JSON.
    """
    present = {name.lower(): f"`{name}`" for name in raw.columns}

    def column(field: T.StructField) -> Column:
        names = [n.lower() for n in (field.name, *OTHER_NAMES.get(field.name, ()))]
        found = [F.col(present[n]) for n in names if n in present]
        text = F.coalesce(*found) if found else F.lit(None).cast("string")
        if isinstance(field.dataType, T.IntegerType):
            return year_cast(text)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(text, field.dataType)
        return text.try_cast(field.dataType)

    if "issue_url" in schema.names and "issue_url" not in present:
        raise ValueError("the table has no issue_url")
    return raw.select(*[column(field).alias(field.name) for field in schema])


def scan_issues(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return scan_table(spark, path, schemas.ISSUES, fmt)


def scan_articles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The article table; a CSV has the columns of its header."""
    return scan_articles_csv(spark, path) if fmt == "csv" else scan_table(spark, path, schemas.ARTICLES)


def scan_articles_csv(spark: SparkSession, path: str) -> DataFrame:
    """A spreadsheet's article table: `issue_url, url` or the older `stable_url`, and `year`."""
    raw = with_url(spark.read.csv(path, header=True, enforceSchema=False, escape='"'))
    whole = [c for c in raw.columns if c.lower() in ("year", "record_ordinal")]
    return raw.withColumns({c.lower(): year_cast(F.col(c)) for c in whole})


def with_url(articles: DataFrame) -> DataFrame:
    """`url` from whichever of `url` and `stable_url` the table has."""
    present = {name.lower(): name for name in articles.columns}
    names = [present[n] for n in ("url", "stable_url") if n in present]
    if not names:
        raise ValueError("the article table has neither url nor stable_url")
    return articles.withColumn("_url", F.coalesce(*names)).drop(*names).withColumnRenamed("_url", "url")


def file_name() -> Column:
    """Name of the file a row was read from; the metadata column holds it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select(file_name().alias("file_name"), "value")
    )


def scan_exports(
    spark: SparkSession, path: str, pattern: str = "*.txt", issue_url: Column | None = None
) -> DataFrame:
    """Citation files, one row each: `(file_name, issue_url, value)`.

    The issue URL is derived from the file name; where it cannot be, use `assign_issue`.
    """
    url = issue_url_of_file_a(F.col("file_name")) if issue_url is None else issue_url
    return _whole_files(spark, path, pattern).select("file_name", url.alias("issue_url"), "value")


#: Issues that are sent to the files' tasks, at some 200 bytes each; more are joined by a shuffle.
MOST_SENT = 1_000_000


def named_issue(
    exports: DataFrame, issues: DataFrame, file_id: Column, most_sent: int = MOST_SENT
) -> DataFrame:
    """Put the URL of the issue whose file name is `file_id` on each export, a row per file.

    `problem` says why there is none: no issue has that file name, or several have. What precedes a
    `~` is the file name of an export fetched again. The texts stay where they are if the issues are
    `most_sent` at most, which is counted first.
    """
    named = issues.select(file_id.alias("_id"), "issue_url").groupBy("_id").agg(
        F.min("issue_url").alias("_least"), F.max("issue_url").alias("_greatest")
    )
    if named.limit(most_sent + 1).count() <= most_sent:
        named = F.broadcast(named)
    one = F.col("_least") == F.col("_greatest")
    problem = F.when(F.col("_least").isNull(), "no issue").when(~one, "several issues")
    keyed = exports.drop("issue_url").withColumn("_id", F.regexp_replace("file_name", r"~[^~]*(\.\w+)$", "$1"))
    # File names are all but unique, so no key is hot.
    joined = keyed.join(named, "_id", "left").withColumns(
        {"issue_url": F.when(one, F.col("_least")), "problem": problem}
    )
    return joined.drop("_id", "_least", "_greatest")


def assign_issue(rows: DataFrame, issues: DataFrame, file_id: Column) -> DataFrame:
    """The rows of files with just one issue, with its URL; `named_issue` tells of the others."""
    return named_issue(rows, issues, file_id).where(F.col("issue_url").isNotNull()).drop("problem")


def scan_html_exports(spark: SparkSession, path: str) -> DataFrame:
    """Saved result pages: `(file_name, html)`."""
    return _whole_files(spark, path, "*.html").withColumnRenamed("value", "html")


def scan_holdings(spark: SparkSession, path: str, pattern: str = "*.pdf", contains: str = "") -> DataFrame:
    """Listing of a folder; the files' content is not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            file_name().alias("name"),
            "path",
            "length",
            F.col("modificationTime").alias("modification_time"),
        )
    )
    return listing.where(F.contains("name", F.lit(contains))) if contains else listing


def scan_remote_holdings(
    spark: SparkSession, path: str, fmt: str = "parquet", mime_type: str | None = None
) -> DataFrame:
    """A manifest of the remote folder, optionally of one MIME type."""
    listing = scan_table(spark, path, schemas.REMOTE_HOLDINGS, fmt)
    return listing.where(F.col("mime_type") == mime_type) if mime_type else listing


def scan_journal_list(spark: SparkSession, path: str) -> DataFrame:
    """`(position, journal)` of a journal list file; names are trimmed, repeats kept."""
    listed = spark.read.schema(schemas.JOURNAL_LIST).json(path, multiLine=True)
    return listed.select(F.posexplode("masterlist").alias("position", "_entry")).select(
        "position", whitespace_strip(F.col("_entry").getField(schemas.JOURNAL_KEY)).alias("journal")
    )


def filter_ext(rows: DataFrame, name: str, extension: str, contains: str = "") -> DataFrame:
    """Rows whose `name` has the extension, and `contains` anywhere."""
    return rows.where(F.endswith(name, F.lit(extension)) & F.contains(name, F.lit(contains)))
