"""What several corpus operators share: tables kept in the shared folder, and joins on uneven keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import shared_dir

#: Runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]"

#: A key with over 1 / HOT_PARTS of a table's rows is spread over SALTS sub-keys. At most HOT_PARTS
#: keys can be that large, so the list of them is small whatever the table's size.
HOT_PARTS = 512
SALTS = 64


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that every executor reaches; it goes when the session's file system closes."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


#: Bytes of rows that Spark sends to a Python worker at once; a larger row goes alone.
BATCH_BYTES = 2 << 20
_SPARK_BATCH_BYTES = "67108864b"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by BATCH_BYTES, unless the user has set another bound.

    A worker holds a batch several times over: as Arrow, as bytes and as arrays of eight bytes a byte.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == _SPARK_BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


#: Partitions of documents that short rows are written as one.
SHORT_PARTS = 8


def kept(df: DataFrame, name: str, short: bool = False) -> DataFrame:
    """`df` written to the shared folder and read back, so that no later job computes it again.

    `short`: its rows, and those it is made of, are a few numbers each, so partitions that are fit for
    documents go together into fewer files. On a local file system each file costs two processes that
    set its mode, and a child just started counts as much memory as its executor.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    folder = shared_folder(spark, name)
    if short:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, parts // SHORT_PARTS))
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def let(value: Column, use) -> Column:
    """`use(value)`, with `value` computed once per row also inside other lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hot_values(table: DataFrame, key: str, rows: str | None = None) -> list:
    """Values of `key` with over 1 / HOT_PARTS of the rows: HOT_PARTS of them at most.

    `rows` names a column of counts if `table` is counted by key already.
    """
    if rows is None:
        table = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
        table, rows = table.select(F.col(key), "_rows"), "_rows"
    total = table.agg(F.sum(rows)).first()[0] or 0
    found = table.where(F.col(rows) > max(SALTS, total // HOT_PARTS))
    return [r[0] for r in found.select(key).collect()]


def lookup(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", hot: list | None = None
) -> DataFrame:
    """Join `left` with `right`, which has one row per `key` and a non-null one.

    Rows of a hot key are dealt to SALTS sub-keys by a hash of the row and its input partition, and
    its one right row is copied to each. `hot` are the keys to treat so, where they are known;
    else they are counted, for which `left` should be a table.
    """
    if hot is None:
        hot = hot_values(left, key)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    deal = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(SALTS))
    copies = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    one = F.array(F.lit(0).cast("long"))
    dealt = left.withColumn("_salt", F.when(is_hot, deal).otherwise(F.lit(0).cast("long")))
    copied = right.withColumn("_salt", F.explode(F.when(is_hot, copies).otherwise(one)))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")
