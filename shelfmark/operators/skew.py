"""Joins and numbering that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import checkpoint

# A key with more rows than this is split; session setting, so a test can lower it.
HOT_ROWS_SETTING = "shelfmark.skew.hotRows"
HOT_ROWS = 1_000_000
# Keys are counted in groups by hash; the largest of each group may be split. Their number bounds
# what is broadcast, and a key that is neither owns well under a hundredth of the rows.
GROUPS = 16
HOT_PER_GROUP = 16
TRACKED_PER_GROUP = 128


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """`(key, _salts)` of the keys with many rows: GROUPS * HOT_PER_GROUP rows at most.

    One scan of the key column into frequent-item sketches of fixed size, combined map-side. The
    counts are estimates; they steer only how rows are spread, never which rows a result holds.
    """
    limit = hot_rows(df)
    top = F.expr(f"approx_top_k(`{key}`, {HOT_PER_GROUP}, {TRACKED_PER_GROUP})")
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.pmod(F.xxhash64(key), F.lit(GROUPS)).alias("_group"))
        .agg(top.alias("_top"))
        .select(F.inline("_top"))
        .where(F.col("count") > limit)
        .select(F.col("item").alias(key), F.ceil(F.col("count") / limit).cast("int").alias("_salts"))
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join `left` with `right`, which holds one row per `key`.

    Rows of a hot key are spread over `_salts` sub-keys and its one right row is copied to each, so
    no task receives much more than HOT_ROWS rows of one key. Rows with a null key never match and
    are spread too. The spread hashes the row and its input partition, hence copies of one row
    spread as well, and a repeated task repeats the choice. `hot` may come from any table whose
    counts bound those of `left`, best the one `left` was filtered from.
    """
    if hot is None:
        hot = hot_keys(left, key)
    return spread(left, key, hot).join(copied(right, key, hot), [key, "_salt"], how).drop("_salt")


def spread(left: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """`left` with `_salt`, the sub-key of each row: 0 but for rows of hot and null keys."""
    hashed = F.xxhash64(*[c for c in left.columns if not _is_map(left, c)], F.spark_partition_id())
    return (
        left.join(F.broadcast(hot), key, "left")  # its size is bounded, see hot_keys
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), hashed)
            .when(F.col("_salts").isNotNull(), F.pmod(hashed, F.col("_salts")))
            .otherwise(F.lit(0).cast("long")),
        )
        .drop("_salts")
    )


def copied(right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """`right`, of one row per key, with a row for each `_salt` that `spread` may have chosen."""
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1)
    return right.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")


def _is_map(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "map"


def number_rows(
    df: DataFrame, key: str, order: list[Column], copies: str, position: str = "position"
) -> DataFrame:
    """1, 2, 3 … per `key` in `order`, which must be total within a key.

    A row stands for `copies` equal ones: it gets the place of the first, and the next row comes
    after the last. A window over `key` alone would sort a hot key in one task. Here the rows are
    range-partitioned by key and order, numbered within each range, and shifted by what the same
    key has in earlier ranges. The ranges come from a sample, so a checkpoint fixes them before they
    are counted.
    """
    ranged = checkpoint(
        df.repartitionByRange(F.col(key).asc_nulls_last(), *order).withColumn(
            "_range", F.spark_partition_id()
        )
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    earlier = before.partitionBy(key).orderBy("_range")
    # A range can continue only the key the range before it ended with: one row per range at most.
    shifts = (
        ranged.groupBy(key, "_range")
        .agg(F.sum(copies).alias("_n"))
        .withColumn("_shift", F.sum("_n").over(earlier))
        .where(F.col("_shift").isNotNull())
        .select(F.col(key).alias("_key"), F.col("_range").alias("_shifted"), "_shift")
    )
    within = before.partitionBy(key, "_range").orderBy(*order)
    joined = ranged.withColumn("_within", F.sum(copies).over(within)).join(
        F.broadcast(shifts),
        (F.col("_range") == F.col("_shifted")) & F.col(key).eqNullSafe(F.col("_key")),
        "left",
    )
    place = F.lit(1) + F.coalesce("_within", F.lit(0)) + F.coalesce("_shift", F.lit(0))
    return joined.withColumn(position, place).select(*df.columns, position)
