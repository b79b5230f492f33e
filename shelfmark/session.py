"""Session settings shared by the bench, the tests and stand-alone runs."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session; a cluster supplies its own through spark-submit."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local master may fall back on a temporary folder of this machine.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return tempfile.mkdtemp(prefix="shelfmark-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back, so a lost executor cannot re-order it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
