"""A table of keyed rows that a stream replaces run by run.

All data folders of a store are written once, under `data/`. What counts is named by small files put
in place whole: `runs/<n>.json` names the rows of batch n, `versions/<n>.json` a base with the live rows
up to batch n. A reader takes the newest version and the runs after it, so it costs the live rows and
the few runs that are not folded in yet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.skew import lookup
from shelfmark.sources.marks import Marks

#: Runs that are folded into a new base, and versions that stay for readers that have begun.
FOLD_AFTER = 8
VERSIONS_KEPT = 2


class RunStore:
    """Rows of `schema`; what a run has of a key takes the place of all earlier rows of that key.

    Rows that are not `live` (a SQL condition) stay in the run but count for nothing. Where a run has
    several groups of rows of one key, told apart by the columns `newest_by`, the greatest counts.
    One writer at a time, any number of readers. A run that is written again changes nothing. Rows
    with a null key are rows of one key.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        newest_by: tuple[str, ...] = (),
        live: str = "true",
    ) -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.newest_by, self.live = list(newest_by), live
        self.marks = Marks(spark, self.path)

    def write(self, rows: DataFrame, run: int) -> DataFrame:
        """Write `rows` as run `run`, in one pass; gives what the run holds."""
        known = self.marks.read("runs", run)
        if known is None and run <= self._version()["upto"]:
            return self.spark.createDataFrame([], self.schema)
        if known is None:
            known = self._new_folder(f"run-{run}", rows.select(*self.schema.names))
            newest = self._newest_groups(known)
            if newest is not None:
                groups = [self.key, *self.newest_by]
                same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in groups]
                kept = self._rows(known).join(newest.toDF(*[f"_{c}" for c in groups]), same, "left_semi")
                dead = self._all_rows(known).where(f"NOT coalesce({self.live}, false)")
                first, known = known, self._new_folder(f"run-{run}", kept.unionByName(dead))
                self.marks.remove(f"data/{first}")
            self.marks.put("runs", run, known)
        return self._all_rows(known)

    def current(self) -> DataFrame:
        """The live rows; the base as it stands if no run came after it."""
        version = self._version()
        return self._live_rows(version, self._runs_after(version["upto"]))

    def fold(self, at_least: int = FOLD_AFTER) -> bool:
        """Fold the runs so far into a new base, if there are at least so many."""
        version = self._version()
        runs = self._runs_after(version["upto"])
        if not runs or len(runs) < at_least:
            return False
        base = self._new_folder(f"base-{runs[-1]}", self._live_rows(version, runs))
        self.marks.put("versions", runs[-1], base)
        self._clean()
        return True

    def _newest_groups(self, folder: str) -> DataFrame | None:
        """The group that counts of each key, or None if no key has several."""
        if not self.newest_by:
            return None
        groups = self._rows(folder).select(self.key, *self.newest_by).distinct()
        counted = groups.groupBy(self.key).agg(
            F.max(F.struct(*self.newest_by)).alias("newest"), F.count("*").alias("n")
        )
        if counted.where("n > 1").isEmpty():
            return None
        return counted.select(self.key, *[F.col("newest").getField(c) for c in self.newest_by])

    def _live_rows(self, version: dict, runs: list[int]) -> DataFrame:
        if not runs:
            return self._rows(version["folder"]) if version["folder"] else self.spark.createDataFrame([], self.schema)
        newer = self._newest_of([self.marks.read("runs", n) for n in runs], runs)
        if not version["folder"]:
            return newer.drop("_key")
        base = self._keyed(self._rows(version["folder"]))
        # Keys of a few runs: small beside the base, which then stays where it is.
        untouched = lookup(base, newer.select("_key").distinct(), "_key", "left_anti")
        return untouched.unionByName(newer).drop("_key")

    def _newest_of(self, folders: list[str], runs: list[int]) -> DataFrame:
        """`_key` and the rows of the newest run of each key."""
        rows = [self._keyed(self._rows(f)).withColumn("_run", F.lit(n)) for f, n in zip(folders, runs)]
        if len(rows) == 1:
            return rows[0].drop("_run")
        every = rows[0]
        for more in rows[1:]:
            every = every.unionByName(more)
        newest = every.groupBy("_key").agg(F.max("_run").alias("_newest"))
        return lookup(every, newest, "_key", "inner").where("_run = _newest").drop("_run", "_newest")

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """Null, which no join matches, as a value of its own."""
        text = F.col(self.key).cast("string")
        return rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), text), F.lit("")))

    def _all_rows(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{folder}")

    def _rows(self, folder: str) -> DataFrame:
        return self._all_rows(folder).where(self.live)

    def _new_folder(self, name: str, rows: DataFrame) -> str:
        folder = f"{name}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{folder}")
        return folder

    def _version(self) -> dict:
        found = self.marks.numbers("versions")
        if not found:
            return {"folder": None, "upto": -1}
        return {"folder": self.marks.read("versions", found[-1]), "upto": found[-1]}

    def _runs_after(self, upto: int) -> list[int]:
        return [n for n in self.marks.numbers("runs") if n > upto]

    def _clean(self) -> None:
        """Remove older versions, the runs that all kept versions hold, and data that nothing names."""
        kept = self.marks.keep_newest("versions", VERSIONS_KEPT)
        if len(kept) == VERSIONS_KEPT:
            for n in self.marks.numbers("runs"):
                if n <= kept[0]:
                    self.marks.remove(f"runs/{n}.json")
        self.marks.remove_unnamed("versions", "runs")
