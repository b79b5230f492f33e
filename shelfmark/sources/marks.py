"""Small files that name a folder of data, seen whole or not at all: `<kind>/<n>.json` under a path.

Data folders are written once and never renamed, so this serves object stores too: what is put in
place is one small file.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Marks:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._place(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def qualified(self) -> str:
        """The path as every session reads it, wherever it runs."""
        return self._fs.makeQualified(self._place(self.path)).toString()

    def names(self, folder: str) -> list[str]:
        path = self._place(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def numbers(self, kind: str) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.names(kind) if n.endswith(".json"))

    def read(self, kind: str, n: int) -> str | None:
        path = self._place(f"{self.path}/{kind}/{n}.json")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())["folder"]
        finally:
            stream.close()

    def put(self, kind: str, n: int, folder: str) -> None:
        aside, here = (self._place(f"{self.path}/{kind}/{n}.{end}") for end in ("writing", "json"))
        stream = self._fs.create(aside, True)
        stream.write(bytearray(json.dumps({"folder": folder}), "utf-8"))
        stream.close()
        if not self._fs.rename(aside, here):
            raise OSError(f"{here} cannot be put in place")

    def remove(self, name: str) -> None:
        self._fs.delete(self._place(f"{self.path}/{name}"), True)

    def keep_newest(self, kind: str, versions: int) -> list[int]:
        """Remove all but the newest marks; those left."""
        found = self.numbers(kind)
        for n in found[:-versions]:
            self.remove(f"{kind}/{n}.json")
        return found[-versions:]

    def remove_unnamed(self, *kinds: str) -> None:
        """Remove data that no mark names: of older versions, and of writers that failed."""
        named = {self.read(kind, n) for kind in kinds for n in self.numbers(kind)}
        for name in self.names("data"):
            if name not in named:
                self.remove(f"data/{name}")
