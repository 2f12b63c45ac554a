"""Parquet tables that grow by one part a micro-batch, with a committed list of the parts that count.

A part is written first, as ``data/<key folders>/part=<name>``; then a new version of the list is committed by renaming
a finished file to the next free number, so readers see a batch whole or not at all. A batch written again
(at-least-once replay, or a crash between the two steps) replaces its earlier part in the list; what the list does not name is
never read. :meth:`BatchTable.compact` rewrites neighbouring old parts as one and swaps them in one
commit, :meth:`BatchTable.expire` leaves out old key folders, :meth:`BatchTable.vacuum` deletes parts that no kept version
of the list names. Rows never pass through the driver, only the names of parts and folders do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class BatchTable:
    """``keys``: columns that become folders above the parts (a date, a time slot); a read can be limited to some."""

    def __init__(self, spark: SparkSession, root: str, keys: Iterable[str] = ()):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), tuple(keys)
        self.data, self.log = f"{self.root}/data", f"{self.root}/_list"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- the list of parts -------------------------------------------------------

    def versions(self) -> list[int]:
        folder = self._path(self.log)
        if not self._fs.exists(folder):
            return []
        names = (f.getPath().getName() for f in self._fs.listStatus(folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def parts(self, version: int | None = None) -> list[dict]:
        """Committed parts (first and last batch, name, key folders, stats) in batch order."""
        known = self.versions()
        if not known:
            return []
        stream = self._fs.open(self._path(f"{self.log}/{version or known[-1]:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, change: Callable[[list[dict]], list[dict]]) -> list[dict]:
        """Commit ``change`` of the current list; taken again on a list that another writer committed meanwhile."""
        for _ in range(100):
            version = (self.versions() or [0])[-1]
            new = sorted(change(self.parts(version) if version else []), key=lambda p: p["first"])
            draft = self._path(f"{self.log}/draft-{uuid.uuid4().hex}")
            out = self._fs.create(draft, False)
            out.write(bytearray(json.dumps(new).encode()))
            out.close()
            target = self._path(f"{self.log}/{version + 1:012d}.json")
            if not self._fs.exists(target) and self._fs.rename(draft, target):
                return new
            self._fs.delete(draft, False)
        raise RuntimeError(f"no version of {self.log} could be committed")

    # ---- writing -----------------------------------------------------------------

    def _write(self, df: DataFrame, name: str) -> list[str]:
        """Write a part; its key folders."""
        df.withColumn("part", F.lit(name)).write.mode("append").partitionBy(*self.keys, "part").parquet(self.data)
        found = self._fs.globStatus(self._path("/".join([self.data, *["*"] * len(self.keys), f"part={name}"])))
        base = self._fs.makeQualified(self._path(self.data)).toString()
        return sorted(f.getPath().getParent().toString().removeprefix(base).strip("/") for f in found or [])

    def append(self, df: DataFrame, batch_id: int, stats: dict | None = None) -> dict:
        """Write and commit one batch; a batch committed before is replaced. One that was compacted with others is
        complete and stays."""
        done = next((p for p in self.parts() if p["first"] <= batch_id <= p["last"] and p["first"] < p["last"]), None)
        if done:
            return done
        name = f"b{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        part = {"first": batch_id, "last": batch_id, "name": name, "folders": self._write(df, name), "stats": stats or {}}
        self._commit(lambda parts: [p for p in parts if not p["first"] == p["last"] == batch_id] + [part])
        return part

    def compact(self, keep_last: int = 2, at_least: int = 2) -> int:
        """Rewrite all parts but the ``keep_last`` newest as one, if they are ``at_least`` so many; how many they were.
        The newest batch can still be replayed, so one is kept in any case."""
        old = self.parts()[:-max(keep_last, 1)]
        if len(old) < at_least:
            return 0
        names = {p["name"] for p in old}
        name = f"c{old[0]['first']:012d}-{uuid.uuid4().hex[:8]}"
        merged = {"first": old[0]["first"], "last": old[-1]["last"], "name": name, "stats": {}, "folders": []}
        for key in set().union(*(p["stats"] for p in old)):
            merged["stats"][key] = max(p["stats"][key] for p in old if key in p["stats"])
        rows = self._rows(old)
        if rows is not None:
            # a key folder's rows go to one task each, or to more where Spark finds the folder large
            merged["folders"] = self._write(rows.hint("rebalance", *self.keys) if self.keys else rows.hint("rebalance"), name)

        def swap(parts: list[dict]) -> list[dict]:
            if not names <= {p["name"] for p in parts}:
                raise RuntimeError("a compacted part was replaced meanwhile")
            return [p for p in parts if p["name"] not in names] + [merged]

        self._commit(swap)
        return len(old)

    def expire(self, gone: Callable[[str], bool]) -> None:
        """Leave out the key folders (``key=value/...``) for which ``gone`` holds."""
        if any(gone(f) for p in self.parts() for f in p["folders"]):
            self._commit(lambda parts: [p | {"folders": [f for f in p["folders"] if not gone(f)]} for p in parts])

    def vacuum(self, keep_versions: int = 10) -> int:
        """Delete parts that none of the ``keep_versions`` newest lists names, and the older lists; how many folders went.
        Not to be run while a batch is being written."""
        known = self.versions()
        kept = {"/".join([*filter(None, [f]), f"part={p['name']}"]) for v in known[-max(keep_versions, 1):] for p in self.parts(v) for f in p["folders"]}
        base, n = self._fs.makeQualified(self._path(self.data)).toString(), 0
        for f in self._fs.globStatus(self._path("/".join([self.data, *["*"] * len(self.keys), "part=*"]))) or []:
            if f.getPath().toString().removeprefix(base).strip("/") not in kept:
                self._fs.delete(f.getPath(), True)
                n += 1
        for v in known[:-max(keep_versions, 1)]:
            self._fs.delete(self._path(f"{self.log}/{v:012d}.json"), False)
        return n

    # ---- reading -----------------------------------------------------------------

    def _rows(self, parts: list[dict], where: Callable[[str], bool] | None = None,
              schema: StructType | None = None) -> DataFrame | None:
        paths = ["/".join([self.data, *filter(None, [f]), f"part={p['name']}"]) for p in parts for f in p["folders"]
                 if where is None or where(f)]
        if not paths:
            return None
        reader = self.spark.read.option("basePath", self.data)
        return (reader.schema(schema) if schema is not None else reader).parquet(*paths).drop("part")

    def read(self, schema: StructType, upto: int | None = None, where: Callable[[str], bool] | None = None) -> DataFrame:
        """Rows (``schema``, key columns included) of the committed parts of batches up to ``upto``, of the key folders
        for which ``where`` holds."""
        rows = self._rows([p for p in self.parts() if upto is None or p["last"] <= upto], where, schema)
        return self.spark.createDataFrame([], schema) if rows is None else rows.select(*schema.fieldNames())
