"""Versions of a graph in a folder, and tables that take small batches.

path/VERSION/TABLE holds a table of a version.  The version counts only once its marker is there,
which names the folder of each table: a table that a stage leaves as it is is not written again.
So a run that was killed goes on from the last whole stage.  path/_current holds numbered files, each named and
filled by one promotion; the greatest number is the current version.  A file appears there by one
rename, so readers see the old version or the new one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Graph
from ..operators import graphops as g

WHOLE = "WHOLE.json"
PARTS = 64


class Store:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        #: Tables as they were read, and where from.
        self.read: dict[int, tuple[DataFrame, str]] = {}

    def _place(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, *names: str) -> list[str]:
        path, files = self._place(*names)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _put(self, text: str, *names: str) -> None:
        """A file that is there whole or not at all."""
        path, files = self._place(*names)
        draft, _ = self._place(f"_draft-{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        files.mkdirs(path.getParent())
        if not files.rename(draft, path):
            raise FileExistsError(str(path.toString()))

    def versions(self) -> list[str]:
        """Whole versions by name."""
        return [v for v in self._listed() if not v.startswith(("_", ".")) and WHOLE in self._listed(v)]

    def save(self, version: str, graph: Graph) -> Graph:
        """Write the tables that are new, then the marker; read all back.  What a killed run left is
        replaced."""
        if version in self.versions():
            raise FileExistsError(f"{self.path}/{version}")
        places = {}
        for f in fields(graph):
            frame = getattr(graph, f.name)
            known = self.read.get(id(frame))
            places[f.name] = known[1] if known and known[0] is frame else f"{version}/{f.name}"
            if places[f.name].startswith(f"{version}/"):
                frame.write.mode("overwrite").parquet(f"{self.path}/{places[f.name]}")
        self._put(json.dumps(places), version, WHOLE)
        return self.load(version)

    def load(self, version: str) -> Graph:
        text = self.spark.read.text(f"{self.path}/{version}/{WHOLE}", wholetext=True).first()
        out = {}
        for name, place in json.loads(text[0]).items():
            out[name] = self.spark.read.parquet(f"{self.path}/{place}")
            self.read[id(out[name])] = out[name], place
        return Graph(**out)

    def forget(self, versions: list[str]) -> None:
        """Versions are no longer whole; their tables are replaced by the next run."""
        for version in versions:
            path, files = self._place(version, WHOLE)
            if files.exists(path):
                files.delete(path, False)

    def promote(self, version: str) -> None:
        """Make a whole version the current one."""
        if version not in self.versions():
            raise ValueError(f"no whole version {version}")
        last = max([int(n.split("-")[0]) for n in self._listed("_current")], default=0)
        self._put(version, "_current", f"{last + 1:08}-{version}")

    def current(self) -> str | None:
        found = self._listed("_current")
        return found[-1].split("-", 1)[1] if found else None

    def status(self) -> list[tuple[str, bool, bool]]:
        """(version, whole, current) of every version that was begun."""
        whole, now = self.versions(), self.current()
        return [(v, v in whole, v == now) for v in self._listed() if not v.startswith(("_", "."))]

    def run(self, stages: list[tuple[str, Callable[[Graph | None], Graph]]], resume: bool = False) -> Graph:
        """Stages in order, each saved as a version under its name; a resumed run starts behind
        the last whole one."""
        whole = self.versions() if resume else []
        done = max([i for i, (name, _) in enumerate(stages) if name in whole], default=-1)
        graph = self.load(stages[done][0]) if done >= 0 else None
        for name, stage in stages[done + 1 :]:
            graph = self.save(name, stage(graph))
        return graph


def _part(keys: list[str], parts: int) -> F.Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def create(rows: DataFrame, path: str, keys: list[str], parts: int = PARTS) -> None:
    """A table in hash partitions of its keys."""
    rows.withColumn("part", _part(keys, parts)).hint("rebalance", "part").write.partitionBy("part").parquet(path)


def upsert(batch: DataFrame, path: str, keys: list[str], lists: tuple[str, ...] = (), parts: int = PARTS) -> None:
    """Merge a batch (unique on its keys) into the table at path.

    What the table has stays, its nulls are filled, `lists` are united.  Only partitions that a key
    of the batch belongs to are read and written anew; the same batch again changes nothing, so a
    broken run is repeated."""
    spark = batch.sparkSession
    batch = batch.withColumn("part", _part(keys, parts))
    touched = [r["part"] for r in batch.select("part").distinct().collect()]
    held = spark.read.parquet(path).where(F.col("part").isin(touched))
    names = [c for c in held.columns if c not in (*keys, "part")]
    new = batch.select(*keys, "part", *[F.col(c).alias(f"new_{c}") for c in names if c in batch.columns])
    rows = held.join(new, [*keys, "part"], "full")
    both = lambda c: F.concat(F.coalesce(c, F.array()), F.coalesce(f"new_{c}", F.array()))
    value = lambda c: c if c not in batch.columns else (F.array_sort(F.array_distinct(both(c))) if c in lists else F.coalesce(c, f"new_{c}")).alias(c)
    merged = g.checkpointed(rows.select(*keys, *[value(c) for c in names], "part"))
    merged.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
