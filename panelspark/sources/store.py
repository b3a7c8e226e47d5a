"""Keyed tables under one commit log.

A store is a folder with data files, which never change, and a log of one small file a version. A version lists, for
each of its tables, the folder of every partition. A write

1. reads the latest version,
2. merges its updates with those partitions alone that hold their keys, and writes these into folders of its own,
3. publishes the next version: the touched partitions point to the new folders, all others are carried over.

Publishing renames a complete file to a name that must not exist yet, so of two writers that started from one version
the second one fails; it then starts again from the version that won, redoing only tables whose touched partitions
changed in between. Several tables can go into one version: readers see all of them or none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def merge_upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Matched keys take the update's non-key columns, unmatched updates are
    inserted, other target rows stay (S12). Duplicate keys inside `updates`:
    the last by `order`, then by the other columns, wins (an aggregate, combined map-side); without
    an order they are an error, raised when the result is computed."""
    keys = list(keys)
    rest = [c for c in updates.columns if c not in keys]
    upd = updates
    if not rest:
        upd = updates.dropDuplicates(keys)
    elif order is None:
        once = updates.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r"), F.count(F.lit(1)).alias("_times"))
        checked = F.when(F.col("_times") == 1, F.col("_r")).otherwise(F.raise_error(F.lit("updates repeat a key; name an order column")))
        upd = once.select(*keys, checked.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
    else:
        best = updates.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("_order"), F.struct(*rest).alias("_rest"))).alias("_r"))
        upd = best.select(*keys, *[F.col(f"_r._rest.{c}").alias(c) for c in rest])
    if target is None:
        return upd.select(*updates.columns)
    kept = target.join(upd.select(*keys), keys, "left_anti")
    return kept.unionByName(upd.select(*target.columns))


@dataclass
class Update:
    """Rows to upsert. Partitions are the values of `by`, or BUCKETS buckets of a hash of the keys."""
    rows: DataFrame
    keys: Sequence[str]
    order: str | None = None
    by: str | None = None

    def labelled(self) -> DataFrame:
        label = F.regexp_replace(F.coalesce(F.col(self.by).cast("string"), F.lit("null")), "[^A-Za-z0-9_.-]", "_") if self.by \
            else F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("string")
        return self.rows.withColumn("_part", label)


class Conflict(Exception):
    """Another writer has published this version."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("_log").getFileSystem(self._conf)

    def version(self) -> int:
        """The latest version; 0 before the first."""
        fs, log = self._fs(), self._path("_log")
        names = [s.getPath().getName() for s in fs.listStatus(log)] if fs.exists(log) else []
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def state(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "tables": {}, "note": {}}
        stream = self._fs().open(self._path(f"_log/{version:020d}.json"))
        try:
            reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return json.loads(reader.readLine())
        finally:
            stream.close()

    def _read_parts(self, folders: Sequence[str]) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders]) if folders else None

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        parts = self.state(version)["tables"].get(name)
        return None if parts is None else self._read_parts(sorted(set(parts.values())))

    def _stage(self, base: dict, name: str, update: Update) -> dict[str, str]:
        """Writes the merged partitions that the update touches; (partition: folder)."""
        rows = update.labelled()
        labels = [r[0] for r in rows.select("_part").distinct().collect()]  # the partitions touched
        old = base["tables"].get(name, {})
        merged = merge_upsert(self._read_parts([old[x] for x in labels if x in old]), update.rows, update.keys, update.order)
        folder = f"data/{name}/{uuid.uuid4().hex}"
        out = Update(merged, update.keys, by=update.by).labelled()
        if labels:
            out.repartition("_part").write.partitionBy("_part").parquet(f"{self.root}/{folder}")
        return {x: f"{folder}/_part={x}" for x in labels}

    def _publish(self, version: int, content: dict) -> None:
        fs, name = self._fs(), f"_log/{version:020d}.json"
        tmp = self._path(f"_log/.{version}-{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, True)
        out.write(json.dumps(content).encode() + b"\n")
        out.close()
        sc = self.spark.sparkContext
        none = sc._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:  # without the option to overwrite, a name that exists is an error
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(
                fs.makeQualified(tmp), fs.makeQualified(self._path(name)), none)
        except Py4JJavaError as e:
            fs.delete(tmp, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise Conflict(version) from e
            raise

    def write(self, updates: Mapping[str, Update], note: dict | None = None, before_publish: Callable[[], None] | None = None) -> int:
        """Upserts several tables as one version; returns it. `before_publish` runs between staging and publishing."""
        staged, base = {}, None
        while True:
            latest = self.state()
            for name, u in updates.items():
                old, new = ((base or latest)["tables"].get(name, {}), latest["tables"].get(name, {}))
                if name not in staged or any(old.get(x) != new.get(x) for x in staged[name]):
                    staged[name] = self._stage(latest, name, u)
            base = latest
            tables = dict(latest["tables"])
            for name, parts in staged.items():
                tables[name] = {**tables.get(name, {}), **parts}
            if before_publish:
                hook, before_publish = before_publish, None
                hook()
            try:
                self._publish(latest["version"] + 1, {"version": latest["version"] + 1, "tables": tables, "note": note or {}})
                return latest["version"] + 1
            except Conflict:
                continue

    def expire(self, keep: int, older_than_ms: int) -> int:
        """Deletes data folders that none of the last `keep` versions names and that are older than a running writer can
        be; returns how many went."""
        fs, last = self._fs(), self.version()
        used = {f.rsplit("/", 1)[0] for v in range(max(1, last - keep + 1), last + 1) for parts in self.state(v)["tables"].values() for f in parts.values()}
        limit, gone = self._jvm.java.lang.System.currentTimeMillis() - older_than_ms, 0
        for table in fs.listStatus(self._path("data")) if last else []:
            for s in fs.listStatus(table.getPath()):
                if f"data/{table.getPath().getName()}/{s.getPath().getName()}" not in used and s.getModificationTime() <= limit:
                    gone += fs.delete(s.getPath(), True)
        return gone
