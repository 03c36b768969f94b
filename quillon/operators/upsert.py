"""Keyed, idempotent upserts without a table format that has MERGE."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.operators.partitions import BUCKET, bucket_start, in_range
from quillon.types import DataTypeSpec

#: Buckets of a stored type that has no date.
HASH_BUCKETS = 64


class ConcurrentMerge(RuntimeError):
    """Another writer made the next version first; merge again."""


def dedupe_batch(batch: DataFrame, keys: Sequence[str], updates: Sequence[str], static: Sequence[str], seq: Column) -> DataFrame:
    """One row per key, as if the rows had been applied one after another in the order of ``seq``.

    Columns that an update may change come from the last row, the others from the first. Map-side combined.
    """
    aggs = []
    if updates:
        aggs.append(F.max_by(F.struct(*updates), F.struct(seq.alias("s"))).alias("__q_last"))
    if static:
        aggs.append(F.min_by(F.struct(*static), F.struct(seq.alias("s"))).alias("__q_first"))
    if not aggs:
        return batch.select(*keys).distinct()
    return batch.groupBy(*keys).agg(*aggs).select(*keys, *[F.col(f"__q_last.{c}").alias(c) for c in updates], *[F.col(f"__q_first.{c}").alias(c) for c in static])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], updates: Sequence[str], seq: Column | None = None) -> DataFrame:
    """``target`` after the rows of ``batch`` are inserted or, where the key is known, update ``updates``.

    An update sets null too. Both sides have the same columns; columns that are neither key nor update keep the
    target's value. ``seq`` orders repeats of a key within the batch (later wins); without it the batch must be unique.
    Rows with a null key part are never equal to others and stay apart. One full outer join on the key.
    """
    columns = target.columns
    static = [c for c in columns if c not in keys and c not in updates]
    new = batch.select(*columns) if seq is None else dedupe_batch(batch, keys, updates, static, seq).select(*columns)
    old = target.select(*[F.col(c).alias(f"__q_t_{c}") for c in columns], F.lit(True).alias("__q_t"))
    fresh = new.select(*[F.col(c).alias(f"__q_b_{c}") for c in columns], F.lit(True).alias("__q_b"))
    on = [F.col(f"__q_t_{k}") == F.col(f"__q_b_{k}") for k in keys]
    both = old.join(fresh, on, "full_outer")
    pick = lambda c, first: F.when(F.col(first).isNotNull(), F.col(f"{first}_{c}")).otherwise(F.col(f"{'__q_t' if first == '__q_b' else '__q_b'}_{c}")).alias(c)
    return both.select(*[pick(c, "__q_b" if c in updates else "__q_t") for c in columns])


def upsert_spec(target: DataFrame, batch: DataFrame, spec: DataTypeSpec, seq: Column | None = None) -> DataFrame:
    """:func:`upsert` with the keys, guards, defaults and update columns of a record type."""
    ready = batch.where(spec.valid())
    if spec.defaults:
        ready = ready.withColumns({c: F.coalesce(F.col(c), F.lit(v)).cast(spec.schema[c].dataType) for c, v in spec.defaults.items()})
    if spec.name == "eod":  # a new row without adjusted close starts with the close
        ready = ready.withColumn("adj_close", F.coalesce("adj_close", "close"))
    return upsert(target, ready, spec.keys, spec.updates, seq)


class Merged(NamedTuple):
    """What a merge did: rows of the rewritten buckets, batch rows set aside, and the version that it made."""

    rows: int
    rejects: int
    version: int


class ParquetStore:
    """A record type stored as Parquet, merged bucket by bucket under one atomic pointer.

    ``root/data/<bucket>=b/v=<id>`` holds the files of a bucket, ``root/log/<n>.json`` names for version n the folder of
    each bucket. A merge writes new folders for the buckets that its batch touches and then creates the next log
    entry; that single rename makes all of them visible at once. Whatever stops a merge before it leaves the table as it
    was, and a reader keeps the version that it opened. :meth:`vacuum` deletes folders that no kept version names.

    Buckets: partitioned types lie in the fixed date ranges, other types with a date in calendar years, types without
    one in ``HASH_BUCKETS`` hash buckets of the key; so a batch of recent dates never rewrites the whole table.

    Defined cases: a partitioned type has no bucket for a row without date or before the first range; such rows go to
    ``root/rejects`` and are counted (a batch that is merged again, as after a failure, stores its rejects again). An empty batch makes no version. Of two writers that build on the same
    version one succeeds and the other gets :class:`ConcurrentMerge` and may merge again. The log entry's rename must
    be atomic and must not replace a file, as on HDFS.
    """

    def __init__(self, spark: SparkSession, root: str, spec: DataTypeSpec) -> None:
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        dated = "event_date" in spec.schema.names
        self.bucket = BUCKET if spec.partitioned else "event_year" if dated else "key_bucket"

    def _bucket(self) -> Column:
        if self.spec.partitioned:
            return bucket_start(F.col("event_date"))
        if self.bucket == "event_year":
            return F.coalesce(F.year("event_date"), F.lit(0))
        return F.pmod(F.xxhash64(*self.spec.keys), F.lit(HASH_BUCKETS)).cast("int")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        p = self._path(self.root)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        fs, log = self._fs(), self._path(f"{self.root}/log")
        if not fs.exists(log):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _state(self, version: int) -> dict:
        stream = self._fs().open(self._path(f"{self.root}/log/{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def version(self) -> int:
        """The newest version, 0 if the table doesn't exist."""
        return (self._versions() or [0])[-1]

    def exists(self) -> bool:
        return self.version() > 0

    def _commit(self, after: int, state: dict) -> int:
        """Create the log entry after version ``after``; an error if another writer did so first."""
        fs, jvm = self._fs(), self.spark._jvm
        fs.mkdirs(self._path(f"{self.root}/log"))
        staged, goal = self._path(f"{self.root}/log/.{uuid.uuid4().hex}"), self._path(f"{self.root}/log/{after + 1:012d}.json")
        out = fs.create(staged, False)
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = rename
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
            context.rename(fs.makeQualified(staged), fs.makeQualified(goal), options)
        except Exception as e:
            fs.delete(staged, False)
            if fs.exists(goal):
                raise ConcurrentMerge(f"version {after + 1} of {self.root} was made by another writer") from e
            raise
        return after + 1

    def _load(self, state: dict, buckets: list[str] | None = None) -> DataFrame:
        """Rows of a version with their bucket column, of all or the named buckets."""
        schema = self.spec.schema
        stored = T.StructType([*schema.fields, T.StructField(self.bucket, T.IntegerType()), T.StructField("v", T.StringType())])
        paths = [f"{self.root}/data/{self.bucket}={b}/v={v}" for b, v in sorted(state["buckets"].items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], stored).drop("v")
        return self.spark.read.schema(stored).option("basePath", f"{self.root}/data").parquet(*paths).drop("v")

    def _newest(self) -> tuple[int, dict]:
        n = self.version()
        return n, self._state(n) if n else {"buckets": {}}

    def read(self, version: int | None = None) -> DataFrame:
        """The table, newest or as of a version."""
        state = self._newest()[1] if version is None else self._state(version)
        return self._load(state).select(*self.spec.schema.names)

    def read_range(self, start: str, end: str) -> DataFrame:
        """Rows of a partitioned type from ``start`` to ``end``, both included; other buckets are pruned."""
        return in_range(self._load(self._newest()[1]), "event_date", start, end).select(*self.spec.schema.names)

    def rejects(self) -> DataFrame:
        """All batch rows that no bucket takes."""
        fs, p = self._fs(), self._path(f"{self.root}/rejects")
        return self.spark.read.schema(self.spec.schema).parquet(f"{self.root}/rejects/*") if fs.exists(p) else self.spark.createDataFrame([], self.spec.schema)

    def create(self) -> None:
        """An empty table, if there is none."""
        if not self.exists():
            self._commit(0, {"buckets": {}})

    def merge(self, batch: DataFrame, seq: Column | None = None) -> Merged:
        """Merge a batch into the table."""
        spec, mark = self.spec, uuid.uuid4().hex
        with_bucket = batch.withColumn(self.bucket, self._bucket())
        counts = {r[0]: r[1] for r in with_bucket.groupBy(self.bucket).count().collect()}  # one row per bucket
        rejected = counts.pop(None, 0)
        if rejected:
            with_bucket.where(F.col(self.bucket).isNull()).select(*spec.schema.names).write.mode("overwrite").parquet(f"{self.root}/rejects/{mark}")
        n, state = self._newest()
        if not counts:
            return Merged(0, rejected, n)
        old = self._load(state, [str(b) for b in counts]).select(*spec.schema.names)
        good = with_bucket.where(F.col(self.bucket).isNotNull()).drop(self.bucket)
        rows = self._write(upsert_spec(old, good, spec, seq), mark, list(counts))
        return Merged(rows, rejected, self._commit(n, state | {"buckets": state["buckets"] | {str(b): mark for b in self._made(mark, list(counts))}}))

    def replace(self, rows: DataFrame, **notes: object) -> int:
        """The next version holds ``rows`` alone, its log entry also ``notes``; returns its number."""
        n, state = self._newest()
        mark = uuid.uuid4().hex
        found = [r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()]
        if None in found:
            raise ValueError("a row without date or before the first range has no bucket")
        self._write(rows, mark, found)
        return self._commit(n, state | notes | {"buckets": {str(b): mark for b in self._made(mark, found)}})

    def _write(self, rows: DataFrame, mark: str, buckets: list) -> int:
        placed = rows.withColumns({self.bucket: self._bucket(), "v": F.lit(mark)})
        # Adaptive execution splits a large bucket into files of the advisory size.
        even = placed.hint("rebalance", self.bucket).sortWithinPartitions(self.bucket, *self.spec.keys)
        even.write.mode("append").option("compression", "zstd").partitionBy(self.bucket, "v").parquet(f"{self.root}/data")
        return self._load({"buckets": {str(b): mark for b in self._made(mark, buckets)}}).count()

    def _made(self, mark: str, buckets: list) -> list:
        """Buckets that got files; guards may have dropped all rows of one."""
        fs = self._fs()
        return [b for b in buckets if fs.exists(self._path(f"{self.root}/data/{self.bucket}={b}/v={mark}"))]

    def vacuum(self, keep: int = 1) -> int:
        """Delete folders and log entries that the newest ``keep`` versions don't need; returns the folders deleted.

        Run it when no merge is under way and no reader has an older version open.
        """
        fs, versions = self._fs(), self._versions()
        live = {(b, v) for n in versions[-keep:] for b, v in self._state(n)["buckets"].items()}
        gone, data = 0, self._path(f"{self.root}/data")
        for bucket in fs.listStatus(data) if fs.exists(data) else []:
            name = bucket.getPath().getName()
            if "=" not in name:
                continue
            for folder in fs.listStatus(bucket.getPath()):
                if (name.split("=")[1], folder.getPath().getName().split("=")[1]) not in live:
                    fs.delete(folder.getPath(), True)
                    gone += 1
        for n in versions[:-keep]:
            fs.delete(self._path(f"{self.root}/log/{n:012d}.json"), False)
        return gone
