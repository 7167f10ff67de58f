"""Stored tables that a stream changes: rows replaced by entry, and keys already seen.

Both cut their rows into buckets by a hash of the key and touch only the buckets
of the keys at hand. A batch is written under its own number and becomes visible
with a pointer written last, so a batch that dies half way is not seen, and a
replayed batch is either skipped or writes the same files again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitegrade.session import cut_lineage


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    target, system = _path(spark, path)
    return bool(system.exists(target))


def _bucket(keys: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class EntryStore:
    """Several tables of rows by entry; the entries of a batch are replaced in all of them.

    A pointer of a batch names, for every table and bucket, the batch that wrote
    its rows: at most ``buckets`` numbers a table, whatever the data. Choose
    ``buckets`` so that one bucket of the largest table is a convenient file.
    """

    def __init__(self, spark: SparkSession, folder: str, tables: Sequence[str], buckets: int = 64):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.tables, self.buckets = tuple(tables), buckets

    def _state(self) -> dict | None:
        """The last completed pointer: batch, schemas, and the batch of every bucket."""
        target, system = _path(self.spark, f"{self.folder}/pointer")
        if not system.exists(target):
            return None
        done = [
            int(s.getPath().getName().removeprefix("batch="))
            for s in system.listStatus(target)
            if _exists(self.spark, f"{s.getPath()}/_SUCCESS")
        ]
        if not done:
            return None
        row = self.spark.read.text(f"{self.folder}/pointer/batch={max(done)}").first()
        return json.loads(row["value"])

    def _rows(self, state: dict, name: str, only: set[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(state["schemas"][name])
        paths = [
            f"{self.folder}/{name}/batch={batch}/bucket={bucket}"
            for bucket, batch in state["buckets"][name].items()
            if only is None or int(bucket) in only
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, name: str) -> DataFrame:
        """A table as of the last completed batch."""
        state = self._state()
        if state is None:
            raise ValueError(f"nothing was stored under {self.folder} yet")
        return self._rows(state, name)

    def commit(self, staged: dict[str, DataFrame], replaced: DataFrame, batch_id: int) -> bool:
        """Replace the entries of ``replaced`` in every table by their ``staged`` rows.

        Rows of other entries in ``staged`` are ignored. A table may gain columns,
        which rows stored before lack. Returns False, and does
        nothing, for a batch that was committed before.
        """
        if set(staged) != set(self.tables):
            raise ValueError(f"a batch replaces rows of all of {self.tables}, not of {tuple(staged)}")
        state = self._state()
        if state is not None and state["batch"] >= batch_id:
            return False
        key = F.lower(F.trim("entry_id"))
        ids = cut_lineage(replaced.select(key.alias("__key")).distinct().withColumn(
            "bucket", _bucket([F.col("__key")], self.buckets)))
        # at most one row per bucket
        touched = {row[0] for row in ids.select("bucket").distinct().collect()}
        held, schemas = {}, {}
        for name in self.tables:
            rows = staged[name].withColumn("__key", key)
            fresh = rows.join(ids, "__key").drop("__key")
            if state is not None:
                old = self._rows(state, name, touched).withColumn("__key", key)
                kept = old.join(ids, "__key", "left_anti").withColumn(
                    "bucket", _bucket([F.col("__key")], self.buckets)).drop("__key")
                fresh = kept.unionByName(fresh, allowMissingColumns=True)
            path = f"{self.folder}/{name}/batch={batch_id}"
            # adaptive execution splits a bucket that one entry crowds
            fresh.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
            found = {b for b in touched if _exists(self.spark, f"{path}/bucket={b}")}
            before = {} if state is None else state["buckets"][name]
            held[name] = {str(b): v for b, v in before.items() if int(b) not in touched} | {
                str(b): batch_id for b in found}
            schemas[name] = fresh.drop("bucket").schema.jsonValue()
        pointer = json.dumps({"batch": batch_id, "schemas": schemas, "buckets": held})
        self.spark.createDataFrame([(pointer,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.folder}/pointer/batch={batch_id}")
        return True


class KeyStore:
    """Keys of earlier batches, read by the buckets of the keys at hand."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], buckets: int = 256):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.keys, self.buckets = list(keys), buckets

    def fresh(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows whose key no earlier batch had, one per key: the smallest in column order."""
        others = [c for c in rows.columns if c not in self.keys]
        first = rows.groupBy(*self.keys).agg(F.min(F.struct(*others)).alias("row")).select(
            *self.keys, "row.*").select(*rows.columns)
        first = cut_lineage(first.withColumn("bucket", _bucket([F.col(k) for k in self.keys], self.buckets)))
        if batch_id == 0 or not _exists(self.spark, self.folder):
            return first
        touched = [row[0] for row in first.select("bucket").distinct().collect()]
        schema = StructType([f for f in first.schema if f.name in self.keys]).add("bucket", "integer").add("batch", "long")
        seen = self.spark.read.schema(schema).option("basePath", self.folder).parquet(self.folder).where(
            F.col("bucket").isin(touched) & (F.col("batch") < batch_id))
        return first.join(seen.select("bucket", *self.keys), ["bucket", *self.keys], "left_anti").select(
            *rows.columns, "bucket")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Remember the keys of a batch; a replay writes the same files again."""
        rows.select(*self.keys, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.folder}/batch={batch_id}")
