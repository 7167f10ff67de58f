"""Interval ranks, stored tables under replacement, seen keys, and the gated freeze."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sitegrade.operators import distribution as dist
from sitegrade.operators.intervals import INTERVALS, interval_index, interval_of, rank_by_interval
from sitegrade.session import cut_lineage
from sitegrade.streaming.store import EntryStore, KeyStore

INPUTS = "entry_id string, metal_site_id string, rszd_abs double, geometry_rms_zbond double"


def _inputs(spark, values):
    rows = [(f"e{i % 5}", f"s{i}", d, g) for i, (d, g) in enumerate(values)]
    return spark.createDataFrame(rows, INPUTS)


def test_interval_ranks_equal_rebuilt_ranks(spark):
    rng = random.Random(4)

    def value():
        return rng.choice([None, float("nan"), -1.0, 0.0, 0.0005, 31.999, 32.768, 32.769, 1e9,
                           rng.random() * 5, rng.random() * 100, 10 ** rng.uniform(-4, 7)])

    cohort = _inputs(spark, [(value(), value()) for _ in range(3000)])
    asked = _inputs(spark, [(value(), value()) for _ in range(800)])
    frozen = dist.value_histogram(cohort)
    index = interval_index(frozen)
    assert index.groupBy("component").count().collect()[0]["count"] == INTERVALS
    got = rank_by_interval(asked, index)
    want = dist.rank_against(asked, frozen)
    columns = ["metal_site_id", "density_rank", "geometry_rank"]
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(
        map(tuple, want.select(columns).collect()), key=str)
    assert rank_by_interval(asked, interval_index(frozen.limit(0))).where("density_rank IS NOT NULL").count() == 0


def test_intervals_are_in_order(spark):
    values = sorted({0, 1, 31, 32, 2**15 - 1, 2**15, 2**15 + 63, 2**15 + 64, 2**40, 2**62, 2**63 - 1})
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in df.orderBy("v").select(interval_of(F.col("v"))).collect()]
    assert got == sorted(got) and got[0] == 0 and got[-1] == INTERVALS - 1


def _entries(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "entry_id string")


def test_entry_store_replaces_in_all_tables_and_skips_replays(spark, tmp_path):
    store = EntryStore(spark, str(tmp_path), ("a", "b"), buckets=4)
    with pytest.raises(ValueError, match="nothing was stored"):
        store.read("a")

    def rows(version, ids, n=2):
        return spark.createDataFrame([(i, k, version) for i in ids for k in range(n)], "entry_id string, k int, v int")

    ids = [f"e{i}" for i in range(20)]
    assert store.commit({"a": rows(0, ids), "b": rows(0, ids, 1)}, _entries(spark, ids), 0)
    # e3 loses its rows in b, e4 is staged but not replaced, E5 is the same entry in another case
    changed = ["e3", "E5", "new"]
    assert store.commit({"a": rows(1, [*changed, "e4"]), "b": rows(1, ["E5"], 3)}, _entries(spark, changed), 1)
    assert not store.commit({"a": rows(9, ids), "b": rows(9, ids)}, _entries(spark, ids), 1)
    again = EntryStore(spark, str(tmp_path), ("a", "b"), buckets=4)
    a = {(r.entry_id, r.k): r.v for r in again.read("a").collect()}
    assert len(a) == 42 and {k[0] for k, v in a.items() if v == 1} == {"e3", "E5", "new"}
    b = sorted((r.entry_id, r.v) for r in again.read("b").collect())
    assert len(b) == 18 + 3 and ("e3", 0) not in b and b.count(("E5", 1)) == 3
    # a batch that died before its pointer is not seen
    (tmp_path / "pointer" / "batch=2").mkdir()
    assert again.read("a").count() == 42
    assert store.commit({"a": rows(2, []), "b": rows(2, [])}, _entries(spark, ids + ["new"]), 2)
    assert again.read("a").count() == 0 and again.read("b").count() == 0
    with pytest.raises(ValueError, match="all of"):
        store.commit({"a": rows(3, ids)}, _entries(spark, ids), 3)


def test_key_store_keeps_the_smallest_row_and_earlier_batches(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), ["k"], buckets=8)
    batches = [[("a", 2), ("a", 1), (None, 5), ("b", 7)], [("a", 0), ("c", 4), (None, 1)], [("c", 1), ("d", 2), ("d", 2)]]
    got = []
    for number, rows in enumerate([*batches, batches[2]]):
        number = min(number, 2)  # the last batch is replayed
        fresh = store.fresh(spark.createDataFrame(rows, "k string, v int"), number)
        got.append(sorted(((r.k, r.v) for r in fresh.collect()), key=str))
        store.add(fresh, number)
    assert got == [[("a", 1), ("b", 7), (None, 5)], [("c", 4), (None, 1)], [("d", 2)], [("d", 2)]]


def test_a_batch_of_the_scorer_builds_no_histogram(spark):
    frozen = dist.value_histogram(_inputs(spark, [(1.0, 2.0), (3.0, None)]))
    index = cut_lineage(interval_index(frozen))
    plan = rank_by_interval(_inputs(spark, [(1.5, 2.0)]), index)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan and "Window" not in plan
