"""How large the plan of the phrase miner's result is."""

from __future__ import annotations

from sitegrade.llm import collocations as col


def test_each_length_is_described_once(spark):
    docs = spark.createDataFrame([("en", "a b c d e")] * 3 + [("en", "x a b")], "lang string, text string")
    rows = col.collocations(docs, least=3)
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    # three lengths of phrases, two of them read again for what they cover, and the sums
    assert leaves <= 8
    assert {(r.phrase, r.a, r.l, r.r) for r in rows.collect()} == {
        ("a b", 4, 4, 4), ("a b c d", 3, 4, 3), ("b c d e", 3, 4, 3)}
