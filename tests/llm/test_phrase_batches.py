"""What a worker process of the phrase miner is sent at once."""

from __future__ import annotations

from sitegrade.llm import collocations as col


def test_blocks_are_sent_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, count = spark.conf.get(name), [], col.count_pairs

    def counted(relation):
        seen.append(spark.conf.get(name))
        return count(relation)

    monkeypatch.setattr(col, "count_pairs", counted)
    docs = spark.createDataFrame([("en", "a b c d. a b c")] * 3, "lang string, text string")
    found = {r.phrase: r.a for r in col.collocations(docs, least=3).collect()}
    # "a b" lies inside "a b c", which is as frequent
    assert found["a b c"] == 6 and "a b" not in found
    assert len(seen) == 3 and all(s.endswith("m") and int(s[:-1]) <= 8 for s in seen)
    assert spark.conf.get(name) == before
