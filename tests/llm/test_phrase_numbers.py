"""The numbers of frequent groups reach their blocks row by row, not as one list a block."""

from __future__ import annotations

from sitegrade.llm import collocations as co


def _documents(spark):
    rows = [(i, "en" if i % 3 else "de", "red fox runs. red fox sleeps, grey owl " * (i % 5 + 1)) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def test_joined_numbers_are_not_gathered(spark, tmp_path):
    blocks = co.word_blocks(_documents(spark), "lang", "text")
    words = co.numbered(co.count_words(blocks).where("a >= 30"), str(tmp_path / "words"))
    joined = co.keep_words(blocks, words, 0)
    assert "collect_list" not in joined._jdf.queryExecution().executedPlan().toString()
    sent = co.keep_words(blocks, words)
    a, b = (sorted((r.block, bytes(r.steps), bytes(r.groups)) for r in df.collect()) for df in (joined, sent))
    assert a and a == b


def test_few_bytes_of_words_are_sent_to_each_worker():
    assert co._SENT_BYTES <= 4 << 20
