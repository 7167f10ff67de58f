"""Fingerprints against an own reading of the method, true likeness, and the order of documents."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from sitegrade.llm.fingerprints import BINS, BITS, fingerprints, likeness, with_fingerprint
from pyspark.sql import functions as F


def documents():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 9, 40, 300])))) for i in
            rng.sample(range(-50, 500), 150)]
    rows += [(5000, "𝔘nicode 🙂 text ÄÖ\r\nof some  words\tand more"), (5001, None), (5002, ""), (5003, " \n"),
             (None, "no id at all"), (None, "no id at all"), (None, "another without"), (5004, rows[0][1]),
             (5005, "y " * 60_000), (5006, "z" * 100_000), (5007, "same row"), (5007, "same row"),
             (5007, "other text")]
    return rows


def shingles(text):
    words = re.findall("[^ \t-\r]+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def test_fingerprints(spark):
    rows = documents()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id long, text string, mark string, n int").repartition(5)
    got = fingerprints(df)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                           "near_edited", "near_next"]
    marks = dict(df.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect())
    distinct = sorted({(i, t or "") for i, t in rows},
                      key=lambda r: (r[0] is None, -(r[0] or 0), marks[r[1]]))
    edited = {}
    for at, (i, text) in enumerate(distinct):
        half = len(text) // 2
        after = distinct[(at + 1) % len(distinct)]
        edited[i, text] = text[:len(text) - half] + after[1][:half]
    want = sorted(((i, len(t or ""), hashlib.sha256(edited[i, t or ""].encode()).hexdigest())
                   for i, t in rows), key=str)
    found = got.collect()
    assert sorted((tuple(r)[:3] for r in found), key=str) == want
    by_text: dict = {}
    texts = {(i, hashlib.sha256(e.encode()).hexdigest()): (i, t) for (i, t), e in edited.items()}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len(r.fingerprint) in (0, BINS * BITS // 4)
        _, text = texts[r.doc_id, r.edited_sha256]
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        a, b = shingles(text), shingles(edited[r.doc_id, text])
        true = len(a & b) / len(a | b) if a | b else 1.0
        if len(a) > 100:
            assert abs(r.near_edited - true) < 0.2, (true, r.near_edited)
    assert fingerprints(df.limit(0)).count() == 0
    one = fingerprints(df.where("doc_id = 5000")).first()
    assert one.near_next == 1.0


@pytest.mark.parametrize("bits", [4, 8])
def test_likeness_is_unbiased(spark, bits):
    rng = random.Random(1)
    rows = []
    for k in range(300):
        n, common = rng.choice([20, 60, 500]), 0.5
        base = [f"a{rng.random()}" for _ in range(n)]
        cut = int(n * common)
        other = base[:cut] + [f"b{rng.random()}" for _ in range(n - cut)]
        a, b = shingles(" ".join(base)), shingles(" ".join(other))
        rows.append((" ".join(base), " ".join(other), len(a & b) / len(a | b)))
    df = spark.createDataFrame(rows, "a string, b string, true double")
    df = with_fingerprint(with_fingerprint(df, "a", "fa", bits=bits), "b", "fb", bits=bits)
    error, spread = df.select((likeness(F.col("fa"), F.col("fb"), bits=bits) - F.col("true")).alias("e")).agg(
        F.avg("e"), F.stddev("e")).first()
    assert abs(error) < 0.02 and spread < 0.09


def test_empty_bins_take_filled_ones_uniformly(spark):
    """An own reading of the method in plain Python, from the hashes Spark gives."""
    text = "one two three four five six seven eight nine"
    hashes = spark.range(1).select(F.array(*(
        F.xxhash64(*(F.lit(w) for w in text.split()[i:i + 5])) for i in range(5)))).first()[0]
    order = {}
    for r in spark.range(BINS).alias("i").crossJoin(spark.range(BINS).withColumnRenamed("id", "j")).select(
            "id", "j", F.xxhash64("id", "j").alias("h")).collect():
        order[r.id, r.j] = r.h
    filled: dict = {}
    for h in hashes:
        b = (h >> 57) + BINS // 2
        filled[b] = min(h, filled.get(b, h))
    code = ""
    for i in range(BINS):
        at = i if i in filled else min(filled, key=lambda j: order[i, j])
        code += f"{filled[at] & 255:02x}"
    df = with_fingerprint(spark.createDataFrame([(text.upper(),)], "t string"), "t", "f")
    assert df.first().f == code
    assert len({code[k:k + 2] for k in range(0, len(code), 2)}) == len(filled)
