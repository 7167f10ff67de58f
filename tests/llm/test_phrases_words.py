"""Collocations and spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from oracle import compare, connect
from sitegrade.llm import collocations as co
from sitegrade.llm.collocations import collocations
from sitegrade.llm.queries import ORACLES, QUERIES
from sitegrade.llm.spelling import signatures, spelling_variants

SF_DIR = "/root/testdata/sf0.001"


def brute_phrases(rows, least, reported):
    f: dict = {}
    for lang, text in rows:
        counts = f.setdefault("und" if lang is None else lang, Counter())
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                counts.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(a for g, a in counts.items() if len(g) == 1)
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        covered = {g[i:i + m] for g, a in candidates.items() for m in range(2, len(g))
                   for i in range(len(g) - m + 1) if 100 * a >= 80 * counts[g[i:i + m]]}
        found = []
        for g, a in candidates.items():
            if g not in covered:
                score, _, left, right = min(
                    (2_000_000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]])
                    for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:reported], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta,", "eps", "zeta.", "éta", "theta\tiota", "k\x0bl", "x\x1cy", "Ö"]
    rows = [(rng.choice(["en", "de", None, "a\nb", "und"]),
             " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for _ in range(120)]
    return rows + [("en", None), ("en", ""), ("en", " \t"), ("xx", "one"), ("en", "same words here " * 400),
                   ("en", "same words here " * 400), ("de", "a" * 100_000)]


@pytest.mark.parametrize("sent", [co.SENT, 0])
def test_collocations(spark, sent, monkeypatch):
    rows = phrase_rows()
    df = spark.createDataFrame(
        [(lang, text, 1, "x") for lang, text in rows], "lang string, text string, a int, label string")
    monkeypatch.setattr(co, "BLOCK", 300)
    for least, reported in ((3, 50), (1, 7)):
        got = sorted(map(tuple, collocations(df.repartition(3), least=least, reported=reported,
                                             sent=sent).collect()))
        assert got == brute_phrases(rows, least, reported)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations(empty).count() == 0
    assert collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0


def test_wide_numbers_count_like_narrow_ones():
    import numpy as np

    left = np.array([5, 1, 5, 1, 2], np.int64)
    right = np.array([1, 2, 1, 3, 2], np.int64)
    narrow = co.runs(left, right)
    wide = co.runs(left + 2**40, right)
    assert narrow[0].tolist() == (wide[0] - 2**40).tolist() == [1, 1, 2, 5]
    for a, b in zip(narrow[1:], wide[1:], strict=True):
        assert a.tolist() == b.tolist()


def brute_words(rows, times):
    n: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    n = Counter({w: k for w, k in n.items() if len(w) >= 6 and k >= times})

    def edits(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: [v for v in n if v != w and edits(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def test_spelling_variants(spark):
    rng = random.Random(11)
    base = ["letters", "brother", "another", "être-réalité", "Straße", "moonlit", "ßüöäéèà", "aaaaaaaa"]
    rows = []
    for doc in range(300):
        words = []
        for _ in range(rng.randrange(40)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w[at:at + rng.randrange(2)] = rng.choice(["", "e", "t", "é"])
            words.append("".join(w))
        rows.append((doc, rng.choice(" .\n-").join(words)))
    # chains of forms: 2, 10, 50 and 250 times
    for word, k in (("chainab", 2), ("chainabc", 10), ("chainabcd", 50), ("chainabcde", 250)):
        rows.append((1000, " ".join([word] * k)))
    rows += [(None, "letters lettrs"), (None, "letters lettrs"), (5, None), (6, ""), (7, "x" * 50_000),
             (7, "x" * 50_000), (8, "x" * 49_999 + " " + "x" * 49_999)]
    df = spark.createDataFrame([(d, t, 1, "w") for d, t in rows], "doc_id long, text string, n int, word string")
    got = spelling_variants(df.repartition(3), times=2)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_words(rows, 2)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)
    assert sorted(map(tuple, got.collect())) == want
    assert spelling_variants(df.limit(0)).count() == 0


def test_one_edit_always_shares_a_signature():
    rng = random.Random(3)
    for _ in range(3000):
        word = "".join(rng.choice("abcdeéz") for _ in range(rng.randrange(6, 12)))
        at = rng.randrange(len(word) + 1)
        other = word[:at] + rng.choice("abzé") + word[at + rng.randrange(2):]
        if other != word:
            assert set(signatures(word)) & set(signatures(other))


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_spelling_variants"])
def test_query_equals_its_twin(spark, name):
    assert not compare(QUERIES[name](spark, SF_DIR), ORACLES[name], connect(SF_DIR))
