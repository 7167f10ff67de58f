"""Token counts, packing and piece lattices against their libraries and brute force."""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitegrade.llm.harmonic_packing import cut_points, pack
from sitegrade.llm.piece_lattice import PieceModel, decode_documents, encode_documents
from sitegrade.llm.pieces import Pieces
from sitegrade.llm.token_counts import count_tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "\n\n \t", "It's  we'll 'tis 12345 ½², no-op!!  end ", "x" * 5000, "Ünïcödé ß Ǆ",
    "<|endoftext|> inside <|startoftext|>", "漢字 и кириллица 🙂 ﬁ ①", "a\x1cb\x85c\xa0d", "İstanbul ΑΣ",
    "é combining", "same text here", "same text here", "tab\tnew\r\nline  ", "word " * 3000,
]
_text = st.text(st.characters(codec="utf-8"), max_size=60) | st.text(
    "ab 'sßÀ² \xa0\x85\x1f.,!<|>\n\t1", max_size=60)


def rows(spark, texts=TEXTS):
    """Documents with null ids, repeated rows and columns of clashing names."""
    data = [(i if i else None, t, "n", 1) for i, t in enumerate(texts)] + [(3, texts[3], "n", 1)]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens string, start int")


@settings(max_examples=150, deadline=None)
@given(_text)
def test_pieces_equal_the_libraries(text):
    for path, lower in ((BYTES, False), (WORDS, True)):
        want = _library(path).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(_pieces(path, lower).ids([text])[0], "<u4").tolist() == want


_kept: dict = {}


def _library(path):
    return _kept.setdefault(("library", path), Tokenizer.from_file(path))


def _pieces(path, lower):
    if (path, lower) not in _kept:
        _kept[path, lower] = Pieces(path, lower, limit=50)
    return _kept[path, lower]


def test_token_counts(spark):
    library = Tokenizer.from_file(BYTES)
    df = rows(spark)
    for frequent in (None, {}):
        got = count_tokens(df, BYTES, limit=20, frequent=frequent)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        want = []
        for r in df.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 20))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert count_tokens(df.limit(0), BYTES).count() == 0


def _check_packing(df, got, capacity):
    library = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in got.collect():
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for r in df.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        pieces = sorted({tuple(p) for p in by_doc[r.doc_id]}, key=lambda p: p[1])
        at = 0
        for _, start, length, crc, total, *_ in sorted({p[:5] + (0,) for p in pieces}, key=lambda p: p[1]):
            assert start == at and total == len(ids)
            assert crc == zlib.crc32(np.array(ids[at:at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    used = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        used += at
    return used / max(1, capacity * len(by_sequence))


def test_packing_covers_every_id_once(spark):
    df = rows(spark).where("doc_id IS NOT NULL").distinct()
    for partitions, fan_in in ((1, 512), (7, 2)):
        got = pack(df.repartition(partitions), WORDS, capacity=64, fan_in=fan_in)
        assert _check_packing(df, got, 64) > 0.9
    assert pack(rows(spark), WORDS).count() >= len(TEXTS) + 1
    assert pack(df.limit(0), WORDS).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 100_000), st.integers(1, 4096), st.floats(0.5, 1.0))
def test_cut_points_fill_their_classes(n, capacity, fill):
    lengths = cut_points(n, capacity, fill)
    assert sum(lengths) == n and min(lengths) > 0
    for length in lengths:
        k = capacity // length
        assert k >= 1 and (k * length >= fill * capacity or length == capacity // k)


def _all_ways(model, text):
    """Every segmentation of a short text with its score, by trying all cuts."""
    out = []
    for n in range(len(text)):
        for cut in combinations(range(1, len(text)), n):
            parts = [text[a:b] for a, b in zip((0, *cut), (*cut, len(text)))]
            score = 0.0
            for p in parts:
                if p in model.scored:
                    score += model.scored[p][0]
                elif len(p) == 1:
                    score += model.unknown
                else:
                    break
            else:
                out.append(score)
    return sorted(out, reverse=True)


def test_n_best_equals_all_cuts():
    model = PieceModel(PIECES, n_best=6)
    for text in ("▁the", "▁reading", "ß①x", "▁▁▁a", "aaaaaaa", "▁"):
        got = [w.score for w in model.search(text, 6)]
        np.testing.assert_allclose(got, _all_ways(model, text)[:6])
    for text in ("x" * 5000, "ab c" * 5000):  # very long words full of ties
        ways = model.search(text, 6)
        assert len({w.data for w in ways}) == 6 and {model.joined(w.ids) for w in ways} == {text}
    ways, back = model.encode("the cat ran")
    np.testing.assert_allclose(
        [w.score for w in ways], _all_ways(model, "▁the▁cat▁ran")[:6])
    assert back and len({w.data for w in ways}) == 6


def test_encoding_round_trip(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = rows(spark)
    encoded = encode_documents(df, PIECES, 3, with_ids=True)
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in encoded.collect():
        assert r.decodes and list(r.scores) == sorted(r.scores, reverse=True)
        assert [len(x) for x in r.ids] == r.n_tokens
        for ids in r.ids:
            assert library.decode(list(ids)) == library.decode(library.encode(texts[r.doc_id]))
    best = encoded.selectExpr("doc_id", "ids[0] AS ids")
    model = PieceModel(PIECES)
    for r in decode_documents(best, PIECES).collect():
        assert r.text == model.library.decode(library.encode(texts[r.doc_id]))
    assert encode_documents(df.limit(0), PIECES).count() == 0
