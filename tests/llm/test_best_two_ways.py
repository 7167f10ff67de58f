"""The best way to cut a word and its gap to the second, found without a search."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pytest

from sitegrade.llm.piece_lattice import _BARE_WORDS, PieceModel, _smallest


@pytest.fixture(scope="module")
def model():
    return PieceModel(public_tokenizers.path("piece_bpe_32k.model"))


def _texts() -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choices("▁aeinrst.,é漢\n1$", k=rng.randint(1, 14))) for _ in range(400)]


def test_the_first_two_equal_those_of_the_search(model):
    for text in _texts():
        ways = model.search(text, 2)
        gap = ways[0].score - ways[1].score if len(ways) > 1 else float("inf")
        assert model.best(text) == (ways[0].data, ways[0].score, gap)


def test_new_words_need_no_search(model, monkeypatch):
    searched = []
    monkeypatch.setattr(model, "search", lambda *a: searched.append(a))
    ways, back = model.encode("unheardof words, each of them xqzv new", n=1)
    assert back and len(ways) == 1 and not searched


def test_words_are_cut_as_by_the_plain_pattern():
    letter = "A-Za-zÀ-ÖØ-öø-ɏ"
    plain = re.compile(f"▁*[^▁.,]*[{letter}](?=[.,])|▁+[^▁]*|[^▁]+")
    for text in ["", *_texts()]:
        assert _BARE_WORDS.findall(text) == plain.findall(text)


def test_smallest_places_keep_their_order():
    rng = random.Random(6)
    for size in range(1, 40):
        values = tuple(rng.choice([0.0, 1.0, 2.0, float("inf")]) for _ in range(size))
        for n in range(5):
            assert _smallest(values, n) == sorted(range(size), key=values.__getitem__)[:n]
