"""Toxicity scores from a linear-chain conditional random field over words.

Only documents are labelled, so token labels come first: a word form (or one of
its prefixes, which stand for a stem) counts as toxic where its appearance in
toxic training documents is too frequent to be chance. The field is trained on
those token labels by exact forward-backward gradients, on a bounded sample.
Scoring runs forward-backward over every whole text; the marginals give the
offending offsets and, through a logistic layer, the document score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import map_batches
from sitegrade.llm.near_duplicates import WordHashes, shingle_set, signature

PREFIXES = (4, 5, 6)
BUCKETS = 1 << 18
THRESHOLD = 0.3
_EDGES = ".,;:!?\"'()[]{}«»„“”¿¡…-"
_WORD = re.compile(r"\S+")


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample, whatever the size of the corpus."""

    toxic_documents: int = 1500
    clean_documents: int = 3000
    longest_text: int = 12_000  # characters; longer texts do not train, they are only scored
    field_documents: int = 400  # of each label, for the field itself; forms they lack come on top
    field_words: int = 800  # longer texts train by windows of at most so many words
    rounds: int = 40
    refits: int = 2  # further fits, each with the clean texts the last one is unsure of


@dataclass(frozen=True)
class Model:
    """Trained parameters; a fixed size of about 1 MB."""

    weights: np.ndarray  # emission weight of label 1, by feature bucket
    transitions: np.ndarray  # 2 x 2, from label to label
    start: float
    layer: tuple[float, ...]  # bias and weights of the document layer


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold no label is learnt from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def forms(token: str) -> list[str]:
    """The word form of a token and its prefixes."""
    word = token.strip(_EDGES).lower()
    return [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]


def _buckets(token: str) -> list[int]:
    return [0, *(1 + zlib.crc32(f.encode()) % (BUCKETS - 1) for f in forms(token))]


def one_of_each(texts: list[str]) -> list[str]:
    """One text of each family of near copies, whose words repeat by no chance.

    Texts are of one family if they share two neighbouring minhashes.
    """
    hashes = WordHashes()
    hashes.limit = 50_000
    seen: set[tuple[int, bytes]] = set()
    kept = []
    for text in texts:
        shingles = shingle_set(text, hashes)
        if len(shingles):
            marks = signature(shingles, 12).reshape(-1, 2)
            keys = {(i, m.tobytes()) for i, m in enumerate(marks)}
            if seen.isdisjoint(keys):
                kept.append(text)
            seen |= keys
    return kept


def form_hashes(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the forms of a text."""
    return np.unique(np.array(
        [xxhash.xxh3_64_intdigest(f) for word in set(text.split()) for f in forms(word)], np.uint64))


def toxic_forms(toxic: list[str], clean: list[str]) -> set[int]:
    """Hashes of forms whose share of toxic documents is significant after testing all.

    Only forms of two toxic documents or more are kept and counted on.
    """
    if not toxic:
        return set()
    values, k = np.unique(np.concatenate([form_hashes(t) for t in toxic]), return_counts=True)
    values, k = values[k > 1], k[k > 1]
    if not len(values):
        return set()
    n = k.copy()
    for text in clean:
        hashes = form_hashes(text)
        at = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
        n[at[values[at] == hashes]] += 1
    base = min(max(len(toxic) / (len(toxic) + len(clean)), 1e-9), 1 - 1e-9)
    p = k / n
    with np.errstate(divide="ignore", invalid="ignore"):
        divergence = p * np.log(p / base) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - base)), 0.0)
    # Chernoff bound of k or more toxic ones among n documents by chance
    sure = ((k + 0.5) / (n + 1) > 0.8) & (n * divergence > math.log(100 * len(values)))
    return set(values[sure].tolist())


def marked_forms(token: str, found: set[int]) -> set[int]:
    """The toxic ones among the forms of a token."""
    return found.intersection(map(xxhash.xxh3_64_intdigest, forms(token)))


def forward_backward(
    emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward odds and label-1 marginals of padded (time, text) columns.

    Columns are ordered by falling length, so each step works on the texts that
    are still running. Messages are kept as odds of label 1 against label 0.
    """
    t = np.exp(transitions)
    e = np.exp(np.clip(emissions, -30, 30))
    steps, texts = e.shape
    running = np.searchsorted(-lengths, -np.arange(steps), side="left")  # texts longer than step
    ahead = np.ones((steps, texts))
    back = np.ones((steps, texts))
    odds = np.full(texts, math.exp(start)) * e[0]
    ahead[0] = odds
    for i in range(1, steps):
        n = running[i]
        odds = e[i, :n] * (t[0, 1] + t[1, 1] * odds[:n]) / (t[0, 0] + t[1, 0] * odds[:n])
        ahead[i, :n] = odds
    for i in range(steps - 2, -1, -1):
        n = running[i + 1]
        later = e[i + 1, :n] * back[i + 1, :n]
        back[i, :n] = (t[1, 0] + t[1, 1] * later) / (t[0, 0] + t[0, 1] * later)
    both = ahead * back
    return ahead, back, both / (1 + both)


def _columns(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Padded (time, text) array of sequences ordered by falling length, and lengths."""
    lengths = np.array([len(v) for v in values])
    out = np.zeros((max(1, lengths.max()), len(values)), values[0].dtype)
    for i, v in enumerate(values):
        out[:len(v), i] = v
    return out, lengths


def train_field(
    texts: list[list[str]], labels: list[np.ndarray], rounds: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, transitions and start score by AdaGrad on the exact likelihood."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    width = 2 + len(PREFIXES)
    padded = BUCKETS  # a bucket whose weight stays zero
    memo: dict[str, list[int]] = {}

    def row(token: str) -> list[int]:
        if token not in memo:
            found = _buckets(token)
            memo[token] = found + [padded] * (width - len(found))
        return memo[token]

    y, lengths = _columns([labels[i].astype(np.float64) for i in order])
    steps, n = y.shape
    inside = np.arange(steps)[:, None] < lengths[None, :]
    pair = inside[1:]
    # one row of buckets per word, text after text, as `inside.T` lists them
    features = np.array([row(w) for i in order for w in texts[i]])
    flat = features.reshape(-1)
    emissions = np.zeros((n, steps))
    weights, transitions, start = np.zeros(BUCKETS + 1), np.zeros((2, 2)), 0.0
    sums = [np.full(BUCKETS + 1, 1e-6), np.full((2, 2), 1e-6), 1e-6]
    for _ in range(rounds):
        emissions[inside.T] = weights[features].sum(axis=1)
        e = emissions.T
        ahead, back, p = forward_backward(e, lengths, transitions, start)
        gap = np.where(inside, y - p, 0.0)
        g_weights = np.bincount(flat, np.repeat(gap.T[inside.T], width), BUCKETS + 1)
        g_weights -= 0.02 * weights
        g_weights[padded] = 0
        later = np.exp(np.clip(e[1:], -30, 30)) * back[1:]
        t = np.exp(transitions)
        joint = np.stack([
            np.stack([t[0, 0] + 0 * later, t[0, 1] * later]),
            np.stack([t[1, 0] * ahead[:-1], t[1, 1] * ahead[:-1] * later])])
        joint /= joint.sum(axis=(0, 1))
        g_transitions = np.empty((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                seen = (y[:-1] == a) & (y[1:] == b)
                g_transitions[a, b] = np.where(pair, seen - joint[a, b], 0).sum()
        g_start = gap[0].sum()
        for k, g in enumerate((g_weights, g_transitions, g_start)):
            sums[k] = sums[k] + g * g
        weights = weights + 0.5 * g_weights / np.sqrt(sums[0])
        transitions = np.clip(transitions + 0.2 * g_transitions / np.sqrt(sums[1]), -8, 8)
        start = float(np.clip(start + 0.2 * g_start / math.sqrt(sums[2]), -8, 8))
    return weights[:BUCKETS].astype(np.float32), transitions, start


class Scorer:
    """Applies a model to texts; word emissions are remembered up to a bound."""

    def __init__(self, model: Model, limit: int = 500_000):
        self.model = model

        class Emissions(dict):
            def __missing__(self, token: str) -> float:
                if len(self) > limit:
                    self.clear()
                value = self[token] = float(model.weights[_buckets(token)].sum())
                return value

        self.emissions = Emissions()

    def marginals(self, texts: list[str], group: int = 64) -> list[np.ndarray]:
        """Label-1 marginals of every word of every whole text."""
        at = self.emissions.__getitem__
        values = []
        for text in texts:
            words = text.split()
            values.append(np.fromiter(map(at, words), np.float64, len(words)))
        order = sorted(range(len(values)), key=lambda i: -len(values[i]))
        out: list[np.ndarray] = [np.zeros(0)] * len(values)
        for low in range(0, len(order), group):
            some = [i for i in order[low:low + group] if len(values[i])]
            if some:
                columns, lengths = _columns([values[i] for i in some])
                _, _, p = forward_backward(
                    columns, lengths, self.model.transitions, self.model.start)
                for j, i in enumerate(some):
                    out[i] = p[:lengths[j], j]
        return out

    def features(self, p: np.ndarray) -> np.ndarray:
        """Document features of the marginals: most certain word, expected count."""
        if not len(p):
            return np.zeros(3)
        return np.array([1.0, p.max(), math.log1p(p.sum())])

    def score(self, p: np.ndarray) -> float:
        x = self.features(p)
        x[0] = 1.0
        return float(1 / (1 + math.exp(-float(np.dot(x, self.model.layer)))))

    def spans(self, text: str, p: np.ndarray) -> list[dict]:
        """Code point offsets of runs of words with a marginal of one half or more."""
        if not len(p) or p.max() < 0.5:
            return []
        found: list[dict] = []
        last = -2
        for i, m in enumerate(_WORD.finditer(text)):
            if p[i] >= 0.5:
                if last == i - 1:
                    found[-1]["end"] = m.end()
                else:
                    found.append({"start": m.start(), "end": m.end()})
                last = i
        return found


def _train_layer(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic layer by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - 0.05 * w)
    return tuple(w.tolist())


def _windows(at: list[int], count: int, longest: int) -> list[slice]:
    """Windows of 50 words either side of the places ``at``; none overlap or exceed ``longest``."""
    runs: list[list[int]] = []
    for i in at:
        low, high = max(0, i - 50), min(count, i + 51)
        if runs and low <= runs[-1][1]:
            runs[-1][1] = high
        else:
            runs.append([low, high])
    return [slice(i, min(i + longest, high)) for low, high in runs for i in range(low, high, longest)]


def field_texts(
    rows: list, found: set[int], sample: Sample
) -> tuple[list[list[str]], list[np.ndarray], list[list[str]]]:
    """Words and marks of toxic texts, and words of clean ones, to train the field on.

    The first texts of each label are taken in the order of ``rows``. A toxic
    text that is too long gives the windows around its marked words, a clean one
    a window at a place told by its hash. Later toxic texts give the windows
    around the marked forms that those before them lack, so no form is left out.
    """
    memo: dict[str, set[int]] = {}
    bad, marks, good = [], [], []
    covered: set[int] = set()
    texts = 0
    for r in rows:
        words = r["text"].split()
        if not words:
            continue
        if r["y"] != 1:
            if len(good) < sample.field_documents:
                room = max(0, len(words) - sample.field_words)
                at = zlib.crc32(r["text"].encode("utf-8", "surrogatepass")) % (room + 1)
                good.append(words[at:at + sample.field_words])
            continue
        for w in words:
            if w not in memo:
                memo[w] = marked_forms(w, found)
        first = texts < sample.field_documents
        if first and len(words) <= sample.field_words:
            parts = [slice(0, len(words))]
        else:
            places = []
            known = set() if first else set(covered)
            for i, w in enumerate(words):
                if memo[w] - known:
                    places.append(i)
                    if not first:
                        known |= memo[w]
            parts = _windows(places, len(words), sample.field_words)
        texts += bool(parts)
        for part in parts:
            some = words[part]
            bad.append(some)
            marks.append(np.array([bool(memo[w]) for w in some]))
            covered.update(*(memo[w] for w in some))
    return bad, marks, good


def train(
    documents: DataFrame, labels: DataFrame, sample: Sample = Sample(),
    doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Model:
    """Fit the model on a bounded sample of labelled rows outside the held-out fold.

    Rows are chosen by the order of a hash of doc_id, per label. Without any
    toxic sample the model scores everything near zero.
    """
    marked = (
        labels.where(F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("y"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    chosen = marked.where("y = 1").orderBy("order").limit(sample.toxic_documents).unionByName(
        marked.where("y = 0").orderBy("order").limit(sample.clean_documents))
    rows = (
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .where(F.length("text") <= sample.longest_text)
        .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
        .dropDuplicates(["doc_id"]).withColumn("order", F.xxhash64("doc_id")).collect()
    )
    # by the order that chose them, which no source or language follows
    rows.sort(key=lambda r: (r["order"], r["doc_id"]))
    found = toxic_forms(*(one_of_each([r["text"] for r in rows if r["y"] == y]) for y in (1, 0)))
    if not found:
        return Model(np.zeros(BUCKETS, np.float32), np.zeros((2, 2)), -8.0, (-4.0, 0.0, 0.0))
    bad, marks, good = field_texts(rows, found, sample)
    for fit in range(sample.refits + 1):
        weights, transitions, start = train_field(
            bad + good, marks + [np.zeros(len(w), bool) for w in good], sample.rounds)
        scorer = Scorer(Model(weights, transitions, start, (0.0, 0.0, 0.0)), limit=100_000)
        p = scorer.marginals([r["text"] for r in rows])
        if fit == sample.refits:
            break
        # texts of the clean sample, of any length, around the words it is unsure of
        doubt = []
        for r, q in zip(rows, p, strict=True):
            if r["y"] == 0 and len(q) and q.max() > 0.05:
                at, words = int(q.argmax()), r["text"].split()
                doubt.append((float(q.max()), words[max(0, at - 50):at + 50]))
        if not doubt:
            break
        doubt.sort(key=lambda d: -d[0])
        good = good + [w for _, w in doubt[:sample.field_documents]]
    x = np.array([scorer.features(q) for q in p])
    y = np.array([float(r["y"]) for r in rows])
    x[:, 0] = 1.0
    return Model(weights, transitions, start, _train_layer(x, y))


def score_documents(
    documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, spans.

    Whole texts are scored; a null or empty text has no words and takes the
    layer's bias as its score. Repeated rows are scored each. The columns named
    in ``carry`` come along with each row, others are ignored; a carried column
    of the name of a result is refused. ``spans`` holds code point offsets of
    toxic runs.
    """
    clash = {"doc_id", "held_out", "score", "predicted", "spans"} & set(carry)
    if clash:
        raise ValueError(f"carried columns have names of results: {sorted(clash)}")
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)

        def step(batch: pa.RecordBatch) -> dict:
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            p = scorer.marginals(texts)
            return {
                **{name: batch.column(name) for name in carry},
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "score": (scores := [scorer.score(x) for x in p]),
                "predicted": [int(s >= THRESHOLD) for s in scores],
                "spans": [scorer.spans(t, x) for t, x in zip(texts, p, strict=True)],
            }

        return step

    return map_batches(
        documents.select(
            F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"),
            F.coalesce(held_out(F.col(doc_id)), F.lit(False)).alias("held_out"), *carry),
        make, f"doc_id {kinds[doc_id]}, held_out boolean, score double, predicted int, "
        "spans array<struct<start: int, end: int>>"
        + "".join(f", `{name}` {kinds[name]}" for name in carry))


def toxicity(documents: DataFrame, labels: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Train on the labelled rows and score all documents."""
    return score_documents(documents, train(documents, labels), carry=carry)
