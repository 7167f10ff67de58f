"""Secret scans in SQL functions: fixed patterns, and character Markov models.

Positions come from one cut per pattern: the pieces between matches and the
matches themselves alternate, so running lengths, summed in blocks, give code
point offsets, and values are the matches as they were cut. Runs
of secret-like characters that no fixed pattern covers are scored by the
log-likelihood ratio of two first-order character models, one of random strings
and one of ordinary identifiers, both counted from labelled samples.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, their kinds in order, and least lengths.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA and more, 20 characters at least
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_VALUE = 6
#: Characters of candidate runs; the models know each of them and "any other".
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
RUN = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{8,}"
_SIDE = len(ALPHABET) + 1
_MATCH = "array<struct<start:int,kind:int,end:int,found:string>>"
#: Numbers, or spans, that are handled as one block; code points of a page.
_BLOCK = 128
_PAGE = 4096


@dataclass(frozen=True)
class Settings:
    """Training bound and decision of the Markov scan."""

    sample_documents: int = 20_000  # documents whose strings are the labelled sample
    smoothing: float = 0.5  # count added to each pair of characters
    least_ratio: float = 9.0  # natural log of the odds a run must reach
    least_mean: float = 0.4  # and its mean for a pair of characters


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For every number of an array, all earlier ones merged (a sum, or a maximum; 0 at first).

    Arrays grow by appending within blocks of ``_BLOCK`` numbers and over the
    totals of blocks only, so the copies stay in proportion for long arrays.
    """
    none = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("seen"))

    def add(acc: Column, value: Column) -> Column:
        return F.struct(merge(acc["total"], value).alias("total"),
                        F.concat(acc["seen"], F.array(acc["total"])).alias("seen"))

    def of(held: Column) -> Column:
        count = F.floor((F.greatest(F.size(held), F.lit(1)) - 1) / _BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count), lambda b: F.aggregate(
            F.slice(held, b * _BLOCK + 1, F.lit(_BLOCK)), none, add))
        return _let(blocks, lambda bs: _let(
            F.aggregate(F.transform(bs, lambda b: b["total"]), none, add, lambda acc: acc["seen"]),
            lambda starts: F.flatten(F.transform(bs, lambda b, i: F.transform(
                b["seen"], lambda x: merge(F.get(starts, i), x))))))

    return _let(values, of)


def _matches(text: Column, pattern: str, kind: int, value: bool = False) -> Column:
    """Leftmost non-overlapping matches (start, kind, end, found); short values are dropped."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if value else whole
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("lead"), whole.alias("whole"),
        F.transform(kept, F.length).alias("kept"))

    def placed(ps: Column) -> Column:
        steps = F.transform(ps, lambda p: p["lead"] + F.coalesce(F.length(p["whole"]), F.lit(0)))
        return F.transform(
            F.arrays_zip(ps.alias("p"), _before(steps, lambda a, b: a + b).alias("at")),
            lambda z: F.struct(
                (z["at"] + z["p"]["lead"]).alias("start"), F.lit(kind).alias("kind"),
                (z["at"] + z["p"]["lead"] + F.length(z["p"]["whole"])).alias("end"),
                z["p"]["whole"].alias("found"), z["p"]["kept"].alias("kept")))

    # the last lead has no match
    found = F.filter(_let(parts, placed), lambda m: m["kept"] >= (ASSIGN_VALUE if value else 1))
    matches = F.transform(found, lambda m: F.struct(
        *(m[name].alias(name) for name in ("start", "kind", "end", "found"))))
    return F.when(text.rlike(pattern), matches).otherwise(F.array().cast(_MATCH))


def _spans(matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(
        *(m[name].alias(name) for name in ("start", "kind", "end"))))


def base_matches(documents: DataFrame) -> DataFrame:
    """Add ``matches``: the matches of the fixed patterns, by start and kind."""
    text = F.col("text")
    return documents.withColumn("matches", F.array_sort(F.concat(
        _matches(text, ASSIGN, 0, value=True), _matches(text, ACCESS, 1), _matches(text, HEX, 2))))


def labelled_samples(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(value, random): strings of a bounded sample of documents, labelled.

    Values that fixed patterns prove to be secrets are random strings; runs of
    eight and more characters of the same texts outside them are ordinary ones.
    """
    documents = documents.select("doc_id", "text")
    chosen = (
        documents.select("doc_id").where("doc_id IS NOT NULL").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_documents))
    rows = base_matches(documents.join(F.broadcast(chosen), "doc_id", "left_semi"))
    secret = rows.select(F.explode(F.transform("matches", lambda m: m["found"])).alias("value"))
    last = F.regexp_extract("value", r"([A-Za-z0-9+/_=-]+)$", 1)
    bare = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    plain = rows.select(
        F.explode(F.regexp_extract_all(bare, F.lit(ORDINARY), F.lit(0))).alias("value"))
    return secret.select(last.alias("value"), F.lit(True).alias("random")).unionByName(
        plain.select("value", F.lit(False).alias("random")))


def _codes(value: Column) -> Column:
    """The alphabet places of a string's characters; 0 for any other character."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def train(samples: DataFrame, settings: Settings = Settings()) -> list[float]:
    """The table of log-likelihood ratios by pair of characters: (68 + 1)^2 numbers.

    Pair counts are aggregated in Spark; only the bounded table reaches the driver.
    """
    codes = samples.where(F.length("value") > 1).select("random", _codes(F.col("value")).alias("c"))
    pairs = codes.select("random", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("c") - 2),
        lambda i: F.col("c")[i] * _SIDE + F.col("c")[i + 1])).alias("pair"))
    counted = pairs.groupBy("pair").agg(
        F.count_if("random").alias("r"), F.count_if(~F.col("random")).alias("o")).collect()
    seen = {row["pair"]: (row["r"], row["o"]) for row in counted}
    first = [[0, 0] for _ in range(_SIDE)]
    second = [[0, 0] for _ in range(_SIDE)]
    for pair, n in seen.items():
        for k in (0, 1):
            first[pair // _SIDE][k] += n[k]
            second[pair % _SIDE][k] += n[k]
    a, table = settings.smoothing, []
    every = [sum(row[k] for row in second) for k in (0, 1)]
    # an unseen pair falls back on how common its second character is
    alone = [[(row[k] + a) / (every[k] + a * _SIDE) for k in (0, 1)] for row in second]
    for pair in range(_SIDE * _SIDE):
        n, total = seen.get(pair, (0, 0)), first[pair // _SIDE]
        p = [(n[k] + a * _SIDE * alone[pair % _SIDE][k]) / (total[k] + a * _SIDE) for k in (0, 1)]
        table.append(log(p[0] / p[1]))
    return table


def _ratio(value: Column, table: Column) -> Column:
    codes = _codes(value)
    return F.aggregate(
        F.sequence(F.lit(0), F.length(value) - 2), F.struct(F.lit(0.0).alias("sum"), codes.alias("c")),
        lambda acc, i: F.struct(
            (acc["sum"] + table[acc["c"][i] * _SIDE + acc["c"][i + 1]]).alias("sum"),
            acc["c"].alias("c")),
        lambda acc: acc["sum"])


def find_secrets(
    documents: DataFrame, table: list[float], settings: Settings = Settings()
) -> DataFrame:
    """Input columns with ``base`` and ``markov``: spans (start, kind, end).

    Offsets are code points of the whole text, end exclusive. A null text is
    empty and has no spans; repeated rows keep their own results. Input columns
    of the names base, markov, runs and matches are replaced or dropped.
    """
    ratios = F.split(F.lit(",".join(f"{x:.6g}" for x in table)), ",").cast("array<double>")
    rows = base_matches(documents.withColumn("text", F.coalesce("text", F.lit(""))))

    def random_run(run: Column) -> Column:
        score = _ratio(run["found"], ratios)
        return (score >= settings.least_ratio) & (
            score >= settings.least_mean * (run["end"] - run["start"] - 1))

    def apart(blocks: Column) -> Callable[[Column], Column]:
        def meets(run: Column) -> Callable[[Column], Column]:
            return lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])

        return lambda run: ~F.exists(blocks, lambda block: meets(run)(block) & F.exists(
            block["spans"], meets(run)))

    runs = _let(_blocks(F.col("base")), lambda blocks: F.filter(
        _matches(F.col("text"), RUN, 3), apart(blocks)))
    return rows.withColumn("base", _spans(F.col("matches"))).drop("matches").withColumn(
        "runs", runs).withColumn("markov", _spans(F.filter("runs", random_run))).drop("runs")


def _blocks(spans: Column) -> Column:
    """Runs of ``_BLOCK`` spans in order, each with the range it lies in."""
    count = F.floor((F.greatest(F.size(spans), F.lit(1)) - 1) / _BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(spans, b * _BLOCK + 1, F.lit(_BLOCK)))
    return F.transform(cut, lambda part: F.struct(
        F.array_min(F.transform(part, lambda s: s["start"])).alias("start"),
        F.array_max(F.transform(part, lambda s: s["end"])).alias("end"), part.alias("spans")))


def described(spans: Column) -> Column:
    """``kind:start:end`` of ordered spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, overlapping ones together, replaced by a mark.

    ``spans`` are in order. The text is cut into pages once, so that no piece is
    searched from the start of a long text.
    """
    def piece(pages: Column, start: Column, end: Column) -> Column:
        page = F.floor(start / _PAGE).cast("int")
        last = F.floor((end - 1) / _PAGE).cast("int")
        return F.when(end > start, F.array_join(F.transform(F.sequence(page, F.greatest(page, last)), lambda i: (
            F.substring(F.get(pages, i), F.greatest(start - i * _PAGE, F.lit(0)) + 1,
                        F.least(end - i * _PAGE, F.lit(_PAGE)) - F.greatest(start - i * _PAGE, F.lit(0))))), "")
        ).otherwise("")

    def joined(pages: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        pairs = F.arrays_zip(spans.alias("s"), _before(ends, F.greatest).alias("at"))
        masked = F.transform(pairs, lambda p: F.when(
            p["s"]["start"] >= p["at"],
            F.concat(piece(pages, p["at"], p["s"]["start"]), F.lit(mark))).otherwise(""))
        tail = piece(pages, F.coalesce(F.array_max(ends), F.lit(0)), F.length(text))
        return F.concat(F.array_join(masked, ""), tail)

    return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0)), joined)


def secret_report(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: counts of base kinds, digest of base spans, all spans."""
    plain = documents.select("doc_id", "text")
    table = train(labelled_samples(plain, settings), settings)
    found = find_secrets(plain, table, settings)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(described(F.col("base")), 256).alias("base_sha256"),
        described(F.array_sort(F.concat("base", "markov"))).alias("spans"),
        F.size("markov").cast("bigint").alias("n_markov"))
