"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every word shingle of a text is hashed once. The high bits of a hash choose one
of ``bins`` bins, and a bin keeps its smallest hash. An empty bin takes the value
of a filled one: the first filled bin in an order of all bins that is random but
fixed for each empty bin, so a filled bin is chosen uniformly and independently
(optimal densification), and equal sets fill alike. Of each bin only the low
``bits`` bits are stored, packed as hexadecimal digits. Two bins then agree by
chance with probability ``2 ** -bits``, which the likeness of two fingerprints
corrects.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegrade.llm.common import cut_lineage

WORDS = 5
BINS = 128  # a power of two
BITS = 8  # 4 or 8: one or two hexadecimal digits a bin
_SPACE = r"[\x20\x09-\x0D]+"


def with_fingerprint(rows: DataFrame, text: str, name: str, bins: int = BINS, bits: int = BITS,
                     words: int = WORDS) -> DataFrame:
    """Add the fingerprint of a text column; a text without words has an empty one.

    Words are lower-cased. With fewer than ``words`` of them, the whole sequence
    is the one shingle. Every step is a column of its own, evaluated once a row.
    """
    shift = 64 - int(log2(bins))

    def bin_of(h: Column) -> Column:
        return F.shiftright(h, shift) + bins // 2

    kept = rows.columns
    w, s, f, b = (f"__{name}_{x}" for x in ("words", "hashes", "first", "bins"))
    rows = rows.withColumn(w, F.array_remove(F.split(F.lower(F.col(text)), _SPACE), ""))
    shingles = F.transform(
        F.sequence(F.lit(0), F.size(w) - words),
        lambda i: F.xxhash64(*(F.get(F.col(w), i + j) for j in range(words))))
    rows = rows.withColumn(s, F.sort_array(
        F.when(F.size(w) >= words, shingles)
        .when(F.size(w) > 0, F.array(F.xxhash64(w)))
        .otherwise(F.array().cast("array<bigint>"))))
    # in order of the hashes, the first of each bin is its smallest
    rows = rows.withColumn(f, F.filter(s, lambda h, i: (i == 0) | (
        bin_of(h) != bin_of(F.get(F.col(s), i - 1)))))
    rows = rows.withColumn(b, F.transform(f, bin_of))

    def donor(i: Column) -> Column:
        ranked = F.transform(b, lambda j, at: F.xxhash64(i, j).bitwiseAND(-bins).bitwiseOR(at))
        return F.array_min(ranked).bitwiseAND(bins - 1).cast("int")

    def value(i: Column) -> Column:
        own = F.array_position(b, i)
        return F.get(F.col(f), F.when(own > 0, own.cast("int") - 1).otherwise(donor(i)))

    digits = bits // 4
    code = F.array_join(F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint")),
        lambda i: F.substring(F.hex(value(i).bitwiseAND((1 << bits) - 1) + (1 << bits)), 2, digits)), "")
    return rows.withColumn(name, F.when(F.size(f) > 0, F.lower(code)).otherwise("")).select(*kept, name)


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The estimated share of common shingles of two packed fingerprints, 0 to 1.

    Equal fingerprints give 1, an empty one with another gives 0.
    """
    digits, chance = bits // 4, 2.0 ** -bits
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: (
        F.substring(a, i * digits + 1, F.lit(digits)) == F.substring(b, i * digits + 1, F.lit(digits)))))
    estimate = F.greatest(F.lit(0.0), (same / bins - chance) / (1.0 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(estimate)


def in_order(documents: DataFrame) -> DataFrame:
    """Distinct documents (doc_id, mark, n) with the key of the next one.

    The order is by descending doc_id, nulls last, then by mark; after the last
    document comes the first. Documents are dealt to tasks by range. A task sees
    the order inside its range, and the first documents of the ranges, a row for
    each, close the gaps between them.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc("mark")]
    dealt = cut_lineage(
        documents.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*order)
    this = F.struct("doc_id", "mark")
    rows = dealt.withColumn("next", F.lead(this).over(inside)).withColumn(
        "place", F.row_number().over(inside))
    heads = rows.where("place = 1").select("part", this.alias("head"))
    ends = heads.select("part", F.coalesce(
        F.lead("head").over(Window.orderBy("part")),
        F.first("head").over(Window.orderBy("part"))).alias("after"))
    return rows.join(F.broadcast(ends), "part").withColumn("next", F.coalesce("next", "after")).select(
        "doc_id", "mark", "n", F.col("next.doc_id").alias("next_id"), F.col("next.mark").alias("next_mark"))


_SAME = "a.doc_id <=> b.doc_id AND a.mark = b.mark"


def edited_texts(texts: DataFrame, order: DataFrame) -> DataFrame:
    """(doc_id, mark, edited): the first half of each text and as much of the next document's start.

    Every document sends its start, as long as asked for, to the key of the
    document before it. Both joins read one exchange of the texts.
    """
    asking = order.select(
        F.col("next_id").alias("doc_id"), F.col("next_mark").alias("mark"),
        F.col("doc_id").alias("asker_id"), F.col("mark").alias("asker_mark"),
        F.floor(F.col("n") / 2).cast("int").alias("asked"))
    given = texts.alias("a").join(asking.alias("b"), F.expr(_SAME)).groupBy(
        F.col("asker_id").alias("doc_id"), F.col("asker_mark").alias("mark")
    ).agg(F.max(F.expr("left(a.text, b.asked)")).alias("given"))  # one text, though rows may repeat
    own = F.expr("left(a.text, length(a.text) - length(a.text) div 2)")
    return texts.alias("a").join(given.alias("b"), F.expr(_SAME)).select(
        "a.doc_id", "a.mark", F.concat(own, F.col("b.given")).alias("edited"))


def fingerprints(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", bins: int = BINS,
    bits: int = BITS, words: int = WORDS,
) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Texts are read whole. A null text is empty; texts without words have the
    empty fingerprint, which is like itself alone. Rows that repeat both doc_id
    and text are one document and get the same result each; different texts of
    one doc_id follow each other by the hash of their text; documents without a
    doc_id come last. A single document is its own next one. An empty table gives
    no rows; other columns are ignored.
    """
    texts = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    rows = with_fingerprint(
        texts.withColumn("n", F.length("text").cast("bigint")), "text", "fingerprint", bins, bits, words)
    # packed to bytes on the way, as digits in the result
    known = cut_lineage(rows.groupBy("doc_id", "mark").agg(
        F.max("n").alias("n"), F.max(F.unhex("fingerprint")).alias("fingerprint")))
    order = cut_lineage(in_order(known.select("doc_id", "mark", "n")))
    following = known.select("doc_id", "mark", F.col("fingerprint").alias("next_fingerprint"))
    pairs = known.alias("a").join(order.alias("b"), F.expr(_SAME)).select(
        "a.*", F.col("b.next_id").alias("next_id"), F.col("b.next_mark").alias("next_mark"))
    pairs = pairs.alias("a").join(
        following.alias("b"), F.expr("a.next_id <=> b.doc_id AND a.next_mark = b.mark")
    ).select("a.doc_id", "a.mark", "a.n", "a.fingerprint", "b.next_fingerprint")
    edited = with_fingerprint(
        edited_texts(texts, order), "edited", "edited_fingerprint", bins, bits, words
    ).select("doc_id", "mark", F.sha2("edited", 256).alias("edited_sha256"), "edited_fingerprint")
    found = edited.alias("a").join(pairs.alias("b"), F.expr(_SAME)).select(
        "a.doc_id", "b.n", "a.edited_sha256", "a.edited_fingerprint",
        F.lower(F.hex("b.fingerprint")).alias("fingerprint"),
        F.lower(F.hex("b.next_fingerprint")).alias("next_fingerprint"))
    mine = F.col("fingerprint")
    return found.select(
        "doc_id", F.col("n").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(mine, F.col("edited_fingerprint"), bins, bits).alias("near_edited"),
        likeness(mine, F.col("next_fingerprint"), bins, bits).alias("near_next"))
