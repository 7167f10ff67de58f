"""Chat formatting of typed content parts, in SQL functions only.

A visitor flattens the parts of a turn in order: text is escaped, an image, an
audio clip or a document becomes a placeholder, whose reference and expanded
token count are recorded as an attachment. All marks of the template begin with
``<``; ``&`` and ``<`` of a text are written ``&amp;`` and ``&lt;``, so no text
can hold a mark and the original can be read back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: The parts of a turn. ``ref`` names an attachment; ``units`` is its size: image
#: pixels, audio seconds, document pages.
PARTS = "array<struct<kind:string,text:string,ref:string,units:double>>"


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder stands for: a fixed share and one by size."""

    pixels_per_token: float = 784.0
    tokens_per_second: float = 25.0
    tokens_per_page: float = 600.0


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def text_part(text: Column) -> Column:
    """A turn of one text part."""
    none = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), none.cast("string").alias("ref"),
        none.cast("double").alias("units"))).cast(PARTS)


def _placeholder(part: Column) -> Column:
    shown = F.coalesce(escaped(part["text"]), F.lit(""))
    for kind, mark in PLACEHOLDERS.items():
        shown = F.when(part["kind"] == kind, F.lit(mark)).otherwise(shown)
    return shown


def _tokens(part: Column, rule: Expansion) -> Column:
    units = F.coalesce(part["units"], F.lit(0.0))
    size = (
        F.when(part["kind"] == "image", units / rule.pixels_per_token)
        .when(part["kind"] == "audio", units * rule.tokens_per_second)
        .otherwise(units * rule.tokens_per_page)
    )
    return F.greatest(F.ceil(size), F.lit(1)).cast("bigint")


def flatten_parts(turns: DataFrame, rule: Expansion = Expansion()) -> DataFrame:
    """Add ``body`` (text and placeholders in order) and ``attachments`` of a turn.

    ``attachments`` lists kind, ref and expanded tokens in the order of the
    placeholders. A part of an unknown kind counts as text, a null one as empty.
    """
    parts = F.coalesce("parts", F.array().cast(PARTS))
    attached = F.filter(parts, lambda p: F.coalesce(p["kind"].isin(*PLACEHOLDERS), F.lit(False)))
    return turns.withColumn(
        "body", F.array_join(F.transform(parts, lambda p: F.coalesce(_placeholder(p), F.lit(""))), "")
    ).withColumn("attachments", F.transform(attached, lambda p: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p, rule).alias("tokens"))))


def format_conversations(turns: DataFrame, rule: Expansion = Expansion()) -> DataFrame:
    """One row per conv_id: formatted, loss_mask, attachments, n_turns.

    ``turns`` has conv_id, turn, role and parts (see ``PARTS``). Turns are
    ordered by turn, then role, then body; repeated rows are turns of their
    own, null ones come first and a null role is empty. ``loss_mask`` lists the
    code point spans of assistant bodies in ``formatted``. A conversation is one
    cell by contract; its turns are shortened to their pieces before they meet.
    """
    pieces = flatten_parts(turns.select("conv_id", "turn", "role", "parts"), rule).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), "body", "attachments")
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY))
    pieces = pieces.withColumn("head", head).withColumn(
        "segment", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    so_far = F.sum(F.length("segment")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = pieces.withColumn("number", F.row_number().over(order)).withColumn("stop", so_far)
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "number", "stop", "role", F.length("body").alias("size"), "segment", "attachments")))
        .alias("all"))

    def span(t: Column) -> Column:
        end = (t["stop"] - len(END)).cast("int")
        return F.struct((end - t["size"]).alias("start"), end.alias("end"))

    return gathered.select(
        "conv_id", F.array_join(F.transform("all", lambda t: t["segment"]), "").alias("formatted"),
        F.transform(F.filter("all", lambda t: t["role"] == "assistant"), span).alias("loss_mask"),
        F.flatten(F.transform("all", lambda t: t["attachments"])).alias("attachments"),
        F.size("all").cast("bigint").alias("n_turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_text``, read from the formatted text alone."""
    raw = F.split("formatted", r"<\|turn\|>", -1)
    turns = F.transform(F.slice(raw, 2, F.size(raw)), lambda t: F.struct(
        unescaped(F.substring_index(t, BODY, 1)).alias("role"),
        unescaped(F.substring_index(F.substring_index(t, BODY, -1), END, 1)).alias("text")))
    loss = F.transform("loss_mask", lambda m: unescaped(
        F.substring(F.col("formatted"), m["start"] + 1, m["end"] - m["start"])))
    return formatted.withColumn("turns", turns).withColumn("loss_text", F.array_join(loss, ""))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Digests of what can be read back from formatted conversations of plain texts."""
    back = read_back(format_conversations(turns))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
