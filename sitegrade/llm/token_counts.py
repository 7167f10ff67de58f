"""Token counts of whole texts by a two-tier lookup on the map side.

Tier one is a broadcast table of the lengths of frequent pre-tokens, tier two a
bounded memory in each worker process for the rest. No pre-token is ever shuffled: one
narrow scan gives the counts.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import map_batches
from sitegrade.llm.pieces import Pieces, worker_pieces

#: Bounds of the frequent table: it never exceeds ENTRIES pre-tokens of at most
#: LONGEST characters, whatever the corpus (some 4 MB).
ENTRIES = 32_768
LONGEST = 32


def frequent_lengths(
    documents: DataFrame, tokenizer: str, text: str = "text",
    sample_tasks: int = 4, sample_documents: int = 1024,
) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample.

    ``take`` visits only as many partitions as it needs, each reading at most
    ``sample_documents`` whole texts, so the cost does not grow with the corpus.
    A poor sample makes the main pass slower, never different.
    """

    def counts(batches):
        pieces = Pieces(tokenizer, lower=False, counts_only=True)
        found: Counter = Counter()
        left = sample_documents
        for batch in batches:
            for value in batch.column(0).slice(0, left).to_pylist():
                found.update(p for p in pieces.cut(value) or () if len(p) <= LONGEST)
            left -= min(left, batch.num_rows)
            if len(found) > 40 * ENTRIES:
                found = Counter(dict(found.most_common(10 * ENTRIES)))
            if not left:
                break
        top = found.most_common(ENTRIES)
        yield pa.RecordBatch.from_pydict(
            {"pieces": [[p for p, _ in top]], "counts": [[n for _, n in top]]},
            schema=pa.schema([("pieces", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]),
        )

    sample = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        counts, "pieces array<string>, counts array<bigint>"
    )
    total: Counter = Counter()
    for row in sample.take(sample_tasks):
        total.update(dict(zip(row["pieces"], row["counts"], strict=True)))
    encode = Pieces(tokenizer, lower=False, counts_only=True)
    encode.learn({p for p, _ in total.most_common(ENTRIES)})
    return encode.known


def count_tokens(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    limit: int = 512, frequent: dict[str, int] | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty (0 bytes, 0 tokens); repeated rows are counted
    each; an empty table gives an empty result; other columns are ignored.
    ``tokenizer`` is the path of a byte-level BPE file.
    """
    if frequent is None:
        frequent = frequent_lengths(documents, tokenizer, text)
    shared = documents.sparkSession.sparkContext.broadcast(frequent)
    number = uuid.uuid4().int  # worker memories never mix two tables

    def make():
        pieces = worker_pieces(tokenizer, False, True, number)
        pieces.start_from(shared.value)

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text")
            n = pieces.lengths(texts.to_pylist())
            return {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pc.binary_length(texts.cast(pa.large_binary())).cast(pa.int64()),
                "n_tokens": n,
                "over_limit": [x > limit for x in n],
            }

        return step

    id_type = documents.schema[doc_id].dataType.simpleString()
    return map_batches(
        documents.select(F.col(doc_id).alias("doc_id"),
                         F.coalesce(F.col(text), F.lit("")).alias("text")),
        make, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
