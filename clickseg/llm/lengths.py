"""Operator 9: exact histogram of encoded lengths, with sums from either end.

Every whole text is encoded by a public byte-level BPE vocabulary (its path is a
parameter; the driver reads the file and broadcasts its bytes, at most
``MAX_VOCABULARY_BYTES``).  Documents are aggregated by length; one row per
length that occurs then answers, for a context limit L equal to that length,
how many documents and tokens fit, are longer, and remain if texts are cut at L.
Between two lengths that occur the counts stay and the cut total is linear, so
the table answers every limit exactly (:func:`at_limit`, :func:`quantile`).

The sums run in two levels (blocks of ``BLOCK`` lengths), so no task gets the
whole histogram.

Defined results: a null or empty text has 0 tokens and counts as a document;
text that looks like a special token is ordinary text; repeated rows count
each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from clickseg.llm.common import cut, table

VOCABULARY = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: Pre-tokenizer pattern published with the vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_VOCABULARY_BYTES = 64 << 20
BLOCK = 256


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``(doc_id, n_tokens)`` for every row: tokens of the whole text."""
    if os.path.getsize(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(shared.value, pattern).encode_ordinary
        for b in batches:
            n = [len(encode(x.as_py())) if x.is_valid else 0 for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
                       ).mapInArrow(count, "doc_id long, n_tokens long")


def length_table(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Histogram of ``n_tokens`` with prefix and suffix sums, one row per length."""
    hist = cut(counts.groupBy("n_tokens").agg(F.count("*").alias("documents")))
    hist = hist.withColumns({"tokens": F.col("n_tokens") * F.col("documents"),
                             "block": F.floor(F.col("n_tokens") / block)})
    whole = hist.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    later = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(1))
    base = whole.select(F.col("block").alias("b"),
                        *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"],
                        *[F.sum(c).over(every).alias(f"{c}_all") for c in "dt"])
    inside = W.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, 0)
    h = hist.withColumns({"d_in": F.sum("documents").over(inside), "t_in": F.sum("tokens").over(inside)}
                         ).join(base, F.col("block") == F.col("b"))
    at_least, tokens_at_least = F.col("d_later") + F.col("d_in"), F.col("t_later") + F.col("t_in")
    longer, tokens_longer = at_least - F.col("documents"), tokens_at_least - F.col("tokens")
    return h.select(
        "n_tokens", "documents", "tokens",
        at_least.alias("documents_at_least"), tokens_at_least.alias("tokens_at_least"),
        longer.alias("documents_longer"),
        (F.col("d_all") - longer).alias("documents_up_to"),
        (F.col("t_all") - tokens_longer).alias("tokens_up_to"),
        (F.col("t_all") - tokens_longer + longer * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("d_all") - longer) / F.col("d_all")).alias("quantile"))


def quantile(lengths: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least the share ``q`` of the documents does not exceed."""
    return lengths.filter(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def at_limit(lengths: DataFrame, limit: int) -> DataFrame:
    """Totals for any context limit: documents and tokens that fit, documents cut, tokens left."""
    fit = F.col("n_tokens") <= limit
    total = lambda c: F.coalesce(F.sum(F.when(fit, F.col(c))), F.lit(0))
    cut_docs = F.coalesce(F.sum(F.when(~fit, F.col("documents"))), F.lit(0))
    return lengths.agg(total("documents").alias("documents_fit"), total("tokens").alias("tokens_fit"),
                       cut_docs.alias("documents_cut"),
                       (total("tokens") + cut_docs * F.lit(limit)).alias("truncated_total"))


def op9_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_table(token_counts(table(spark, sf_dir, "documents")))
