"""Corpus pipeline: toxicity, line dedup, near-dedup, decontamination, source mix.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on
all that its predecessor kept, and all but the last return the columns of
documents.  ``run`` writes each stage's result as Parquet in the shared folder
and reads it again as the next one's input, so a lost executor costs the current
stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm import common, decontaminate, linededup, minhash, mixing, toxicity


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go (operator 5)."""
    return toxicity.drop_toxic(spark, docs, sf_dir)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go (operator 8); a document of which nothing
    is left goes too.  ``n_chars`` follows the text."""
    out = linededup.drop_repeated_lines(docs)
    out = out.filter((F.col("__n_removed") == 0) | F.col("text").rlike(linededup.FILLED))
    changed = F.col("__n_removed") > 0
    return out.select(*[F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                        if c == "n_chars" else F.col(c) for c in docs.columns])


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (operator 1)."""
    return minhash.drop_near_duplicates(docs)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go (operator 10)."""
    return decontaminate.drop_contaminated(spark, docs, sf_dir)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix reads (operator 7), one row each, sorted by training position."""
    common.ship(spark)
    return mixing.training_order(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("minhash_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_passages),
    ("mix_sources", mix_sources),
]

#: The toxicity model and the near-duplicate groups are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with common.only_last_table(spark):  # the stage's own tables go when its result is written
            docs = common.cut(stage(spark, docs, sf_dir))
    return docs
