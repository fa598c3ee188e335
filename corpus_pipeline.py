"""From documents to training tokens: five stages, each of which works on all that the one before kept.

Toxic documents go, then near duplicates of documents with smaller ids, then passages that repeat
within the rest; what remains is mixed to the sources' target weights and encoded. All but the last
stage return the columns of documents. Nulls, empty texts, repeated rows, empty tables and further
columns are handled as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripkpi.llm import minhash, mixing, suffixes, toxicity, wfst
from tripkpi.llm.common import table, written

PIECES = "piece_bpe_32k.model"
# Workers have done the other stages before and share their memory with them.
CACHED_PRE_TOKENS = 150_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without toxic ones, by a model of the labelled documents among them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.without_near_duplicates(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without what also starts earlier, in strings of 100 bytes."""
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row for each time that it takes words from a document."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed texts."""
    return wfst.encode(docs, public_tokenizers.path(PIECES), CACHED_PRE_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# The first stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
