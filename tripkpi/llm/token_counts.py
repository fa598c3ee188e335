"""Token counts of documents by looking up the lengths of pre-tokens in two tiers.

The first tier is a table of frequent pre-tokens with their numbers of tokens. It is fitted on a
bounded sample, broadcast, and only saves work: its content has no effect on any result. What is not
in it is encoded by the tokenizer's own library, once per Python worker as long as the worker's
bounded cache holds it. No pre-token is ever shuffled; documents are counted where they are read.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tripkpi.llm.common import map_rows
from tripkpi.llm.pieces import SPACE, pre_tokens, read_model

# Documents, on average, that the first tier is fitted on, and entries that it has at most (bounds its size).
SAMPLE_ROWS = 2_000
FREQUENT = 50_000
# Entries of a worker's cache, and characters of those pre-tokens that are worth caching.
CACHED = 400_000
CACHED_CHARS = 64

_workers: dict = {}


class _Lengths(dict):
    """Pre-token to number of tokens; encodes what it does not have yet."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        import sentencepiece

        self.frequent = frequent
        self.encode = sentencepiece.SentencePieceProcessor(model_file=path).encode

    def __missing__(self, pre_token: str) -> int:
        # The library puts one space in front itself, but none in front of nothing. A last space by
        # itself is counted behind a letter, as no piece goes on from there into a space.
        text = pre_token[1:].replace(SPACE, " ")
        length = len(self.encode(text)) if text else len(self.encode("x ")) - len(self.encode("x"))
        if len(pre_token) <= CACHED_CHARS:
            if len(self) >= len(self.frequent) + CACHED:
                self.clear()
                self.update(self.frequent)
            self[pre_token] = length
        return length


def frequent_lengths(documents: DataFrame, path: str, rows: int, size: int) -> dict[str, int]:
    """The most frequent pre-tokens of about ``rows`` documents and their numbers of tokens.

    Each task counts its own documents and hands over at most ``size`` pre-tokens.
    """

    def count(batches):
        model, seen = read_model(path), Counter()
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    seen.update(x for x in pre_tokens(text.as_py(), model) if len(x) <= CACHED_CHARS)
        top = seen.most_common(size)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([w for w, _ in top], pa.string()),
            "n": pa.array([n for _, n in top], pa.int64()),
        })

    share = min(1.0, rows / max(documents.count(), 1))
    some = documents.select("text").sample(share, seed=1)
    counted = some.mapInArrow(count, "word string, n long")
    top = counted.groupBy("word").sum("n").orderBy("sum(n)", "word", ascending=[False, True])
    lengths = _Lengths(path, {})
    return {row.word: lengths[row.word] for row in top.limit(size).collect()}


def count_tokens(
    documents: DataFrame,
    model_path: str,
    limit: int = 4096,
    sample_rows: int = SAMPLE_ROWS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) for every row.

    Tokens are those of the SentencePiece model at ``model_path`` without begin and end tokens. A
    null text counts as empty: no bytes, no tokens. Rows are counted one by one, so repeated rows,
    null or repeated ids and further columns, whatever their names, change nothing. An empty table
    gives an empty result.
    """
    spark = documents.sparkSession
    if not read_model(model_path).dummy_prefix or read_model(model_path).trim:
        raise ValueError("the model must put a space in front and leave other spaces alone")
    documents = documents.select("doc_id", "text")
    table = spark.sparkContext.broadcast(
        frequent_lengths(documents, model_path, sample_rows, frequent)
    )
    run = uuid.uuid4().hex  # so that a worker that is used again does not take an older table

    def make():
        key = (model_path, run)
        if key not in _workers:
            _workers.clear()
            _workers[key] = _Lengths(model_path, table.value)
        lengths, model = _workers[key].__getitem__, read_model(model_path)

        def work(part):
            texts = part.column("text")
            n_tokens = [
                sum(map(lengths, pre_tokens(t, model))) if t else 0 for t in texts.to_pylist()
            ]
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            return part.column("doc_id"), n_bytes, n_tokens, [n > limit for n in n_tokens]

        return work

    ddl = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_rows(documents, ddl, None, text="text", make=make)
