"""Severity of toxic text by cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all ordered thresholds: P(grade > k) = sigmoid(w.x - theta_k). The
result is the expected grade, sum over k of P(grade > k). Features are words and word beginnings that
go along with the toxic label; their values are log2(1 + occurrences among PER_WORDS words), so that a
short text with one telling word stands out while a long one does not add up chance hits. Grades go by
shares of words too, so all thresholds ask the same of the weights they share.

The labels only say toxic or not, so the grades to learn are derived from them: 0 for a text that is
not toxic, else 1, 2 or 3 by the share of its words that are typical of toxic texts. The model is
fitted on a bounded sample of labelled rows (``sample_rows``) and has a bounded number of features;
it is then applied to every whole text.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.common import map_rows, slices, written

SAMPLE_ROWS = 20_000
MAX_FEATURES = 4_096
# Texts of the sample that have a feature, and its likelihood ratio statistic, at least.
LEAST_TEXTS = 5
LEAST_RATIO = 25.0
# Features of mostly toxic texts only: with others, long texts could add up to anything.
LEAST_SHARE = 0.5
PREFIXES = (4, 5, 6)
# The length of text that occurrences are counted for.
PER_WORDS = 200
# A word is typical if so many of the texts with one of its features are toxic; shares of typical
# words from which a toxic text has grade 2 and 3.
TYPICAL = 0.9
GRADE_SHARES = (0.01, 0.025)
PENALTY = 1e-3
STEPS = 500
CACHED_WORDS = 300_000

LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


def value(occurrences: int, n_words: int) -> float:
    """A feature's value in a text of so many words."""
    return math.log2(1 + PER_WORDS * occurrences / n_words)


@dataclass(frozen=True)
class Severity:
    """A fitted model: feature names with weights and whether they are typical, and thresholds."""

    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


class _Hits(dict):
    """Word to the numbers of its features; most words have none."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.index = index

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        index = self.index
        found = tuple(index[f] for f in features_of(word) if f in index)
        self[word] = found
        return found

    def __call__(self, text: str) -> tuple[int, dict[int, int], list[tuple[int, ...]]]:
        """Number of words, occurrences of each feature, and the features of words that have any."""
        words = LETTERS.findall(text.lower())
        hits = [h for h in map(self.__getitem__, words) if h]
        counts: dict[int, int] = {}
        for hit in hits:
            for j in hit:
                counts[j] = counts.get(j, 0) + 1
        return len(words), counts, hits


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows, columns, values, grades, n_features, n_grades=4):
    """Weights and ordered thresholds of the most likely cumulative-link model, with an L2 penalty.

    ``rows``, ``columns`` and ``values`` are the entries of the sparse matrix, ``grades`` the grade of
    each of its rows. Full-batch Adam from zero weights; the same input gives the same model.
    """
    n = len(grades)
    above = np.array([(grades > k).mean() for k in range(n_grades - 1)])
    start = -np.log((above + 1 / (n + 1)) / (1 - above + 1 / (n + 1)))
    # theta_0 and the logarithms of the steps to the next ones keep thresholds in order.
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    parameters = np.concatenate([np.zeros(n_features), theta])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, theta = parameters[:n_features], parameters[n_features:]
        thresholds = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        score = np.bincount(rows, weights[columns] * values, minlength=n)
        padded = np.concatenate([[-np.inf], thresholds, [np.inf]])
        high, low = padded[grades + 1] - score, padded[grades] - score
        p_high, p_low = _sigmoid(high), _sigmoid(low)
        p_high[np.isposinf(high)], p_low[np.isneginf(low)] = 1.0, 0.0
        chance = np.maximum(p_high - p_low, 1e-12)
        d_high, d_low = p_high * (1 - p_high) / chance, p_low * (1 - p_low) / chance
        d_score = (d_high - d_low) / n  # of the loss, the negative log likelihood
        d_thresholds = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            d_thresholds[k] = (d_low[grades == k + 1].sum() - d_high[grades == k].sum()) / n
        d_theta = np.cumsum(d_thresholds[::-1])[::-1] * np.concatenate([[1.0], np.exp(theta[1:])])
        d_weights = np.bincount(columns, d_score[rows] * values, minlength=n_features)
        gradient = np.concatenate([d_weights + PENALTY / n * weights, d_theta])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        change = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        parameters = parameters - 0.1 * change
    theta = parameters[n_features:]
    return parameters[:n_features], np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text and toxic of at most ``rows`` labelled documents, taken by the hash of their ids.

    An id labelled more than once is toxic if any of its labels says so; null ids and labels are
    left out, as are null texts.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic"))
        .where("id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = documents.select("doc_id", "text").where("text IS NOT NULL")
    # At most ``rows`` ids and flags: some hundred kilobytes.
    return texts.join(F.broadcast(chosen), texts.doc_id == chosen.id).select("text", "toxic")


def _select_features(sample: DataFrame, max_features: int) -> list:
    """The features that tell toxic texts from others, best first, with their toxic share.

    Copies of a text would make its rare words look typical. So texts are counted by family, the
    least hash of their words, which near copies mostly share.
    """

    def distinct(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                names, families, flags = [], [], []
                for text, toxic in zip(
                    part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True
                ):
                    words = set(LETTERS.findall(text.lower()))
                    found = {f for w in words for f in features_of(w)}
                    names.extend(found)
                    family = min((zlib.crc32(w.encode()) for w in words), default=0)
                    families.extend([family] * len(found))
                    flags.extend([1 if toxic else 0] * len(found))
                yield pa.RecordBatch.from_pydict({
                    "feature": pa.array(names, pa.string()),
                    "family": pa.array(families, pa.int64()),
                    "toxic": pa.array(flags, pa.int32()),
                })

    counts = (
        sample.mapInArrow(distinct, "feature string, family long, toxic int")
        .groupBy("feature", "family")
        .agg(F.max("toxic").alias("toxic"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("a"), F.sum(F.expr("1 - toxic")).alias("b"))
    )
    totals = sample.agg(
        F.coalesce(F.sum(F.expr("IF(toxic > 0, 1, 0)")), F.lit(0)).alias("toxic"),
        F.count("*").alias("all"),
    ).first()
    n_toxic, n_clean = totals["toxic"], totals["all"] - totals["toxic"]
    if not n_toxic or not n_clean:
        return []
    share = n_toxic / (n_toxic + n_clean)
    ratio = (
        f"2 * (IF(a > 0, a * ln(a / ((a + b) * {share!r}D)), 0D)"
        f" + IF(b > 0, b * ln(b / ((a + b) * {1 - share!r}D)), 0D))"
    )
    return (
        counts.where(f"a + b >= {LEAST_TEXTS}")
        .select("feature", F.expr("a / (a + b)").alias("share"), F.expr(ratio).alias("ratio"))
        .where(f"ratio >= {LEAST_RATIO} AND share >= {LEAST_SHARE}")
        .orderBy(F.desc("ratio"), "feature")
        .limit(max_features)
        .collect()
    )


def fit(
    documents: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    max_features: int = MAX_FEATURES,
) -> Severity:
    """The model of a bounded sample; without toxic or without other labels, one that finds nothing."""
    sample = written(labelled_sample(documents, labels, sample_rows), "toxicity-sample")
    chosen = _select_features(sample, max_features)
    index = {row.feature: i for i, row in enumerate(chosen)}
    if not index:
        return Severity({}, np.zeros(0), np.full(3, 40.0))
    typical = np.array([row.share >= TYPICAL for row in chosen])

    def entries(part):
        hits = _Hits(index)
        grades, columns, values = [], [], []
        for text, toxic in zip(
            part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True
        ):
            n_words, counts, words = hits(text)
            share = sum(any(typical[j] for j in w) for w in words) / max(n_words, 1)
            grades.append(1 + sum(share >= s for s in GRADE_SHARES) if toxic else 0)
            columns.append(list(counts))
            values.append([value(n, n_words) for n in counts.values()])
        return grades, columns, values

    # At most sample_rows rows of features that occur in them.
    found = map_rows(sample, "grade int, columns array<int>, values array<double>", entries).collect()
    rows = np.repeat(np.arange(len(found)), [len(r.columns) for r in found])
    columns = np.array([c for r in found for c in r.columns], dtype=np.int64)
    values = np.array([v for r in found for v in r["values"]])
    grades = np.array([r.grade for r in found])
    weights, thresholds = fit_ordinal(rows, columns, values, grades, len(index))
    return Severity(index, weights, thresholds)


def score(documents: DataFrame, model: Severity, least: float = 0.5, keep: bool = False) -> DataFrame:
    """doc_id, severity, grade, p_toxic, toxic and kept for every row; with ``keep``, documents as
    they are without those that are toxic.

    ``severity`` is the expected grade from 0 to 3, ``grade`` the likeliest one, ``p_toxic`` the
    chance of a grade above 0; a document is toxic from ``least`` on, and kept if not. A text that is
    null or has no words scores as one without features. Rows are judged one by one: repeated rows
    get equal results, null ids and further columns change nothing, an empty table gives an empty
    result.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    ddl = "doc_id long, severity double, grade int, p_toxic double, toxic boolean, kept boolean"

    def make():
        model = shared.value
        hits = _Hits(model.index)

        def work(part):
            scores = np.zeros(part.num_rows)
            for i, text in enumerate(part.column("text").to_pylist()):
                if text:
                    n_words, counts, _ = hits(text)
                    scores[i] = sum(model.weights[j] * value(n, n_words) for j, n in counts.items())
            above = model.above(scores)
            bounds = np.hstack([np.ones((len(scores), 1)), above, np.zeros((len(scores), 1))])
            grades = np.argmax(bounds[:, :-1] - bounds[:, 1:], axis=1)
            toxic = above[:, 0] >= least
            if keep:
                return part.filter(pa.array(~toxic)).columns
            return part.column("doc_id"), above.sum(axis=1), grades, above[:, 0], toxic, ~toxic

        return work

    if keep:
        return map_rows(documents, documents.schema, None, "text", make)
    return map_rows(documents.select("doc_id", "text"), ddl, None, "text", make)
