"""Language of documents by interpolated Kneser-Ney models of characters, one for each language.

A model's grams are four characters of lower-cased text, everything but letters being single spaces.
The number of times that each language has each gram is counted over all labelled documents that are
not held out; lower orders follow from it by counting distinct continuations. Grams are kept as
64-bit keys (the UTF-16 units side by side) in sorted arrays with the logarithms of their
probabilities in every language beside them, so that one search serves all languages. Keys that no
language has seen are worked out from lower orders as they come.

No gram is left out. If there are more than is good to broadcast, all orders are grouped and joined by
Spark; only grams that are frequent have their logarithms broadcast, those of all others are joined to
the texts that have them. Logarithms are whole numbers of STEPS, so sums do not depend on the way.

The language with the lowest cross-entropy per character wins. The score is the chance that this is
right, by a logistic regression on the distance to the runner-up; below 0.5, or if the cross-entropy is
above that of nearly all texts, the prediction is marked as rejected. Both are fitted on all texts that may
be learned from. As texts that a model has seen look surer than others, each third of them is judged by
models counted from the other two; the models that predict are counted from all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.common import map_rows, written

ORDER = 4
DISCOUNT = 0.75
# Grams, counted once for each language, that are broadcast: all of them if there are no more, or those
# that are frequent. Results do not depend on it.
BROADCAST_GRAMS = 1_000_000
# Steps of a logarithm: sums of them are exact.
STEPS = 1 << 20
# The part of the texts that one belongs to; the score is calibrated on each, by models of the others.
FOLDS = 3
FOLD = f"pmod(xxhash64(text), {FOLDS})"
CALIBRATING = f"{FOLD} = 0"
# Share of the texts whose cross-entropy is not too high.
USUAL = 0.999
# Margins beyond this make no answer surer.
SUREST = 50.0
# Ranges that values are counted in to find the one of a rank.
RANGES = 1_000
CHUNK = 1 << 19

OTHER = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"


def units(text: str | None) -> bytes:
    """UTF-16 units of the text's letters, padded; empty if it has none."""
    plain = OTHER.sub(" ", text.lower()).strip() if text else ""
    if not plain:
        return b""
    return (" " * (ORDER - 1) + plain + " ").encode("utf-16-le", "surrogatepass")


def keys(data: np.ndarray) -> np.ndarray:
    """The gram that ends at each unit but the first three."""
    out = np.zeros(len(data) - ORDER + 1, np.uint64)
    for j in range(ORDER):
        out = out << np.uint64(16) | data[j : len(data) - ORDER + 1 + j].astype(np.uint64)
    return out


def _lookup(sorted_keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the keys, 0 where there is none."""
    if not len(sorted_keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, values[at], 0.0)


class KneserNey:
    """One language's model from its grams and their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order].astype(float)
        self.alphabet = alphabet
        self.levels = []  # from the longest grams down: keys, counts, contexts, totals, kinds
        for n in range(ORDER, 0, -1):
            contexts, where = np.unique(grams >> np.uint64(16), return_inverse=True)
            totals, kinds = np.bincount(where, counts), np.bincount(where).astype(float)
            self.levels.append((grams, counts, contexts, totals, kinds))
            # Below, what counts is in how many different ways a gram is begun.
            mask = np.uint64((1 << (16 * (n - 1))) - 1)
            grams, counts = np.unique(grams & mask, return_counts=True)
            counts = counts.astype(float)

    def probability(self, grams: np.ndarray) -> np.ndarray:
        chance = np.full(len(grams), 1.0 / self.alphabet)
        for n in range(1, ORDER + 1):
            known, counts, contexts, totals, kinds = self.levels[ORDER - n]
            wanted = grams & np.uint64((1 << (16 * n)) - 1)
            context = wanted >> np.uint64(16)
            total = _lookup(contexts, totals, context)
            kind = _lookup(contexts, kinds, context)
            count = _lookup(known, counts, wanted)
            seen = total > 0
            total = np.where(seen, total, 1.0)
            mixed = np.maximum(count - DISCOUNT, 0) / total + DISCOUNT * kind / total * chance
            chance = np.where(seen, mixed, chance)
        return chance


def _steps(chances: np.ndarray) -> np.ndarray:
    return np.rint(np.log(chances) * STEPS)


@dataclass
class Tables:
    """All grams of all languages as tables, for more than can be broadcast."""

    names: list[str]
    alphabet: int
    levels: list[tuple[DataFrame, DataFrame]]  # from the longest grams down: grams, contexts

    @classmethod
    def of(cls, counts: DataFrame, names: list[str], alphabet: int) -> Tables:
        levels = []
        for n in range(ORDER, 0, -1):
            contexts = counts.groupBy("lang", F.expr("shiftrightunsigned(gram, 16)").alias("context"))
            contexts = contexts.agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            levels.append((counts, written(contexts, f"contexts{n}")))
            if n > 1:
                lower = counts.groupBy("lang", F.expr(_last(n - 1)).alias("gram"))
                counts = written(lower.agg(F.count("*").alias("n")), f"grams{n - 1}")
        return cls(names, alphabet, levels)

    def logs(self, grams: DataFrame) -> DataFrame:
        """gram and logs, its steps in each language, as KneserNey.probability has them."""
        langs = F.posexplode(F.array(*map(F.lit, self.names))).alias("place", "lang")
        rows = grams.select("gram", langs, F.lit(1.0 / self.alphabet).alias("chance"))
        for n in range(1, ORDER + 1):
            known, contexts = self.levels[ORDER - n]
            rows = rows.selectExpr("*", f"{_last(n)} AS wanted").selectExpr(
                "*", "shiftrightunsigned(wanted, 16) AS context"
            )
            rows = rows.join(known.withColumnRenamed("gram", "wanted"), ["lang", "wanted"], "left")
            rows = rows.join(contexts, ["lang", "context"], "left")
            mixed = (
                f"greatest(coalesce(n, 0L) - {DISCOUNT}D, 0D) / total"
                f" + {DISCOUNT}D * kinds / total * chance"
            )
            rows = rows.selectExpr(
                "gram", "place", "lang",
                f"CASE WHEN total > 0 THEN {mixed} ELSE chance END AS chance",
            )
        step = F.expr(f"CAST(rint(ln(chance) * {STEPS}D) AS BIGINT)").alias("step")
        listed = F.sort_array(F.collect_list(F.struct("place", step))).alias("listed")
        return rows.groupBy("gram").agg(listed).selectExpr("gram", "listed.step AS logs")


def _last(n: int) -> str:
    """The last n characters of a gram."""
    return f"gram & {(1 << (16 * n)) - 1}L" if n < ORDER else "gram"


@dataclass
class Languages:
    """All models: names in code point order, sorted keys, and log probabilities by language.

    ``tables`` has all grams where not all are broadcast; ``models`` is empty then.
    """

    names: list[str]
    models: list[KneserNey]
    grams: np.ndarray
    logs: np.ndarray
    tables: Tables | None = None
    slope: float = 1.0
    offset: float = 0.0
    usual: float = np.inf

    def __getstate__(self):
        return self.__dict__ | {"tables": None}  # tables stay with the driver

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list]:
        """Steps of each text in each language, the texts' lengths, and what is not in the sums:
        places of texts, grams and counts."""
        encoded = [units(t) for t in texts]
        sizes = np.array([len(e) // 2 for e in encoded], np.int64)
        data = np.frombuffer(b"".join(encoded), np.uint16)
        totals = np.zeros((len(texts), len(self.names)))
        lengths = np.maximum(sizes - ORDER + 1, 0)
        rare = []
        if len(data) < ORDER or not self.names:
            return totals, lengths, rare
        starts = np.cumsum(sizes) - sizes
        for at in range(0, len(data) - ORDER + 1, CHUNK):
            part = keys(data[at : at + CHUNK + ORDER - 1])
            ends = np.arange(at, at + len(part)) + ORDER - 1
            owner = np.searchsorted(starts, ends, side="right") - 1
            inside = ends >= starts[owner] + ORDER - 1  # not begun in the text before
            part, owner = part[inside], owner[inside]
            different, where = np.unique(part, return_inverse=True)
            logs, new = self.log_probabilities(different)
            if len(new):
                missing = np.isin(where, new)
                rare.append(np.column_stack([owner[missing].astype(np.uint64), part[missing]]))
            for j in range(len(self.names)):
                totals[:, j] -= np.bincount(owner, logs[where, j], minlength=len(texts))
        if rare:
            pairs, n = np.unique(np.concatenate(rare), axis=0, return_counts=True)
            rare = [(pairs[:, 0].tolist(), pairs[:, 1], n)]
        return totals, lengths, rare

    def log_probabilities(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In steps, and the places of grams that only the tables have, which get 0."""
        if not len(self.grams):
            return np.zeros((len(grams), len(self.names))), np.arange(len(grams))
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        logs = self.logs[at].astype(float)
        new = np.flatnonzero(self.grams[at] != grams)
        if not self.models:
            logs[new] = 0
            return logs, new
        for j, model in enumerate(self.models if len(new) else ()):
            logs[new, j] = _steps(model.probability(grams[new]))
        return logs, new[:0]

    def margins(self, entropies: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Distance between the two best languages; it counts for more in longer texts."""
        if len(self.names) < 2:
            return np.full(len(entropies), 10.0)
        two = np.sort(entropies, axis=1)[:, :2]
        return (two[:, 1] - two[:, 0]) * np.sqrt(lengths)


def learned_from(documents: DataFrame) -> DataFrame:
    """text and lang of the documents that may be learned from."""
    return documents.where(
        "crc32(CAST(doc_id AS STRING)) % 3 <> 1 AND lang IS NOT NULL AND text IS NOT NULL"
    ).select("text", "lang")


def gram_counts(documents: DataFrame) -> DataFrame:
    """lang, gram, n over all documents that may be learned from, and rest, rest1 and rest2, without those
    of the first, second and third fold."""
    rests = _rests()

    def work(part):
        texts = part.column("text").to_pylist()
        kinds = list(zip(part.column("lang").to_pylist(), part.column("fold").to_pylist(), strict=True))
        out = ([], [], [], *([] for _ in rests))
        for lang, fold in sorted(set(kinds)):
            counts: list = []
            for text in (t for t, x in zip(texts, kinds, strict=True) if x == (lang, fold)):
                data = np.frombuffer(units(text), np.uint16)
                if len(data) >= ORDER:
                    counts.append(keys(data))
            if counts:
                grams, n = np.unique(np.concatenate(counts), return_counts=True)
                out[0].extend([lang] * len(grams))
                out[1].append(grams.view(np.int64))
                out[2].append(n)
                for i in range(FOLDS):
                    out[3 + i].append(np.zeros_like(n) if i == fold else n)
        if not out[0]:
            return [[] for _ in out]
        return out[0], *map(np.concatenate, out[1:])

    known = learned_from(documents).withColumn("fold", F.expr(FOLD))
    ddl = ", ".join(["lang string, gram long, n long", *(f"{r} long" for r in rests)])
    counted = map_rows(known, ddl, work, text="text")
    return counted.groupBy("lang", "gram").agg(*(F.sum(c).alias(c) for c in ("n", *rests)))


def _rests() -> list[str]:
    """Names of the counts without one fold."""
    return ["rest", *(f"rest{i}" for i in range(1, FOLDS))]


def fit(documents: DataFrame, broadcast_grams: int = BROADCAST_GRAMS) -> Languages:
    """Models of all languages that labelled documents have, and the score's calibration."""
    counts = written(gram_counts(documents), f"grams{ORDER}")
    names = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not names:
        return Languages([], [], np.empty(0, np.uint64), np.empty((0, 0)))
    alphabet = counts.selectExpr(_last(1)).distinct().count() + 1
    whole = counts.count() <= broadcast_grams
    others = []
    for rest in _rests():
        kept = counts.where(f"{rest} > 0").selectExpr("lang", "gram", f"{rest} AS n")
        others.append(_models(kept, names, alphabet, whole, broadcast_grams))
    fitted = _models(counts.select("lang", "gram", "n"), names, alphabet, whole, broadcast_grams)
    _calibrate(fitted, others, documents)
    return fitted


def _models(
    counts: DataFrame, names: list[str], alphabet: int, whole: bool, broadcast_grams: int
) -> Languages:
    """Models with all grams broadcast, or as many of the frequent ones as there is room for."""
    if whole:
        table = counts.toArrow()
        langs = np.array(table.column("lang").to_pylist(), dtype=object)
        grams = table.column("gram").to_numpy().view(np.uint64)
        n = table.column("n").to_numpy()
        models = [KneserNey(grams[langs == x], n[langs == x], alphabet) for x in names]
        union = np.unique(grams)
        logs = np.column_stack([_steps(m.probability(union)) for m in models])
        return Languages(names, models, union, logs.astype(np.int32))
    tables = Tables.of(counts, names, alphabet)
    table = tables.logs(_frequent(counts, broadcast_grams // len(names))).toArrow()
    grams = table.column("gram").to_numpy().view(np.uint64)
    logs = np.array(table.column("logs").to_pylist(), np.int32).reshape(-1, len(names))
    order = np.argsort(grams)
    return Languages(names, [], grams[order], logs[order], tables)


def _frequent(counts: DataFrame, room: int) -> DataFrame:
    """The grams of at least 2**k occurrences, for the least k with which there is room for them."""
    grams = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    sizes = grams.groupBy(F.expr("length(bin(n))").alias("bits")).count().collect()
    least = 64
    for row in sorted(sizes, reverse=True):
        room -= row["count"]
        if room < 0:
            break
        least = row.bits
    return grams.where(F.expr("length(bin(n))") >= least).select("gram")


def _entropies(rows: DataFrame, fitted: Languages, ddl: str) -> DataFrame:
    """Columns of ``ddl``, entropies by language (0 for no letters), and the number of grams."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)
    columns = [c.split()[0] for c in ddl.split(", ")]
    rows = rows.selectExpr(*columns, "text", "sha2(text, 256) AS key")

    def work(part):
        totals, lengths, _ = shared.value.sums(part.column("text").to_pylist())
        return *(part.column(c) for c in (*columns, "key")), totals.tolist(), lengths

    def find(part):
        keys, out = part.column("key").to_pylist(), ([], [], [])
        for owner, grams, n in shared.value.sums(part.column("text").to_pylist())[2]:
            out[0].extend(keys[i] for i in owner)
            out[1].extend(grams.view(np.int64).tolist())
            out[2].extend(n.tolist())
        return out

    summed = map_rows(rows, f"{ddl}, key string, sums array<double>, n long", work, text="text")
    if fitted.tables is not None:
        texts = rows.where("text IS NOT NULL")
        rare = map_rows(texts, "key string, gram long, times long", find, text="text")
        rare = written(rare.distinct(), "rare")  # copies of a text have equal rows
        logs = fitted.tables.logs(rare.select("gram").distinct())
        added = [f"sum(times * logs[{j}])" for j in range(len(fitted.names))]
        added = F.expr(f"array({', '.join(added)})").alias("added")
        summed = summed.join(rare.join(logs, "gram").groupBy("key").agg(added), "key", "left")
        both = "zip_with(sums, added, (a, b) -> a - b)"
        summed = summed.withColumn("sums", F.expr(f"IF(added IS NULL, sums, {both})"))
    each = f"transform(sums, s -> s / {STEPS}D / greatest(n, 1L)) AS entropies"
    return summed.selectExpr(*columns, each, "n")


def _matrix(part, names: list[str]) -> np.ndarray:
    flat = part.column("entropies").to_pylist()
    return np.array(flat, float).reshape(len(flat), len(names))


def _judged(documents: DataFrame, others: list[Languages]) -> DataFrame:
    """margin, right and least (the best language's entropy) of all texts with letters that may be learned
    from, each by the models in ``others`` that have not seen its fold."""
    parts = []
    for fold, fitted in enumerate(others):
        known = learned_from(documents).where(f"{FOLD} = {fold}")
        if fitted.tables is not None:
            known = written(known, "calibration")  # read twice
        elif not len(fitted.grams):
            continue  # there are no texts but this fold's, so nothing to judge them by
        rows = _entropies(known, fitted, "lang string").where("n > 0")
        parts.append(map_rows(rows, "margin double, right double, least double", _judge(fitted.names)))
    rows = reduce(DataFrame.union, parts) if parts else None
    return rows if rows is None else written(rows, "judged")


def _judge(names: list[str]):
    margins = Languages(names, [], np.empty(0, np.uint64), np.empty((0, 0))).margins

    def work(part):
        entropies = _matrix(part, names)
        margin = np.minimum(margins(entropies, part.column("n").to_numpy()), SUREST)
        best = np.array([names[i] for i in entropies.argmin(axis=1)], object)
        right = best == np.array(part.column("lang").to_pylist(), object)
        return margin, right.astype(float), entropies.min(axis=1)

    return work


def _calibrate(fitted: Languages, others: list[Languages], documents: DataFrame) -> None:
    """Slope and offset of the score, and the usual cross-entropy, from all texts that may be learned from,
    by models that have not seen them."""
    judged = _judged(documents, others)
    if judged is None or judged.isEmpty():
        return
    # Newton's steps; one imagined right and one wrong answer keep the slope finite. Sums of decimals
    # do not depend on the order of rows.
    x, y, w = np.array([[1.0, 1.0], [0.0, 1.0]]), np.array([1.0, 0.0]), np.zeros(2)
    for _ in range(50):
        logit = F.lit(float(w[0])) * F.col("margin") + F.lit(float(w[1]))
        p = 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))
        rows = judged.select("margin", (p * (1 - p)).alias("v"), (F.col("right") - p).alias("off"))
        terms = ("margin * margin * v", "margin * v", "v", "margin * off", "off")
        sums = rows.selectExpr(*(f"CAST(sum(CAST({t} AS DECIMAL(28, 15))) AS DOUBLE)" for t in terms)).first()
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        hessian += np.array([[sums[0], sums[1]], [sums[1], sums[2]]])
        gradient = x.T @ (y - p) - 1e-3 * w + np.array([sums[3], sums[4]])
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    fitted.slope, fitted.offset = float(max(w[0], 0.0)), float(w[1])
    fitted.usual = _quantile(judged.select(F.col("least").alias("value")), USUAL)


def _quantile(values: DataFrame, share: float) -> float:
    """The exact quantile of the column ``value``, between the two nearest where it falls between them."""
    n, low, high = values.selectExpr("count(value)", "min(value)", "max(value)").first()
    place = (n - 1) * share
    before = rank = int(place)
    while low < high:  # the range that holds the rank, in ever smaller ones
        at = (F.col("value") - F.lit(low)) / F.lit(high - low) * RANGES
        ranges = values.where(F.col("value").between(low, high)).groupBy(
            F.least(F.floor(at), F.lit(RANGES - 1)).alias("at")
        )
        counted = ranges.agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        for row in counted.orderBy("at").collect():
            if before < row.n:
                low, high = row.low, row.high
                break
            before -= row.n
    over, above = values.selectExpr(f"count_if(value <= {low!r}D)", f"min(value) FILTER (WHERE value > {low!r}D)").first()
    if over > rank + 1 or above is None:
        return low
    return low + (place - rank) * (above - low)


def identify(documents: DataFrame, fitted: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy and rejected for every row.

    A text that is null or has no letter is ``und`` with score 0, and rejected; so is every text if
    nothing could be learned. Of equally likely languages the first by code point wins. A null id is
    not held out, and not learned from either. Rows are judged one by one: repeated rows get equal
    results, further columns change nothing, an empty table gives an empty result.
    """
    names, slope, offset, usual = fitted.names, fitted.slope, fitted.offset, fitted.usual
    margins = Languages(names, [], np.empty(0, np.uint64), np.empty((0, 0))).margins
    rows = documents.select(
        "doc_id",
        F.expr("coalesce(crc32(CAST(doc_id AS STRING)) % 3 = 1, false)").alias("held_out"),
        "text",
    )

    def work(part):
        lengths = part.column("n").to_numpy()
        known = (lengths > 0) & bool(names)
        entropies = _matrix(part, names) if names else np.zeros((part.num_rows, 1))
        best, least = entropies.argmin(axis=1), entropies.min(axis=1)
        found = [names[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        margin = np.minimum(margins(entropies, lengths), SUREST)
        score = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        score = np.where(known, score, 0.0)
        rejected = (score < 0.5) | (least > usual)
        return part.column("doc_id"), part.column("held_out"), found, score, least, rejected

    ddl = (
        "doc_id long, held_out boolean, lang_pred string, score double, entropy double,"
        " rejected boolean"
    )
    return map_rows(_entropies(rows, fitted, "doc_id long, held_out boolean"), ddl, work)
