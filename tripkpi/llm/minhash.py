"""Near-duplicate documents by MinHash, odd sketches and exact confirmation.

* A document's set are the hashes of its distinct five-word shingles. Documents with equal sets are
  one node from here on, so exact copies cost nothing however many there are.
* 176 MinHash samples of a set make 44 bands of four. Two sets with similarity 0.75 share no band
  with a chance of (1 - 0.75^4)^44 < 6e-8.
* For verification, samples are folded into an odd sketch, 2048 parity bits: each sample flips one.
  Samples are the elements that come least in one more permutation: all of a set of up to 1024, and
  of larger ones the share (a half, a quarter, ...) that brings them below that. The sketches of two
  sets differ in bits that samples outside their common part have flipped, so the population count of
  their XOR tells how far apart the sets are, precisely where they are close, and never too much.
* Within a band's bucket, members are paired with the bucket's least node only. Pairs whose sketches
  differ by more than sets of similarity 0.75 can (where only a share is sampled, by six standard
  deviations more) are dropped, the others confirmed on the full sets. Links so found make components.
* Members of a bucket that are in one component by then need no further comparison, whatever their
  number. In a bucket with more components, members outside the least node's component are paired
  with all members of other components, under the same bound for sketches. So no link between
  components is left out, and a large group of copies never becomes a square number of pairs.
"""

from __future__ import annotations

import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.common import WORD, map_rows, written
from tripkpi.llm.components import components

SHINGLE = 5
PER_CENT = 75
BANDS, BAND_ROWS = 44, 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 2_048
SKETCH_SAMPLES = 1_024
LANES = SKETCH_BITS // 64

WORDS = re.compile(WORD.encode())
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
CACHED_WORDS = 300_000
CACHED_SET_BYTES = 64 * 1024 * 1024
CHUNK = 4_096

_random = np.random.Generator(np.random.PCG64(20_240_105))
MULTIPLIERS = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
PLACES = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted sets of shingle hashes."""

    def __init__(self):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest
        self.words: dict[bytes, int] = {}

    def word_hashes(self, text: str) -> np.ndarray:
        words, known = WORDS.findall(text.encode().translate(LOWER)), self.words
        out = np.empty(len(words), np.uint64)
        if len(known) > CACHED_WORDS:
            known.clear()
        get, digest = known.get, self.hash
        for i, word in enumerate(words):
            value = get(word)
            if value is None:
                value = digest(word)
                known[word] = value
            out[i] = value
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        hashes = self.word_hashes(text) if text else np.empty(0, np.uint64)
        if not len(hashes):
            return hashes
        n = max(1, len(hashes) - SHINGLE + 1)
        total = np.full(n, min(len(hashes), SHINGLE), np.uint64)
        for j in range(min(len(hashes), SHINGLE)):
            total += mix(hashes[j : j + n]) * PLACES[j]
        return np.unique(mix(total))


def samples(shingles: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that is not empty."""
    least = np.full(SAMPLES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), CHUNK):
        part = shingles[None, at : at + CHUNK] * MULTIPLIERS[:, None]
        part ^= OFFSETS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def level(size: int) -> int:
    """How often the set is halved before it is sketched."""
    return max(0, size - 1).bit_length() - min(10, max(0, size - 1).bit_length())


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketch of a set, as 64-bit integers."""
    least = mix(samples(shingles) + np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rows = least.reshape(BANDS, BAND_ROWS)
    bands = np.arange(BANDS, dtype=np.uint64)
    for j in range(BAND_ROWS):
        bands = mix(bands ^ rows[:, j])
    place = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    halved = level(len(shingles))
    if halved:
        place = place[place < np.uint64(1 << (64 - halved))]
    parity = np.bincount(mix(place) % np.uint64(SKETCH_BITS), minlength=SKETCH_BITS) & 1
    sketch = np.packbits(parity.astype(np.uint8)).view(np.uint64)
    return bands.view(np.int64), sketch.view(np.int64)


def describe(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two digests of the set, and level, bands and sketch (null if it is empty)."""

    def make():
        shingler = Shingler()

        def work(part):
            n, first, second, levels, bands, sketches = [], [], [], [], [], []
            for text in part.column("text").to_pylist():
                shingles = shingler(text)
                n.append(len(shingles))
                first.append(int(shingles.sum().view(np.int64)) if len(shingles) else 0)
                second.append(int(mix(~shingles).sum().view(np.int64)) if len(shingles) else 0)
                b, s = signature(shingles) if len(shingles) else (None, None)
                levels.append(level(len(shingles)))
                bands.append(b)
                sketches.append(s)
            return part.column("doc_id"), n, first, second, levels, bands, sketches

        return work

    ddl = (
        "doc_id long, n_shingles long, digest1 long, digest2 long, level int, bands array<long>,"
        " sketch array<long>"
    )
    return map_rows(documents.select("doc_id", "text"), ddl, None, text="text", make=make)


def _close(left: str, right: str) -> str:
    """SQL for pairs that sizes and sketches leave possible.

    Sets with similarity p / 100 differ in (100 - p) / (100 + p) of the sum of their sizes. Sets that
    are halved a different number of times are left to confirmation.
    """
    differ = " + ".join(f"bit_count({left}s{i} ^ {right}s{i})" for i in range(LANES))
    most = (
        f"(({left}n + {right}n) * {100 - PER_CENT} / {100 + PER_CENT} / shiftleft(1L, {left}level))"
    )
    return (
        f"100 * least({left}n, {right}n) >= {PER_CENT} * greatest({left}n, {right}n)"
        f" AND ({left}level <> {right}level"
        f" OR {differ} <= {most} + IF({left}level = 0, 0D, 6 * sqrt({most})))"
    )


def confirm(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs (u, v) of ids whose full sets are similar enough."""
    # Both joins deal the texts out by id, so they are shuffled once.
    texts = documents.select("doc_id", "text").where("doc_id IS NOT NULL")
    left = texts.toDF("left_id", "left_text")
    right = texts.toDF("right_id", "right_text")
    joined = pairs.join(left, pairs.v == left.left_id).select("u", "v", "left_text")
    joined = joined.join(right, joined.u == right.right_id).select("u", "v", "right_text", "left_text")

    def make():
        shingler, sets = Shingler(), OrderedDict()

        size = 0

        def shingles(text):  # one document may be in many pairs
            nonlocal size
            found = sets.get(text)
            if found is None:
                found = sets[text] = shingler(text)
                size += found.nbytes + 2 * len(text)
                while size > CACHED_SET_BYTES:
                    old, gone = sets.popitem(last=False)
                    size -= gone.nbytes + 2 * len(old)
            return found

        def work(part):
            keep = []
            for a, b in zip(
                part.column("right_text").to_pylist(),
                part.column("left_text").to_pylist(),
                strict=True,
            ):
                a, b = shingles(a), shingles(b)
                common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                union = len(a) + len(b) - common
                keep.append(union > 0 and 100 * common >= PER_CENT * union)
            kept = part.filter(pa.array(keep, pa.bool_()))
            return kept.column("u"), kept.column("v")

        return work

    return map_rows(joined, "u long, v long", None, text="left_text", make=make)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row.

    A text that is null or has no words has an empty set and is linked with nothing. Rows with equal
    ids are parts of one document, linked with each other; each keeps its own n_shingles. A row with
    a null id cannot be linked: its component is null and it is kept. Further columns change nothing.
    An empty table gives an empty result.
    """
    described = written(describe(documents), "shingle-sets")
    filled = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # One node for equal sets, named by the smallest id that has it.
    nodes = written(
        filled.groupBy("digest1", "digest2", "n_shingles").agg(
            F.min("doc_id").alias("id"),
            F.first("level").alias("level"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    lanes = [F.col("sketch")[i].alias(f"s{i}") for i in range(LANES)]
    named = ["n", "level", *(f"s{i}" for i in range(LANES))]
    sketches = nodes.select("id", F.col("n_shingles").alias("n"), "level", *lanes)

    def sketched(pairs: DataFrame) -> DataFrame:
        """The pairs that sizes and sketches leave possible."""
        left = sketches.select(F.col("id").alias("id1"), *[F.col(c).alias("a" + c) for c in named])
        right = sketches.select(F.col("id").alias("id2"), *[F.col(c).alias("b" + c) for c in named])
        return (
            pairs.join(left, pairs.v == left.id1)
            .join(right, F.col("u") == right.id2)
            .where(_close("a", "b"))
            .select("u", "v")
            .distinct()
        )

    buckets = nodes.select(F.explode("bands").alias("band"), "id")
    shared = written(
        buckets.groupBy("band")
        .agg(F.min("id").alias("center"), F.max("id").alias("last"))
        .where("center <> last")
        .select(F.col("band").alias("shared_band"), "center"),
        "buckets",
    )
    grouped = written(
        buckets.join(shared, buckets.band == shared.shared_band).select("band", "center", "id"),
        "members",
    )
    stars = grouped.where("id <> center").select(F.col("center").alias("u"), F.col("id").alias("v"))
    links = written(confirm(sketched(stars.distinct()), documents), "confirmed")
    # Rows of one id with different sets.
    own = (
        filled.join(
            nodes.select("digest1", "digest2", "n_shingles", "id"),
            ["digest1", "digest2", "n_shingles"],
        )
        .select("doc_id", "id", "digest1", "digest2", "n_shingles")
    )
    same_id = own.where("doc_id <> id").select(F.col("id").alias("u"), F.col("doc_id").alias("v"))
    first = components(links.union(same_id))

    # What the stars have left open.
    placed = (
        grouped.join(first, grouped.id == first.node, "left")
        .select("band", "center", "id", F.coalesce("component", "id").alias("component"))
    )
    open_bands = (
        placed.groupBy("band", "center")
        .agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
        .where("c1 <> c2")
        .select(F.col("band").alias("open_band"))
    )
    still = placed.join(open_bands, placed.band == open_bands.open_band, "left_semi")
    still = written(
        still.join(sketches.withColumnRenamed("id", "sid"), still.id == F.col("sid")).drop("sid"),
        "open",
    )
    centers = still.where("id = center").select(
        F.col("band").alias("cb"), F.col("component").alias("center_component")
    )
    outside = (
        still.join(centers, still.band == centers.cb)
        .where("component <> center_component")
        .select(
            F.col("band").alias("band2"), F.col("id").alias("v"), F.col("component").alias("component2"),
            F.col("center_component").alias("cc"), *[F.col(c).alias("b" + c) for c in named],
        )
    )
    inside = still.select(
        "band", F.col("id").alias("u"), "component", "center",
        *[F.col(c).alias("a" + c) for c in named],
    )
    # A pair of outsiders comes up once; the least node has been compared with all already.
    rest = (
        inside.join(
            outside,
            (inside.band == outside.band2)
            & (inside.component != outside.component2)
            & (inside.u != inside.center)
            & ((inside.component == outside.cc) | (inside.u < outside.v))
            & F.expr(_close("a", "b")),
        )
        .select("u", "v")
        .distinct()
    )
    more = written(confirm(rest, documents), "confirmed")
    found = written(components(links.union(same_id).union(more)), "components") if not more.isEmpty() else first

    of_sets = (
        nodes.join(found, nodes.id == found.node, "left")
        .select(
            F.col("digest1").alias("d1"), F.col("digest2").alias("d2"),
            F.col("n_shingles").alias("n"), F.coalesce("component", "id").alias("component"),
        )
    )
    return described.select("doc_id", "n_shingles", "digest1", "digest2").join(
        of_sets,
        (F.col("digest1") == of_sets.d1)
        & (F.col("digest2") == of_sets.d2)
        & (F.col("n_shingles") == of_sets.n),
        "left",
    ).select(
        "doc_id", "n_shingles",
        F.expr("IF(doc_id IS NULL, NULL, coalesce(component, doc_id))").alias("component_id"),
        F.expr("coalesce(doc_id = coalesce(component, doc_id), true)").alias("kept"),
    )


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """``documents`` without those of which a near duplicate with a smaller id is there.

    Rows with equal ids are one document and stay or go together.
    """
    kept = near_duplicates(documents).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return documents.join(
        kept, documents["doc_id"].eqNullSafe(F.col("kept_id")), "left_semi"
    )
