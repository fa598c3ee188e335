"""SimHash near duplicates, found through tables of Hamming distances to reference fingerprints.

A fingerprint's row in the table holds its distances to REFERENCES. Two fingerprints that differ in
few bits are about as far from every reference: a pair is discarded as soon as one coordinate differs
by more than it may, and what is left is verified by its bits.

One coordinate alone parts few pairs: unrelated fingerprints have distances to a reference that
differ by 4 or less six times out of ten, so sorting or cutting up the table by whole distances would
leave nearly all pairs. The references therefore come in two kinds. Those of a block are zero outside
it, so that their distances, less that to the zero fingerprint, tell about the block alone; at most
MOST blocks of a pair differ, so in all the others its distances are equal. Fingerprints with equal
distances in that many blocks share a bucket, one for each choice of blocks. References over all bits
then discard the pairs of a bucket.

Buckets are never paired out as a whole. First each of their members is compared with one, the least;
the links found make components. Buckets that then still hold several components have their members
compared with those outside the bucket's commonest component. A cloud of thousands of near copies is
one component by then and costs nothing. Only links come out of the joins, so no link is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.common import map_rows, written
from tripkpi.llm.components import components

WORDS, SEED, MOST = 4, 42, 4
# With 7 blocks of 9 or 10 bits a bucket goes by 3 of them: 35 buckets a fingerprint, 27 bits each.
BLOCKS = 7
WHOLE = 16
# Bytes of a text that are taken apart at a time, but for longer words.
CHUNK = 1 << 20

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _references() -> tuple[np.ndarray, np.ndarray]:
    """Those of each block (a row each) and those over all bits.

    A block's are its Walsh words: word j has the places i, counted from 1, with an odd number of bits
    in i & j. Their 15 distances tell any two values of a block of up to 15 bits apart.
    """
    ends = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
    blocks = [
        [
            sum(1 << place for i, place in enumerate(range(a, b), 1) if (i & j).bit_count() % 2)
            for j in range(1, 16)
        ]
        for a, b in zip(ends, ends[1:])
    ]
    whole = np.random.default_rng(11).integers(0, 2**64, WHOLE, np.uint64)
    return np.array(blocks, np.uint64), whole


OF_BLOCKS, OF_ALL = _references()
CHOICES = list(combinations(range(BLOCKS), BLOCKS - MOST))
_FACTORS = np.random.default_rng(12).integers(0, 2**63, (len(CHOICES), BLOCKS, 15)).astype(np.uint64) | np.uint64(1)


def shingle_hashes(text: str | None) -> Iterator[np.ndarray]:
    """XXH64 of the text's shingles, repeats included, some thousand at a time."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    data = (text or "").encode().translate(LOWER)
    before, at, seen = [], 0, False
    while at < len(data):
        gap = SPACE.search(data, at + CHUNK)
        to = gap.start() if gap else len(data)
        words = before + data[at:to].split()
        at, n = to, len(words) - WORDS + 1
        if n > 0:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])[:n]
            places = zip(starts.tolist(), ends[WORDS - 1 :].tolist())
            yield np.fromiter((digest(joined[a:b], SEED) for a, b in places), np.uint64, n)
            seen = True
        before = words[-(WORDS - 1) :]
    if before and not seen:
        yield np.array([digest(b" ".join(before), SEED)], np.uint64)


def fingerprint(text: str | None) -> int:
    """Bits that are set in more than half of the shingles' hashes; 0 for a text without words."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text):
        for i in range(0, len(hashes), 1 << 16):
            part = hashes[i : i + (1 << 16)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0]) if n else 0


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and its fingerprint as a signed integer, for every row."""

    def work(part):
        return part.column("doc_id"), [fingerprint(text) for text in part.column("text").to_pylist()]

    return map_rows(documents.select("doc_id", "text"), "doc_id long, print long", work, "text")


def block_distances(prints: np.ndarray) -> np.ndarray:
    """Distances of fingerprints to each block's references, less that to the zero fingerprint."""
    to_blocks = np.bitwise_count(prints[:, None, None] ^ OF_BLOCKS[None])
    return to_blocks.astype(np.int64) - np.bitwise_count(prints)[:, None, None]


def bucket_keys(local: np.ndarray) -> np.ndarray:
    """For each fingerprint and choice of blocks, a hash of its distances in these blocks."""
    keys = np.empty((len(local), len(CHOICES)), np.uint64)
    for c, chosen in enumerate(CHOICES):
        factors = _FACTORS[c, list(chosen)].reshape(-1)
        keys[:, c] = local[:, chosen].reshape(len(local), -1).astype(np.uint64) @ factors
    return keys


def bucket_rows(prints: DataFrame) -> DataFrame:
    """bucket and print: a row for each of a fingerprint's buckets."""

    def work(part):
        found = part.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
        keys = bucket_keys(block_distances(found))
        prints = np.repeat(found.view(np.int64), len(CHOICES))
        return pa.array(keys.reshape(-1).view(np.int64)), pa.array(prints)

    return map_rows(prints.select("print"), "bucket long, print long", work)


def with_distances(prints: DataFrame) -> DataFrame:
    """Rows with a fingerprint and its distances to OF_ALL, as the bytes of near and far."""
    signed = OF_ALL.view(np.int64).tolist()
    columns = {}
    for name, references in (("near", signed[:8]), ("far", signed[8:])):
        parts = [
            f"shiftleft(CAST(bit_count(print ^ CAST('{r}' AS BIGINT)) AS BIGINT), {8 * i})"
            for i, r in enumerate(references)
        ]
        columns[name] = F.expr(" | ".join(parts))
    return prints.withColumns(columns)


def _close(a: str, b: str) -> str:
    """SQL for pairs whose coordinates differ by MOST at most, and then their bits."""

    def coordinate(side: str, lanes: str, i: int) -> str:
        return f"(shiftright({side}{lanes}, {8 * i}) & 255)"

    parts = [
        f"abs({coordinate(a, lanes, i)} - {coordinate(b, lanes, i)}) <= {MOST}"
        for lanes in ("near", "far")
        for i in range(8)
    ]
    return " AND ".join([*parts, f"bit_count({a}print ^ {b}print) <= {MOST}"])


def _named(table: DataFrame, prefix: str) -> DataFrame:
    return table.toDF(*[prefix + c for c in table.columns])


def links(prints: DataFrame) -> DataFrame:
    """node and component of each fingerprint that differs from another in MOST bits or fewer; a
    component is named by its least fingerprint. ``prints`` has each fingerprint once."""
    buckets = written(bucket_rows(prints), "buckets")
    shared = buckets.groupBy("bucket").count().where("count > 1")
    # Written, so that the join deals out both of its sides and Spark can split a large bucket; and by
    # merging at every size, as shared buckets grow with the input.
    shared = written(shared.select(F.col("bucket").alias("shared")), "shared").hint("merge")
    shared = written(buckets.join(shared, F.col("bucket") == F.col("shared"), "left_semi"), "shared")
    least = shared.groupBy("bucket").agg(F.min("print").alias("center"))
    least = written(least.withColumnRenamed("bucket", "of_bucket"), "centers")
    members = written(
        with_distances(shared.join(least, shared.bucket == least.of_bucket).drop("of_bucket")),
        "distances",
    )
    centers = _named(members.where("print = center").select("bucket", "print", "near", "far"), "c_")
    stars = (
        members.where("print <> center")
        .join(centers, (F.col("bucket") == F.col("c_bucket")) & F.expr(_close("", "c_")))
        .select(F.col("center").alias("u"), F.col("print").alias("v"))
    )
    stars = written(stars.distinct(), "stars")
    first = written(components(stars), "components")

    # What the stars have left open.
    placed = written(
        members.join(first, members.print == first.node, "left").select(
            "bucket", "print", "near", "far", F.coalesce("component", "print").alias("component")
        ),
        "placed",
    )
    main = written(
        placed.groupBy("bucket", "component")
        .count()
        .groupBy("bucket")
        .agg(F.expr("max_by(component, count)").alias("main"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("bucket").alias("open_bucket"), "main"),
        "open-buckets",
    )
    still = written(placed.join(main, placed.bucket == main.open_bucket).drop("open_bucket"), "open")
    outside = _named(still.where("component <> main"), "o_")
    more = (
        still.join(
            outside,
            (F.col("bucket") == F.col("o_bucket"))
            & (F.col("component") != F.col("o_component"))
            # Two outsiders meet once.
            & F.expr("component = main OR print < o_print")
            & F.expr(_close("", "o_")),
        )
        .select(F.col("component").alias("u"), F.col("o_component").alias("v"))
        .distinct()
    )
    more = written(more, "more")
    return first if more.isEmpty() else written(components(stars.union(more)), "components")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row.

    A text that is null or has no words has fingerprint zero and is linked like any other. Rows with a
    null id are linked too and have the component of what they reach, null if no id is among it. Rows
    of one id are documents of their own that happen to share it. Further columns change nothing; an
    empty table gives an empty result.
    """
    described = written(fingerprints(documents), "fingerprints")
    prints = written(described.groupBy("print").agg(F.min("doc_id").alias("first_id")), "prints")
    linked = links(prints)
    ids = written(
        linked.join(prints, linked.node == prints.print)
        .groupBy("component")
        .agg(F.min("first_id").alias("least_id"))
        .withColumnRenamed("component", "named"),
        "least",
    )
    of_linked = linked.join(ids, linked.component == ids.named).select("node", "least_id")
    of_prints = written(
        prints.join(of_linked, prints.print == of_linked.node, "left").select(
            F.col("print").alias("found"),
            F.expr("IF(node IS NULL, first_id, least_id)").alias("component_id"),
        ),
        "of-prints",
    )
    return described.join(of_prints, described.print == of_prints.found).select(
        "doc_id", F.expr("lpad(lower(hex(print)), 16, '0')").alias("fingerprint"), "component_id"
    )
