import random
import re

import numpy as np
import pytest
import xxhash
from cases import LONG, ROWS, documents, empty, given

from tripkpi.llm import simhash


def plain_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Rows (id, fingerprint) to (id, hex, component)."""
    prints = np.array([p for _, p in rows], np.uint64)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 4):
            parent[root(i)] = root(int(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(root(i))) for i, (d, p) in enumerate(rows)]


def result(table):
    return sorted(str(tuple(r)) for r in simhash.near_duplicates(table).collect())


def test_rows_of_all_kinds_and_whole_table(spark):
    for table in (documents(spark), given(spark, "documents", "sf0.01")):
        rows = [(r.doc_id, plain_print(r.text)) for r in table.select("doc_id", "text").collect()]
        assert result(table) == sorted(map(str, brute(rows)))
    assert simhash.near_duplicates(documents(spark)).count() == len(ROWS)
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_fingerprints_of_texts_in_chunks(monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    for text in (None, "", " \t", "one", "One  two three", "one two three four", "É b C d e", LONG[:9000]):
        assert simhash.fingerprint(text) % 2**64 == plain_print(text)


def clouds():
    """Fingerprints around a few centres, up to 7 bits away: chains, dense and thin clouds."""
    random.seed(3)
    found = {0, 1, 2**64 - 1}
    for size, most in ((400, 2), (300, 5), (200, 7), (3, 4)):
        center = random.getrandbits(64)
        for _ in range(size):
            found.add(center ^ sum(1 << b for b in random.sample(range(64), random.randint(0, most))))
    drift = random.getrandbits(64)
    for _ in range(60):  # a chain whose ends have nothing in common
        drift ^= sum(1 << b for b in random.sample(range(64), random.choice((4, 5))))
        found.add(drift)
    return sorted(found)


def test_clouds_lose_no_link(spark):
    prints = clouds()
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    got = {r.node % 2**64: r.component for r in simhash.links(table).collect()}
    groups = {}
    for p, (_, _, c) in zip(prints, brute([(i, p) for i, p in enumerate(prints)])):
        groups.setdefault(c, set()).add(p)
    want = sorted(sorted(g) for g in groups.values() if len(g) > 1)
    have = {}
    for p, c in got.items():
        have.setdefault(c, set()).add(p)
    assert sorted(map(sorted, have.values())) == want
    assert len(want) > 3


def test_no_close_pair_is_discarded_or_kept_apart(spark):
    random_ = np.random.default_rng(4)
    a = random_.integers(0, 2**64, 2000, np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << random_.integers(0, 64, 2000).astype(np.uint64)
    other = random_.integers(0, 2**64, 2000, np.uint64)
    keys = [simhash.bucket_keys(simhash.block_distances(x)) for x in (a, b, other)]
    assert (keys[0] == keys[1]).any(axis=1).all()
    assert (keys[0] == keys[2]).any(axis=1).mean() < 0.01

    frame = spark.createDataFrame([(p,) for p in np.concatenate([a, b, other]).view(np.int64).tolist()], "print long")
    rows = simhash.with_distances(frame).collect()
    lanes = {r["print"]: np.array([r.near, r.far], np.int64).view(np.uint8).astype(int) for r in rows}
    near_a, near_b, near_o = (np.array([lanes[p] for p in x.view(np.int64).tolist()]) for x in (a, b, other))
    assert (near_a == np.bitwise_count(a[:, None] ^ simhash.OF_ALL[None])).all()
    assert (np.abs(near_a - near_b) <= 4).all()
    assert (np.abs(near_a - near_o).max(axis=1) <= 4).mean() < 0.02


def test_distances_of_a_block_tell_its_values_apart():
    for b in range(simhash.BLOCKS):
        low, high = 64 * b // simhash.BLOCKS, 64 * (b + 1) // simhash.BLOCKS
        values = np.arange(1 << (high - low), dtype=np.uint64) << np.uint64(low)
        local = simhash.block_distances(values)
        assert len(np.unique(local[:, b], axis=0)) == len(values)
