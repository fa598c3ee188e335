import random
import re

import numpy as np
from cases import ROWS, documents, empty, given
from pyspark.sql import functions as F

from tripkpi.llm import minhash
from tripkpi.llm.components import components


def shingle_set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [
        (i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets
    ]


def result(table):
    return sorted(str(tuple(r)) for r in minhash.near_duplicates(table).collect())


def test_equals_brute_force(spark):
    for table in (documents(spark), given(spark, "documents")):
        rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
        assert result(table) == sorted(map(str, brute(rows)))
    assert minhash.near_duplicates(documents(spark)).count() == len(ROWS)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_clouds_and_chains_lose_no_link(spark):
    """Copies that drift away from each other: links at the border, chains, several components."""
    random.seed(5)
    rows, words = [], [f"w{i}" for i in range(120)]
    for i in range(150):
        if i % 40 == 0:
            words = [f"w{random.randint(0, 10**6)}" for _ in range(120)]
        words = list(words)
        for _ in range(random.randint(0, 3)):
            words[random.randrange(len(words))] = f"x{random.randint(0, 10**6)}"
        rows.append((i, " ".join(words), "en", "s"))
    random.shuffle(rows)
    want = sorted(map(str, brute([r[:2] for r in rows])))
    assert result(documents(spark, rows)) == want


def test_sketches_never_overstate():
    random_ = np.random.default_rng(2)
    for size, lost in ((40, 5), (300, 43), (1000, 142)):
        a = np.unique(minhash.mix(random_.integers(0, 1 << 62, size).astype(np.uint64)))
        b = np.concatenate([a[lost:], minhash.mix(np.arange(lost).astype(np.uint64))])
        sketches = [minhash.signature(x)[1].view(np.uint64) for x in (a, np.unique(b))]
        assert np.bitwise_count(sketches[0] ^ sketches[1]).sum() <= 2 * lost


def test_one_of_each_group_stays(spark):
    table = documents(spark)
    kept = minhash.without_near_duplicates(table)
    assert kept.columns == table.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").where("doc_id IS NOT NULL").collect())
    assert set(ids) == {1, 2, 3, 4, 5, 7, 8}
    assert kept.where("doc_id IS NULL").count() == 2


def test_components_of_a_long_chain_and_a_star(spark):
    chain = spark.range(0, 300).selectExpr("id + 1 AS u", "id AS v")
    star = spark.range(1001, 1400).selectExpr("1000L AS u", "id AS v")
    got = components(chain.union(star).union(star)).groupBy("component").agg(F.count("*").alias("n"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 301), (1000, 400)]
    assert components(chain.limit(0)).count() == 0
