import hashlib
import random

import numpy as np
import pytest
from cases import ROWS, documents, empty, given

from tripkpi.llm import suffixes


def brute(rows):
    """(doc_id, text) in order to (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(data[i : i + 100])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def in_order(table):
    rows = table.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    return [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))]


@pytest.mark.parametrize("frequent", [2, 64])
def test_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffixes, "FREQUENT", frequent)
    for table in (documents(spark, [r for r in ROWS if r[0] != 6]), given(spark, "documents")):
        got = [tuple(r) for r in suffixes.repeats(table).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(in_order(table))))


@pytest.mark.parametrize("frequent", [2, 64])
def test_shifted_and_periodic_passages(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffixes, "FREQUENT", frequent)
    random.seed(3)
    letters = lambda n: "".join(random.choice("abc é") for _ in range(n))
    passages = [letters(n) for n in (99, 100, 101, 130, 400)] + ["x" * 250, "xyz" * 90]
    rows = []
    for i in range(60):
        picks = [random.choice(passages) for _ in range(3)]
        cut = [p[random.randint(0, 40) :] for p in picks]
        rows.append((i, letters(random.randint(0, 60)).join(["", *cut, ""]), "en", "s"))
    table = documents(spark, rows)
    got = sorted(tuple(r) for r in suffixes.repeats(table).collect())
    assert got == brute([(r[0], r[1]) for r in rows])


def near_copies(n):
    """Texts that differ in two words each."""
    random.seed(5)
    words = ["".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(120)]
    rows = []
    for i in range(n):
        mine = list(words)
        mine[random.randrange(120)], mine[random.randrange(120)] = f"x{i}y", f"z{i}w"
        rows.append((i, " ".join(mine), "en", "s"))
    return rows


def test_strings_of_near_copies_are_made_once_and_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "FREQUENT", 2)
    plain, made, there = suffixes.map_rows, [], []

    def counted(df, ddl, function, text=None):
        if function.__name__ not in ("groups", "strings"):
            return plain(df, ddl, function, text=text)
        total = spark.sparkContext.accumulator(0)
        there.append(plain(df, ddl, function).count())
        made.append(total)

        def work(part):
            columns = function(part)
            total.add(len(columns[0]))
            return columns

        return plain(df, ddl, work)

    monkeypatch.setattr(suffixes, "map_rows", counted)
    for n in (40, 160):
        rows = near_copies(n)
        got = sorted(tuple(r) for r in suffixes.repeats(documents(spark, rows)).collect())
        assert got == brute([(r[0], r[1]) for r in rows])
    assert len(there) == 4 and min(there) > 0
    assert [total.value for total in made] == there  # once, not again for the join
    assert there[2] < 4.5 * there[0] and there[3] < 4.5 * there[1]


def test_extension_is_found_and_collisions_are_noticed():
    contexts = [b"abcdefgh" * 20, b"abcdefgh" * 12 + b"X" * 64, b"zzz"]
    sorter = suffixes.Sorter(contexts, np.zeros(3, np.int64))
    assert sorter.extension(0, 1) == 96
    assert sorter.sort(np.arange(3))[0] == [1, 0, 2]
    sorter._sums = [0] * len(sorter._sums)  # every hash agrees now
    assert sorter.extension(0, 1) == 96


def test_texts_without_repeats(spark):
    table = documents(spark)
    got = suffixes.without_repeats(table)
    assert got.columns == table.columns
    assert got.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in got.where("doc_id IN (1, 2, 3, 5, 6)").collect()}
    assert texts[1] == "a short text" and texts[2] is None and texts[3] == ""
    assert texts[5].startswith("word0") and len(texts[6]) < 200
    assert got.where("n_chars <> length(text)").count() == 0
    assert suffixes.repeats(empty(spark)).count() == 0
    assert suffixes.without_repeats(empty(spark)).count() == 0
