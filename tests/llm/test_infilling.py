import hashlib
import random
import re

import numpy as np
import pytest
from cases import LONG, ROWS, documents, empty, given
from hypothesis import given as given_text
from hypothesis import settings
from hypothesis import strategies as st

from tripkpi.llm import infilling

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_way(text, doc_id):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given_text(st.text(alphabet=st.sampled_from("abZ <>PSM.\n\té日𝄞"), max_size=120), st.integers(0, 10**6))
def test_equals_the_plain_way(text, doc_id):
    got = infilling.arrange(text, doc_id)
    assert got == plain_way(text, doc_id)
    assert infilling.restore(got[4], got[1]) == text


def test_all_ranks_are_found():
    for n in (1, 7, 8, 9, 1000, 20_000):
        widths = np.random.default_rng(n).integers(1, 12, n)
        lanes, ends = infilling.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
        for rank in {0, 1, n // 2, n - 1, n} | set(random.Random(n).sample(range(n + 1), min(n, 300))):
            assert lanes.place(rank) == ends[rank]
    assert infilling.SkipList(np.empty(0, np.int64)).place(0) == 0


def test_lanes_thin_out_and_keep_their_widths():
    lanes = infilling.SkipList(np.full(100_000, 3)).lanes
    assert len(lanes) > 5
    for (units, points, _), (above, points_above, places) in zip(lanes, lanes[1:]):
        assert len(above) < 0.6 * len(units) + 4
        assert units.sum() == above.sum() and points.sum() == points_above.sum()
        assert places[0] == 0


@pytest.mark.parametrize("chunk", [1, 2, 5])
def test_runs_go_on_over_chunks(monkeypatch, chunk):
    monkeypatch.setattr(infilling, "CHUNK", chunk)
    for text in ("abcdefgh", "ab cd  efg", "  ", "a", "é𝄞abé", ""):
        assert infilling.unit_widths(text).tolist() == [len(u) for u in UNITS.findall(text)]


def test_rows_of_all_kinds(spark):
    rows = [*ROWS, (11, "has <M> inside " * 9, "en", "s"), (12, "x<P y>S> <S " * 9, "en", "s"), (13, LONG * 3, "en", "s")]
    table = documents(spark, rows)
    out = infilling.infill(table)
    want = sorted(str((r[0], *plain_way(r[1], r[0]))) for r in rows)
    assert sorted(str(tuple(r)) for r in out.collect()) == want
    back = infilling.restored(out).collect()
    assert sorted(str(tuple(r)) for r in back) == sorted(str((r[0], r[1] or "")) for r in rows)
    assert infilling.digests(infilling.infill(empty(spark))).count() == 0


def test_whole_table(spark):
    table = given(spark, "documents")
    got = {r.doc_id: r for r in infilling.digests(infilling.infill(table)).collect()}
    forms = set()
    for row in table.collect():
        n, form, prefix, middle, out = plain_way(row.text, row.doc_id)
        forms.add(form)
        assert tuple(got[row.doc_id]) == (row.doc_id, n, form, prefix, middle, sha(out), sha(row.text or ""))
    assert forms == {"plain", "psm", "spm"}
