import hashlib
import itertools
import re
import zlib

import pytest
from cases import LONG, given
from hypothesis import given as given_rows
from hypothesis import settings
from hypothesis import strategies as st

from tripkpi.llm import dialogue

PATTERN = re.compile("(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")
NO_ROWS = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def by_all_edits(rows):
    """Cost, audit and repaired rows by trying all edits; ``rows`` are (role, text, fault)."""
    best = None

    def fits(initials):  # what a way may still become
        return re.fullmatch("s?(ua)*u?", initials)

    def go(i, cost, audit, initials, out, inserts):
        nonlocal best
        if not fits(initials) or (best and cost > best[0]):
            return
        if i == len(rows) and PATTERN.fullmatch(initials):
            found = (cost, audit, out)
            best = min(best, found) if best else found
        if inserts < 2:
            for role in ("user", "assistant"):
                go(i, cost + 5, audit + "I", initials + role[0], [*out, (role, "")], inserts + 1)
        if i == len(rows):
            return
        role, text, fault = rows[i]
        go(i + 1, cost + 2, audit + "D", initials, out, 0)
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            go(i + 1, cost + more, audit + "K", initials + (role[:1] or "?"), [*out, (role, text)], 0)
            for new in ("user", "assistant"):
                go(i + 1, cost + more + 1, audit + "R", initials + new[0], [*out, (new, text)], 0)

    go(0, 0, "", "", [], 0)
    return best


def after_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        damage = zlib.crc32(key.encode()) % 20
        if damage == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(damage, text)
        role = "user" if damage == 4 else role
        out += [(conv_id, turn, role, text)] * (2 if damage == 3 else 1)
    md5 = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], md5(r)))


def plain_way(rows):
    """Results of all conversations of the rows (conv_id, turn, role, text)."""
    results = {conv_id: NO_ROWS for conv_id, *_ in rows}
    for conv_id in results:
        own, seen, judged = after_damage([r for r in rows if r[0] == conv_id]), set(), []
        if not own:
            continue
        for _, _, role, text in own:
            found = WORD.findall(text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else ""
            seen.add((role, text))
            judged.append((role, text, fault or ("" if found[-1] in ".!?" else "truncated")))
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(judged)]
        counts = [sum(f == name for *_, f in judged) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        cost, audit, out = by_all_edits(judged)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        results[conv_id] = (gaps, *counts, illegal, cost, audit, sha)
    return results


def table(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = ("audit", "cost", "has_row", "digest", "damage", "copy", "n", "first", "initial", "fault")
    return frame.selectExpr(*[f"'x' AS {c}" for c in clash], "*", "1 AS later")


def result(frame):
    rows = dialogue.digests(frame).collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


KINDS = st.lists(
    st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.integers(0, 3)), max_size=7
)


@settings(max_examples=400, deadline=None)
@given_rows(KINDS)
def test_audit_is_the_least_of_the_cheapest(rows):
    names = ("", "blank", "duplicate", "truncated")
    kinds = bytes(dialogue.INITIALS.get(r[:1], dialogue.OTHER) * 4 + f for r, f in rows)
    cost, audit, out = by_all_edits([(r, f"t{i}", names[f]) for i, (r, f) in enumerate(rows)])
    assert dialogue.least_audit(kinds, dialogue.Table()) == (cost, audit)
    repair = dialogue.Repair(audit)
    got = [r for i, (role, _) in enumerate(rows) for r in repair.row(role, f"t{i}")] + repair.rest()
    assert got == out


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_blocks_change_nothing(monkeypatch, block):
    import random

    random.seed(block)
    for _ in range(60):
        kinds = bytes(random.choice((0, 4, 4, 8, 8, 12)) + random.choice((0, 0, 1, 2, 3)) for _ in range(150))
        whole = dialogue.least_audit(kinds, dialogue.Table())
        with monkeypatch.context() as patch:
            patch.setattr(dialogue, "BLOCK", block)
            assert dialogue.least_audit(kinds, dialogue.Table()) == whole


def test_a_long_conversation(monkeypatch):
    kinds = bytes([dialogue.U * 4, dialogue.A * 4, dialogue.U * 4 + 3, dialogue.U * 4 + 1] * 100_000)
    cost, audit = dialogue.least_audit(kinds, dialogue.Table())
    assert len(audit) == 400_000 and cost == 400_000 and set(audit) <= set("DIKR")


def test_rows_of_all_kinds(spark):
    rows = [
        (1, 0, "system", "Be good."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"),
        (2, 0, "user", None), (2, 1, None, "What?"), (2, None, "user", "first."), (2, 4, "user", "first."),
        (3, None, "user", "a."), (3, None, "user", "a."), (3, None, "assistant", "b."),
        (4, 7, "user", LONG + "."), (4, 9, "assistant", LONG), (4, 12, "tool", "x.\n"),
        (None, 1, "user", "Who?"), (None, None, "assistant", "Me.\n "), (None, 3, "", ""),
        (6, 2, "user", "same."), (6, 2, "user", "same."), (6, 2, "assistant", "same."), (6, 2, "user", "same"),
        (7, -(2**62), "user", "far."), (7, 2**62, "assistant", "away."),
    ] + [(c, t, ("user", "assistant")[t % 2], f"turn {t}" + ".!?"[t % 3]) for c in range(100, 260) for t in range(4)]
    rows += [(c, 0, "user", "alone.") for c in range(300, 360)]
    want = plain_way(rows)
    assert result(table(spark, rows)) == want
    assert NO_ROWS in want.values()
    assert result(table(spark, rows[:1]).limit(0)) == {}


def test_whole_table_and_repaired_rows(spark):
    frame = given(spark, "conversations", "sf0.01")
    want = plain_way([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])
    assert result(frame) == want
    lines = {}
    for r in sorted(dialogue.repair(frame).collect(), key=lambda r: (r.conv_id, r.turn)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv_id, found in want.items():
        joined = "\n".join(lines.get(conv_id, []))
        assert hashlib.sha256(joined.encode()).hexdigest() == found[-1]
