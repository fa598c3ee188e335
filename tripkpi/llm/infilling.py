"""Fill-in-the-middle: texts are cut at two units and put together anew around sentinels.

A text's units, runs of ASCII letters and single other characters, are the lowest lane of an indexable
skip list. Each node of a lane carries two widths: the units and the code points from it to the next
node of its lane. Lanes above hold the nodes whose number has enough trailing zeros once it is mixed,
a quarter of the lane below on average, with the widths below added up. A cut at rank k is found from
the highest lane's head: go right while the units that have been passed stay within k, else one lane
down. The code points passed on the way are the place of the cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from tripkpi.llm.common import map_rows

# Sentinels, and shares out of a hundred: fixed by the contract of the query.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20

# Each lane keeps a node of the lane below with a chance of 1 / 2**LANE_BITS.
LANE_BITS = 2
# Lanes stop below this many nodes.
SHORT_LANE = 8
# Code points that are looked at together while the lowest lane is built.
CHUNK = 1 << 20


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit, in order."""
    parts, open_letters = [], False
    for at in range(0, len(text), CHUNK):
        points = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le"), np.uint32)
        letters = (points | 32) - 97 < 26
        starts = np.ones(len(points), bool)
        starts[1:] = ~(letters[1:] & letters[:-1])
        starts[0] = not (open_letters and letters[0])
        places = np.flatnonzero(starts)
        if not starts[0]:  # the run that the chunk before has begun goes on
            parts[-1][-1] += places[0] if len(places) else len(points)
        if len(places):
            parts.append(np.diff(places, append=len(points)).astype(np.int64))
        open_letters = bool(letters[-1])
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _heights(n: int) -> np.ndarray:
    """How many lanes above the lowest each of n nodes is on; the head is on all of them."""
    x = np.arange(n, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    zeros = np.bitwise_count((x & -x) - np.uint64(1))
    heights = zeros // LANE_BITS
    if n:
        heights[0] = 64
    return heights


class SkipList:
    """Lanes of (units, code points, place on the lane below) over a text's units."""

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        self.lanes = [(np.ones(self.n, np.int64), widths, None)]
        heights, level = _heights(self.n), 0
        while len(heights) >= SHORT_LANE:
            level += 1
            places = np.flatnonzero(heights >= level)
            if len(places) == len(heights):
                break
            units, points, _ = self.lanes[-1]
            widths = np.add.reduceat(units, places), np.add.reduceat(points, places)
            # The end of this lane is the end of the one below.
            self.lanes.append((*widths, np.append(places, len(units))))
            heights = heights[places]

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank; all of them for the rank after the last."""
        passed, points, at = 0, 0, 0
        for units, widths, below in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed += int(units[at])
                points += int(widths[at])
                at += 1
            if below is not None:
                at = int(below[at])
        return points


def numbers(doc_id: int | None) -> list[int]:
    """Four 32-bit numbers that depend on nothing but the id; a null id counts as an empty one."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def arrange(text: str, doc_id: int | None) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the text put together anew."""
    lanes = SkipList(unit_widths(text))
    h1, h2, h3, h4 = numbers(doc_id)
    sentinels = any(s in text for s in (PREFIX, SUFFIX, MIDDLE))
    if not text or sentinels or h3 % 100 >= PLAIN_FROM:
        return lanes.n, "plain", None, None, text
    first, last = sorted((h1 % (lanes.n + 1), h2 % (lanes.n + 1)))
    a, b = lanes.place(first), lanes.place(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        form, out = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, out = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return lanes.n, form, a, b - a, out


def restore(out: str, form: str) -> str:
    """The text that ``arrange`` was given. No sentinel is in such a text, so each is found where it
    was put: none can begin in a part and end in the sentinel after it, nor the other way."""
    if form == "plain":
        return out
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at = out.index(second, len(first))
    to = out.index(MIDDLE, at + len(second))
    one, two, middle = out[len(first) : at], out[at + len(second) : to], out[to + len(MIDDLE) :]
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def infill(documents: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row.

    A text that is null counts as empty and stays plain, as does one that holds a sentinel. Rows are
    handled one by one: repeated rows get equal results, a null id is cut like an id without digits,
    further columns change nothing, an empty table gives an empty result. A text is held as a whole,
    with 16 bytes for each of its units.
    """

    def work(part):
        ids = part.column("doc_id").to_pylist()
        texts = part.column("text").to_pylist()
        rows = [arrange(text or "", doc_id) for text, doc_id in zip(texts, ids, strict=True)]
        return part.column("doc_id"), *zip(*rows, strict=True)

    ddl = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_rows(documents.select("doc_id", "text"), ddl, work, "text")


def restored(infilled: DataFrame) -> DataFrame:
    """doc_id and text of the rows of ``infill``, from output and form alone."""

    def work(part):
        pairs = zip(part.column("output").to_pylist(), part.column("form").to_pylist(), strict=True)
        return part.column("doc_id"), [restore(out, form) for out, form in pairs]

    return map_rows(infilled.select("doc_id", "output", "form"), "doc_id long, text string", work, "output")


def digests(infilled: DataFrame) -> DataFrame:
    """``infill`` with the hashes of output and rebuilt text in place of the output."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def work(part):
        outs, forms = part.column("output").to_pylist(), part.column("form").to_pylist()
        again = [sha(restore(out, form)) for out, form in zip(outs, forms, strict=True)]
        return *part.columns[:-1], [sha(out) for out in outs], again

    ddl = (
        "doc_id long, n long, form string, prefix_chars long, middle_chars long,"
        " output_sha256 string, restored_sha256 string"
    )
    return map_rows(infilled, ddl, work, "output")
