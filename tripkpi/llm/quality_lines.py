"""Quality of documents, line first: lines that fail a rule are removed, then documents that lose too
much of their text are rejected.

Rules for a line with words (a line without words is neither kept nor counted):

* punctuation: over 40 % of the characters of its words are neither letters nor digits, or at
  least half of its words (three or more) end in two or more of ``!?*#$%&``;
* navigation: it is made of three or more short parts between ``|``, ``>``, ``»``, ``·`` or ``•``;
* boilerplate: it has one of the phrases below, or equals an earlier line of the document and has
  fewer than 200 characters.

The document's verdict is to keep it if at least ``keep_share`` of the characters of its lines with
words remain. Before that, the base rules reject what has fewer than 50 words or repeats itself.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from tripkpi.llm.common import WORD, map_rows

KEEP_SHARE = 0.5
ODD_SHARE = 0.4
SHORT_PART = 30
SHORT_LINE = 200
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words

WORDS = re.compile(WORD)
ODD = re.compile(r"[\W_]")
MARKS = re.compile(r"[!?*#$%&]{2}")
PARTS = re.compile(r"[|>»·•]")
SHOUT = re.compile(r"[!?*#$%&]{2,}[.,;:]?$")
BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie|javascript"
    r"|click here|sign up|log ?in|subscribe|lorem ipsum|©|copyright",
    re.IGNORECASE,
)
# Characters that count as symbols (fixed values).
SYMBOLS = "[#*$%&|<>]"
_SYMBOL = re.compile(SYMBOLS)


def repeated_words(words: list[str]) -> int:
    """Words that lie in three-word windows found twice or more, the first ones included."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # Pairs first: two numbers below 2**31 fit into one integer, three might not.
    _, pairs = np.unique(ids[:-1] << 31 | ids[1:], return_inverse=True)
    _, windows, counts = np.unique(
        pairs[:-1].astype(np.int64) << 31 | ids[2:], return_inverse=True, return_counts=True
    )
    again = counts[windows] > 1
    covered = np.zeros(len(words), dtype=bool)
    for offset in range(3):
        covered[offset : offset + n] |= again
    return int(covered.sum())


def line_fails(line: str, words: list[str]) -> bool:
    """Whether one of the rules that look at nothing but the line removes it."""
    filled = "".join(words)
    if len(ODD.findall(filled)) > ODD_SHARE * len(filled):
        return True
    if len(words) >= 3 and MARKS.search(line):
        if 2 * sum(1 for w in words if SHOUT.search(w)) >= len(words):
            return True
    if len(line) > 2 and PARTS.search(line):
        parts = PARTS.split(line)
        if len(parts) >= 3 and max(len(p.strip()) for p in parts) <= SHORT_PART:
            return True
    return len(line) < SHORT_LINE and BOILERPLATE.search(line) is not None


def judge(text: str | None, keep_share: float = KEEP_SHARE) -> tuple:
    """The figures and flags of ``assess`` for one text."""
    text = text or ""
    all_words = WORDS.findall(text)
    seen: set[str] = set()
    duplicate = removed = chars = kept_chars = 0
    for line in text.split("\n"):
        words = WORDS.findall(line)
        if not words:
            continue
        chars += len(line)
        again = line in seen
        duplicate += again
        seen.add(line)
        if again and len(line) < SHORT_LINE or line_fails(line, words):
            removed += 1
        else:
            kept_chars += len(line)
    repeated = repeated_words(all_words)
    failed = len(all_words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(all_words)
    return (
        len(all_words),
        sum(map(len, all_words)),
        len(_SYMBOL.findall(text)),
        duplicate,
        repeated,
        failed,
        removed,
        chars,
        kept_chars,
        not failed and kept_chars >= keep_share * chars,
    )


def clean_text(text: str | None) -> str | None:
    """The text without the lines that fail; lines without words stay where they are."""
    if text is None:
        return None
    seen: set[str] = set()
    lines = []
    for line in text.split("\n"):
        words = WORDS.findall(line)
        again = bool(words) and line in seen
        if words:
            seen.add(line)
        if not words or not (again and len(line) < SHORT_LINE or line_fails(line, words)):
            lines.append(line)
    return "\n".join(lines)


def assess(documents: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed_lines, n_line_chars, n_kept_chars and kept for every row.

    A null text has no words: all figures 0, base_failed true, kept false. Rows are judged one by
    one and whole: repeated rows get equal results, null ids and further columns, whatever their
    names, change nothing, an empty table gives an empty result.
    """

    def work(part):
        judged = [judge(t, keep_share) for t in part.column("text").to_pylist()]
        return part.column("doc_id"), *(list(c) for c in zip(*judged, strict=True))

    ddl = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_repeat_words long, base_failed boolean, n_removed_lines long, n_line_chars long,"
        " n_kept_chars long, kept boolean"
    )
    return map_rows(documents.select("doc_id", "text"), ddl, work, text="text")


def clean(documents: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """doc_id and the cleaned text of the documents that are kept."""

    def work(part):
        ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
        kept = [i for i, t in enumerate(texts) if judge(t, keep_share)[-1]]
        return [ids[i] for i in kept], [clean_text(texts[i]) for i in kept]

    return map_rows(documents.select("doc_id", "text"), "doc_id long, text string", work, text="text")
