import re
from collections import Counter

from cases import ROWS, documents, empty, given

from tripkpi.llm import quality_lines


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in many for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_base_figures(spark):
    for table in (documents(spark), given(spark, "documents")):
        got = quality_lines.assess(table).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
        )
        want = [(r.doc_id, *brute(r.text)) for r in table.select("doc_id", "text").collect()]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert quality_lines.assess(documents(spark)).count() == len(ROWS)
    assert quality_lines.assess(empty(spark)).count() == 0


def test_line_rules():
    words = quality_lines.WORDS.findall
    for bad in ("### $$$ %%% &&&", "BUY!! NOW!! HERE!!", "Home | About | Contact", "All rights reserved."):
        assert quality_lines.line_fails(bad, words(bad)), bad
    for good in ("A plain sentence, with a comma.", "It costs $5 (or less)!", "a > b"):
        assert not quality_lines.line_fails(good, words(good)), good
    assert quality_lines.clean_text("keep this\nHome | About | Contact\n\nkeep this") == "keep this\n"
    assert quality_lines.clean_text(None) is None


def test_clean_documents_stay_and_junk_goes(spark):
    got = quality_lines.assess(given(spark, "documents", "sf0.1")).join(
        given(spark, "labels", "sf0.1"), "doc_id"
    ).where("NOT base_failed").groupBy("quality", "kept").count()
    counts = {(r.quality, r.kept): r["count"] for r in got.collect()}
    assert counts.get((1, False), 0) == 0
    assert counts[0, False] > 20 * counts.get((0, True), 0)
    kept = quality_lines.clean(given(spark, "documents"))
    assert 0 < kept.count() < 200
