import numpy as np
from cases import ROWS, documents, empty, given

from tripkpi.llm import language


def test_probabilities_add_up():
    data = np.frombuffer(language.units("abab abc ba"), np.uint16)
    grams, counts = np.unique(language.keys(data), return_counts=True)
    letters = sorted(set(data.tolist()))
    model = language.KneserNey(grams, counts, len(letters))
    for text in ("aba", "zzz", " ab"):
        head = 0
        for c in text:
            head = head << 16 | ord(c)
        total = model.probability(np.array([head << 16 | c for c in letters], np.uint64)).sum()
        assert abs(total - 1) < 1e-9


def test_kneser_ney_by_hand():
    """Last order: counts less the discount, and what is left over by kinds of continuation."""
    gram = lambda t: sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(t))
    model = language.KneserNey(
        np.array([gram("aaab"), gram("aaac")], np.uint64), np.array([3, 1]), 10
    )
    lower = model.probability(np.array([gram("xaab")], np.uint64))[0]  # an unseen context: order 3
    got = model.probability(np.array([gram("aaab")], np.uint64))[0]
    assert abs(got - ((3 - 0.75) / 4 + 0.75 * 2 / 4 * lower)) < 1e-12


def test_held_out_accuracy(spark):
    table = given(spark, "documents", "sf0.1")
    fitted = language.fit(table)
    assert fitted.names == ["de", "en", "es", "fr"]
    got = language.identify(table, fitted).where("held_out")
    rows = got.join(table.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 3000
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)
    wrong = [r.score for r in rows if r.lang != r.lang_pred]
    assert np.mean(wrong) < np.mean([r.score for r in rows])
    # Calibrated on texts that the models had not seen, so scores are as sure as they are right.
    assert abs(np.mean([r.score for r in rows]) - np.mean([r.lang == r.lang_pred for r in rows])) < 0.01
    foreign = spark.createDataFrame([(1, "Ελληνικά και ξένα γράμματα μόνο")], "doc_id long, text string")
    assert language.identify(foreign, fitted).first().rejected


def test_rows_of_all_kinds(spark):
    table = documents(spark)
    fitted = language.fit(table)
    got = language.identify(table, fitted).collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.doc_id in (2, 3, 4):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert r.lang_pred in (*fitted.names, "und")
        assert r.doc_id is not None or r.held_out is False
    assert language.identify(empty(spark), fitted).count() == 0
    none = language.fit(empty(spark))
    assert {r.lang_pred for r in language.identify(table, none).collect()} == {"und"}


def test_nothing_but_the_text_decides(spark):
    table = given(spark, "documents")
    fitted = language.fit(table)
    other = table.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source")
    key = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in df.collect())
    assert key(language.identify(table, fitted)) == key(language.identify(other, fitted))


def test_no_gram_is_left_out_however_few_are_broadcast(spark):
    table = given(spark, "documents").select("doc_id", "text", "lang")
    table = table.union(documents(spark).select("doc_id", "text", "lang"))
    whole = language.fit(table)
    few = language.fit(table, 2_000)
    assert len(few.grams) < len(whole.grams) / 10
    assert abs(few.slope - whole.slope) < 1e-6 and abs(few.usual - whole.usual) < 1e-5
    key = lambda r: (r.doc_id is None, r.doc_id, r.entropy)
    a, b = (sorted(language.identify(table, x).collect(), key=key) for x in (whole, few))
    assert len(a) == len(b) == table.count()
    for x, y in zip(a, b, strict=True):
        assert (x.doc_id, x.lang_pred, x.rejected, x.held_out) == (y.doc_id, y.lang_pred, y.rejected, y.held_out)
        assert abs(x.entropy - y.entropy) < 1e-5 and abs(x.score - y.score) < 1e-6


def test_calibrating_texts_count_for_the_models_that_predict_only(spark):
    table = given(spark, "documents")
    counts = language.gram_counts(table)
    of = lambda kind: {(r.lang, r.gram): r.n for r in kind.collect()}
    whole, rest = of(counts.drop("rest")), of(counts.where("rest > 0").selectExpr("lang", "gram", "rest AS n"))
    held = table.where(language.CALIBRATING)
    only = of(language.gram_counts(held).drop("rest"))
    assert only and language.gram_counts(held).where("rest > 0").count() == 0
    assert all(whole[g] == rest.get(g, 0) + only.get(g, 0) for g in whole)


def test_all_texts_calibrate_the_score_whatever_their_number(spark, monkeypatch):
    """The fit over each text of the table, judged by models of the folds that it is not in."""
    table = given(spark, "documents", "sf0.1").select("doc_id", "text", "lang")
    judged, kept = language._judged, []
    monkeypatch.setattr(language, "_judged", lambda *a: kept.append(judged(*a)) or kept[0])
    fitted = language.fit(table)
    rows = kept[0].toPandas()
    letters = [t for t in language.learned_from(table).toPandas()["text"] if language.units(t)]
    assert len(rows) == len(letters) > 3_000
    assert abs(fitted.usual - np.quantile(rows["least"], language.USUAL)) < 1e-12
    x = np.column_stack([np.r_[rows["margin"], 1.0, 0.0], np.ones(len(rows) + 2)])
    y, w = np.r_[rows["right"], 1.0, 0.0], np.array([fitted.slope, fitted.offset])
    gradient = x.T @ (y - 1 / (1 + np.exp(-x @ w))) - 1e-3 * w
    assert np.abs(gradient).max() < 1e-6 and rows["right"].mean() > 0.99


def test_no_text_is_judged_by_a_model_that_has_seen_it(spark):
    table = given(spark, "documents")
    counts = language.gram_counts(table)
    for fold, rest in enumerate(language._rests()):
        others = language.gram_counts(table.where(f"{language.FOLD} <> {fold}")).select("lang", "gram", "n")
        kept = counts.where(f"{rest} > 0").selectExpr("lang", "gram", f"{rest} AS n")
        assert others.count() == kept.count() and kept.exceptAll(others).isEmpty()


def test_quantile_is_exact(spark):
    for values in ([3.0], [1.0] * 5, [2.0, -1.0], [1e300, -1e300, 0.0], [i * i / 7 for i in range(5_000)]):
        frame = spark.createDataFrame([(v,) for v in values], "value double")
        for share in (0.0, 0.5, 0.999, 1.0):
            assert np.isclose(language._quantile(frame, share), np.quantile(values, share), rtol=1e-12)


def test_entropies_equal_a_plain_scorer(spark):
    """Each text's letters one by one, against the table's results."""
    table = given(spark, "documents")
    fitted = language.fit(table)
    got = {r.doc_id: r for r in language.identify(table, fitted).collect()}
    for row in table.limit(60).collect():
        plain = language.OTHER.sub(" ", (row.text or "").lower()).strip()
        if not plain:
            assert got[row.doc_id].lang_pred == "und"
            continue
        chars = np.frombuffer(f"   {plain} ".encode("utf-16-le"), np.uint16).tolist()
        grams = [sum(c << 16 * (3 - j) for j, c in enumerate(chars[i : i + 4])) for i in range(len(chars) - 3)]
        sums = [-np.log(m.probability(np.array(grams, np.uint64))).sum() / len(grams) for m in fitted.models]
        assert abs(got[row.doc_id].entropy - min(sums)) < 1e-5
        assert got[row.doc_id].lang_pred == fitted.names[int(np.argmin(sums))]
