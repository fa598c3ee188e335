import re

import numpy as np
from cases import ROWS, documents, empty, given

from tripkpi.llm import toxicity


def test_ordinal_fit_shares_weights_and_orders_thresholds():
    random = np.random.default_rng(1)
    x = (random.random((4000, 5)) < 0.3).astype(float)
    latent = x @ np.array([2.0, 1.0, 0, 0, -1]) + random.logistic(size=4000)
    grades = np.digitize(latent, [0.5, 1.5, 3.0])
    rows, columns = np.nonzero(x)
    weights, thresholds = toxicity.fit_ordinal(rows, columns, x[rows, columns], grades, 5)
    assert np.allclose(thresholds, [0.5, 1.5, 3.0], atol=0.25)
    assert np.allclose(weights, [2, 1, 0, 0, -1], atol=0.25)


def test_labelled_documents_are_told_apart(spark):
    texts, labels = given(spark, "documents", "sf0.1"), given(spark, "labels", "sf0.1")
    learn = labels.where("crc32(CAST(doc_id AS STRING)) % 3 <> 1")
    model = toxicity.fit(texts, learn)
    held = labels.where("crc32(CAST(doc_id AS STRING)) % 3 = 1")
    got = toxicity.score(texts, model).join(held.withColumnRenamed("toxic", "label"), "doc_id").collect()
    caught = [r.toxic for r in got if r.label == 1]
    clean = [r.kept for r in got if r.label == 0]
    assert sum(caught) / len(caught) > 0.8
    assert sum(clean) / len(clean) > 0.995
    for r in got:
        assert 0 <= r.severity <= 3 and r.toxic == (r.p_toxic >= 0.5) and r.kept != r.toxic


def test_scores_are_those_of_a_plain_loop(spark):
    texts, labels = given(spark, "documents", "sf0.01"), given(spark, "labels", "sf0.01")
    model = toxicity.fit(texts, labels)
    got = {r.doc_id: r for r in toxicity.score(texts, model).collect()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for row in texts.collect():
        words = re.findall(r"[^\W\d_]+", (row.text or "").lower())
        total = 0.0
        for feature, j in model.index.items():
            kind, name = feature[0], feature[1:]
            n = sum(w == name if kind == "=" else w[: len(name)] == name for w in words)
            total += model.weights[j] * np.log2(1 + 200 * n / max(len(words), 1))
        chances = sigmoid(total - model.thresholds)
        r = got[row.doc_id]
        assert np.isclose(r.severity, chances.sum()) and np.isclose(r.p_toxic, chances[0])
        bounds = np.array([1, *chances]) - np.array([*chances, 0])
        assert r.grade == np.argmax(bounds) and r.kept == (r.p_toxic < 0.5)


def test_rows_of_all_kinds(spark):
    labels = spark.createDataFrame(
        [(1, None, 1), (5, 1, 0), (5, 1, None), (None, 1, 1), (7, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = toxicity.fit(documents(spark), labels)
    got = toxicity.score(documents(spark), model)
    assert got.count() == len(ROWS)
    assert got.where("severity IS NULL OR kept IS NULL").count() == 0
    assert toxicity.score(empty(spark), model).count() == 0
    nothing = toxicity.fit(empty(spark), labels.limit(0))
    assert toxicity.score(documents(spark), nothing).where("toxic").count() == 0
    kept = toxicity.score(documents(spark), nothing, keep=True)
    assert kept.columns == documents(spark).columns
    assert kept.count() == len(ROWS)
