import os

import corpus_pipeline
import duckdb
import pytest
from cases import documents, empty

from tripkpi.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = connection.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = queries.queries()[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, want.fetchall()))


def test_there_is_a_query_for_each_operator():
    numbers = {n.split("_")[0] for n in queries.queries() if n.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in queries.queries()


def test_pipeline_is_its_stages(spark):
    from tripkpi.llm import minhash, mixing, suffixes, toxicity

    documents_ = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    clean = toxicity.score(documents_, toxicity.fit(documents_, labels), keep=True)
    alone = minhash.without_near_duplicates(clean)
    unique = suffixes.without_repeats(alone)
    mixed = mixing.mixed_documents(unique)
    assert clean.count() >= alone.count() == unique.count() > 0
    want = sorted((r.doc_id, len(r.text.encode())) for r in mixed.collect())
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.n_bytes) for r in got) == want
    assert all(r.round_trip for r in got)


def test_stages_take_rows_of_all_kinds(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for start in (documents(spark), empty(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = str(tmp_path / f"{name}-{os.urandom(4).hex()}")
            stage(spark, docs, str(tmp_path)).write.parquet(out)
            docs = spark.read.parquet(out)
            if name != "sentencepiece":
                assert docs.columns == start.columns
        assert docs.count() == 0 if start.count() == 0 else docs.count() > 0
