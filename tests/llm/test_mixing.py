from cases import ROWS, documents, empty, given
from pyspark.sql import functions as F

from tripkpi.llm import mixing


def aimed(sizes, weights):
    """Targets by resharing what is above a source's room until nothing is."""
    total, open_, done = 1.5 * sum(sizes), set(range(len(sizes))), {}
    while True:
        left = total - sum(done.values())
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        full = [i for i in open_ if share[i] >= 2 * sizes[i]]
        if not full:
            return [done.get(i, share.get(i)) for i in range(len(sizes))]
        for i in full:
            done[i] = 2 * sizes[i]
            open_.discard(i)


def test_targets_are_shared_again_and_met(spark):
    table = given(spark, "documents", "sf0.01")
    got = mixing.mix(table).join(table.select("doc_id", "source"), "doc_id")
    rows = got.groupBy("source").agg(
        F.first("source_size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken")
    ).orderBy("source").collect()
    weights = [(3, 1, 2)[i % 3] for i in range(len(rows))]
    for row, want in zip(rows, aimed([r["size"] for r in rows], weights), strict=True):
        assert abs(row.target - want) < 1e-6
        assert abs(row.taken - row.target) <= 2 * mixing.BLOCK_WORDS
    assert got.where("taken > 2 * size").count() == 0
    again = mixing.mix(table.repartition(13))
    assert sorted(map(str, again.collect())) == sorted(map(str, mixing.mix(table).collect()))


def test_permutations_are_permutations(spark):
    for n in (1, 2, 7, 1000):
        for key in (0, 5):
            place = mixing.permuted("id", f"{n}L", f"{key}L", "t")
            got = [r[0] for r in spark.range(n).selectExpr(place).collect()]
            assert sorted(got) == list(range(n))
    assert got != list(range(1000))


def test_shards_have_about_equal_shares(spark):
    sources = mixing.targets(mixing.sizes(given(spark, "documents", "sf0.01")))
    counts = mixing.slots(sources, shard_blocks=1000).groupBy("shard").pivot("ordinal").count().drop("shard")
    rows = [list(r) for r in counts.collect() if sum(x or 0 for x in r) == 1000]
    for column in zip(*rows, strict=True):
        assert max(column) < 2 * min(column) + 20


def test_rows_of_all_kinds(spark):
    table = documents(spark)
    got = mixing.mix(table)
    assert got.count() == len(ROWS)
    assert got.where("size = 0 AND taken <> 0").count() == 0
    assert got.where("taken > 2 * size").count() == 0
    assert got.where("doc_id = 2").first()["size"] == 0
    assert mixing.mix(empty(spark)).count() == 0
    wordless = mixing.mix(table.where("doc_id IN (2, 3, 4)")).collect()
    assert [(r["size"], r.taken, r.target) for r in wordless] == [(0, 0, 0.0)] * 3


def test_mixed_texts_are_what_is_taken(spark):
    for table in (documents(spark, [r for r in ROWS if r[0] != 7]), given(spark, "documents")):
        mixed = mixing.mixed_documents(table)
        assert mixed.columns == table.columns
        words = mixed.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n"))
        taken = mixing.mix(table).where("taken > 0").groupBy("doc_id").agg(F.sum("taken").alias("n"))
        assert sorted(map(str, words.collect())) == sorted(map(str, taken.collect()))
        assert mixed.where("n_chars <> length(text)").count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
