"""Mixing sources to target weights with DataFrame functions alone.

The words of a source, document after document, are packed into blocks of fixed length. The mix is a
row of slots, each of which takes one block. How many slots a source has follows from its target.
A pseudorandom permutation of all slots deals them out to output shards, so the numbers of a source's
slots per shard are a multinomial draw, held to the source's total over all shards. Within its source
a slot's number is mapped through a permutation of the source's blocks, another one for each time
through, and slots are joined with blocks by source and block number. Hence a block is taken at most
once more often than another one of its source.

Permutations are swap-or-not networks: in each round a number is swapped with its partner or not,
and both ends of the swap agree on that. They need no sort and no table, whatever their length.

Sums along a source are taken by ranges of ids within ranges of ranges, so that no task holds more
than some hundred rows of a source that is large.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.llm.common import WORD, written

BLOCK_WORDS = 64
SHARD_BLOCKS = 8_192
# Fixed by the contract: weights repeat along the sources, share is of all words, most is the number
# of times that a word may be taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2

ROUNDS = 12
SEED = 7
RANGE = 512
LEVELS = 3
_P, _Q = 2_147_483_647, 2_147_483_629  # primes below 2**31: products stay below 2**62


def _numbers(name: str, below: int) -> list[int]:
    """One number for each round."""
    return [
        int(hashlib.md5(f"{SEED}/{name}/{r}".encode()).hexdigest()[:15], 16) % below
        for r in range(ROUNDS)
    ]


def round_sql(x: str, n: str, key: str, r: str, start: str, step: str, factor: str) -> str:
    """One round; the same text is SQL for Spark and for others. Numbers of the round are given."""
    partner = f"((({start} + {key} * {step}) % {n} - {x} + {n}) % {n})"
    higher = f"greatest({x}, {partner})"
    bit = f"((({higher} % {_P} + {r}) * {factor} % {_Q}) // 1024 % 2 = 0)"
    return f"CASE WHEN {bit} THEN {partner} ELSE {x} END"


def round_numbers(name: str) -> list[tuple[int, int, int]]:
    return list(
        zip(
            _numbers(f"{name}/start", 1 << 40),
            _numbers(f"{name}/step", 1 << 20),
            _numbers(f"{name}/factor", _Q),
            strict=True,
        )
    )


def permuted(x: str, n: str, key: str, name: str) -> str:
    """SQL for the place of ``x`` under permutation ``key`` of 0 to n - 1."""
    rounds = ", ".join(
        f"named_struct('r', {r}L, 's', {s}L, 't', {t}L, 'f', {f}L)"
        for r, (s, t, f) in enumerate(round_numbers(name))
    )
    one = round_sql("x", n, key, "k.r", "k.s", "k.t", "k.f").replace("//", "DIV")
    return f"aggregate(array({rounds}), CAST({x} AS BIGINT), (x, k) -> CAST({one} AS BIGINT))"


def starts(rows: DataFrame, group: str, order: list[str], value: str, levels: int = LEVELS):
    """``rows`` with ``start``, the sum of ``value`` over the rows before it in its group.

    The first of ``order`` is a whole number by which rows are put into ranges.
    """
    if levels == 0:
        before = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("start", F.coalesce(F.sum(value).over(before), F.lit(0)))
    here = f"range{levels}"
    ranged = rows.withColumn(here, F.expr(f"{order[0]} DIV {RANGE}"))
    sums = ranged.groupBy(group, here).agg(F.sum(value).alias("words"))
    base = starts(sums, group, [here], "words", levels - 1).select(
        F.col(group).alias("g"), F.col(here).alias("b"), F.col("start").alias("base")
    )
    before = (
        Window.partitionBy(group, here).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = ranged.withColumn("start", F.coalesce(F.sum(value).over(before), F.lit(0)))
    return (
        inner.join(base.hint("merge"), (inner[group] == base.g) & (inner[here] == base.b))
        .withColumn("start", F.expr("start + base"))
        .drop(here, "g", "b", "base")
    )


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, and ``digest`` and ``place`` that tell and order documents."""
    return documents.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("digest"),
    ).withColumn("place", F.expr("coalesce(doc_id, pmod(digest, 1099511627776L))"))


def targets(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each source: ordinal, size, target, number of blocks and of slots, first slot.

    Targets share ``SHARE`` of all words by weight. Filling up by weight, the sources with the least
    room for their weight stop first, so the level is found along sources ordered by that.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "ordinal")
    later = by_room.rowsBetween(0, Window.unboundedFollowing)
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weights = ", ".join(f"{w}L" for w in WEIGHTS)
    per_source = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("ordinal", (F.row_number().over(by_name) - 1).cast("long"))
        .withColumn("weight", F.expr(f"element_at(array({weights}), CAST(ordinal % {len(WEIGHTS)} + 1 AS INT))"))
        .withColumn("room", F.expr(f"{MOST} * source_size / weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum(F.expr(f"{MOST} * source_size")).over(earlier), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(later))
        .withColumn("level", F.expr(f"({SHARE}D * total - full) / rest"))
        # The first level that its own source has room for is the one for all; later ones are lower.
        .withColumn("level", F.max(F.expr("IF(level <= room, level, NULL)")).over(everything))
        .withColumn(
            "target",
            F.expr(f"IF(level * weight >= {MOST} * source_size, CAST({MOST} * source_size AS DOUBLE), level * weight)"),
        )
        .withColumn("n_blocks", F.expr(f"(source_size + {block_words - 1}) DIV {block_words}"))
        .withColumn(
            "n_slots",
            F.expr("IF(source_size = 0, 0L, CAST(round(target * n_blocks / source_size) AS BIGINT))"),
        )
        .withColumn("n_all_slots", F.sum("n_slots").over(everything))
    )
    first = F.coalesce(
        F.sum("n_slots").over(Window.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    return per_source.withColumn("first_slot", first).select(
        "source", "ordinal", "source_size", "target", "n_blocks", "n_slots", "first_slot", "n_all_slots"
    )


def slots(sources: DataFrame, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """One row for each slot of the mix: ordinal of its source, block, turn, shard and position."""
    chunk = 4096
    # The chunks are few bytes and much work: a fixed number keeps adaptive execution from merging them.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        sources.where("n_slots > 0")
        .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n_slots - 1) DIV {chunk})")))
        .repartition(tasks, "ordinal", "chunk")
        .withColumn(
            "slot",
            F.explode(F.expr(f"sequence(chunk * {chunk}, least(n_slots, (chunk + 1) * {chunk}) - 1)")),
        )
        .withColumn("turn", F.expr("slot DIV n_blocks"))
        .withColumn("key", F.expr("ordinal * 64 + turn"))
        .withColumn("block", F.expr(permuted("slot % n_blocks", "n_blocks", "key", "block")))
        .withColumn(
            "position", F.expr(permuted("first_slot + slot", "n_all_slots", "0L", "slot"))
        )
        .withColumn("shard", F.expr(f"position DIV {shard_blocks}"))
        .select("ordinal", "block", "turn", "shard", "position")
    )


def packed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with their source's figures and the words of the source before them."""
    placed = starts(
        sized.join(
            sources.select(F.col("source").alias("s"), "ordinal", "source_size", "target"),
            F.col("source").eqNullSafe(F.col("s")),
        ).drop("s"),
        "ordinal",
        ["place", "size", "digest"],
        "size",
    )
    return placed


def pieces(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each block that a document has words in: its words are from ``first`` on."""
    return (
        placed.where("size > 0")
        .withColumn(
            "block",
            F.explode(F.expr(f"sequence(start DIV {block_words}, (start + size - 1) DIV {block_words})")),
        )
        .withColumn("first", F.expr(f"greatest(block * {block_words} - start, 0L)"))
        .withColumn(
            "words", F.expr(f"least((block + 1) * {block_words} - start, size) - first")
        )
    )


def _prepared(documents: DataFrame, block_words: int):
    sized = written(sizes(documents), "mix-sizes")
    sources = written(targets(sized, block_words), "mix-sources")
    return packed(sized, sources), sources


def mix(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken and first_shard for every row.

    ``taken`` are the words that the mix takes from the document, counted as often as they are taken;
    ``first_shard`` is the first output shard that takes any of them, null if none does. A null text
    has size 0; a null source is a source of its own, the last one. Rows with equal ids are documents
    of their own, and which of several equal rows is packed first makes no difference to the rows of
    the result; null ids are placed by a hash of their text. Further columns change nothing. An empty
    table gives an empty result, and if no text has words all figures are 0.
    """
    placed, sources = _prepared(documents, block_words)
    takes = slots(sources).groupBy("ordinal", "block").agg(
        F.count("*").alias("times"), F.min("shard").alias("shard")
    )
    # Slots come from few rows of sources, so Spark takes them for small; they grow with the corpus.
    taken = (
        pieces(placed, block_words)
        .hint("merge")
        .join(takes.hint("merge"), ["ordinal", "block"])
        .groupBy("ordinal", F.col("start").alias("at"))
        .agg(F.sum(F.expr("words * times")).alias("taken"), F.min("shard").alias("first_shard"))
        .withColumnRenamed("ordinal", "o")
    )
    # Documents with words differ in their place; one without words starts where another one does.
    return placed.hint("merge").join(
        taken.hint("merge"),
        (placed.ordinal == taken.o) & (placed.start == taken["at"]) & (placed["size"] > 0),
        "left",
    ).select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard",
    )


def mixed_documents(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: a row with the words taken from a document in each turn.

    A document of which a turn takes everything keeps its text as it is; of others, words are put
    together again with single spaces. ``n_chars``, if there is such a column, is counted anew. Rows
    with equal ids and equal texts are the same document here.
    """
    placed, sources = _prepared(documents, block_words)
    once = placed.dropDuplicates(["doc_id", "digest"])
    parts = (
        pieces(once, block_words)
        .hint("merge")
        .join(slots(sources).select("ordinal", "block", "turn").hint("merge"), ["ordinal", "block"])
        .groupBy("doc_id", "digest", "turn")
        .agg(
            F.array_sort(F.collect_list(F.struct("first", "words"))).alias("parts"),
            F.sum("words").alias("n_taken"),
            F.first("size").alias("n_words"),
        )
        .withColumnsRenamed({"doc_id": "mix_id", "digest": "mix_digest"})
    )
    texts = documents.withColumn("mix_here", F.xxhash64("text"))
    joined = texts.hint("merge").join(
        parts.hint("merge"),
        texts["doc_id"].eqNullSafe(parts.mix_id) & (F.col("mix_here") == F.col("mix_digest")),
    )
    some = F.expr(
        "array_join(flatten(transform(parts, p -> slice(words_of_text, CAST(p.first + 1 AS INT),"
        " CAST(p.words AS INT)))), ' ')"
    )
    rebuilt = joined.withColumn(
        "words_of_text",
        F.when(F.col("n_taken") < F.col("n_words"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))),
    ).withColumn("text", F.when(F.col("n_taken") == F.col("n_words"), F.col("text")).otherwise(some))
    if "n_chars" in documents.columns:
        rebuilt = rebuilt.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return rebuilt.select(*documents.columns)
