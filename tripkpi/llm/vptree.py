"""Nearest neighbours by vantage-point trees, one for each shard of the vectors.

A node of a tree has a vantage point, the vectors nearer to it than the median and the others. A side
is skipped if the triangle inequality says that all of it is farther than the nearest vectors found so
far; ``relax`` multiplies that lower bound. With 1 the search is exact, above it skips more and may
miss some. Ties count as nearer by the smaller id, so a side that may hold a tie is searched.

Vectors are grouped in cells around pivots, and large cells cut into shards, so that a shard's tree
fits a task whatever the table's size and one very frequent vector fills several shards. Each query
first searches one shard of its own cell. The k-th distance found there bounds all further search: the
cells that the triangle inequality rules out, by the least and largest distance of their vectors to the
pivot, are not visited at all, and the trees of the others start from that bound. Queries that visit a
shard come in blocks, and a task walks its tree with a whole block at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.llm.common import map_rows, written

SHARD_ROWS = 8_192
BLOCK_QUERIES = 16_384
LEAF_ROWS = 256
# Queries that are compared with a leaf at a time.
COMPARED = 2_048
# Pivots are broadcast, so they are a bounded number; cells with more rows have more shards.
MOST_PIVOTS = 1_024
NO_ID = np.iinfo(np.int64).max


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, squares added from the first component on."""
    total = np.zeros((len(left), len(right)))
    for j in range(left.shape[1]):
        total += (left[:, j, None] - right[None, :, j]) ** 2
    return np.sqrt(total)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths, for bounds that leave room for rounding."""
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


class Tree:
    """A vantage-point tree over the rows of ``vectors``. Equal rows are told apart by ``serials``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS, serials=None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.leaf_rows = ids[order], vectors[order], leaf_rows
        self.serials = np.zeros(len(ids), int) if serials is None else serials[order]
        self.squares = _lengths(self.vectors) ** 2
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray):
        """A leaf is its rows; a node is (vantage point, inner, inner radius, outer, outer radius)."""
        if len(rows) <= self.leaf_rows:
            return rows
        # The row farthest from the middle splits better than any; equal vectors split by id.
        found = self.vectors[rows]
        vantage = found[np.argmax(_lengths(found - found.mean(axis=0)))]
        far = _lengths(found - vantage)
        order = np.argsort(far, kind="stable")
        rows, far, half = rows[order], far[order], len(rows) // 2
        return vantage, self._build(rows[:half]), far[half - 1], self._build(rows[half:]), far[half]

    def search(self, query_ids, queries, k: int, relax: float = 1.0, bounds=None):
        """Ids and distances of the k nearest rows of each query but itself, as far as they are within
        ``bounds``; NO_ID where none is. The row with a query's id and vector and serial 0 is itself."""
        self.best_ids = np.full((len(queries), k), NO_ID)
        self.best = np.full((len(queries), k), np.inf)
        self.query_ids, self.queries, self.relax = query_ids, queries, relax
        self.query_squares = _lengths(queries) ** 2 if len(queries) else np.empty(0)
        self.bounds = np.full(len(queries), np.inf) if bounds is None else bounds
        if len(self.ids) and len(queries):
            with np.errstate(over="ignore", invalid="ignore"):
                self._walk(self.root, np.arange(len(queries)))
        return self.best_ids, self.best

    def _reach(self, which: np.ndarray) -> np.ndarray:
        return np.minimum(self.best[which, -1], self.bounds[which])

    def _offer(self, rows: np.ndarray, which: np.ndarray) -> None:
        """Puts what is near among a leaf's rows into the lists of some queries.

        Squares of distances from a product of matrices tell, within what rounding may change, which
        pairs can matter; only these get their distance by ``distances``.
        """
        k, queries, vectors = self.best.shape[1], self.queries[which], self.vectors[rows]
        sums = self.query_squares[which, None] + self.squares[rows]
        squares = sums - 2 * (queries @ vectors.T)
        slack = sums * (1e-14 * (vectors.shape[1] + 8))
        limit = self._reach(which) ** 2 * (1 + 1e-12)
        if len(rows) > k:  # one more than k, as the query itself may be among them
            limit = np.minimum(limit, np.partition(squares + slack, k, axis=1)[:, k])
        i, j = np.nonzero(~(squares - slack > limit[:, None]))
        ids, asked = self.ids[rows[j]], which[i]
        total = np.zeros(len(i))
        for c in range(vectors.shape[1]):
            total += (queries[i, c] - vectors[j, c]) ** 2
        far = np.sqrt(total)
        own = (ids == self.query_ids[asked]) & (self.serials[rows[j]] == 0)
        for pair in np.flatnonzero(own):
            own[pair] = np.array_equal(queries[i[pair]], vectors[j[pair]])
        there = ~own & (far <= self._reach(asked)) & ~np.isinf(far)
        far, ids, asked = far[there], ids[there], asked[there]
        changed = np.unique(asked)
        owner = np.concatenate([np.repeat(changed, k), asked])
        far = np.concatenate([self.best[changed].reshape(-1), far])
        ids = np.concatenate([self.best_ids[changed].reshape(-1), ids])
        order = np.lexsort((ids, far, owner))
        starts = np.searchsorted(owner[order], changed)
        taken = order[starts[:, None] + np.arange(k)]
        self.best[changed], self.best_ids[changed] = far[taken], ids[taken]

    def _walk(self, node, which: np.ndarray) -> None:
        if not len(which):
            return
        if isinstance(node, np.ndarray):
            for at in range(0, len(which), COMPARED):
                self._offer(node, which[at : at + COMPARED])
            return
        vantage, inner, inner_radius, outer, outer_radius = node
        far = _lengths(self.queries[which] - vantage)
        slack = 1e-9 * (far + outer_radius)  # for rounding
        low_inner, low_outer = far - inner_radius - slack, outer_radius - far - slack
        near = low_inner <= low_outer

        def open_(low: np.ndarray) -> np.ndarray:
            return ~(low * self.relax > self._reach(which))

        # The nearer side first; both kinds of queries share the walk of the outer one.
        self._walk(inner, which[near & open_(low_inner)])
        self._walk(outer, which[open_(low_outer)])
        self._walk(inner, which[~near & open_(low_inner)])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and times, how often they occur together, of the rows that take part.

    Left out are rows with a null id, and vectors that are null, empty, zero or hold null or
    non-finite components. Rows that share an id but not the vector are vectors of their own.
    """
    return (
        vectors.select("vec_id", "embedding")
        .where(
            "vec_id IS NOT NULL AND exists(embedding, x -> x <> 0)"
            " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x)"
            " AND abs(x) < double('Infinity'))"
        )
        .groupBy("vec_id", "embedding")
        .agg(F.count("*").alias("times"))
    )


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class Cells:
    """Pivots by number of components, and what is known of the cells around them."""

    def __init__(self, pivots: list[list[float]]):
        self.points = {
            dim: np.unique(np.array([p for p in pivots if len(p) == dim], float), axis=0)
            for dim in {len(p) for p in pivots}
        }
        self.spans: dict[tuple[int, int], tuple[float, float]] = {}

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and its distance; -1 and 0 if no pivot is comparable."""
        points = self.points.get(vectors.shape[1])
        if points is None:
            return np.full(len(vectors), -1), np.zeros(len(vectors))
        far = distances(vectors, points)
        cell = far.argmin(axis=1)
        return cell, far[np.arange(len(vectors)), cell]

    def visited(self, vectors: np.ndarray, bounds: np.ndarray, relax: float) -> list[list[int]]:
        """Cells that may hold a vector within each query's bound."""
        dim = vectors.shape[1]
        names = sorted(c for d, c in self.spans if d == dim)
        least, most = np.array([self.spans[dim, c] for c in names]).reshape(-1, 2).T
        low = np.zeros((len(vectors), len(names)))
        if dim in self.points:
            far = distances(vectors, self.points[dim][names])
            low = np.maximum(far - most, least - far) - 1e-9 * (far + most)  # for rounding
        names = np.array(names)
        return [names[row].tolist() for row in low * relax <= bounds[:, None]]


def _by_dim(part: pa.RecordBatch):
    """Places of a batch's rows and their vectors, for each number of components."""
    dims = part.column("dim").to_numpy()
    for dim in np.unique(dims):
        where = np.flatnonzero(dims == dim)
        yield where, _matrix(part.column("embedding").take(pa.array(where)))


FOUND = pa.schema(
    [
        ("query_id", pa.int64()), ("mark", pa.string()), ("times", pa.int64()),
        ("vec_id", pa.int64()), ("score", pa.float64()),
    ]
)


def _searched(shards: DataFrame, queries: DataFrame, k: int, relax: float) -> DataFrame:
    """The nearest of each query within each shard that it is dealt to, by dim, cell, part and block."""

    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        if not shard.num_rows or not block.num_rows:
            return FOUND.empty_table()
        ids, serials = shard.column("vec_id").to_numpy(), shard.column("serial").to_numpy()
        tree = Tree(ids, _matrix(shard.column("embedding")), serials=serials)
        asked, bounds = block.column("query_id").to_numpy(), block.column("bound").to_numpy()
        found, far = tree.search(asked, _matrix(block.column("embedding")), k, relax, bounds)
        there = found != NO_ID
        rows = pa.array(np.repeat(np.arange(len(asked)), there.sum(axis=1)))
        named = [block.column(c).take(rows) for c in ("query_id", "mark", "times")]
        return pa.table([*named, found[there], far[there]], schema=FOUND)

    keys = ("dim", "cell", "part", "block")
    shards = shards.select(*keys, "vec_id", "serial", "embedding")
    queries = queries.select(*keys, "query_id", "mark", "times", "bound", "embedding")
    queries = queries.toDF(*queries.columns)  # columns of its own, though both come from one table
    return (
        shards.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(search, "query_id long, mark string, times long, vec_id long, score double")
    )


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    relax: float = 1.0,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
    most_pivots: int = MOST_PIVOTS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest others of each query, nearest first.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query's
    own with as many components (``usable`` says which rows take part). Rows that repeat, or share an
    id, are candidates each; if they are queries, each has its own k rows. Ties go to the smaller id.
    With fewer than k candidates all are returned; an empty table gives an empty result. Further
    columns change nothing.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors).withColumn("dim", F.size("embedding")), "vectors")
    # A row that repeats more than k times fills any list by itself.
    rows = rows.withColumn("kept", F.expr(f"least(times, {k + 1}L)"))
    n, n_queries = rows.agg(
        F.sum("kept"), F.count(F.expr(f"IF(vec_id % {every} = 0, 1, NULL)"))
    ).first()
    n_pivots = min(most_pivots, -(-(n or 0) // shard_rows))
    pivots = rows.orderBy(F.expr("xxhash64(vec_id, embedding)"), "vec_id").limit(n_pivots)
    cells = Cells([r.embedding for r in pivots.select("embedding").collect()])

    def place(part):
        cell, reach = np.empty(part.num_rows, np.int32), np.empty(part.num_rows)
        for where, found in _by_dim(part):
            cell[where], reach[where] = cells.place(found)
        return *part.columns, cell, reach

    ddl = (
        f"vec_id long, embedding {rows.schema['embedding'].dataType.simpleString()}, times long,"
        " dim int, kept long, cell int, reach double"
    )
    placed = written(map_rows(rows, ddl, place), "cells")
    # One row for each pivot and, where vectors have other numbers of components, for each of these.
    sizes = placed.groupBy("dim", "cell").agg(
        F.expr(f"CAST(ceil(sum(kept) / {shard_rows}) AS INT)").alias("parts"),
        F.count(F.expr(f"IF(vec_id % {every} = 0, 1, NULL)")).alias("asked"),
        F.min("reach").alias("least"),
        F.max("reach").alias("most"),
    )
    known = sizes.collect()
    cells.spans = {(r.dim, r.cell): (r.least, r.most) for r in known}
    sizes = spark.createDataFrame(
        [(r.dim, r.cell, r.parts, -(-r.asked // (r.parts * block_queries))) for r in known],
        "dim int, cell int, parts int, home_blocks long",
    )
    placed = placed.join(F.broadcast(sizes), ["dim", "cell"])
    shards = placed.withColumn("serial", F.explode(F.expr("sequence(0L, kept - 1)"))).withColumn(
        "part", F.expr("CAST(pmod(xxhash64(vec_id, embedding, serial), parts) AS INT)")
    )

    def in_blocks(table: DataFrame, blocks: str) -> DataFrame:
        return table.where(f"{blocks} > 0").withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks} - 1)")))

    queries = (
        placed.where(f"vec_id % {every} = 0")
        .withColumnRenamed("vec_id", "query_id")
        .withColumn("mark", F.expr("sha2(CAST(embedding AS STRING), 256)"))
        .withColumn("dealt", F.expr("xxhash64(query_id, mark)"))
        .withColumn("home", F.expr("CAST(pmod(dealt, parts) AS INT)"))
    )
    first = queries.withColumns(
        {
            "part": F.col("home"),
            "block": F.expr("pmod(shiftright(dealt, 20), home_blocks)"),
            "bound": F.lit(float("inf")),
        }
    )
    first = written(_searched(in_blocks(shards, "home_blocks"), first, k, relax), "home")
    bounds = first.groupBy("query_id", "mark").agg(
        F.expr(f"IF(count(*) < {k}, double('Infinity'), max(score))").alias("bound")
    )
    queries = queries.drop("parts", "home_blocks").join(bounds, ["query_id", "mark"], "left")
    queries = queries.fillna(float("inf"), "bound").withColumnRenamed("cell", "home_cell")

    def visit(part):
        asked = part.column("bound").to_numpy()
        visited = [[]] * part.num_rows
        for where, found in _by_dim(part):
            for i, names in zip(where, cells.visited(found, asked[where], relax), strict=True):
                visited[i] = names
        return *part.columns, visited

    visits = map_rows(queries, f"{_ddl(queries)}, cells array<int>", visit)
    n_blocks = -(-n_queries // block_queries)
    visits = (
        visits.withColumn("cell", F.explode("cells"))
        .join(F.broadcast(sizes), ["dim", "cell"])
        .withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        .where("NOT (cell = home_cell AND part = home)")
        .withColumn("block", F.expr(f"pmod(shiftright(dealt, 20), {max(n_blocks, 1)})"))
    )
    found = first.union(_searched(in_blocks(shards, f"{n_blocks}L"), visits, k, relax))
    order = Window.partitionBy("query_id", "mark").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .withColumn("again", F.explode(F.expr("sequence(1L, times)")))
        .select("query_id", "rank", "vec_id", "score")
    )


def _ddl(table: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
