"""Removal of passages that repeat, by a hash-compared sort of sampled suffixes.

A byte goes if a string of 100 bytes that covers it also starts earlier. Comparing all suffixes of a
corpus would mean shuffling many times its size, so suffixes are sampled in a way that loses nothing:

* Of the 77 places in a 100-byte string at which 24 bytes fit, the one with the least hash is its
  *anchor*. Equal strings have equal anchors, and about one place in 39 is one. The strings with the
  same anchor start in a run of neighbouring places; the bytes they cover together are the anchor's
  *context*.
* Occurrences of an anchor whose whole contexts are equal are repeats of the first of them. That
  settles everything but the edges of repeated passages: anchors with more than one context.
* The suffixes at those anchors are sorted. Two suffixes are compared by the longest common extension,
  found by binary search over prefix polynomial hashes, so a comparison takes a number of steps
  logarithmic in the length; the sort is Python's merge sort. Suffixes that agree in their first m
  bytes are neighbours then, and with a hash of the bytes left of the anchor they make the classes of
  equal 100-byte strings. Members of a class are compared byte by byte with its first.

Anchors that are frequent in a sample go another way, so that no task gets all their occurrences: they
are aggregated by context before they are shuffled, and the strings at their edges are grouped by two
64-bit hashes, some neighbouring ones together first. Which anchors go that way has no effect on the result.
"""

from __future__ import annotations

import hashlib
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.common import map_rows, written

LENGTH = 100
GRAM = 24
PLACES = LENGTH - GRAM + 1
# Documents, on average, that frequent anchors are looked for in, occurrences that make one
# frequent, and how many may be (bounds what is broadcast).
SAMPLE_ROWS = 10_000
FREQUENT = 64
MOST_FREQUENT = 10_000
# Contexts that are sorted together, at least; a task holds these and one anchor's more.
SORTED_CONTEXTS = 4_096
# Strings of frequent anchors that are compared together.
TOGETHER = 11
POSITION_BITS = 28

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_random = np.random.Generator(np.random.PCG64(4))
BYTES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
SALT = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as they have been needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 1 << 16)
            for name, base in (("up", BASE), ("down", INVERSE)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers))
        return cls.up, cls.down


class Prefixes:
    """Prefix polynomial hashes of a byte string; equal strings have equal hashes wherever they are."""

    def __init__(self, data: np.ndarray):
        self.up, down = Powers.to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * down[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.up[start]


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Anchors of the texts at ``starts`` to ``ends`` in ``data``: for each one its text's number, the
    first and the last place at which a string with it starts, and hashes of its 24 bytes and of its
    context."""
    empty = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty, empty, empty
    prefixes = Prefixes(data)
    places = np.arange(len(data) - GRAM + 1)
    grams = mix(prefixes.hash(places, places + GRAM))
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = grams & ~low | places.astype(np.uint64)
    span = 1
    while 2 * span <= PLACES:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(least) - (PLACES - span)], least[PLACES - span :])
    at = (least & low).astype(np.int64)  # of the string that starts at each place
    text = np.searchsorted(starts, np.arange(len(at)), side="right") - 1
    inside = np.arange(len(at)) + LENGTH <= ends[text]
    kept = np.flatnonzero(inside)
    if not len(kept):
        return empty, empty, empty, empty, empty, empty
    anchor, owner = at[kept], text[kept]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    first, last = kept[new], kept[np.r_[new[1:] - 1, len(kept) - 1]]
    anchor, owner = anchor[new], owner[new]
    shape = ((anchor - first) * 128 + (last - first)).astype(np.uint64)
    context = mix(prefixes.hash(first, last + LENGTH) ^ mix(shape + SALT))
    return owner, first - starts[owner], last - starts[owner], anchor - starts[owner], grams[anchor], context


def joined(texts: list[str | None]):
    """The UTF-8 bytes of the texts in one array, and where each one starts and ends."""
    encoded = [t.encode() if t else b"" for t in texts]
    ends = np.cumsum([len(e) for e in encoded], dtype=np.int64)
    return np.frombuffer(b"".join(encoded), np.uint8), np.r_[0, ends[:-1]], ends


ANCHOR_DDL = "ord long, start int, last int, offset int, anchor long, context long"


def all_anchors(documents: DataFrame, frequent=None, wanted: bool = False) -> DataFrame:
    """The anchors of all documents (ord, text): those among ``frequent``, a broadcast sorted array,
    or, unless they are ``wanted``, those that are not."""

    def work(part):
        data, starts, ends = joined(part.column("text").to_pylist())
        # Texts that are too short for a string have no place; starts must differ to be told apart.
        some = np.flatnonzero(ends - starts >= LENGTH)
        owner, first, last, anchor, gram, context = anchors(data, starts[some], ends[some]) if len(
            some
        ) == len(starts) else anchors_of(data, starts, ends, some)
        ids = part.column("ord").to_numpy(zero_copy_only=False)[owner] if len(owner) else owner
        gram = gram.astype(np.uint64).view(np.int64)
        keep = slice(None)
        if frequent is not None:
            among = np.isin(gram, frequent.value)
            keep = among if wanted else ~among
        context = context.astype(np.uint64).view(np.int64)
        return (
            ids[keep], first[keep].astype(np.int32), last[keep].astype(np.int32),
            (anchor - first)[keep].astype(np.int32), gram[keep], context[keep],
        )

    return map_rows(documents.select("ord", "text"), ANCHOR_DDL, work, text="text")


def anchors_of(data, starts, ends, some):
    """As ``anchors``, for some of the texts only; the others are too short to have any."""
    parts = [data[starts[i] : ends[i]] for i in some]
    lengths = np.array([len(p) for p in parts], np.int64)
    new_ends = np.cumsum(lengths)
    whole = np.concatenate(parts) if parts else data[:0]
    owner, *rest = anchors(whole, new_ends - lengths, new_ends)
    return some[owner] if len(owner) else owner, *rest


def frequent_anchors(documents: DataFrame) -> np.ndarray:
    """Anchors that a sample has many times, sorted; at most ``MOST_FREQUENT``."""
    share = min(1.0, SAMPLE_ROWS / max(documents.count(), 1))
    counts = all_anchors(documents.sample(share, seed=1)).groupBy("anchor").count()
    top = counts.where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "anchor")
    return np.sort(np.array([r.anchor for r in top.limit(MOST_FREQUENT).collect()], np.int64))


def _complete(batches, key: str, least: int = 1):
    """Sorted batches cut anew where ``key`` changes."""
    carry, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1])) if keys[0] <= keys[-1] else 0
        if carry and carry[-1].column(key)[-1].as_py() != keys[0] and rows >= least:
            yield pa.Table.from_batches(carry).combine_chunks()
            carry, rows = [], 0
        if cut and rows + cut >= least:
            yield pa.Table.from_batches([*carry, batch.slice(0, cut)]).combine_chunks()
            carry, rows = [], 0
            batch = batch.slice(cut)
        carry.append(batch)
        rows += batch.num_rows
    if carry:
        yield pa.Table.from_batches(carry).combine_chunks()


def same_context(found: DataFrame) -> DataFrame:
    """What comparing whole contexts settles: ``covered`` occurrences, whose context occurs earlier,
    and first occurrences of the contexts of anchors that have several."""

    def settle(batches):
        for table in _complete(batches, "anchor"):
            anchor = table.column("anchor").to_numpy()
            context = table.column("context").to_numpy()
            new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
            new_context = new_anchor | np.r_[True, context[1:] != context[:-1]]
            group = np.cumsum(new_anchor) - 1
            several = np.bincount(group, new_context)[group] > 1
            keep = ~new_context | several
            rows = table.filter(pa.array(keep))
            rows = rows.append_column("covered", pa.array(~new_context[keep]))
            yield from rows.select(SETTLED).to_batches()

    SETTLED = ["covered", "ord", "start", "last", "offset", "anchor"]
    return (
        found.repartition("anchor")
        .sortWithinPartitions("anchor", "context", "ord", "start")
        .mapInArrow(
            settle, "covered boolean, ord long, start int, last int, offset int, anchor long"
        )
    )


def with_context(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """``wanted`` occurrences with the bytes of their contexts."""
    lists = wanted.groupBy("ord").agg(
        F.collect_list(F.struct("start", "last", "offset", "anchor")).alias("wanted")
    )
    rows = documents.select("ord", "text").join(lists.withColumnRenamed("ord", "o"), F.col("ord") == F.col("o"))

    def work(part):
        out = ([], [], [], [], [], [])
        for ord_, text, items in zip(
            part.column("ord").to_pylist(), part.column("text").to_pylist(),
            part.column("wanted").to_pylist(), strict=True,
        ):
            data = text.encode()
            for item in items:
                row = (
                    ord_, item["start"], item["last"], item["offset"], item["anchor"],
                    data[item["start"] : item["last"] + LENGTH],
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        return out

    ddl = "ord long, start int, last int, offset int, anchor long, context binary"
    return map_rows(rows.select("ord", "text", "wanted"), ddl, work, text="text")


class Sorter:
    """Sorted suffixes of contexts from their anchors on."""

    def __init__(self, contexts: list[bytes], offsets: np.ndarray):
        data = np.frombuffer(b"".join(contexts), np.uint8)
        self.data = data
        ends = np.cumsum([len(c) for c in contexts], dtype=np.int64)
        self.starts, self.ends = np.r_[0, ends[:-1]], ends
        self.at = self.starts + offsets
        self.prefixes = Prefixes(data)
        # Plain integers are faster where single ones are compared.
        self._sums, self._up = self.prefixes.sums.tolist(), self.prefixes.up[: len(data) + 1].tolist()
        self._at, self._ends, self._bytes = self.at.tolist(), ends.tolist(), data.tobytes()

    def extension(self, i: int, j: int) -> int:
        """The length of the longest common extension of two suffixes, by binary search."""
        a, b, sums, up = self._at[i], self._at[j], self._sums, self._up
        low, high = 0, min(self._ends[i] - a, self._ends[j] - b)
        while low < high:
            middle = (low + high + 1) // 2
            left = (sums[a + middle] - sums[a]) * up[a]
            right = (sums[b + middle] - sums[b]) * up[b]
            if (left - right) & 0xFFFFFFFFFFFFFFFF:
                high = middle - 1
            else:
                low = middle
        # A hash may agree by chance: then bytes decide.
        if self._bytes[a : a + low] != self._bytes[b : b + low]:
            low = next(n for n in range(low) if self._bytes[a + n] != self._bytes[b + n])
        return low

    def compare(self, i: int, j: int) -> int:
        n = self.extension(i, j)
        a, b = self._at[i] + n, self._at[j] + n
        left = self._bytes[a] if a < self._ends[i] else -1
        right = self._bytes[b] if b < self._ends[j] else -1
        return left - right

    def sort(self, members: np.ndarray) -> tuple[list[int], list[int]]:
        """Members in the order of their suffixes, and the extension each shares with the one before."""
        order = sorted(members.tolist(), key=cmp_to_key(self.compare))
        return order, [0, *(self.extension(i, j) for i, j in zip(order, order[1:], strict=False))]


def repeated_strings(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``table`` and places in their texts at which a string starts that also starts earlier,
    in the context of another row with the same anchor."""
    anchor = table.column("anchor").to_numpy()
    ords, start = table.column("ord").to_numpy(), table.column("start").to_numpy().astype(np.int64)
    last, offset = table.column("last").to_numpy(), table.column("offset").to_numpy().astype(np.int64)
    sorter = Sorter(table.column("context").to_pylist(), offset)
    bounds = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
    order, extension = [], []
    for a, b in zip(bounds, bounds[1:], strict=False):
        members, shared = sorter.sort(np.arange(a, b))
        order += members
        extension += shared
    order, extension = np.array(order), np.array(extension)
    group = np.searchsorted(bounds, order, side="right")
    new_group = np.r_[True, group[1:] != group[:-1]]
    rank = np.empty(len(order), np.int64)
    rank[np.lexsort((start, ords))] = np.arange(len(order))
    rank = rank[order]
    offset, width = offset[order], (last - start)[order]
    at = sorter.at[order]
    rows_out, places_out = [], []
    for left in range(PLACES):  # strings that start this far before their anchor
        # Neighbours that agree in the string's bytes from the anchor on.
        run = np.cumsum(new_group | (extension < LENGTH - left))
        have = np.flatnonzero((left <= offset) & (left >= offset - width))
        if len(have) < 2:
            continue
        head = sorter.prefixes.hash(at[have] - left, at[have])
        sort = np.lexsort((rank[have], head, run[have]))
        have, head, runs = have[sort], head[sort], run[have][sort]
        new = np.r_[True, (head[1:] != head[:-1]) | (runs[1:] != runs[:-1])]
        first = have[np.maximum.accumulate(np.where(new, np.arange(len(have)), 0))]
        later = np.flatnonzero(~new)
        if not len(later):
            continue
        span = np.arange(LENGTH)
        mine = sorter.data[(at[have[later]] - left)[:, None] + span]
        theirs = sorter.data[(at[first[later]] - left)[:, None] + span]
        same = (mine == theirs).all(axis=1)
        if not same.all():  # a collision: classes by the bytes themselves
            seen: dict[tuple, bool] = {}
            same_at = []
            for i in np.argsort(rank[have], kind="stable"):
                key = (group[have[i]], sorter.data[at[have[i]] - left :][:LENGTH].tobytes())
                if key in seen:
                    same_at.append(i)
                seen[key] = True
            later, same = np.array(same_at, np.int64), slice(None)
        hit = have[later[same]]
        rows_out.append(order[hit])
        places_out.append(start[order[hit]] + offset[hit] - left)
    if not rows_out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows_out), np.concatenate(places_out)


SPAN_DDL = "ord long, start int, stop int"


def edges(contexts: DataFrame) -> DataFrame:
    """Spans of repeated strings in contexts that are not repeated as a whole."""

    def work(batches):
        for table in _complete(batches, "anchor", SORTED_CONTEXTS):
            rows, places = repeated_strings(table)
            yield pa.RecordBatch.from_pydict({
                "ord": pa.array(table.column("ord").to_numpy()[rows], pa.int64()),
                "start": pa.array(places, pa.int32()),
                "stop": pa.array(places + LENGTH, pa.int32()),
            })

    return (
        contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(work, SPAN_DDL)
    )


def _two_hashes(data: np.ndarray, start: np.ndarray, length) -> tuple[np.ndarray, np.ndarray]:
    """Independent hashes of strings of ``data``: forwards, and backwards."""
    back = Prefixes(data[::-1].copy())
    size = len(data)
    return (
        mix(Prefixes(data).hash(start, start + length)),
        mix(back.hash(size - start - length, size - start)),
    )


def _by_string(rows: DataFrame, keys: list[str], span: str) -> tuple[DataFrame, DataFrame]:
    """First occurrences of equal ``keys`` with all columns, and the spans of the others.

    Rows are written, as both the aggregate and the join read them and would make each one anew. First
    ones are written, so that the join shuffles both of its sides and Spark can split a key that is
    frequent; it cannot where one side is the aggregate itself.
    """
    rows = written(rows, "strings")
    others = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("first"))
    first = written(first, "first-strings")
    named = first.select(*[F.col(k).alias(f"{k}_f") for k in keys], "first.ord", "first.start")
    named = named.toDF(*[f"{k}_f" for k in keys], "ord_f", "start_f")
    same = [F.col(k) == F.col(f"{k}_f") for k in keys]
    # Where a string ends is worked out before the join, which need not carry its bytes then.
    ends = rows.selectExpr(*keys, "ord", "start", f"{span} AS stop")
    later = ends.join(named, same).where("NOT (ord = ord_f AND start = start_f)")
    return first.select(*keys, "first.*"), later.select("ord", "start", "stop")


def frequent_edges(contexts: DataFrame) -> DataFrame:
    """The same for frequent anchors, by grouping their strings.

    Strings that start at neighbouring places are taken ``TOGETHER`` first, so most are settled by a
    few rows; those of groups that differ in part are then grouped one by one.
    """

    def groups(part):
        ords, places, bytes_, cores, one, two = [], [], [], [], [], []
        zero = np.zeros(1, np.int64)
        for ord_, start, last, offset, context in zip(
            *(part.column(c).to_pylist() for c in ("ord", "start", "last", "offset", "context")),
            strict=True,
        ):
            data = np.frombuffer(context, np.uint8)
            # Cut relative to the anchor, so that equal strings are cut alike.
            low, high = offset - (last - start), offset
            for g in range(low // TOGETHER, high // TOGETHER + 1):
                far, near = min(high, g * TOGETHER + TOGETHER - 1), max(low, g * TOGETHER)
                whole = data[offset - far : offset - near + LENGTH]
                # What all strings of the group would share, whether they are here or not.
                core = data[offset - g * TOGETHER :][: LENGTH - TOGETHER + 1]
                a, b = _two_hashes(whole, zero, len(whole))
                c = _two_hashes(core, zero, len(core))[0] ^ mix(np.array([g], np.uint64))
                ords.append(ord_)
                places.append(start + offset - far)
                bytes_.append(whole.tobytes())
                for column, value in ((cores, c), (one, a), (two, b)):
                    column.append(int(value.view(np.int64)[0]))
        return ords, places, bytes_, cores, one, two

    def strings(part):
        ords, places, one, two = [], [], [], []
        for ord_, start, text in zip(
            *(part.column(c).to_pylist() for c in ("ord", "start", "text")), strict=True
        ):
            at = np.arange(len(text) - LENGTH + 1)
            a, b = _two_hashes(np.frombuffer(text, np.uint8), at, LENGTH)
            ords.append(np.full(len(at), ord_))
            places.append(start + at)
            one.append(a)
            two.append(b)
        if not ords:
            return [], [], [], []
        return (
            np.concatenate(ords), np.concatenate(places).astype(np.int32),
            np.concatenate(one).view(np.int64), np.concatenate(two).view(np.int64),
        )

    ddl = "ord long, start int, text binary, core long, one long, two long"
    grouped = map_rows(contexts, ddl, groups)
    first, whole = _by_string(grouped, ["core", "one", "two"], "start + length(text)")
    several = first.groupBy("core").count().where("count > 1").select(F.col("core").alias("c"))
    open_ = first.join(several, first.core == several.c, "left_semi")
    single = map_rows(open_.select("ord", "start", "text"), "ord long, start int, one long, two long", strings)
    return whole.union(_by_string(single, ["one", "two"], f"start + {LENGTH}")[1])


def ordered(documents: DataFrame) -> DataFrame:
    """``documents`` with ``ord``, which orders them and tells them apart.

    That is their id, if ids are unique and never null. Otherwise documents are numbered in the order
    of id (null first) and text hash, and the numbered table is written, so that it stays the same.
    """
    ids = documents.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if ids.isEmpty():
        return documents.withColumn("ord", F.col("doc_id").cast("long"))
    sort = documents.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return written(sort.withColumn("ord", F.monotonically_increasing_id()), "ordered")


def spans(documents: DataFrame) -> DataFrame:
    """ord, start and stop of spans whose bytes repeat, of documents with ord; spans may overlap."""
    hot = frequent_anchors(documents)
    frequent = documents.sparkSession.sparkContext.broadcast(hot)
    settled = written(same_context(all_anchors(documents, frequent)), "settled")
    whole = settled.where("covered").selectExpr("ord", "start", f"last + {LENGTH} AS stop")
    several = with_context(settled.where("NOT covered").drop("covered"), documents)
    found = whole.union(written(edges(several), "edges"))
    if not len(hot):
        return found
    occurrences = written(all_anchors(documents, frequent, wanted=True), "frequent")
    first = occurrences.groupBy("anchor", "context").agg(
        F.min(F.struct("ord", "start", "last", "offset")).alias("first")
    )
    first = written(first, "first-contexts")  # lets the join below split what is frequent
    named = first.withColumnsRenamed({"anchor": "a", "context": "c"})
    later = (
        occurrences.join(named, (F.col("anchor") == F.col("a")) & (F.col("context") == F.col("c")))
        .where("NOT (ord = first.ord AND start = first.start)")
        .selectExpr("ord", "start", f"last + {LENGTH} AS stop")
    )
    contexts = written(with_context(first.select("first.*", "anchor"), documents), "contexts")
    return found.union(later).union(frequent_edges(contexts))


def _without(documents: DataFrame, columns, ddl) -> DataFrame:
    """``documents`` (with ord) joined with their spans; ``columns`` makes the result of a part, the
    remaining bytes, and the numbers of removed bytes and runs."""
    lists = spans(documents).groupBy(F.col("ord").alias("o")).agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    rows = documents.join(lists, documents["ord"] == F.col("o"), "left").drop("o")

    def work(part):
        kept, removed, runs = [], [], []
        for text, found in zip(
            part.column("text").to_pylist(), part.column("spans"), strict=True
        ):
            data = text.encode() if text else b""
            if not found.is_valid:
                kept.append(data)
                removed.append(0)
                runs.append(0)
                continue
            pairs = found.values
            start = pairs.field("start").to_numpy()
            stop = pairs.field("stop").to_numpy()
            depth = np.bincount(start, minlength=len(data) + 1)[: len(data) + 1].astype(np.int64)
            depth -= np.bincount(stop, minlength=len(data) + 1)[: len(data) + 1]
            gone = np.cumsum(depth)[:-1] > 0
            kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
            removed.append(int(gone.sum()))
            runs.append(int((gone & ~np.r_[False, gone[:-1]]).sum()))
        return columns(part, kept, removed, runs)

    return map_rows(rows, ddl, work, text="text")


def repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row.

    A null text is empty. Rows with equal ids are documents of their own, ordered by a hash of their
    text; of equal rows one comes first and the others repeat it, which one makes no difference.
    Null ids come before all others. Further columns change nothing. An empty table gives an empty
    result.
    """

    def columns(part, kept, removed, runs):
        n_bytes = [len(k) + r for k, r in zip(kept, removed, strict=True)]
        digests = [hashlib.sha256(k).hexdigest() for k in kept]
        return part.column("doc_id"), n_bytes, removed, runs, digests

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _without(ordered(documents.select("doc_id", "text")), columns, ddl)


def without_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` with what repeats taken out of their texts.

    Characters of which some bytes repeat go as a whole. ``n_chars``, if there is such a column, is
    counted anew; null texts stay null, and a document of which nothing remains has an empty text.
    """
    names = documents.columns

    def columns(part, kept, removed, runs):
        texts = [
            t if not r else k.decode("utf-8", "ignore")
            for t, k, r in zip(part.column("text").to_pylist(), kept, removed, strict=True)
        ]
        out = {n: part.column(n) for n in names} | {"text": texts}
        if "n_chars" in names:
            before = part.column("n_chars").to_pylist()
            out["n_chars"] = [
                n if not r else len(t) for n, r, t in zip(before, removed, texts, strict=True)
            ]
        return [out[n] for n in names]

    return _without(ordered(documents), columns, documents.schema)
