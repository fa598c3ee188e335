"""SentencePiece encoding and decoding as shortest paths through weighted finite-state transducers.

Three machines take part. The *normaliser* puts a space in front and rewrites spaces; it has one state
and no choice, so it is applied as a rewriting of the text before the others. The *piece* transducer, a
trie whose leaves emit piece ids, has an arc per piece. The *byte fallback* has an arc for each character
without a piece, which emits the pieces of its UTF-8 bytes. The last two are composed with the input as
they are needed, state by state; no lattice is stored. The encoding is the shortest path in the tropical
semiring (weights are added along a path, the least path counts).

A unigram model's weights are its negative scores. A BPE model is not a sum of weights: which pieces
it yields depends on the order of merges. It is exact as a bigram acceptor, though. A sequence of
pieces is what the merges lead to if and only if every two neighbours on their own are what their
joint string leads to: the first merge across a border between two pieces would happen in the same
way in the string of these two alone. The acceptor's arc from one piece to the next weighs 0 if the
pair lasts and infinity otherwise, which the histories of the two pieces' edges tell, and exactly one
path through a lattice is finite: the shortest. It is searched depth first, longest pieces first.
States of the composition are (position, last piece), each visited once at most, so encoding takes
time in proportion to the text's length, however long it is.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tripkpi.llm.common import map_rows
from tripkpi.llm.pieces import BPE, BYTE, NORMAL, SPACE, Model, pre_tokens, read_model

INFINITY = float("inf")
# Pre-tokens whose ids are kept, in each of two generations: some 340 MB for each Python worker.
CACHED_WORDS = 400_000
CACHED_PAIRS = 1_000_000
CACHED_CHARS = 64
# Characters by which the arcs that leave a position are remembered.
AHEAD = 6
# What a character costs beyond the worst piece if a unigram model has neither piece nor bytes.
UNKNOWN_PENALTY = 10.0


class _Words(dict):
    """Pre-tokens to ids; those that are not there are encoded.

    When a generation is full it becomes the older one, and what is still in use is taken over from there.
    Emptying everything instead would have frequent pre-tokens encoded again and again.
    """

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, pre_token: str) -> bytes:
        ids = self.older.get(pre_token)
        if ids is None:
            ids = self.encode(pre_token)
        if len(pre_token) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[pre_token] = ids
        return ids


class Transducer:
    """Encoder and decoder of one model."""

    def __init__(self, model: Model, cached: int = CACHED_WORDS):
        self.model = model
        self.bpe = model.kind == BPE
        self.ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        self.rank = {p: -model.scores[i] for p, i in self.ids.items()}
        self.bytes = {}
        for i, kind in enumerate(model.kinds):
            if kind == BYTE:
                self.bytes[int(model.pieces[i][1:-1], 16)] = i
        self.trie: dict = {}
        for piece, i in self.ids.items():
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = i
        # What each id stands for when decoding; spaces are put back at the end.
        self.output = [p.encode() for p in model.pieces]
        for value, i in self.bytes.items():
            self.output[i] = bytes([value])
        for i, kind in enumerate(model.kinds):
            if kind not in (NORMAL, BYTE):
                self.output[i] = b""
        self.output[model.unknown] = " ⁇ ".encode()
        self.lowest = max(self.rank.values(), default=0.0) + UNKNOWN_PENALTY
        self.words = _Words(self.word, cached)
        # By the left piece, then the right one.
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.ahead: dict[str, tuple[str, ...]] = {}
        self.edges: dict[str, tuple[list, list] | None] = {}

    def merged(self, text: str) -> list[str]:
        """What BPE merges lead to: always the best pair, the leftmost of several."""
        parts, rank = list(text), self.rank
        while True:
            best, at = INFINITY, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1], INFINITY)
                if r < best:
                    best, at = r, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def lasts(self, left: str, right: str) -> bool:
        """Whether the acceptor lets ``right`` follow ``left``."""
        if self.n_pairs >= CACHED_PAIRS:
            for after in self.pairs.values():
                after.clear()
            self.n_pairs = 0
        lasts = not left or self.apart(left, right)
        self.pairs.setdefault(left, {})[right] = lasts
        self.n_pairs += 1
        return lasts

    def history(self, piece: str) -> tuple[list, list] | None:
        """How a piece's first and last part come about as its characters are merged: each part with
        the rank of the merge that ends it. None if merges lead elsewhere or their ranks ever fall."""
        if piece in self.edges:
            return self.edges[piece]
        parts, rank, before = list(piece), self.rank, -INFINITY
        first, last = [], []
        while len(parts) > 1:
            ranks = [rank.get(a + b, INFINITY) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == INFINITY or best < before:
                break
            at, before = ranks.index(best), best
            if at == 0:
                first.append((parts[0], best))
            if at == len(parts) - 2:
                last.append((parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        edge = (piece, INFINITY)
        found = ([*first, edge], [*last, edge]) if len(parts) == 1 else None
        if len(self.edges) >= self.words.most:
            self.edges.clear()
        self.edges[piece] = found
        return found

    def apart(self, left: str, right: str) -> bool:
        """Whether merges of the joint string never cross the border.

        Ranks of merges rise within each of the two, so both histories can be walked side by side:
        two parts that meet at the border are merged if their rank comes before the merge that ends
        either of them. Of equal ranks the leftmost comes first.
        """
        a, b = self.history(left), self.history(right)
        if a is None or b is None:
            return self.merged(left + right) == [left, right]
        (_, ends), (starts, _) = a, b
        rank, i, j = self.rank, 0, 0
        while True:
            (x, x_until), (y, y_until) = ends[i], starts[j]
            border = rank.get(x + y, INFINITY)
            if border < x_until and border <= y_until and border < INFINITY:
                return False
            if x_until <= y_until:
                if x_until == INFINITY:
                    return True
                i += 1
            else:
                j += 1

    def arcs(self, text: str, at: int) -> tuple[str, ...]:
        """Arcs of the piece transducer and the byte fallback that leave ``at``, longest first."""
        key = text[at : at + AHEAD]
        known = self.ahead.get(key)
        if known is not None:
            return known
        found, node, end = [], self.trie, at
        for end in range(at, len(text)):
            node = node.get(text[end])
            if node is None:
                break
            if "" in node:
                found.append(text[at : end + 1])
        if not found or len(found[0]) > 1:
            found.insert(0, text[at])
        arcs = tuple(reversed(found))
        # Remember what no text after the key has a part in; a short key is a text's end.
        if node is None and end < at + AHEAD or len(text) - at < AHEAD:
            if len(self.ahead) >= self.words.most:
                self.ahead.clear()
            self.ahead[key] = arcs
        return arcs

    def finite_path(self, text: str) -> list[str]:
        """The one path of finite weight: states that lead nowhere are left by the way they came."""
        size, pairs, ahead, path, at, last = len(text), self.pairs, self.ahead, [], 0, ""
        dead: set[tuple[int, str]] = set()
        while at < size:
            after = pairs.get(last) or pairs.setdefault(last, {})
            for piece in ahead.get(text[at : at + AHEAD]) or self.arcs(text, at):
                lasts = after.get(piece)
                if lasts is None:
                    lasts = self.lasts(last, piece)
                if lasts and (not dead or (at + len(piece), piece) not in dead):
                    path.append(piece)
                    at += len(piece)
                    last = piece
                    break
            else:
                dead.add((at, last))
                at -= len(path.pop())
                last = path[-1] if path else ""
        return path

    def least_path(self, text: str) -> list[str]:
        """The path of least weight: position by position, the best way there."""
        weights, by = [0.0] + [INFINITY] * len(text), [""] * (len(text) + 1)
        for at in range(len(text)):
            for piece in self.arcs(text, at):
                weight = weights[at] + self.rank.get(piece, self.lowest)
                if weight < weights[at + len(piece)]:
                    weights[at + len(piece)], by[at + len(piece)] = weight, piece
        path, at = [], len(text)
        while at:
            path.append(by[at])
            at -= len(by[at])
        return path[::-1]

    def shortest_path(self, text: str) -> list[str]:
        """Pieces of the shortest path through the lattice of ``text``."""
        return self.finite_path(text) if self.bpe else self.least_path(text)

    def emit(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        if known is not None:
            return [known]
        if self.model.byte_fallback:
            return [self.bytes[b] for b in piece.encode()]
        return [self.model.unknown]

    def word(self, pre_token: str) -> bytes:
        """Ids of a pre-token as 32-bit integers in memory order."""
        path = self.shortest_path(pre_token)
        return array("i", [i for piece in path for i in self.emit(piece)]).tobytes()

    def encode(self, text: str) -> array:
        ids = array("i")
        ids.frombytes(b"".join(map(self.words.__getitem__, pre_tokens(text, self.model))))
        return ids

    def decode(self, ids) -> str:
        """The text of ``ids``; bytes that are not UTF-8 become replacement characters."""
        text = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace")
        text = text.replace(SPACE, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def transducer(path: str, cached: int = CACHED_WORDS) -> Transducer:
    """Compiled once per Python worker."""
    return Transducer(read_model(path), cached)


def encode(documents: DataFrame, model_path: str, cached: int = CACHED_WORDS) -> DataFrame:
    """doc_id, token_ids, n_tokens, n_bytes and round_trip for every row.

    ``round_trip`` says whether decoding gives the text again; it is false only for texts with the
    space mark U+2581 itself, which decodes to a space. A null text counts as empty: no ids, true.
    Each row is encoded on its own and whole, so repeated rows, null ids and further columns,
    whatever their names, change nothing. An empty table gives an empty result. ``cached`` trades a
    worker's memory for time and has no effect on results.
    """

    def make():
        fst = transducer(model_path, cached)

        def work(part):
            texts = part.column("text")
            encoded = [fst.encode(t) if t else array("i") for t in texts.to_pylist()]
            same = [
                fst.decode(ids) == (t or "")
                for ids, t in zip(encoded, texts.to_pylist(), strict=True)
            ]
            ends = [0]
            for ids in encoded:
                ends.append(ends[-1] + len(ids))
            values = pa.array(memoryview(b"".join(x.tobytes() for x in encoded)).cast("i"), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            return part.column("doc_id"), lists, [len(x) for x in encoded], n_bytes, same

        return work

    ddl = "doc_id long, token_ids array<int>, n_tokens long, n_bytes long, round_trip boolean"
    return map_rows(documents.select("doc_id", "text"), ddl, None, text="text", make=make)


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text for rows with doc_id and token_ids; null ids give a null text."""

    def make():
        fst = transducer(model_path)

        def work(part):
            lists = part.column("token_ids").to_pylist()
            return part.column("doc_id"), [None if x is None else fst.decode(x) for x in lists]

        return work

    return map_rows(tokens.select("doc_id", "token_ids"), "doc_id long, text string", None, make=make)
