"""The parts of a SentencePiece model that both token operators need, read from its file."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

SPACE = "▁"

# Piece types and model types in the model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass(frozen=True)
class Model:
    """Pieces with scores and kinds, and the normaliser's switches."""

    kind: int
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool
    trim: bool
    byte_fallback: bool

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)


@lru_cache(maxsize=4)
def read_model(path: str) -> Model:
    """The model in ``path``; one with a character map or space as suffix is refused."""
    from sentencepiece import sentencepiece_model_pb2 as format_pb2

    proto = format_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    rules, trainer = proto.normalizer_spec, proto.trainer_spec
    if rules.precompiled_charsmap or not rules.escape_whitespaces:
        raise ValueError("only identity normalisers with escaped spaces are supported")
    if trainer.treat_whitespace_as_suffix or USER_DEFINED in {p.type for p in proto.pieces}:
        raise ValueError("spaces as suffix and user-defined symbols are not supported")
    if trainer.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces):
        raise ValueError("pieces that go beyond a word are not supported")
    return Model(
        trainer.model_type,
        tuple(p.piece for p in proto.pieces),
        tuple(p.score for p in proto.pieces),
        tuple(p.type for p in proto.pieces),
        rules.add_dummy_prefix,
        rules.remove_extra_whitespaces,
        trainer.byte_fallback,
    )


# Pieces hold spaces in front only, so no piece goes across the start of a run of spaces: what
# begins there can be encoded on its own.
PRE_TOKEN = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def normalise(text: str, dummy_prefix: bool, trim: bool) -> str:
    text = text.replace(" ", SPACE)
    if trim:
        text = re.sub(f"{SPACE}+", SPACE, text).strip(SPACE)
    return SPACE + text if dummy_prefix and text else text


def pre_tokens(text: str, model: Model) -> list[str]:
    """The parts of the normalised text that are encoded on their own; none if it is empty."""
    return PRE_TOKEN.findall(normalise(text, model.dummy_prefix, model.trim))
