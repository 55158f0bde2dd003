"""What a SentencePiece model file says: pieces, their kinds and the normalisation around them."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

# Fixed values of the file format: kinds of pieces, and the mark that stands for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            value = data[at : at + size]
            at += size
        yield key >> 3, value


@dataclass
class PieceModel:
    """The pieces of a BPE model with byte fallback, in the order of their ids."""

    texts: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    dummy_prefix: bool = True

    @classmethod
    def read(cls, data: bytes) -> PieceModel:
        """The model in a file's bytes; a ValueError where it asks for what is not built here."""
        model = cls()
        trainer: dict[int, int | bytes] = {}
        normalizer: dict[int, int | bytes] = {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                model.texts.append(piece[1].decode())
                model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                model.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
            raise ValueError("only BPE models with byte fallback are supported")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models that change nothing but spaces are supported")
        if not set(model.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with user-defined or unused pieces are not supported")
        model.dummy_prefix = bool(normalizer.get(3, 1))
        return model

    def of_kind(self, kind: int) -> list[int]:
        return [i for i, k in enumerate(self.kinds) if k == kind]

    def normal(self, text: str) -> str:
        """The text as pieces cover it: spaces marked, and one before a text that is not empty."""
        marked = text.replace(" ", SPACE)
        return SPACE + marked if self.dummy_prefix and marked else marked
