"""SentencePiece BPE by a prefix table: the last token of every prefix, and ids recovered backwards.

A row of tokens is what BPE makes of a text exactly if BPE leaves each token by
itself whole and never merges across the boundary of two neighbours: inside two
neighbours merges come in the same order whatever stands around them. So the
encoding of a prefix has one last token: of the tokens that end there (found
by an automaton over all pieces) the only one that is compatible with the last
token of the prefix before it. A table of these last tokens is filled from left
to right, and the ids are read from its end backwards.
"""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import Memo
from surveyloom.llm.piece_model import BYTE, CONTROL, NORMAL, SPACE, UNKNOWN, PieceModel
from surveyloom.session import ship_package

# Segments up to this many characters are remembered; longer ones are encoded where they stand.
REMEMBERED_CHARS = 48
# Segments, and pairs of tokens, that a worker remembers.
REMEMBERED, REMEMBERED_PAIRS = 100_000, 400_000
# Rows are handed back when they hold this many bytes.
BATCH_BYTES = 8 << 20
NEVER = float("inf")
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


def merges(text: str, priority: dict[str, float]) -> tuple[list[str], list[tuple[float, str, str]]]:
    """The symbols BPE leaves of a text, and (priority, left edge, right edge) after each merge."""
    symbols, steps = list(text), []
    while len(symbols) > 1:
        pairs = [priority.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        best = min(pairs)
        if best == NEVER:
            break
        at = pairs.index(best)
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        steps.append((best, symbols[0], symbols[-1]))
    return symbols, steps


class Decoder:
    """Texts of ids."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.raw = [t.replace(SPACE, " ").encode() for t in model.texts]
        for i in model.of_kind(BYTE):
            self.raw[i] = bytes([int(model.texts[i][3:-1], 16)])
        for i in model.of_kind(UNKNOWN):
            self.raw[i] = " ⁇ ".encode()  # how the library shows an unknown piece
        self.controls = np.zeros(len(model.texts), bool)
        for i in model.of_kind(CONTROL):
            self.raw[i], self.controls[i] = b"", True

    def decode(self, ids: bytes) -> str:
        """The text of ids: control ids are dropped, bytes that are not UTF-8 become U+FFFD one by one."""
        listed = np.frombuffer(ids, "<u4")
        control = self.controls[listed]
        # A control id ends a run of bytes, so what stands on both sides is read apart.
        runs = np.split(listed, np.flatnonzero(control))
        raw = [b"".join(map(self.raw.__getitem__, run.tolist())) for run in runs]
        text = "".join([r.decode("utf-8", "one_by_one") for r in raw])
        first = int(control.argmin()) if len(listed) else 0
        marked = self.model.dummy_prefix and not control.all() and self.model.texts[listed[first]].startswith(SPACE)
        return text[1:] if marked else text


class Followers(dict):
    """Whether BPE keeps a token apart from each one that may follow it."""

    def __init__(self, table: PrefixTable, token: str):
        super().__init__()
        self.table, self.token = table, token

    def __missing__(self, following: str) -> bool:
        value = self.table.joins(self.token, following)
        self.table.count_pair()
        self[following] = value
        return value


class PrefixTable:
    """Ids of texts under a BPE model."""

    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model = model
        normal = model.of_kind(NORMAL)
        self.ids = {model.texts[i]: i for i in normal}
        # What is merged first has the smaller number.
        self.priority = {model.texts[i]: -model.scores[i] for i in normal if len(model.texts[i]) > 1}
        self.steps: dict[str, list] = {}
        self.automaton = ahocorasick.Automaton()
        for text in self.ids:
            symbols, steps = merges(text, self.priority)
            # A piece that BPE does not make of its own text is no token of any encoding.
            if len(symbols) == 1:
                self.steps[text] = steps
                self.automaton.add_word(text, text)
        self.automaton.make_automaton()
        self.followers = {text: Followers(self, text) for text in self.steps}
        # The text's beginning and a character without a piece are never merged with.
        self.anything = defaultdict(lambda: True)
        self.pairs = 0
        self.spaced = Memo(lambda word: self._segments(SPACE + word), REMEMBERED)
        self.known = Memo(self._segments, REMEMBERED)
        byte_ids = {int(model.texts[i][3:-1], 16): i for i in model.of_kind(BYTE)}
        self.byte_ids = [byte_ids[b] for b in range(256)]
        longer = list(self.priority)
        # What stands between two segments is crossed by no piece.
        self.by_words = not any(a != SPACE and b == SPACE for t in longer for a, b in zip(t, t[1:]))
        apart = "".join(c for c in map(chr, range(32)) if not any(c in t for t in longer))
        self.by_lines = "\n" in apart
        alone = re.escape(apart)
        self.cuts = re.compile(
            (f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]" if apart else f"{SPACE}*[^{SPACE}]+|{SPACE}+") if self.by_words else r"(?s).+"
        )

    # --- pair compatibility ---

    def count_pair(self) -> None:
        """Forget all pairs when there are too many, which costs time but changes no result."""
        self.pairs += 1
        if self.pairs > REMEMBERED_PAIRS:
            for one in self.followers.values():
                one.clear()
            self.pairs = 0

    def joins(self, first: str, second: str) -> bool:
        """Whether BPE keeps two neighbouring tokens apart.

        Replays the merges inside both in the order of BPE and looks whether one
        across the boundary would ever have come first.
        """
        left, right = self.steps[first], self.steps[second]
        x, y = first[-1], second[0]
        i = j = 0
        while True:
            before = left[i][0] if i < len(left) else NEVER
            after = right[j][0] if j < len(right) else NEVER
            # Of equal merges the leftmost comes first.
            across = self.priority.get(x + y, NEVER)
            if across < before and across <= after and across != NEVER:
                return False
            if before == after == NEVER:
                return True
            if before <= after:
                x = left[i][2]
                i += 1
            else:
                y = right[j][1]
                j += 1

    # --- encoding ---

    def last_tokens(self, segment: str) -> list[str]:
        """The last token of each prefix, from the empty one on; a character without a piece is its own token."""
        last = ["", *segment]
        follows = [self.anything] * len(last)
        followers, filled = self.followers, 0
        for end, token in self.automaton.iter(segment):
            end += 1
            if end != filled and follows[end - len(token)][token]:
                last[end], follows[end], filled = token, followers[token], end
        return last

    def _segments(self, text: str) -> bytes:
        """Ids of a normalised text, cut where no piece reaches across."""
        out = array("I")
        for segment in self.cuts.findall(text):
            last = self.last_tokens(segment)
            ids, at = [], len(segment)
            while at:
                token = last[at]
                known = self.ids.get(token)
                if known is None:
                    ids += [self.byte_ids[b] for b in reversed(token.encode())]
                else:
                    ids.append(known)
                at -= len(token)
            out.extend(reversed(ids))
        return out.tobytes() if LITTLE else np.array(out, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        plain = self.by_words and self.by_lines and self.model.dummy_prefix and "  " not in text and SPACE not in text
        if not plain or not text or text[0] == " ":
            known = self.known
            return b"".join([
                known[s] if len(s) <= REMEMBERED_CHARS else self._segments(s) for s in self.cuts.findall(self.model.normal(text))
            ])
        # One space at a time: words, each with the space before it, and the beginnings of lines, which have none.
        out, spaced, mark = [], self.spaced, SPACE
        for line in text.split("\n"):
            first, *words = line.split(" ")
            if out:
                out.append(self.known["\n"])
            out.append(self._word(mark + first))
            mark = ""
            out += [spaced[w] if len(w) <= REMEMBERED_CHARS else self._segments(SPACE + w) for w in words]
        return b"".join(out)

    def _word(self, word: str) -> bytes:
        return self.known[word] if len(word) <= REMEMBERED_CHARS else self._segments(word)


def one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_by_one", one_by_one)


@lru_cache(maxsize=2)
def encoder_of(data: bytes) -> PrefixTable:
    """The table of a model, built once in each Python worker."""
    return PrefixTable(PieceModel.read(data))


@lru_cache(maxsize=2)
def decoder_of(data: bytes) -> Decoder:
    return Decoder(PieceModel.read(data))


def sliced(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose rows hold bounded bytes; a larger row is a slice of its own."""
    first = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > BATCH_BYTES:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    yield batch.slice(first)


def _made(df: DataFrame, column: str, keep: list[str], kinds: dict[str, str], model: str, tool: Callable, make: Callable) -> DataFrame:
    """The columns ``keep`` with the columns ``kinds`` that ``make(tool(model's bytes), value of column)`` gives for each row."""
    spark = df.sparkSession
    ship_package(spark)
    data = spark.sparkContext.broadcast(Path(model).read_bytes())  # the file has a fixed size
    arrow = {"binary": pa.binary(), "string": pa.string()}

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = tool(data.value)
            at = batch.schema.get_field_index(column)
            # Rows of a large batch are taken in slices, so that no more than one slice of results is held.
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
            for part in sliced(batch, sizes) if batch.num_rows else []:
                made = zip(*[make(table, v) for v in part.column(at).to_pylist()])
                kept = [part.column(part.schema.get_field_index(n)) for n in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *(pa.array(m, arrow[k]) for m, k in zip(made, kinds.values()))], [*keep, *kinds]
                )

    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep] + [f"`{n}` {k}" for n, k in kinds.items()]
    return df.mapInArrow(over, ", ".join(fields))


def encode(
    df: DataFrame, model: str, ident: str = "doc_id", text: str = "text", begin: bool = True, end: bool = True,
    decoded: bool = False,
) -> DataFrame:
    """(ident, ids): the ids of every whole text, as little-endian unsigned 32-bit integers, rows as they come.

    ``model`` is the path of a SentencePiece BPE file with byte fallback. ``begin``
    and ``end`` put ids 1 and 2 around. Null and empty texts have these alone;
    null ids and repeated rows come back as they are; an empty table gives no
    rows. Other columns are not looked at. Texts stay in their tasks. With
    ``decoded`` the text that :func:`decode` makes of the ids comes too, in the
    same pass.
    """
    first, last = (i.to_bytes(4, "little") if asked else b"" for i, asked in ((1, begin), (2, end)))
    narrow = df.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    if decoded:
        def tools(data: bytes) -> tuple[PrefixTable, Decoder]:
            return encoder_of(data), decoder_of(data)

        def both(found: tuple[PrefixTable, Decoder], t: str | None) -> tuple[bytes, str]:
            ids = first + found[0].encode(t or "") + last
            return ids, found[1].decode(ids)

        made = _made(narrow, "text", ["ident"], {"ids": "binary", "text": "string"}, model, tools, both)
    else:
        made = _made(narrow, "text", ["ident"], {"ids": "binary"}, model, encoder_of, lambda table, t: (first + table.encode(t or "") + last,))
    return made.withColumnRenamed("ident", ident)


def decode(df: DataFrame, model: str, ident: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(ident, ids, text): the text of each row's ids; null ids have a null text."""
    narrow = df.select(F.col(ident).alias("ident"), F.col(ids).alias("ids"))
    made = _made(narrow, "ids", ["ident", "ids"], {"text": "string"}, model, decoder_of, lambda table, i: (None if i is None else table.decode(i),))
    return made.withColumnRenamed("ident", ident)
