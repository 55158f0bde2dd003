"""License scans: ordered signature rules behind keywords, overlapping detections resolved."""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches, plain_words, utf8
from surveyloom.llm.license_rules import GRANT, NAME, SHORT, TEXT, Rule, build_rules

BASE = {b"cc by": "cc-by", b"general public license": "gpl", b"all rights reserved": "reserved"}
BASE_PATTERN = re.compile(rb"(?<![^ ])(?:" + b"|".join(BASE) + rb")(?![^ ])")
# Detections are compared within stretches of two to this power bytes.
STRETCH = 8
# How sure a detection of each priority is.
SURE = {TEXT: 0.95, GRANT: 0.9, NAME: 0.7, SHORT: 0.4}


@cache
def rules_by_keyword() -> dict[bytes, list[Rule]]:
    """Rules under their keywords, each keyword's in order of priority."""
    groups: dict[bytes, list[Rule]] = {}
    for rule in sorted(build_rules(), key=lambda r: -r.priority):
        groups.setdefault(rule.keyword, []).append(rule)
    return groups


def detect(words: bytes) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of every detection in text of plain words that no other one suppresses.

    Detections are taken by priority, then by length; one that lies inside a
    taken one of the same or a higher priority is suppressed, one that only
    overlaps stays.
    """
    found = [
        (m.start(), m.end(), rule)
        for keyword, rules in rules_by_keyword().items()
        if keyword in words
        for rule in rules
        for m in rule.pattern.finditer(words)
    ]
    found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
    taken: list[tuple[int, int, Rule]] = []
    # Taken intervals by the stretches of text they touch.
    touching: dict[int, list[tuple[int, int]]] = {}
    for start, end, rule in found:
        if not any(a <= start and end <= b for a, b in touching.get(start >> STRETCH, ())):
            taken.append((start, end, rule))
            for stretch in range(start >> STRETCH, (end >> STRETCH) + 1):
                touching.setdefault(stretch, []).append((start, end))
    return sorted(taken, key=lambda d: (d[0], d[1]))


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label:string,priority:int,first_word:bigint,n_words:bigint>>"
)
DETECTION = pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64())])


def scan_text(text: bytes) -> tuple:
    words = plain_words(text)
    joined = b" ".join(words)
    base = [(m.start(), BASE[m[0]]) for m in BASE_PATTERN.finditer(joined)]
    starts = [0, *accumulate(len(w) + 1 for w in words)]

    def place(at: int) -> int:
        """The number of the word that holds or follows a byte."""
        return bisect_left(starts, at)

    detections = detect(joined)
    doubt = 1.0
    for priority in {rule.label: rule.priority for _, _, rule in detections}.values():
        doubt *= 1 - SURE[priority]
    base_labels = {label for _, label in base}
    return (
        len(words),
        len(base),
        place(base[0][0]) if base else None,
        place(base[-1][0]) if base else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | {rule.label for _, _, rule in detections})),
        1 - doubt if detections else 0.0,
        [
            {"label": r.label, "priority": r.priority, "first_word": place(a), "n_words": place(b) - place(a)}
            for a, b, r in detections
        ],
    )


def scan(df: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) for every row.

    ``n_base`` counts the places of the base phrases; ``labels`` has their
    labels and those of all detections. ``score`` says how likely the text
    states a license at all: 0 without a detection.

    Null and empty texts have no words and no labels (empty strings); null ids
    and repeated rows come back as they are; an empty table gives no rows. Other
    columns are not looked at.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*map(scan_text, utf8(batch.column(1))))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(DETECTION)]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["ident", *names]
        )

    kind = df.schema[ident].dataType.simpleString()
    narrow = df.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    return map_batches(narrow, one, f"ident {kind}, {SCHEMA}").withColumnRenamed("ident", ident)
