"""Records of large JSON documents, read by byte ranges.

An export is one document, ``{"responses": [{...}, {...}, ...], ...}``, of any
size. Where a byte range begins, nothing in it tells whether that place lies
inside a string, nor how deep. So a first pass reads every range under both
assumptions and keeps what it does to the state; running sums over the ranges
of a file, one row each, give the true state at the beginning of each; a second
pass then cuts out the records that begin in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.session import ship_package, store

RANGE_BYTES = 32 << 20
# Bytes read before a range, for the key of an array that opens at its beginning.
BEFORE = 256
# Bytes read at a time beyond a range, to the end of its last record.
BEYOND = 1 << 20
# The bytes that decide the structure of JSON.
QUOTE, BACKSLASH = 0x22, 0x5C
SIGN = np.zeros(256, np.int8)
SIGN[[0x7B, 0x5B]], SIGN[[0x7D, 0x5D]] = 1, -1
OPEN_LIST, OPEN_RECORD = 0x5B, 0x7B
KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.DOTALL)
# Depths inside a document: of its keys' values, and of a list's records.
OF_KEYS, OF_RECORDS = 1, 2


def open_file(path: str):
    """A random access file of a path as Spark writes it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/*", "/", path))
    system, inner = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return system.open_input_file(inner)


def read_at(file, start: int, stop: int) -> bytes:
    return file.read_at(stop - start, start) if stop > start else b""


def quotes_of(raw: np.ndarray, skip: int) -> np.ndarray:
    """Places from ``skip`` on of the quotes that begin or end a string: those after an even number of backslashes."""
    places = np.flatnonzero(raw == QUOTE)
    slash = raw == BACKSLASH
    if slash.any():
        # The last byte before each place that is no backslash.
        other = np.maximum.accumulate(np.where(slash, -1, np.arange(len(raw))))
        before = np.where(places > 0, other[places - 1], -1)
        places = places[(places - 1 - before) % 2 == 0]
    return places[places >= skip]


class Structure:
    """The brackets outside strings in the bytes from ``skip`` on, if those begin inside a string or outside."""

    def __init__(self, data: bytes, skip: int):
        self.data, self.skip = data, skip
        raw = np.frombuffer(data, np.uint8)
        quotes = quotes_of(raw, skip)
        self.flips = len(quotes) % 2 == 1
        sign = SIGN[raw[skip:]]
        places = np.flatnonzero(sign)
        self.inside = np.searchsorted(quotes, places + skip) % 2 == 1
        self.places, self.signs, self.bytes = places + skip, sign[places].astype(np.int64), raw[places + skip]

    def outside(self, in_string: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, depths before, depths after) of the brackets outside strings; depths count from the beginning."""
        kept = self.inside == in_string
        after = np.cumsum(self.signs[kept])
        return self.places[kept], after - self.signs[kept], after

    def list_key(self, place: int) -> str:
        """The key a list that opens there is the value of; nothing for an object."""
        found = KEY.search(self.data[max(0, place - BEFORE) : place]) if self.data[place] == OPEN_LIST else None
        return found[1].decode("utf-8", "replace") if found else ""

    def summary(self, in_string: bool) -> dict:
        """What the bytes do to the depth, how low it gets, and the key of what opens there last, and one higher."""
        places, before, after = self.outside(in_string)
        lowest = int(min(after.min(), before.min())) if len(places) else 0

        def last_key(depth: int) -> str | None:
            at = places[(after > before) & (before == depth)]
            return self.list_key(int(at[-1])) if len(at) else None

        return {"depth": int(after[-1]) if len(after) else 0, "lowest": lowest, "key": last_key(lowest), "key_above": last_key(lowest + 1)}

    def data_at(self, places: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.data, np.uint8)[places]


def beginning(file, start: int, stop: int) -> tuple[bytes, int]:
    """(bytes, how many of them lie before ``start``): enough before it to tell an escaped quote and a list's key."""
    before = min(start, BEFORE)
    while True:
        head = read_at(file, start - before, start)
        if before == start or head.strip(b"\\"):
            return head + read_at(file, start, stop), len(head)
        before = min(start, before * 16)


def records_of(file, start: int, stop: int, size: int, in_string: bool, depth: int, key: str | None, wanted: str):
    """(place, text, problem) of every record of the lists ``wanted`` that begins in a range."""
    data, skip = beginning(file, start, stop)
    origin = start - skip
    structure = Structure(data, skip)
    places, before, after = structure.outside(in_string)
    before, after = before + depth, after + depth
    kinds = structure.data_at(places)
    holders = np.flatnonzero((after > before) & (before == OF_KEYS))
    keys = [structure.list_key(int(places[i])) for i in holders]
    opens = np.flatnonzero((kinds == OPEN_RECORD) & (before == OF_RECORDS))
    # A bracket that leaves a list's depth closes what the last one opened there.
    closes = np.flatnonzero((after == OF_RECORDS) & (before == OF_RECORDS + 1))
    ends = np.searchsorted(closes, opens)
    list_of = np.searchsorted(holders, opens) - 1
    for i, end, of in zip(opens.tolist(), ends.tolist(), list_of.tolist()):
        if (keys[of] if of >= 0 else key) != wanted:
            continue
        place = int(places[i])
        if end < len(closes):
            yield origin + place, data[place : int(places[closes[end]]) + 1], None
        else:
            yield (origin + place, *_beyond(file, data[place:], stop, size))
    # Between a list's brackets and its records stand white space and commas, nothing else.
    for i in np.flatnonzero((after[:-1] == OF_RECORDS) & (before[1:] == OF_RECORDS)).tolist():
        first, of = int(places[i]) + 1, int(np.searchsorted(holders, i, "right")) - 1
        text = data[first : int(places[i + 1])].strip(b" \t\r\n,")
        if text and (keys[of] if of >= 0 else key) == wanted:
            yield origin + first, text, "not a record"


def _beyond(file, text: bytes, stop: int, size: int) -> tuple[bytes, str | None]:
    """(text, problem) of a record that ends after its range."""
    pieces, depth, in_string = [text], None, False
    begun = Structure(text, 0)
    depth, in_string = int(begun.outside(False)[2][-1]), begun.flips
    while stop < size:
        more, skip = beginning(file, stop, min(size, stop + BEYOND))
        structure = Structure(more, skip)
        places, _, after = structure.outside(in_string)
        closed = np.flatnonzero(after + depth == 0)
        if len(closed):
            pieces.append(more[skip : int(places[closed[0]]) + 1])
            return b"".join(pieces), None
        pieces.append(more[skip:])
        depth += int(after[-1]) if len(after) else 0
        in_string ^= structure.flips
        stop = min(size, stop + BEYOND)
    return b"".join(pieces), "the document ends inside a record"


SUMMARY = "struct<depth:long, lowest:long, key:string, key_above:string>"
SUMMARY_KIND = pa.struct([("depth", pa.int64()), ("lowest", pa.int64()), ("key", pa.string()), ("key_above", pa.string())])


def _dealt(ranges: DataFrame) -> DataFrame:
    """Ranges dealt to tasks, by number and together not much more than a few of the largest."""
    held = ranges.agg(F.count("*").alias("n"), F.sum(F.col("stop") - F.col("start")).alias("bytes")).first()
    tasks = max(min(held["n"], ranges.sparkSession.sparkContext.defaultParallelism), -(-(held["bytes"] or 0) // (4 * RANGE_BYTES)))
    return ranges.repartition(max(1, tasks))


def file_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, landed_at, size, start, stop) for each range of the landed files; listing them reads none."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), F.col("modificationTime").alias("landed_at"), F.col("length").alias("size")
    )
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    return files.select("file", "landed_at", "size", starts.alias("start")).withColumn(
        "stop", F.least(F.col("start") + range_bytes, F.col("size"))
    )


def scan_ranges(ranges: DataFrame) -> DataFrame:
    """Each range with ``flips`` (whether it changes from inside a string to outside) and what it does in either case."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = []
            for r in rows:
                with open_file(r["file"]) as file:
                    structure = Structure(*beginning(file, r["start"], r["stop"]))
                found.append((structure.flips, structure.summary(False), structure.summary(True)))
            if found:
                flips, out, inside = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(flips), pa.array(out, SUMMARY_KIND), pa.array(inside, SUMMARY_KIND)],
                    [*batch.schema.names, "flips", "outside", "inside"],
                )

    ship_package(ranges.sparkSession)
    return ranges.mapInArrow(
        scan, f"file string, landed_at timestamp, size long, start long, stop long, flips boolean, outside {SUMMARY}, inside {SUMMARY}"
    )


def with_states(scanned: DataFrame) -> DataFrame:
    """Each range with the state at its beginning, ``(in_string, depth, key)``, and at its end."""
    # One row for each range of a file, not for each record.
    order = Window.partitionBy("file").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)

    def before(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(earlier), F.lit(0))

    in_string = before(F.col("flips").cast("long")) % 2 == 1
    found = scanned.withColumn("in_string", in_string).withColumn("does", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")))
    deep = found.withColumn("depth", before(F.col("does.depth")))
    lowest = F.col("depth") + F.col("does.lowest")
    own_key = F.when(lowest == OF_KEYS, F.col("does.key")).when(lowest == OF_KEYS - 1, F.col("does.key_above"))
    return deep.withColumn("own_key", own_key).select(
        "file", "landed_at", "size", "start", "stop", "in_string", "depth",
        F.last("own_key", ignorenulls=True).over(earlier).alias("key"),
        F.last("own_key", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("key_after"),
        (F.col("depth") + F.col("does.depth")).alias("depth_after"),
        (F.col("in_string") != F.col("flips")).alias("in_string_after"),
    )


def read_records(spark: SparkSession, path: str, wanted: str = "responses", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, landed_at, position, record, problem) of landed documents, whatever their size.

    ``record`` is the text of each object in the list under the key ``wanted``
    of a document, ``position`` its first byte. What is no whole record has a
    ``problem``: an element that is no object, a record its document ends
    inside, and, without a text, a document that does not end, has text after
    its end or has no such list.
    """
    states = store(with_states(scan_ranges(_dealt(file_ranges(spark, path, range_bytes)))), "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with open_file(r["file"]) as file:
                    found, held = [], 0
                    rows = records_of(file, r["start"], r["stop"], r["size"], r["in_string"], r["depth"], r["key"], wanted)
                    for place, text, problem in rows:
                        found.append((place, text.decode("utf-8", "replace"), problem))
                        held += len(text)
                        if held > 4 << 20:
                            yield _rows(r, found)
                            found, held = [], 0
                    if found:
                        yield _rows(r, found)

    records = _dealt(states).mapInArrow(cut, "file string, landed_at timestamp, position long, record string, problem string")
    ended = states.where("stop = size").select(
        "file", "landed_at", F.col("size").alias("position"), F.lit(None).cast("string").alias("record"),
        F.when(F.col("in_string_after"), "the document ends inside a string")
        .when(F.col("depth_after") > 0, "the document does not end")
        .when(F.col("depth_after") < 0, "the document ends twice")
        .when(F.col("key_after").isNull(), "the document has no list")
        .alias("problem"),
    ).where("problem is not null")
    # Stored, so that nothing done with the problems is done with ranges that have none.
    return records.unionByName(store(ended, "ends"))


def _rows(source: dict, found: list[tuple]) -> pa.RecordBatch:
    place, text, problem = zip(*found)
    landed = pa.array([source["landed_at"]] * len(found), pa.timestamp("us", "UTC"))
    return pa.RecordBatch.from_arrays(
        [pa.array([source["file"]] * len(found)), landed, pa.array(place, pa.int64()), pa.array(text, pa.string()), pa.array(problem, pa.string())],
        ["file", "landed_at", "position", "record", "problem"],
    )
