"""Landed exports: documents split at byte ranges, rejects, repeated exports."""

import json
import random

import pytest
from pyspark.sql import functions as F

from surveyloom.sources import exports as E
from surveyloom.sources import split_documents as S

TEXTS = ['a"b', '{"x', "\\", '\\\\"', "é漢\U0001f600", "[1,{", '}"]', "", '"responses":[{', "\n", "\\" * 9]
NAMES = ["a", "responses", 'b"', "k{", "responseId"]


class Bytes:
    """A file that is held in memory."""

    def __init__(self, data):
        self.data = data

    def read_at(self, size, start):
        return self.data[start : start + size]


def some_value(rnd, depth=0):
    kind = rnd.random()
    if kind < 0.3 or depth == 4:
        return rnd.choice(TEXTS)
    if kind < 0.6:
        return rnd.choice([rnd.randint(-5, 10**6), None, True, 1.5])
    if kind < 0.8:
        return {rnd.choice(NAMES): some_value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}
    return [some_value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]


def some_document(rnd):
    records = [{"responseId": str(i), "v": some_value(rnd)} for i in range(rnd.randint(0, 6))]
    before = {rnd.choice(["meta", "x"]): some_value(rnd, 1) for _ in range(rnd.randint(0, 2))}
    after = {rnd.choice(["after", "z"]): some_value(rnd, 1) for _ in range(rnd.randint(0, 2))}
    text = json.dumps({**before, "responses": records, **after}, indent=rnd.choice([None, 1]), ensure_ascii=rnd.random() < 0.5)
    return text.encode(), records


def cut(data, size):
    """All records of a document read range by range, the state carried along."""
    file, state, out = Bytes(data), (False, 0, None), []
    for start in range(0, len(data), size):
        stop = min(len(data), start + size)
        out += list(S.records_of(file, start, stop, len(data), *state, "responses"))
        structure = S.Structure(*S.beginning(file, start, stop))
        does = structure.summary(state[0])
        lowest = state[1] + does["lowest"]
        key = does["key"] if lowest == 1 else does["key_above"] if lowest == 0 else None
        state = (state[0] ^ structure.flips, state[1] + does["depth"], state[2] if key is None else key)
    return out, state


@pytest.mark.parametrize("size", [1, 2, 7, 50, 10_000])
def test_ranges_of_any_size_give_every_record_once(monkeypatch, size):
    rnd = random.Random(size)
    for _ in range(400):
        monkeypatch.setattr(S, "BEYOND", rnd.choice([1, 5, 100, 10_000]))
        data, records = some_document(rnd)
        found, (in_string, depth, _) = cut(data, size)
        good = [r for r in found if r[2] is None]
        assert [json.loads(text) for _, text, _ in good] == records
        assert all(data[place : place + len(text)] == text for place, text, _ in good)
        assert not in_string and depth == 0


def test_long_runs_of_backslashes_before_a_range():
    text = "\\" * 3000 + '"'
    data = json.dumps({"responses": [{"responseId": "1", "v": text}, {"responseId": "2"}]}).encode()
    for size in (100, 999, 4096):
        assert [json.loads(t) for _, t, _ in cut(data, size)[0]] == [{"responseId": "1", "v": text}, {"responseId": "2"}]


def test_what_is_no_record_is_named():
    data = b'{"x":[1,2],"responses":[1, {"responseId":"a"}, null, {"responseId":"b"} ,"c"]}'
    found, _ = cut(data, 10_000)
    assert sorted((t, p) for _, t, p in found) == [
        (b'"c"', "not a record"), (b"1", "not a record"), (b"null", "not a record"),
        (b'{"responseId":"a"}', None), (b'{"responseId":"b"}', None),
    ]
    cut_short = b'{"responses":[{"responseId":"a"},{"responseId":"b","v":"'
    assert [p for *_, p in cut(cut_short, 5)[0]] == [None, "the document ends inside a record"]


def land(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    rnd = random.Random(5)
    records = [{"responseId": f"R_{i}", "values": {"QID1": i, "QID2_TEXT": rnd.choice(TEXTS), "at": {"x": "{" * (i % 5)}}} for i in range(3000)]
    path = land(tmp_path / "SV_1", "export.json", json.dumps({"meta": {"responses": [{"responseId": "no"}]}, "responses": records}))
    found = E.read_export_records(spark, path, range_bytes=10_000)
    assert found.where("problem is null").select(F.spark_partition_id()).distinct().count() > 4
    got = {r["responseId"]: json.loads(r["values"]) for r in E.accepted(found).collect()}
    assert got == {r["responseId"]: r["values"] for r in records}
    assert [tuple(r)[1:] for r in E.account(found).collect()] == [(3000, 3000, 0)]


# Documents by name, what is wrong with each, and how many responses it still has.
BROKEN = {
    "html": ("<html>busy</html>", ["the document has no list"], 0),
    "cut": ('{"responses":[{"responseId":"a","values":{}},{"responseId":"b"', ["the document does not end", "the document ends inside a record"], 1),
    "open": ('{"responses":[{"responseId":"a","values":{}}]', ["the document does not end"], 1),
    "string": ('{"responses":[{"responseId":"a","values":{}}],"x":"', ["the document ends inside a string"], 1),
    "other": ('{"error":"gone"}', ["the document has no list"], 0),
    "twice": ('{"responses":[]}}', ["the document ends twice"], 0),
    "good": ('{"responses":[{"responseId":"a","values":{}}]}', [], 1),
}


@pytest.mark.parametrize("size", [9, 1 << 20])
def test_broken_documents_are_rejected_and_end_a_strict_read(spark, tmp_path, size):
    for name, (text, _, _) in BROKEN.items():
        path = land(tmp_path / "SV", name, text)
    found = E.read_export_records(spark, path, range_bytes=size).select(F.element_at(F.split("file", "/"), -1).alias("name"), "problem").collect()
    for name, (_, problems, good) in BROKEN.items():
        assert sorted(r["problem"] for r in found if r["name"] == name and r["problem"]) == problems
        assert sum(r["name"] == name and r["problem"] is None for r in found) == good
    if size > 9:
        with pytest.raises(Exception, match="malformed export"):
            E.read_responses(spark, path).collect()


def test_lines_that_are_blank_or_broken(spark, tmp_path):
    lines = ['{"responseId":"a","values":{"QID1":1}}', "", "  \t", '{"responseId":"b"', "[1]", '{"responseId":"c","values":{}}', "nonsense", "null"]
    path = land(tmp_path / "SV", "export.ndjson", "\n".join(lines) + "\n\n")
    records = E.read_export_records(spark, path, one_per_line=True)
    assert [r["responseId"] for r in E.accepted(records, "PERMISSIVE").orderBy("responseId").collect()] == ["a", "c"]
    assert sorted(r["record"] for r in E.rejected(records).collect()) == sorted(["[1]", "nonsense", "null", '{"responseId":"b"'])
    watched, observation = E.observed(records)
    assert E.accepted(watched, "PERMISSIVE").count() == 2
    assert observation.get == {"landed": 6, "parsed": 2, "rejected": 4}
    with pytest.raises(Exception, match="malformed export"):
        E.accepted(records).collect()


def test_files_of_several_documents_and_of_none(spark, tmp_path):
    land(tmp_path / "SV", "a.json", '{"responses":[{"responseId":"a","values":{}}]}\n{"responses":[{"responseId":"b","values":{}}]}')
    path = land(tmp_path / "SV", "b c é.json", '{"responses": [ ]}')
    records = E.read_export_records(spark, path, range_bytes=20)
    assert {r["responseId"] for r in E.accepted(records).collect()} == {"a", "b"}
    assert [r["landed"] for r in E.account(records).collect()] == [2]


def test_an_export_landed_twice_counts_once(spark, tmp_path):
    import os

    def export(name, at, *rows):
        path = land(tmp_path / "SV", name, "\n".join(json.dumps({"responseId": i, "values": {"QID1": v}}) for i, v in rows))
        os.utime(tmp_path / "SV" / name, (at, at))
        return path

    export("1.ndjson", 1000, ("a", 1), ("b", 1), ("c", 1))
    path = export("2.ndjson", 2000, ("b", 2), ("c", 2), ("d", 2), ("d", 2), ("d", 2))
    rows = E.read_responses(spark, path, one_per_line=True, newest=True)
    assert sorted((r["response_id"], r["answers"][0]["num"]) for r in rows.collect()) == [("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 2.0)]
    assert E.read_responses(spark, path, one_per_line=True).count() == 8
    document = {"responses": [{"responseId": "x", "values": {"QID1": 5}}, {"values": {"QID1": 6}}, {"values": {"QID1": 6}}]}
    other = land(tmp_path / "SW", "1.json", json.dumps(document))
    land(tmp_path / "SW", "2.json", json.dumps(document))
    found = E.read_responses(spark, other, newest=True).collect()
    assert sorted(str(r["response_id"]) for r in found) == ["None"] * 4 + ["x"]


def test_wide_rows_of_all_surveys_in_one_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    one = {"responses": [{"responseId": "1", "values": {"recordedDate": "2024-01-02T03:04:05Z", "QID2": ["1", "2"], "QID10": 3, "QID1_TEXT": 'say "a, b"', "geo": {"lat": 1}}},
                         {"responseId": "2", "values": {"QID1_TEXT": "line\nbreak", "QID2": ""}}]}
    two = {"responses": [{"responseId": "3", "values": {"QID9": "x", "progress": 50}}]}
    for name, document in (("SV_1", one), ("SV_2", two)):
        land(tmp_path / "in" / name, "e.json", json.dumps(document))
    responses = E.read_responses(spark, str(tmp_path / "in" / "*"))
    names = [("SV_1", "geo.lat", 3), ("SV_1", "recordedDate", 1), ("SV_1", "QID10", 9), ("SV_1", "QID2", 9), ("SV_1", "QID1_TEXT", 9), ("SV_2", "progress", 2), ("SV_2", "QID9", 9)]
    columns = E.order_columns(spark.createDataFrame(names, "survey_id string, column_id string, seen_pos int"))
    rows = E.wide_rows(responses, columns)
    found = {r["response_id"]: dict(zip(r["columns"], r["cells"])) for r in rows.collect()}
    assert [list(found[i]) for i in "13"] == [["recordedDate", "geo.lat", "QID1_TEXT", "QID2", "QID10"], ["progress", "QID9"]]
    assert found["1"] == {"recordedDate": "2024-01-02T03:04:05Z", "geo.lat": "1", "QID1_TEXT": 'say "a, b"', "QID2": '["1","2"]', "QID10": "3.0"}
    assert found["3"] == {"progress": "50.0", "QID9": "x"}
    for _ in range(2):
        E.write_wide(rows, str(tmp_path / "out"))

    def written(part, survey):
        import csv
        import io

        text = "".join(f.read_text() for f in (tmp_path / "out" / part / f"survey_id={survey}").glob("part-*"))
        return sorted(csv.reader(io.StringIO(text)))

    assert written("header", "SV_1") == [["response_id", "recordedDate", "geo.lat", "QID1_TEXT", "QID2", "QID10"]]
    assert written("rows", "SV_1") == [["1", "2024-01-02T03:04:05Z", "1", 'say "a, b"', '["1","2"]', "3.0"], ["2", "", "", "line\nbreak", "", ""]]
    assert written("rows", "SV_2") == [["3", "50.0", "x"]]
