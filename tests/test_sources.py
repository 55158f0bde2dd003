"""Landed JSON files: exports, definitions, listings, written tables."""

import datetime
import json

import pytest

from pyspark.sql import functions as F

from checks import views as V
from surveyloom.operators import blocks as B
from surveyloom.operators import filters as flt
from surveyloom.operators import questions as Q
from surveyloom.plans.dimensions import survey_dimensions
from surveyloom.sources import definitions as D
from surveyloom.sources import exports as E
from surveyloom import session
from surveyloom.sources import listings as L
from surveyloom.sources import rejects as R
from surveyloom.sources import tables as T

EXPORT = {"responses": [
    {"responseId": "R_1", "values": {
        "recordedDate": "2024-06-27T00:00:00Z", "endDate": "2024-06-27T00:00:00.250Z", "distributionChannel": "anonymous",
        "progress": 100, "QID1": 1, "QID2": ["1", "3"], "QID3_TEXT": "Good, {thanks}", "QID4_1": 2.5, "geo": {"lat": 1, "at": {"city": "x"}},
        "QID6": True, "2_QID1": "2"}},
    {"responseId": "R_2", "values": {"recordedDate": "2024-07-08T10:00:00Z", "distributionChannel": "preview", "QID1": 2}},
    {"values": {"_recordId": "R_3", "recordedDate": "2024-07-08T00:00:00Z", "progress": 90, "QID2": [], "QID138": 4}},
    {"responseId": "R_4", "values": {"recordedDate": "not a date", "progress": 10, "QID1": None}},
]}


def landed(tmp_path, one_per_line=False):
    folder = tmp_path / "SV_1"
    folder.mkdir()
    if one_per_line:
        (folder / "export.ndjson").write_text("\n".join(json.dumps(r) for r in EXPORT["responses"]))
    else:
        (folder / "export.json").write_text(json.dumps(EXPORT, indent=1))
    return str(folder)


def check_responses(spark, rows):
    found = {r["response_id"]: r for r in rows.collect()}
    assert set(found) == {"R_1", "R_2", "R_3", "R_4"}
    first = found["R_1"]
    assert first["survey_id"] == "SV_1"
    assert first["recorded_at"] == datetime.datetime(2024, 6, 27)
    assert first["end_at"].microsecond == 250000
    assert first["progress"] == 100.0 and first["meta"] == {"geo.lat": "1", "geo.at.city": "x"}
    answers = {a["column_id"]: a for a in first["answers"]}
    assert {k: a["kind"] for k, a in answers.items()} == {
        "QID1": "number", "QID2": "list", "QID3_TEXT": "text", "QID4_1": "number", "QID6": "bool", "2_QID1": "text"}
    assert answers["QID2"]["items"] == ["1", "3"] and answers["QID4_1"]["num"] == 2.5
    assert found["R_3"]["channel"] is None and [a["items"] for a in found["R_3"]["answers"] if a["kind"] == "list"] == [[]]
    assert found["R_4"]["recorded_at"] is None and found["R_4"]["answers"] == []
    kept = flt.drop_all_null(flt.drop_preview(rows))
    assert {r["response_id"] for r in kept.collect()} == {"R_1", "R_3"}
    ranged = flt.date_range(rows, "2024-06-27", "2024-07-08")
    assert {r["response_id"] for r in ranged.collect()} == {"R_1", "R_3"}


def test_read_responses(spark, tmp_path):
    check_responses(spark, E.read_responses(spark, landed(tmp_path)))


def test_read_responses_line_by_line(spark, tmp_path):
    check_responses(spark, E.read_responses(spark, landed(tmp_path, True), one_per_line=True))


def test_times_do_not_depend_on_the_session_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = E.read_responses(spark, landed(tmp_path)).filter("response_id = 'R_1'").first()
        assert row["recorded_at"] == datetime.datetime(2024, 6, 27)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_export_keeps_its_columns(spark, tmp_path):
    (tmp_path / "empty.json").write_text('{"responses": []}')
    rows = E.read_responses(spark, str(tmp_path))
    assert rows.collect() == [] and "answers" in rows.columns


def test_wide_view(spark, tmp_path):
    row = E.wide_responses(E.read_responses(spark, landed(tmp_path)), ["QID1", "QID2", "QID99"]).filter("response_id = 'R_1'").first()
    assert (row["QID1"], row["QID2"], row["QID99"]) == ("1.0", '["1","3"]', None)


def choice(recode, text, image=None):
    return {"recode": recode, "choiceText": text, **({"imageDescription": image} if image is not None else {})}


def question(kind, selector, text="Text", **rest):
    return {"questionName": "N" + kind, "questionText": text, "questionType": {"type": kind, "selector": selector}, **rest}


DEFINITION = {"result": {
    "questions": {
        "QID1": question("MC", "SAVR", " <b>Pick</b> one ", choices={"1": choice(1, "<i>Yes</i>"), "2": choice("2", "No", "A picture"), "3": choice(2, "again")}),
        "QID2": question("TE", "ML"),
        "QID3": question("TE", "SL", validation={"type": "ValidNumber"}),
        "QID4": question("Matrix", "Likert", subQuestions={"1": {"choiceText": "a"}, "2": {"choiceText": "b"}}, choices={"1": choice("1", "low"), "2": choice("2", "high", "")}),
        "QID5": question("CS", "HR", choices={"1": choice("1", "first")}),
        "QID6": question("RO", "DND", choices={"1": choice("1", "x"), "2": choice("2", "y", "why")}),
        "QID7": question("Slider", "STAR", choices={"1": choice("1", "stars")}),
        "QID8": question("Timing", "PageTimer"),
        "QID9": question("SS", "TA"),
        "QID10": question("PGR", "DragAndDrop", groups={"0": {"description": "g"}}, items={"1": {"description": "i1"}, "2": {"description": "i2"}}),
        "QID11": question("FileUpload", "FileUpload"), "QID12": question("Meta", "Browser"),
        "QID13": question("Draw", "Signature"), "QID14": question("SBS", "SBSMatrix"), "QID15": question("DB", "TB"),
    },
    "blocks": {
        "B1": {"description": "First", "elements": [{"type": "Question", "questionId": "QID1"}, {"type": "Page Break"}, {"type": "Question", "questionId": "QID99"}]},
        "B2": {"elements": [{"type": "Question", "questionId": "QID4"}]},
        "B3": {"description": "Deep", "elements": [{"type": "Question", "questionId": "QID7"}]},
        "B4": {"description": "Hidden", "elements": [{"type": "Question", "questionId": "QID2"}]},
    },
    "flow": [{"type": "Branch", "flow": [{"type": "Branch", "flow": [{"type": "Block", "id": "B3"}]}, {"type": "Block", "id": "B2"}]},
             {"type": "Group", "flow": [{"type": "Block", "id": "B4"}]}, {"type": "Block", "id": "B1"}, {"type": "Branch"}],
}}
FULL = {"result": {"Questions": {"QID6": {"ChoiceOrder": [2, "1"]}}}}
COLUMNS = ["QID1", "2_QID1", "QID1_3_TEXT", "QID2_TEXT", "QID3_TEXT", "QID4_1", "QID4_2", "QID5_1", "QID6_1", "QID6_2", "QID6_TEXT", "QID7_1", "QID7_5",
           "QID8_CLICK", "QID9", "QID10_0_GROUP", "QID10_0_1", "QID11", "QID12", "QID13", "QID14#1_1", "QID15", "QID77", "endDate"]

EXPECTED = {  # column: text, type, data type
    "QID1": ("Pick one", "MC", "MultipleChoice"), "2_QID1": ("Pick one", "MC", "MultipleChoice"), "QID1_3_TEXT": ("Pick one", "TE", "FreeText"),
    "QID2_TEXT": ("Text", "TE", "FreeText"), "QID3_TEXT": ("Text", "TE", "Numeric"), "QID4_1": ("Text| a", "Matrix", "MultipleChoice"),
    "QID4_2": ("Text| b", "Matrix", "MultipleChoice"), "QID5_1": ("Text| first", "CS", "Numeric"), "QID6_1": ("Text | why", "RO", "Numeric"),
    "QID6_2": ("Text | x", "RO", "Numeric"), "QID6_TEXT": ("Text", "RO", "Numeric"), "QID7_1": ("Text | stars", "Slider", "Numeric"),
    "QID7_5": ("Text | ", "Slider", "Numeric"), "QID8_CLICK": ("Text", "Timing", "Numeric"), "QID9": ("Text", "SS", "Numeric"),
    "QID10_0_GROUP": ("Text| g", "PGR", "Group"), "QID10_0_1": ("Text", "PGR", "Group"), "QID11": ("Text", "FileUpload", "FileUpload"),
    "QID12": ("Text", "Meta", "MetaData"), "QID13": ("Text", "Draw", "Draw"), "QID14#1_1": ("Text", "SBS", "Dates"), "QID15": ("Text", "DB", "Unknown"),
}


def documents(spark, tmp_path):
    for name, content in (("plain", DEFINITION), ("full", FULL)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "SV_1.json").write_text(json.dumps(content))
    return [D.read_documents(spark, str(tmp_path / n)) for n in ("plain", "full")]


def test_question_and_choice_dimensions(spark, tmp_path):
    plain, full = documents(spark, tmp_path)
    columns = spark.createDataFrame([("SV_1", c) for c in COLUMNS], "survey_id string, column_id string")
    questions, choices = Q.question_tables(columns, D.full_definition_join(D.read_definitions(plain), full))
    found = {r["column_id"]: (r["question_text"], r["question_type"], r["data_type"]) for r in questions.collect()}
    assert found == EXPECTED
    offered = {}
    for r in choices.orderBy("choice_pos").collect():
        offered.setdefault(r["column_id"], []).append((r["answer_id"], r["question_value"]))
    assert offered["QID1"] == offered["2_QID1"] == [("1", "Yes"), ("2", "A picture")]
    assert offered["QID4_2"] == [("1", "low"), ("2", "high")]
    assert offered["QID6_1"] == [("1", "1"), ("2", "2")] and len(offered["QID7_5"]) == 5
    assert set(offered) == {"QID1", "2_QID1", "QID4_1", "QID4_2", "QID6_1", "QID6_2", "QID7_1", "QID7_5"}
    items = Q.group_items(columns, D.full_definition_join(D.read_definitions(plain), full)).collect()
    assert {(r["column_id"], r["item_id"], r["item_text"]) for r in items} == {("QID10_0_GROUP", "1", "i1"), ("QID10_0_GROUP", "2", "i2")}


def test_flow_opens_branches_only(spark, tmp_path):
    plain, full = documents(spark, tmp_path)
    parsed = D.parse_definitions(plain)
    assert [r["block_id"] for r in B.flow_order(parsed).orderBy("block_pos").collect()] == ["B3", "B2", "B1"]
    rows = B.blocks(parsed).orderBy("block_pos", "element_pos").collect()
    assert [(r["block_name"], r["base_qid"]) for r in rows] == [("Deep", "QID7"), ("No Description", "QID4"), ("First", "QID1"), ("First", "QID99")]
    answers = F.array(F.struct("column_id"))
    responses = spark.createDataFrame([("SV_1", c) for c in COLUMNS], "survey_id string, column_id string").select("survey_id", answers.alias("answers"))
    dims = survey_dimensions(responses, plain, full)
    placed = [r["column_id"] for r in dims.questions.orderBy("flow_pos").collect()]
    assert placed == ["QID7_1", "QID7_5", "QID4_1", "QID4_2", "QID1", "2_QID1", "QID1_3_TEXT"] or placed[:4] == ["QID7_1", "QID7_5", "QID4_1", "QID4_2"]
    assert set(placed) == {"QID7_1", "QID7_5", "QID4_1", "QID4_2", "QID1", "2_QID1", "QID1_3_TEXT"}


def test_listings(spark, tmp_path):
    pages = [{"result": {"elements": [{"id": "1", "name": "a"}, {"id": "2", "name": "b"}], "nextPage": "https://example.com/s?offset=2"}},
             {"result": {"elements": [{"id": "2", "name": "b"}, {"id": "3", "name": "b"}], "nextPage": None}}]
    for i, page in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(page))
    landed_pages = L.read_pages(spark, str(tmp_path))
    surveys = L.union_pages(landed_pages, L.ENTITIES["surveys"], id_field="id")
    assert {(r["id"], r["name"]) for r in surveys.collect()} == {("1", "a"), ("2", "b"), ("3", "b")}
    assert {r[0] for r in landed_pages.select(L.next_offset(F.col("page"))).collect()} == {"2", None}
    for name, expected in (("a", ("1", "ok")), ("b", (None, "ambiguous")), ("c", (None, "missing"))):
        assert tuple(Q.survey_id_by_name(surveys, name).first()) == expected
    for entity in L.ENTITIES:
        assert L.list_elements(landed_pages, entity).count() == 4


def test_written_tables_read_back(spark, tmp_path):
    table = spark.createDataFrame([("s1", 1), ("s1", 2), ("s2", 3)], "survey_id string, n int")
    for format in ("parquet", "csv"):
        path = str(tmp_path / format)
        T.write_tables(table, path, format, **({"header": "true"} if format == "csv" else {}))
        back = T.read_table(spark, path, format)
        assert {(r["survey_id"], int(r["n"])) for r in back.collect()} == {("s1", 1), ("s1", 2), ("s2", 3)}


def test_writing_one_survey_leaves_the_others(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "survey_id string, n int"
    T.write_tables(spark.createDataFrame([("a", 1), ("b", 2)], schema), path)
    T.write_tables(spark.createDataFrame([("b", 3), ("c", 4)], schema), path)
    expected = {("a", 1), ("b", 3), ("c", 4)}

    def stored():
        return {(r["survey_id"], r["n"]) for r in T.read_table(spark, path).collect()}

    assert stored() == expected
    failing = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("survey_id"),
        F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("id").cast("int")).alias("n"),
    )
    with pytest.raises(Exception, match="broken"):
        T.write_tables(failing, path)
    assert stored() == expected


def page(next_offset, *ids, name="n"):
    following = None if next_offset is None else f"https://example.com/s?offset={next_offset}"
    return json.dumps({"result": {"elements": [{"id": i, "name": name} for i in ids], "nextPage": following}})


PAGES = "offset string, landed int, page string"


def chain_of(spark, rows, **more):
    chain, problems = L.page_chain(spark.createDataFrame(rows, PAGES), **more)
    return {r["offset"]: r["position"] for r in chain.collect()}, sorted((r["offset"], r["problem"]) for r in problems.collect())


def test_a_listing_is_followed_page_by_page(spark):
    whole = [(str(i), 1, page(i + 1 if i < 40 else None, str(i))) for i in range(41)]
    assert chain_of(spark, whole) == ({str(i): i for i in range(41)}, [])
    assert L.complete_pages(spark.createDataFrame(whole, PAGES)).count() == 41
    assert chain_of(spark, whole[:1] and [("0", 1, page(None))]) == ({"0": 0}, [])


def test_gaps_circles_and_missing_beginnings_of_a_listing(spark):
    rows = [(str(i), 1, page(i + 1 if i < 9 else None, str(i))) for i in range(10) if i != 4]
    places, problems = chain_of(spark, rows)
    assert places == {**{str(i): i for i in range(4)}, **{str(i): None for i in range(5, 10)}}
    assert problems == [("4", "not landed"), ("5", "no landed page leads to it")]
    with pytest.raises(ValueError, match="4 not landed|5 no landed page"):
        L.complete_pages(spark.createDataFrame(rows, PAGES))
    circle = [("0", 1, page(None)), ("a", 1, page("b")), ("b", 1, page("c")), ("c", 1, page("a"))]
    assert chain_of(spark, circle) == ({"0": 0, "a": None, "b": None, "c": None}, [(o, "its pages lead in a circle") for o in "abc"])
    assert ("0", "the first page was not landed") in chain_of(spark, [("5", 1, page(None))])[1]
    home = [("0", 1, page("1")), ("1", 1, page("0"))]
    assert chain_of(spark, home) == ({"0": 0, "1": 1}, [])


def test_the_last_landed_version_of_an_element_stays(spark):
    rows = [("0", 1, page("1", "x", name="older")), ("0", 2, page("1", "x", "y", name="newer")), ("1", 1, page(None, "y", name="oldest"))]
    pages = spark.createDataFrame(rows, PAGES)
    elements = L.union_pages(pages, "id string, name string", id_field="id", order="landed")
    assert {tuple(r) for r in elements.collect()} == {("x", "newer"), ("y", "newer")}
    assert chain_of(spark, rows) == ({"0": 0, "1": 1}, [])


BROKEN = '{"responses":[{"responseId":"R","values":{"QID1":1}}'


def test_a_broken_export_is_not_left_out_in_silence(spark):
    documents = spark.createDataFrame([("S", BROKEN), ("S", '{"responses":[{"responseId":"Q","values":{"QID1":1}}]}')], "survey_id string, document string")
    with pytest.raises(Exception, match="(?i)malformed"):
        E.explode_documents(documents, "document").collect()
    assert [r["responseId"] for r in E.explode_documents(documents, "document", "PERMISSIVE").collect()] == ["Q"]


def test_a_broken_definition_is_not_left_out_in_silence(spark):
    documents = spark.createDataFrame([("S", '{"result":{"questions":{"QID1":{')], "survey_id string, document string")
    with pytest.raises(Exception, match="(?i)malformed"):
        D.read_definitions(documents).collect()
    assert D.read_definitions(documents, "PERMISSIVE").count() == 0


def test_a_broken_page_is_not_left_out_in_silence(spark):
    pages = spark.createDataFrame([('{"result":{"elements":[{"id":"1"',)], "page string")
    with pytest.raises(Exception, match="(?i)malformed"):
        L.union_pages(pages, "id string").collect()
    assert L.union_pages(pages, "id string", mode="PERMISSIVE").count() == 0


def test_a_name_given_twice_keeps_the_last(spark):
    values = '{"a.b":1,"a":{"b":2},"QID1_1":3,"text":"' + "{" * 50 + '"}'
    exported = spark.createDataFrame([("R", values)], "responseId string, values string")
    row = E.responses_from_values(exported, F.lit("S")).first()
    assert row["meta"] == {"a.b": "2", "text": "{" * 50} and [a["num"] for a in row["answers"]] == [3.0]


def test_broken_documents_and_pages_are_accounted_for(spark):
    good = json.dumps(DEFINITION)
    documents = spark.createDataFrame([("a", good), ("b", good[:-1]), ("c", "[1]"), ("d", ""), ("e", None), ("f", "{}")], "survey_id string, document string")
    rejected = D.rejected_definitions(documents)
    assert sorted((r["survey_id"], r["problem"]) for r in rejected.collect()) == [("b", "malformed"), ("c", "malformed"), ("d", "malformed"), ("e", "missing")]
    assert tuple(R.account_of(documents, rejected).first()) == (6, 2, 4)
    assert {r["survey_id"] for r in D.read_definitions(documents, "PERMISSIVE").collect()} == {"a"}
    pages = spark.createDataFrame([(1, page(None, "x")), (2, page("1", "y")[:-2]), (3, "nothing")], "landed int, page string")
    schema = L.ENTITIES["surveys"]
    assert [r["id"] for r in L.union_pages(pages, schema, mode="PERMISSIVE").collect()] == ["x"]
    assert sorted((r["landed"], r["problem"]) for r in L.rejected_pages(pages, schema).collect()) == [(2, "malformed"), (3, "malformed")]


def test_tables_stored_in_a_block_end_with_it(spark):
    import os

    with session.freeing(spark):
        kept = session.store(spark.range(5), "kept")
        with session.freeing(spark):
            inner = session.store(spark.range(3), "inner")
            files = inner.inputFiles()
            assert inner.count() == 3
        assert not any(os.path.exists(f.removeprefix("file:").removeprefix("//")) for f in files)
        assert kept.count() == 5


@pytest.mark.parametrize("orders", [7, 1 << 18])
def test_landed_documents_hold_a_record_on_each_line(spark, tmp_path, monkeypatch, orders):
    keys = [*range(60), 4, 4, None]
    rows = [(k, 5, "F" if (k or 0) % 5 else None, datetime.datetime(2024, 1, 1), "1-URGENT") for k in keys]
    kind = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(V, "DOCUMENT_ORDERS", orders)
    V.land_documents(spark, str(tmp_path), str(tmp_path / "in"))
    files = [f.read_text() for f in tmp_path.glob("in/**/*.txt")]
    documents = [json.loads(f) for f in files]
    # Each file is one document, and no line of it, which is a row, grows with the survey.
    assert all(f.count("responseId") == len(d["responses"]) == len(f.splitlines()) - 2 for f, d in zip(files, documents))
    found = sorted(r["responseId"] for d in documents for r in d["responses"])
    assert found == sorted(f"R_{k}_{i}" for k in keys if k is not None for i in range(k % 3))
    assert max(len(d["responses"]) for d in documents) < (40 if orders == 7 else 100)
    # Two of each survey, one of those without a key, and more where a survey is larger.
    assert len(documents) == 5 if orders > 60 else len(documents) > 8
