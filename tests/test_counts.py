"""Frequency, nonresponse and pre/post tables: golden cases and properties."""

import datetime

import pytest
from pyspark.sql import functions as F

from surveyloom.functions.answers import ANSWER_TYPE
from surveyloom.operators import filters as flt
from surveyloom.operators import frequency as freq
from surveyloom.operators import prepost
from surveyloom.operators import summary
from surveyloom.plans import reports
from surveyloom.plans.dimensions import Dimensions

RESPONSE = (f"survey_id string, response_id string, recorded_at timestamp_ntz, end_at timestamp_ntz, channel string, "
            f"progress double, answers array<{ANSWER_TYPE}>")


def answer(column, value):
    if isinstance(value, bool):
        return (column, "bool", None, None, str(value).lower())
    if isinstance(value, list):
        return (column, "list", value, None, None)
    if isinstance(value, str):
        return (column, "text", None, None, value)
    return (column, "number", None, float(value), None)


def responses(spark, rows, times=None, survey="S"):
    """Rows are dicts of column -> value; None is left out."""
    data = []
    for i, row in enumerate(rows):
        at = times[i] if times else datetime.datetime(2024, 1, 1)
        data.append((survey, f"{survey}{i}", at, at, None, 100.0, [answer(c, v) for c, v in row.items() if v is not None]))
    return spark.createDataFrame(data, RESPONSE)


def dims(spark, columns, choices=(), survey="S"):
    questions = spark.createDataFrame(
        [(survey, c, "N", "Text of " + c, t, "B", f"{i:03d}") for i, (c, t) in enumerate(columns)],
        "survey_id string, column_id string, question_name string, question_text string, data_type string, block_name string, flow_pos string")
    options = spark.createDataFrame([(survey, *c) for c in choices], "survey_id string, column_id string, answer_id string, question_value string")
    return questions, options


def table(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())


def codes(spark, values, choices=()):
    questions, options = dims(spark, [("Q", "MultipleChoice")], [("Q", a, b) for a, b in choices])
    return table(freq.survey_frequency(responses(spark, [{"Q": v} for v in values]), questions, options), "code", "value", "n", "frequency")


@pytest.mark.parametrize("values, choices, expected", [
    (["1", "1", "2", None], [("1", "Yes"), ("2", "No"), ("3", "Maybe")],
     [("1", "Yes", 2, "50.0%"), ("2", "No", 1, "25.0%"), ("3", "Maybe", 0, "0.0%"), ("NULL", "", 1, "25.0%")]),
    ([["1", "2"], ["1"], None, []], [], [("1", "", 2, "50.0%"), ("2", "", 1, "25.0%"), ("NULL", "", 1, "25.0%")]),
    (["1"] + ["2"] * 15, [], [("1", "", 1, "6.2%"), ("2", "", 15, "93.8%")]),
    (["1", "abc", 2], [], [("1", "", 1, "33.3%"), ("NULL", "", 2, "66.7%")]),
    ([3.7, 3, None], [], [("3", "", 2, "66.7%"), ("NULL", "", 1, "33.3%")]),
    ([-1.5, 0.4], [], [("-1", "", 1, "50.0%"), ("0", "", 1, "50.0%")]),
    ([["x", "1"], 5], [], [("1", "", 1, "50.0%"), ("NULL", "", 1, "50.0%"), ("x", "", 1, "50.0%")]),
    ([True, False], [], []),
    ([True, None], [], [("NULL", "", 2, "100.0%")]),
    ([None, None], [("1", "Yes")], [("1", "Yes", 0, "0.0%"), ("NULL", "", 2, "100.0%")]),
])
def test_golden_frequencies(spark, values, choices, expected):
    assert codes(spark, values, choices) == expected


def test_single_choice_counts_add_up_and_order_does_not_matter(spark):
    rows = [{"Q": str(i % 4) if i % 5 else None, "P": i / 3} for i in range(60)]
    questions, options = dims(spark, [("Q", "MultipleChoice"), ("P", "Numeric"), ("F", "FreeText")], [("Q", "9", "never")])
    found = freq.survey_frequency(responses(spark, rows), questions, options)
    again = freq.survey_frequency(responses(spark, rows).repartition(5, "response_id"), questions, options)
    columns = ("column_id", "code", "value", "n", "frequency")
    assert table(found, *columns) == table(again, *columns)
    sums = {r["column_id"]: r["s"] for r in found.groupBy("column_id").agg(F.sum("n").alias("s")).collect()}
    assert sums == {"Q": 60, "P": 60}
    numeric = [r["code"] for r in freq.report_order(found).filter("column_id = 'P'").collect()]
    assert numeric == [str(i) for i in range(20)]


def test_missing_stats(spark):
    questions, _ = dims(spark, [("Q", "MultipleChoice"), ("T", "FreeText"), ("U", "FreeText")])
    data = responses(spark, [{"Q": "1", "T": "x"}, {"Q": []}, {"T": "y"}, {"Q": "2"}])
    found = table(summary.missing_stats(data, questions), "column_id", "missing_n", "present_n", "missing_frc", "present_frc")
    assert found == [("Q", 1, 3, 0.25, 0.75), ("T", 2, 2, 0.5, 0.5), ("U", 4, 0, 1.0, 0.0)]
    assert table(summary.free_text_compliance(data, questions), "column_id") == [("T",), ("U",)]


def test_header_counts_whole_days(spark):
    questions, _ = dims(spark, [("Q", "MultipleChoice"), ("T", "FreeText")])
    questions = questions.withColumn("question_type", F.when(F.col("column_id") == "Q", "MC").otherwise("TE"))
    data = responses(spark, [{"Q": "1"}, {"Q": "1"}], [datetime.datetime(2024, 1, 1, 23), datetime.datetime(2024, 1, 3, 1)])
    row = summary.survey_header(data, questions).first()
    assert (row["n_responses"], row["first_response"], row["last_response"], row["duration_days"], row["n_questions"], row["question_types"]) == (
        2, "2024-01-01", "2024-01-03", 1, 2, "MC, TE")


def test_cutoff_includes_its_midnight(spark):
    times = [datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 1, 5), None]
    data = flt.cutoff_split(responses(spark, [{"Q": "1"}] * 3, times), "2024-01-01")
    assert [r["phase"] for r in data.orderBy("response_id").collect()] == ["pre", "post"]
    with pytest.raises(ValueError):
        flt.cutoff_split(data.drop("recorded_at"), "2024-01-01")


def phased(spark, pre, post):
    one, two = (responses(spark, [{"Q": v} for v in values]) for values in (pre, post))
    return prepost.as_phase(one, "S", "pre").unionByName(prepost.as_phase(two, "S", "post"))


def test_pre_post(spark):
    questions, options = dims(spark, [("Q", "MultipleChoice")])
    found = prepost.pre_post_mc(phased(spark, ["1", "1"], ["2"]), questions, options)
    columns = ("code", "value", "pre_n", "pre_frequency", "post_n", "post_frequency")
    assert table(found, *columns) == [("1", "", 2, "100.0%", 0, "0.0%"), ("2", "", 0, "0.0%", 1, "100.0%")]


def test_phases_of_different_surveys_decide_apart_what_is_numeric(spark):
    questions, options = dims(spark, [("Q", "MultipleChoice")])
    data = phased(spark, [1, 2], ["1", 2])
    columns = ("code", "pre_n", "post_n")
    assert table(prepost.pre_post_mc(data, questions, options, apart=True), *columns) == [("1", 1, 1), ("2", 1, 0), ("NULL", 0, 1)]
    assert table(prepost.pre_post_mc(data, questions, options), *columns) == [("1", 0, 1), ("NULL", 2, 1)]


def test_pre_post_equals_joining_two_tables(spark):
    questions, options = dims(spark, [("Q", "MultipleChoice")], [("Q", "0", "zero"), ("Q", "7", "seven")])
    pre = [str(i % 3) if i % 4 else None for i in range(17)]
    post = [str(i % 5) for i in range(11)]
    found = prepost.pre_post_report(phased(spark, pre, post), questions, options)
    sides = [freq.frequency_mc(responses(spark, [{"Q": v} for v in values]), questions, options).select(
        "code", "value", F.col("n").alias(f"n{i}"), F.col("frequency").alias(f"f{i}")) for i, values in enumerate((pre, post))]
    joined = sides[0].join(sides[1], ["code", "value"], "full").fillna(0).fillna("0.0%")
    assert table(found, "code", "value", "pre_n", "pre_frequency", "post_n", "post_frequency") == table(joined, "code", "value", "n0", "f0", "n1", "f1")


def test_regional_questions_drop_zero_rows(spark):
    questions, options = dims(spark, [("Q", "MultipleChoice")], [("Q", "1", "a"), ("Q", "2", "b")])
    data = responses(spark, [{"Q": "1"}])
    assert table(freq.survey_frequency(data, questions, options, ["Text of Q"]), "code") == [("1",)]
    assert table(freq.survey_frequency(data, questions, options, ["other"]), "code") == [("1",), ("2",)]


def test_counting_reads_the_responses_once(spark):
    """One shuffle before the counts are stored, no Python anywhere."""
    counted = freq.counted_rows(responses(spark, [{"Q": "1"}])).groupBy("survey_id", "column_id", "kind", "code").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Python" not in plan and "SortMergeJoin" not in plan


def two_surveys(spark, pre, post, pre_columns, post_columns):
    sides = []
    for rows, columns, survey in ((pre, pre_columns, "A"), (post, post_columns, "B")):
        asked, offered = dims(spark, [(c, "MultipleChoice") for c in columns], [(c, "1", f"{c} of {survey}") for c in columns], survey)
        sides.append((responses(spark, rows, survey=survey), Dimensions(asked, offered)))
    (pre, pre_dims), (post, post_dims) = sides
    return reports.pre_post_of_two_surveys(pre, post, pre_dims, post_dims, "AB")


def test_each_of_two_surveys_has_its_own_questions(spark):
    pre = [{"Q": "1", "P": "1"}, {"Q": "1"}, {"R": "1"}]
    post = [{"R": "1"}, {"Q": "1", "R": "2"}, {"P": "9"}]
    header, found = two_surveys(spark, pre, post, ["Q", "P"], ["Q", "R"])
    # Answers to what a survey does not ask make no respondent.
    assert table(header, "phase", "n_responses") == [("post", 2), ("pre", 2)]
    assert table(found, "column_id", "code", "value", "pre_n", "pre_frequency", "post_n", "post_frequency") == [
        ("P", "1", "P of A", 1, "50.0%", 0, "0.0%"), ("P", "NULL", "", 1, "50.0%", 0, "0.0%"),
        ("Q", "1", "Q of A", 2, "100.0%", 1, "50.0%"), ("Q", "NULL", "", 0, "0.0%", 1, "50.0%"),
        ("R", "1", "R of B", 0, "0.0%", 1, "50.0%"), ("R", "2", "", 0, "0.0%", 1, "50.0%"),
    ]


def test_large_surveys_are_split_by_their_size(spark, monkeypatch):
    questions, options = dims(spark, [("Q", "MultipleChoice"), ("T", "FreeText"), ("X", "Draw")])
    small, large = dims(spark, [("Q", "MultipleChoice"), ("T", "FreeText")], survey="B")[0], questions
    both = large.unionByName(small)
    data = responses(spark, [{"Q": "1", "T": "a", "X": "b", "Z": "c"}] * 300 + [{"Z": "1"}] * 5).unionByName(
        responses(spark, [{"Q": "2", "T": "d"}] * 20, survey="B")).cache()
    assert flt.splits_of(data) == {}
    before = [sorted(map(str, f(data).collect())) for f in (
        lambda r: flt.drop_all_null(r, both, flt.REPORTABLE), lambda r: flt.free_text_view(r, both))]
    assert len(before[0]) == len(before[1]) == 320
    monkeypatch.setattr(flt, "ROWS_PER_SPLIT", 50)
    monkeypatch.setattr(flt, "BROADCAST_BYTES", 0)
    assert flt.splits_of(data) == {"S": 7}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        after = [sorted(map(str, f(data).collect())) for f in (
            lambda r: flt.drop_all_null(r, both, flt.REPORTABLE), lambda r: flt.free_text_view(r, both))]
        assert after == before
        joined = flt.with_survey_dimension(data, large.select("survey_id").distinct()).withColumn("part", F.spark_partition_id())
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert joined.select("part").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_answers_that_are_not_reported_are_left_before_they_are_rows(spark):
    questions, options = dims(spark, [("Q", "MultipleChoice"), ("T", "FreeText")])
    data = responses(spark, [{"Q": "1", "T": "a", "Z": "c"}])
    kept = reports.usable_responses(data, questions, flt.REPORTABLE)
    assert [a["column_id"] for r in kept.collect() for a in r["answers"]] == ["Q"]
    plan = freq.counted_rows(kept)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("array_contains")
    view = flt.free_text_view(data, questions)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_contains_key" in view or "array_contains(map_keys" in view
    assert [tuple(r) for r in flt.free_text_view(data, questions).select("column_id", "text", "question_text").collect()] == [("T", "a", "Text of T")]
