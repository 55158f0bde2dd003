"""Deduplication, exact cascade, fuzzy search against brute force, confirmations."""

import datetime
import random

from pyspark.sql import functions as F

from surveyloom.functions.scores import FIRST_WEIGHT, LAST_WEIGHT
from surveyloom.operators import fuzzy
from surveyloom.operators import matching as M
from surveyloom.operators.numbering import number_rows
from test_functions import ratio

PERSON = "response_id string, first string, last string, cohort string, recorded_at timestamp_ntz, marker boolean"


def people(spark, rows):
    return spark.createDataFrame(
        [(f"p{i:04d}", f, l, c, datetime.datetime(2024, 1, d), m) for i, (f, l, c, d, m) in enumerate(rows)], PERSON)


def test_latest_with_marker_wins(spark):
    rows = [("a", "b", "pre", 3, False), ("a", "b", "pre", 1, True), ("a", "b", "pre", 2, True), ("c", "d", "pre", 1, False), ("c", "d", "pre", 2, False), ("c", "d", "pre", 2, False)]
    kept = M.latest_valid_per_name(people(spark, rows))
    assert {r["response_id"] for r in kept.collect()} == {"p0002", "p0005"}


def test_names_in_other_scripts_stay(spark):
    rows = [("Иван", "Петров", "pre", 1, True), ("李", "明", "pre", 1, True), ("أحمد", "علي", "pre", 1, True), ("X", "-", "pre", 1, True)]
    assert sorted(r["response_id"] for r in M.drop_test_names(people(spark, rows)).collect()) == ["p0000", "p0001", "p0002"]


def test_one_long_name_makes_no_cells(spark):
    left = spark.createDataFrame([("", "anna", f"smith{i % 7}", -1.0, 1, 5) for i in range(40)], "pair string, first string, last string, known double, _v int, _o int").distinct()
    layout = spark.createDataFrame([("", 150, 150, 1), ("", 1, 5, 1)], "pair string, vowels int, others int, n_blocks int")
    met = fuzzy._meetings(left, layout, 5)
    assert sorted((r["vowels"], r["others"], r["n_left_blocks"]) for r in met.collect()) == [(1, 5, 2), (150, 150, 2)]
    assert fuzzy._left_cells(left, met).count() == 14


def test_test_names(spark):
    rows = [("X", "Test", "pre", 1, True), ("x", "lopez", "pre", 1, True), ("A", "", "pre", 1, True), ("jane", "roe", "pre", 1, True)]
    kept = M.drop_test_names(people(spark, rows), [("jane", "roe")])
    assert {(r["first"], r["last"]) for r in kept.collect()} == {("x", "lopez")}
    excluded = spark.createDataFrame([("jane", "roe")], "first string, last string")
    assert M.drop_test_names(people(spark, rows), excluded).count() == 1


def cohorts(spark, seed=1, n=60):
    rng = random.Random(seed)
    names = sorted({("".join(rng.choices("abeo", k=rng.randint(0, 4))), "".join(rng.choices("abcei", k=rng.randint(0, 7)))) for _ in range(n)})
    rows = [(f, l, c, 1, True) for c in M.COHORTS for f, l in names if rng.random() < 0.5]
    return people(spark, rows)


def test_cascade_equals_the_three_steps(spark):
    everyone = cohorts(spark)
    pre, post, unsure = (M.cohort(everyone, c) for c in M.COHORTS)
    m1, pre1, post1 = M.exact_match_pre_post(pre, post)
    m2, pre2, unsure1 = M.exact_match_pre_unsure(pre1, unsure)
    m3, post2, unsure2 = M.exact_match_post_unsure(post1, unsure1)
    matches, leftovers = M.match_cascade(everyone)
    ids = ["pre_id", "post_id", "unsure_id"]
    stepwise = m1.unionByName(m2).unionByName(m3)
    assert sorted(map(str, matches.select(*ids).collect())) == sorted(map(str, stepwise.select(*ids).collect()))
    left = {r["response_id"] for f in (pre2, post2, unsure2) for r in f.collect()}
    assert {r["response_id"] for r in leftovers.collect()} == left
    matched = {v for r in matches.select(*ids).collect() for v in r if v}
    assert matched | left == {r["response_id"] for r in everyone.collect()} and not matched & left


def brute(left, right):
    best = {}
    ordered = sorted(right, key=lambda r: (r[1], r[2], r[0]))
    for i, f, l in left:
        top, who = -1, None
        for r in ordered:
            score = ratio(f, r[1]) * FIRST_WEIGHT + ratio(l, r[2]) * LAST_WEIGHT
            if score > top:
                top, who = score, r
        best[i] = (who[0], round(top, 9)) if who else (None, None)
    return best


def test_fuzzy_search_equals_all_pairs(spark):
    everyone = cohorts(spark, seed=7, n=120)
    sides = [M.cohort(everyone, c) for c in ("pre", "post")]
    rows = [[(r["response_id"], r["first"], r["last"]) for r in s.collect()] for s in sides]
    for sizes in ({}, {"left_rows": 7, "right_rows": 3}):
        found = fuzzy.fuzzy_best_match(*sides, "pre", "post", **sizes).collect()
        assert {r["pre_id"]: (r["post_id"], round(r["match_score"], 9)) for r in found} == brute(*rows)


def test_fuzzy_long_names_and_hot_last_name(spark):
    rng = random.Random(3)
    rows = [("n" + "".join(rng.choices("abc", k=3)), "smith", c, 1, True) for c in ("pre", "post") for _ in range(40)]
    rows += [("long", "ab" * 45 + x, c, 1, True) for c, x in (("pre", "c"), ("post", "d"))]
    everyone = people(spark, rows)
    sides = [M.cohort(everyone, c) for c in ("pre", "post")]
    data = [[(r["response_id"], r["first"], r["last"]) for r in s.collect()] for s in sides]
    found = fuzzy.fuzzy_best_match(*sides, "pre", "post", left_rows=10, right_rows=10).collect()
    assert {r["pre_id"]: (r["post_id"], round(r["match_score"], 9)) for r in found} == brute(*data)


def test_fuzzy_without_right_side(spark):
    everyone = people(spark, [("a", "b", "pre", 1, True)])
    row = fuzzy.fuzzy_best_match(M.cohort(everyone, "pre"), M.cohort(everyone, "post"), "pre", "post").first()
    assert row["pre_first"] == "a" and row["post_id"] is None and row["match_score"] is None


def test_confirming_moves_candidates(spark):
    everyone = people(spark, [("ann", "smith", "pre", 1, True), ("ann", "smyth", "post", 1, True), ("ann", "smithe", "unsure", 1, True), ("bob", "x", "pre", 1, True), ("bob", "x", "post", 1, True)])
    matches, leftovers = M.match_cascade(everyone)
    candidates = fuzzy.fuzzy_candidates(leftovers)
    assert {(r["pre_id"], r["post_id"], r["unsure_id"]) for r in candidates.collect()} == {
        ("p0000", "p0001", None), ("p0000", None, "p0002"), (None, "p0001", "p0002")}
    chosen = spark.createDataFrame([("p0000", "p0001", None), ("nobody", "p0001", None)], "pre_id string, post_id string, unsure_id string")
    matches, remaining, left = M.confirm_matches(matches, candidates, leftovers, chosen)
    assert matches.count() == 2 and remaining.count() == 2
    assert {r["response_id"] for r in left.collect()} == {"p0002"}
    numbered = M.match_ids(matches)
    assert {r["match_id"]: r["pre_id"] for r in numbered.collect()} == {1: "p0003", 2: "p0000"}
    assert M.match_ids(matches, hashed=True).select("match_id").distinct().count() == 2
    for side, expected in (("pre", ["p0003", "p0000"]), ("post", ["p0004", "p0001"])):
        rows = M.side_of_matches(numbered, everyone, side).orderBy("match_id").collect()
        assert [r["response_id"] for r in rows] == expected
    gone = M.pre_side(numbered, everyone.filter("response_id != 'p0000'")).orderBy("match_id").collect()
    assert gone[1]["match_id"] == 2 and gone[1]["response_id"] is None and gone[1]["cohort"] is None


def test_row_numbers_are_consecutive(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(6)
    numbered = number_rows(rows, [F.col("v")], "n")
    assert numbered.filter("n != v + 1").count() == 0 and numbered.count() == 1000
