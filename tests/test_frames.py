"""Frames of different columns, and keys as text."""

from decimal import Decimal

from pyspark.sql import functions as F

from surveyloom.operators import frames


def test_union_fills_what_a_frame_lacks_and_widens_types(spark):
    one = spark.createDataFrame([(1, "a", 2)], "id int, x string, n int")
    two = spark.createDataFrame([(2**40, 1.5, [1, 2])], "id long, n double, items array<int>")
    three = spark.createDataFrame([("k", [3])], "id string, x array<int>")
    both = frames.union_by_name([one, two])
    assert both.dtypes == [("id", "bigint"), ("x", "string"), ("n", "double"), ("items", "array<int>")]
    assert {tuple(r) for r in both.select("id", "x", "n").collect()} == {(1, "a", 2.0), (2**40, None, 1.5)}
    named = frames.union_by_name({"one": one, "three": three}, source="of")
    assert {tuple(r) for r in named.collect()} == {("one", "1", "a", 2), ("three", "k", "[3]", None)}
    assert frames.union_by_name([one.limit(0), one.limit(0)]).count() == 0
    assert frames.union_by_name([one, one.withColumn("x", F.lit(None))]).dtypes[1] == ("x", "string")


def test_keys_of_any_type_compare_as_text(spark):
    row = spark.createDataFrame([(3, 3.0, 2.5, Decimal("4.00"), "5", None, True)], "a int, b double, c float, d decimal(5,2), e string, f double, g boolean")
    assert tuple(frames.to_text(row, row.columns).first()) == ("3", "3", "2.5", "4", "5", None, "true")
