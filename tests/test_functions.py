"""Hand-computed cases of the column expressions."""

import pytest
from pyspark.sql import functions as F

from surveyloom.functions import columns as C
from surveyloom.functions import scores
from surveyloom.functions import text as X
from surveyloom.functions.answers import has_answer, is_digits, percentage, percentage_text


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, clean", [
    ("Ána  O'Neil-Smith JR", "ana o neil smith"), ("smith,jr", "smith jr"), ("V", ""), (None, ""),
    ("Mary IV", "mary"), ("Groß Łukasz Ægir", "gross lukasz aegir"), ("Иван", "ivan"), ("Ήλιος", "ilios"), ("李", "李"), ("小龙 2", "小龙"), ("ＡＮＮ", "ann"), ("123", ""), ("ivy", "ivy"), ("de Vries III", "de vries"),
])
def test_clean_name(spark, raw, clean):
    assert one(spark, raw, X.clean_name) == clean


@pytest.mark.parametrize("raw, clean, exact", [
    ("banana", None, "banana"), ("Hi,\nThere!", "hi there", "hi there"), ("  ", None, None),
    ("see N/A", None, "see na"), ("N/A", None, None), ("nan", None, None), ("!!!", "", ""),
    ("É_2 ½ x y", "é_2 ½ x y", "é_2 ½ x y"), (None, None, None),
])
def test_clean_text(spark, raw, clean, exact):
    assert one(spark, raw, X.clean_text) == clean
    assert one(spark, raw, lambda v: X.clean_text(v, exact=True)) == exact


def test_strip_html(spark):
    assert one(spark, "<p>a &amp; <b\nx='1'>b</b></p> 1 < 2", X.strip_html) == "a &amp; b 1 < 2"


def test_emoji_characters_are_those_of_unicode():
    import regex

    ours = regex.compile("[" + regex.sub(r"\\x\{([0-9A-F]+)\}", lambda m: regex.escape(chr(int(m[1], 16))), X.EMOJI_CHARACTERS) + "]")
    theirs = regex.compile(r"[\p{Emoji}--[0-9#*\U0001F1E6-\U0001F1FF]]", regex.V1)
    assigned = regex.compile(r"\P{Cn}")
    characters = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000]
    assert [hex(ord(c)) for c in characters if assigned.match(c) and bool(ours.match(c)) != bool(theirs.match(c))] == []


@pytest.mark.parametrize("text, left", [
    ("a → b ■ ✓ ⌂", "a → b ■ ✓ ⌂"), ("1️⃣ 2", " 2"), ("🇩🇪x", "x"), ("❤️ ❤ ✔", "  "), ("👨‍👩‍👧‍👦!", "!"), ("क्‍ष", "क्‍ष"), ("🏴󠁧󠁢󠁳󠁣󠁴󠁿.", "."),
    ("", ""), (None, None),
])
def test_emoji_sequences(spark, text, left):
    assert one(spark, text, X.remove_emojis) == left


def test_remove_emojis(spark):
    assert one(spark, "ok 👍🏽 👩‍👧☀️ é 1#", X.remove_emojis) == "ok   é 1#"


@pytest.mark.parametrize("column, parts", [
    ("QID1", ("QID1", 0, 1, "", 0, "")), ("2_QID1", ("QID1", 2, 1, "", 0, "")), ("QID4_12", ("QID4", 0, 4, "12", 12, "")),
    ("QID3_TEXT", ("QID3", 0, 3, "TEXT", 0, "TEXT")), ("QID9_1_GROUP", ("QID9", 0, 9, "1", 1, "GROUP")),
    ("QID5#1_2", ("QID5", 0, 5, "1", 1, "")), ("3_QID7_2_TEXT", ("QID7", 3, 7, "2", 2, "TEXT")),
    ("recordedDate", (None, 0, 0, "", 0, "")),
])
def test_parse_column_id(spark, column, parts):
    assert tuple(one(spark, column, C.parse_column_id)) == parts


def test_percentages_round_halves_to_even(spark):
    rows = spark.createDataFrame([(1, 16), (3, 16), (4, 4), (0, 4), (1, 3), (0, 0)], "n long, base long")
    pct = percentage(F.col("n"), F.col("base"))
    found = [r[0] for r in rows.select(percentage_text(pct)).collect()]
    assert found == ["6.2%", "18.8%", "100.0%", "0.0%", "33.3%", "0.0%"]


@pytest.mark.parametrize("text, digits", [("12", True), ("1.5", False), ("", False), ("-1", False), ("٣", True), ("²", True), ("a1", False)])
def test_is_digits(spark, text, digits):
    assert one(spark, text, is_digits) is digits


def test_has_answer(spark):
    rows = spark.createDataFrame(
        [(None,), (("c", "text", None, None, ""),), (("c", "text", None, None, "x"),), (("c", "list", [], None, None),),
         (("c", "list", ["1"], None, None),), (("c", "number", None, 0.0, None),)],
        "a struct<column_id:string,kind:string,items:array<string>,num:double,txt:string>",
    )
    assert [r[0] for r in rows.select(has_answer(F.col("a"))).collect()] == [False, False, True, False, True, True]


def lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = rows[i - 1][j - 1] + 1 if x == y else max(rows[i - 1][j], rows[i][j - 1])
    return rows[-1][-1]


def ratio(a, b):
    if a == b:
        return 100
    return round(200 * lcs(a, b) / (len(a) + len(b))) if a and b else 0


PAIRS = [("marlow", "malrow"), ("smith", "smyth"), ("", ""), ("", "a"), ("anna", "nana"), ("abc" * 30, "bca" * 29), ("x", "y"),
         ("a" * 60, "a" * 30 + "b" * 30), ("a" * 61, "ba" * 20), ("o neil", "oneil"), ("ab" * 40, "b")]


def test_name_scores(spark):
    rows = spark.createDataFrame(PAIRS, "a string, b string")
    found = [r[0] for r in rows.select(scores.ratio(F.col("a"), F.col("b"))).collect()]
    assert found == [ratio(a, b) for a, b in PAIRS]
    assert found[:2] == [83, 80]
    names = spark.createDataFrame([("marlow", "smith", "malrow", "smyth")], "a string, b string, c string, d string")
    assert names.select(scores.name_match_score(*map(F.col, "abcd"))).first()[0] == pytest.approx(80.6)
