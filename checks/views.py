"""Survey-shaped views of the driver's tables.

Everything is derived by Spark from the given tables, row by row where it can
be, so the work of every query grows with them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.functions.answers import ANSWER_TYPE

QUESTION_COLUMNS = (
    "column_id string, question_name string, question_text string, question_type string, "
    "question_selector string, is_numeric boolean, data_type string, block_name string, flow_pos string"
)

PROGRAM = "Which program?"

# column, name, text, type, selector, numeric, data type, block, position
ORDER_QUESTIONS = [
    ("QID1", "Q1", PROGRAM, "MC", "SAVR", False, "MultipleChoice", "Start", "000001"),
    ("QID4", "Q4", "Which size?", "MC", "SAVR", False, "MultipleChoice", "Start", "000002"),
    ("QID2", "Q2", "Which of these?", "MC", "MAVR", False, "MultipleChoice", "Middle", "000003"),
    ("QID3", "Q3", "How many?", "TE", "SL", True, "Numeric", "Middle", "000004"),
    ("QID5_TEXT", "Q5", "Anything else?", "TE", "ML", False, "FreeText", "End", "000005"),
    ("QID7", "Q7", "Never asked", "MC", "SAVR", False, "MultipleChoice", "End", "000006"),
]

EVENT_QUESTIONS = [
    ("QID1", "Q1", "What happened?", "MC", "SAVR", False, "MultipleChoice", "Events", "000001"),
    ("QID2", "Q2", "How much?", "TE", "SL", True, "Numeric", "Events", "000002"),
]

# What only the first, or only the second of two surveys asks.
ONLY_PRE = ("QID8", "Q8", "Would you come?", "MC", "SAVR", False, "MultipleChoice", "Events", "000008")
ONLY_POST = ("QID7", "Q7", "Where from?", "MC", "SAVR", False, "MultipleChoice", "Events", "000007")
ONLY_CHOICES = [("QID7", "1", "North"), ("QID7", "2", "South"), ("QID7", "3", "None of these"), ("QID8", "1", "Yes"), ("QID8", "2", "No")]

DOCUMENT_QUESTIONS = [
    ("QID1_TEXT", "Q1", "Tell us more", "TE", "ML", False, "FreeText", "Text", "000001"),
    ("QID2", "Q2", "Quality", "MC", "SAVR", False, "MultipleChoice", "Text", "000002"),
    ("QID3", "Q3", "Toxic", "MC", "SAVR", False, "MultipleChoice", "Text", "000003"),
    ("QID4_TEXT_x", "Q4", "Left empty", "TE", "ML", False, "FreeText", "Text", "000004"),
    ("QID5_6_TEXT", "Q5", "Other source", "TE", "ML", False, "FreeText", "Text", "000005"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def later(at: Column, unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), at)


def questions_of(surveys: DataFrame, rows: list[tuple]) -> DataFrame:
    """The same questions for every survey there is."""
    fields = QUESTION_COLUMNS.replace(" ", ":").replace(",:", ",")
    listed = json.dumps([dict(zip([f.split(":")[0] for f in fields.split(",")], row)) for row in rows])
    return surveys.select("survey_id").distinct().select(
        "survey_id", F.inline(F.from_json(F.lit(listed), f"array<struct<{fields}>>"))
    )


# One answer per kind, for use in SQL expressions.
def text(column_id: str, value: str) -> str:
    return _answer(column_id, "text", value, txt=f"cast({value} as string)")


def number(column_id: str, value: str) -> str:
    return _answer(column_id, "number", value, num=f"cast({value} as double)")


def items(column_id: str, value: str) -> str:
    return _answer(column_id, "list", value, items=f"cast({value} as array<string>)")


def _answer(column_id: str, kind: str, value: str, items="null", num="null", txt="null") -> str:
    """An array of one answer, or of none when there is no value."""
    built = (
        f"named_struct('column_id','{column_id}','kind','{kind}','items',cast({items} as array<string>),"
        f"'num',cast({num} as double),'txt',cast({txt} as string))"
    )
    return f"if({value} is null, cast(array() as array<{ANSWER_TYPE}>), array({built}))"


def answers(*parts: str) -> str:
    """The answers of a response.

    ``explode`` makes them a column like one that was read, so that conditions
    on answers are not rewritten in terms of how they are made up here.
    """
    return f"explode(array(concat({','.join(parts)}))) as answers"


def bits(column: str, count: int) -> str:
    """'1'..'count' for the bits that are set."""
    marks = ",".join(f"if(({column} & {1 << i}) != 0, '{i + 1}', '')" for i in range(count))
    return f"array_remove(array({marks}), '')"


# -- orders as responses --------------------------------------------------------

def order_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "k % 13 != 5"
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("*", "o_orderkey as k", "timestampadd(HOUR, cast(o_orderkey % 24 as int), o_orderdate) as recorded_at")
        .selectExpr(
            "concat('SV_', o_orderstatus) as survey_id",
            "concat('R_', k) as response_id",
            "recorded_at",
            "timestampadd(MINUTE, cast(k % 90 as int), recorded_at) as end_at",
            "case when k % 20 = 0 then 'preview' when k % 20 != 1 then 'anonymous' end as channel",
            "case when k % 50 != 7 then cast(k % 101 as double) end as progress",
            answers(
                text("QID1", f"case when {said} and k % 10 != 3 then substring(o_orderpriority, 1, 1) end"),
                items("QID2", f"case when {said} and k % 11 != 0 then {bits('o_custkey', 7)} end"),
                number("QID3", f"case when {said} and k % 7 != 0 then o_totalprice / 100000 end"),
                number("QID4", f"case when {said} and k % 17 != 0 and k % 3 = 0 then k % 5 end"),
                text(
                    "QID4",
                    f"case when {said} and k % 17 != 0 and k % 3 = 1 then cast(k % 5 as string) "
                    f"when {said} and k % 17 != 0 and k % 3 = 2 then 'other' end",
                ),
                text("QID5_TEXT", f"case when {said} and k % 4 = 0 then concat('comment ', o_orderpriority) end"),
            ),
        )
    )


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses of two exports that overlap: every third response is in both, some of the first without answers."""
    second = order_responses(spark, sf_dir)
    overlap = F.pmod(F.xxhash64("response_id"), F.lit(3)) == 0
    first = second.where(overlap).withColumn("channel", F.lit("older")).withColumn("answers", F.slice("answers", 1, 0))
    return first.withColumn("version", F.lit(1)).unionByName(second.withColumn("version", F.lit(2)))


def order_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("SV_"), "o_orderstatus").alias("survey_id"))


def order_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions_of(order_surveys(spark, sf_dir), ORDER_QUESTIONS)


def order_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels from the data for QID1, plus options that nobody can choose."""
    fixed = (
        [("QID1", "6", "Never chosen"), ("QID7", "1", "Yes")]
        + [("QID2", str(i), f"Option {i}") for i in range(1, 8)]
        + [("QID4", str(i), f"Size {i}") for i in range(4)]
    )
    listed = json.dumps([dict(zip(("column_id", "answer_id", "question_value"), row)) for row in fixed])
    orders = table(spark, sf_dir, "orders").selectExpr("concat('SV_', o_orderstatus) as survey_id", "o_orderpriority")
    seen = orders.distinct().selectExpr(
        "survey_id", "'QID1' as column_id", "substring(o_orderpriority, 1, 1) as answer_id", "o_orderpriority as question_value"
    )
    offered = orders.select("survey_id").distinct().select(
        "survey_id",
        F.inline(F.from_json(F.lit(listed), "array<struct<column_id:string,answer_id:string,question_value:string>>")),
    )
    return seen.unionByName(offered)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(survey_id, key, responses): none, one or two responses of each order, as an export has them."""
    # Exports come in many files, the orders in one.
    o = table(spark, sf_dir, "orders").repartition(spark.sparkContext.defaultParallelism)
    key = F.col("o_orderkey")
    stamp = F.date_format(later(F.col("o_orderdate"), "HOUR", key % 24), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    picked = F.filter(
        F.array(*[F.when(F.col("o_custkey").bitwiseAND(1 << i) != 0, F.lit(str(i + 1))) for i in range(3)]),
        lambda c: c.isNotNull(),
    )

    def values(i: Column) -> Column:
        return F.struct(
            F.when(key % 97 == 0, "not a date").otherwise(stamp).alias("recordedDate"),
            F.when(key % 20 == 0, "preview").when(key % 20 != 1, "anonymous").alias("distributionChannel"),
            (key % 101).alias("progress"),
            F.struct(
                F.col("o_custkey").alias("customer"),
                F.struct(F.col("o_orderstatus").alias("status")).alias("state"),
            ).alias("location"),
            F.substring("o_orderpriority", 1, 1).alias("QID1"),
            picked.alias("QID2"),
            F.when(key % 7 != 0, F.col("o_custkey") + i).alias("QID3"),
        )

    responses = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(2)), lambda i: i < key % 3),
        lambda i: F.struct(
            F.concat(F.lit("R_"), key, F.lit("_"), i).alias("responseId"), values(i).alias("values")
        ),
    )
    return o.select(F.concat(F.lit("SV_"), "o_orderstatus").alias("survey_id"), key.alias("key"), responses.alias("responses"))


def order_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export documents of none, one or two responses each."""
    return order_records(spark, sf_dir).select("survey_id", F.to_json(F.struct("responses")).alias("document"))


# Orders an export document holds, more or less; a survey with more has more documents.
DOCUMENT_ORDERS = 1 << 18


def land_documents(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Export documents of each survey, two or a multiple of it, each a file that is written record by record."""
    half = F.col("key") % 2
    records = order_records(spark, sf_dir).withColumn("half", half)
    largest = records.groupBy("survey_id", "half").count().agg(F.max("count")).first()[0] or 0
    share = F.pmod(F.xxhash64("key"), F.lit(-(-largest // DOCUMENT_ORDERS) or 1))
    document = ["survey_id", "half", "share"]
    records = records.withColumn("share", share)
    # A record for each line; no row ever holds a document.
    inner = records.select(*document, F.lit(1).alias("place"), F.explode(F.transform("responses", lambda r: F.to_json(r))).alias("value"))
    ends = F.array(
        F.struct(F.lit(0).alias("place"), F.lit('{"about":"x","responses":[').alias("value")),
        F.struct(F.lit(2).alias("place"), F.concat(F.lit('],"parts":'), F.to_json(F.array("half")), F.lit("}")).alias("value")),
    )
    outer = records.select(*document).distinct().select(*document, F.inline(ends))
    follows = F.lag("place").over(Window.partitionBy(*document).orderBy("place")) == F.col("place")
    lines = inner.unionByName(outer).select(*document, F.concat(F.when(follows, ",").otherwise(""), "value").alias("value"))
    lines.write.partitionBy("half", "share", "survey_id").text(path)
    return path


def land_lines(spark: SparkSession, sf_dir: str, path: str, broken: bool = False) -> str:
    """Line-delimited exports of each survey; with ``broken`` among blank lines and others that are no responses."""
    records = order_records(spark, sf_dir)
    lines = records.select("survey_id", F.explode(F.transform("responses", lambda r: F.to_json(r))).alias("value"))
    if broken:
        key = F.col("key")
        bad = F.array(
            F.when(key % 10 == 0, ""), F.when(key % 10 == 1, " \t"), F.when(key % 10 == 2, F.concat(F.lit('{"responseId":"'), key)),
            F.when(key % 20 == 3, "[1]"), F.when(key % 20 == 13, "nothing"),
        )
        lines = lines.unionByName(records.select("survey_id", F.explode(F.array_compact(bad)).alias("value")))
    lines.write.partitionBy("survey_id").text(path)
    return path


# -- events as responses around a cutoff ------------------------------------------

EVENT_CODES = ("click", "error", "purchase", "signup", "view")
CUTOFF = "2024-01-15"


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = f"array_position(array{EVENT_CODES}, event_type)"
    return table(spark, sf_dir, "events").selectExpr(
        "concat('SE_', user_id % 2) as survey_id",
        "concat('E_', event_id) as response_id",
        "case when event_id % 31 != 0 then ts end as recorded_at",
        "ts as end_at",
        answers(
            text("QID1", f"case when event_id % 6 != 0 then cast({code} as string) end"),
            number("QID2", "case when event_id % 9 != 0 then value / 10 end"),
        ),
    )


def survey_of_two(spark: SparkSession, sf_dir: str, survey_id: str) -> DataFrame:
    """Events of one survey, which asks a question the other does not."""
    only = {
        "SE_0": text("QID8", "case when split(response_id, '_')[1] % 4 != 0 then cast(split(response_id, '_')[1] % 2 + 1 as string) end"),
        "SE_1": text("QID7", "case when split(response_id, '_')[1] % 3 != 0 then cast(split(response_id, '_')[1] % 3 as string) end"),
    }[survey_id]
    events = event_responses(spark, sf_dir).filter(F.col("survey_id") == survey_id)
    return events.withColumn("answers", F.concat("answers", F.expr(only))).withColumn("channel", F.lit(None).cast("string"))


def dimensions_of_two(spark: SparkSession, sf_dir: str, survey_id: str) -> tuple[DataFrame, DataFrame]:
    """Questions and choices of one of the two surveys."""
    only = {"SE_0": ONLY_PRE, "SE_1": ONLY_POST}[survey_id]
    survey = event_surveys(spark, sf_dir).filter(F.col("survey_id") == survey_id)
    listed = json.dumps([dict(zip(("column_id", "answer_id", "question_value"), c)) for c in ONLY_CHOICES if c[0] == only[0]])
    more = survey.select(
        "survey_id", F.inline(F.from_json(F.lit(listed), "array<struct<column_id:string,answer_id:string,question_value:string>>"))
    )
    choices = event_choices(spark, sf_dir).filter(F.col("survey_id") == survey_id)
    return questions_of(survey, [*EVENT_QUESTIONS, only]), choices.unionByName(more)


def event_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("concat('SE_', user_id % 2) as survey_id").distinct()


def event_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions_of(event_surveys(spark, sf_dir), EVENT_QUESTIONS)


def event_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label per event type, and one never chosen."""
    labels = f"array{(*EVENT_CODES, 'none')}"
    return event_surveys(spark, sf_dir).selectExpr("survey_id", "'QID1' as column_id", f"posexplode({labels}) as (p, question_value)").selectExpr(
        "survey_id", "column_id", "cast(p + 1 as string) as answer_id", "question_value"
    )


# -- parts as questions of many surveys ---------------------------------------------

# type, selector; part p has the type at place p % 16.
PART_TYPES = [
    ("MC", "SAVR"), ("MC", "MAVR"), ("TE", "ML"), ("TE", "SL"), ("Matrix", "Likert"), ("CS", "HR"),
    ("RO", "DND"), ("Slider", "STAR"), ("Timing", "PageTimer"), ("SS", "TA"), ("PGR", "DragAndDrop"),
    ("FileUpload", "FileUpload"), ("Meta", "Browser"), ("Draw", "Signature"), ("SBS", "SBSMatrix"),
    ("Matrix", "Bipolar"),
]
FLOW = (
    '[{"type":"Block","id":"B2"},{"type":"Branch","flow":[{"type":"Block","id":"B1"},'
    '{"type":"Branch","flow":[{"type":"Block","id":"B3"}]}]},'
    '{"type":"Group","flow":[{"type":"Block","id":"B4"}]},{"type":"EmbeddedData"}%s]'
)


def part_questions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    kind = F.element_at(F.array(*[F.lit(t) for t, _ in PART_TYPES]), (key % 16 + 1).cast("int"))
    selector = F.element_at(F.array(*[F.lit(s) for _, s in PART_TYPES]), (key % 16 + 1).cast("int"))
    return p.select(
        "*",
        F.concat(F.lit("SP_"), F.floor(key / 20)).alias("survey_id"),
        F.concat(F.lit("QID"), key % 20 + 1).alias("base_qid"),
        kind.alias("kind"),
        selector.alias("selector"),
        (F.col("p_size") % 4 + 2).alias("n_choices"),
    )


def part_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer columns the questions have."""
    q, n, key = F.col("base_qid"), F.col("n_choices"), F.col("p_partkey")
    kind = F.col("kind")

    def named(*parts: str) -> Column:
        return F.array(*[F.concat(q, F.lit(part)) for part in parts])

    columns = (
        F.when(
            kind == "MC",
            F.array_compact(
                F.array(
                    q,
                    F.when(key % 3 == 1, F.concat(q, F.lit("_TEXT"))),
                    F.when(key % 8 == 0, F.concat(F.lit("2_"), q)),
                )
            ),
        )
        .when(kind == "TE", named("_TEXT"))
        .when(kind.isin("Matrix", "CS"), named("_1", "_2"))
        .when(kind == "RO", F.concat(
            F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(q, F.lit("_"), i)), named("_TEXT")
        ))
        .when(kind == "Slider", named("_1", "_2", "_9"))
        .when(kind == "Timing", named("_FIRST_CLICK", "_PAGE_SUBMIT"))
        .when(kind == "PGR", named("_1_GROUP", "_2_GROUP"))
        .when(kind == "SBS", named("#1_1"))
        .otherwise(F.array(q))
    )
    return part_questions_raw(spark, sf_dir).select("survey_id", F.explode(columns).alias("column_id"))


def part_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition documents, twenty questions each."""
    key, kind = F.col("p_partkey"), F.col("kind")
    name, n = F.col("p_name"), F.col("n_choices")
    choices = F.map_from_entries(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.struct(
                i.cast("string"),
                F.struct(
                    F.when((key % 5 == 0) & (i == 3), 2).otherwise(i + key % 2 * 10).cast("string").alias("recode"),
                    F.concat(F.lit("<b>Choice "), i, F.lit(" of "), F.col("p_type"), F.lit("</b>")).alias("choiceText"),
                    F.when(i == 2, F.when(key % 3 == 0, F.concat(F.lit("Image of "), name)).otherwise("")).alias("imageDescription"),
                ),
            ),
        )
    )

    def described(field: str, prefix: str, last: int) -> Column:
        return F.map_from_entries(
            F.array(
                *[
                    F.struct(F.lit(str(i)), F.struct(F.concat(F.lit(f"{prefix} {i} "), name).alias(field)))
                    for i in range(1, last + 1)
                ]
            )
        )

    question = F.struct(
        F.concat(F.lit("Q"), key).alias("questionName"),
        F.concat(F.lit("<p> How about <i>"), name, F.lit("</i>? </p>")).alias("questionText"),
        F.struct(kind.alias("type"), F.col("selector").alias("selector")).alias("questionType"),
        F.when(F.col("selector") == "SL", F.struct(F.lit("ValidNumber").alias("type"))).alias("validation"),
        F.when(kind.isin("MC", "Matrix", "CS", "RO", "Slider"), choices).alias("choices"),
        F.when(kind == "Matrix", described("choiceText", "Row", 2)).alias("subQuestions"),
        F.when(kind == "PGR", described("description", "Group", 2)).alias("groups"),
        F.when(kind == "PGR", described("description", "Item", 3)).alias("items"),
    )

    def block(number: int) -> Column:
        mine = F.filter("numbers", lambda x: (x % 4 == number - 1) & (x != 19))
        elements = F.concat(
            F.transform(
                F.array_sort(mine),
                lambda x: F.struct(F.lit("Question").alias("type"), F.concat(F.lit("QID"), x + 1).alias("questionId")),
            ),
            F.array(F.struct(F.lit("Page Break").alias("type"), F.lit(None).cast("string").alias("questionId"))),
        )
        title = F.lit(None).cast("string") if number == 3 else F.lit(f"Block {number}")
        return F.struct(title.alias("description"), elements.alias("elements"))

    grouped = (
        part_questions_raw(spark, sf_dir)
        .select("survey_id", (key % 20).alias("number"), "base_qid", question.alias("q"), F.floor(key / 20).alias("survey_no"))
        .groupBy("survey_id", "survey_no")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("base_qid", "q"))).alias("questions"),
            F.collect_list("number").alias("numbers"),
        )
    )
    flow = F.when(F.col("survey_no") % 2 == 0, FLOW % ',{"type":"Block","id":"B4"}').otherwise(FLOW % "")
    blocks = F.struct(*[block(i).alias(f"B{i}") for i in range(1, 5)])
    return grouped.select(
        "survey_id",
        F.concat(
            F.lit('{"result":{"questions":'), F.to_json("questions"),
            F.lit(',"blocks":'), F.to_json(blocks), F.lit(',"flow":'), flow, F.lit("}}"),
        ).alias("document"),
    )


def part_full_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full definition documents, of which only the choice order is used."""
    order = F.when(F.col("kind") == "RO", F.reverse(F.sequence(F.lit(1), F.col("n_choices"))))
    return (
        part_questions_raw(spark, sf_dir)
        .groupBy("survey_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("base_qid", F.struct(order.alias("ChoiceOrder"))))
            ).alias("Questions")
        )
        .select("survey_id", F.to_json(F.struct(F.struct("Questions").alias("result"))).alias("document"))
    )


# -- parts as people -----------------------------------------------------------------

MARKER_COLUMN, PHASE_COLUMN, FIRST_COLUMN, LAST_COLUMN = "QID9", "QID8", "QID7_1", "QID7_2"


def people_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with names that are accented, suffixed, misspelt or made up for a test."""
    names = table(spark, sf_dir, "part").selectExpr(
        "*",
        "p_partkey as k",
        "split_part(p_name, ' ', 1) as f",
        "concat(split_part(p_name, ' ', 2), translate(regexp_replace(p_brand, '[^0-9]', ''), '0123456789', 'abcdefghij')) as l",
        "cast(p_partkey % 5 + 1 as int) as place",
        "timestampadd(HOUR, cast(p_partkey * 7919 % 1000 as int), timestamp_ntz'2024-01-01 00:00:00') as recorded_at",
    ).withColumn("l", F.expr("case when k % 4 = 0 then concat(substring(l, 1, place - 1), substring(l, place + 1, length(l))) else l end"))
    return names.selectExpr(
        "'SN_1' as survey_id",
        "concat('P_', lpad(cast(k as string), 12, '0')) as response_id",
        "recorded_at",
        "recorded_at as end_at",
        "'anonymous' as channel",
        "cast(k % 41 + 70 as double) as progress",
        "cast(map() as map<string,string>) as meta",
        answers(
            text(
                FIRST_COLUMN,
                "case when k % 101 = 0 then 'X' when k % 6 = 0 then upper(f) "
                "when k % 10 = 1 then translate(f, 'aeo', 'áéö') else f end",
            ),
            text(
                LAST_COLUMN,
                "case when k % 202 = 0 then 'Test' when k % 9 = 0 then concat(l, ' Jr.') else l end",
            ),
            number(
                PHASE_COLUMN,
                "case when k % 37 != 0 then case when k % 50 = 49 then 3 when k % 3 = 0 then 1 when k % 3 = 1 then 4 else 5 end end",
            ),
            items(
                MARKER_COLUMN,
                "case when k % 5 = 1 then array(p_brand) when k % 5 = 2 then cast(array() as array<string>) end",
            ),
            text("QID1", "cast(p_size % 5 + 1 as string)"),
            number("QID2", "case when k % 8 != 0 then p_retailprice / 250 end"),
        ),
    )


# -- documents as free text -----------------------------------------------------------

# Chosen to cover plain, skin-toned and joined emoji.
EMOJI_SAMPLE = "👍🏽 👩‍👧 ☀️"


DOCUMENT_TEXT = (
    "concat(text, case when doc_id % 11 = 0 then ' N/A' else '' end, "
    f"case when doc_id % 5 = 0 then '{EMOJI_SAMPLE}' else '' end)"
)


def document_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.join(table(spark, sf_dir, "labels"), "doc_id", "left").selectExpr(
        "concat('SD_', lang) as survey_id",
        "concat('D_', doc_id) as response_id",
        "cast(null as string) as channel",
        answers(
            text("QID1_TEXT", f"case when doc_id % 7 != 0 then {DOCUMENT_TEXT} end"),
            number("QID2", "quality"),
            number("QID3", "toxic"),
            text("QID5_6_TEXT", "case when doc_id % 3 = 0 then source end"),
        ),
    )


def document_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    surveys = table(spark, sf_dir, "documents").select(F.concat(F.lit("SD_"), "lang").alias("survey_id"))
    return questions_of(surveys, DOCUMENT_QUESTIONS)


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free texts in long form, repeated ones included."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('SD_', lang) as survey_id", "concat('D_', doc_id) as response_id",
        "'QID1_TEXT' as column_id", f"{DOCUMENT_TEXT} as text",
    )


def document_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, some of which many rows share, some blank, some missing."""
    key = F.col("doc_id")
    text = F.when(key % 9 == 0, F.lit(None)).when(key % 10 == 0, "  ").otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("SD_"), "lang").alias("survey_id"),
        F.concat(F.lit("D_"), key).alias("response_id"),
        F.lit("QID5_6_TEXT").alias("column_id"),
        text.alias("text"),
    )


def translation_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A translation for every text but those that some German document has."""
    documents = table(spark, sf_dir, "documents").select(F.col("text").alias("source"), "lang")
    known = documents.groupBy("source").agg(F.max(F.col("lang") == "de").alias("german")).where("not german")
    return known.select("source", F.concat(F.lit("en: "), "source").alias("target"))


# -- customers as contacts --------------------------------------------------------------

def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("contact_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.map_from_arrays(
            F.array(F.lit("nation"), F.lit("preference")), F.array(F.col("c_nationkey").cast("string"), F.lit("email"))
        ).alias("embedded"),
    )


def contact_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two updates of each fifth contact, the earlier one with more in it; some contacts are unknown."""
    key = F.col("c_custkey")
    shifted = F.when(key % 50 == 0, key + 1_000_000_000).otherwise(key)
    customers = table(spark, sf_dir, "customer").filter(key % 5 == 0)
    later = customers.select(
        shifted.alias("contact_id"),
        F.when(key % 10 == 0, F.upper("c_name")).alias("name"),
        F.lit(None).cast("string").alias("segment"),
        (F.col("c_acctbal") + 1).alias("balance"),
        F.when(key % 3 == 0, F.create_map(F.lit("preference"), F.lit("phone"))).alias("embedded"),
        F.lit(2).alias("at"),
    )
    earlier = customers.select(
        shifted.alias("contact_id"),
        F.concat(F.lit("zz "), "c_name").alias("name"),
        F.when(key % 4 == 0, "earlier").alias("segment"),
        (F.col("c_acctbal") + 9).alias("balance"),
        F.create_map(F.lit("preference"), F.lit("zz"), F.lit("shoe"), (key % 7).cast("string")).alias("embedded"),
        F.lit(1).alias("at"),
    )
    return later.unionByName(earlier)


def contact_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of up to fifty contacts; the contact at each page's start was landed twice, under another name first."""
    key = F.col("c_custkey")
    size = 50
    rows = table(spark, sf_dir, "customer").select(
        F.explode(
            F.when(key % size == 0, F.array(F.floor(key / size), F.floor(key / size) - 1)).otherwise(F.array(F.floor(key / size)))
        ).alias("page_no"),
        "*",
    ).select(
        "page_no",
        F.struct(
            F.concat(F.lit("CID_"), key).alias("contactId"),
            F.when((key % size == 0) & (F.col("page_no") < F.floor(key / size)), "zz earlier").otherwise(F.col("c_name")).alias("firstName"),
            F.col("c_mktsegment").alias("lastName"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            (key % 4 == 0).alias("unsubscribed"),
            F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("embeddedData"),
        ).alias("e"),
    )
    return rows.groupBy("page_no").agg(F.collect_list("e").alias("elements")).select(
        "page_no",
        F.to_json(
            F.struct(
                F.struct(
                    "elements",
                    F.concat(F.lit("https://example.com/contacts?offset="), (F.col("page_no") + 1) * size).alias("nextPage"),
                ).alias("result")
            )
        ).alias("page"),
    )


def survey_pages(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """A page per supplier with the two surveys it owns and the offset of the next; some names occur twice.

    Every fifth page was landed before, with older names. With ``gaps`` the listing breaks after every
    forty-first page, whose successor is missing.
    """
    key = F.col("s_suppkey")

    def survey(number: int) -> Column:
        named = F.when(F.col("landed") == 1, "An older name").when(key % 7 == 0, "Yearly survey")
        return F.struct(
            F.concat(F.lit("SV_"), key, F.lit(f"_{number}")).alias("id"),
            named.otherwise(F.concat("s_name", F.lit(f" {number}"))).alias("name"),
            F.concat(F.lit("UR_"), F.col("s_nationkey")).alias("ownerId"),
            (F.col("s_acctbal") > 0).alias("isActive"),
        )

    suppliers = table(spark, sf_dir, "supplier")
    if gaps:
        suppliers = suppliers.where((key % 41 != 0) | (key == 0))
    last = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey").alias("last"))
    following = F.when(key < F.col("last"), F.concat(F.lit("https://example.com/surveys?offset="), key + 1))
    rows = suppliers.crossJoin(F.broadcast(last)).withColumn(
        "landed", F.explode(F.when(key % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2))))
    )
    return rows.select(
        key.cast("string").alias("offset"),
        "landed",
        F.to_json(
            F.struct(F.struct(F.array(survey(1), survey(2)).alias("elements"), following.alias("nextPage")).alias("result"))
        ).alias("page"),
    )


def distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as mail-outs."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("EMD_"), F.col("event_id")).alias("distribution_id"),
        F.concat(F.lit("SV_"), F.col("user_id") % 4).alias("survey_id"),
        F.when(F.col("event_type") == "click", "Reminder").when(F.col("event_type") == "view", "ThankYou").otherwise("Invite").alias("request_type"),
        F.concat(F.lit("CG_"), F.col("event_id") % 3).alias("mailing_list_id"),
        F.col("ts").alias("send_date"),
    )
