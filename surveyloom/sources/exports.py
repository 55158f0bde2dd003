"""Response exports: JSON documents of responses -> one row per response.

The canonical response row keeps its answers nested::

    survey_id, response_id, recorded_at, end_at, channel, progress,
    meta MAP<STRING,STRING>, answers ARRAY<STRUCT<column_id, kind, items, num, txt>>

so every response-level filter is a plain row filter, and the long form is one
``explode`` away without a shuffle. Times are UTC wall clock (TIMESTAMP_NTZ),
independent of the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions import columns as C
from surveyloom.functions.answers import ANSWER_TYPE
from surveyloom.functions.json import STRICT
from surveyloom.operators.filters import with_survey_dimension
from surveyloom.sources.split_documents import RANGE_BYTES, read_records

EXPORT_SCHEMA = "struct<responses:array<struct<responseId:string,values:string>>>"
RESPONSE_SCHEMA = "struct<responseId:string,values:string,broken:string>"

# Names of the metadata fields that get a typed column.
RECORDED, ENDED, CHANNEL, PROGRESS = "recordedDate", "endDate", "distributionChannel", "progress"
ID_FIELDS = ("responseId", "_recordId")

def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text to UTC wall clock; null when it does not parse."""
    return F.timestamp_add(
        "MICROSECOND",
        F.unix_micros(F.try_to_timestamp(text)),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    )


def read_export_records(
    spark: SparkSession, path: str, one_per_line: bool = False, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Everything landed export files hold: ``(file, landed_at, position, record, responseId, values, problem)``.

    A row is a response, or has a ``problem``: a record that is no JSON object,
    an element that is no record, a document that does not end. Both formats
    are split inside a file, so one document may be of any size. ``position``
    is the record's first byte; in the line-delimited format (``one_per_line``)
    it is that of the block its line was read with. Blank lines are no rows.
    """
    if one_per_line:
        found = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed_at"),
            F.col("_metadata.file_block_start").alias("position"),
            F.col("value").alias("record"), F.lit(None).cast("string").alias("problem"),
        ).where(~F.col("record").rlike(r"^\s*$"))
    else:
        found = read_records(spark, path, range_bytes=range_bytes)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    parsed = F.when(F.col("problem").isNull(), F.from_json("record", RESPONSE_SCHEMA, options))
    # A blank line is never malformed, whichever of the conditions on it Spark looks at first.
    malformed = (F.col("response.broken").isNotNull() | ~F.col("record").rlike(r"^\s*\{")) & F.col("record").rlike(r"\S")
    return found.withColumn("response", parsed).select(
        "file", "landed_at", "position", "record", "response.responseId", "response.values",
        F.coalesce("problem", F.when(malformed, "malformed")).alias("problem"),
    )


def rejected(records: DataFrame) -> DataFrame:
    """What of ``read_export_records`` is no response: ``(file, position, problem, record)``."""
    return records.where("problem is not null").select("file", "position", "problem", "record")


def accepted(records: DataFrame, mode: str = STRICT) -> DataFrame:
    """The responses of ``read_export_records`` as ``(file, landed_at, position, responseId, values)``.

    Anything rejected ends the job; with ``mode="PERMISSIVE"`` it is passed over.
    """
    if mode != STRICT:
        return records.where("problem is null").select("file", "landed_at", "position", "responseId", "values")
    where = F.concat(F.lit("malformed export: "), "problem", F.lit(" at "), F.col("position").cast("string"), F.lit(" of "), "file")
    checked = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(where).cast("boolean"))
    return records.where(checked).select("file", "landed_at", "position", "responseId", "values")


def account(records: DataFrame) -> DataFrame:
    """How many records each file landed with, and how many of them are responses: ``(file, landed, parsed, rejected)``."""
    return records.groupBy("file").agg(
        F.count("*").alias("landed"), F.count_if(F.col("problem").isNull()).alias("parsed"), F.count("problem").alias("rejected")
    )


def observed(records: DataFrame, name: str = "export") -> tuple[DataFrame, Observation]:
    """``records`` and the account of all files together, filled when an action reads the records as a whole."""
    observation = Observation(name)
    return (
        records.observe(
            observation, F.count(F.lit(1)).alias("landed"), F.count_if(F.col("problem").isNull()).alias("parsed"),
            F.count("problem").alias("rejected"),
        ),
        observation,
    )


def read_export_files(
    spark: SparkSession, path: str, one_per_line: bool = False, mode: str = STRICT
) -> DataFrame:
    """Landed export files as ``(file, landed_at, position, responseId, values)``; see :func:`read_export_records` and :func:`accepted`."""
    return accepted(read_export_records(spark, path, one_per_line), mode)


def explode_documents(documents: DataFrame, column: str, mode: str = STRICT) -> DataFrame:
    """A column of export documents as ``(other columns, responseId, values)``.

    A document without responses gives no row. A broken one ends the job; with
    ``mode="PERMISSIVE"`` it is passed over.
    """
    others = [c for c in documents.columns if c != column]
    parsed = F.from_json(column, EXPORT_SCHEMA, {"mode": mode})
    return documents.select(
        *others, F.explode(parsed["responses"]).alias("response")
    ).select(*others, "response.*")


def _with_shape(name: Column, value: Column) -> Column:
    """A field with what decides its use: the type of its value, and whether it is an answer.

    Both are looked up once here and only compared later.
    """
    return F.struct(
        name.alias("name"),
        value.alias("value"),
        F.schema_of_variant(value).alias("shape"),
        C.is_question_column(name).alias("asked"),
    )


def _fields_of(object_map: Column, prefix: Column | None = None) -> Column:
    def field(e: Column) -> Column:
        name = e["key"] if prefix is None else F.concat_ws(".", prefix, e["key"])
        return _with_shape(name, e["value"])

    return F.transform(F.map_entries(object_map), field)


def flat_values(values: Column) -> Column:
    """Fields of a JSON object as ``(name, value, shape, asked)``; those of nested objects get dotted names.

    One pass per nesting level; the number of opening braces bounds the levels,
    and a pass that finds no object left changes nothing.
    """
    top = _fields_of(F.from_json(values, "map<string,variant>"))

    def open_objects(fields: Column, _: Column) -> Column:
        def opened(f: Column) -> Column:
            inner = _fields_of(f["value"].cast("map<string,variant>"), f["name"])
            return F.when(f["shape"].startswith("OBJECT"), inner).otherwise(F.array(f))

        some = F.exists(fields, lambda f: f["shape"].startswith("OBJECT"))
        return F.when(some, F.flatten(F.transform(fields, opened))).otherwise(fields)

    levels = F.length(values) - F.length(F.replace(values, F.lit("{"))) - 1
    return F.when(levels < 1, top).otherwise(
        F.reduce(F.sequence(F.lit(1), F.greatest(levels, F.lit(1))), top, open_objects)
    )


def last_of_each(entries: Column, name: str) -> Column:
    """Entries of a map to be: of several with one name the last stays."""
    names = F.transform(entries, lambda e: e[name])
    backwards = F.reverse(names)
    last = F.filter(
        entries, lambda e, i: F.array_position(backwards, e[name]) == F.size(names) - i
    )
    return F.when(F.size(F.array_distinct(names)) == F.size(names), entries).otherwise(last)


def typed_answers(fields: Column) -> Column:
    """Question fields as answers; JSON nulls are left out.

    ``fields`` is what ``flat_values`` gives.
    """
    present = F.filter(fields, lambda f: f["asked"] & (f["shape"] != "VOID"))

    def kind(shape: Column) -> Column:
        return (
            F.when(shape.startswith("ARRAY"), "list")
            .when(shape == "BOOLEAN", "bool")
            .when((shape == "STRING") | shape.startswith("OBJECT"), "text")
            .otherwise("number")
        )

    kinds = F.transform(
        present,
        lambda f: F.struct(f["name"].alias("name"), f["value"].alias("value"), kind(f["shape"]).alias("kind")),
    )

    def answer(f: Column) -> Column:
        def read(data_type: str, *kinds_read: str) -> Column:
            return F.when(f["kind"].isin(*kinds_read), F.try_variant_get(f["value"], "$", data_type))

        return F.struct(
            f["name"].alias("column_id"),
            f["kind"].alias("kind"),
            read("array<string>", "list").alias("items"),
            read("double", "number").alias("num"),
            read("string", "text", "bool").alias("txt"),
        )

    return F.transform(kinds, answer)


def responses_from_values(
    exported: DataFrame, survey_id: Column, values: str = "values", response_id: str = "responseId",
    version: Column | None = None,
) -> DataFrame:
    """Canonical response rows from ``(responseId, values JSON)`` rows, with ``version`` beside them if it is given."""
    typed = (RECORDED, ENDED, CHANNEL, PROGRESS, *ID_FIELDS)
    more = {} if version is None else {"version": version}
    fields = exported.select(
        survey_id.cast("string").alias("survey_id"),
        F.col(response_id).alias("outer_id"),
        F.from_json(values, ",".join(f"`{n}` string" for n in typed)).alias("known"),
        flat_values(F.col(values)).alias("fields"),
        *[c.alias(n) for n, c in more.items()],
    )
    known = F.col("known")
    others = F.filter("fields", lambda f: ~f["asked"] & ~f["name"].isin(*typed))
    return fields.select(
        "survey_id",
        F.coalesce("outer_id", *[known[f] for f in ID_FIELDS]).alias("response_id"),
        utc_timestamp(known[RECORDED]).alias("recorded_at"),
        utc_timestamp(known[ENDED]).alias("end_at"),
        known[CHANNEL].alias("channel"),
        known[PROGRESS].try_cast("double").alias("progress"),
        F.map_from_entries(
            F.transform(
                last_of_each(others, "name"),
                lambda f: F.struct(f["name"], F.try_variant_get(f["value"], "$", "string")),
            )
        ).alias("meta"),
        typed_answers(F.col("fields")).cast(f"array<{ANSWER_TYPE}>").alias("answers"),
        *more,
    )


def survey_of_folder(file: Column) -> Column:
    """The name of the folder a file lies in, or what follows ``=`` in it."""
    return F.regexp_replace(F.element_at(F.split(file, "/"), -2), "^[^=]*=", "")


def read_responses(
    spark: SparkSession,
    path: str,
    survey_id: Column | None = None,
    one_per_line: bool = False,
    mode: str = STRICT,
    newest: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Landed exports as canonical response rows.

    Without ``survey_id`` the name of the folder a file lies in identifies the
    survey. With ``newest`` a response that several exports hold counts once, as
    the last landed one has it (see :func:`newest_responses`).
    """
    exported = accepted(read_export_records(spark, path, one_per_line, range_bytes), mode)
    survey = survey_of_folder(F.col("file")) if survey_id is None else survey_id
    if not newest:
        return responses_from_values(exported, survey)
    version = F.struct("landed_at", "file", "position")
    return newest_responses(responses_from_values(exported, survey, version=version), "version").drop("version")


def newest_responses(responses: DataFrame, version: str) -> DataFrame:
    """Each response once: of the rows with one (survey, response) id the one with the largest ``version``.

    Which rows stay is decided on ids and versions alone; whole responses are
    only joined with them. Rows without an id are all kept. Of several rows
    with the same id and version, the one whose content is largest stays.
    """
    ids = ["survey_id", "response_id"]
    found = responses.where(F.col("response_id").isNotNull()).select(*ids, F.col(version).alias("_version"))
    counted = found.groupBy(*ids, "_version").agg(F.count("*").alias("_rows"))
    last = counted.groupBy(*ids).agg(F.max("_version").alias("_version"), F.max_by("_rows", "_version").alias("_rows"))
    same = [responses[c].eqNullSafe(last[c]) for c in ids] + [responses[version] == last["_version"]]
    kept = responses.join(last, same).select(responses["*"], "_rows")
    # Rows that even the version does not tell apart are few; only they are compared as a whole.
    row = F.struct(*responses.columns)
    told = kept.where("_rows = 1").drop("_rows")
    rest = kept.where("_rows > 1").groupBy(*ids).agg(F.max_by(row, F.to_json(row)).alias("row")).select("row.*")
    return told.unionByName(rest).unionByName(responses.where(F.col("response_id").isNull()))


def flatten_values(exported: DataFrame, values: str = "values") -> DataFrame:
    """Every field of every response as a row ``(other columns, name, value)``."""
    others = [c for c in exported.columns if c != values]
    pairs = exported.select(*others, F.explode(flat_values(F.col(values))).alias("pair"))
    return pairs.select(
        *others,
        F.col("pair.name").alias("name"),
        F.try_variant_get("pair.value", "$", "string").alias("value"),
    )


def answers_long(responses: DataFrame) -> DataFrame:
    """One row per answer: ``(survey_id, response_id, column_id, kind, items, num, txt)``."""
    return responses.select(
        "survey_id", "response_id", F.explode("answers").alias("answer")
    ).select("survey_id", "response_id", "answer.*")


def order_columns(columns: DataFrame) -> DataFrame:
    """Position of each column of a survey: metadata first as they came, then
    question columns by question, sub-question and loop number.

    ``columns`` has ``survey_id, column_id, seen_pos``.
    """
    from pyspark.sql import Window

    column = F.col("column_id")
    is_question = C.is_question_column(column)
    w = Window.partitionBy("survey_id").orderBy(
        is_question,
        F.when(~is_question, F.col("seen_pos")),
        C.question_no(column),
        C.sub_no(column),
        C.loop_no(column),
        F.col("seen_pos"),
        column,
    )
    return columns.withColumn("position", F.row_number().over(w))


def ordered_columns(columns: DataFrame) -> DataFrame:
    """``(survey_id, columns)``: each survey's column names in order, from ``(survey_id, column_id, position)``."""
    # A survey's columns, not its responses.
    return columns.groupBy("survey_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "column_id"))), lambda c: c["column_id"]).alias("columns")
    )


def _cells(responses: DataFrame) -> Column:
    """Every value of a response as text by column name; lists are JSON."""
    by_column = F.transform(
        last_of_each(F.col("answers"), "column_id"),
        lambda a: F.struct(a["column_id"], F.coalesce(a["txt"], a["num"].cast("string"), F.to_json(a["items"]))),
    )
    typed = {RECORDED: "recorded_at", ENDED: "end_at", CHANNEL: "channel", PROGRESS: "progress"}

    def text(name: str) -> Column:
        if responses.schema[name].dataType.typeName().startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.col(name).cast("string")

    known = [F.struct(F.lit(k), text(v)) for k, v in typed.items() if v in responses.columns]
    cells = F.map_from_entries(by_column)
    if known:
        cells = F.map_concat(cells, F.map_from_entries(F.array(*known)))
    return F.map_concat(cells, F.col("meta")) if "meta" in responses.columns else cells


def wide_rows(responses: DataFrame, columns: DataFrame) -> DataFrame:
    """``(survey_id, response_id, columns, cells)``: all surveys as wide rows, in one job.

    ``columns`` has ``(survey_id, column_id, position)``, as :func:`order_columns`
    gives it: metadata first, then question columns. ``cells`` are the texts under
    ``columns``, null where a response says nothing.
    """
    joined = with_survey_dimension(responses, ordered_columns(columns))
    # Cells are looked up in a map that is made once for each response.
    mapped = joined.select("survey_id", "response_id", "columns", _cells(joined).alias("by_column"))
    return mapped.select(
        "survey_id", "response_id", "columns",
        F.transform("columns", lambda c: F.try_element_at("by_column", c)).alias("cells"),
    )


def write_wide(rows: DataFrame, path: str) -> None:
    """Wide rows of all surveys as CSV text, a folder for each survey, in one job.

    Each survey's columns are the first line of ``<path>/header/survey_id=...``,
    its rows the lines of ``<path>/rows/survey_id=...``; both replace what was
    there of those surveys and leave the others.
    """
    def line(cells: Column) -> Column:
        def quoted(cell: Column) -> Column:
            doubled = F.concat(F.lit('"'), F.regexp_replace(cell, '"', '""'), F.lit('"'))
            return F.when(cell.isNull(), "").when((cell == "") | cell.rlike('[",\\r\\n]'), doubled).otherwise(cell)

        return F.array_join(F.transform(cells, quoted), ",")

    header = rows.groupBy("survey_id").agg(F.any_value("columns").alias("columns"))
    parts = {
        "rows": rows.select("survey_id", line(F.array_insert("cells", 1, F.col("response_id"))).alias("value")).hint("rebalance", "survey_id"),
        "header": header.select("survey_id", line(F.array_insert("columns", 1, F.lit("response_id"))).alias("value")),
    }
    for name, part in parts.items():
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("survey_id").text(f"{path}/{name}")


def wide_responses(responses: DataFrame, column_ids: Sequence[str]) -> DataFrame:
    """One column per name, for the known columns of one survey in their order; no shuffle.

    Names of metadata give what the response has under them, others the answers.
    """
    mapped = responses.select("survey_id", "response_id", _cells(responses).alias("_by_column"))
    return mapped.select(
        "survey_id", "response_id", *[F.try_element_at("_by_column", F.lit(c)).alias(c) for c in column_ids]
    )
