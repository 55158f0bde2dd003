"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from surveyloom.functions import columns as C
from surveyloom.functions import text as X
from surveyloom.functions.answers import answer_to, has_answer, percentage, percentage_text
from surveyloom.functions.json import json_field
from surveyloom.functions.scores import name_match_score, ratio
from surveyloom.operators import blocks as B
from surveyloom.operators import contacts as K
from surveyloom.operators import filters as flt
from surveyloom.operators import frames
from surveyloom.operators import frequency as freq
from surveyloom.operators import fuzzy
from surveyloom.operators import matching as M
from surveyloom.operators import prepost
from surveyloom.operators import questions as Q
from surveyloom.operators import summary
from surveyloom.operators import translation as tr
from surveyloom.plans.dimensions import Dimensions, survey_dimensions
from surveyloom.plans import reports
from surveyloom.session import checkpoint, shared_folder
from surveyloom.sources import definitions as D
from surveyloom.sources import exports as E
from surveyloom.sources import listings as L
from surveyloom.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def day_time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/surveyloom-{uuid.uuid4().hex}/{name}"


# -- sources and sinks -----------------------------------------------------------

def exported(spark, d) -> DataFrame:
    return E.explode_documents(V.order_exports(spark, d), "document")


def response_fields(rows: DataFrame) -> DataFrame:
    return rows.select(
        "survey_id", "response_id", day_time("recorded_at").alias("recorded"), "channel", "progress",
        F.size("answers").alias("n_answers"),
        answer_to(F.col("answers"), "QID1")["txt"].alias("q1"),
        F.array_join(answer_to(F.col("answers"), "QID2")["items"], ",").alias("q2"),
        answer_to(F.col("answers"), "QID3")["num"].alias("q3"),
        F.element_at("meta", "location.state.status").alias("status"),
    )


@query
def read_responses(spark, d):
    """Landed documents, each read by several tasks."""
    path = V.land_documents(spark, d, scratch(spark, "documents"))
    return response_fields(E.read_responses(spark, path, range_bytes=1 << 20))


@query
def read_response_lines(spark, d):
    return response_fields(E.read_responses(spark, V.land_lines(spark, d, scratch(spark, "lines")), one_per_line=True))


@query
def read_response_column(spark, d):
    """Documents that are a column of a table."""
    return response_fields(E.responses_from_values(exported(spark, d), F.col("survey_id")))


@query
def export_account(spark, d):
    """What lines with others among them landed with, and what of it was rejected."""
    records = E.read_export_records(spark, V.land_lines(spark, d, scratch(spark, "lines"), broken=True), one_per_line=True)
    by_survey = E.account(records).groupBy(E.survey_of_folder(F.col("file")).alias("survey_id"))
    return by_survey.agg(*[F.sum(c).alias(c) for c in ("landed", "parsed", "rejected")])


@query
def newest_responses(spark, d):
    return E.newest_responses(V.order_versions(spark, d), "version").select(
        "survey_id", "response_id", "channel", F.size("answers").alias("n_answers"), "version"
    )


@query
def flatten_values(spark, d):
    return E.flatten_values(exported(spark, d)).select("survey_id", F.col("responseId").alias("response_id"), "name", "value")


@query
def union_pages(spark, d):
    return L.union_pages(V.survey_pages(spark, d), L.ENTITIES["surveys"], id_field="id", order="landed").select(
        "id", "name", F.col("ownerId").alias("owner_id"), F.col("isActive").alias("is_active")
    )


def first_offset(spark, d) -> str:
    return str(V.table(spark, d, "supplier").agg(F.min("s_suppkey")).first()[0])


@query
def page_chain(spark, d):
    """Where each page stands in its listing."""
    chain, _ = L.page_chain(V.survey_pages(spark, d), first=first_offset(spark, d))
    return chain.select(F.col("offset").alias("page_offset"), "position")


@query
def page_gaps(spark, d):
    """What is missing of a listing with gaps."""
    _, problems = L.page_chain(V.survey_pages(spark, d, gaps=True), first=first_offset(spark, d))
    return problems.select(F.col("offset").alias("page_offset"), "problem")


@query
def list_elements(spark, d):
    rows = L.list_elements(V.contact_pages(spark, d), "contacts")
    return L.one_per_id(rows, ["contactId"], "page_no").select(
        F.col("contactId").alias("contact_id"), F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"),
        "email", "unsubscribed", F.element_at("embeddedData", "nation").alias("nation"),
    )


@query
def read_definitions(spark, d):
    q = F.col("question")
    return D.read_definitions(V.part_documents(spark, d)).select(
        "survey_id", "base_qid", q["questionName"].alias("question_name"), q["questionText"].alias("question_text"),
        q["questionType"]["type"].alias("type"), q["questionType"]["selector"].alias("selector"),
        q["validation"]["type"].alias("validation"),
        F.array_join(F.transform(F.map_entries(q["choices"]), lambda e: e["value"]["choiceText"]), ";").alias("choice_texts"),
    )


def definitions(spark, d) -> DataFrame:
    return D.full_definition_join(
        D.read_definitions(V.part_documents(spark, d)), V.part_full_documents(spark, d)
    )


@query
def full_definition_join(spark, d):
    return definitions(spark, d).select(
        "survey_id", "base_qid", F.array_join("choice_order", ",").alias("choice_order")
    )


@query
def write_tables(spark, d):
    """The frequency table, written by survey and read back."""
    path = scratch(spark, "frequency")
    table = survey_frequency(spark, d)
    # First every survey with other counts, then one after the other in their place.
    T.write_tables(table.withColumn("n", F.col("n") + 1), path)
    for one in ("SV_F", "SV_O", "SV_P"):
        T.write_tables(table.where(F.col("survey_id") == one), path)
    return T.read_table(spark, path).select(
        "survey_id", "column_id", "heading", "flow_pos", "code", "value", "n", "pct", "frequency"
    )


# -- question metadata --------------------------------------------------------------

@query
def strip_html(spark, d):
    pages = V.table(spark, d, "pages")
    return pages.select("page_id", X.strip_html(F.col("html")).alias("text"))


@query
def strip_html_deep(spark, d):
    """Tags out of strings inside arrays and maps."""
    pages = V.table(spark, d, "pages").select(
        "page_id", F.struct(F.array("html", "url").alias("both"), F.create_map(F.lit("a"), F.col("html")).alias("named")).alias("nested")
    )
    cleaned = X.strip_html_deep(F.col("nested"), pages.schema["nested"].dataType)
    return pages.select("page_id", cleaned.alias("c")).select(
        "page_id", F.array_join("c.both", " ").alias("both"), F.element_at("c.named", "a").alias("named")
    )


def parsed(spark, d) -> DataFrame:
    return D.parse_definitions(V.part_documents(spark, d))


@query
def block_questions(spark, d):
    return B.block_questions(parsed(spark, d))


@query
def flow_order(spark, d):
    return B.flow_order(parsed(spark, d))


@query
def blocks(spark, d):
    return B.blocks(parsed(spark, d))


@query
def parse_column_id(spark, d):
    parts = V.part_columns(spark, d).select("survey_id", "column_id", C.parse_column_id(F.col("column_id")).alias("p")).select(
        "survey_id", "column_id", "p.*"
    )
    # The SQL has integers; a number beyond them ends the query.
    return parts.select(*[F.col(c).cast("int").alias(c) if t == "bigint" else c for c, t in parts.dtypes])


@query
def order_columns(spark, d):
    meta = V.part_columns(spark, d).select("survey_id").distinct().select(
        "survey_id", F.posexplode(F.array(F.lit("recordedDate"), F.lit("endDate"))).alias("seen_pos", "column_id")
    ).select("survey_id", "column_id", "seen_pos")
    columns = V.part_columns(spark, d).withColumn("seen_pos", F.lit(9))
    return E.order_columns(columns.unionByName(meta)).select("survey_id", "column_id", "position")


def all_columns(spark, d) -> DataFrame:
    """Position of every column, metadata first."""
    asked = Q.survey_columns(V.order_responses(spark, d)).withColumn("seen_pos", F.lit(9))
    meta = V.order_surveys(spark, d).distinct().select(
        "survey_id", F.posexplode(F.array(*map(F.lit, (E.RECORDED, E.ENDED, E.CHANNEL, E.PROGRESS)))).alias("seen_pos", "column_id")
    )
    return E.order_columns(asked.unionByName(meta))


@query
def wide_responses(spark, d):
    """All surveys as wide rows, every column in its place."""
    rows = E.wide_rows(V.order_responses(spark, d), all_columns(spark, d))
    return rows.select(
        "survey_id", "response_id", F.array_join("columns", ",").alias("names"), F.array_join("cells", "|", "-").alias("cells")
    )


@query
def wide_frame(spark, d):
    """One survey as a frame with all its columns."""
    one = F.col("survey_id") == "SV_F"
    names = [r[0] for r in all_columns(spark, d).where(one).orderBy("position").select("column_id").collect()]
    return E.wide_responses(V.order_responses(spark, d).where(one), names)


def dictionary(spark, d) -> DataFrame:
    return Q.question_dictionary(V.part_columns(spark, d), definitions(spark, d))


@query
def question_dictionary(spark, d):
    return dictionary(spark, d).select(
        "survey_id", "column_id", "question_name", "question_text", "question_type", "question_selector", "is_numeric"
    )


@query
def is_numeric(spark, d):
    return D.read_definitions(V.part_documents(spark, d)).select(
        "survey_id", "base_qid", Q.is_numeric(F.col("question")).alias("is_numeric")
    )


def texts_of_type(*kinds: str) -> Query:
    """Dictionary rows and choices of columns whose definition has one of the types."""
    def run(spark, d):
        defined = definitions(spark, d).filter(F.col("question")["questionType"]["type"].isin(*kinds))
        columns = V.part_columns(spark, d)
        about = Q.question_dictionary(columns, defined)
        offered = Q.choice_table(columns, defined).drop("choice_pos")
        return about.join(offered, ["survey_id", "column_id"], "left").select(
            "survey_id", "column_id", "question_text", "question_type", "is_numeric", "answer_id", "question_value"
        )

    return run


QUESTION_KINDS = {
    "q_matrix": ("Matrix",), "q_constant_sum": ("CS",), "q_rank_order": ("RO",), "q_slider": ("Slider",),
    "q_timing": ("Timing",), "q_graphic_slider": ("SS",), "q_pick_group_rank": ("PGR",),
    "q_default": ("MC", "TE", "FileUpload", "Meta", "Draw", "SBS"),
}
for _name, _kinds in QUESTION_KINDS.items():
    QUERIES[_name] = texts_of_type(*_kinds)


@query
def group_items(spark, d):
    return Q.group_items(V.part_columns(spark, d), definitions(spark, d))


@query
def question_tables(spark, d):
    """Choice dimension."""
    return Q.question_tables(V.part_columns(spark, d), definitions(spark, d))[1]


@query
def classify_data_type(spark, d):
    questions, _ = Q.question_tables(V.part_columns(spark, d), definitions(spark, d))
    return questions.select("survey_id", "column_id", "question_type", "data_type")


def ordered_questions(spark, d) -> DataFrame:
    questions, _ = Q.question_tables(V.part_columns(spark, d), definitions(spark, d))
    return Q.order_by_block(questions, B.blocks(parsed(spark, d)))


PLACED = ["survey_id", "block_name", "base_qid", "column_id", "data_type", "flow_pos"]


@query
def order_by_block(spark, d):
    return ordered_questions(spark, d).select(*PLACED)


@query
def drop_incomplete_questions(spark, d):
    return Q.drop_incomplete_questions(ordered_questions(spark, d)).select(*PLACED)


@query
def survey_columns(spark, d):
    return Q.survey_columns(V.order_responses(spark, d))


@query
def survey_id_by_name(spark, d):
    """Wanted names: every supplier's first survey, one that is not there, one that many have."""
    surveys = L.union_pages(V.survey_pages(spark, d), L.ENTITIES["surveys"], id_field="id", order="landed")
    names = V.table(spark, d, "supplier").select(
        F.explode(F.array(F.concat("s_name", F.lit(" 1")), F.concat("s_name", F.lit(" 3")), F.lit("Yearly survey"))).alias("name")
    ).distinct()
    return Q.survey_ids_by_name(surveys, names)


# -- filters ---------------------------------------------------------------------------

@query
def drop_preview(spark, d):
    return flt.drop_preview(V.order_responses(spark, d)).select("survey_id", "response_id", "channel")


@query
def drop_all_null(spark, d):
    return flt.drop_all_null(V.order_responses(spark, d), V.order_questions(spark, d)).select("survey_id", "response_id")


@query
def date_range(spark, d):
    return flt.date_range(V.order_responses(spark, d), "1996-06-27", "1998-07-08").select(
        "survey_id", "response_id", day_time("recorded_at").alias("recorded")
    )


@query
def cutoff_split(spark, d):
    return flt.cutoff_split(V.event_responses(spark, d), V.CUTOFF).select("survey_id", "response_id", "phase")


@query
def eligible_responses(spark, d):
    return flt.eligible_responses(V.people_responses(spark, d), V.PHASE_COLUMN).select("response_id", "progress")


@query
def select_questions(spark, d):
    kept = flt.select_questions(V.order_responses(spark, d), ["QID1", "QID5_TEXT"])
    return kept.select("survey_id", "response_id", day_time("recorded_at").alias("recorded"), F.explode("answers").alias("a")).select(
        "survey_id", "response_id", "recorded", "a.column_id", "a.txt"
    )


@query
def cohort_split(spark, d):
    return flt.cohort_split(V.people_responses(spark, d), flt.phase_code(V.PHASE_COLUMN)).select("response_id", "cohort")


@query
def regional_nonzero(spark, d):
    return flt.regional_nonzero(survey_frequency(spark, d), [V.PROGRAM]).select("survey_id", "column_id", "code", "n")


@query
def parse_recorded_date(spark, d):
    rows = E.flatten_values(exported(spark, d)).filter(F.col("name") == E.RECORDED)
    return rows.select("survey_id", F.col("responseId").alias("response_id"), flt.parse_recorded_date(F.col("value")).alias("recorded"))


@query
def free_text_view(spark, d):
    return flt.free_text_view(V.document_responses(spark, d), V.document_questions(spark, d), skip_other=True).select(
        "survey_id", "response_id", "column_id", "question_text", "text"
    )


@query
def reportable_questions(spark, d):
    return flt.reportable_questions(V.order_questions(spark, d), by_type=True).select("survey_id", "column_id", "data_type", "flow_pos")


# -- aggregations -------------------------------------------------------------------------

def usable(spark, d) -> DataFrame:
    return reports.usable_responses(V.order_responses(spark, d), V.order_questions(spark, d))


@query
def normalise_answers(spark, d):
    return freq.normalise_answers(usable(spark, d), V.order_questions(spark, d))


@query
def frequency_mc(spark, d):
    questions = freq.of_type(V.order_questions(spark, d), "MultipleChoice")
    return freq.frequency_mc(usable(spark, d), questions, V.order_choices(spark, d))


@query
def frequency_numeric(spark, d):
    return freq.frequency_numeric(usable(spark, d), freq.of_type(V.order_questions(spark, d), "Numeric"))


@query
def frequency_numeric_labelled(spark, d):
    """Numeric answers under labels for some of the values."""
    labels = V.order_choices(spark, d).filter(F.col("column_id") == "QID4").withColumn("column_id", F.lit("QID3"))
    return freq.frequency_numeric_labelled(
        usable(spark, d), freq.of_type(V.order_questions(spark, d), "Numeric"), labels
    )


@query
def survey_frequency(spark, d):
    return freq.survey_frequency(usable(spark, d), V.order_questions(spark, d), V.order_choices(spark, d)).select(
        "survey_id", "column_id", "heading", "question_text", "data_type", "block_name", "flow_pos", "code", "value", "n", "pct", "frequency"
    )


@query
def survey_header(spark, d):
    return summary.survey_header(usable(spark, d), V.order_questions(spark, d))


@query
def missing_stats(spark, d):
    return summary.missing_stats(usable(spark, d), V.order_questions(spark, d))


@query
def free_text_compliance(spark, d):
    return summary.free_text_compliance(V.document_responses(spark, d), V.document_questions(spark, d))


@query
def text_entry_counts(spark, d):
    return summary.text_entry_counts(tr.clean_texts(V.document_texts(spark, d)))


@query
def pct_text(spark, d):
    """Share of each priority in its status."""
    o = V.table(spark, d, "orders")
    keys = ["o_orderstatus", "o_orderpriority"]
    n = o.groupBy(*keys).agg(F.count("*").alias("n"))
    base = o.groupBy("o_orderstatus").agg(F.count("*").alias("base"))
    pct = percentage(F.col("n"), F.col("base"))
    return n.join(base, "o_orderstatus").select(*keys, pct.alias("pct"), percentage_text(pct).alias("frequency"))


@query
def chart_series(spark, d):
    return freq.chart_series(survey_frequency(spark, d)).select("survey_id", "column_id", "code", "pct", "is_null_bar")


@query
def pre_post_header(spark, d):
    return summary.pre_post_header(phased(spark, d))


# -- pre and post -------------------------------------------------------------------------

def phased(spark, d) -> DataFrame:
    usable_events = flt.drop_all_null(V.event_responses(spark, d), V.event_questions(spark, d))
    return flt.cutoff_split(usable_events, V.CUTOFF)


@query
def pre_post_mc(spark, d):
    questions = freq.of_type(V.event_questions(spark, d), "MultipleChoice")
    return prepost.pre_post_mc(phased(spark, d), questions, V.event_choices(spark, d))


@query
def pre_post_numeric(spark, d):
    return prepost.pre_post_numeric(phased(spark, d), freq.of_type(V.event_questions(spark, d), "Numeric"))


@query
def pre_post_report(spark, d):
    return prepost.pre_post_report(
        phased(spark, d), V.event_questions(spark, d), V.event_choices(spark, d), ["What happened?"]
    ).select(
        "survey_id", "column_id", "heading", "code", "value", "pre_n", "pre_frequency", "post_n", "post_frequency"
    )


def two_surveys(spark, d) -> tuple[DataFrame, DataFrame]:
    sides = [V.survey_of_two(spark, d, s) for s in ("SE_0", "SE_1")]
    dims = [Dimensions(*V.dimensions_of_two(spark, d, s)) for s in ("SE_0", "SE_1")]
    return reports.pre_post_of_two_surveys(*sides, *dims, "SE")


@query
def pre_post_two_surveys(spark, d):
    """One survey's responses compared with another's; each asks a question the other does not."""
    return two_surveys(spark, d)[1].select("column_id", "code", "value", "pre_n", "pre_frequency", "post_n", "post_frequency")


@query
def pre_post_two_surveys_header(spark, d):
    return two_surveys(spark, d)[0]


@query
def pre_post_chart_series(spark, d):
    table = prepost.pre_post_report(phased(spark, d), V.event_questions(spark, d), V.event_choices(spark, d))
    return freq.chart_series(table).select("survey_id", "column_id", "code", "pre_pct", "post_pct", "is_null_bar")


# -- people --------------------------------------------------------------------------------

def named_people(spark, d) -> DataFrame:
    eligible = flt.eligible_responses(V.people_responses(spark, d), V.PHASE_COLUMN)
    return M.people_from_responses(eligible, V.FIRST_COLUMN, V.LAST_COLUMN, V.MARKER_COLUMN)


EXCLUDED = (("small", "ringb"), ("old", "gearcc"))
SETTINGS = reports.MatchingSettings(
    V.FIRST_COLUMN, V.LAST_COLUMN, V.MARKER_COLUMN, V.PHASE_COLUMN, excluded_names=EXCLUDED
)


def cohorts(spark, d) -> DataFrame:
    """Deduplicated people; stored, since matching uses them many times."""
    return checkpoint(reports.cohorts_of(V.people_responses(spark, d), SETTINGS))


@query
def clean_name(spark, d):
    return M.clean_names(named_people(spark, d)).select("response_id", "first", "last")


@query
def drop_test_names(spark, d):
    return M.drop_test_names(named_people(spark, d), EXCLUDED).select("response_id", "first", "last")


@query
def has_answer_(spark, d):
    rows = V.people_responses(spark, d)
    return rows.select("response_id", has_answer(answer_to(F.col("answers"), V.MARKER_COLUMN)).alias("has_answer"))


QUERIES["has_answer"] = QUERIES.pop("has_answer_")


@query
def latest_valid_per_name(spark, d):
    people = reports.cohorts_of(V.people_responses(spark, d), SETTINGS)
    return people.select("cohort", "first", "last", "response_id", "marker", day_time("recorded_at").alias("recorded"))


def sides(spark, d):
    people = cohorts(spark, d)
    return [M.cohort(people, c) for c in M.COHORTS]


IDS = ["pre_id", "post_id", "unsure_id"]
MATCH = [*IDS, "pre_first", "pre_last", "post_first", "post_last", "unsure_first", "unsure_last", "match_score"]


@query
def exact_match_pre_post(spark, d):
    pre, post, _ = sides(spark, d)
    return M.exact_match_pre_post(pre, post)[0].select(*MATCH)


@query
def exact_match_pre_unsure(spark, d):
    pre, post, unsure = sides(spark, d)
    left = M.exact_match_pre_post(pre, post)[1]
    return M.exact_match_pre_unsure(left, unsure)[0].select(*MATCH)


@query
def exact_match_post_unsure(spark, d):
    pre, post, unsure = sides(spark, d)
    _, pre_left, post_left = M.exact_match_pre_post(pre, post)
    unsure_left = M.exact_match_pre_unsure(pre_left, unsure)[2]
    return M.exact_match_post_unsure(post_left, unsure_left)[0].select(*MATCH)


@query
def match_cascade(spark, d):
    """Matches, and the left-over people with stage 0."""
    matches, leftovers = M.match_cascade(cohorts(spark, d))
    one = [F.when(F.col("cohort") == c, F.col("response_id")).alias(f"{c}_id") for c in M.COHORTS]
    return matches.select("stage", *IDS).unionByName(leftovers.select(F.lit(0).alias("stage"), *one))


@query
def match_leftovers(spark, d):
    return M.match_cascade(cohorts(spark, d))[1]


@query
def name_match_score_(spark, d):
    """Each person against the one with the next key."""
    people = M.clean_names(named_people(spark, d)).select(
        F.substring("response_id", 3, 12).cast("bigint").alias("k"), "response_id", "first", "last"
    )
    other = people.select((F.col("k") - 1).alias("k"), F.col("first").alias("first_b"), F.col("last").alias("last_b"))
    return people.join(other, "k").select(
        "response_id",
        ratio(F.col("first"), F.col("first_b")).alias("first_ratio"),
        ratio(F.col("last"), F.col("last_b")).alias("last_ratio"),
        name_match_score(F.col("first"), F.col("last"), F.col("first_b"), F.col("last_b")).alias("score"),
    )


QUERIES["name_match_score"] = QUERIES.pop("name_match_score_")


@query
def fuzzy_best_match(spark, d):
    """Best post person for each pre person, all of them."""
    pre, post, _ = sides(spark, d)
    return fuzzy.fuzzy_best_match(pre, post, "pre", "post").select(
        "pre_id", "pre_first", "pre_last", "post_id", "post_first", "post_last", "match_score"
    )


def candidates(spark, d) -> DataFrame:
    return fuzzy.fuzzy_candidates(M.match_cascade(cohorts(spark, d))[1])


@query
def fuzzy_candidates(spark, d):
    return candidates(spark, d).select(*MATCH)


CONFIRMED_ABOVE = 95


def confirmed(spark, d):
    """A reviewer who accepts candidates above a score, and names one that does not exist."""
    matches, leftovers = M.match_cascade(cohorts(spark, d))
    found = checkpoint(fuzzy.fuzzy_candidates(leftovers))
    accepted = found.filter(F.col("match_score") > CONFIRMED_ABOVE).select(*IDS)
    unknown = accepted.agg(F.lit("P_none").alias("pre_id"), F.max("post_id").alias("post_id")).withColumn(
        "unsure_id", F.lit(None).cast("string")
    )
    return M.confirm_matches(matches, found, leftovers, accepted.unionByName(unknown))


@query
def confirm_matches(spark, d):
    matches, remaining, leftovers = confirmed(spark, d)
    rows = matches.select(F.lit("match").alias("part"), *IDS, "match_score").unionByName(
        remaining.select(F.lit("candidate").alias("part"), *IDS, "match_score")
    )
    one = [F.when(F.col("cohort") == c, F.col("response_id")).alias(f"{c}_id") for c in M.COHORTS]
    return rows.unionByName(
        leftovers.select(F.lit("leftover").alias("part"), *one, F.lit(None).cast("double").alias("match_score"))
    )


def numbered(spark, d):
    people = cohorts(spark, d)
    return people, M.match_ids(M.match_cascade(people)[0])


@query
def match_ids(spark, d):
    return numbered(spark, d)[1].select("match_id", "stage", *IDS)


SIDE = ["match_id", "cohort", "response_id", "first", "last"]


@query
def pre_side(spark, d):
    people, matches = numbered(spark, d)
    return M.pre_side(matches, people).select(*SIDE)


@query
def post_side(spark, d):
    people, matches = numbered(spark, d)
    return M.post_side(matches, people).select(*SIDE)


@query
def matched_pre_post(spark, d):
    """Pre/post report over matched people, questions and choices from the data."""
    people, matches = numbered(spark, d)
    surveys = people.select("survey_id").distinct()
    rows = [
        ("QID1", "Q1", "Size", "MC", "SAVR", False, "MultipleChoice", "Block", "000001"),
        ("QID2", "Q2", "Price", "TE", "SL", True, "Numeric", "Block", "000002"),
    ]
    choices = surveys.select(
        "survey_id", F.lit("QID1").alias("column_id"),
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.struct(
            i.cast("string").alias("answer_id"), F.concat(F.lit("Size "), i).alias("question_value")
        ))).alias("c"),
    ).select("survey_id", "column_id", "c.*")
    dims = Dimensions(V.questions_of(surveys, rows), choices)
    matching = reports.Matching(people, matches, matches, people)
    return reports.matched_pre_post_report(matching, dims)[1].select(
        "column_id", "code", "value", "pre_n", "pre_frequency", "post_n", "post_frequency"
    )


@query
def label_join(spark, d):
    """Counts of codes and the choices offered, either of which may lack the other."""
    tallied = freq.tally(usable(spark, d))
    stats = freq.column_stats(tallied, V.order_questions(spark, d))
    return freq.labelled(freq.seen_codes(tallied, stats), V.order_choices(spark, d))


@query
def union_by_name(spark, d):
    """People, documents and contacts; the contacts' ids are numbers."""
    contacts = V.contacts(spark, d).withColumnRenamed("contact_id", "response_id")
    return frames.union_by_name({
        "people": M.clean_names(named_people(spark, d)).select("response_id", "first", "last", "marker"),
        "documents": V.document_responses(spark, d).select("response_id", "survey_id", "channel"),
        "contacts": contacts.select("response_id", "name", "balance"),
    }, source="source")


# -- text ------------------------------------------------------------------------------------

@query
def clean_text(spark, d):
    return V.document_texts(spark, d).select(
        "response_id", X.clean_text(F.col("text")).alias("text"), X.clean_text(F.col("text"), exact=True).alias("text_exact")
    )


@query
def drop_null_columns(spark, d):
    texts = tr.clean_texts(V.document_texts(spark, d))
    silent = V.document_sources(spark, d).withColumn(
        "text", F.when(F.col("survey_id") != "SD_de", F.col("text"))
    )
    return tr.drop_null_columns(texts.unionByName(silent)).select("survey_id", "response_id", "column_id")


@query
def remove_emojis(spark, d):
    return tr.remove_emojis_from(V.document_texts(spark, d)).select("response_id", "text")


@query
def translate_columns(spark, d):
    return tr.translate_columns(V.document_sources(spark, d), V.translation_memory(spark, d))


@query
def translate_replace(spark, d):
    return tr.translate_replace(V.document_sources(spark, d), V.translation_memory(spark, d))


def failing_translator():
    """A translator that fails on texts whose length five divides; tasks get it by value."""
    def translator(texts):
        if any(len(t) % 5 == 0 for t in texts):
            raise RuntimeError("cannot translate")
        return ["en: " + t for t in texts]

    return translator


@query
def translate_call(spark, d):
    return tr.translate_columns(V.document_sources(spark, d), failing_translator())


@query
def translate_with_memory(spark, d):
    """A memory that begins with some of the texts and then learns the rest."""
    texts = V.document_sources(spark, d)
    memory = tr.TranslationMemory(spark, scratch(spark, "memory"))
    memory.learn(texts.where(F.col("survey_id") == "SD_en"), failing_translator())
    memory.learn(texts, failing_translator())
    return tr.translate_columns(texts, memory.table())


@query
def json_fields(spark, d):
    return V.table(spark, d, "events").select(
        "event_id", json_field(F.col("props"), "$.k", "bigint").alias("k"), json_field(F.col("props"), "$.none.deeper").alias("absent")
    )


@query
def to_text(spark, d):
    """Choices whose ids came as numbers."""
    choices = V.order_choices(spark, d).withColumn("answer_id", F.col("answer_id").cast("double"))
    return frames.to_text(choices, choices.columns).select("survey_id", "column_id", "answer_id", "question_value")


# -- contacts and distributions ------------------------------------------------------------------

def contact_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "contact_id", "name", "segment", "balance",
        *[F.try_element_at("embedded", F.lit(k)).alias(k) for k in ("nation", "preference", "shoe")],
    )


@query
def contacts_upsert(spark, d):
    return contact_rows(K.contacts_upsert(V.contacts(spark, d), V.contact_updates(spark, d), "at"))


@query
def merge_contacts(spark, d):
    """The same through a stored table, of which the touched buckets are rewritten."""
    contacts = T.BucketedTable(spark, scratch(spark, "contacts"), "contact_id", 16)
    contacts.write(V.contacts(spark, d))
    K.merge_contacts(contacts, V.contact_updates(spark, d), "at")
    return contact_rows(contacts.read())


@query
def contacts_delete(spark, d):
    gone = V.table(spark, d, "customer").select(F.col("c_custkey").alias("contact_id")).filter(F.col("contact_id") % 13 == 0)
    return K.contacts_delete(V.contacts(spark, d), gone).select("contact_id", "name")


@query
def since_filter(spark, d):
    return K.since_filter(V.table(spark, d, "events"), "ts", "2024-01-20 12:00:00").select("event_id", "user_id")


@query
def distribution_filter(spark, d):
    return K.distribution_filter(
        V.distributions(spark, d), "SV_1", "Reminder", send_start="2024-01-05", send_end="2024-01-25 06:00:00"
    ).select("distribution_id", "mailing_list_id")


# -- reports -----------------------------------------------------------------------------------------

@query
def survey_dimensions_(spark, d):
    """Questions the flow shows, from definitions and the columns answers have."""
    answers = F.array(F.struct(F.col("column_id"), F.lit("text").alias("kind")))
    responses = V.part_columns(spark, d).select("survey_id", answers.alias("answers"))
    dims = survey_dimensions(responses, V.part_documents(spark, d), V.part_full_documents(spark, d))
    return dims.questions.select("survey_id", "column_id", "question_text", "data_type", "flow_pos")


QUERIES["survey_dimensions"] = QUERIES.pop("survey_dimensions_")


@query
def translation_report(spark, d):
    cleaned = tr.clean_texts(V.document_texts(spark, d)).where("survey_id != 'SD_de' AND text IS NOT NULL").select(F.col("text").alias("source"))
    known = cleaned.unionByName(V.table(spark, d, "documents").select("source")).distinct()
    memory = known.select("source", F.concat(F.lit("en: "), "source").alias("target"))
    dims = Dimensions(V.document_questions(spark, d), V.document_questions(spark, d))
    return reports.translation_report(V.document_responses(spark, d), dims, memory, replace=True).select(
        "survey_id", "response_id", "column_id", "text"
    )
