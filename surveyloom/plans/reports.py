"""The reports: frequencies, pre/post, matched pre/post, text compliance, translation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators import filters as flt
from surveyloom.operators import frequency as freq
from surveyloom.operators import fuzzy
from surveyloom.operators import matching as match
from surveyloom.operators import prepost
from surveyloom.operators import summary
from surveyloom.operators import translation as tr
from surveyloom.plans.dimensions import Dimensions
from surveyloom.session import checkpoint


def usable_responses(
    responses: DataFrame, questions: DataFrame, data_types: Iterable[str] | None = None
) -> DataFrame:
    """Without previews and without responses that answer none of the questions.

    With ``data_types`` answers to questions of other types are left behind.
    """
    return flt.drop_all_null(flt.drop_preview(responses), questions, data_types)


def frequency_report(
    responses: DataFrame,
    dimensions: Dimensions,
    regional: Iterable[str] = (),
    start=None,
    end=None,
) -> tuple[DataFrame, DataFrame]:
    """(header, table) of every survey."""
    ranged = responses if start is None else flt.date_range(responses, start, end)
    kept = usable_responses(ranged, dimensions.questions, flt.REPORTABLE)
    table = freq.survey_frequency(kept, dimensions.questions, dimensions.choices, regional)
    return summary.survey_header(kept, dimensions.questions), freq.report_order(table)


def pre_post_by_cutoff(
    responses: DataFrame, dimensions: Dimensions, cutoff, regional: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(header, table) comparing what came up to the cutoff with what came later."""
    phased = flt.cutoff_split(usable_responses(responses, dimensions.questions, flt.REPORTABLE), cutoff)
    table = prepost.pre_post_report(phased, dimensions.questions, dimensions.choices, regional)
    return summary.pre_post_header(phased), freq.report_order(table)


def pre_post_of_two_surveys(
    pre: DataFrame, post: DataFrame, pre_dimensions: Dimensions, post_dimensions: Dimensions, survey_id: str,
    regional: Iterable[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(header, table) comparing two surveys, each with its own questions, under the id ``survey_id``.

    A respondent counts who answers any question of their own survey. All
    questions of either are reported; of one that only one survey asks the other
    has neither answers nor skipped ones.
    """
    sides = [
        flt.drop_all_null(
            prepost.as_phase(flt.drop_preview(rows), survey_id, phase),
            dimensions.questions.withColumn("survey_id", F.lit(survey_id)),
        )
        for rows, dimensions, phase in ((pre, pre_dimensions, "pre"), (post, post_dimensions, "post"))
    ]
    phased = sides[0].unionByName(sides[1], allowMissingColumns=True)
    questions = prepost.questions_of_both(pre_dimensions.questions, post_dimensions.questions, survey_id)
    choices = prepost.choices_of_both(pre_dimensions.choices, post_dimensions.choices, survey_id)
    table = prepost.pre_post_report(phased, questions, choices, regional, apart=True)
    return summary.pre_post_header(phased), freq.report_order(table)


@dataclass(frozen=True)
class MatchingSettings:
    """Which questions hold names, marker and phase, and how people are told apart."""

    first_column: str
    last_column: str
    marker_column: str
    phase_column: str
    min_progress: float = 82
    cohorts: Mapping[str, str] = field(
        default_factory=lambda: {"1": "pre", "4": "post", "5": "unsure"}
    )
    excluded_names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Matching:
    people: DataFrame
    matches: DataFrame
    candidates: DataFrame
    leftovers: DataFrame


def cohorts_of(responses: DataFrame, settings: MatchingSettings) -> DataFrame:
    """One row per cohort and name: eligible, named, latest or latest with the marker."""
    eligible = flt.eligible_responses(responses, settings.phase_column, settings.min_progress)
    people = match.people_from_responses(
        eligible, settings.first_column, settings.last_column, settings.marker_column
    )
    named = match.drop_test_names(people, settings.excluded_names)
    split = flt.cohort_split(named, flt.phase_code(settings.phase_column), settings.cohorts)
    return match.latest_valid_per_name(split.drop("meta"))


def match_people(
    responses: DataFrame, settings: MatchingSettings, confirmations: DataFrame | None = None
) -> Matching:
    """Exact cascade, fuzzy candidates for the rest, and the links a reviewer confirmed."""
    people = checkpoint(cohorts_of(responses, settings))
    matches, leftovers = match.match_cascade(people)
    candidates = checkpoint(fuzzy.fuzzy_candidates(leftovers))
    if confirmations is not None:
        matches, candidates, leftovers = match.confirm_matches(
            matches, candidates, leftovers, confirmations
        )
    return Matching(people, match.match_ids(matches), candidates, leftovers)


def matched_pre_post_report(
    matching: Matching, dimensions: Dimensions, regional: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(header, table) over the matched people, one pre and one post row per match."""
    def side(name: str) -> DataFrame:
        rows = match.side_of_matches(matching.matches, matching.people, name)
        return rows.withColumn("phase", F.lit(name))

    phased = side("pre").unionByName(side("post"))
    table = prepost.pre_post_report(phased, dimensions.questions, dimensions.choices, regional)
    return summary.pre_post_header(phased), freq.report_order(table)


def text_compliance_report(responses: DataFrame, dimensions: Dimensions) -> DataFrame:
    """How many answered each free-text question."""
    kept = usable_responses(responses, dimensions.questions)
    return summary.free_text_compliance(kept, dimensions.questions)


def translation_report(
    responses: DataFrame, dimensions: Dimensions, translator, replace: bool = False
) -> DataFrame:
    """Cleaned free texts with their translation beside or, with ``replace``, instead of them."""
    kept = usable_responses(responses, dimensions.questions)
    texts = tr.clean_texts(flt.free_text_view(kept, dimensions.questions, skip_other=True))
    texts = tr.drop_null_columns(texts)
    return tr.translate_replace(texts, translator) if replace else tr.translate_columns(texts, translator)
