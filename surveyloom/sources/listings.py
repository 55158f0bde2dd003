"""Paged listings (surveys, mailing lists, contacts, members, distributions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.json import STRICT
from surveyloom.session import store
from surveyloom.sources.rejects import parsed_documents, rejected_documents

# The fields each listing carries.
ENTITIES = {
    "surveys": "id string, name string, ownerId string, lastModified string, isActive boolean",
    "mailing_lists": "mailingListId string, name string, ownerId string, contactCount bigint",
    "contacts": (
        "contactId string, firstName string, lastName string, email string, phone string, "
        "extRef string, language string, unsubscribed boolean, embeddedData map<string,string>"
    ),
    "bounced_contacts": "contactId string, email string, bouncedDate string",
    "opted_out_contacts": "contactId string, email string, unsubscribeDate string",
    "group_members": "id string, username string, firstName string, lastName string, email string",
    "distributions": (
        "id string, requestType string, sendDate string, "
        "recipients struct<mailingListId:string>, surveyLink struct<surveyId:string>"
    ),
    "distribution_history": (
        "contactId string, responseId string, status string, sentAt string, openedAt string"
    ),
    "sms_distributions": "id string, name string, sendDate string, surveyId string",
}


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A folder of landed page files as ``(file, landed, offset, page)``.

    ``landed`` is when the file was written, ``offset`` what its name says after
    ``offset=`` (``0`` where it says nothing).
    """
    name = F.col("_metadata.file_name")
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed"),
        F.coalesce(F.nullif(F.regexp_extract(name, r"offset=(.*?)(\.json)?$", 1), F.lit("")), F.lit("0")).alias("offset"),
        F.col("value").alias("page"),
    )


def union_pages(
    pages: DataFrame, schema: str, page: str = "page", id_field: str | None = None, mode: str = STRICT,
    order: str | None = None,
) -> DataFrame:
    """Elements of all pages as rows; an id that occurs on several pages is kept once.

    ``order`` is the column of ``pages`` that says which was landed later: of
    several versions of an id the last one stays. Whether the pages are all
    there is what :func:`page_chain` tells. A broken page ends the job; with
    ``mode="PERMISSIVE"`` it is passed over.
    """
    others = [c for c in pages.columns if c != page] if id_field is None else [c for c in (order,) if c]
    read = parsed_documents(pages.select(*others, page), page, _page_of(schema), mode)
    rows = read.select(*others, F.explode(F.col(page)["result"]["elements"]).alias("e")).select(*others, "e.*")
    return rows if id_field is None else one_per_id(rows, [id_field], order).drop(*others)


def _page_of(schema: str) -> str:
    return f"struct<result:struct<elements:array<struct<{_fields(schema)}>>>>"


def rejected_pages(pages: DataFrame, schema: str, page: str = "page") -> DataFrame:
    """The pages that cannot be read: other columns, ``problem`` and the text as ``record``."""
    return rejected_documents(pages, page, _page_of(schema))


def one_per_id(rows: DataFrame, ids: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per id, the last by ``order``, combined map-side so a page landed many times costs no skew.

    What ``order`` leaves open goes by the row's content, the largest staying.
    """
    rest = [c for c in rows.columns if c not in ids]
    row = F.struct(*rest)
    by = F.struct(*[F.col(c) for c in (order,) if c], F.to_json(row).alias("_content"))
    return rows.groupBy(*ids).agg(F.max_by(row, by).alias("row")).select(*ids, "row.*").select(*rows.columns)


def page_chain(
    pages: DataFrame, first: str = "0", offset: str = "offset", landed: str = "landed", page: str = "page",
    listing: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(``pages`` with each one's ``position`` from 0, problems) of listings followed by ``nextPage``.

    A page is known by ``offset``, of several landed ones the last by ``landed``
    stays; ``listing`` names the columns that tell listings apart. Positions are
    found by pointer jumping: every page points at the one before it, and each
    round doubles how far it points, so a chain of n pages takes log2(n) rounds.
    Pages that are not reached from ``first`` have no position. ``problems`` has
    ``(listing, offset, problem)``: a next page that was not landed, a first page
    that was not landed, pages nothing landed leads to, and pages in a circle.
    """
    keys = list(listing)
    versions = one_per_id(pages, [*keys, offset], landed)
    known = store(versions.withColumn("_next", next_offset(F.col(page))), "pages")
    links = known.select(*keys, F.col(offset).alias("_from"), F.col("_next").alias(offset)).where("_next is not null")
    # Where several pages lead to one, the smallest counts.
    before = links.groupBy(*keys, offset).agg(F.min("_from").alias("_before"))
    is_first = F.col(offset) == first
    state = known.select(*keys, offset).join(before, [*keys, offset], "left").select(
        *keys, offset, F.when(is_first, F.col(offset)).otherwise(F.coalesce("_before", offset)).alias("_up"),
        F.when(~is_first & F.col("_before").isNotNull(), 1).otherwise(0).cast("long").alias("_far"),
    )
    # A page before that was not landed is where its chain begins.
    landed_ones = known.select(*keys, F.col(offset).alias("_up"), F.lit(True).alias("_there"))
    state = state.join(landed_ones, [*keys, "_up"], "left").select(
        *keys, offset, F.when(F.col("_there"), F.col("_up")).otherwise(F.col(offset)).alias("_up"),
        F.when(F.col("_there"), F.col("_far")).otherwise(0).alias("_far"),
    )
    state = store(state, "chain")
    rounds = max(1, known.count()).bit_length()
    for _ in range(rounds):
        above = state.select(*keys, F.col(offset).alias("_up"), F.col("_up").alias("_top"), F.col("_far").alias("_more"))
        moved = state.join(above, [*keys, "_up"]).select(
            *keys, offset, F.col("_top").alias("_up"), (F.col("_far") + F.col("_more")).alias("_far"),
            (F.col("_more") > 0).alias("_moved"),
        )
        moved = store(moved, "chain")
        state = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            break
    reached = F.col("_up") == first
    chain = known.join(state, [*keys, offset]).withColumn("position", F.when(reached, F.col("_far")))
    missing = links.select(*keys, offset).distinct().join(known.select(*keys, offset), [*keys, offset], "left_anti")
    # Those that point at themselves without being first begin a chain of their own; after all rounds the rest goes round.
    begins = state.where((F.col("_up") == F.col(offset)) & (F.col("_far") == 0) & ~is_first).select(*keys, offset)
    own = state.where(F.col("_far") == 0).select(*keys, F.col(offset).alias("_up"))
    circles = state.join(own, [*keys, "_up"], "left_anti").select(*keys, offset)
    named = [
        (missing, "not landed"), (begins, "no landed page leads to it"), (circles, "its pages lead in a circle"),
    ]
    listings = known.select(*keys, F.lit(first).alias(offset)).distinct() if keys else known.sparkSession.range(1).select(F.lit(first).alias(offset))
    named.append((listings.join(known.select(*keys, offset), [*keys, offset], "left_anti"), "the first page was not landed"))
    problems = None
    for rows, problem in named:
        found = rows.withColumn("problem", F.lit(problem))
        problems = found if problems is None else problems.unionByName(found)
    return chain.drop("_up", "_far", "_next"), problems


def complete_pages(pages: DataFrame, first: str = "0", **more) -> DataFrame:
    """``pages`` with their positions; a listing that is not complete ends here with what is missing."""
    chain, problems = page_chain(pages, first, **more)
    some = problems.take(5)
    if some:
        raise ValueError("incomplete listing: " + "; ".join(" ".join(map(str, r)) for r in some))
    return chain


def list_elements(pages: DataFrame, entity: str, page: str = "page") -> DataFrame:
    """A known listing by its name in ``ENTITIES``."""
    return union_pages(pages, ENTITIES[entity], page)


def next_offset(page: Column) -> Column:
    """The offset the next page starts at; null on the last one."""
    return F.nullif(
        F.regexp_extract(
            F.coalesce(F.get_json_object(page, "$.result.nextPage"), F.lit("")),
            r"\?offset=(.*)$",
            1,
        ),
        F.lit(""),
    )


def _fields(ddl: str) -> str:
    """``a string, b bigint`` -> ``a:string,b:bigint``."""
    return ",".join(f"{n}:{t}" for n, t in (part.strip().split(" ", 1) for part in _split(ddl)))


def _split(ddl: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(ddl[start:i])
            start = i + 1
    return [*parts, ddl[start:]]
