"""Upkeep of contact tables and reading of distribution tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.operators.filters import literal_time
from surveyloom.session import freeing, store
from surveyloom.sources.tables import BucketedTable

CONTACT_ID = "contact_id"


def contacts_upsert(contacts: DataFrame, updates: DataFrame, order: str, key: str = CONTACT_ID) -> DataFrame:
    """Contacts after partial updates; several updates of one contact are merged first.

    ``order`` is the column of ``updates`` that says which came later. An
    attribute the update leaves null keeps its stored value; map attributes
    (embedded data) are merged key by key, the update winning. Updates of
    unknown contacts are added.
    """
    updates = latest_updates(updates, order, key)
    joined = contacts.alias("old").join(updates.alias("new"), key, "full_outer")
    columns: list[Column] = [F.col(key)]
    for field in contacts.schema.fields:
        name = field.name
        if name == key:
            continue
        old = F.col(f"old.{name}")
        if name not in updates.columns:
            columns.append(old)
        elif isinstance(field.dataType, T.MapType):
            columns.append(_merged_map(old, F.col(f"new.{name}")).alias(name))
        else:
            columns.append(F.coalesce(F.col(f"new.{name}"), old).alias(name))
    return joined.select(*columns)


def merge_contacts(table: BucketedTable, updates: DataFrame, order: str) -> list[int]:
    """Apply partial updates to a stored contact table; which buckets were rewritten."""
    with freeing(table.spark):
        merged = store(latest_updates(updates, order, table.key).withColumn(order, F.lit(0)), "updates")
        return table.change(merged, lambda stored, changes: contacts_upsert(stored, changes, order, table.key))


def _merged_map(old: Column, new: Column) -> Column:
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.coalesce(F.map_concat(kept, new), new, old)


def latest_updates(updates: DataFrame, order: str, key: str = CONTACT_ID) -> DataFrame:
    """Several partial updates of one contact as one: per attribute, and per key of a map, the last one given.

    Equal order goes by the value, so the result does not depend on the rows'
    places. Every value is found as a maximum, combined before the shuffle, so
    one contact may have any number of updates; what is gathered for it is one
    entry for each key of a map.
    """
    named = [f for f in updates.schema.fields if f.name not in (key, order)]
    maps = [f.name for f in named if isinstance(f.dataType, T.MapType)]
    plain = [f.name for f in named if f.name not in maps]
    last = [
        F.max(F.when(F.col(n).isNotNull(), F.struct(F.col(order).alias("at"), F.col(n).alias("value"))))["value"].alias(n)
        for n in plain
    ]
    # An empty map is an update that says nothing.
    found = updates.groupBy(key).agg(F.count("*").alias("_n"), *last).drop("_n")
    for name in maps:
        entries = updates.select(key, order, F.explode(name).alias("_k", "_v")).groupBy(key, "_k").agg(
            F.max(F.struct(F.col(order).alias("at"), F.col("_v").alias("value")))["value"].alias("_v")
        )
        whole = entries.groupBy(key).agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("_k", "_v")))).alias(name)
        )
        found = found.join(whole, key, "left")
    return found.select(key, *[f.name for f in named])


def contacts_delete(contacts: DataFrame, ids: DataFrame, key: str = CONTACT_ID) -> DataFrame:
    return contacts.join(ids.select(key), key, "left_anti")


def _bound(rows: DataFrame, column: str, value) -> Column:
    """A bound in the type of its column; for times it may have a zone."""
    kind = rows.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return literal_time(rows, column, value)
    return F.lit(value).cast(kind)


def since_filter(contacts: DataFrame, column: str, since=None) -> DataFrame:
    """Contacts whose bounce or opt-out is not before ``since``; all of them without it."""
    return contacts if since is None else contacts.filter(F.col(column) >= _bound(contacts, column, since))


def distribution_filter(
    distributions: DataFrame,
    survey_id: str,
    request_type: str | None = None,
    mailing_list_id: str | None = None,
    send_start=None,
    send_end=None,
) -> DataFrame:
    """Distributions of a survey; each filter applies only if given, bounds are included."""
    kept = F.col("survey_id") == survey_id
    if request_type is not None:
        kept = kept & (F.col("request_type") == request_type)
    if mailing_list_id is not None:
        kept = kept & (F.col("mailing_list_id") == mailing_list_id)
    if send_start is not None:
        kept = kept & (F.col("send_date") >= _bound(distributions, "send_date", send_start))
    if send_end is not None:
        kept = kept & (F.col("send_date") <= _bound(distributions, "send_date", send_end))
    return distributions.filter(kept)
