"""Translation and contact upkeep."""

import datetime
import time
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from surveyloom.operators import contacts as K
from surveyloom.operators import translation as tr
from surveyloom.sources import tables as T

TEXTS = "survey_id string, response_id string, column_id string, text string, extra int"


def texts(spark):
    rows = [("S", "1", "Q", "hallo", 1), ("S", "2", "Q", "hallo", 2), ("S", "3", "Q", "bad", 3), ("S", "4", "Q", " \t", 4), ("S", "5", "Q", None, 5)]
    return spark.createDataFrame(rows, TEXTS)


def test_translate_columns(spark):
    def translator(batch):
        if "bad" in batch:
            raise RuntimeError("no")
        return [t.upper() for t in batch]

    out = tr.translate_columns(texts(spark), translator)
    assert out.columns == ["survey_id", "response_id", "column_id", "text", "text_translated", "text_error", "extra"]
    found = {r["response_id"]: (r["text_translated"], r["text_error"]) for r in out.collect()}
    assert found == {"1": ("HALLO", None), "2": ("HALLO", None), "3": ("bad", "error"), "4": (" \t", None), "5": (None, None)}


def test_each_text_is_translated_once(spark):
    assert sorted(r[0] for r in tr.distinct_texts(texts(spark)).collect()) == ["bad", "hallo"]


def test_translate_replace_from_a_table(spark):
    memory = spark.createDataFrame([("hallo", "hello"), ("hallo", "hello")], "source string, target string")
    out = tr.translate_replace(texts(spark), memory)
    assert {r["response_id"]: r["text"] for r in out.collect()} == {"1": "hello", "2": "hello", "3": "bad", "4": " \t", "5": None}


def test_columns_without_text_vanish(spark):
    rows = texts(spark).union(spark.createDataFrame([("S", "6", "P", None, 6)], TEXTS))
    assert {r[0] for r in tr.drop_null_columns(rows).select("column_id").distinct().collect()} == {"Q"}


def test_contacts(spark):
    schema = "contact_id string, name string, email string, embedded map<string,string>"
    stored = spark.createDataFrame([("1", "a", "a@x", {"k": "old", "l": "1"}), ("2", "b", "b@x", None)], schema)
    updates = spark.createDataFrame([("1", None, "new@x", {"k": "new"}), ("3", "c", None, {"m": "2"})], schema)
    after = {r["contact_id"]: tuple(r)[1:] for r in K.contacts_upsert(stored, updates.withColumn("at", F.lit(1)), "at").collect()}
    assert after == {"1": ("a", "new@x", {"k": "new", "l": "1"}), "2": ("b", "b@x", None), "3": ("c", None, {"m": "2"})}
    assert [r["contact_id"] for r in K.contacts_delete(stored, stored.filter("contact_id = '1'")).collect()] == ["2"]


def test_updates_of_one_contact_are_merged(spark):
    updates = spark.createDataFrame([("1", 1, "a", "x"), ("1", 2, None, "y"), ("1", 3, "c", None)], "contact_id string, at int, name string, email string")
    assert tuple(K.latest_updates(updates, "at").first()) == ("1", "c", "y")


def test_repeated_updates_of_contacts_lose_nothing(spark):
    schema = "contact_id string, at int, name string, embedded map<string,string>"
    stored = spark.createDataFrame([("1", "a", {"k": "old"})], "contact_id string, name string, embedded map<string,string>")
    updates = spark.createDataFrame([("1", 2, None, {"b": "2", "c": "late"}), ("1", 1, "n", {"a": "1", "c": "early"}), ("2", 1, "x", None)], schema)
    after = {r["contact_id"]: tuple(r)[1:] for r in K.contacts_upsert(stored, updates, order="at").collect()}
    assert after == {"1": ("n", {"k": "old", "a": "1", "b": "2", "c": "late"}), "2": ("x", None)}


def test_one_contact_with_a_million_updates(spark):
    n = 1_000_000
    at = F.col("id").alias("at")
    one = spark.range(n).select(
        F.lit("hot").alias("contact_id"), at, F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("name"),
        F.create_map(F.concat(F.lit("k"), F.col("id") % 5), F.col("id").cast("string")).alias("embedded"),
    )
    row = K.latest_updates(one, "at").first()
    assert row["name"] == "999999" and row["embedded"] == {f"k{i}": str(n - 5 + i) for i in range(5)}


def test_a_change_rewrites_the_buckets_it_touches(spark, tmp_path):
    schema = "contact_id string, name string, embedded map<string,string>"
    rows = [(str(i), f"n{i}", {"k": str(i)}) for i in range(200)]
    table = T.BucketedTable(spark, str(tmp_path / "contacts"), "contact_id", 16)
    table.write(spark.createDataFrame(rows, schema))

    def files():
        return {f: f.stat().st_mtime_ns for f in tmp_path.glob("contacts/_bucket=*/*.parquet")}

    before = files()
    updates = spark.createDataFrame([("7", 1, "new", {"x": "1"}), ("7", 2, None, {"k": "later"}), ("new", 1, "added", None)],
                                    "contact_id string, at int, name string, embedded map<string,string>")
    touched = K.merge_contacts(table, updates, "at")
    assert 1 <= len(touched) <= 2
    kept = {f for f in files() if int(f.parent.name.split("=")[1]) not in touched}
    assert {f: t for f, t in before.items() if f in kept} == {f: files()[f] for f in kept} and len(kept) > 10
    after = {r["contact_id"]: (r["name"], r["embedded"]) for r in table.read().collect()}
    assert after == {**{i: (n, m) for i, n, m in rows}, "7": ("new", {"k": "later", "x": "1"}), "new": ("added", None)}
    assert K.merge_contacts(table, updates.limit(0), "at") == [] and table.read().count() == 201


def counting(log):
    """A translator that notes in a folder what it is asked; tasks run in other processes."""
    def translator(batch):
        for text in batch:
            (log / uuid.uuid4().hex).write_text(text)
        if "later" in batch:
            raise tr.Transient("busy")
        return [None if t == "bad" else t.upper() for t in batch]

    return translator


def asked(log):
    found = sorted(f.read_text() for f in log.iterdir())
    for f in log.iterdir():
        f.unlink()
    return sorted(set(found))


def test_a_memory_asks_for_each_text_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    memory = tr.TranslationMemory(spark, str(tmp_path / "memory"))
    assert memory.table().count() == 0
    rows = texts(spark).union(spark.createDataFrame([("S", "6", "Q", "later", 6)], TEXTS))
    memory.learn(rows, counting(log), tasks=1)
    assert asked(log) == ["bad", "hallo", "later"]
    assert {tuple(r) for r in memory.table().collect()} == {("hallo", "HALLO")}
    # What is done or refused is known; what was busy is asked for again.
    more = rows.union(spark.createDataFrame([("S", "7", "Q", "neu", 7)], TEXTS))
    memory.learn(more, counting(log))
    assert asked(log) == ["later", "neu"]
    memory.learn(more.where("text != 'later'"), counting(log))
    assert asked(log) == []
    out = tr.translate_columns(more, memory.table())
    found = {r["response_id"]: (r["text_translated"], r["text_error"]) for r in out.collect()}
    assert found == {"1": ("HALLO", None), "2": ("HALLO", None), "3": ("bad", "error"), "4": (" \t", None), "5": (None, None),
                     "6": ("later", "error"), "7": ("NEU", None)}


def test_a_rate_holds_each_task_back(spark):
    sources = spark.createDataFrame([(f"t{i}",) for i in range(30)], "source string")
    began = time.monotonic()
    assert tr.call_translator(sources, lambda batch: batch, tasks=1, rate=20).count() == 30
    assert time.monotonic() - began >= 1.0


def test_bounds_with_zones(spark):
    rows = spark.createDataFrame([(datetime.datetime(2024, 1, 1, h),) for h in (0, 1, 2)], "send_date timestamp_ntz")
    assert K.since_filter(rows, "send_date", "2024-01-01T03:00:00+02:00").count() == 2
    assert K.since_filter(rows.select(F.col("send_date").cast("timestamp")), "send_date", "2024-01-01T01:00:00Z").count() == 2


def test_filters_that_are_not_given_do_nothing(spark):
    day = lambda d: datetime.datetime(2024, 1, d)
    rows = spark.createDataFrame([("s", "Invite", "l1", day(1)), ("s", "Reminder", "l2", day(2)), ("t", "Invite", "l1", day(3))],
                                 "survey_id string, request_type string, mailing_list_id string, send_date timestamp_ntz")
    assert K.distribution_filter(rows, "s").count() == 2
    assert K.distribution_filter(rows, "s", "Invite").count() == 1
    assert K.distribution_filter(rows, "s", mailing_list_id="l2", send_start="2024-01-02", send_end="2024-01-02").count() == 1
    assert K.since_filter(rows, "send_date").count() == 3
    assert K.since_filter(rows, "send_date", "2024-01-02 00:00:00").count() == 2


def test_a_translator_gets_texts_of_bounded_size(spark):
    def translator(batch):
        return [str(sum(len(t.encode()) for t in batch)) for _ in batch]

    long = [f"{i} " + "é" * 50_000 for i in range(60)]
    rows = [(t,) for t in [*long, "e" * (3 << 20), "", "short"]] + [(None,)]
    sources = spark.createDataFrame(rows, "source string")
    known = tr.call_translator(sources.where("source is not null"), translator, tasks=1).collect()
    assert sorted(r["source"] for r in known) == sorted(t for t, in rows if t is not None)
    sizes = {int(r["target"]) for r in known}
    # One text of 3 MB goes alone, all others in calls of a megabyte at most.
    assert max(sizes) == 3 << 20 and max(sizes - {3 << 20}) <= tr.CALL_BYTES


def test_portions_hold_every_text_once():
    texts = pa.array(["a", None, "", "b" * (2 << 20), "é", *"xyz"] * 3)
    for most in (None, 1, 4):
        found = list(tr.portions(texts, most))
        assert sum(found, []) == texts.to_pylist() and all(found)
        assert most is None or max(map(len, found)) <= most
    assert list(tr.portions(texts.slice(5))) and not list(tr.portions(texts.slice(0, 0)))
