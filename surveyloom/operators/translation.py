"""Free-text cleaning and translation in long form.

Texts are rows ``(survey_id, response_id, column_id, text)``. A translator is a
Python callable on a batch of texts, or a table ``(source, target)``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.text import clean_text, remove_emojis
from surveyloom.session import freeing, ship_package, store

ERROR = "error"
# Bytes of text that a translator gets at a time, one text at least: only they are Python objects.
CALL_BYTES = 1 << 20
# A batch translator gets a list of texts and returns as many results; a result
# of None, or an exception for the batch, means failure.
Translator = Callable[[Sequence[str]], Sequence[str | None]]



def clean_texts(texts: DataFrame, text: str = "text", exact: bool = False) -> DataFrame:
    """Texts in clean form; a missing one is null."""
    return texts.withColumn(text, clean_text(F.col(text), exact))


def drop_null_columns(texts: DataFrame, text: str = "text") -> DataFrame:
    """Without the columns (of a survey) in which no text is left."""
    keys = ["survey_id", "column_id"]
    filled = texts.filter(F.col(text).isNotNull()).select(*keys).distinct()
    return texts.join(filled, keys, "left_semi")


def remove_emojis_from(frame: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Without emoji in the given columns, or in every string column."""
    if columns is None:
        columns = [c for c, t in frame.dtypes if t == "string"]
    return frame.withColumns({c: remove_emojis(F.col(c)) for c in columns})


def _has_text(text: Column) -> Column:
    return text.rlike(r"(?U)\S")


def distinct_texts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Each text that has to be translated, once."""
    return texts.filter(_has_text(F.col(text))).select(F.col(text).alias("source")).distinct()


class Transient(Exception):
    """What a translator raises when the same text may succeed another time."""


# What became of a text: translated, refused for good, or to be asked for again.
DONE, REFUSED, AGAIN = "done", "refused", "again"


def portions(texts: pa.Array, most: int | None = None) -> Iterator[list[str]]:
    """The texts in lists of up to ``CALL_BYTES``, or of a single text, and of up to ``most`` texts."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + CALL_BYTES, "right")))
        last = last if most is None else min(last, first + most)
        yield texts.slice(first, last - first).to_pylist()
        first = last


def call_translator(
    sources: DataFrame, translator: Translator, tasks: int | None = None, rate: float | None = None
) -> DataFrame:
    """``(source, target, status)`` by calling the translator with batches of distinct texts, of bounded size.

    ``tasks`` is how many tasks call at a time at most, ``rate`` how many texts
    each of them sends in a second, for services that bear no more; without
    them Spark's shuffle settings decide. ``target`` is null where it failed,
    and ``status`` tells whether that is final (``refused``) or not (``again``,
    after :class:`Transient`). A batch that raises is tried text by text, so one
    bad text costs no other.
    """
    def one(text: str) -> tuple[str | None, str]:
        try:
            target = translator([text])[0]
        except Transient:
            return None, AGAIN
        except Exception:
            return None, REFUSED
        return target, REFUSED if target is None else DONE

    def answered(texts: list[str]) -> list[tuple[str | None, str]]:
        try:
            targets = list(translator(texts))
        except Exception:
            return [one(text) for text in texts]
        if len(targets) != len(texts):
            return [one(text) for text in texts]
        return [(t, REFUSED if t is None else DONE) for t in targets]

    def batches(received: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began, sent = time.monotonic(), 0
        most = None if rate is None else max(1, int(rate))
        for batch in received:
            for texts in portions(batch.column(0), most):
                if rate is not None:
                    time.sleep(max(0.0, began + sent / rate - time.monotonic()))
                    sent += len(texts)
                target, status = zip(*answered(texts))
                columns = [pa.array(c, pa.string(), from_pandas=True) for c in (texts, target, status)]
                yield pa.RecordBatch.from_arrays(columns, ["source", "target", "status"])

    ship_package(sources.sparkSession)
    dealt = sources.repartition("source") if tasks is None else sources.repartition(tasks, "source")
    return dealt.mapInArrow(batches, "source string, target string, status string")


class TranslationMemory:
    """Translations on disk: each text is asked for once, whatever the number of runs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _answers(self) -> DataFrame:
        schema = "source string, target string, status string"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def table(self) -> DataFrame:
        """``(source, target)`` of all texts that were translated."""
        return self._answers().where(F.col("status") == DONE).select("source", "target")

    def unknown(self, texts: DataFrame, text: str = "text") -> DataFrame:
        """The texts without a final answer, each once."""
        final = self._answers().where(F.col("status") != AGAIN).select(F.xxhash64("source").alias("_hash"), F.col("source").alias("_known"))
        wanted = distinct_texts(texts, text).withColumn("_hash", F.xxhash64("source"))
        # Joined by a hash and compared, since texts may be long.
        return wanted.join(final, (wanted["_hash"] == final["_hash"]) & (wanted["source"] == final["_known"]), "left_anti").select("source")

    def learn(
        self, texts: DataFrame, translator: Translator, text: str = "text", tasks: int | None = None, rate: float | None = None
    ) -> None:
        """Ask for what is unknown and append the answers; those that may succeed another time are not kept."""
        # Answers are stored apart first, so that a task that is repeated while they are appended calls nothing again.
        with freeing(self.spark):
            given = store(call_translator(self.unknown(texts, text), translator, tasks, rate), "translations")
            given.where(F.col("status") != AGAIN).write.mode("append").parquet(self.path)


def translations(
    texts: DataFrame, translator: Translator | DataFrame, text: str = "text", tasks: int | None = None
) -> DataFrame:
    """``(source, target)`` from a callable or a translation table.

    What a callable gives is stored, so that a repeated task calls it no second time.
    """
    if isinstance(translator, DataFrame):
        return translator.select("source", "target").groupBy("source").agg(F.min("target").alias("target"))
    return store(call_translator(distinct_texts(texts, text), translator, tasks), "translations").select("source", "target")


def translate_columns(
    texts: DataFrame, translator: Translator | DataFrame, text: str = "text", tasks: int | None = None
) -> DataFrame:
    """Add ``<text>_translated`` and ``<text>_error`` right after the text.

    Missing and blank texts pass through. A failure keeps the text and is
    marked ``error``. Texts are joined by a hash and compared, and those that
    need no translation stay out of the join.
    """
    known = translations(texts, translator, text, tasks).withColumn("_hash", F.xxhash64("source"))
    needed = F.coalesce(_has_text(F.col(text)), F.lit(False))
    failed = needed & F.col("target").isNull()
    before = texts.columns[: texts.columns.index(text) + 1]
    after = texts.columns[len(before):]
    hashed = texts.where(needed).withColumn("_hash", F.xxhash64(text)).alias("t")
    same = (F.col("t._hash") == F.col("k._hash")) & (F.col(f"t.{text}") == F.col("k.source"))
    looked_up = hashed.join(known.alias("k"), same, "left").select("t.*", "k.target").drop("_hash")
    rest = texts.where(~needed).withColumn("target", F.lit(None).cast("string"))
    return looked_up.unionByName(rest).select(
        *before,
        F.coalesce("target", text).alias(f"{text}_translated"),
        F.when(failed, ERROR).alias(f"{text}_error"),
        *after,
    )


def translate_replace(
    texts: DataFrame, translator: Translator | DataFrame, text: str = "text", tasks: int | None = None
) -> DataFrame:
    """The text replaced by its translation where there is one."""
    return (
        translate_columns(texts, translator, text, tasks)
        .withColumn(text, F.col(f"{text}_translated"))
        .select(*texts.columns)
    )
