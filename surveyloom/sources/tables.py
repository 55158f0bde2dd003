"""Result and canonical tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.session import freeing, store


def write_tables(
    frame: DataFrame, path: str, format: str = "parquet", by: str = "survey_id", **options: str
) -> None:
    """Write partitioned by survey: the surveys in ``frame`` are replaced, all others stay.

    New files wait in a staging folder and take their place when the whole job
    has succeeded, so a failed write leaves the table as it was. Rebalancing
    lets AQE split a survey that holds much of the data over many tasks and
    files, and pack small surveys together.
    """
    (
        frame.hint("rebalance", by)
        .write.mode("overwrite")
        .format(format)
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(by)
        .save(path)
    )


def read_table(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    reader = spark.read.format(format).options(**options)
    if format == "csv":
        reader = reader.option("header", "true")
    return reader.load(path)


BUCKET = "_bucket"


class BucketedTable:
    """A keyed table in folders by a hash of its key, of which a change rewrites only the buckets it touches."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 256):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def bucketed(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int"))

    def write(self, frame: DataFrame) -> None:
        """Put the rows' buckets in place of those stored."""
        write_tables(self.bucketed(frame), self.path, by=BUCKET)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets a change reaches, ``buckets`` numbers at most."""
        return sorted(r[0] for r in self.bucketed(changes).select(BUCKET).distinct().collect())

    def change(self, changes: DataFrame, merge) -> list[int]:
        """Replace each touched bucket by ``merge(its rows, its changes)``; which buckets those were.

        ``changes`` is read twice, so it should be a stored table.
        """
        touched = self.touched(changes)
        if touched:
            stored = self.spark.read.parquet(self.path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            # Stored first: the table is read until the new rows are there.
            with freeing(self.spark):
                self.write(store(merge(stored, changes), "merged"))
        return touched
