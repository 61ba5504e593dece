"""Reading document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


SPREAD = "spark.pairloom.read.partitions"


def read_texts(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A table with work-heavy text columns, read where it lies.

    ``partitions``, or else the session setting ``spark.pairloom.read.partitions``,
    spreads the rows over so many tasks by a shuffle.  That is for small files of
    a single row group, which no two tasks can share; neither is set by default.
    """
    frame = read_table(spark, path)
    wanted = partitions or int(spark.conf.get(SPREAD, "0"))
    return frame.repartition(wanted) if wanted else frame
