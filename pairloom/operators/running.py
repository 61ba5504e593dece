"""Running totals without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import settle


def running_total(
    frame: DataFrame,
    value: str,
    order: Sequence[Column],
    group: Sequence[str] = (),
    out_col: str = "before",
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the group, or of the table.

    Rows are range-partitioned by group and order, so that a group of any size
    spreads over as many tasks as it fills.  Each partition gives one total
    per group it holds; their running sums, at most one row per partition for
    each group, are the partitions' offsets.  The partition number is written
    with the rows, so a retried task cannot move a row elsewhere.

    Pass a narrow table: everything in it is shuffled and written once.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group]
    ranged = frame.repartitionByRange(parts, *keys, *order).withColumn("part", F.spark_partition_id())
    placed, _ = settle(ranged, "ranged")
    totals = placed.groupBy("part", *group).agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(frame.schema[value].dataType)
    offsets = totals.select(
        "part", *group, F.coalesce(F.sum("total").over(earlier), zero).alias("offset")
    )
    inside = Window.partitionBy("part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("inside", F.coalesce(F.sum(value).over(inside), zero))
    joined = local.join(offsets, ["part", *group])
    return joined.withColumn(out_col, F.col("offset") + F.col("inside")).drop("part", "offset", "inside")
