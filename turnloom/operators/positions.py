"""Global positions without a window over the whole table.

The rows are split into ordered ranges, one small total is taken per range, and the rows are
numbered inside each range. The number of ranges is a parameter and never set by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.sources.scratch import pin

# Range totals are broadcast up to this many rows (a few MB), joined by shuffle beyond.
BROADCAST_TOTALS = 1 << 18


def seeded_hash(seed: Column | str | int, *keys: str) -> Column:
    """md5 of `seed:key[:key..]` as hex text; its order is the seeded random order.

    A NULL key hashes like the empty text, so that its row keeps its place.
    """
    parts = [seed if isinstance(seed, Column) else F.lit(str(seed))]
    for key in keys:
        parts += [F.lit(":"), F.coalesce(F.col(key).cast("string"), F.lit(""))]
    return F.md5(F.concat(*parts))


def range_starts(totals: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """Add `_start`, the sum of `_total` of all buckets before."""
    before = (
        Window.partitionBy(*group)
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0)))


def running_starts(
    df: DataFrame,
    value: str,
    *order: str,
    group: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add `start`, the exclusive running sum of `value` in the given order, per `group`.

    Ranges of the order columns are split by a sample, so the ranged rows are written to the
    checkpoint folder once and every later step reads the same ranges. Ties are spread by row
    id: equal rows may land in several ranges, and any order among them is right.
    """
    spark = df.sparkSession
    by = [group] if group else []
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = [*by, *order, "_tie"]
    ranged = pin(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *ordered)
        .withColumn("_range", F.spark_partition_id())
    )
    # One row per range, and one more for each group that begins inside a range.
    totals = pin(ranged.groupBy("_range", *by).agg(F.sum(value).alias("_total")))
    starts = range_starts(totals, by, "_range").drop("_total")
    if totals.count() <= BROADCAST_TOTALS:
        starts = F.broadcast(starts)
    inside = (
        Window.partitionBy("_range", *by)
        .orderBy(*order, "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranged.repartitionById(parts, "_range")
        .withColumn("_upto", F.sum(value).over(inside))
        .join(starts, ["_range", *by])
        .withColumn("start", F.col("_start") + F.col("_upto") - F.col(value))
        .select(*df.columns, "start")
    )
