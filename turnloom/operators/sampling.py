"""Seeded sample of a fixed size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions import column
from turnloom.operators.positions import seeded_hash
from turnloom.sources.scratch import pin

# Hex digits of the hash that rows are counted by at a time: at most 65,536 counts.
HASH_DIGITS = 4


def _cut(part: DataFrame, size: int, digits: int) -> tuple[str, int, int, bool] | None:
    """Prefix of _order in which the running row count reaches size, the count before it and its own.

    The last value says whether all its rows have one order. `part` shares all but the last
    HASH_DIGITS digits.
    """
    counts = part.groupBy(F.substring("_order", 1, digits).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), (F.min("_order") == F.max("_order")).alias("alike")
    )
    upto = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counts.withColumn("upto", F.sum("n").over(upto)).filter(F.col("upto") >= size)
    row = reached.orderBy("prefix").select("prefix", F.col("upto") - F.col("n"), "n", "alike").first()
    return tuple(row) if row else None


def _equal_rows(copies: DataFrame, size: int) -> DataFrame:
    """`size` of rows that are equal: whole tasks, then part of one.

    The running count goes over one number per task, never over the rows.
    """
    held = pin(copies.withColumn("_task", F.spark_partition_id()))
    counts = held.groupBy("_task").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .filter(F.col("upto") >= size)
        .orderBy("_task")
        .first()
    )
    before = row["upto"] - row["n"]
    whole = held.filter(F.col("_task") < row["_task"])
    part = held.filter(F.col("_task") == row["_task"]).limit(size - before)
    return whole.unionByName(part).drop("_task")


def _first_rows(edge: DataFrame, size: int, digits: int) -> DataFrame:
    """The first `size` rows in _order of rows that share its first `digits` digits."""
    part, left = edge, size
    while True:
        digits += HASH_DIGITS
        bound, before, held, alike = _cut(part, left, digits)
        left -= before
        part = edge.filter(F.startswith("_order", F.lit(bound)))
        if left == held or alike:
            last = part if left == held else _equal_rows(part, left)
            return edge.filter(F.col("_order") < bound).unionByName(last)


def seeded_sample(
    df: DataFrame,
    size: int | None,
    seed: int,
    *keys: str,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The first `size` rows in seeded order of the keys; all rows where size is None or 0.

    The source is read twice, whatever its size. The first read counts rows per hash prefix, as
    hashes spread rows evenly; it tells the prefix in which the sample ends. The second writes the
    rows up to the end of that prefix, which are the sample and a 65,536th of the table; the
    rest is cut off among these. Rows of one key are ordered by their content, so that a sample
    is repeatable. `watch` may add a metric to the first read, which covers all rows.
    """
    if not size:
        return df
    hashed = df.withColumn("_order", seeded_hash(seed, *keys))
    found = _cut(watch(hashed) if watch else hashed, size, HASH_DIGITS)
    if found is None:
        return df
    bound, before, held, _ = found
    near = pin(hashed.filter(F.substring("_order", 1, HASH_DIGITS) <= bound))
    if size - before == held:
        return near.drop("_order")
    content = F.hex(F.xxhash64(F.to_json(F.struct(*(F.col(column(c)) for c in df.columns)))))
    inside = F.startswith("_order", F.lit(bound))
    edge = near.filter(inside).withColumn("_order", F.concat("_order", F.lpad(content, 16, "0")))
    first = _first_rows(edge, size - before, HASH_DIGITS)
    # A longer hash sorts after its own prefix, so this is all that lies before the edge.
    return near.filter(F.col("_order") < bound).unionByName(first).drop("_order")
