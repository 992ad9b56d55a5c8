"""Shuffled sharding by a keyed permutation of row numbers, in native expressions.

Every row has a global number in the order of its key. A Feistel network over a x b numbers,
where a x b is the smallest such rectangle around the row count, is a bijection; numbers that
fall outside the count walk on along their cycle until they are inside. The permuted number p
gives shard `p mod shards` and slot `p div shards`, so shards differ by one row at most, slots
have no gaps, and place_of_row computes any row's place without the data.

Numbering ranges the rows once by key; what is broadcast has one row per range. Equal keys are
spread over ranges by a row id, so a key with a third of all rows is no hot spot.

Cases: NULL keys come first and are numbered like others. Rows that are equal in key and text
are interchangeable. An empty table gives an empty result. NULL text counts as no bytes. Columns
of the input with the name of a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.common import Work, parallelism

ROUNDS = 6
SEED = 20_240
# A rectangle leaves fewer than `a` numbers outside, so up to a = 64 this many steps are always
# enough; above, the chance that a row needs more is below (1 / 64) ** 64. Such a row would stop
# the job, never get a wrong place.
WALK = 64
IN_PART = (1 << 33) - 1


def global_numbers(df: DataFrame, order: list[str], work: Work) -> DataFrame:
    """Add `_number`, 0 to n - 1 without gaps in the given order."""
    tie = F.monotonically_increasing_id()
    ranged = (
        df.withColumn("_tie", tie)
        .repartitionByRange(parallelism(df.sparkSession), *order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_row", F.monotonically_increasing_id())
    )
    written = work.put(ranged, "numbered")
    part = F.shiftright("_row", 33)
    counts = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    return (
        written.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn("_number", F.col("_start") + F.col("_row").bitwiseAND(F.lit(IN_PART)))
        .drop("_part", "_start", "_row")
    )


def rectangle(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def permuted_once(x: Column, n: int, seed: int) -> Column:
    """One pass of the network over the rectangle of n numbers."""
    a, b = rectangle(n)

    def turned(state: Column, at: Column) -> Column:
        def moved(part: str, by: str, size: int) -> Column:
            return F.pmod(state[part] + F.pmod(F.xxhash64(state[by], at, F.lit(seed)), F.lit(size)), F.lit(size))

        left, right = moved("l", "r", a), moved("r", "l", b)
        return F.when(
            at % 2 == 0, F.struct(left.alias("l"), state["r"].alias("r"))
        ).otherwise(F.struct(state["l"].alias("l"), right.alias("r")))

    start = F.struct(
        F.call_function("div", x, F.lit(b).cast("bigint")).alias("l"),
        F.pmod(x, F.lit(b).cast("bigint")).alias("r"),
    )
    return F.aggregate(
        F.array(*(F.lit(i) for i in range(ROUNDS))), start, turned, lambda s: s["l"] * b + s["r"]
    )


def permuted(x: Column, n: int, seed: int = SEED) -> Column:
    """A bijection of the numbers 0 to n - 1, by walking along cycles until inside."""
    size = F.lit(n).cast("bigint")
    first = permuted_once(x, n, seed)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        first,
        lambda y, _: F.when(y < size, y).otherwise(permuted_once(y, n, seed)),
    )
    lost = F.raise_error(F.lit("a row number left its cycle walk outside")).cast("bigint")
    return F.when(walked < size, walked).otherwise(lost)


def place_of_row(number: Column, n: int, shards: int, seed: int = SEED) -> tuple[Column, Column]:
    """Shard and slot of a row number among n."""
    p = permuted(number, n, seed)
    return F.pmod(p, F.lit(shards)).cast("int"), F.call_function("div", p, F.lit(shards)).cast("bigint")


def shard_rows(
    df: DataFrame, order: list[str], shards: int, work: Work, seed: int = SEED
) -> DataFrame:
    """Add shard and slot to every row; rows are numbered in the given order first."""
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    numbered = global_numbers(df.select(*kept), order, work)
    n = numbered.count()
    if not n:
        return df.select(*kept, F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    p = numbered.withColumn("_p", permuted(F.col("_number"), n, seed))
    return p.select(
        *kept,
        F.pmod("_p", F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("_p"), F.lit(shards)).cast("bigint").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int, work: Work, seed: int = SEED) -> DataFrame:
    """Documents as (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    The law is `rows`: counts differ by one at most. Growing by a shard moves rows between all
    shards, so grown_shard is NULL.
    """
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    sized = docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    placed = shard_rows(sized, ["doc_id", "text_crc32", "size"], shards, work, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
