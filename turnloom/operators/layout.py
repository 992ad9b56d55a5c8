"""Sequence layout for training: truncation, packing, batches and the plan summary."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.operators.positions import range_starts, running_starts, seeded_hash
from turnloom.sources.scratch import pin

# The blanks that separate words.
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


def _div(value: Column, size: Column | int) -> Column:
    return F.call_function("div", value, size if isinstance(size, Column) else F.lit(size))


def words(text: Column) -> Column:
    """Blank-separated pieces, the stand-in where no token column is given."""
    return F.array_remove(F.split(text, BLANKS), "")


def truncate(df: DataFrame, tokens: str, max_length: int) -> DataFrame:
    """Cut the token list to max_length; add n_tokens (after the cut) and was_truncated.

    A NULL list stays NULL, and so do both numbers.
    """
    if max_length < 1:
        raise ValueError("max_length must be 1 or more")
    whole = F.when(F.col(tokens).isNotNull(), F.size(tokens))
    return (
        df.withColumn("was_truncated", whole > max_length)
        .withColumn("n_tokens", F.when(whole.isNotNull(), F.least(whole, F.lit(max_length))))
        .withColumn(tokens, F.slice(tokens, 1, max_length))
    )


def pack_layout(
    df: DataFrame, key: str, length: str, pack_size: int, partitions: int | None = None
) -> DataFrame:
    """Where each sequence goes when all are joined in key order and cut every pack_size tokens.

    Gives pack_id, pack_offset, the key, src_offset and piece_len. Only keys and lengths are
    sorted; the tokens stay where they are. Lengths are written down first: they often come
    from the text, which the later passes would otherwise read again and again.
    """
    if pack_size < 1:
        raise ValueError("pack_size must be 1 or more")
    known = F.col(length).cast("bigint")
    wrong = F.raise_error(F.lit(f"{length} is NULL or negative")).cast("bigint")
    checked = F.when(known >= 0, known).otherwise(wrong)
    sized = pin(df.select(key, checked.alias("_length")))
    filled = sized.filter("_length > 0")
    placed = running_starts(filled, "_length", key, "_length", partitions=partitions)
    first, last = F.col("start"), F.col("start") + F.col("_length") - 1
    size = F.lit(pack_size).cast("bigint")

    pieces = placed.withColumn("pack_id", F.explode(F.sequence(_div(first, size), _div(last, size))))
    pack_start = F.col("pack_id") * size
    begin = F.greatest(first, pack_start)
    end = F.least(last + 1, pack_start + size)
    return pieces.select(
        "pack_id",
        (begin - pack_start).alias("pack_offset"),
        key,
        (begin - first).alias("src_offset"),
        (end - begin).alias("piece_len"),
    )


def _cut_lists(size: int, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins the token lists of one range and cuts them at multiples of size in the global order.

    Gives the packs that lie inside the range, or else the pieces at its two ends. Lists are cut by
    their offsets; single tokens are never looked at.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = -1, None

        def edge(values: pa.Array) -> pa.RecordBatch:
            listed = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            numbers = [pa.array([x], pa.int64()) for x in divmod(at, size)]
            return pa.RecordBatch.from_arrays([*numbers, listed], names=["pack_id", "pack_offset", "tokens"])

        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(1).flatten()
            if left is None:
                at = batch.column(0)[0].as_py()
            else:
                values = pa.concat_arrays([left, values])
            head = -at % size
            if len(values) < head:
                left = values
                continue
            if head and not whole:
                yield edge(values[:head])
            packs, at = (len(values) - head) // size, at + head
            if packs and whole:
                ends = pa.array(np.arange(packs + 1, dtype=np.int32) * size)
                full = pa.ListArray.from_arrays(ends, values[head : head + packs * size])
                ids = pa.array(at // size + np.arange(packs))
                yield pa.RecordBatch.from_arrays([ids, full], names=["pack_id", "tokens"])
            at += packs * size
            left = values[head + packs * size :]
        if left is not None and len(left) and not whole:
            yield edge(left)

    return cut


def packed_tokens(
    df: DataFrame, key: str, tokens: str, pack_size: int, partitions: int | None = None
) -> DataFrame:
    """The packs themselves: pack_id and its token list of pack_size tokens, the last one shorter.

    The tokens move once, into ranges of the key, and are written there in order. Ranges know
    where they start from their totals, so each is cut on its own; only the packs that lie across
    the edge of a range are put together from their pieces, two per range. Rows of one key stand
    next to each other, in any order. A NULL list stops the job.
    """
    if pack_size < 1:
        raise ValueError("pack_size must be 1 or more")
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[tokens].dataType
    missing = F.raise_error(F.lit(f"{tokens} is NULL")).cast(kind)
    listed = F.when(F.col(tokens).isNotNull(), F.col(tokens)).otherwise(missing)
    ranged = pin(
        df.select(F.col(key).alias("_key"), listed.alias("_tokens"))
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, "_key", "_tie")
        .sortWithinPartitions("_key", "_tie")
        .select(F.spark_partition_id().alias("_range"), "_tokens")
    )
    totals = pin(ranged.groupBy("_range").agg(F.sum(F.size("_tokens").cast("bigint")).alias("_total")))
    # One row per range, and their number is a parameter.
    starts = F.broadcast(range_starts(totals, [], "_range"))
    rows = ranged.join(starts, "_range").select("_start", "_tokens")
    lists = f"tokens {kind.simpleString()}"
    inside = rows.mapInArrow(_cut_lists(pack_size, True), f"pack_id bigint, {lists}")
    pieces = rows.mapInArrow(_cut_lists(pack_size, False), f"pack_id bigint, pack_offset bigint, {lists}")
    part = F.struct("pack_offset", "tokens")
    across = pieces.groupBy("pack_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(part)), lambda p: p.tokens)).alias("tokens")
    )
    return inside.unionByName(across)


def assign_batches(
    df: DataFrame,
    key: str,
    seed: int,
    batch_size: int,
    epochs: int = 1,
    accumulation: int = 1,
    devices: int = 1,
) -> DataFrame:
    """Seeded order per epoch: epoch, the key, pos, batch and optimiser step, all from 0.

    Only the key is ordered; join the result to the samples where their text is needed. Rows of
    one key have a place each and stand next to each other.
    """
    if min(epochs, batch_size, accumulation, devices) < 1:
        raise ValueError("epochs, batch_size, accumulation and devices must be 1 or more")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    spread = df.select(key, numbers)
    seeded = F.concat(F.lit(f"{seed}:"), F.col("epoch").cast("string"))
    hashed = spread.withColumn("_digest", seeded_hash(seeded, key))
    counted = hashed.withColumn("_one", F.lit(1).cast("bigint"))
    placed = running_starts(counted, "_one", "_digest", key, group="epoch").withColumnRenamed("start", "pos")
    per_step = batch_size * accumulation * devices
    return placed.select(
        "epoch",
        key,
        "pos",
        _div(F.col("pos"), batch_size).alias("batch"),
        _div(F.col("pos"), per_step).alias("step"),
    )


def write_batches(batches: DataFrame, path: str) -> None:
    """One folder per epoch; each file holds a run of neighbouring steps."""
    (
        batches.repartitionByRange("epoch", "pos")
        .sortWithinPartitions("epoch", "pos")
        .write.mode("overwrite")
        .partitionBy("epoch")
        .parquet(path)
    )


def write_bucketed(
    df: DataFrame, table: str, path: str, by: Sequence[str], order: Sequence[str], buckets: int
) -> DataFrame:
    """Store the rows as a table of one file per bucket of `by`, sorted by `order`; gives the table.

    Tables with the same buckets join and group by them where they lie, without a shuffle. The
    number of buckets should grow with the data: a bucket is read by one task.
    """
    if buckets < 1:
        raise ValueError("buckets must be 1 or more")
    (
        df.repartition(buckets, *by)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *by)
        .sortBy(*order)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def write_steps(
    samples: DataFrame, batches: DataFrame, key: str, table: str, path: str, buckets: int
) -> DataFrame:
    """The samples of every batch, stored by epoch and step in the order of training.

    Samples and batches stored by `write_bucketed` with the same buckets of the key are joined
    without a shuffle; then each sample moves once per epoch, into the bucket of its step. Keys
    name samples: a key that several samples share gives each of them at each of its places.
    """
    clash = sorted({"epoch", "pos", "batch", "step"} & set(samples.columns))
    if clash:
        raise ValueError(f"samples have columns that batches need: {', '.join(clash)}")
    # A merge join reads the buckets as they are; sides of any size fit.
    joined = batches.hint("merge").join(samples, key)
    return write_bucketed(joined, table, path, ["epoch", "step"], ["epoch", "step", "pos"], buckets)


def train_plan(
    df: DataFrame, batch_size: int, epochs: int = 1, accumulation: int = 1, devices: int = 1
) -> DataFrame:
    """One row: n_rows, batches_per_epoch, steps_per_epoch, total_steps, last_batch."""
    per_step = batch_size * accumulation * devices

    rows = F.col("n_rows")
    steps = _div(rows + (per_step - 1), per_step)
    remainder = rows % batch_size
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        _div(rows + (batch_size - 1), batch_size).alias("batches_per_epoch"),
        steps.alias("steps_per_epoch"),
        (steps * epochs).alias("total_steps"),
        F.when((remainder == 0) & (rows > 0), batch_size).otherwise(remainder).alias("last_batch"),
    )
