"""What each filter removes in every order of the filters, counted in one pass.

A document is reduced to the set of filters it fails, its mask. In a fixed order of the filters a
mask decides the outcome of every step, so each mask (with the document's labels) has one wide
integer: a field of FIELD_BITS bits for every outcome, order and step, 600 steps for five
filters. Adding the integers of all documents of a part counts all fields at once. A field holds
more than any table has rows, so no field runs over into the next one, and the sum is unpacked
by cutting it into fields.

The plan: one narrow row per document (hash of the text, mask of the filters that look at one
document, part); rows with labels are counted per text, part and labels with map-side combine, so
that copies of one text, however many, travel as a few rows. Whether a text was seen before needs
the smallest key of its copies alone. Counts times integers are added per task, and the tasks'
sums in a tree of TREE branches, so that no task reads more than that many sums at a time.

Cases: a NULL text is the empty text, a NULL part the part ''. Repeated rows count each; rows that
share text and key are no copies of each other. Rows with a NULL key are never copies and make
none. Repeated labels: the largest counts. An empty table gives no rows. The result's columns are
its own; other columns of the input are left out, so that their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.common import Work, text_chunks, text_or_empty

FILTERS = "ABCDE"
COPY = 4  # the bit of the filter that looks at other documents
KINDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BITS = 64  # one unsigned number of numpy each
TREE = 64
WORDS_AT_ONCE = 4_000_000

LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 3
# Characters that no kept document holds.
MARKS = b"#$%&*|"
UPPER = bytes(range(65, 91))
INSIDE = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that do not begin a character
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words; a long text is split in slices, cut between words."""
    total, seen, at = 0, set(), 0
    while at < len(text):
        blank = BLANK.search(text, at + WORDS_AT_ONCE)
        end = blank.start() if blank else len(text)
        words = text[at:end].split()
        total += len(words)
        seen.update(words)
        at = end
    return total, len(seen)


def own_mask(text: bytes) -> int:
    """Bits of the filters A to D that the text fails by itself."""
    words, distinct = word_counts(text)
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, INSIDE))
    return (
        (words < LEAST_WORDS)
        | (100 * distinct < DISTINCT_PERCENT * words) << 1
        | (100 * upper > UPPER_PERCENT * points) << 2
        | (len(text.translate(None, MARKS)) < len(text)) << 3
    )


@lru_cache(maxsize=1)
def orders() -> list[str]:
    return ["".join(p) for p in permutations(FILTERS)]


@lru_cache(maxsize=1 << (len(FILTERS) + 2))
def wide(mask: int, good: bool, toxic: bool) -> int:
    """The integer of one document: ones in the fields of its outcomes, by kind, order and step."""
    fields: list[bool] = []
    for kind in KINDS:
        for order in orders():
            gone = False
            for name in order:
                fails = bool(mask >> FILTERS.index(name) & 1)
                now = fails and not gone
                fields.append(
                    {
                        "kept": not (gone or fails),
                        "removed": now,
                        "redundant": fails and gone,
                        "unique_fails": fails and mask.bit_count() == 1,
                        "good_lost": now and good,
                        "toxic_lost": now and toxic,
                    }[kind]
                )
                gone = gone or fails
    return int.from_bytes(np.array(fields, "<u8").tobytes(), "little")


def n_fields() -> int:
    return len(KINDS) * len(orders()) * len(FILTERS)


def packed(value: int) -> bytes:
    return value.to_bytes(n_fields() * FIELD_BITS // 8, "little")


def unpacked(value: bytes) -> np.ndarray:
    """Counts by kind, order and step."""
    return np.frombuffer(value, "<u8").astype(np.int64).reshape(len(KINDS), len(orders()), len(FILTERS))


def document_masks(docs: DataFrame, key: str, text: str, part: Column) -> DataFrame:
    """key, part, hash of the text and mask of A to D, one narrow row per document."""

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    pa.array([own_mask(t) for t in texts], pa.int32()),
                ],
                names=["id", "part", "hash", "mask"],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(
        F.col(key).alias("id"), F.coalesce(part, F.lit("")).alias("part"), text_or_empty(text).alias("_text")
    )
    return narrow.mapInArrow(masks, f"id {kind}, part string, hash binary, mask int")


def counted_masks(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """part, mask, good, toxic and the number n of such documents, the copy filter included."""
    flags = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    # Rows of one document first: repeated ones join the labels once.
    once = rows.groupBy("id", "part", "hash", "mask").agg(F.count(F.lit(1)).alias("n"))
    flagged = once.join(flags, "id", "left").fillna(False, ["good", "toxic"])
    alike = flagged.groupBy("hash", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min_by(F.struct("id", "n"), "id").alias("first"),
    )
    # Of each text there are at most four rows per part here.
    smallest = F.min("first.id").over(Window.partitionBy("hash"))
    told = alike.withColumn("smallest", smallest)
    fresh = F.col("unnamed") + F.when(
        F.col("first.id") == F.col("smallest"), F.col("first.n")
    ).otherwise(0)
    both = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), fresh.alias("n")),
            F.struct((F.col("mask") + (1 << COPY)).alias("mask"), (F.col("n") - fresh).alias("n")),
        )
    )
    split = told.select("part", "good", "toxic", both.alias("one"))
    return split.select("part", "good", "toxic", "one.mask", "one.n").filter("n > 0")


def summed(counts: DataFrame, work: Work) -> DataFrame:
    """One wide integer per part: per task first, then in a tree of TREE branches."""
    schema = "part string, total binary, branch bigint"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for batch in batches:
            alike: Counter[tuple] = Counter()
            columns = [column.to_pylist() for column in batch.columns]
            for part, good, toxic, mask, n in zip(*columns):
                alike[part, mask, good, toxic] += n
            for (part, *document), n in alike.items():
                totals[part] = totals.get(part, 0) + n * wide(*document)
        if totals:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(totals), pa.string()),
                    pa.array([packed(t) for t in totals.values()], pa.binary()),
                    pa.array([0] * len(totals), pa.int64()),
                ],
                names=["part", "total", "branch"],
            )

    def join(group: pa.Table) -> pa.Table:
        total = sum(int.from_bytes(v.as_py(), "little") for v in group.column("total"))
        return pa.table(
            {
                "part": pa.array([group.column("part")[0].as_py()], pa.string()),
                "total": pa.array([packed(total)], pa.binary()),
                "branch": pa.array([group.column("branch")[0].as_py()], pa.int64()),
            }
        )

    sums = counts.mapInArrow(add, schema).withColumn("branch", F.spark_partition_id().cast("bigint"))
    sums = work.put(sums, "sums")
    while True:
        most = sums.agg(F.max("branch")).first()[0]
        if not most:
            return sums.select("part", "total")
        sums = sums.withColumn("branch", F.floor(F.col("branch") / TREE))
        sums = work.put(sums.groupBy("part", "branch").applyInArrow(join, schema), "sums")


def audit_filters(
    docs: DataFrame, labels: DataFrame, work: Work, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """part, filter_order, step and the counts of KINDS and shapley, one row for each."""
    rows = document_masks(docs, key, text, F.col(part).cast("string"))
    counts = work.put(counted_masks(rows, labels, key), "masks")
    schema = "part string, filter_order string, step int, " + ", ".join(
        f"{name} bigint" for name in (*KINDS, "shapley")
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = len(FILTERS)
        for batch in batches:
            for name, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fields = unpacked(total)
                letters = np.array([[FILTERS.index(c) for c in order] for order in orders()])
                removed = np.zeros(steps, np.int64)
                np.add.at(removed, letters, fields[KINDS.index("removed")])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (len(orders()) * steps), pa.string()),
                        pa.array(np.repeat(orders(), steps), pa.string()),
                        pa.array(np.tile(np.arange(1, steps + 1), len(orders())), pa.int32()),
                        *(pa.array(fields[i].ravel()) for i in range(len(KINDS))),
                        pa.array(removed[letters.ravel()]),
                    ],
                    names=["part", "filter_order", "step", *KINDS, "shapley"],
                )

    return summed(counts, work).mapInArrow(unpack, schema)
