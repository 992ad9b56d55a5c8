"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Only lengths decide a packing, and a length is a number from 1 to the capacity. So the plan is
made on the histogram of lengths, which has `capacity` rows however many documents there are:
large items are matched in pairs, smaller ones fill the tightest gaps, always many equal bins at
a time. Rows then find their place by their rank among the rows of their length. No key, source
or copy group is ever gathered; a rank is counted inside one written part and shifted by the
count of the parts before it.

Cases: a NULL or empty text has the closing id only and is packed like any other. Equal rows are
separate items. An empty table gives an empty result. Other columns than the key are left out, so
that their names cannot clash. A length below 1 or above the capacity stops the job.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.llm.common import CLEARED_AFTER_TASKS, Work, spread, text_chunks
from turnloom.llm.words import LOWER, join_texts, prefix_hash, range_hash

CAPACITY = 4096
CLOSING_ID = 1
# Remembered pieces per worker; an entry takes ENTRY_BYTES beside its ids.
MEMO_BYTES, ENTRY_BYTES = 12 << 20, 16
# More text at a time repeats more pieces, which are looked up once each; the arrays over the
# pieces take some 60 bytes per byte of text.
TOKENIZED_BYTES = 1_000_000

# Classes of bytes in plain text: white space, letters, digits, other signs.
SPACES, LETTER, DIGIT, SIGN, ODD = range(5)
CLASS = np.full(128, SIGN, np.uint8)
CLASS[:33] = ODD
CLASS[[9, 10, 13, 32]] = SPACES
CLASS[127] = ODD
CLASS[48:58] = DIGIT
CLASS[65:91] = CLASS[97:123] = LETTER


def plain_classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte; two-byte Latin letters count, any other character is ODD."""
    kind = np.full(len(data), ODD, np.uint8)
    low = data < 128
    kind[low] = CLASS[data[low]]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    after = data[lead + 1]
    lead = lead[(after >= 0x80) & (after != 0x97) & (after != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    return kind


def lowered(data: np.ndarray) -> np.ndarray:
    data = LOWER[data]
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
    data[capital] += 0x20
    return data


def piece_bounds(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokenizer's pieces start and end in lower-cased plain text.

    Pieces are runs of letters, runs of signs and single digits; an apostrophe that does not
    follow a sign takes the ending s, t, m, d, re, ve or ll with it.
    """
    start = np.ones(len(data), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    quote = np.flatnonzero((data == 39) & start)
    one = data[np.minimum(quote + 1, len(data) - 1)]
    two = data[np.minimum(quote + 2, len(data) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    for ending, size in ((short, 2), (long & ~short, 3)):
        at = quote[ending]
        start[at + 1] = False
        start[at + size] = True
    first = np.flatnonzero(start)
    end = np.append(first[1:], len(data))
    inside = kind[first] != SPACES
    return first[inside], end[inside]


class PieceIds:
    """Token ids of pieces, remembered up to a fixed number of bytes.

    The tokenizer cuts text into pieces before it merges anything, so a text's ids are the ids of
    its pieces in order. In plain text (ASCII and Latin letters, no special token) the pieces
    are found for all texts at once; any other text goes to the tokenizer as it is.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        # hashes of pieces, sorted, and where the ids of each lie in the pool
        self.known = np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, "<u4")

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has."""
        ids, counts = [], []
        for at in range(0, len(pieces), 2000):
            some = pieces[at : at + 2000]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids.append(np.array(found.ids, "<u4"))
            counts.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
        return np.concatenate(ids), np.concatenate(counts).astype(np.int32)

    def _learn(self, at: np.ndarray, keys: np.ndarray, pieces: list[str]) -> None:
        """Remember new pieces, whose hashes belong before the known ones `at`."""
        ids, count = self._ids_of(pieces)
        first = (len(self.pool) + np.cumsum(count) - count).astype(np.int32)
        self.known = np.insert(self.known, at, keys)
        self.first, self.count = np.insert(self.first, at, first), np.insert(self.count, at, count)
        self.pool = np.concatenate([self.pool, ids])

    def _plain_ids(self, data: np.ndarray, kind: np.ndarray, offset: np.ndarray) -> tuple:
        first, end = piece_bounds(data, kind)
        hashes = range_hash(prefix_hash(data), first, end)
        keys, sample, each = np.unique(hashes, return_index=True, return_inverse=True)
        # Only before a chunk is looked up: all of its pieces have to stay known.
        if ENTRY_BYTES * len(self.known) + self.pool.nbytes > MEMO_BYTES:
            self._forget()
        at = np.searchsorted(self.known, keys)
        new = at == len(self.known)
        new[~new] = self.known[at[~new]] != keys[~new]
        if new.any():
            raw, some = data.tobytes(), sample[new]
            bounds = zip(first[some].tolist(), end[some].tolist())
            self._learn(at[new], keys[new], [raw[x:y].decode() for x, y in bounds])
            at = np.searchsorted(self.known, keys)
        lengths = self.count[at].astype(np.int64)
        of_piece = lengths[each]
        ids = self.pool[spread(self.first[at].astype(np.int64)[each], of_piece)]
        text = np.searchsorted(offset, first, "right") - 1
        return ids, np.bincount(text, of_piece, len(offset) - 1).astype(np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with the closing id, and each one's length."""
        data, offset = join_texts(texts)
        kind = plain_classes(data)
        odd = np.add.reduceat(kind == ODD, offset[:-1]) > 0
        special = np.fromiter((b"<|" in t for t in texts), bool, len(texts))
        plain = ~(odd | special)
        some = [t for t, p in zip(texts, plain) if p]
        if len(some) < len(texts):
            data, offset = join_texts(some)
            kind = plain_classes(data)
        ids, sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        if some:
            ids, sizes = self._plain_ids(lowered(data), kind, offset)
        if len(some) < len(texts):
            parts = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(some) else [])
            lists = [
                next(parts)
                if p
                else np.array(
                    self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, "<u4"
                )
                for t, p in zip(texts, plain)
            ]
            ids, sizes = np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
        closed = np.full(len(ids) + len(texts), CLOSING_ID, "<u4")
        closed[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), sizes)] = ids
        return closed, sizes + 1


@lru_cache(maxsize=2)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


CLEARED_AFTER_TASKS.append(piece_ids.cache_clear)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(
    docs: DataFrame, key: str, text: str, path: str, capacity: int = CAPACITY
) -> DataFrame:
    """Cut every text's ids into pieces: key, piece, start, length, ids (little-endian uint32)."""
    key_type = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_ids(path)
        for batch, texts in text_chunks(batches, "_text", TOKENIZED_BYTES):
            ids, sizes = encoder.encode(texts)
            counts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(texts)), counts)
            piece = spread(np.zeros(len(texts), np.int64), counts)
            start = piece * capacity
            length = np.minimum(capacity, sizes[row] - start)
            ends = 4 * np.cumsum(length)
            raw = ids.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array([raw[e - 4 * n : e] for e, n in zip(ends, length)], pa.binary()),
                ],
                names=schema.names,
            )

    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(cut, schema)


# --- the plan on the histogram ---------------------------------------------------------------


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list]]:
    """Groups of equal bins: how many, and their entries (length, times).

    Lengths above a third of the capacity go in pairs at most: the longest first, each with the
    longest one that still fits. Shorter lengths, longest first, go to the tightest gap that
    takes them, and to new bins where none does.
    """
    third = capacity // 3
    left = {n: c for n, c in counts.items() if n > third and c}
    lengths = sorted(left)
    gaps: dict[int, list] = {}

    def add(gap: int, bins: int, entries: list) -> None:
        if bins:
            gaps.setdefault(gap, []).append((bins, entries))

    while lengths:
        a = lengths[-1]
        at = bisect_right(lengths, capacity - a) - 1
        if at < 0:
            add(capacity - a, left[a], [(a, 1)])
            lengths.pop()
            continue
        b = lengths[at]
        if a == b:
            add(capacity - 2 * a, left[a] // 2, [(a, 2)])
            add(capacity - a, left[a] % 2, [(a, 1)])
            lengths.pop()
            continue
        pairs = min(left[a], left[b])
        add(capacity - a - b, pairs, [(a, 1), (b, 1)])
        for n in (a, b):
            left[n] -= pairs
            if not left[n]:
                lengths.remove(n)

    for n in sorted((n for n in counts if n <= third), reverse=True):
        count = counts[n]
        for gap in sorted(g for g in gaps if g >= n):
            if not count:
                break
            times, waiting = gap // n, gaps.pop(gap)
            for bins, entries in waiting:
                full = min(bins, count // times)
                add(gap - n * times, full, [*entries, (n, times)])
                count -= full * times
                bins -= full
                if bins and count:  # fewer than `times` are left: one more bin takes them
                    add(gap - n * count, 1, [*entries, (n, count)])
                    bins, count = bins - 1, 0
                add(gap, bins, entries)
        times = capacity // n
        add(capacity - n * times, count // times, [(n, times)])
        add(capacity - n * (count % times), int(count % times > 0), [(n, count % times)])
    return [group for _, groups in sorted(gaps.items()) for group in groups]


def plan_slots(bins: list[tuple[int, list]]) -> np.ndarray:
    """Places by (length, first rank): length, rank, times, sequence, offset; sorted.

    The row of rank r among those of its length lies, with q = r - rank, in sequence
    `sequence + q // times` at `offset + (q % times) * length`.
    """
    rows, used, sequence = [], {}, 0
    for count, entries in bins:
        offset = 0
        for n, times in entries:
            rows.append((n, used.get(n, 0), times, sequence, offset))
            used[n] = used.get(n, 0) + count * times
            offset += n * times
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def best_fit(
    items: DataFrame, length: str, order: list[str], work: Work, capacity: int = CAPACITY
) -> DataFrame:
    """Add sequence_id and offset to every item; `order` columns order equal lengths.

    The items are written once, with the number of the part they are in. What is broadcast is
    the list of places, a few per possible length: its size follows from the capacity alone.
    """
    size = F.col(length)
    wrong = F.raise_error(F.lit(f"{length} must be from 1 to {capacity}")).cast("bigint")
    checked = F.when(size.between(1, capacity), size.cast("bigint")).otherwise(wrong)
    parts = work.put(
        items.withColumn("_part", F.spark_partition_id()).withColumn("_size", checked), "items"
    )
    by_part = parts.groupBy("_size", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    totals = by_part.groupBy("_size").agg(F.sum("_rows").alias("n")).collect()
    slots = plan_slots(plan_bins({r["_size"]: r["n"] for r in totals}, capacity))
    step = 1 << 44
    places = items.sparkSession.sparkContext.broadcast((slots[:, 0] * step + slots[:, 1], slots))

    earlier = (
        Window.partitionBy("_size")
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = by_part.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    inside = Window.partitionBy("_size", "_part").orderBy(*order)
    ranked = (
        parts.withColumn("_rank", F.row_number().over(inside).cast("bigint") - 1)
        .join(shifts.drop("_rows"), ["_size", "_part"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_before", "_part")
    )

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        keys, rows = places.value
        n, rank = sizes.to_numpy(np.int64), ranks.to_numpy(np.int64)
        slot = rows[np.searchsorted(keys, n * step + rank, "right") - 1]
        q = rank - slot[:, 1]
        return pd.DataFrame(
            {
                "sequence_id": slot[:, 3] + q // slot[:, 2],
                "offset": slot[:, 4] + q % slot[:, 2] * n,
            }
        )

    kept = [c for c in items.columns if c not in ("sequence_id", "offset")]
    placed = ranked.withColumn("_place", place("_size", "_rank"))
    return placed.select(*kept, "_place.sequence_id", "_place.offset")


def pack_documents(
    docs: DataFrame, key: str, text: str, path: str, work: Work, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents with their crc32 and place, without the ids themselves."""
    pieces = token_pieces(docs, key, text, path, capacity)
    sized = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return best_fit(sized, "length", [key, "piece"], work, capacity)
