"""Exact removal of long byte strings that also start in an earlier document.

Every string of `length` bytes holds a 20-byte gram whose hash is the smallest of its grams. These
grams are the anchors: equal strings have equal anchors at the same place, so it is enough to
sort the suffixes that begin at anchors, one in sixteen. The steps:

1. Documents are written as compressed blocks of a few MB, with a sample of 8-byte beginnings
   of suffixes. Quantiles of the sample are the splitters.
2. Blocks send the hashes of their anchors to hash buckets, which answer with a bit for each:
   does the anchor occur in two documents? Only such anchors go on.
3. Blocks send the suffixes of these anchors, `length` bytes each and the bytes before the
   anchor, once per distinct context, to the range of their leading bytes. A splitter that
   fills several ranges spreads its suffixes by the hash of the whole anchor.
4. A range sorts its suffixes by multikey sort, eight bytes at a time, and its left contexts
   alike. Common prefixes of neighbours give, for each window around an anchor, the group of
   equal strings and its first document. The answer is the leftmost and rightmost window of a
   context that an earlier document holds.
5. Blocks remove the union of these windows.

No window is lost at a range's boundary: all suffixes that share an anchor are in one range.
Copies of a document or passage are one context per block, so a group with a third of all rows
sends one row per block. The number of buckets grows with the bytes of the table.

Cases: NULL text is empty. Equal ids are not earlier than each other; a NULL id is later than
all others. Matches never cross documents. An empty table gives an empty result. Other columns
than the key are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import (
    Work,
    group_starts,
    lean,
    mixed,
    pack_arrays,
    parallelism,
    spread,
    text_chunks,
    text_or_empty,
    unpack_arrays,
)
from turnloom.llm.words import join_texts, prefix_hash, range_hash

LENGTH = 50
GRAM = 20
BYTES_PER_BUCKET, BLOCK_BYTES = 64 << 20, 2_000_000
# Arrays over positions and contexts are made for so many at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 18, 1 << 13
SAMPLE_EVERY = 4096
LAST = np.iinfo(np.int64).max
U = np.uint64
BLOCK = "block bigint, n_bytes bigint, sample array<bigint>, payload binary"


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of each `width` neighbours, in a logarithmic number of passes."""
    span = 1
    while span < width:
        step = min(span, width - span)
        values = best(values[:-step], values[step:])
        span += step
    return values


def anchors(
    data: np.ndarray, offset: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, document and hash of the anchors of all texts, found in slices of the data."""
    width = length - GRAM + 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    grams = len(data) - GRAM + 1 if len(data) >= length else 0
    pad = np.zeros(width - 1, np.uint64)
    for begin in range(0, grams, SLICE_BYTES):
        end = min(grams, begin + SLICE_BYTES)
        # All windows that hold a gram of the slice lie between low and high.
        low, high = max(0, begin - width + 1), min(grams, end + width - 1)
        first = np.arange(high - low)
        hashes = range_hash(prefix_hash(data[low : high + GRAM - 1]), first, first + GRAM)
        least = _sliding(hashes, width, np.minimum)
        chosen = hashes == _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
        at = begin - low + np.flatnonzero(chosen[begin - low : end - low])
        found.append((low + at, hashes[at]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    at, hashes = (np.concatenate(x) for x in zip(*found))
    doc = np.searchsorted(offset, at, "right") - 1
    inside = at + GRAM <= offset[doc + 1] - 1
    return at[inside], doc[inside], hashes[inside]


class Block:
    """The documents of one block and their anchors."""

    def __init__(self, payload: bytes, length: int) -> None:
        self.ids, sizes, self.data = unpack_arrays(payload)
        self.offset = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.length = length
        self.at, self.doc, self.hash = anchors(self.data, self.offset, length)

    def hashes(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes by bucket, their buckets, whether two documents here hold
        them, and the place of each anchor in that list."""
        value, place = np.unique(self.hash, return_inverse=True)
        bucket = (mixed(value) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        low, high = np.full(len(value), LAST), np.full(len(value), -LAST)
        np.minimum.at(low, place, self.ids[self.doc])
        np.maximum.at(high, place, self.ids[self.doc])
        return value[order], bucket[order], (high > low)[order], rank[place]

    def keep_shared(self, buckets: int, masks: list[tuple[int, bytes]]) -> None:
        value, bucket, _, place = self.hashes(buckets)
        shared = np.zeros(len(value), bool)
        for b, mask in masks:
            first, end = np.searchsorted(bucket, [b, b + 1])
            shared[first:end] = np.unpackbits(np.frombuffer(mask, np.uint8), count=end - first)
        kept = shared[place]
        self.at, self.doc, self.hash = self.at[kept], self.doc[kept], self.hash[kept]

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct contexts, each one's anchor hash and first id, and each anchor's context.

        A context is a row of bytes: how many bytes of the document lie before and from the
        anchor, at most what a window reaches, then the bytes before it, nearest first, then
        the suffix.
        """
        before = self.length - GRAM
        left = np.minimum(self.at - self.offset[self.doc], before)
        right = np.minimum(self.offset[self.doc + 1] - 1 - self.at, self.length)
        steps = np.concatenate([-1 - np.arange(before), np.arange(self.length)])
        width = self.length + before + 2
        parts, firsts, places, total = [np.zeros((0, width), np.uint8)], [], [], 0
        for begin in range(0, len(self.at), SLICE_ROWS):
            some = slice(begin, begin + SLICE_ROWS)
            rows = self.data[np.clip(self.at[some, None] + steps, 0, len(self.data) - 1)]
            rows[:, :before][np.arange(before) >= left[some, None]] = 0
            rows[:, before:][np.arange(self.length) >= right[some, None]] = 0
            full = np.empty((len(rows), width), np.uint8)
            full[:, 0], full[:, 1], full[:, 2:] = left[some], right[some], rows
            first, place = _distinct(full)
            parts.append(full[first])
            firsts.append(begin + first)
            places.append(total + place)
            total += len(first)
        full = np.concatenate(parts)
        first, place = _distinct(full)
        every, none = np.concatenate([*places, []]).astype(np.int64), np.zeros(0, np.int64)
        place = place[every]
        smallest = np.full(len(first), LAST)
        np.minimum.at(smallest, place, self.ids[self.doc])
        return full[first], self.hash[np.concatenate([none, *firsts])[first]], smallest, place


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row occurs first, in the order of their bytes, and each row's number."""
    values = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()
    return np.unique(values, return_index=True, return_inverse=True)[1:]


def leading(rows: np.ndarray) -> np.ndarray:
    """The first eight bytes as a signed number whose order is that of the bytes."""
    big = np.ascontiguousarray(rows[:, :8]).view(">u8").ravel().astype(np.uint64)
    return (big ^ U(1 << 63)).view(np.int64)


def range_of(lead: np.ndarray, hashes: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    first = np.searchsorted(splitters, lead, "left")
    last = np.searchsorted(splitters, lead, "right")
    several = np.maximum(1, last - first)
    return first + (last > first) + np.where(
        several > 1, (mixed(hashes ^ U(0xC2B2AE3D27D4EB4F)) % several.astype(np.uint64)), U(0)
    ).astype(np.int64)


# --- inside a range --------------------------------------------------------------------------


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Sorts rows of bytes eight at a time; only runs that are still equal are sorted on."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    keys = padded.view(">u8").astype(np.uint64)
    order = np.argsort(keys[:, 0], kind="stable")
    run = np.zeros(n, np.int64)
    run[1:] = np.cumsum(keys[order[1:], 0] != keys[order[:-1], 0])
    for level in range(1, keys.shape[1]):
        equal = run[1:] == run[:-1]
        active = np.zeros(n, bool)
        active[1:] |= equal
        active[:-1] |= equal
        at = np.flatnonzero(active)
        if not len(at):
            break
        some = order[at]
        order[at] = some[np.lexsort((keys[some, level], run[at]))]
        new = run[1:] != run[:-1]
        new |= keys[order[1:], level] != keys[order[:-1], level]
        run[1:] = np.cumsum(new)
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the one before it, in the given order."""
    width = rows.shape[1]
    apart = rows[order[1:]] != rows[order[:-1]]
    found = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    return np.concatenate([[0], found]).astype(np.int64)[: len(rows)]


def earlier_windows(rows: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For each context, the fewest and most bytes before the anchor with which a window also
    starts in an earlier document; (255, 255) if none does."""
    before = length - GRAM
    left, right = rows[:, 0].astype(np.int64), rows[:, 1].astype(np.int64)
    ahead, behind = rows[:, 2 + before :], rows[:, 2 : 2 + before]
    order, back = multikey_order(ahead), multikey_order(behind)
    prefix, suffix = common_prefixes(ahead, order), common_prefixes(behind, back)
    result = np.full((len(rows), 2), 255, np.uint8)
    ahead_class, behind_class = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for j in range(before + 1):
        valid = np.flatnonzero((left >= j) & (right >= length - j))
        if not len(valid):
            continue
        ahead_class[order] = np.cumsum(prefix < length - j)
        behind_class[back] = np.cumsum(suffix < j)
        key = ahead_class[valid] * (len(rows) + 1) + behind_class[valid]
        by = np.argsort(key, kind="stable")
        starts = group_starts(key[by])
        smallest = np.minimum.reduceat(ids[valid][by], starts)
        smallest = np.repeat(smallest, np.diff(np.append(starts, len(by))))
        hit = valid[by[smallest < ids[valid][by]]]
        result[hit, 0] = np.minimum(result[hit, 0], j)
        result[hit, 1] = j
    return result


def _covered(block: Block, answers: list[tuple[int, bytes]], splitters: np.ndarray) -> np.ndarray:
    """Which bytes of the block's data are to be removed."""
    depth = np.zeros(len(block.data) + 1, np.int64)
    if len(block.at):
        rows, hashes, smallest, place = block.contexts()
        before = block.length - GRAM
        where = range_of(leading(rows[:, 2 + before :]), hashes, splitters)
        found = np.full((len(rows), 2), 255, np.uint8)
        for bucket, payload in answers:
            found[where == bucket] = unpack_arrays(payload)[0].reshape(-1, 2)
        found = found.astype(np.int64)
        # Ids after the context's first one here have all its windows in an earlier document.
        later = block.ids[block.doc] > smallest[place]
        left, right = rows[place, 0].astype(np.int64), rows[place, 1].astype(np.int64)
        low = np.where(later, np.maximum(0, block.length - right), found[place, 0])
        high = np.where(later, left, np.where(found[place, 0] == 255, -1, found[place, 1]))
        some = low <= high
        first, end = (block.at - high)[some], (block.at - low + block.length)[some]
        depth += np.bincount(first, minlength=len(depth))
        depth -= np.bincount(end, minlength=len(depth))
    return np.cumsum(depth)[:-1] > 0


def remove_repeats(
    docs: DataFrame,
    key: str,
    text: str,
    work: Work,
    length: int = LENGTH,
    whole_characters: bool = False,
) -> DataFrame:
    """key, n_bytes, removed (spans of bytes), kept (the bytes that stay), one row per document.

    With whole_characters a character stays if any of its bytes does, so that `kept` is text.
    """
    if not GRAM < length < 200:
        raise ValueError("length must be from 21 to 199 bytes")
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        for batch, texts in text_chunks(batches, "_text", BLOCK_BYTES):
            ids = batch.column(0).cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            data, _ = join_texts(texts)
            at = np.arange(SAMPLE_EVERY // 2, len(data) - 8, SAMPLE_EVERY)
            sample = leading(data[at[:, None] + np.arange(8)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([base + count]),
                    pa.array([int(sizes.sum())]),
                    pa.array([sample.tolist()], pa.list_(pa.int64())),
                    pa.array([pack_arrays(ids, sizes, data)], pa.binary()),
                ],
                names=["block", "n_bytes", "sample", "payload"],
            )
            count += 1

    narrow = docs.select(F.col(key), text_or_empty(text).alias("_text"))
    blocks = work.put(narrow.mapInArrow(pack, BLOCK), "blocks")
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(parallelism(spark), math.ceil(total / BYTES_PER_BUCKET))
    shares = [i / buckets for i in range(1, buckets)]
    sampled = blocks.select(F.explode("sample").alias("lead"))
    found = sampled.agg(F.percentile_approx("lead", shares or [0.5], 10_000)).first()[0]
    splitters = np.array(found or [], np.int64)

    def send_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, payload in zip(batch.column(0), batch.column(1)):
                value, bucket, twice, _ = Block(payload.as_py(), length).hashes(buckets)
                starts = group_starts(bucket)
                parts = np.split(np.arange(len(value)), starts[1:]) if len(value) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[starts], pa.int32()),
                        pa.array([name.as_py()] * len(parts), pa.int64()),
                        pa.array([_hash_payload(value[p], twice[p]) for p in parts], pa.binary()),
                    ],
                    names=["bucket", "block", "payload"],
                )

    def answer_hashes(group: pa.Table) -> pa.Table:
        received = [_hash_values(p) for p in group.column("payload").to_pylist()]
        value = np.concatenate([v for v, _ in received])
        twice = np.concatenate([t for _, t in received])
        _, place, count = np.unique(value, return_inverse=True, return_counts=True)
        several = count > 1
        several[place[twice]] = True
        shared = np.split(several[place], np.cumsum([len(v) for v, _ in received])[:-1])
        return group.drop_columns(["payload"]).append_column(
            "mask", pa.array([np.packbits(s).tobytes() for s in shared], pa.binary())
        )

    masks = work.put(
        blocks.select("block", "payload")
        .mapInArrow(lean(send_hashes), "bucket int, block bigint, payload binary")
        .groupBy("bucket")
        .applyInArrow(answer_hashes, "bucket int, block bigint, mask binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("bucket", "mask")).alias("masks")),
        "masks",
    )
    known = blocks.select("block", "payload").join(masks, "block", "left")

    def opened(batch: pa.RecordBatch) -> Iterator[tuple[Block, dict]]:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = Block(row["payload"], length)
            got = [(m["bucket"], m["mask"]) for m in row["masks"] or []]
            block.keep_shared(buckets, got)
            yield block, row

    def send_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, row in opened(batch):
                if not len(block.at):
                    continue
                rows, hashes, smallest, _ = block.contexts()
                where = range_of(leading(rows[:, 2 + length - GRAM :]), hashes, splitters)
                order = np.argsort(where, kind="stable")
                starts = group_starts(where[order])
                parts = np.split(order, starts[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(where[order][starts], pa.int32()),
                        pa.array([row["block"]] * len(parts), pa.int64()),
                        pa.array(
                            [pack_arrays(rows[p].ravel(), smallest[p]) for p in parts], pa.binary()
                        ),
                    ],
                    names=["bucket", "block", "payload"],
                )

    def sort_suffixes(group: pa.Table) -> pa.Table:
        width = 2 * length - GRAM + 2
        received = [unpack_arrays(p) for p in group.column("payload").to_pylist()]
        rows = np.concatenate([r.reshape(-1, width) for r, _ in received])
        ids = np.concatenate([i for _, i in received])
        found = earlier_windows(rows, ids, length)
        ends = np.cumsum([len(i) for _, i in received])
        parts = np.split(found, ends[:-1])
        return group.drop_columns(["payload"]).append_column(
            "answer", pa.array([pack_arrays(p.ravel()) for p in parts], pa.binary())
        )

    answers = work.put(
        known.mapInArrow(lean(send_suffixes), "bucket int, block bigint, payload binary")
        .groupBy("bucket")
        .applyInArrow(sort_suffixes, "bucket int, block bigint, answer binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("bucket", "answer")).alias("answers")),
        "answers",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, row in opened(batch):
                got = [(a["bucket"], a["answer"]) for a in row["answers"] or []]
                gone = _covered(block, got, splitters)
                yield _result(block, gone, whole_characters, key)

    schema = (
        f"`{key}` bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary"
    )
    result = known.join(answers, "block", "left").mapInArrow(lean(cut), schema)
    return result.withColumn(key, F.col(key).cast(key_type))


def _hash_payload(value: np.ndarray, twice: np.ndarray) -> bytes:
    head, tail = (value >> U(32)).astype(np.uint32), (value >> U(16)).astype(np.uint16)
    return pack_arrays(head, tail, np.packbits(twice))


def _hash_values(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    head, tail, twice = unpack_arrays(payload)
    value = (head.astype(np.uint64) << U(16)) | tail.astype(np.uint64)
    return value, np.unpackbits(twice, count=len(value)).astype(bool)


def _result(block: Block, gone: np.ndarray, whole_characters: bool, key: str) -> pa.RecordBatch:
    data, offset = block.data, block.offset
    text = np.ones(len(data), bool)
    text[offset[1:] - 1] = False
    if whole_characters:
        character = np.cumsum((data & 0xC0) != 0x80)
        stays = np.bincount(character, ~gone) > 0
        gone = ~stays[character]
    gone &= text
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(offset, first, "right") - 1
    spans = pa.StructArray.from_arrays(
        [pa.array(first - offset[doc]), pa.array(end - offset[doc])], ["start", "end"]
    )
    lists = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offset) - 1))])
    kept = data[text & ~gone].tobytes()
    per_doc = np.add.reduceat((text & ~gone).astype(np.int64), offset[:-1])
    ends = np.concatenate([[0], np.cumsum(per_doc)]).tolist()
    late = block.ids == LAST
    return pa.RecordBatch.from_arrays(
        [
            pa.array(block.ids, mask=late),
            pa.array(np.diff(offset) - 1),
            pa.ListArray.from_arrays(pa.array(lists, pa.int32()), spans),
            pa.array([kept[a:b] for a, b in zip(ends, ends[1:])], pa.binary()),
        ],
        names=[key, "n_bytes", "removed", "kept"],
    )
