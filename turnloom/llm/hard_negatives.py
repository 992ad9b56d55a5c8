"""Hard negatives from blocks in Hilbert order with zone maps.

Vectors become integers, floor(scale * x), and are ordered by label and by their place on a Hilbert
curve through the space of all dimensions. The order is cut into blocks of BLOCK_ROWS rows of one
label, one Parquet row each, with the smallest and largest value of every dimension, its zone map.
For an anchor a and a block, interval arithmetic bounds all inner products of the block:
sum(max(a_i * low_i, a_i * high_i)) from above and sum(min(..)) from below. A block is read for an
anchor only if the bounds leave room for a row that it needs.

- Positives: the blocks of the anchor's label whose upper bound reaches the score of its last
  positive so far, which at first comes from the block that the anchor itself lies in.
- Negatives: every positive opens a window of scores, low_part * s <= whole * n <= high_part * s.
  The blocks of other labels whose bounds meet an open window are read; while a task reads, it
  visits the blocks with the highest bounds first and closes a window for blocks that cannot
  better the rows found.

Anchors travel in batches of ANCHOR_ROWS neighbours of one label on the curve; zone maps, a few
hundred bytes per block, are compared with them in chunks of ZONE_BLOCKS, and only then are blocks
joined, in sections of at most SECTION_BLOCKS per task. So what a task holds is bounded whatever
the table's size, and a label or vector that makes up a third of the rows is spread over
sections by its place in the order, ties included. Everything is exact: bounds are integers too.

Cases: rows with a NULL key, label or vector or a NULL or non-finite component take no part. Rows
are compared with rows of as many components. Repeated rows and keys are rows of their own: a row
is never its own partner, but its twin can be. Fewer partners than asked for: all. Tables without
anchors, or with rows of one label only, give no rows. Scores that could leave 64 bits stop the
job. Other columns of the input are left out, so that their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.common import Work, parallelism

BLOCK_ROWS = 256
ANCHOR_ROWS = 512
BATCHES_PER_FILE = 8
ZONE_BLOCKS = 4096
SECTION_BLOCKS = 64
CURVE_BITS = 4
EXACT_DOUBLE = 1 << 53

LEAST = np.iinfo(np.int64).min + 1
BLOCK = "block dims label n anchors rid vec q low high a_rid a_vec a_q floor"
BATCH = "batch dims n label rid vec q floor"


# --- numbers ---------------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each cell (row of unsigned numbers below 2^bits) on the Hilbert curve, as bytes."""
    x = cells.astype(np.uint32).copy()
    n, dims = x.shape
    if not dims:
        return [b""] * n
    top = 1 << (bits - 1)
    step = top
    while step > 1:  # undo the rotations, from the largest cubes to the smallest
        low = np.uint32(step - 1)
        for i in range(dims):
            turned = (x[:, i] & np.uint32(step)) != 0
            swap = np.where(turned, np.uint32(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, i] ^= swap
        step >>= 1
    for i in range(1, dims):  # Gray code
        x[:, i] ^= x[:, i - 1]
    fix = np.zeros(n, np.uint32)
    step = top
    while step > 1:
        fix ^= np.where((x[:, -1] & np.uint32(step)) != 0, np.uint32(step - 1), np.uint32(0))
        step >>= 1
    x ^= fix[:, None]
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)[None, :, None]
    interleaved = ((x[:, None, :] >> shifts) & np.uint32(1)).astype(np.uint8).reshape(n, bits * dims)
    return [row.tobytes() for row in np.packbits(interleaved, axis=1)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: by doubles where these hold every sum exactly."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if most < EXACT_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 1 << 63:
        raise ValueError("inner products of these vectors can leave 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest inner product of each row of a with anything in each zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def sound(vector: Column) -> Column:
    wide = vector.cast("array<double>")
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def shrunk(values: np.ndarray) -> bytes:
    """Integers in the narrowest type that holds them all."""
    for kind in ("<i2", "<i4"):
        info = np.iinfo(kind)
        if not values.size or (values.min() >= info.min and values.max() <= info.max):
            break
    else:
        kind = "<i8"
    return kind.encode() + np.ascontiguousarray(values, kind).tobytes()


def matrix(value: bytes, dims: int, rows: int) -> np.ndarray:
    return np.frombuffer(value, value[:3].decode(), offset=3).reshape(rows, dims)


def column_of(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


# --- ordered blocks --------------------------------------------------------------------------


def quantised(
    vectors: DataFrame, key: str, vector: str, label: Column, is_anchor: Column, scale: int, work: Work
) -> DataFrame:
    """rid, vec, label, dims, anchor, q and place on the curve of every row that takes part."""
    wide = F.col(vector).cast("array<double>")
    rows = vectors.select(
        F.col(key).cast("bigint").alias("vec"),
        label.cast("bigint").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.transform(wide, lambda x: F.floor(x * scale).cast("bigint")).alias("q"),
        sound(F.col(vector)).alias("_sound"),
    ).filter("_sound AND vec IS NOT NULL AND label IS NOT NULL")
    rows = work.put(
        rows.drop("_sound")
        .withColumn("dims", F.size("q"))
        .withColumn("rid", F.monotonically_increasing_id()),
        "quantised",
    )
    spans = rows.agg(F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high")).first()
    low, high = int(spans["low"] or 0), int(spans["high"] or 0)
    cell = (high - low) // (1 << CURVE_BITS) + 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = ("rid", "vec", "label", "dims", "anchor")
        for batch in batches:
            flat = batch.column(batch.schema.get_field_index("q")).flatten()
            flat = flat.to_numpy(zero_copy_only=False).astype("<i8")
            sizes = np.array(column_of(batch, "dims"), np.int64)
            ends = np.cumsum(sizes)
            curve: list[bytes] = [b""] * len(sizes)
            packed: list[bytes] = [b""] * len(sizes)
            for dims in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == dims)
                q = flat[(ends[of] - dims)[:, None] + np.arange(dims)]
                for i, row, place in zip(of.tolist(), q, hilbert_keys((q - low) // cell, CURVE_BITS)):
                    curve[i], packed[i] = place, row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in kept),
                    pa.array(packed, pa.binary()),
                    pa.array(curve, pa.binary()),
                ],
                names=[*kept, "q", "curve"],
            )

    return rows.mapInArrow(
        keyed, "rid bigint, vec bigint, label bigint, dims int, anchor boolean, q binary, curve binary"
    )


def best_first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row, ties by smaller id."""
    return np.lexsort((ids, -scores), axis=1)[:, :k]


def ordered_blocks(rows: DataFrame, ranges: int, positives: int) -> DataFrame:
    """One row per block, in (dims, label, curve) order; equal rows are spread by their row id.

    Beside the block stand its anchors, each with the score that its positives reach inside it.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            rid, vec, label, dims, anchor, q = zip(*held)
            held.clear()
            n, d = len(rid), dims[0]
            values = np.frombuffer(b"".join(q), "<i8").reshape(n, d)
            own = np.flatnonzero(anchor)
            scores = products(values[own], values)
            scores[np.arange(len(own)), own] = LEAST
            floor = np.full(len(own), LEAST)
            if n > positives:
                floor = np.sort(scores, axis=1)[:, -positives]
            edges = (values.min(axis=0), values.max(axis=0))
            parts = [rid, vec, values, *edges, np.array(rid)[own], np.array(vec)[own], values[own], floor]
            packed = [pa.array([shrunk(np.asarray(x, "<i8"))], pa.binary()) for x in parts]
            numbers = [pa.array([0], pa.int64()), pa.array([d], pa.int32()), pa.array([label[0]], pa.int64())]
            counts = [pa.array([n], pa.int32()), pa.array([len(own)], pa.int32())]
            return pa.RecordBatch.from_arrays([*numbers, *counts, *packed], names=BLOCK.split())

        for batch in batches:
            names = ("rid", "vec", "label", "dims", "anchor", "q")
            for row in zip(*(column_of(batch, c) for c in names)):
                if held and (len(held) == BLOCK_ROWS or held[0][2:4] != row[2:4]):
                    yield block()
                held.append(row)
        if held:
            yield block()

    order = ["dims", "label", "curve", "rid"]
    placed = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    kinds = ["bigint", "int", "bigint", "int", "int", *["binary"] * 9]
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(BLOCK.split(), kinds))
    return placed.mapInArrow(pack, schema).withColumn("block", F.monotonically_increasing_id())


def anchor_batches(blocks: DataFrame) -> DataFrame:
    """Anchors of neighbouring blocks: batch, dims, n and their labels, ids, numbers and floors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def one() -> pa.RecordBatch:
            dims, n = held[0][0], sum(r[2] for r in held)
            label = np.repeat([r[1] for r in held], [r[2] for r in held])
            joined = [
                np.concatenate([matrix(r[i], width, r[2]) for r in held])
                for i, width in ((3, 1), (4, 1), (5, dims), (6, 1))
            ]
            held.clear()
            packed = [pa.array([shrunk(x)], pa.binary()) for x in (label, *joined)]
            head = [pa.array([0], pa.int64()), pa.array([dims], pa.int32()), pa.array([n], pa.int32())]
            return pa.RecordBatch.from_arrays([*head, *packed], names=BATCH.split())

        for batch in batches:
            columns = ("dims", "label", "anchors", "a_rid", "a_vec", "a_q", "floor")
            for row in zip(*(column_of(batch, c) for c in columns)):
                full = sum(r[2] for r in held) + row[2] > ANCHOR_ROWS
                if held and (full or held[0][0] != row[0]):
                    yield one()
                held.append(row)
        if held:
            yield one()

    some = blocks.filter("anchors > 0").select("dims", "label", "anchors", "a_rid", "a_vec", "a_q", "floor")
    kinds = ["bigint", "int", "int", *["binary"] * 5]
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(BATCH.split(), kinds))
    n = some.agg(F.sum("anchors")).first()[0] or 0
    files = 1 + n // (BATCHES_PER_FILE * ANCHOR_ROWS)
    batches = some.coalesce(files).mapInArrow(pack, schema)
    return batches.withColumn("batch", F.monotonically_increasing_id())


class Anchors:
    """A batch of anchors."""

    def __init__(self, row: dict) -> None:
        self.batch, self.dims, self.n = row["batch"], row["dims"], row["n"]
        self.label, self.rid, self.vec, self.floor = (
            matrix(row[c], 1, self.n)[:, 0].astype(np.int64) for c in ("label", "rid", "vec", "floor")
        )
        self.q = matrix(row["q"], self.dims, self.n)


class Block:
    """A block with its bounds for each anchor of a batch."""

    def __init__(self, row: dict, anchors: Anchors) -> None:
        self.label, n, dims = row["label"], row["n"], row["dims"]
        self.rid, self.vec = (matrix(row[c], 1, n)[:, 0].astype(np.int64) for c in ("rid", "vec"))
        self.q = matrix(row["q"], dims, n)
        low, high = (matrix(row[c], dims, 1) for c in ("low", "high"))
        below, above = bounds(anchors.q, low, high)
        self.below, self.above = below[:, 0], above[:, 0]


# --- searches --------------------------------------------------------------------------------


def wanted_blocks(batches: DataFrame, blocks: DataFrame, work: Work, low: int, high: int, whole: int) -> DataFrame:
    """(batch, block) of every block that an anchor of the batch has to read, from zone maps alone.

    Batches that hold `scores` of positives ask for negatives, others for positives. A task holds
    about ZONE_BLOCKS zone maps and BATCHES_PER_FILE batches.
    """
    chunks = 1 + blocks.count() // ZONE_BLOCKS
    slots = 1 + batches.count() // BATCHES_PER_FILE
    negatives = "scores" in batches.columns

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        who: list[int] = []
        what: list[int] = []
        zones: dict[int, list[dict]] = {}
        for zone in right.to_pylist():
            zones.setdefault(zone["dims"], []).append(zone)
        for row in left.to_pylist():
            anchors, near = Anchors(row), zones.get(row["dims"], [])
            if not near:
                continue
            edges = [np.concatenate([matrix(z[c], anchors.dims, 1) for z in near]) for c in ("low", "high")]
            below, above = bounds(anchors.q, *edges)
            same = anchors.label[:, None] == np.array([z["label"] for z in near])
            if negatives:
                opened = np.zeros(same.shape, bool)
                edges = open_windows(row, anchors, low, high, whole)
                for j in range(edges.shape[1]):
                    first, last = edges[:, j, :1], edges[:, j, 1:]
                    opened |= (above >= first) & (below <= last) & (first <= last)
                read = opened & ~same
            else:
                read = same & (above >= anchors.floor[:, None])
            some = np.flatnonzero(read.any(axis=0))
            who += [anchors.batch] * len(some)
            what += [near[i]["block"] for i in some]
        return pa.table({"batch": pa.array(who, pa.int64()), "block": pa.array(what, pa.int64())})

    zone_columns = ["block", "dims", "label", "low", "high"]
    slot = F.pmod(F.xxhash64("batch"), F.lit(slots)).cast("int").alias("slot")
    chunk = F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk")
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    every_slot = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
    asking = batches.select("*", slot).select("*", every_chunk)
    zones = blocks.select(*zone_columns, chunk).select("*", every_slot)
    pairs = (
        asking.groupBy("chunk", "slot")
        .cogroup(zones.groupBy("chunk", "slot"))
        .applyInArrow(ask, "batch bigint, block bigint")
    )
    return work.put(pairs, "wanted")


def read_blocks(
    batches: DataFrame, blocks: DataFrame, pairs: DataFrame, search: Callable, schema: str
) -> DataFrame:
    """The search over the wanted blocks of each batch, SECTION_BLOCKS neighbours to a task."""
    placed = pairs.select("batch", "block", F.expr(f"block div {SECTION_BLOCKS}").alias("section"))
    sections = placed.select(F.col("batch").alias("batch"), F.col("section").alias("section")).distinct()
    asking = sections.join(batches, "batch")
    data = blocks.select("block", "dims", "label", "n", "rid", "vec", "q", "low", "high")
    read = placed.join(data, "block")

    def body(left: pa.Table, right: pa.Table) -> pa.Table:
        return search(left.to_pylist()[0], right.to_pylist())

    by = ["batch", "section"]
    return asking.groupBy(*by).cogroup(read.groupBy(*by)).applyInArrow(body, schema)


def first_rows(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k highest scores of each group, ties by smaller vec, numbered from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def open_windows(row: dict, anchors: Anchors, low: int, high: int, whole: int) -> np.ndarray:
    """Window of each positive of each anchor: (anchors, positives, 2); a missing one is empty."""
    count = matrix(row["counts"], 1, anchors.n)[:, 0].astype(np.int64)
    scores = matrix(row["scores"], row["most"], anchors.n).tolist()
    edges = np.zeros((anchors.n, row["most"], 2), np.int64)
    edges[..., 0] = 1
    for i, n in enumerate(count.tolist()):
        for j in range(n):
            s = scores[i][j]
            edges[i, j] = -((-low * s) // whole), (high * s) // whole
    return edges


def mine(
    vectors: DataFrame,
    key: str,
    vector: str,
    label: Column,
    is_anchor: Column,
    work: Work,
    positives: int = 5,
    negatives: int = 10,
    low_part: int = 30,
    high_part: int = 90,
    whole: int = 100,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = quantised(vectors, key, vector, label, is_anchor, scale, work)
    blocks = work.put(ordered_blocks(rows, parallelism(spark), positives), "blocks")
    batches = work.put(anchor_batches(blocks), "anchors")

    def find_positives(row: dict, near: list[dict]) -> pa.Table:
        anchors = Anchors(row)
        best = np.full((anchors.n, positives), LEAST)
        ids = np.zeros((anchors.n, positives), np.int64)
        floor = anchors.floor.copy()
        read = [Block(z, anchors) for z in near]
        for block in sorted(read, key=lambda b: -int(b.above.max())):
            who = np.flatnonzero((anchors.label == block.label) & (block.above >= floor))
            if not len(who):
                continue
            scores = products(anchors.q[who], block.q)
            scores[anchors.rid[who][:, None] == block.rid] = LEAST
            scores = np.concatenate([best[who], scores], axis=1)
            names = np.concatenate([ids[who], np.broadcast_to(block.vec, (len(who), len(block.vec)))], axis=1)
            top = best_first(scores, names, positives)
            best[who], ids[who] = (np.take_along_axis(x, top, axis=1) for x in (scores, names))
            floor = np.maximum(floor, best[:, -1])
        at, j = np.nonzero(best > LEAST)
        return pa.table(
            {
                "batch": pa.array(np.full(len(at), anchors.batch)),
                "at": pa.array(at.astype(np.int32)),
                "vec": pa.array(ids[at, j]),
                "score": pa.array(best[at, j]),
            }
        )

    pairs = wanted_blocks(batches, blocks, work, low_part, high_part, whole)
    found = read_blocks(batches, blocks, pairs, find_positives, "batch bigint, at int, vec bigint, score bigint")
    chosen = work.put(first_rows(found, ["batch", "at"], positives), "positives")

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        """A batch with the positives of its anchors, ANCHOR_ROWS times `positives` of them at most."""
        row = left.to_pylist()[0]
        n = row["n"]
        counts, scores, ids = (np.zeros(shape, np.int64) for shape in ((n,), (n, positives), (n, positives)))
        for one in right.to_pylist():
            i, j = one["at"], one["rank"] - 1
            scores[i, j], ids[i, j] = one["score"], one["vec"]
            counts[i] = max(counts[i], j + 1)
        packed = {name: pa.array([shrunk(x)], pa.binary()) for name, x in zip(("counts", "scores", "ids"), (counts, scores, ids))}
        return pa.table({**{c: left.column(c) for c in BATCH.split()}, "most": pa.array([positives], pa.int32()), **packed})

    schema = batches.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    asking = work.put(
        batches.groupBy("batch").cogroup(chosen.groupBy("batch")).applyInArrow(
            gather, f"{schema}, most int, counts binary, scores binary, ids binary"
        ),
        "asking",
    )

    def find_negatives(row: dict, near: list[dict]) -> pa.Table:
        anchors = Anchors(row)
        edges = open_windows(row, anchors, low_part, high_part, whole)
        first, last = edges[..., 0], edges[..., 1]
        best = np.full((anchors.n, positives, negatives), LEAST)
        ids = np.zeros(best.shape, np.int64)
        read = [Block(z, anchors) for z in near]
        for block in sorted(read, key=lambda b: -int(b.above.max())):
            least = np.maximum(first, best[..., -1])
            wanted = (block.above[:, None] >= least) & (block.below[:, None] <= last) & (first <= last)
            who = np.flatnonzero(wanted.any(axis=1) & (anchors.label != block.label))
            if not len(who):
                continue
            scores = products(anchors.q[who], block.q)
            order = best_first(scores, np.broadcast_to(block.vec, scores.shape), scores.shape[1])
            scores, names = np.take_along_axis(scores, order, axis=1), block.vec[order]
            for j in range(positives):
                skip = (scores > last[who, j][:, None]).sum(axis=1)
                at = skip[:, None] + np.arange(negatives)
                inside = at < scores.shape[1]
                at = np.minimum(at, scores.shape[1] - 1)
                new = np.where(inside, np.take_along_axis(scores, at, axis=1), LEAST)
                new[new < first[who, j][:, None]] = LEAST
                new = np.concatenate([best[who, j], new], axis=1)
                own = np.concatenate([ids[who, j], np.take_along_axis(names, at, axis=1)], axis=1)
                top = best_first(new, own, negatives)
                best[who, j], ids[who, j] = (np.take_along_axis(x, top, axis=1) for x in (new, own))
        i, j, r = np.nonzero((best > LEAST) & (first <= last)[..., None])
        scores = matrix(row["scores"], positives, anchors.n).astype(np.int64)
        names = matrix(row["ids"], positives, anchors.n).astype(np.int64)
        return pa.table(
            {
                "rid": pa.array(anchors.rid[i]),
                "anchor_id": pa.array(anchors.vec[i]),
                "at": pa.array(j.astype(np.int32)),
                "positive_id": pa.array(names[i, j]),
                "positive_score": pa.array(scores[i, j]),
                "vec": pa.array(ids[i, j, r]),
                "score": pa.array(best[i, j, r]),
            }
        )

    pairs = wanted_blocks(asking, blocks, work, low_part, high_part, whole)
    found = read_blocks(
        asking,
        blocks,
        pairs,
        find_negatives,
        "rid bigint, anchor_id bigint, at int, positive_id bigint, positive_score bigint, vec bigint, score bigint",
    )
    return first_rows(found, ["rid", "at"], negatives).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
