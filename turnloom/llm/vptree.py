"""Nearest neighbours by cosine with a vantage-point tree per shard.

On unit vectors the Euclidean distance is a metric and orders like the cosine. Equal vectors are
one entry with the smallest ids it can contribute, reduced per task before the shuffle. Entries
belong to the cell of their nearest pivot, and a cell is split by hash into shards of bounded
size, each with its own tree. A query searches its home cell first. Its distance bound then
rules out other cells, by the cell's radius and by the halfway plane between pivots, and the
rest are searched in a second round. Trees prune by the triangle inequality.

`factor` relaxes all pruning: a part is skipped if its lower bound times the factor exceeds the
bound so far. At 1 the search is exact; larger values skip more.

Pivots are a sample of bounded size (`PIVOTS` entries by hash order); all vectors are indexed.

Cases: vectors that are NULL or zero or hold NULL or non-finite numbers, and rows without an id,
take no part, neither as query nor as candidate. A shorter vector counts as one with zeros behind
its end. Repeated vectors and ids are rows of their own: a query never finds its own row, but it
finds its twins. With fewer candidates than k all are returned. Without queries or vectors the
result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import Work, spread

PIVOTS = 128
SHARD_ROWS = 20_000
QUERY_ROWS = 2_000
LEAF = 48
FACTOR = 1.1
# More entries than asked for are kept until scores are compared in full precision.
SPARE = 4
ROUNDING = 1e-7


class Tree:
    """Vantage-point tree over unit vectors; queries are searched together."""

    def __init__(self, points: np.ndarray, factor: float) -> None:
        self.points, self.factor = points, factor
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> tuple:
        if len(rows) <= LEAF:
            return (rows,)
        vantage = self.points[rows[len(rows) // 2]]
        far = distances(self.points[rows], vantage[None, :])[:, 0]
        middle = float(np.median(far))
        near = far <= middle
        if near.all():
            near = far < middle
        if not near.any():  # all at the same distance
            near[: len(rows) // 2] = True
        inside, outside = rows[near], rows[~near]
        bounds = [float(x) for x in (far[near].min(), far[near].max(), far[~near].min(), far[~near].max())]
        return vantage, bounds, self._build(inside), self._build(outside)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances and rows of the k nearest points, -1 where there are fewer."""
        self.queries, self.k = queries, k
        self.far = np.full((len(queries), k), np.inf)
        self.row = np.full((len(queries), k), -1)
        self._visit(self.root, np.arange(len(queries)))
        return self.far, self.row

    def _visit(self, node: tuple, who: np.ndarray) -> None:
        if not len(who):
            return
        if len(node) == 1:
            rows = node[0]
            far = distances(self.queries[who], self.points[rows])
            far = np.concatenate([self.far[who], far], axis=1)
            row = np.concatenate([self.row[who], np.broadcast_to(rows, (len(who), len(rows)))], axis=1)
            best = np.argsort(far, axis=1, kind="stable")[:, : self.k]
            self.far[who] = np.take_along_axis(far, best, axis=1)
            self.row[who] = np.take_along_axis(row, best, axis=1)
            return
        vantage, (in_low, in_high, out_low, out_high), inside, outside = node
        far = distances(self.queries[who], vantage[None, :])[:, 0]
        to_in = np.maximum(0, np.maximum(far - in_high, in_low - far))
        to_out = np.maximum(0, np.maximum(far - out_high, out_low - far))
        first_in = to_in <= to_out
        for side, first, bound in (
            (inside, first_in, to_in),
            (outside, ~first_in, to_out),
            (outside, first_in, to_out),
            (inside, ~first_in, to_in),
        ):
            wanted = first & (bound * self.factor <= self.far[who, -1] + ROUNDING)
            self._visit(side, who[wanted])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def units(values: list[bytes], size: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(values), np.float64).reshape(-1, size)
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True) if len(raw) else raw
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no NULL, no non-finite number, not all zero."""
    wide = vector.cast("array<double>")
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(wide, lambda x: x != 0.0), F.lit(False))


def nearest(
    vectors: DataFrame,
    key: str,
    vector: str,
    is_query: Column,
    work: Work,
    k: int = 5,
    factor: float = FACTOR,
) -> DataFrame:
    """query_id, rank, the candidate's key and score of the k nearest of every query."""
    spark = vectors.sparkSession
    sound = vectors.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    size = sound.agg(F.max(F.size("v"))).first()[0]
    names = f"query_id bigint, rank int, `{key}` bigint, score double"
    if size is None:
        return spark.createDataFrame([], names)
    keep = k + 1

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            lengths = np.array([len(v) for v in batch.column(1)], np.int64)
            padded = np.zeros((len(lengths), size))
            row = np.repeat(np.arange(len(lengths)), lengths)
            padded[row, spread(np.zeros_like(lengths), lengths)] = flat.astype(np.float64) + 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([v.tobytes() for v in padded], pa.binary()), batch.column(2)],
                names=["id", "v", "asks"],
            )

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: dict[bytes, list[dict]] = {}
            for i, r, v in sorted(zip(*(column.to_pylist() for column in batch.columns))):
                own = ids.setdefault(v, [])
                if len(own) < keep:
                    own.append({"id": i, "rid": r})
            kind = pa.list_(pa.struct([("id", pa.int64()), ("rid", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(ids), pa.binary()), pa.array(list(ids.values()), kind)],
                names=["v", "ids"],
            )

    rows = work.put(
        sound.mapInArrow(as_bytes, "id bigint, v binary, asks boolean").withColumn(
            "rid", F.monotonically_increasing_id()
        ),
        "vectors",
    )
    smallest = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, keep)
    members = "v binary, ids array<struct<id:bigint,rid:bigint>>"
    entries = rows.select("id", "rid", "v").mapInArrow(reduced, members)
    entries = work.put(entries.groupBy("v").agg(smallest.alias("ids")), "entries")

    chosen = entries.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(PIVOTS)
    pivots = units([bytes(r["v"]) for r in chosen.collect()], size)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(units(batch.column(0).to_pylist(), size), pivots)
            cell = far.argmin(axis=1)
            yield batch.append_column("cell", pa.array(cell, pa.int32())).append_column(
                "far", pa.array(far.min(axis=1))
            )

    placed = work.put(
        entries.mapInArrow(to_cells, f"{members}, cell int, far double"), "cells"
    )
    shards = F.ceil(F.count(F.lit(1)) / F.lit(SHARD_ROWS)).cast("int")
    cells = placed.groupBy("cell").agg(shards.alias("shards"), F.max("far").alias("radius"))
    # One row per pivot, so at most PIVOTS rows.
    few = spark.createDataFrame(cells.collect(), cells.schema)
    radius = {r["cell"]: r["radius"] for r in few.collect()}
    shard = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    stored = placed.join(F.broadcast(few), "cell").select("cell", shard.alias("shard"), "v", "ids")

    asked = work.put(rows.filter("asks").select("v").distinct(), "queries")
    home = asked.mapInArrow(
        lambda batches: (
            b.append_column(
                "cell",
                pa.array(
                    distances(units(b.column(0).to_pylist(), size), pivots).argmin(axis=1), pa.int32()
                ),
            )
            for b in batches
        ),
        "v binary, cell int",
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found_q, found_i, found_r, found_s = [], [], [], []
        if left.num_rows and right.num_rows:
            queries, points = left.column("v").to_pylist(), right.column("v").to_pylist()
            ids = right.column("ids").to_pylist()
            q, p = (np.frombuffer(b"".join(x), np.float64).reshape(-1, size) for x in (queries, points))
            _, near = Tree(units(points, size), factor).search(units(queries, size), keep + SPARE)
            for i, row in enumerate(near):
                row = row[row >= 0]
                score = cosine(q[i], p[row])
                best = sorted((-s, x["id"], x["rid"]) for s, r in zip(score, row) for x in ids[r])[:keep]
                found_q += [queries[i]] * len(best)
                found_i += [x for _, x, _ in best]
                found_r += [x for _, _, x in best]
                found_s += [-s for s, _, _ in best]
        return pa.table(
            {
                "v": pa.array(found_q, pa.binary()),
                "id": pa.array(found_i, pa.int64()),
                "rid": pa.array(found_r, pa.int64()),
                "score": pa.array(found_s, pa.float64()),
            }
        )

    def searched(queries: DataFrame) -> DataFrame:
        sent = queries.join(F.broadcast(few), "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "v"
        )
        pieces = sent.groupBy("cell", "shard").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(QUERY_ROWS)).cast("int").alias("pieces")
        )
        piece = F.pmod(F.xxhash64("v", F.lit(1)), F.col("pieces")).cast("int").alias("piece")
        each = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
        by = ["cell", "shard", "piece"]
        asking = sent.join(pieces, ["cell", "shard"]).select("cell", "shard", piece, "v")
        standing = stored.join(pieces, ["cell", "shard"]).select("cell", "shard", each, "v", "ids")
        return (
            asking.groupBy(*by)
            .cogroup(standing.groupBy(*by))
            .applyInArrow(search, "v binary, id bigint, rid bigint, score double")
        )

    first = work.put(searched(home), "first")
    worst = first.groupBy("v").agg(
        F.when(F.count(F.lit(1)) >= keep, F.min("score")).otherwise(F.lit(-2.0)).alias("worst")
    )
    bounds = asked.join(worst, "v", "left").select("v", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    # Several shards of a home cell give more than `keep` rows: their minimum is only a weaker bound.

    def other_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = np.array([radius.get(c, -np.inf) for c in range(len(pivots))])
        for batch in batches:
            values = batch.column(0).to_pylist()
            worst_score = batch.column(1).to_numpy(zero_copy_only=False)
            bound = np.where(worst_score < -1.5, np.inf, np.sqrt(np.maximum(0, 2 - 2 * worst_score)))
            far = distances(units(values, size), pivots)
            nearest_pivot = far.min(axis=1, keepdims=True)
            low = np.maximum(far - reach, (far - nearest_pivot) / 2)
            wanted = (low * factor <= bound[:, None] + ROUNDING) & np.isfinite(reach)
            wanted[np.arange(len(far)), far.argmin(axis=1)] = False
            who, cell = np.nonzero(wanted)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(who)), pa.array(cell, pa.int32())], names=["v", "cell"]
            )

    second = searched(bounds.mapInArrow(other_cells, "v binary, cell int"))
    both = first.unionByName(second)
    order = F.struct((-F.col("score")).alias("s"), F.col("id"), F.col("rid"))
    best = both.groupBy("v").agg(
        F.slice(F.sort_array(F.collect_set(order)), 1, keep).alias("found")
    )
    queries = rows.filter("asks").select(F.col("id").alias("query_id"), F.col("rid").alias("_own"), "v")
    own = F.filter("found", lambda c: c["rid"] != F.col("_own"))
    ranked = queries.join(best, "v").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "c"))
    return ranked.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("c.id").alias(key),
        (-F.col("c.s")).alias("score"),
    )


def cosine(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Cosines in double precision; scaling by the largest number keeps squares finite."""
    q = query / np.abs(query).max()
    p = points / np.abs(points).max(axis=1, keepdims=True) if len(points) else points
    dot = (p * q).sum(axis=1)
    return dot / (np.sqrt((q * q).sum()) * np.sqrt((p * p).sum(axis=1)))
