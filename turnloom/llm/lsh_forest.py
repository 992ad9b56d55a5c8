"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Every distinct set of word shingles has a signature of TREES x DEPTH MinHash values. Tree t orders
the sets by its own DEPTH values; sets with a common prefix stand next to each other, and a run
of sets that share a prefix is a region. Depth adapts to the region: it starts at SHALLOW values,
and only a region of more than REGION_SETS sets is split by one value more, up to DEPTH. A link of
similarity s is met in one tree with probability s^depth, so at 0.8 it escapes all trees with
probability 1e-9 in thin regions and 6e-5 in the densest ones; near copies escape far less.

Neighbours in a region are candidates. They are told apart by their whole signatures: only sets
that agree in CANDIDATE values or more, five standard deviations below what a link needs, are
joined. What is joined is compared on full shingle sets, so no false link remains.

Nothing is gathered at a hot place. Copies are one set. Each task first folds sets that agree in
nearly all values (FOLDED) with a neighbour of the deepest region into that neighbour, so that a
crowd of near copies leaves a task as a few sets and a list of edges; the candidate threshold
leaves room for the fold. Regions with equal members in several trees are looked at once. A
region beyond PIECE_SETS is folded once more in pieces, and if it is still larger its pieces
are compared with each other in pairs, each pair in a task of its own.

Cases: NULL or empty text has no shingles and links with nothing. Fewer words than n make one
shingle. Repeated rows and repeated or NULL keys are each kept. An empty table gives an empty
result. Columns of the input with the name of a result column are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import (
    Work,
    group_starts,
    mixed,
    pack_arrays,
    parallelism,
    text_chunks,
    text_or_empty,
    unpack_arrays,
)
from turnloom.llm.graph import components, smallest_keys
from turnloom.llm.ngram_join import set_nodes, shingle_sets, verified_links

TREES, DEPTH, SHALLOW = 32, 6, 3
VALUES = TREES * DEPTH
FOLDED, CANDIDATE = 0.95, 0.62
REGION_SETS, PIECE_SETS = 512, 4096
SETS_PER_CHUNK = 20_000
ENTRIES_PER_BUCKET = 1_000_000
COMPARED_BYTES = 32 << 20
U = np.uint64

_DRAW = np.random.default_rng(20240229)
_SEEDS = _DRAW.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)
_FACTORS = _DRAW.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def min_hashes(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Signature of each non-empty set: VALUES numbers of 16 bits."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    result = np.zeros((len(starts), VALUES), np.uint16)
    if not len(starts):
        return result
    short = (mixed(tokens) >> U(32)).astype(np.uint32)
    for i in range(VALUES):
        least = np.minimum.reduceat((short ^ _SEEDS[i]) * _FACTORS[i], starts)
        result[:, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return result


def agreement(signatures: np.ndarray, one: np.ndarray) -> np.ndarray:
    """In how many values each signature equals one, or its own counterpart."""
    step = max(1, COMPARED_BYTES // VALUES)
    parts = [
        (signatures[i : i + step] == (one if one.ndim == 1 else one[i : i + step])).sum(axis=1)
        for i in range(0, len(signatures), step)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def clusters(signatures: np.ndarray, least: float) -> np.ndarray:
    """Number of each signature's cluster: its smallest member; links agree in that share of values."""
    label = np.full(len(signatures), -1)
    unseen = np.arange(len(signatures))
    while len(unseen):
        seed = unseen[0]
        label[seed], waiting, unseen = seed, [seed], unseen[1:]
        while waiting and len(unseen):
            near = agreement(signatures[unseen], signatures[waiting.pop()]) >= least * VALUES
            label[unseen[near]] = seed
            waiting.extend(unseen[near])
            unseen = unseen[~near]
    return label


def leaders(signatures: np.ndarray) -> np.ndarray:
    """For each signature an earlier one that it agrees with nearly everywhere, or itself."""
    leader = np.arange(len(signatures))
    left = np.arange(len(signatures))
    while len(left):
        first, left = left[0], left[1:]
        near = agreement(signatures[left], signatures[first]) >= FOLDED * VALUES
        leader[left[near]] = first
        left = left[~near]
    return leader


# --- the forest ------------------------------------------------------------------------------


def tree_entries(signatures: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Region at the smallest depth, and the deeper values as one number."""
    values = signatures[:, tree * DEPTH : (tree + 1) * DEPTH].astype(np.uint64)
    region = mixed(np.full(len(values), U(tree + 1)))
    for i in range(SHALLOW):
        region = mixed(region + values[:, i] * U(0x2545F4914F6CDD1D))
    deep = np.zeros(len(values), np.uint64)
    for i in range(SHALLOW, DEPTH):
        deep = (deep << U(16)) | values[:, i]
    return region, deep


def regions(region: np.ndarray, deep: np.ndarray, most: int) -> np.ndarray:
    """Where regions start in sorted entries; those above `most` are split by deeper values."""
    start = np.ones(len(region), bool)
    start[1:] = region[1:] != region[:-1]
    chosen = start.copy()
    for level in range(1, DEPTH - SHALLOW + 1):
        at = np.flatnonzero(chosen)
        large = np.repeat(np.diff(np.append(at, len(region))) > most, np.diff(np.append(at, len(region))))
        if not large.any():
            break
        head = deep >> U(16 * (DEPTH - SHALLOW - level))
        new = np.zeros(len(region), bool)
        new[1:] = head[1:] != head[:-1]
        chosen |= large & new
    return np.flatnonzero(chosen)


ENTRIES = "bucket int, a bigint, b bigint, payload binary"
MEMBERS = "region bigint, sets int, short bigint"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def signed_documents(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """key, n_shingles, node, its first half and the signature; the last three NULL for an empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "_text"):
            tokens, counts = shingle_sets(texts, n)
            node, some = set_nodes(tokens, counts), counts > 0
            signature = np.zeros((len(texts), VALUES), np.uint16)
            signature[some] = min_hashes(tokens, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.array([x.tobytes() for x in node], pa.binary(), mask=~some),
                    pa.array(node[:, 0].view(np.int64), mask=~some),
                    pa.array([x.tobytes() for x in signature], pa.binary(), mask=~some),
                ],
                names=[key, "n_shingles", "node", "short", "signature"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_shingles bigint, node binary, short bigint, signature binary"
    return docs.select(F.col(key), text_or_empty(text).alias("_text")).mapInArrow(sign, schema)


def planted(sets: DataFrame, buckets: int) -> DataFrame:
    """Entries of all trees, packed by bucket of their region, and edges (a, b) of folded sets."""

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())]
        return pa.RecordBatch.from_arrays(
            [none[0], _signed(a), _signed(b), none[1]], names=["bucket", "a", "b", "payload"]
        )

    def chunk(short: np.ndarray, signatures: np.ndarray) -> Iterator[pa.RecordBatch]:
        entries, folds = [], []
        for tree in range(TREES):
            region, deep = tree_entries(signatures, tree)
            order = np.lexsort((short, deep, region))
            starts = regions(region[order], deep[order], 0)
            sizes = np.diff(np.append(starts, len(order)))
            first = np.repeat(order[starts], sizes)
            other = np.flatnonzero(order != first)
            near = agreement(signatures[order[other]], signatures[first[other]]) >= FOLDED * VALUES
            folded = other[near]
            folds.append(np.stack([short[order[folded]], short[first[folded]]], axis=1))
            kept = np.delete(order, folded)
            entries.append(np.stack([region[kept], deep[kept], short[kept]], axis=1))
        pairs = np.unique(np.concatenate(folds), axis=0)
        if len(pairs):
            yield edges(pairs[:, 0], pairs[:, 1])
        every = np.concatenate(entries)
        bucket = (mixed(every[:, 0]) % U(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        starts = group_starts(bucket[order])
        payloads = [
            pack_arrays(*(every[part, i].copy() for i in range(3))) for part in np.split(order, starts[1:])
        ]
        none = pa.nulls(len(payloads), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[order][starts]), none, none, pa.array(payloads, pa.binary())],
            names=["bucket", "a", "b", "payload"],
        )

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            short = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
            held.append((short, raw.reshape(-1, VALUES)))
            if sum(len(s) for s, _ in held) >= SETS_PER_CHUNK:
                yield from chunk(*(np.concatenate(x) for x in zip(*held)))
                held = []
        if sum(len(s) for s, _ in held):
            yield from chunk(*(np.concatenate(x) for x in zip(*held)))

    return sets.select("short", "signature").mapInArrow(plant, ENTRIES)


def forest_regions(entries: DataFrame) -> DataFrame:
    """Members of all regions of two sets or more; regions of equal members have one number."""

    def meet(group: pa.Table) -> pa.Table:
        parts = [unpack_arrays(p) for p in group.column("payload").to_pylist()]
        region, deep, short = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((short, deep, region))
        region, deep, short = region[order], deep[order], short[order]
        starts = regions(region, deep, REGION_SETS)
        sizes = np.diff(np.append(starts, len(region)))
        number = mixed(np.add.reduceat(mixed(short), starts) + sizes.astype(np.uint64))
        several = np.repeat(sizes, sizes) > 1
        return pa.table(
            {
                "region": _signed(np.repeat(number, sizes)[several]),
                "sets": pa.array(np.repeat(sizes, sizes)[several].astype(np.int32)),
                "short": _signed(short[several]),
            }
        )

    packed = entries.filter("bucket IS NOT NULL").select("bucket", "payload")
    return packed.groupBy("bucket").applyInArrow(meet, MEMBERS).distinct()


def _matrix(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and signatures of a group, ordered by number, each number once."""
    short = group.column("short").to_numpy()
    raw = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(-1, VALUES)
    own, at = np.unique(short, return_index=True)
    return own, raw[at]


def candidate_edges(members: DataFrame, sets: DataFrame, work: Work) -> DataFrame:
    """Edges (a, b) that connect, within each region, the sets with similar signatures."""
    told = work.put(members.join(sets.select("short", "signature"), "short"), "regions")

    def compare(least: float):
        def body(group: pa.Table) -> pa.Table:
            short, signatures = _matrix(group)
            label = clusters(signatures, least)
            other = label != np.arange(len(label))
            return pa.table({"a": pa.array(short[other]), "b": pa.array(short[label[other]])})

        return body

    def fold(group: pa.Table) -> pa.Table:
        short, signatures = _matrix(group)
        leader = leaders(signatures)
        number = np.full(len(short), group.column("region")[0].as_py())
        return pa.table(
            {
                "region": pa.array(number, pa.int64()),
                "short": pa.array(short),
                "leader": pa.array(short[leader]),
                "signature": pa.array([x.tobytes() for x in signatures], pa.binary()),
            }
        )

    edge = "a bigint, b bigint"
    plain = told.filter(f"sets <= {PIECE_SETS}").groupBy("region").applyInArrow(compare(CANDIDATE), edge)
    pieces = F.ceil(F.col("sets") / PIECE_SETS).cast("int")
    large = told.filter(f"sets > {PIECE_SETS}").withColumn(
        "piece", F.pmod(F.xxhash64("short"), pieces).cast("int")
    )
    folded = work.put(
        large.groupBy("region", "piece").applyInArrow(
            fold, "region bigint, short bigint, leader bigint, signature binary"
        ),
        "folded",
    )
    left = folded.filter("short = leader").select("region", "short", "signature")
    sizes = left.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / PIECE_SETS).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("short", F.lit(1)), F.col("pieces")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    pairs = (
        left.join(sizes, "region")
        .withColumn("piece", piece)
        .withColumn("other", other)
        .withColumn("one", F.least("piece", "other"))
        .withColumn("two", F.greatest("piece", "other"))
    )
    crossed = pairs.groupBy("region", "one", "two").applyInArrow(compare(CANDIDATE - (1 - FOLDED)), edge)
    own = folded.filter("short <> leader").select(F.col("short").alias("a"), F.col("leader").alias("b"))
    return plain.union(own).union(crossed)


def near_duplicates(
    docs: DataFrame, key: str, text: str, work: Work, n: int = 5, part: int = 80, whole: int = 100
) -> DataFrame:
    """key, n_shingles, component_id (the smallest key reachable by links) and kept."""
    spark = docs.sparkSession
    signed = work.put(signed_documents(docs, key, text, n), "signed")
    sets = work.put(
        signed.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(F.first("short").alias("short"), F.first("signature").alias("signature")),
        "distinct",
    )
    buckets = max(parallelism(spark), -(-sets.count() * TREES // ENTRIES_PER_BUCKET))
    entries = work.put(planted(sets, buckets), "entries")
    members = work.put(forest_regions(entries), "members")
    folds = entries.filter("bucket IS NULL").select("a", "b")
    groups = components(folds.union(candidate_edges(members, sets, work)), work)
    nodes = signed.drop("signature")
    links = verified_links(docs, key, text, n, nodes, groups, part, whole, work)
    placed = smallest_keys(nodes, components(links, work), key, work)
    return placed.withColumn("kept", F.col(key) == F.col("component_id"))
