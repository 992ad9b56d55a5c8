"""Self join of documents by the Jaccard similarity of their word n-gram sets.

A set of s shingles and one of t, at least `part` of `whole` alike, differ in at most
H = (whole - part)(s + t) / (whole + part) shingles. The universe of shingles is hashed into m
segments, m by the band of the smaller set's size, so at least m - H segments are equal.

- Level 1 indexes each segment as a whole, unless it holds fewer than `least` shingles, which
  would match by chance. If a set keeps H + 1 segments or more, one of them is equal in every
  partner. Whether a segment is kept depends on its content alone, so both sides agree.
- Level 2 is paid only by sets that keep too few: half as many segments, each with all ways of
  deleting one shingle. A kept segment counts two, as it takes two differences to miss it.
- Level 3 is for sets still too short, mostly tiny ones: single shingles, the smallest ones by
  hash, as many as any partner must share one of.

A pair is found as soon as one of the two is long enough at a level both use, so no link is
lost. `allocation` chooses the segment width and `least` from the expected number of kept
segments per shingle.

Sets that meet in a segment only decide which sets are verified together. A common line may
connect any share of the table so, hence a group beyond one chunk is formed anew by prefixes: with
the shingles ordered from rare to frequent, two sets that link share one of their first
s - ceil(s * part / whole) + 1. The FREQUENT most frequent shingles come last in that order, the
others by hash; the order is the same for all sets, so no link is lost.

Each chunk of a candidate group is compared by exact intersection sizes, until it is one cluster
or all is compared; the chunks share the group's first set, and only sets not connected to it are
sent to the other chunks. Links are joined to components over the whole table.

Documents with equal sets share a node, so copies never meet each other; segments are reduced to
one row per task before they are shuffled. Shingles are 64-bit hashes, nodes 128-bit.

Signatures go from the task that makes them to the bucket where they meet and are not written as
a table. Groups and the sets' shingles are deleted as soon as the step that reads them is written;
the result reads a few numbers per document.

Cases: NULL or empty text has no shingles and links with nothing. Fewer words than n make one
shingle. Repeated rows and repeated or NULL ids are each kept. An empty table gives an empty
result. Columns of the input with the name of a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

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
    spread,
    text_chunks,
    text_or_empty,
    unpack_arrays,
)
from turnloom.llm.graph import components, skew_join, smallest_keys
from turnloom.llm.words import split_words

SIGNATURES_PER_ROW = 1 << 21
SHINGLES_PER_BUCKET = 20_000_000
SHINGLES_PER_CHUNK = 1_000_000
# Shingles of large groups with so many sets count as frequent, and so many of them are sent to all tasks.
LEAST_FREQUENT, FREQUENT = 16, 1 << 18
U = np.uint64


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text as sorted hashes, all in one array, and their counts."""
    words = split_words(texts)
    hashes = words.hashes()
    per_text = words.per_text()
    whole = per_text >= n
    count = np.where(whole, per_text - n + 1, np.minimum(per_text, 1))
    width = np.minimum(per_text, n)
    first = spread(np.cumsum(per_text) - per_text, count)
    owner = np.repeat(np.arange(len(texts)), count)
    width = width[owner]
    value = np.full(len(first), U(0x51ED270B0A1F39C1)) + width.astype(np.uint64)
    for i in range(n):
        has = width > i
        at = np.minimum(first + i, max(0, len(hashes) - 1))
        value = np.where(has, mixed(value * U(0x2545F4914F6CDD1D) + hashes[at]), value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts))


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum modulo 2^64 of each run of `counts` values."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


# --- signatures ------------------------------------------------------------------------------


def allocation(part: int, whole: int) -> tuple[float, int]:
    """Mean shingles per segment and the least size of an indexed segment.

    A set must keep (whole - part) / part of its size as segments. With a mean of x shingles
    per segment the share of segments with `least` or more follows Poisson's law. The largest
    `least` and x that leave a tenth to spare are the cheapest: fewest and rarest signatures.
    """
    need = 1.1 * (whole - part) / part
    for least in (3, 2, 1):
        for tenths in range(120, 4, -1):
            x = tenths / 10
            kept = 1 - sum(math.exp(-x) * x**i / math.factorial(i) for i in range(least))
            if kept / x >= need:
                return x, least
    return 0.5, 1


@dataclass(frozen=True)
class Scheme:
    part: int
    whole: int
    low: np.ndarray  # smallest size of each band
    segments: np.ndarray  # level 1 segments of each band
    least: int

    @staticmethod
    def of(part: int, whole: int, largest: int) -> Scheme:
        mean, least = allocation(part, whole)
        low = [1]
        while low[-1] <= largest:
            low.append(max(low[-1] + 1, math.ceil(low[-1] * (whole / part) ** 2)))
        low_ = np.array(low, np.int64)
        high = np.append(low_[1:] - 1, low_[-1])
        most = (whole - part) * (high + high * whole // part) // (whole + part)
        segments = np.maximum(np.ceil(high / mean).astype(np.int64), most + 1)
        return Scheme(part, whole, low_, segments, least)

    def band(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, "right") - 1

    def most_apart(self, size: np.ndarray, other: np.ndarray) -> np.ndarray:
        return (self.whole - self.part) * (size + other) // (self.whole + self.part)


def _segments(
    tokens: np.ndarray, counts: np.ndarray, m: np.ndarray, salt: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Non-empty segments of each set: set, seed, size, sum; and the tokens in segment order."""
    owner = np.repeat(np.arange(len(counts)), counts)
    at = (mixed(tokens ^ salt[owner]) % m[owner].astype(np.uint64)).astype(np.int64)
    key = (np.cumsum(m) - m)[owner] + at
    order = np.argsort(key, kind="stable")
    key, tokens = key[order], mixed(tokens[order])
    starts = group_starts(key)
    size = np.diff(np.append(starts, len(key)))
    owner, at = owner[order][starts], at[order][starts]
    seed = mixed(salt[owner] + at.astype(np.uint64) * U(0x9FB21C651E98DF25))
    return owner, seed, size, sums(tokens, size), tokens


def signatures(
    scheme: Scheme, tokens: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and the set that each belongs to."""
    band = scheme.band(counts)
    below = (counts > 0) & (band > 0) & (-(-counts * scheme.part // scheme.whole) < scheme.low[band])
    start = np.cumsum(counts) - counts
    found: list[tuple[np.ndarray, np.ndarray]] = []
    tiny: list[np.ndarray] = []
    for lower in (0, 1):
        sets = np.flatnonzero(below if lower else counts > 0)
        if not len(sets):
            continue
        size, at = counts[sets], band[sets] - lower
        if lower:
            other = np.minimum(size, scheme.low[at + 1] - 1)
        else:
            other = size * scheme.whole // scheme.part
        apart = scheme.most_apart(size, other)

        def taken(some: np.ndarray) -> np.ndarray:
            return tokens[spread(start[sets[some]], size[some])]

        # level 1
        some = np.arange(len(sets))
        salt = mixed(at.astype(np.uint64) * U(2) + U(1))
        owner, seed, width, total, _ = _segments(
            taken(some), size, scheme.segments[at], salt
        )
        kept = width >= scheme.least
        found.append((mixed(total[kept] ^ seed[kept]), sets[owner[kept]]))
        some = np.flatnonzero(np.bincount(owner[kept], minlength=len(sets)) <= apart)
        if not len(some):
            continue
        # level 2
        least = max(1, scheme.least - 1)
        owner, seed, width, total, inside = _segments(
            taken(some),
            size[some],
            (scheme.segments[at[some]] + 1) // 2,
            mixed(at[some].astype(np.uint64) * U(2) + U(1 << 40)),
        )
        good = np.bincount(owner[width > least], minlength=len(some))
        kept = width >= least
        found.append((mixed(total[kept] ^ seed[kept]), sets[some[owner[kept]]]))
        one_less = np.repeat(np.arange(len(width)), width)
        keep = width[one_less] > least
        one_less, gone = one_less[keep], inside[keep]
        found.append(
            (mixed((total[one_less] - gone) ^ seed[one_less]), sets[some[owner[one_less]]])
        )
        tiny.append(sets[some[2 * good <= apart[some]]])
    if tiny:  # level 3
        sets = np.unique(np.concatenate(tiny))
        size = counts[sets]
        first = size - -(-size * scheme.part // scheme.whole) + 1
        found.append((mixed(tokens[spread(start[sets], first)]), np.repeat(sets, first)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))  # type: ignore[return-value]


def _stars(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per signature with its smallest node, and links of the other nodes to it."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    starts = group_starts(sig)
    smallest = np.repeat(node[starts], np.diff(np.append(starts, len(sig))))
    apart = node != smallest
    links = np.unique(np.stack([node[apart], smallest[apart]], axis=1), axis=0)
    return sig[starts], node[starts], links


# --- the plan --------------------------------------------------------------------------------

NODES = "n_shingles bigint, node binary, short bigint"
FOUND, LINKS_PER_ROW = "bucket int, payload binary", 1 << 16


def _bytes(values: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(values).tobytes()
    width = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def set_nodes(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 128-bit number of each set, in two columns."""
    one = mixed(sums(mixed(tokens), counts) + counts.astype(np.uint64))
    two = mixed(sums(mixed(tokens ^ U(0xA24BAED4963EE407)), counts))
    return np.stack([one, two], axis=1)


def document_nodes(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """key, n_shingles, node and its first half; node is NULL for an empty set."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "_text"):
            tokens, counts = shingle_sets(texts, n)
            node = set_nodes(tokens, counts)
            empty = counts == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.array(_bytes(node), pa.binary(), mask=empty),
                    pa.array(node[:, 0].view(np.int64), mask=empty),
                ],
                names=[key, "n_shingles", "node", "short"],
            )

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {NODES}"
    return docs.select(F.col(key), text_or_empty(text).alias("_text")).mapInArrow(nodes, schema)


def _reduced(sig: np.ndarray, node: np.ndarray, buckets: int) -> pa.RecordBatch:
    """By bucket one entry for each of a task's signatures, and the links of its own nodes."""
    sig, node, links = _stars(sig, node)
    bucket = (mixed(sig) % U(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = group_starts(bucket)
    to, payloads = bucket[starts].tolist(), []
    for part in np.split(order, starts[1:]):
        own, at = np.unique(node[part], return_inverse=True)
        index = at.astype(np.uint16 if len(own) < 1 << 16 else np.uint32)
        head = (sig[part] >> U(32)).astype(np.uint32)
        tail = (sig[part] >> U(16)).astype(np.uint16)
        payloads.append(pack_arrays(head, tail, index, own))
    for first in range(0, len(links), LINKS_PER_ROW):  # these may meet anywhere
        some = links[first : first + LINKS_PER_ROW]
        to.append(int(mixed(some[:1, 0])[0] % U(buckets)))
        payloads.append(pack_arrays(some[:, 0], some[:, 1]))
    return pa.RecordBatch.from_arrays(
        [pa.array(to, pa.int32()), pa.array(payloads, pa.binary())], names=["bucket", "payload"]
    )


def _meet(group: pa.Table) -> pa.Table:
    sent = [unpack_arrays(p) for p in group.column("payload").to_pylist()]
    found = [
        ((head.astype(np.uint64) << U(16)) | tail.astype(np.uint64), own[index])
        for head, tail, index, own in (x for x in sent if len(x) == 4)
    ]
    links = [np.stack(x, axis=1) for x in sent if len(x) == 2]
    if found:
        links.append(_stars(*(np.concatenate(x) for x in zip(*found)))[2])
    a, b = (np.concatenate([x[:, i] for x in links]).view(np.int64) for i in (0, 1))
    return pa.table({"a": a, "b": b})


def candidate_task(n: int, scheme: Scheme, buckets: int) -> Callable:
    """The step that sends the signatures of sets, by hash, to a bucket.

    A task first reduces its own signatures to one entry each; only in a bucket, by `_meet`, are
    they compared with the entries of other tasks.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0
        for _, texts in text_chunks(batches, "_text"):
            tokens, counts = shingle_sets(texts, n)
            sig, owner = signatures(scheme, tokens, counts)
            waiting.append((sig, set_nodes(tokens, counts)[:, 0][owner]))
            total += len(sig)
            if total >= SIGNATURES_PER_ROW:
                yield _reduced(*(np.concatenate(x) for x in zip(*waiting)), buckets)
                waiting, total = [], 0
        if total:
            yield _reduced(*(np.concatenate(x) for x in zip(*waiting)), buckets)

    return emit


def link_documents(
    docs: DataFrame,
    key: str,
    text: str,
    work: Work,
    n: int = 5,
    part: int = 80,
    whole: int = 100,
) -> DataFrame:
    """Add n_shingles and component_id, the smallest key reachable by links, to key."""
    spark = docs.sparkSession
    nodes = work.put(document_nodes(docs, key, text, n), "nodes")
    row = nodes.agg(F.max("n_shingles").alias("m"), F.sum("n_shingles").alias("s")).first()
    scheme = Scheme.of(part, whole, int(row["m"] or 1))
    buckets = max(parallelism(spark), math.ceil((row["s"] or 0) / SHINGLES_PER_BUCKET))
    with work.passing() as steps:
        groups = candidate_groups(docs, text, n, scheme, buckets, steps)
        links = verified_links(docs, key, text, n, nodes, groups, part, whole, steps)
        roots = work.put(components(links, steps), "roots")
    return smallest_keys(nodes, roots, key, work)


def candidate_groups(
    docs: DataFrame, text: str, n: int, scheme: Scheme, buckets: int, work: Work
) -> DataFrame:
    """(node, root) of the short nodes that signatures connect."""
    texts = docs.select(text_or_empty(text).alias("_text"))
    found = texts.mapInArrow(candidate_task(n, scheme, buckets), FOUND)
    with work.passing() as steps:
        return work.put(_closed(found, steps), "groups")


def _closed(found: DataFrame, work: Work) -> DataFrame:
    """(node, root) of the nodes whose entries meet in buckets; what is found is read once."""
    return components(found.groupBy("bucket").applyInArrow(_meet, "a bigint, b bigint"), work)


def _sets_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a batch's sets in one array, and their counts."""
    raw = batch.column("tokens").to_pylist()
    counts = np.array([len(t) // 8 for t in raw], np.int64)
    return np.frombuffer(b"".join(raw), np.uint64), counts


def frequent_shingles(members: DataFrame, buckets: int, work: Work) -> np.ndarray:
    """The most frequent shingles of the sets, at most FREQUENT, from rare to frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        total = 0

        def sent() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(waiting), return_counts=True)
            bucket = (mixed(value) % U(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            starts = group_starts(bucket[order])
            parts = np.split(order, starts[1:])
            payloads = [pack_arrays(value[p], n[p].astype(np.uint32)) for p in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[order][starts]), pa.array(payloads, pa.binary())],
                names=["bucket", "payload"],
            )

        for batch in batches:
            waiting.append(_sets_of(batch)[0])
            total += len(waiting[-1])
            if total >= SIGNATURES_PER_ROW:
                yield sent()
                waiting, total = [], 0
        if total:
            yield sent()

    def add(group: pa.Table) -> pa.Table:
        parts = [unpack_arrays(p) for p in group.column("payload").to_pylist()]
        value, n = (np.concatenate(x) for x in zip(*parts))
        value, place = np.unique(value, return_inverse=True)
        total = np.bincount(place, n).astype(np.int64)
        some = total >= LEAST_FREQUENT
        return pa.table({"value": value[some].view(np.int64), "n": total[some]})

    counted = work.put(
        members.select("tokens")
        .mapInArrow(count, "bucket int, payload binary")
        .groupBy("bucket")
        .applyInArrow(add, "value bigint, n bigint"),
        "frequent",
    )
    band = F.floor(8 * F.log2("n")).alias("band")
    least, total = None, 0
    for row in sorted(counted.groupBy(band).count().collect(), reverse=True):
        total += row["count"]
        if total > FREQUENT:
            break
        least = row["band"]
    chosen = counted.filter(F.lit(False) if least is None else band >= least).toArrow()
    value, n = (chosen.column(c).to_numpy() for c in ("value", "n"))
    return value.view(np.uint64)[np.lexsort((value, n))]


def prefix_groups(
    members: DataFrame, part: int, whole: int, buckets: int, work: Work
) -> DataFrame:
    """(node, root) of the short nodes of sets (short, root, tokens) whose prefixes connect them."""
    frequent = frequent_shingles(members, buckets, work)
    rank = np.argsort(frequent).astype(np.uint32)  # of the values in their own order
    frequent = frequent[rank]

    def prefixes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        tokens, counts = _sets_of(batch)
        owner = np.repeat(np.arange(len(counts)), counts)
        place = np.zeros(len(tokens), np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
            place = np.where(frequent[at] == tokens, rank[at].astype(np.int64) + 1, 0)
        tokens = tokens[np.lexsort((tokens, place, owner))]
        first = counts - -(-counts * part // whole) + 1
        chosen = spread(np.cumsum(counts) - counts, first)
        owner = owner[chosen]
        root, node = (batch.column(c).to_numpy().view(np.uint64) for c in ("root", "short"))
        return mixed(tokens[chosen] ^ mixed(root)[owner]), node[owner]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(prefixes(batch))
            total += len(waiting[-1][0])
            if total >= SIGNATURES_PER_ROW:
                yield _reduced(*(np.concatenate(x) for x in zip(*waiting)), buckets)
                waiting, total = [], 0
        if total:
            yield _reduced(*(np.concatenate(x) for x in zip(*waiting)), buckets)

    return _closed(members.select("short", "root", "tokens").mapInArrow(emit, FOUND), work)


def verified_links(
    docs: DataFrame,
    key: str,
    text: str,
    n: int,
    nodes: DataFrame,
    groups: DataFrame,
    part: int,
    whole: int,
    work: Work,
) -> DataFrame:
    """Links (a, b) of nodes that connect whatever links connect within each candidate group."""
    firsts = (
        nodes.filter("node IS NOT NULL")
        .groupBy("node", "short", "n_shingles")
        .agg(F.min(key).alias(key))
        .join(groups.withColumnRenamed("node", "short"), "short")
    )
    sizes = firsts.groupBy("root").agg(
        F.count(F.lit(1)).alias("sets"),
        (F.sum("n_shingles") > SHINGLES_PER_CHUNK).alias("large"),
    )
    chosen = firsts.join(sizes.filter("sets > 1"), "root").select(
        key, "node", "short", "root", "large"
    )

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "_text"):
            tokens, counts = shingle_sets(texts, n)
            same = np.array(_bytes(set_nodes(tokens, counts)), object) == np.array(
                batch.column("node").to_pylist(), object
            )
            ends = 8 * np.cumsum(counts)
            raw = tokens.tobytes()
            sets = pa.array([raw[e - 8 * c : e] for e, c in zip(ends, counts)], pa.binary())
            kept = batch.drop_columns(["_text"]).append_column("tokens", sets)
            yield kept.filter(pa.array(same.astype(bool)))

    texts = docs.select(F.col(key), text_or_empty(text).alias("_text"))
    found = work.put(
        texts.join(chosen, key)
        .drop(key)
        .mapInArrow(
            tokens_of, "node binary, short bigint, root bigint, large boolean, tokens binary"
        ),
        "sets",
    )
    members = found.filter("NOT large").select(
        "node",
        "root",
        F.lit(1).alias("chunks"),
        F.lit(None).cast("binary").alias("hub"),
        "tokens",
        F.lit(0).alias("chunk"),
    )
    large = found.filter("large")
    if not large.isEmpty():
        members = members.unionByName(_regrouped(large, part, whole, work))
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    hubs = members.filter("node = hub AND chunks > 1").withColumn("chunk", every)
    shared = members.unionByName(hubs)

    def connect(group: pa.Table) -> pa.Table:
        return _connected(group, part, whole)

    first = work.put(
        shared.groupBy("root", "chunk").applyInArrow(
            connect, "root bigint, chunk int, node binary, label binary, joined boolean"
        ),
        "clusters",
    )
    # Sets that their chunk does not connect to the group's hub meet all other chunks.
    alone = first.filter("NOT joined").select("root", "chunk", "node")
    left = members.filter("chunks > 1").join(alone, ["root", "chunk", "node"])
    per_piece = left.groupBy("root").agg(
        F.ceil(F.sum(F.octet_length("tokens")) / F.lit(8 * SHINGLES_PER_CHUNK)).cast("int").alias("pieces")
    )
    guests = (
        left.join(per_piece, "root")
        .withColumn("piece", F.pmod(F.xxhash64("node", F.lit(1)), F.col("pieces")).cast("int"))
        .withColumn("home", F.col("chunk"))
        .withColumn("chunk", every)
        .filter("chunk <> home")
        .select("root", "chunk", "piece", "node", "tokens", F.lit(None).cast("binary").alias("label"))
    )
    pieces = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    hosts = (
        members.join(per_piece, "root")
        .join(first.drop("joined"), ["root", "chunk", "node"])
        .select("root", "chunk", pieces.alias("piece"), "node", "tokens", "label")
    )

    def visit(group: pa.Table) -> pa.Table:
        return _visited(group, part, whole)

    second = (
        guests.unionByName(hosts)
        .groupBy("root", "chunk", "piece")
        .applyInArrow(visit, "a binary, b binary")
    )
    return first.select(F.col("node").alias("a"), F.col("label").alias("b")).union(second)


def _regrouped(large: DataFrame, part: int, whole: int, work: Work) -> DataFrame:
    """The sets of large groups in the smaller groups that their prefixes form, dealt to chunks."""
    buckets = max(
        parallelism(large.sparkSession),
        math.ceil(large.agg(F.sum(F.octet_length("tokens"))).first()[0] / (8 * SHINGLES_PER_BUCKET)),
    )
    with work.passing() as steps:
        smaller = prefix_groups(large, part, whole, buckets, steps)
        groups = work.put(smaller.withColumnRenamed("node", "short"), "regrouped")
    sizes = large.groupBy("node", "short").agg(F.max(F.octet_length("tokens")).alias("bytes"))
    named = work.put(sizes.join(groups, "short").select("node", "root", "bytes"), "named")
    chunks = F.ceil(F.sum("bytes") / F.lit(8 * SHINGLES_PER_CHUNK)).cast("int")
    hubs = named.groupBy("root").agg(chunks.alias("chunks"), F.min("node").alias("hub"))
    dealt = skew_join(named.drop("bytes"), work.put(hubs, "hubs"), "root").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    )
    return work.put(
        large.select("node", "tokens")
        .join(dealt, "node")
        .select("node", "root", "chunks", "hub", "tokens", "chunk"),
        "placed",
    )


class _Sets:
    """Exact intersection sizes of one set with all sets of a group, by an inverted list."""

    def __init__(self, tokens: list[bytes], part: int, whole: int) -> None:
        self.sets = [np.frombuffer(t, np.uint64) for t in tokens]
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.part, self.whole = part, whole
        every = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.value = every[order]
        self.owner = np.repeat(np.arange(len(self.sets)), self.size)[order]

    def like(self, tokens: np.ndarray) -> np.ndarray:
        first = np.searchsorted(self.value, tokens, "left")
        count = np.searchsorted(self.value, tokens, "right") - first
        common = np.bincount(self.owner[spread(first, count)], minlength=len(self.size))
        union = self.size + len(tokens) - common
        return np.flatnonzero(self.whole * common >= self.part * union)


def _connected(group: pa.Table, part: int, whole: int) -> pa.Table:
    """A label for each cluster of a chunk, and whether it is the hub's cluster."""
    frame = group.to_pandas().drop_duplicates("node").sort_values("node", ignore_index=True)
    sets = _Sets(list(frame["tokens"]), part, whole)
    nodes, hub = list(frame["node"]), frame["hub"].iloc[0]
    label, unseen = np.full(len(nodes), -1), len(nodes)
    start = nodes.index(hub) if hub in nodes else 0
    for seed in [start, *range(len(nodes))]:
        if label[seed] >= 0:
            continue
        label[seed], waiting = seed, [seed]
        unseen -= 1
        while waiting and unseen:
            near = sets.like(sets.sets[waiting.pop()])
            new = near[label[near] < 0]
            label[new] = seed
            unseen -= len(new)
            waiting.extend(new)
    return pa.table(
        {
            "root": pa.array(frame["root"], pa.int64()),
            "chunk": pa.array(frame["chunk"], pa.int32()),
            "node": pa.array(nodes, pa.binary()),
            "label": pa.array([nodes[i] for i in label], pa.binary()),
            "joined": pa.array(label == start),
        }
    )


def _visited(group: pa.Table, part: int, whole: int) -> pa.Table:
    """A link from each set that came from another chunk to each cluster here that is like it."""
    frame = group.to_pandas()
    here = frame["label"].notna()
    hosts, guests = frame[here], frame[~here]
    sets = _Sets(list(hosts["tokens"]), part, whole)
    labels = hosts["label"].to_numpy(object)
    a, b = [], []
    for node, tokens in zip(guests["node"], guests["tokens"]):
        near = set(labels[sets.like(np.frombuffer(tokens, np.uint64))])
        a += [node] * len(near)
        b += near
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
