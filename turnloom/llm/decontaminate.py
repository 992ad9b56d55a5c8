"""Benchmark items in documents by latent semantic retrieval and alignment.

1. Words are hashed to TERMS terms. How many 16-word steps hold each term is counted over all
   documents and gives the inverse document frequencies; the mean passage is added up with it.
2. The latent space is the span of the leading right singular vectors of the passages' TF-IDF
   matrix A, found by a randomised subspace iteration: every task adds up its part of
   A'(A W) for a random W, the parts are added term by term, and the orthonormal basis of the
   sum is rotated and scaled with the small matrix (AQ)'(AQ), added up likewise. Passages are
   centred and scaled by the singular values. A has every passage of every document, copies
   included; it is never built: rows of W are added up by passage, and the results by term.
3. Passages of all documents, 32 words every 16, are compared with the passages of all items.
   A pair with a cosine of COSINE or more is a candidate; less is asked, down to LEAST_COSINE,
   for an item's passage that is shorter than the document's.
4. For a candidate the longest common subsequence of words of the item and of the document's
   words around the passage is computed exactly. An item is found if it makes up LCS_SHARE of
   the item's words, or LCS_LOW of them while the item's answer is there word for word. The
   answer is the column `answer` if there is one, else the item's last sentence.

What is sent to tasks is the basis, TERMS x RANK numbers, and the items, ITEMS_PER_PASS at a
time; more items take more passes over the documents.

Cases: NULL or empty texts and items match nothing. Items shorter than SHORTEST words are
compared like others but need all their words in order. Repeated documents and items are
reported each. Without documents or items the result is empty. Other columns than the keys are
left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import Work, group_starts, mixed, text_chunks, text_or_empty
from turnloom.llm.words import Words, split_words

TERMS, RANK, SPARE_RANK = 4096, 64, 8
STEP, PASSAGE = 16, 32
# Tasks' arrays are added this many at a time.
TREE = 256
COSINE, PART_COSINE, LEAST_COSINE = 0.5, 0.6, 0.36
LCS_SHARE, LCS_LOW, SHORTEST = 0.7, 0.5, 8
ITEMS_PER_PASS = 5_000
ROW_TERMS = 64


def terms_of(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) % np.uint64(TERMS)).astype(np.int64)


def step_starts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of each run of STEP words; the last run of a text may be shorter."""
    per_text = words.per_text()
    steps = -(-per_text // STEP)
    text = np.repeat(np.arange(len(per_text)), steps)
    place = np.arange(len(text)) - np.repeat(np.cumsum(steps) - steps, steps)
    return (np.cumsum(per_text) - per_text)[text] + place * STEP, text


def passage_sums(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Each step's values added to those of the next step of its text."""
    result = values.copy()
    same = np.flatnonzero(text[1:] == text[:-1])
    result[same] += values[same + 1]
    return result


def run_sums(rows: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows[index] over runs of at most STEP entries, which begin at `first`."""
    place = np.full((len(first), STEP), len(rows))
    place[np.arange(STEP) < np.diff(np.append(first, len(index)))[:, None]] = index
    rows = np.concatenate([rows, np.zeros_like(rows, shape=(1, rows.shape[1]))])
    total = np.zeros((len(first), rows.shape[1]), rows.dtype)
    # a few hundred runs at a time stay in the processor's cache
    some = np.empty((512, rows.shape[1]), rows.dtype)
    for at in range(0, len(first), 512):
        part, of_part = total[at : at + 512], place[at : at + 512]
        for i in range(STEP):
            part += np.take(rows, of_part[:, i], axis=0, out=some[: len(part)], mode="clip")
    return total


def term_rows(terms: np.ndarray, first: np.ndarray, text: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the rows of each passage's terms."""
    return passage_sums(run_sums(rows, terms, first), text)


def add_to_terms(
    total: np.ndarray, terms: np.ndarray, first: np.ndarray, text: np.ndarray, values: np.ndarray
) -> None:
    """Adds each passage's row of values to the row of each of its terms."""
    if not len(terms):
        return
    # a step is in its own passage and in the one before
    each = values.copy()
    same = np.flatnonzero(text[1:] == text[:-1])
    each[same + 1] += values[same]
    order = np.argsort(terms.astype(np.uint16), kind="stable")
    step = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(terms))))[order]
    starts = group_starts(terms[order])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    begins = np.flatnonzero(place % STEP == 0)
    owner = terms[order[begins]]
    of_term = group_starts(owner)
    total[owner[of_term]] += np.add.reduceat(run_sums(each, step, begins), of_term, axis=0)


@dataclass(frozen=True)
class Space:
    """idf-weighted, centred and scaled basis: a row per term."""

    basis: np.ndarray

    def passages(
        self, words: Words, hashes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit latent vectors of all passages, their first words and texts."""
        first, text = step_starts(words)
        latent = term_rows(terms_of(hashes), first, text, self.basis)
        norm = np.sqrt((latent * latent).sum(axis=1, keepdims=True))
        return latent / np.maximum(norm, 1e-9), first, text


def _sum_rows(parts: DataFrame) -> np.ndarray:
    """Adds arrays that tasks sent in numbered pieces; their number does not grow with the data."""

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v, np.float64) for v in group.column("value").to_pylist()], axis=0)
        return pa.table({"piece": group.column("piece")[:1], "value": pa.array([total.tobytes()], pa.binary())})

    branch = F.expr(f"spark_partition_id() div {TREE}")
    some = parts.withColumn("branch", branch).groupBy("piece", "branch").applyInArrow(add, PIECES)
    rows = some.groupBy("piece").applyInArrow(add, PIECES).collect()
    if not rows:
        return np.zeros(0)
    return np.concatenate([np.frombuffer(r["value"]) for r in sorted(rows, key=lambda r: r["piece"])])


def _pieces(array: np.ndarray, count: int) -> pa.RecordBatch:
    parts = np.array_split(np.asarray(array, np.float64).ravel(), count)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(count), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
        names=["piece", "value"],
    )


PIECES = "piece int, value binary"


def steps_with_term(terms: np.ndarray, first: np.ndarray) -> np.ndarray:
    """In how many steps each term occurs."""
    step = np.zeros(len(terms), np.int32)
    step[first[1:]] = 1
    step = np.cumsum(step, dtype=np.int32)
    order = np.argsort(terms.astype(np.uint16), kind="stable")
    term, step = terms[order], step[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (step[1:] != step[:-1])
    return np.bincount(term[new], minlength=TERMS)


def term_statistics(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """idf of every term over all steps of all documents, its mean number in a passage, passages.

    A passage starts with every step, so there are as many of both.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, TERMS))
        for _, chunk in text_chunks(batches, "_text"):
            words = split_words(chunk)
            terms, (first, text) = terms_of(words.hashes()), step_starts(words)
            total[0] += steps_with_term(terms, first)
            # a step is in its own passage and, but for a text's first one, in the one before
            times = np.ones(len(first))
            times[1:] += text[1:] == text[:-1]
            each = np.repeat(times, np.diff(np.append(first, len(terms))))
            total[1] += np.bincount(terms, each, TERMS)
            total[2, 0] += len(first)
        yield _pieces(total, 1)

    total = _sum_rows(texts.mapInArrow(count, PIECES))
    if not len(total):
        return np.zeros(TERMS), np.zeros(TERMS), 0
    within, times, (passages, *_) = total.reshape(3, TERMS)
    return np.log((passages + 1) / (within + 1)), times / max(1.0, passages), int(passages)


def fit_space(texts: DataFrame) -> Space | None:
    idf, mean, count = term_statistics(texts)
    if not count:
        return None
    centre = idf * mean
    width = RANK + SPARE_RANK
    start = np.random.default_rng(17).standard_normal((TERMS, width))

    def projected(
        batches: Iterator[pa.RecordBatch], rows: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Terms, steps and texts of each chunk, and its centred passages times the rows."""
        weighted, shift = (idf[:, None] * rows).astype(np.float32), (centre @ rows).astype(np.float32)
        for _, chunk in text_chunks(batches, "_text"):
            words = split_words(chunk)
            terms, (first, text) = terms_of(words.hashes()), step_starts(words)
            yield terms, first, text, term_rows(terms, first, text, weighted) - shift

    def iterate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, summed = np.zeros((TERMS, width)), np.zeros(width)
        for terms, first, text, y in projected(batches, start):
            add_to_terms(total, terms, first, text, y)
            summed += y.sum(axis=0, dtype=np.float64)
        yield _pieces(idf[:, None] * total - np.outer(centre, summed), TERMS // ROW_TERMS)

    spread_ = _sum_rows(texts.mapInArrow(iterate, PIECES)).reshape(TERMS, width)
    basis = np.linalg.qr(spread_)[0]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for *_, y in projected(batches, basis):
            total += y.T @ y
        yield _pieces(total, 1)

    small = _sum_rows(texts.mapInArrow(project, PIECES)).reshape(width, width)
    value, vector = np.linalg.eigh(small)
    best = np.argsort(value)[::-1][:RANK]
    scale = 1 / np.sqrt(np.maximum(value[best], 1e-6 * max(value.max(), 1e-12)))
    rotated = basis @ vector[:, best] * scale
    # A passage's centre follows its number of words: the mean per word is taken from each term.
    words = max(1.0, float(mean[idf > 0].sum()))
    weighted = idf[:, None] * rotated - (centre @ rotated / words)[None, :]
    return Space(weighted.astype(np.float32))


# --- alignment -------------------------------------------------------------------------------


def common_subsequence(pattern: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, with one bit per word of the pattern."""
    masks: dict[int, int] = {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    row = full
    for word in text:
        hit = row & masks.get(word, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(pattern) - row.bit_count()


def _inside(part: list[int], whole: list[int]) -> bool:
    n = len(part)
    return n > 0 and any(whole[i : i + n] == part for i in range(len(whole) - n + 1))


@dataclass(frozen=True)
class Items:
    words: list[list[int]]
    answers: list[list[int]]
    latent: np.ndarray
    owner: np.ndarray
    distinct: list[frozenset[int]]
    least: np.ndarray


def _hashed(words: Words, hashes: np.ndarray) -> list[list[int]]:
    ends = np.cumsum(words.per_text())
    hashed = hashes.tolist()
    return [hashed[e - n : e] for e, n in zip(ends, words.per_text())]


def prepare_items(texts: list[str], answers: list[str | None], space: Space) -> Items:
    split = split_words([t.encode() for t in texts])
    hashes = split.hashes()
    last = [re.split(r"(?<=[.!?])\s+|\n+", t.strip())[-1] for t in texts]
    given = split_words([(a if a is not None else s).encode() for a, s in zip(answers, last)])
    latent, first, owner = space.passages(split, hashes)
    words = _hashed(split, hashes)
    ends = np.cumsum([len(w) for w in words])
    # The end of an item is in its last full passage too. An item shorter than a passage fills
    # only a part of any passage that holds it.
    filled = np.minimum(PASSAGE, ends[owner] - first) / PASSAGE
    starts = np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]
    kept = starts | (filled == 1)
    latent, owner, filled = latent[kept], owner[kept], filled[kept]
    least = np.where(filled == 1, COSINE, np.maximum(LEAST_COSINE, PART_COSINE * np.sqrt(filled)))
    return Items(words, _hashed(given, given.hashes()), latent, owner, [frozenset(w) for w in words], least.astype(np.float32))


def align(item: list[int], answer: list[int], near: list[int]) -> tuple[float, bool]:
    """Share of the item's words in common order, and whether the answer is there."""
    return common_subsequence(item, near) / len(item), _inside(answer, near)


def found_items(
    texts: list[bytes], space: Space, items: Items
) -> Iterator[tuple[int, int, float, float, bool, int]]:
    """Text, item, cosine, shared part, answer found, first word of the passage; best per pair."""
    words = split_words(texts)
    hashed = words.hashes()
    latent, first, text = space.passages(words, hashed)
    if not len(first):
        return
    ends = np.cumsum(words.per_text())
    starts = ends - words.per_text()
    best: dict[tuple[int, int], tuple] = {}
    for at in range(0, len(first), 4096):
        likeness = latent[at : at + 4096] @ items.latent.T
        for i, k in zip(*np.nonzero(likeness >= items.least)):
            passage, item = at + i, int(items.owner[k])
            own, answer, t = items.words[item], items.answers[item], int(text[passage])
            low = max(int(starts[t]), int(first[passage]) - len(own))
            high = min(int(ends[t]), int(first[passage]) + PASSAGE + len(own))
            near = hashed[low:high].tolist()
            distinct = items.distinct[item]
            # words that are not there at all cannot be in a common subsequence
            if len(own) - len(distinct) + len(distinct.intersection(near)) < LCS_LOW * len(own):
                continue
            share, there = align(own, answer, near)
            needed = 1.0 if len(own) < SHORTEST else LCS_LOW if there else LCS_SHARE
            if share >= needed:
                value = (share, there, float(likeness[i, k]), -int(first[passage] - starts[t]))
                best[t, item] = max(best.get((t, item), value), value)
    for (t, item), (share, there, cosine, place) in sorted(best.items()):
        yield t, item, cosine, share, there, -place


def find_benchmark_items(
    docs: DataFrame,
    benchmark: DataFrame,
    work: Work,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """key, item key, cosine, shared (part of the item's words), answer_found, first_word."""
    narrow = docs.select(F.col(key), text_or_empty(text).alias("_text"))
    names = [key, item, "cosine", "shared", "answer_found", "first_word"]
    schema = (
        f"`{key}` {docs.schema[key].dataType.simpleString()}, "
        f"`{item}` {benchmark.schema[item].dataType.simpleString()}, "
        "cosine double, shared double, answer_found boolean, first_word bigint"
    )
    space = fit_space(narrow.select("_text"))
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    listed = benchmark.select(item, F.col(item_text).alias("_item"), answer.alias("_answer"))
    listed = work.put(
        listed.filter("trim(_item) <> ''").withColumn("_row", F.monotonically_increasing_id()), "items"
    )
    passes = max(1, -(-listed.count() // ITEMS_PER_PASS))
    result = docs.sparkSession.createDataFrame([], schema)
    if space is None:
        return result
    for number in range(passes):
        some = listed.filter(F.pmod(F.xxhash64("_row"), F.lit(passes)) == number).collect()
        some = [r for r in some if r["_item"].split()]
        if not some:
            continue
        items = prepare_items([r["_item"] for r in some], [r["_answer"] for r in some], space)
        item_ids = pa.array([r[item] for r in some])

        def search(
            batches: Iterator[pa.RecordBatch], items: Items = items, item_ids: pa.Array = item_ids
        ) -> Iterator[pa.RecordBatch]:
            for batch, texts in text_chunks(batches, "_text"):
                rows = list(found_items(texts, space, items))
                columns = list(zip(*rows)) or [[]] * 6
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64()]
                t, i, cosine, share, there, place = (pa.array(c, k) for c, k in zip(columns, types))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(t), item_ids.take(i), cosine, share, there, place],
                    names=names,
                )

        found = narrow.mapInArrow(search, schema)
        result = found if number == 0 else result.union(found)
    return result
