"""Toxicity by compression distance with two zstandard dictionaries.

A window of a few words is compressed with a dictionary of toxic text and with one of ordinary
text; the difference in bytes is its evidence. Both dictionaries share a base that zstandard
trains on ordinary windows, so that everyday words cost the same in both. In front of the
window's end each has its own class's words, those that stand in the most distinct contexts of
that class compared with the other: copies of one text count once. The ordinary one is then
trained further on the words of ordinary windows that looked toxic.

A document is scored by its largest differences, by the numbers and shares of windows above
several thresholds and by its length; weights and the threshold are calibrated by logistic
regression on labelled rows that the dictionaries have not seen.

The training sample is bounded: TOXIC_ROWS and ORDINARY_ROWS labelled ids by hash order, one text
of at most SAMPLE_BYTES each. So are the dictionaries: BASE_BYTES of common text, at most
WORD_LIMIT words whose log-likelihood gain exceeds LEAST_GAIN in the toxic one, as many bytes of
ordinary words in the other and at most HARD_BYTES of corrections. Scoring covers all windows of
all texts.

The end of a dictionary is chosen by rank and not by zstandard's own training: dictionaries
trained by zstandard on the windows of each class, also when retrained on the windows that
looked most toxic, told the classes apart far less well; the README has the figures.

Cases: NULL or empty text is scored as one empty window. Labels that are NULL or repeated: the
largest counts. With fewer than LEAST_ROWS of either class every score is the smoothed share of
toxic labels. An empty table gives an empty result. Columns of the input with the name of a
result column are replaced.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import CLEARED_AFTER_TASKS, small_batches, text_chunks, text_or_empty

TOXIC_ROWS, ORDINARY_ROWS, SAMPLE_BYTES = 2_000, 4_000, 20_000
LEAST_ROWS = 20
WORDS_PER_WINDOW = 4
BASE_BYTES, WORD_LIMIT, HARD_BYTES = 4096, 256, 1024
LEAST_GAIN = 15.0
LEVEL = 9
THRESHOLDS = (2, 3, 4, 5, 6)
EDGES = b".,!?;:\"'()[]*#$%&|"


def words_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().split()


def windows_of(words: list[bytes], size: int = WORDS_PER_WINDOW) -> list[bytes]:
    if not words:
        return [b"  "]
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=data,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


@lru_cache(maxsize=2)
def _pair(toxic: bytes, ordinary: bytes) -> tuple:
    return _compressor(toxic).compress, _compressor(ordinary).compress


CLEARED_AFTER_TASKS.append(_pair.cache_clear)


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def differences(self, text: bytes) -> np.ndarray:
        toxic, ordinary = _pair(self.toxic, self.ordinary)
        windows = windows_of(words_of(text))
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows])

    def score(self, texts: list[bytes]) -> np.ndarray:
        x = np.array([features(self.differences(t)) for t in texts])
        z = np.c_[(x - self.mean) / self.spread, np.ones(len(x))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def features(differences: np.ndarray) -> list[float]:
    top = np.zeros(4)
    largest = np.sort(differences)[::-1][:4]
    top[: len(largest)] = largest
    above = [int((differences >= t).sum()) for t in THRESHOLDS]
    n = len(differences)
    return [*top, *map(math.log1p, above), *(a / n for a in above), math.log(n)]


def distinct_contexts(texts: list[bytes]) -> dict[bytes, int]:
    seen: dict[bytes, set[int]] = defaultdict(set)
    for text in texts:
        words = [w.strip(EDGES) for w in words_of(text)]
        for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
            if len(word) >= 3:
                seen[word].add(hash((before, after)))
    return {w: len(s) for w, s in seen.items()}


def class_words(toxic: list[bytes], ordinary: list[bytes]) -> list[tuple[float, bytes]]:
    """Words by the log-likelihood gain of telling the classes apart, toxic ones first."""
    a, b = distinct_contexts(toxic), distinct_contexts(ordinary)
    n, m = sum(a.values()), sum(b.values())
    ranked = []
    for word in a.keys() | b.keys():
        x, y = a.get(word, 0), b.get(word, 0)
        e, f = (x + y) * n / (n + m), (x + y) * m / (n + m)
        gain = 2 * ((x * math.log(x / e) if x else 0) + (y * math.log(y / f) if y else 0))
        ranked.append((gain if x > e else -gain, word))
    return sorted(ranked, reverse=True)


def _joined(words: list[bytes], limit: int) -> bytes:
    """The words with the first one last, where it is cheapest to refer to."""
    kept, size = [], 0
    for word in words:
        if size >= limit:
            break
        kept.append(word)
        size += len(word) + 1
    return b" " + b"".join(w + b" " for w in reversed(kept))


def train(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    """Dictionaries from two thirds of the rows, weights from the rest."""
    t, o = 2 * len(toxic) // 3, 2 * len(ordinary) // 3
    ranked = class_words(toxic[:t], ordinary[:o])
    samples = [w for text in ordinary[:o] for w in windows_of(words_of(text), 16)][::3]
    try:
        base = zstandard.train_dictionary(BASE_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        base = b"".join(samples)[:BASE_BYTES]
    insults = [w for gain, w in ranked if gain > LEAST_GAIN][:WORD_LIMIT]
    toxic_end = _joined(insults, 1 << 20)
    ordinary_end = _joined([w for _, w in reversed(ranked)], len(toxic_end))
    first = _pair(base + toxic_end, base + ordinary_end)
    hard: Counter[bytes] = Counter()
    for text in ordinary[o:]:
        for window in windows_of(words_of(text)):
            gain = len(first[1](window)) - len(first[0](window))
            if gain >= THRESHOLDS[0]:
                for word in window.split():
                    alone = b" " + word + b" "
                    if len(first[1](alone)) > len(first[0](alone)):
                        hard[word.strip(EDGES)] += gain
    corrected = _joined([w for w, _ in hard.most_common()], HARD_BYTES) if hard else b""
    zeros = np.zeros(1)
    model = Model(base + toxic_end, base + corrected + ordinary_end, zeros, zeros, zeros)
    rows = toxic[t:] + ordinary[o:]
    x = np.array([features(model.differences(text)) for text in rows])
    y = np.array([1.0] * len(toxic[t:]) + [0.0] * len(ordinary[o:]))
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / deviation, np.ones(len(x))]
    weights, penalty = np.zeros(z.shape[1]), 1e-5 * len(x)
    # The sample holds more toxic rows than the table; both classes keep their own weight here,
    # which asks for somewhat more evidence than equal weights would.
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -50, 50)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(weights)) + 1e-6
        weights = weights + np.linalg.solve(curve, z.T @ (y - p) - penalty * weights)
    return Model(model.toxic, model.ordinary, mean, deviation, weights)


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str) -> list:
    """A bounded sample of labelled rows that are not held out: (toxic, text)."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull())
        .groupBy(key)
        .agg((F.max("toxic") > 0).alias("toxic"))
        .filter(~held_out(key))
    )
    sized = docs.filter(F.octet_length(text_or_empty(text)) <= SAMPLE_BYTES)
    usable = known.join(sized.select(key).distinct(), key)
    chosen = [
        usable.filter(F.col("toxic") == flag).orderBy(F.xxhash64(key), key).limit(rows)
        for flag, rows in ((True, TOXIC_ROWS), (False, ORDINARY_ROWS))
    ]
    # At most TOXIC_ROWS + ORDINARY_ROWS rows.
    few = docs.sparkSession.createDataFrame(
        chosen[0].union(chosen[1]).collect(), known.schema
    )
    rows = sized.join(F.broadcast(few), key).groupBy(key)
    return rows.agg(F.max("toxic").alias("toxic"), F.min(text).alias(text)).select("toxic", text).collect()


def held_out(key: str) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add score (0 to 1) and predicted (score >= 0.5) to every row."""
    small_batches(docs.sparkSession)
    sample = sorted((bool(r["toxic"]), (r[text] or "").encode()) for r in training_rows(docs, labels, key, text))
    order = np.random.default_rng(7).permutation(len(sample))
    toxic = [sample[i][1] for i in order if sample[i][0]]
    ordinary = [sample[i][1] for i in order if not sample[i][0]]
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    if min(len(toxic), len(ordinary)) < LEAST_ROWS:
        share = (len(toxic) + 0.5) / (len(sample) + 10)
        scored = docs.select(*kept, F.lit(share).cast("double").alias("score"))
    else:
        model = train(toxic, ordinary)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in text_chunks(batches, text):
                yield batch.append_column("score", pa.array(model.score(texts)))

        schema = docs.select(*kept, F.lit(0.0).alias("score")).schema
        scored = docs.select(*kept).mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
