import glob
import os
import random
import time
import uuid
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from brute import components, repeats, words
from pyspark.sql import functions as F

import corpus_pipeline
from turnloom.llm import decontaminate, html_blocks, license_scan, ngram_join, packing, queries
from turnloom.llm import sharding, suffix_dedup, toxicity, url_filter, vptree
from turnloom.llm.common import CLEANUP_SETTING, SCAN_ROWS, SCAN_SETTING, Work, mixed
from turnloom.llm.words import split_words
from turnloom.sources.scratch import checkpoint_base

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty, tiny, repeated, long and nearly equal texts."""
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [draw.choice(vocabulary) for _ in range(120)]
    texts = [None, "", "   \n\t", "one", "One two", "one two", "é", "a b c", "A b  c", "x" * 3000]
    texts += [" ".join(base)] * 4
    for i in range(40):  # a large group of near copies
        near = list(base)
        for _ in range(i % 4):
            near[draw.randrange(len(near))] = draw.choice(vocabulary)
        texts.append(" ".join(near))
    passage = " ".join(draw.choice(vocabulary) for _ in range(60))
    for i in range(30):
        own = [draw.choice(vocabulary) for _ in range(draw.randrange(3, 200))]
        texts.append(" ".join(own[:40]) + (" " + passage if i % 3 == 0 else "") + " ".join(own[40:]))
    texts.append(" ".join(draw.choice(vocabulary) for _ in range(30_000)))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("n,part", [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_ngram_join(spark, odd_docs, n, part):
    linked = ngram_join.link_documents(odd_docs, "doc_id", "text", Work(spark), n, part, 100)
    assert {r[0]: (r[1], r[2]) for r in linked.collect()} == components(pairs(odd_docs), n, part, 100)


def test_ngram_join_over_many_chunks(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHINGLES_PER_CHUNK", 200)
    linked = ngram_join.link_documents(odd_docs, "doc_id", "text", Work(spark), 3, 97, 100)
    assert {r[0]: (r[1], r[2]) for r in linked.collect()} == components(pairs(odd_docs), 3, 97, 100)


def test_a_common_line_does_not_send_sets_to_all_chunks(spark, folder, monkeypatch):
    rng, line = random.Random(5), " ".join(f"common{i}" for i in range(12))
    rows = []
    for i in range(400):
        own = [f"w{rng.randrange(100_000)}" for _ in range(30)]
        rows.append((2 * i, f"{' '.join(own[:15])} {line} {' '.join(own[15:])}"))
        if i % 10 == 0:  # a near copy
            rows.append((2 * i + 1, f"{rows[-1][1]} more"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    visited = ngram_join._visited

    def noted(group, part, whole):
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
            file.write(str(group.num_rows))
        return visited(group, part, whole)

    monkeypatch.setattr(ngram_join, "SHINGLES_PER_CHUNK", 1000)
    monkeypatch.setattr(ngram_join, "_visited", noted)
    linked = ngram_join.link_documents(docs, "doc_id", "text", Work(spark), 3, 80, 100)
    assert {r[0]: (r[1], r[2]) for r in linked.collect()} == components(rows, 3, 80, 100)
    sent = sum(int(Path(f).read_text()) for f in glob.glob(f"{folder}/*"))
    assert sent < len(rows)


def test_prefixes_of_large_groups_lose_no_link(spark, monkeypatch):
    rng, rows = random.Random(7), []
    lines = [[f"l{k}x{i}" for i in range(9)] for k in range(6)]
    for i in range(300):
        if i % 3:
            words = [w for w in rows[rng.randrange(len(rows))][1].split() if rng.random() > 0.03]
        else:
            words = [w for k in rng.sample(range(6), 3) for w in lines[k]]
            words += [f"w{rng.randrange(300)}" for _ in range(rng.randrange(25))]
        rows.append((i, " ".join(words)))
    rows += [(5, rows[5][1]), (300, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(ngram_join, "SHINGLES_PER_CHUNK", 150)
    monkeypatch.setattr(ngram_join, "FREQUENT", 30)
    linked = ngram_join.link_documents(docs, "doc_id", "text", Work(spark), 2, 80, 100)
    assert {r[0]: (r[1], r[2]) for r in linked.collect()} == components(rows, 2, 80, 100)


def test_ngram_join_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r[0]: (r[1], r[2]) for r in queries.op9_ngram_join(spark, sf_dir).collect()}
    assert got == components(pairs(docs), 3, 90, 100)


def test_signature_levels_lose_no_link():
    """Random sets of all sizes: whatever is alike shares a signature."""
    draw = np.random.default_rng(1)
    for part, whole in ((90, 100), (80, 100), (60, 100)):
        scheme = ngram_join.Scheme.of(part, whole, 400)
        for size in [1, 2, 3, 5, 8, 9, 10, 11, 19, 20, 21, 40, 79, 160, 333]:
            for _ in range(20):
                a = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
                b = a.copy()
                while True:  # move apart until one step more would lose the link
                    c = b.copy()
                    c[draw.integers(len(c))] = draw.integers(0, 2**63)
                    c = np.unique(c)
                    same = len(np.intersect1d(a, c))
                    if whole * same < part * (len(a) + len(c) - same):
                        break
                    b = c
                sig, owner = ngram_join.signatures(
                    scheme, np.concatenate([a, b]), np.array([len(a), len(b)])
                )
                assert set(sig[owner == 0]) & set(sig[owner == 1])


@pytest.mark.parametrize("length", [21, 50, 100])
def test_suffix_dedup(spark, odd_docs, length):
    cut = suffix_dedup.remove_repeats(odd_docs, "doc_id", "text", Work(spark), length)
    got = {}
    for r in cut.collect():
        sizes = [s["end"] - s["start"] for s in r["removed"]]
        import hashlib

        got[r["doc_id"]] = (r["n_bytes"], sum(sizes), len(sizes), hashlib.sha256(r["kept"]).hexdigest())
    assert got == repeats(pairs(odd_docs), length)


def test_suffix_dedup_keeps_characters_whole(spark):
    one = "ä" * 10 + "é" + "ö" * 30
    rows = [(1, one, "", "", 0), (2, "x" + one, "", "", 0), (None, one, "", "", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    cut = suffix_dedup.remove_repeats(docs, "doc_id", "text", Work(spark), 31, whole_characters=True)
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in cut.collect()}
    assert kept == {1: one, 2: "x", None: ""}


def test_packing(spark, odd_docs):
    packed = packing.pack_documents(odd_docs, "doc_id", "text", packing.tokenizer_path(), Work(spark), 256)
    rows = sorted((r["sequence_id"], r["offset"], r["length"]) for r in packed.collect())
    ends = {}
    for sequence, offset, length in rows:
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values()) <= 256
    gaps = []  # best fit decreasing, one item at a time
    for n in sorted((n for _, _, n in rows), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 256) - n)
    assert len(ends) <= len(gaps) + 1
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    expected = set()
    for i, text in pairs(odd_docs):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k : k + 256], "<u4")
            expected.add((i, k // 256, k, len(part), zlib.crc32(part.tobytes())))
    got = {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed.collect()}
    assert got == expected


def test_piece_ids_equal_the_tokenizer():
    draw = random.Random(2)
    letters = [*"abXY 's't're'll\n09.,!?<|>-_éÉßÿŸ×÷µ…—İΣςa\u0301\u00a0\x0b\x7f日", "<|endoftext|>", "''s", "'RE"]
    texts = ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(1500)]
    encoder = packing.PieceIds(packing.tokenizer_path())
    ids, sizes = encoder.encode([t.encode() for t in texts])
    for text, n, end in zip(texts, sizes, np.cumsum(sizes)):
        own = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert ids[end - n : end].tolist() == own


def test_tables_are_read_and_written_in_small_portions(spark):
    work = Work(spark)
    assert int(spark.conf.get(SCAN_SETTING)) == SCAN_ROWS
    rows = spark.range(400, numPartitions=1).select(F.expr("randstr(100000, 7)").alias("v"))
    written = work.put(rows, "wide")
    assert written.count() == 400
    [path] = glob.glob(f"{work.paths[-1]}/*.parquet")
    assert pq.ParquetFile(path).num_row_groups > 1


def test_piece_ids_are_remembered_within_the_bytes_allowed(monkeypatch):
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{k:x}" for k in range(2500)).encode() for i in range(80)]
    encoder, asked = packing.PieceIds(packing.tokenizer_path()), []
    plain = encoder._ids_of
    monkeypatch.setattr(encoder, "_ids_of", lambda pieces: asked.append(len(pieces)) or plain(pieces))
    texts = [text.translate(bytes.maketrans(b"0123456789", b"ghijklmnop")) for text in texts]
    first = [encoder.encode(texts[at : at + 10])[0] for at in range(0, 80, 10)]
    assert sum(asked) == 200_000
    again = [encoder.encode(texts[at : at + 10])[0] for at in range(0, 80, 10)]
    assert sum(asked) == 200_000  # all are known: before, room for 147,000 pieces at most
    monkeypatch.setattr(packing, "MEMO_BYTES", 1 << 20)
    less = [encoder.encode(texts[at : at + 10])[0] for at in range(0, 80, 10)]
    assert sum(asked) > 200_000
    for a, b, c in zip(first, again, less):
        assert a.tobytes() == b.tobytes() == c.tobytes()


def test_plan_pairs_large_items_and_fills_gaps():
    bins = packing.plan_bins({70: 2, 40: 3, 30: 2, 10: 1}, 100)
    used = [sum(n * t for n, t in entries) for count, entries in bins for _ in range(count)]
    assert sum(used) == 330 and len(used) == 4 and max(used) <= 100
    assert packing.plan_bins({}, 100) == []


def test_packing_refuses_impossible_lengths(spark):
    for n in (0, 300, None):
        items = spark.createDataFrame([(1, n)], "k int, n bigint")
        with pytest.raises(Exception, match="must be from 1"):
            packing.best_fit(items, "n", ["k"], Work(spark), 256).collect()


def _feistel(x, n, seed):
    a, b = sharding.rectangle(n)

    def signed(v):
        return v - (1 << 64) if v >> 63 else v

    def mix(value, at):
        h = xxhash.xxh64(value.to_bytes(8, "little"), seed=42).intdigest()
        h = xxhash.xxh64(at.to_bytes(4, "little"), seed=h).intdigest()
        return signed(xxhash.xxh64(seed.to_bytes(4, "little"), seed=h).intdigest())

    while True:
        left, right = divmod(x, b)
        for at in range(sharding.ROUNDS):
            if at % 2 == 0:
                left = (left + mix(right, at) % a) % a
            else:
                right = (right + mix(left, at) % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 1000])
def test_permutation(spark, n):
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n).alias("p")).collect()
    assert sorted(r["p"] for r in rows) == list(range(n))
    assert all(r["p"] == _feistel(r["id"], n, sharding.SEED) for r in rows)


def test_sharding(spark, odd_docs):
    placed = sharding.shard_documents(odd_docs.union(odd_docs.limit(3)), 8, Work(spark)).collect()
    slots = {}
    for r in placed:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    texts = dict(pairs(odd_docs))
    for r in placed:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))


def test_sharding_does_not_depend_on_the_layout(spark, odd_docs):
    one = {tuple(r) for r in sharding.shard_documents(odd_docs, 8, Work(spark)).collect()}
    two = sharding.shard_documents(odd_docs.repartition(3, "n_chars"), 8, Work(spark)).collect()
    assert one == {tuple(r) for r in two}


def test_nearest_is_exact_at_factor_one(spark):
    draw = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((300, 8)))]
    rows += [(300 + i, [1.0] * 8) for i in range(40)]  # a large group of copies
    rows += [(900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] * 8), (950, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    asks = F.col("vec_id") % 50 == 0
    found = vptree.nearest(vectors, "vec_id", "embedding", asks, Work(spark), 5, factor=1.0)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    sound = [(i, np.array(v + [0.0] * (8 - len(v)))) for i, v in rows if i < 900 or i == 950]
    for q, v in sound:
        if q % 50 == 0:
            far = [(-v @ w / np.sqrt((v @ v) * (w @ w)), i) for i, w in sound if i != q]
            assert got[q] == [i for _, i in sorted((round(s, 12), i) for s, i in far)[:5]]
    assert set(got) == {q for q, _ in sound if q % 50 == 0}


def test_nearest_recall_on_embeddings(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    ids = np.array([r["vec_id"] for r in rows])
    hits = total = 0
    got = {}
    for r in queries.op6_nearest(spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    for i in np.flatnonzero(ids % 50 == 0):
        order = [j for j in np.lexsort((ids, -(x @ x[i]))) if j != i][:5]
        hits += len(got[ids[i]] & set(ids[order]))
        total += len(order)
    assert hits >= 0.9 * total


def test_urls(spark):
    urls = [None, "", "no host", "http://NET", "http://a.net/en/x", "https://www.example.net/en/a?b#c"]
    urls += ["http://example.net/en", "http://x.example.com/de/", "http://myexample.com/de/", "http://b.org/fr/"]
    urls += ["a://example.net:80/en/", "://net/#x", "http://u@q.net?x", "x\ny://net/", "http://net./"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(3)
    rules = spark.createDataFrame(queries.URL_RULES * 2, "host string, path string, action string")
    got = url_filter.judge_urls(pages, rules, Work(spark))
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    expected = con.sql(queries.ORACLES["op8_url_filter"]).fetchall()
    names = ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(expected)
    nested = [("net", "/", "block"), ("b.net", "/", "allow"), ("a.b.net", "/x", "block"), ("c.net", "/", "allow")]
    hosts = ["a.b.net/x", "a.b.net/y", "z.b.net/x", "bb.net/", "c.net/", "d.net/", "z.com/"]
    pages = spark.createDataFrame([(i, f"http://{h}") for i, h in enumerate(hosts)], pages.schema)
    rules = spark.createDataFrame(nested, rules.schema)
    got = url_filter.judge_urls(pages, rules, Work(spark)).orderBy("page_id")
    assert [r["rule"] for r in got.collect()] == ["a.b.net/x", "b.net/", "b.net/", "net/", "c.net/", "net/", None]
    none = url_filter.judge_urls(pages, rules.limit(0), Work(spark))
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "allow")}


def test_licenses(spark):
    texts = [None, "", "mit", "Hello.\nReleased under the MIT License.\nBye", "x " * 5000]
    texts += [license_scan.TEMPLATES["MIT"][-1].replace(" ", "\n")]
    texts += ["a b. Licensed under CC BY-NC 4.0! c d", "Released under the MIT license of nobody at all here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {(r["doc_id"], r["license"], round(r["score"], 3)) for r in license_scan.scan_licenses(docs).collect()}
    assert found == {(3, "MIT", 1.0), (5, "MIT", 1.0), (6, "CC-BY-NC-4.0", 1.0)}


def test_licenses_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    said = docs.filter(F.lower("text").rlike("licen[sc]e")).select("doc_id").collect()
    found = queries.op1_licenses(spark, sf_dir).select("doc_id").distinct().collect()
    assert {r[0] for r in found} == {r[0] for r in said}


def test_toxicity(spark):
    draw = random.Random(9)
    plain = ["".join(draw.choices("abcdefghij", k=draw.randrange(3, 8))) for _ in range(300)]
    bad = ["moronish", "scumlike", "idiotic"]
    rows, labels = [], []
    for i in range(600):
        text = [draw.choice(plain) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(6):
                text.insert(draw.randrange(len(text)), draw.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "moronish " * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    scored = {r["doc_id"]: r for r in toxicity.score_documents(docs, known).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(scored[i]["predicted"] == (i % 4 == 0) for i in held)
    assert right >= 0.95 * len(held)
    assert scored[1002]["predicted"] == 1 and 0 <= scored[1000]["score"] == scored[1001]["score"] <= 1
    few = toxicity.score_documents(docs, known.limit(3)).select("score").distinct().collect()
    assert len(few) == 1


def test_decontamination_space_is_fitted_on_every_passage(spark):
    """Statistics by brute force; the squares of all passages, copies too, add up to one each way."""
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(draw.choices(vocabulary, k=16)) for _ in range(600)]
    texts += [texts[0]] * 500
    docs = spark.createDataFrame([(t,) for t in [*texts, "", None]], "_text string").repartition(6)
    space = decontaminate.fit_space(docs)
    terms = [decontaminate.terms_of(split_words([t.encode()]).hashes()) for t in texts]
    tf = np.array([np.bincount(t, minlength=decontaminate.TERMS) for t in terms], float)
    idf, mean, count = decontaminate.term_statistics(docs)
    assert count == len(texts)
    np.testing.assert_allclose(mean, tf.mean(axis=0))
    np.testing.assert_allclose(idf, np.log((count + 1) / ((tf > 0).sum(axis=0) + 1)))
    latent = tf @ space.basis
    np.testing.assert_allclose(latent.sum(axis=0), 0, atol=0.05)
    np.testing.assert_allclose(latent.T @ latent, np.eye(decontaminate.RANK), atol=0.01)


def test_pipeline_space_is_fitted_beyond_forty_thousand_passages(spark, sf_dir, monkeypatch):
    """All 50,000 passages of a stage's input, all of them different, whatever partitions they lie in."""
    spaces, fit = [], decontaminate.fit_space
    monkeypatch.setattr(decontaminate, "fit_space", lambda *given: spaces.append(fit(*given)) or spaces[-1])
    chosen = "transform(sequence(1, 16), i -> concat('w', pmod(xxhash64(id, i), 300)))"
    docs = spark.range(50_000).selectExpr("id AS doc_id", f"concat_ws(' ', {chosen}) AS text")
    texts = [r["text"].encode() for r in docs.select("text").collect()]
    words = split_words(texts)
    hashes, number = np.unique(words.hashes(), return_inverse=True)
    tf = np.bincount(words.text * len(hashes) + number, minlength=len(texts) * len(hashes))
    tf = tf.reshape(len(texts), len(hashes)).astype(float)
    for parts in (1, 7):
        corpus_pipeline.decontamination(spark, docs.repartition(parts), sf_dir)
        latent = tf @ spaces[-1].basis[(mixed(hashes) % np.uint64(decontaminate.TERMS)).astype(int)]
        np.testing.assert_allclose(latent.T @ latent, np.eye(decontaminate.RANK), atol=0.02)


def test_decontamination_adds_up_by_passage_and_term():
    draw = random.Random(4)
    texts = [" ".join(draw.choices("abcdefghij", k=n)).encode() for n in (0, 1, 16, 17, 33, 9_000, 40)]
    words = split_words(texts)
    terms, (first, text) = decontaminate.terms_of(words.hashes()), decontaminate.step_starts(words)
    tf, ends = np.zeros((len(first), decontaminate.TERMS)), np.cumsum(words.per_text())
    for i, (a, t) in enumerate(zip(first, text)):
        tf[i] = np.bincount(terms[a : min(a + 32, ends[t])], minlength=decontaminate.TERMS)
    rows = np.random.default_rng(1).standard_normal((decontaminate.TERMS, 3))
    got = decontaminate.term_rows(terms, first, text, rows)
    np.testing.assert_allclose(got, tf @ rows)
    total = np.zeros_like(rows)
    decontaminate.add_to_terms(total, terms, first, text, got)
    np.testing.assert_allclose(total, tf.T @ got, atol=1e-9)


def test_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    held = {
        (i, item["item_id"])
        for i, text in pairs(docs)
        for item in items
        if " ".join(words(item["text"])) in " ".join(words(text))
    }
    got = {(r[0], r[1]) for r in queries.op7_decontamination(spark, sf_dir).select("doc_id", "item_id").collect()}
    assert len(got & held) >= 0.97 * len(held) and len(got - held) <= 0.05 * len(got) + 1


def test_alignment():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
        return row[-1]

    draw = random.Random(3)
    for _ in range(200):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(1, 30))] for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == plain(a, b)


def test_main_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    more = [(-1, "u", None), (-2, "u", ""), (-3, "u", "<script>x</script"), (-4, None, "<p>a<p>b &amp; c</nav>")]
    got = html_blocks.extract_main_text(pages.union(spark.createDataFrame(more, pages.schema))).collect()
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[-1] == by_id[-2] == by_id[-3] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    for page in pages.collect():
        blocks = html_blocks.blocks_of(page["html"])
        kept = [b.text for b in blocks if html_blocks.marked_main(b.path)]
        assert by_id[page["page_id"]] == "\n\n".join(kept)


def test_main_text_of_unknown_templates(spark, sf_dir):
    pages = [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]
    labeller = html_blocks.train(pages[:150])
    draw = np.random.default_rng(8)
    right = total = 0
    for page in pages[150:]:
        blocks = html_blocks.blocks_of(page)
        main = np.array([html_blocks.marked_main(b.path) for b in blocks])
        changed, flags = html_blocks.changed_page(blocks, main, [b.text for b in blocks], draw)
        right += int((labeller.label([changed])[0] == flags).sum())
        total += len(flags)
    assert right >= 0.97 * total


def test_empty_tables(spark, sf_dir):
    docs, work = empty(spark), Work(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for result in (
        license_scan.scan_licenses(docs),
        packing.pack_documents(docs, "doc_id", "text", packing.tokenizer_path(), work),
        suffix_dedup.remove_repeats(docs, "doc_id", "text", work),
        sharding.shard_documents(docs, 8, work),
        toxicity.score_documents(docs, labels),
        vptree.nearest(vectors, "vec_id", "embedding", F.lit(True), work),
        decontaminate.find_benchmark_items(docs, benchmark, work),
        url_filter.judge_urls(pages, rules, work),
        ngram_join.link_documents(docs, "doc_id", "text", work),
        html_blocks.extract_main_text(pages),
    ):
        assert result.collect() == []


def test_clashing_columns(spark, odd_docs, sf_dir):
    extra = odd_docs.withColumns({c: F.lit("x") for c in ("score", "predicted", "component_id", "piece", "shard")})
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    n = odd_docs.count()
    assert toxicity.score_documents(extra, labels).filter("score BETWEEN 0 AND 1").count() == n
    assert ngram_join.link_documents(extra, "doc_id", "text", Work(spark)).count() == n
    assert sharding.shard_rows(extra, ["doc_id"], 4, Work(spark)).filter("shard < 4").count() == n


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, work, seen = docs.columns, Work(spark), [set(r[0] for r in docs.select("doc_id").collect())]
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = pairs(docs) if at < 4 else None
        docs = work.put(stage(spark, docs, sf_dir), name)
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert ids <= seen[-1]
        if at < 4:
            assert docs.columns == names
        if name == "ngram_join":
            roots = components(before, 5, 80, 100)
            assert ids == {i for i, (_, root) in roots.items() if i == root}
        if name == "suffix_dedup":
            expected = repeats(before, corpus_pipeline.REPEATED_BYTES)
            gone = {i for i, (n, removed, _, _) in expected.items() if n and n == removed}
            assert ids == seen[-1] - gone
        seen.append(ids)
    assert docs.count() >= len(seen[-1]) > 0


def test_pipeline_stages_on_odd_rows(spark, odd_docs, sf_dir):
    odd = odd_docs.union(odd_docs.filter("doc_id < 3")).union(
        spark.createDataFrame([(None, "no id", "en", None, None), (None, None, None, None, 0)], DOCS)
    )
    for docs in (odd, empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = Work(spark).put(stage(spark, docs, sf_dir), name)
        docs.count()


def written_tables(spark):
    """Paths of the written tables that exist."""
    return set(glob.glob(f"{checkpoint_base(spark).removeprefix('file:')}/turnloom/*"))


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = (glob.glob(f"{d}/*/shuffle_*") for d in disk.localDirs())
    return {os.path.basename(f) for some in found for f in some}


def test_written_tables_leave_no_shuffle_files(spark):
    work, before, setting = Work(spark), shuffle_files(spark), spark.conf.get(CLEANUP_SETTING)
    rows = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    table = work.put(rows, "counted")
    end = time.time() + 10
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP_SETTING) == setting
    assert sorted(table.collect()) == sorted(rows.collect()) == sorted(rows.collect())


def test_ngram_join_deletes_what_no_result_reads(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHINGLES_PER_CHUNK", 200)
    before = written_tables(spark)
    linked = ngram_join.link_documents(odd_docs, "doc_id", "text", Work(spark), 3, 90, 100)
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in written_tables(spark) - before}
    assert left == {"nodes", "roots", "placed", "least", "known"}
    assert {r[0]: (r[1], r[2]) for r in linked.collect()} == components(pairs(odd_docs), 3, 90, 100)


def test_pipeline_leaves_its_result_only(spark, odd_docs, folder, monkeypatch):
    stages = [s for s in corpus_pipeline.STAGES if s[0] in ("ngram_join", "suffix_dedup")]
    odd_docs.write.parquet(f"{folder}/documents.parquet")
    docs = odd_docs
    for _, stage in stages:
        docs = stage(spark, docs, folder)
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    before = written_tables(spark)
    result = corpus_pipeline.run(spark, folder)
    assert {os.path.basename(p).rsplit("-", 1)[0] for p in written_tables(spark) - before} == {"suffix_dedup"}
    assert sorted(pairs(result)) == sorted(pairs(docs))
