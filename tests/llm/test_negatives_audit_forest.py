"""Hard negatives, the filter audit and the LSH forest against plain versions."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from brute import components
from pyspark.sql import functions as F

from turnloom.llm import filter_audit, hard_negatives, lsh_forest, queries, toxicity, vptree
from turnloom.llm.common import Work

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VECTORS = "vec_id bigint, embedding array<double>, label int"


def plain_negatives(rows, positives=5, negatives=10):
    """What op11 asks for, row by row; rows are (vec_id, vector, label)."""
    sound = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        sound.append((i, [int(np.floor(256.0 * x)) for x in v], label))
    found = []
    for at, (i, v, label) in enumerate(sound):
        if i % 100:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), j, other)
            for k, (j, w, other) in enumerate(sound)
            if k != at and len(w) == len(v)
        ]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            inside = [x for x in scored if x[2] != label and -30 * s <= -100 * x[0] <= -90 * s]
            for rank, (t, k, _) in enumerate(sorted(inside)[:negatives], 1):
                found.append((i, j, rank, k, -s, -t))
    return sorted(found)


def mined(vectors):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = F.col("vec_id") % 100 == 0
    return hard_negatives.mine(vectors, "vec_id", "embedding", moved, anchors, Work(vectors.sparkSession))


@pytest.mark.parametrize("block,section", [(256, 64), (3, 2)])
def test_hard_negatives(spark, monkeypatch, block, section):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "SECTION_BLOCKS", section)
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(0.3, 1, 6).tolist(), int(draw.integers(4))) for i in range(240)]
    rows += [(300 + i, [0.5] * 6, i % 2) for i in range(90)]  # copies of one vector, ties
    rows += [(500, [0.1, 0.9], 1), (501, [0.2, 0.3], 1), (502, [0.5, 0.4], 2), (600, [], 1), (700, [2.0] * 6, 9)]
    rows += [(800, None, 1), (900, [1.0, None], 1), (1000, [float("nan")] * 6, 1), (1100, [1.0] * 6, None)]
    rows += [(None, [1.0] * 6, 1), (100, [0.4] * 6, 0), (100, [0.4] * 6, 0)]  # repeated rows
    vectors = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("rank", "q", "n")})
    got = mined(vectors.repartition(4))
    assert got.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    # Rows of one id can tie: ranks of such ties are the same rows in any order.
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_hard_negatives_on_embeddings(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, sf_dir).collect())) == plain_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert mined(spark.createDataFrame([], VECTORS)).collect() == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], VECTORS)).collect() == []
    assert mined(spark.createDataFrame([(100, [1.0], 1), (2, [1.0], 1)], VECTORS)).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        mined(spark.createDataFrame([(100, [1e16], 1), (2, [1e16], 1)], VECTORS)).collect()


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 3), (3, 2), (5, 2)])
def test_hilbert_neighbours_are_adjacent(dims, bits):
    side = 1 << bits
    cells = np.array(np.meshgrid(*[range(side)] * dims)).reshape(dims, -1).T
    keys = hard_negatives.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    path = cells[np.argsort(np.array(keys, object), kind="stable")]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product():
    draw = np.random.default_rng(8)
    a, b = draw.integers(-50, 50, (9, 7)), draw.integers(-50, 50, (30, 7))
    low, high = b.min(axis=0, keepdims=True), b.max(axis=0, keepdims=True)
    below, above = hard_negatives.bounds(a, low, high)
    scores = hard_negatives.products(a, b)
    assert (scores >= below).all() and (scores <= above).all()
    wide = hard_negatives.products(a * 10**7, b * 10**7)
    assert (wide == scores * 10**14).all()


def test_nearest_keeps_repeated_rows(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    found = vptree.nearest(vectors, "vec_id", "embedding", F.col("vec_id") == 50, Work(spark), 5)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found.collect())
    assert got == sorted((50, rank, i) for rank, i in enumerate([2, 2, 50, 3, 1], 1) for _ in range(2))


# --- filter audit ----------------------------------------------------------------------------


def test_filter_audit(spark):
    draw = random.Random(2)
    texts = [None, "", "   ", "A", "é" * 300, "# a", "a " * 250, "ABC def " * 150, "x y z " * 3]
    texts += [" ".join(f"w{draw.randrange(900)}" for _ in range(draw.choice([150, 250, 900]))) for _ in range(60)]
    texts += ["copied text of some length"] * 40 + [" ".join(f"L{i}" for i in range(120_000))]
    rows = [(i, t, draw.choice(["en", "de", None, ""]), "s", 0) for i, t in enumerate(texts)]
    rows += rows[20:25] + [(None, texts[30], "en", "s", 0), (None, texts[30], "fr", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    labels = spark.createDataFrame(
        [(i, i % 2, int(i % 5 == 0)) for i in range(0, 80, 2)] + [(4, 1, None), (6, None, 1), (None, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    clashing = docs.withColumns({c: F.lit("x") for c in ("part", "mask", "step", "kept", "hash", "id", "n")})
    got = filter_audit.audit_filters(clashing, labels, Work(spark))
    database = duckdb.connect()
    database.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    database.register("labels", labels.toPandas().astype({c: "Int64" for c in ("doc_id", "quality", "toxic")}))
    expected = database.sql(queries.ORACLES["op12_filter_audit"])
    order = got.columns
    names = [d[0] for d in expected.description]
    rows = sorted(tuple(r[names.index(c)] for c in order) for r in expected.fetchall())
    assert sorted(map(tuple, got.collect())) == rows
    assert len(rows) == 600 * 4


def test_filter_audit_adds_in_a_tree(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(filter_audit, "TREE", 2)
    documents, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    one = filter_audit.audit_filters(documents.repartition(7), labels, Work(spark)).collect()
    assert sorted(one) == sorted(queries.op12_filter_audit(spark, sf_dir).collect())


def test_filter_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit_filters(spark.createDataFrame([], DOCS), labels, Work(spark)).collect() == []


def test_wide_counters_do_not_run_over():
    most = (1 << 31) - 1
    fields = filter_audit.unpacked(filter_audit.packed(most * filter_audit.wide(0b10101, True, False)))
    assert set(np.unique(fields)) == {0, most}
    removed = fields[filter_audit.KINDS.index("removed")]
    assert (removed.sum(axis=1) == most).all()
    for order, row in zip(filter_audit.orders(), removed):
        assert row[min(map(order.index, "ACE"))] == most


# --- LSH forest ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def crowded(spark):
    """Tiny, empty and long texts, copies, and a crowd of near copies at many distances."""
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \t\n", "one", "One", "a b c", "a b c d", "A  b c d", "a b c d e"]
    base = [draw.choice(vocabulary) for _ in range(200)]
    texts += [" ".join(base)] * 5
    for i in range(150):
        near = list(base)
        for _ in range(i % 12):
            near[draw.randrange(len(near))] = draw.choice(vocabulary)
        texts.append(" ".join(near))
    for i in range(60):
        own = [draw.choice(vocabulary) for _ in range(draw.randrange(4, 120))]
        texts += [" ".join(own), " ".join(own[: max(4, len(own) - i % 9)])]
    long = [draw.choice(vocabulary) for _ in range(40_000)]
    texts += [" ".join(long), " ".join(long[:-1000])]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def placed(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize("region,piece,chunk", [(512, 4096, 20_000), (4, 4096, 20_000), (512, 8, 30)])
def test_lsh_forest(spark, crowded, monkeypatch, region, piece, chunk):
    for name, value in (("REGION_SETS", region), ("PIECE_SETS", piece), ("SETS_PER_CHUNK", chunk)):
        monkeypatch.setattr(lsh_forest, name, value)
    clashing = crowded.withColumns({c: F.lit("x") for c in ("component_id", "kept", "node", "short", "signature")})
    found = lsh_forest.near_duplicates(clashing, "doc_id", "text", Work(spark), 4, 80, 100)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [(r["doc_id"], r["text"]) for r in crowded.collect()]
    assert placed(found) == components(rows, 4, 80, 100)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def test_lsh_forest_on_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert placed(queries.op13_minhash_forest(spark, sf_dir)) == components(rows, 4, 80, 100)


def test_lsh_forest_keeps_every_row(spark):
    docs = spark.createDataFrame(
        [(7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (None, None), (3, ""), (3, "x")],
        "doc_id bigint, text string",
    )
    found = lsh_forest.near_duplicates(docs, "doc_id", "text", Work(spark), 4).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)
    assert got == [("3", 0, "3"), ("3", 1, "3"), ("7", 2, "7"), ("7", 2, "7"), ("None", 0, "None"), ("None", 2, "7")]
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert lsh_forest.near_duplicates(none, "doc_id", "text", Work(spark)).collect() == []


def test_min_hashes_estimate_similarity():
    draw = np.random.default_rng(6)
    common = draw.integers(0, 2**63, 800).astype(np.uint64)
    a, b = (np.concatenate([common, draw.integers(0, 2**63, 100).astype(np.uint64)]) for _ in range(2))
    signatures = lsh_forest.min_hashes(np.concatenate([a, b]), np.array([900, 900]))
    assert abs((signatures[0] == signatures[1]).mean() - 0.8) < 0.12


def test_toxicity_learns_one_text_per_id(spark):
    docs = spark.range(400).selectExpr("if(id < 300, 7, id) AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    rows = toxicity.training_rows(docs, labels, "doc_id", "text")
    ids = [i for i in {7, *range(300, 400)} if zlib.crc32(str(i).encode()) % 5]
    assert len(rows) == len(ids)
    assert sum(r["toxic"] for r in rows) == sum(i % 2 for i in ids)
