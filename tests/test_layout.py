import hashlib

import pytest
from pyspark.sql import functions as F

from turnloom.operators.layout import (
    assign_batches,
    pack_layout,
    packed_tokens,
    train_plan,
    truncate,
    words,
    write_batches,
    write_bucketed,
    write_steps,
)
from turnloom.operators.positions import running_starts
from turnloom.operators.sampling import seeded_sample


def digest(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


def docs(spark, n=300):
    rows = [(i * 7 % 1009, [f"w{i}_{j}" for j in range(i * 13 % 41)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, tokens array<string>").repartition(5)


def test_words_and_truncate(spark):
    frame = spark.createDataFrame([(1, "a b\n c  d"), (2, "a"), (3, "")], "id long, text string")
    tokens = frame.select("id", words(F.col("text")).alias("tokens"))
    rows = truncate(tokens, "tokens", 3).orderBy("id").collect()
    assert [(r.tokens, r.n_tokens, r.was_truncated) for r in rows] == [
        (["a", "b", "c"], 3, True),
        (["a"], 1, False),
        ([], 0, False),
    ]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_running_starts_match_brute_force(spark, partitions):
    rows, frame = docs(spark)
    sized = frame.select("id", F.size("tokens").cast("long").alias("n"))
    got = {(r.id, r.n): r.start for r in running_starts(sized, "n", "id", partitions=partitions).collect()}
    start, expected = 0, {}
    for key, tokens in sorted(rows):
        expected[(key, len(tokens))] = start
        start += len(tokens)
    assert got == expected


@pytest.mark.parametrize("size", [1, 16, 1000, 10**6])
def test_packs_match_brute_force(spark, size):
    rows, frame = docs(spark)
    stream = [t for _, tokens in sorted(rows) for t in tokens]
    expected = [stream[i : i + size] for i in range(0, len(stream), size)]
    packs = packed_tokens(frame, "id", "tokens", size, partitions=4).orderBy("pack_id").collect()
    assert [p.tokens for p in packs] == expected
    assert [p.pack_id for p in packs] == list(range(len(expected)))
    layout = pack_layout(frame.select("id", F.size("tokens").alias("n")), "id", "n", size).collect()
    filled = {}
    for r in layout:
        filled[r.pack_id] = filled.get(r.pack_id, 0) + r.piece_len
    assert filled == {i: len(p) for i, p in enumerate(expected)}


def test_layout_spreads_a_key_that_holds_most_rows(spark):
    frame = spark.range(4000).selectExpr("if(id % 4 = 0, id, -1) AS id", "3L AS n")
    layout = pack_layout(frame, "id", "n", 10, partitions=8)
    total = layout.agg(F.sum("piece_len"), F.count_distinct("pack_id")).first()
    assert tuple(total) == (12000, 1200)
    overlaps = layout.groupBy("pack_id").agg(
        F.sum("piece_len").alias("n"), F.max(F.col("pack_offset") + F.col("piece_len")).alias("m")
    )
    assert overlaps.filter("n <> 10 OR m <> 10").count() == 0
    sizes = running_starts(frame, "n", "id", partitions=8)
    assert sizes.count() == 4000
    assert sizes.agg(F.count_distinct("start")).first()[0] == 4000


def test_packing_tokens_of_repeated_keys(spark):
    frame = spark.range(2000).selectExpr("if(id % 3 = 0, id, -1) AS id", "array(string(id), 't') AS tokens")
    packs = packed_tokens(frame.repartition(4), "id", "tokens", 7, partitions=8).orderBy("pack_id").collect()
    stream = [t for p in packs for t in p.tokens]
    assert [len(p.tokens) for p in packs] == [7] * (4000 // 7) + [4000 % 7]
    assert sorted(stream) == sorted([str(i) for i in range(2000)] + ["t"] * 2000)
    assert all(t == "t" for t in stream[1::2])


def test_packing_tokens_of_other_types(spark):
    rows = [(i, [i, None][: i % 3]) for i in range(20)]
    frame = spark.createDataFrame(rows, "id long, tokens array<long>")
    packs = packed_tokens(frame, "id", "tokens", 4, partitions=3).orderBy("pack_id").collect()
    assert [t for p in packs for t in p.tokens] == [t for _, tokens in rows for t in tokens]
    assert packed_tokens(frame.filter("id < 0"), "id", "tokens", 4).collect() == []
    with pytest.raises(Exception, match="is NULL"):
        packed_tokens(spark.createDataFrame([(1, None)], "id long, tokens array<long>"), "id", "tokens", 4)


def test_packing_moves_the_tokens_once(spark):
    _, frame = docs(spark)
    plan = packed_tokens(frame, "id", "tokens", 16)._jdf.queryExecution().executedPlan().toString()
    small = ("BroadcastExchange", "SinglePartition")  # the totals, one row per range
    moves = [line for line in plan.split("\n") if "Exchange" in line and not any(s in line for s in small)]
    assert len(moves) == 1 and "pack_id" in moves[0]  # the pieces at the edges of ranges


def test_batches_match_brute_force_and_do_not_depend_on_partitions(spark):
    n, seed = 500, 11
    results = []
    for parts in (1, 9):
        frame = spark.range(n).repartition(parts).withColumn("text", F.lit("x"))
        batches = assign_batches(frame, "id", seed, batch_size=4, epochs=3, accumulation=2, devices=2)
        results.append(sorted(map(tuple, batches.collect())))
    expected = []
    for epoch in range(3):
        order = sorted(range(n), key=lambda k: (digest(seed, epoch, k), k))
        expected += [(epoch, k, p, p // 4, p // 16) for p, k in enumerate(order)]
    assert results == [sorted(expected)] * 2


def test_batches_give_repeated_keys_a_place_each(spark):
    hot = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) AS id")
    rows = assign_batches(hot, "id", 1, batch_size=4, epochs=2).collect()
    keys = [5 if i % 3 == 0 else i for i in range(3000)]
    for epoch in range(2):
        placed = sorted((r.pos, r.id) for r in rows if r.epoch == epoch)
        assert [p for p, _ in placed] == list(range(3000))
        assert [k for _, k in placed] == sorted(keys, key=lambda k: (digest(1, epoch, k), k))


def test_batches_keep_a_null_key(spark):
    frame = spark.createDataFrame([(None,), ("",), ("a",)], "id string")
    assert assign_batches(frame, "id", 1, batch_size=2).count() == 3


def test_written_batches_are_split_by_epoch(spark, folder):
    batches = assign_batches(spark.range(100), "id", 1, batch_size=4, epochs=2)
    write_batches(batches, folder)
    back = spark.read.parquet(folder)
    assert back.count() == 200
    assert "epoch" in {f.name for f in back.schema.fields}
    plan = back.filter("epoch = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in plan


@pytest.mark.parametrize("rows,last", [(0, 0), (8, 8), (17, 1)])
def test_train_plan(spark, rows, last):
    plan = train_plan(spark.range(rows), batch_size=8, epochs=3, accumulation=2).first()
    batches, steps = -(-rows // 8), -(-rows // 16)
    assert tuple(plan) == (rows, batches, steps, steps * 3, last)


def expected_sample(keys, size, seed):
    return sorted(sorted(keys, key=lambda k: (digest(seed, k), k))[:size])


@pytest.mark.parametrize("size", [1, 7, 250, 999, 1000, 5000])
def test_samples_match_brute_force(spark, size):
    frame = spark.range(1000).withColumn("text", F.col("id").cast("string"))
    got = sorted(r.id for r in seeded_sample(frame, size, 5, "id").collect())
    assert got == expected_sample(range(1000), size, 5)


def test_sample_of_many_copies(spark):
    """One key holds most rows: any of its copies may be taken, but exactly enough of them."""
    frame = spark.range(3000).selectExpr("if(id % 3 = 0, id, -1) AS id").repartition(6)
    keys = [i if i % 3 == 0 else -1 for i in range(3000)]
    for size in (40, 700, 1500, 2900):
        got = sorted(r.id for r in seeded_sample(frame, size, 5, "id").collect())
        assert got == expected_sample(keys, size, 5), size


def test_a_sample_reads_its_source_twice(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    for rows, size in ((1000, 10), (1000, 999), (200_000, 90_000)):
        reads.value = 0
        source = spark.range(rows).mapInArrow(counted, "id bigint")
        assert seeded_sample(source, size, 1, "id").count() == size
        assert reads.value == 2 * rows


def test_a_sample_of_repeated_keys_does_not_depend_on_the_layout(spark):
    rows = spark.range(4000).selectExpr("id % 3 AS key", "cast(id div 3 AS string) AS text")
    one, two = (
        {tuple(r) for r in seeded_sample(rows.repartition(n), 1700, 5, "key").collect()} for n in (3, 8)
    )
    assert one == two and len(one) == 1700


def test_a_sample_sorts_and_moves_no_rows(spark):
    plan = seeded_sample(spark.range(1000), 10, 1, "id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan and "Sort" not in plan


def test_unset_sample_size_keeps_all(spark):
    for size in (None, 0):
        assert seeded_sample(spark.range(10), size, 1, "id").count() == 10


def test_stored_samples_join_their_batches_where_they_lie(spark, folder):
    rows = spark.range(500).select("id", F.concat(F.lit("text "), "id").alias("text"))
    tag = folder.rsplit("-", 1)[1].replace("_", "x")
    samples = write_bucketed(rows, f"samples_{tag}", f"{folder}/samples", ["id"], ["id"], 4)
    numbered = assign_batches(rows, "id", 5, batch_size=8, epochs=2)
    batches = write_bucketed(numbered, f"batches_{tag}", f"{folder}/batches", ["id"], ["id"], 4)
    steps = write_steps(samples, batches, "id", f"steps_{tag}", f"{folder}/steps", 4)
    joined = batches.hint("merge").join(samples, "id")
    sums = steps.groupBy("epoch", "step").agg(F.count("*").alias("n"))
    for frame in (joined, sums):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    expected = {(r.epoch, r.pos, r.step, r.id) for r in numbered.collect()}
    assert {(r.epoch, r.pos, r.step, r.id) for r in steps.collect()} == expected
    assert steps.filter("text <> concat('text ', id)").count() == 0
    assert sums.filter("n <> if(step = 62, 4, 8)").count() == 0
    with pytest.raises(ValueError, match="pos"):
        write_steps(rows.withColumn("pos", F.lit(1)), batches, "id", "never", f"{folder}/never", 4)
