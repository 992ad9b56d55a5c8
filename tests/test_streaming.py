import os

from pyspark.sql import functions as F

from turnloom.fixtures import raw_lines
from turnloom.jobs import main, run_stream, stream_totals
from turnloom.plans.normalise import normalise, outcome_counts
from turnloom.sources.jsonl import read_lines
from turnloom.streaming.normalise import normalise_stream, write_stream


def test_stream_equals_batch_and_reports_counts(spark, sf_dir, folder):
    source = os.path.join(folder, "source")
    raw_lines(spark, sf_dir).select("line").repartition(6).write.text(source)
    judged = normalise_stream(spark, source, maxFilesPerTrigger="2")
    target, progress = os.path.join(folder, "target"), os.path.join(folder, "progress")
    query = write_stream(judged, target, progress)
    query.awaitTermination()
    batch = normalise(read_lines(spark, source))
    written = spark.read.schema(judged.schema).parquet(target)
    columns = ["line", "shape", "outcome", "reason", "msg_index", "detail", "messages"]

    def keyed(df):
        return df.select(F.to_json(F.struct(*columns)).alias("row"))

    assert keyed(written).exceptAll(keyed(batch)).count() == 0
    assert keyed(batch).exceptAll(keyed(written)).count() == 0
    seen = {"processed": 0, "error": 0, "dropped": 0}
    for step in query.recentProgress:
        counts = step.observedMetrics.get("outcomes")
        for name in seen:
            seen[name] += counts[name] if counts else 0
    assert len(query.recentProgress) >= 3
    assert seen == {r.outcome: r.n for r in outcome_counts(batch).collect()}


def test_stream_goes_on_where_it_stopped(spark, folder):
    source, target = os.path.join(folder, "in"), os.path.join(folder, "out")
    progress = os.path.join(folder, "progress")
    os.mkdir(source)
    for n, name in enumerate(("a", "b")):
        with open(os.path.join(source, name), "w") as f:
            f.write(f'{{"prompt":"q{n}"}}\n')
        write_stream(normalise_stream(spark, source), target, progress).awaitTermination()
        assert spark.read.parquet(target).count() == n + 1


def test_totals_survive_a_restart_and_count_every_line_once(spark, folder):
    source, out = os.path.join(folder, "in"), os.path.join(folder, "out")
    os.mkdir(source)
    for n in range(3):
        with open(os.path.join(source, f"{n}.jsonl"), "w") as f:
            f.write('{"prompt":"q"}\n' * (n + 1) + "junk\n\n")
        main(["stream", f"--input={source}", f"--output={out}", "--files_per_batch=1"])
        assert stream_totals(spark, out) == {"processed": (n + 1) * (n + 2) // 2, "error": n + 1}
    main(["stream", f"--input={source}", f"--output={out}"])  # nothing new
    assert stream_totals(spark, out) == {"processed": 6, "error": 3}


def test_a_running_stream_shows_its_progress(spark, folder):
    source, out = os.path.join(folder, "in"), os.path.join(folder, "out")
    os.mkdir(source)
    queries = []
    try:
        for n in range(2):
            with open(os.path.join(source, f"{n}.jsonl"), "w") as f:
                f.write('{"prompt":"q"}\n' * 5)
            queries = queries or run_stream(spark, source, out, every="1 second")
            for _ in range(3):
                for query in queries:
                    query.processAllAvailable()
            assert stream_totals(spark, out) == {"processed": 5 * (n + 1)}
    finally:
        for query in queries:
            query.stop()
