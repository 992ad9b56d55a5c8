"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT
(default 2: the best run counts, the first also warms the JVM) and BENCH_COPIES (default 40:
how many copies of the table the throughput part normalises).
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.catalog import QUERIES
from turnloom.fixtures import raw_lines
from turnloom.operators.layout import pack_layout
from turnloom.operators.sampling import seeded_sample
from turnloom.operators.templates import render_chat
from turnloom.plans.normalise import accepted, normalise
from turnloom.sources.jsonl import read_lines
from turnloom.sources.scratch import scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))
COPIES = int(os.environ.get("BENCH_COPIES", "40"))

HEADLINE = """render_conversations read_lines read_lines_numbered parse_outcomes jsonl_roundtrip
detect_shape norm_canonical norm_mixed norm_instruction accepted_samples rejects rejects_numbered
outcome_counts normalise_files stream_normalise strict_violations render_chatml render_named
text_mode sample_train sample_train_large prepare_splits truncate pack pack_tokens assign_batches
train_plan""".split()


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def best(action: Callable[[], None]) -> float:
    times = []
    for _ in range(REPEAT):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def throughput(spark: SparkSession) -> dict[str, float]:
    """Records per second over copies of the canonical lines, and over copied documents."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    path = scratch_path(spark, "copies")
    lines = raw_lines(spark, SF_DIR, "canonical", "from_value")
    lines.withColumn("copy", copies).select("line").write.text(path)
    samples = accepted(normalise(read_lines(spark, path)))
    rendered = samples.select(render_chat(F.col("messages")).alias("text"))
    n_lines = read_lines(spark, path).count()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("copy", copies)
    keyed = documents.select(F.concat_ws("-", "copy", "doc_id").alias("key"), "n_chars")
    n_documents = keyed.count()
    return {
        "normalise": round(n_lines / best(lambda: run(samples))),
        "normalise_and_render": round(n_lines / best(lambda: run(rendered))),
        "sample": round(n_documents / best(lambda: run(seeded_sample(keyed, 50_000, 1, "key")))),
        "pack": round(n_documents / best(lambda: run(pack_layout(keyed, "key", "n_chars", 2048)))),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("turnloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: best(lambda: run(QUERIES[name](spark, SF_DIR))) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "records_per_sec": throughput(spark),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
