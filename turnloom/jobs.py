"""spark-submit entry points: normalise raw chat lines, also as they arrive; prepare training text."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnloom.functions import last_key_wins
from turnloom.operators.layout import assign_batches, packed_tokens, truncate, words, write_batches
from turnloom.operators.shapes import INPUT_FIELD, OUTPUT_FIELD
from turnloom.operators.template_text import is_template_text
from turnloom.operators.templates import Template
from turnloom.plans.normalise import normalise, observe_outcomes, rejects, report_object
from turnloom.plans.prepare import prepare_paths, profile
from turnloom.sources.jsonl import load_dataset, read_lines, read_numbered_lines, read_placed_lines
from turnloom.sources.jsonl import write_jsonl, write_jsonl_by, write_jsonl_in_order
from turnloom.streaming.normalise import count_stream, normalise_stream, write_stream

logger = logging.getLogger(__name__)


def run_normalise(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    input_field: str = INPUT_FIELD,
    output_field: str = OUTPUT_FIELD,
    rejects_path: str | None = None,
    by_outcome: bool = False,
    keep_order: bool = False,
    compression: str | None = None,
) -> dict[str, int]:
    """Write the accepted samples and return the count of each outcome.

    The plain job is one pass without a shuffle. `by_outcome` writes rejects too, in the same
    pass, into folders outcome=processed, outcome=error and outcome=dropped. `rejects_path`
    keeps them apart from the samples at the price of a second pass. Both number the lines, which
    takes a counting scan first. `keep_order` writes a folder per input block, so that files in name
    order hold the samples in the order of the input; it takes no further pass and no shuffle.
    `compression` is a codec of Spark's text files, like gzip, for all that is written.
    """
    if by_outcome and (rejects_path or keep_order):
        raise ValueError("by_outcome writes rejects itself and keeps no order; drop the other option")
    last_key_wins(spark)

    def judged(lines: DataFrame) -> DataFrame:
        return normalise(lines, "line", input_field, output_field)

    outcomes = Observation("outcomes")
    if by_outcome:
        counted = observe_outcomes(judged(read_numbered_lines(spark, input_path)), outcomes)
        report = report_object(counted, "line", output_field)
        write_jsonl_by(counted, output_path, report, "outcome", compression)
        return dict(outcomes.get)
    lines = (read_placed_lines if keep_order else read_lines)(spark, input_path)
    kept = observe_outcomes(judged(lines), outcomes).filter(F.col("outcome") == "processed")
    write = write_jsonl_in_order if keep_order else write_jsonl
    write(kept, output_path, [F.col("messages").alias(output_field)], compression)
    if rejects_path:
        failed = rejects(judged(read_numbered_lines(spark, input_path)))
        write_jsonl(failed.drop("line"), rejects_path, compression=compression)
    return dict(outcomes.get)


def run_prepare(
    spark: SparkSession,
    train_path: str,
    eval_path: str | None,
    output_path: str,
    key: str | None = None,
    columns: Sequence[str] = (),
    text_field: str = "text",
    max_seq_length: int | None = None,
    packing: bool = False,
    batch_size: int | None = None,
    accumulation: int = 1,
    epochs: int = 1,
    seed: int = 3407,
    **options: Any,
) -> dict[str, tuple[int, dict | None]]:
    """Write train and eval text and return the row count and an example of each split.

    All other fields of the records are written too, or only the declared columns. With max_seq_length the words of each text are cut, or with
    `packing` joined and cut, into `train_tokens` and `eval_tokens`; with batch_size the seeded
    order of the training split is written to `batches`. These three need the key, which names
    one row. All of them start from the text as it was written.
    """
    if (packing or batch_size) and not key:
        raise ValueError("packing and batches need a key")
    if packing and not max_seq_length:
        raise ValueError("packing needs max_seq_length")
    keys = [key] if key else []
    splits = prepare_paths(
        spark, train_path, eval_path, *keys, columns=columns, text_field=text_field, seed=seed, **options
    )
    report = {}
    for name, split in zip(("train", "eval"), splits):
        if split is None:
            continue
        path = f"{output_path.rstrip('/')}/{name}"
        replaced = (options.get("messages_field", "messages"), text_field)
        kept = [column for column in split.columns if column not in replaced]
        write_jsonl(split, path, [*kept, text_field])
        written = load_dataset(spark, path, split.select(*kept, text_field).schema)
        report[name] = profile(written)
        if max_seq_length:
            tokens = written.withColumn("tokens", words(F.col(text_field))).drop(text_field)
            if packing:
                laid = packed_tokens(tokens, key, "tokens", max_seq_length)
            else:
                laid = truncate(tokens, "tokens", max_seq_length)
            laid.write.mode("overwrite").parquet(f"{path}_tokens")
        if batch_size and name == "train":
            order = options.get("shuffle_seed") or seed
            batches = assign_batches(written, key, order, batch_size, epochs, accumulation)
            write_batches(batches, f"{output_path.rstrip('/')}/batches")
    return report


def run_stream(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    input_field: str = INPUT_FIELD,
    output_field: str = OUTPUT_FIELD,
    every: str | None = None,
    **options: str,
) -> list[StreamingQuery]:
    """Normalise the files that are new since the last run, and count the outcomes of all runs.

    Verdicts go to `verdicts` below the output, one folder per outcome, and the totals so far to
    `totals`; what a later run needs to go on is in `progress`. Returns when all files are
    read, or at once with two running queries where `every` says how often to look for more.
    """
    base = output_path.rstrip("/")
    last_key_wins(spark)
    judged = normalise_stream(spark, input_path, input_field, output_field, **options)
    writer = write_stream(judged, f"{base}/verdicts", f"{base}/progress/verdicts", every=every)
    if every is None:
        writer.awaitTermination()
    counter = count_stream(spark, f"{base}/verdicts", f"{base}/totals", f"{base}/progress/totals", every)
    if every is None:
        counter.awaitTermination()
    return [writer, counter]


def stream_totals(spark: SparkSession, output_path: str) -> dict[str, int]:
    """The outcome counts of all runs of run_stream so far."""
    totals = spark.read.parquet(f"{output_path.rstrip('/')}/totals")
    return {row["outcome"]: row["n"] for row in totals.collect()}


def truth(text: str) -> bool:
    """A flag's value: empty, false, no, off, none, null and 0 are false."""
    return text.strip().lower() not in ("", "false", "no", "off", "none", "null", "0")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="turnloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    norm = jobs.add_parser("normalise", help="raw chat lines to one messages list per line")
    norm.add_argument("--input", required=True)
    norm.add_argument("--output", required=True)
    norm.add_argument("--input_field", default=INPUT_FIELD)
    norm.add_argument("--output_field", default=OUTPUT_FIELD)
    norm.add_argument("--rejects", help="also write rejected lines, in a second pass")
    norm.add_argument("--by_outcome", action="store_true", help="one pass, a folder per outcome")
    norm.add_argument("--keep_order", action="store_true", help="a folder per input block, in input order")
    norm.add_argument("--compression", help="codec of the written files, like gzip")
    live = jobs.add_parser("stream", help="normalise files as they arrive")
    live.add_argument("--input", required=True)
    live.add_argument("--output", required=True, help="folder for verdicts, totals and progress")
    live.add_argument("--input_field", default=INPUT_FIELD)
    live.add_argument("--output_field", default=OUTPUT_FIELD)
    live.add_argument("--every", help='go on and look for files this often, like "30 seconds"')
    live.add_argument("--files_per_batch", help="at most so many files in a micro-batch")
    prep = jobs.add_parser("prepare", help="messages or text to training text")
    prep.add_argument("--train", required=True)
    prep.add_argument("--eval")
    prep.add_argument("--output", required=True, help="folder for train and eval")
    prep.add_argument("--use_chat_template", type=truth, default=False)
    prep.add_argument("--chat_template_name")
    prep.add_argument(
        "--template",
        type=lambda text: text if is_template_text(text) else Template(**json.loads(text)),
        help='own template: its text with {{ }} and {%% %%}, or JSON like {"prefix": "<", "infix": ":", "suffix": ">"}',
    )
    prep.add_argument("--column", action="append", default=[], help='keep only such columns, like "id bigint"; default all')
    prep.add_argument("--key", help="field that names a row and orders samples and packs")
    prep.add_argument("--check_all", type=truth, default=True, help="check rows outside the sample too")
    prep.add_argument("--max_seq_length", type=int)
    prep.add_argument("--packing", type=truth, default=False)
    prep.add_argument("--batch_size", type=int)
    prep.add_argument("--accumulation", type=int, default=1)
    prep.add_argument("--epochs", type=int, default=1)
    prep.add_argument("--messages_field", default="messages")
    prep.add_argument("--text_field", default="text")
    prep.add_argument("--max_samples", type=int)
    prep.add_argument("--seed", type=int, default=3407)
    prep.add_argument("--shuffle_seed", type=int)
    return parser


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"turnloom-{args.job}").getOrCreate()
    if args.job == "normalise":
        counts = run_normalise(
            spark,
            args.input,
            args.output,
            args.input_field,
            args.output_field,
            rejects_path=args.rejects,
            by_outcome=args.by_outcome,
            keep_order=args.keep_order,
            compression=args.compression,
        )
        logger.info("outcomes: %s", counts)
        return
    if args.job == "stream":
        options = {"maxFilesPerTrigger": args.files_per_batch} if args.files_per_batch else {}
        queries = run_stream(
            spark, args.input, args.output, args.input_field, args.output_field, args.every, **options
        )
        if args.every:
            spark.streams.awaitAnyTermination()
        for query in queries:
            query.stop()
        logger.info("outcomes so far: %s", stream_totals(spark, args.output))
        return
    report = run_prepare(
        spark,
        args.train,
        args.eval,
        args.output,
        key=args.key,
        columns=args.column,
        max_seq_length=args.max_seq_length,
        packing=args.packing,
        batch_size=args.batch_size,
        accumulation=args.accumulation,
        epochs=args.epochs,
        check_all=args.check_all,
        use_chat_template=args.use_chat_template,
        template=args.template or args.chat_template_name,
        messages_field=args.messages_field,
        text_field=args.text_field,
        max_samples=args.max_samples,
        seed=args.seed,
        shuffle_seed=args.shuffle_seed,
    )
    for name, (rows, example) in report.items():
        logger.info("%s: %d rows, for example %s", name, rows, example)


if __name__ == "__main__":
    main()
