"""The normaliser over newly arriving JSONL files, and the running totals of its outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnloom.operators.shapes import INPUT_FIELD, OUTPUT_FIELD
from turnloom.plans.normalise import normalise, observe_outcomes
from turnloom.sources.jsonl import stream_lines


def normalise_stream(
    spark: SparkSession,
    path: str,
    input_field: str = INPUT_FIELD,
    output_field: str = OUTPUT_FIELD,
    **options: str,
) -> DataFrame:
    """Verdicts of the lines below path as a streaming frame; the same plan as the batch job."""
    return normalise(stream_lines(spark, path, **options), "line", input_field, output_field)


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def count_stream(
    spark: SparkSession, path: str, totals: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start adding up what write_stream wrote below path, one row per outcome in `totals`.

    The running totals are the state of a streaming aggregate, kept in the checkpoint, so they go
    on where a stopped run left off and every written line counts once. Only the names of
    the outcome folders are read. `totals` is replaced after every micro-batch, which shows the
    progress; writing one batch again gives the same table.
    """

    def replace(counts: DataFrame, batch: int) -> None:
        counts.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("overwrite").parquet(totals)

    written = spark.readStream.schema("outcome string").parquet(path)
    return (
        written.groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("n"))
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .outputMode("complete")
        .trigger(**_trigger(every))
        .start()
    )


def write_stream(
    judged: DataFrame, path: str, checkpoint: str, format: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Start writing all verdicts, one folder per outcome, and stop when the files are read.

    With `every`, like "30 seconds", it goes on and looks for new files that often.

    Each micro-batch reports its outcome counts as the observed metrics named `outcomes`.
    """
    return (
        observe_outcomes(judged, "outcomes")
        .writeStream.format(format)
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )
