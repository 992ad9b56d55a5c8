"""Line-oriented sources and sinks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.functions import loose_json, not_blank, python_strip
from turnloom.sources.scratch import pin

# The JSON reader stops at 20 million characters by default.
LONGEST_TEXT = str((1 << 31) - 1)
# Offsets have one row of about 100 bytes per scanned block and are broadcast up to this many,
# 250 TB in blocks of 128 MiB.
BROADCAST_BLOCKS = 2_000_000
# Names the folders of an output that keeps the order of its input.
INPUT_BLOCK = "input_block"
CASE_SENSITIVE = "spark.sql.caseSensitive"


def _stripped(lines: DataFrame) -> DataFrame:
    kept = lines.filter(not_blank("value"))
    return kept.withColumn("line", F.expr(python_strip("value"))).drop("value")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines of text files, stripped: file_path, line."""
    text = spark.read.text(path)
    return _stripped(text.select(F.col("_metadata.file_path").alias("file_path"), "value"))


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same lines as a stream of newly arriving files."""
    text = spark.readStream.options(**options).text(path)
    return _stripped(text.select(F.col("_metadata.file_path").alias("file_path"), "value"))


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines with their 1-based number in the file, blank lines counted.

    A first pass counts the lines of each scanned block and notes the row id of its first
    line. The second pass turns its own row ids into numbers with a broadcast join on the block,
    so the text is never sorted or shuffled. A block is at most one split, however large the file
    is. With more blocks than may be broadcast the job stops and asks for larger ones.
    """
    # Files are told apart by a hash: blocks of one task only, and checked by the row ids below.
    block = ["task", "file_id", "block_start"]
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )
    rows = rows.withColumn("task", F.shiftright("row_id", 33)).withColumn("file_id", F.xxhash64("file_path"))
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = pin(
        rows.groupBy("file_path", *block)
        .agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n_lines"))
        .withColumn("lines_before", F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)))
        .drop("file_path")
    )
    if blocks.count() > BROADCAST_BLOCKS:
        raise ValueError("too many blocks to number; raise spark.sql.files.maxPartitionBytes or merge files")
    step = F.col("row_id") - F.col("first_id")
    same_scan = (step >= 0) & (step < F.col("n_lines"))
    moved = F.raise_error(
        F.lit("the files were split differently in the two passes; fix spark.sql.files settings")
    )
    number = F.when(same_scan, F.col("lines_before") + step + 1).otherwise(moved.cast("bigint"))
    numbered = rows.join(F.broadcast(blocks), block, "left").select(
        "file_path", number.alias("line_num"), "value"
    )
    return _stripped(numbered)


def _one_form(uri: str) -> str:
    """Local files are listed as file:///x and scanned as file:/x."""
    return re.sub("^file:/+", "file:/", uri)


def read_placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines with their place in the input: file_path, input_block, row_id, line.

    input_block is text, the number of the file in path order and where the scanned block begins;
    row_id grows inside a block. The order is known from the file listing, so nothing is counted.
    """
    text = spark.read.text(path)
    files = sorted(map(_one_form, text.inputFiles()))
    if len(files) > BROADCAST_BLOCKS:
        raise ValueError("too many files to keep their order; merge files")
    numbers = spark.createDataFrame(list(enumerate(files)), "number long, file_path string")
    block = F.format_string("%08d-%015d", "number", "block_start").alias(INPUT_BLOCK)
    placed = text.select(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    ).join(F.broadcast(numbers), "file_path")
    return _stripped(placed.select("file_path", block, "row_id", "value"))


def write_jsonl(
    df: DataFrame,
    path: str,
    columns: list[str | Column] | None = None,
    compression: str | None = None,
) -> None:
    """One JSON object per row into part files below path; replaces what is there."""
    fields = F.struct(*(columns or df.columns))
    df.select(F.to_json(fields).alias("value")).write.mode("overwrite").text(path, compression)


def lines_in_order(df: DataFrame, columns: list[str | Column]) -> DataFrame:
    """value and input_block, in input order inside each task.

    `df` comes from read_placed_lines by narrow steps. Every block of the input was read by one
    task, so rows are sorted there and never moved.
    """
    rows = df.select(F.to_json(F.struct(*columns)).alias("value"), INPUT_BLOCK, "row_id")
    return rows.sortWithinPartitions(INPUT_BLOCK, "row_id").select("value", INPUT_BLOCK)


def write_jsonl_in_order(
    df: DataFrame, path: str, columns: list[str | Column], compression: str | None = None
) -> None:
    """One JSON object per row, a folder per input block: name order is the order of the input."""
    ordered = lines_in_order(df, columns).write.mode("overwrite").partitionBy(INPUT_BLOCK)
    ordered.text(path, compression)


def write_jsonl_by(
    df: DataFrame, path: str, value: Column, by: str, compression: str | None = None
) -> None:
    """One JSON object per row, one folder per value of `by`, all in a single pass."""
    rows = df.select(F.to_json(value).alias("value"), by)
    rows.write.mode("overwrite").partitionBy(by).text(path, compression)


def _spark_type(variant_type: str) -> str:
    """DDL of the type that schema_of_variant_agg names; quoted field names are left as they are.

    A column that only holds nulls is text. Integers beyond 64 bits keep all their digits, any
    other number with a fraction is a double. Values of several kinds stay VARIANT.
    """

    def standard(found: re.Match) -> str:
        word = found[0]
        if word == "OBJECT<>":
            return "VARIANT"
        if word == "OBJECT<":
            return "STRUCT<"
        if word == "VOID":
            return "STRING"
        if word.startswith("DECIMAL"):
            return "DECIMAL(38,0)" if int(found[1]) > 18 and int(found[2]) == 0 else "DOUBLE"
        return word

    return re.sub(r"`(?:[^`]|``)*`|OBJECT<>?|VOID|DECIMAL\((\d+),(\d+)\)", standard, variant_type)


def dataset_schema(
    spark: SparkSession, path: str | list[str], declared: Mapping[str, str] | None = None
) -> T.StructType:
    """Every field of the records below path with the type that all its values share.

    One aggregate over all lines, merged per task first; what reaches the driver is the schema.
    Declared fields have the type given there, whether a record has them or not.
    """
    lines = spark.read.text(path).filter(not_blank("value"))
    every = lines.agg(F.expr(f"schema_of_variant_agg({loose_json('value')})"))
    folds = spark.conf.get(CASE_SENSITIVE)
    spark.conf.set(CASE_SENSITIVE, "true")  # else one of two names that differ in case is lost
    try:
        merged = every.first()[0]
    finally:
        spark.conf.set(CASE_SENSITIVE, folds)
    fields = {}
    if merged.startswith("OBJECT<"):
        found = T.StructType.fromDDL(_spark_type(merged).removeprefix("STRUCT<").removesuffix(">"))
        fields = {field.name: field for field in found}
    for name, kind in (declared or {}).items():
        fields[name] = T.StructField(name, T.DataType.fromDDL(kind))
    if str(folds).lower() != "true":
        folded = Counter(name.lower() for name in fields)
        same = [name for name in fields if folded[name.lower()] > 1]
        if same:
            raise ValueError(f"fields differ in case only: {same}; set {CASE_SENSITIVE} to true")
    return T.StructType(list(fields.values()))


def load_dataset(
    spark: SparkSession,
    path: str | None,
    schema: T.StructType | str | None = None,
    declared: Mapping[str, str] | None = None,
) -> DataFrame | None:
    """Typed JSONL; None without a path. A malformed line or a missing path fails.

    Without a schema the records are read once to find all their fields, see dataset_schema. A
    field declared VARIANT keeps whatever the line holds.
    """
    if path is None:
        return None
    if schema is None:
        schema = dataset_schema(spark, path, declared)
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    loaded = reader.option("maxStringLen", LONGEST_TEXT).json(path)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return loaded if INPUT_BLOCK in fields.fieldNames() else loaded.drop(INPUT_BLOCK)
