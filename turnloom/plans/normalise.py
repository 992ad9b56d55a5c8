"""Normalise raw chat lines: parse, adapt the shape, validate, split by outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from turnloom.functions import column, let, require_last_key_wins, strict_json
from turnloom.operators.messages import check_messages, verdict
from turnloom.operators.shapes import INPUT_FIELD, OUTPUT_FIELD, envelope, extract_messages
from turnloom.operators.shapes import raw_contents

OUTCOMES = ("processed", "error", "dropped")
KEYS_SHOWN = 5


def normalise(
    lines: DataFrame,
    line: str = "line",
    input_field: str = INPUT_FIELD,
    output_field: str = OUTPUT_FIELD,
) -> DataFrame:
    """One verdict per line: shape, outcome, reason, msg_index, detail, messages.

    `lines` holds stripped, non-blank text as read_lines gives it; its other columns stay. The
    plan is one narrow stage without a shuffle and serves batch and streaming frames alike.

    The steps are nested lets in one expression, so a line is parsed once and the intermediate
    values are never copied into rows. The generator around it keeps later filters above it;
    they would otherwise bring their own copy of the parse along.
    """
    outcome = verdict(column(line), "rec", "env", "picked", "checked")
    raws = raw_contents(column(line), "rec", "env", "picked.shape", input_field, output_field)
    checked = let("checked", check_messages("picked.messages", raws), outcome)
    picked = let("picked", extract_messages("env"), checked)
    env = let("env", envelope("rec", input_field, output_field), picked)
    judged = let("rec", strict_json(column(line)), env)
    require_last_key_wins(lines.sparkSession)
    wide = lines.selectExpr("*", f"explode(array({judged})) AS verdict")
    return wide.selectExpr(*map(column, lines.columns), "verdict.*")


def accepted(judged: DataFrame) -> DataFrame:
    """Samples whose every message is valid."""
    return judged.filter(F.col("outcome") == "processed").drop(
        "outcome", "reason", "msg_index", "detail"
    )


def _first_keys(line: str) -> Column:
    keys = F.slice(F.array_distinct(F.json_object_keys(F.col(line))), 1, KEYS_SHOWN)
    return F.when(F.col("reason") == "no_messages", keys)


def rejects(judged: DataFrame, line: str = "line") -> DataFrame:
    """Lines that gave no sample, with the reason and the first keys of a record without messages."""
    failed = judged.filter(F.col("outcome") != "processed")
    return failed.withColumn("keys", _first_keys(line)).drop("messages", "shape")


def report_object(judged: DataFrame, line: str = "line", output_field: str = OUTPUT_FIELD) -> Column:
    """What is written about any line: the messages of a sample, else where and why it failed."""
    failed = F.col("outcome") != "processed"
    about = [c for c in judged.columns if c not in (line, "shape", "outcome", "messages")]
    return F.struct(
        F.col("messages").alias(output_field),
        *(F.when(failed, F.col(c)).alias(c) for c in about),
        _first_keys(line).alias("keys"),
    )


def outcome_counts(judged: DataFrame) -> DataFrame:
    """Number of lines per outcome."""
    return judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def observe_outcomes(judged: DataFrame, observation: Observation | str) -> DataFrame:
    """Count the outcomes while another action runs, without a pass of their own."""
    return judged.observe(
        observation, *(F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES)
    )
