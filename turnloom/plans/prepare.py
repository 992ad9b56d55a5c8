"""Prepare training and evaluation sets: load, render or take the text, sample, profile."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from turnloom.operators.sampling import seeded_sample
from turnloom.operators.templates import Template, observe_faults, require_field
from turnloom.operators.templates import strict_render, text_mode
from turnloom.sources.jsonl import load_dataset


def prepare(
    df: DataFrame,
    *keys: str,
    use_chat_template: Any = False,
    template: Template | str | None = None,
    formatter: Callable[[Column], Column] | None = None,
    messages_field: str = "messages",
    text_field: str = "text",
    max_samples: int | None = None,
    seed: int = 3407,
    shuffle_seed: int | None = None,
    check_all: bool = True,
) -> DataFrame:
    """One split ready for training, sampled first so that only kept rows are rendered.

    use_chat_template is any truthy value, also a template name in a config. `formatter` maps
    the message list to text in place of a template. Keys give the sample its order; without
    keys the text or the messages do. A faulty message list stops the job, also that of a row
    outside the sample unless check_all is off: the check rides on the sample's first read.
    """
    field = messages_field if use_chat_template else text_field
    require_field(df, field)
    if max_samples and not keys:
        df = df.withColumn("_content", F.to_json(F.struct(field)))
        keys = ("_content",)
    faults = Observation("faults")

    def watch(rows: DataFrame) -> DataFrame:
        return observe_faults(rows, faults, messages_field)

    checked = use_chat_template and check_all and max_samples
    sample = seeded_sample(
        df, max_samples, shuffle_seed or seed, *keys, watch=watch if checked else None
    ).drop("_content")
    if checked and faults.get["rows"]:
        found = faults.get
        raise ValueError(f"field {messages_field!r} is not sound in {found['rows']} rows: {found['example']}")
    if not use_chat_template:
        return text_mode(sample, text_field)
    return strict_render(sample, template, messages_field, text_field, formatter=formatter)


def prepare_splits(
    train: DataFrame, evaluation: DataFrame | None, *keys: str, **options: Any
) -> tuple[DataFrame, DataFrame | None]:
    """The same steps for both splits; only the training split is sampled."""
    ready = prepare(train, *keys, **options)
    if evaluation is None:
        return ready, None
    return ready, prepare(evaluation, *keys, **{**options, "max_samples": None})


def prepare_paths(
    spark: SparkSession,
    train_path: str,
    eval_path: str | None = None,
    *keys: str,
    columns: Sequence[str] = (),
    **options: Any,
) -> tuple[DataFrame, DataFrame | None]:
    """prepare_splits over JSONL paths.

    All fields of the records are kept, with the types their values share. `columns`, like
    "id bigint", declares the ones to keep instead and saves the pass that finds them; keys
    have to be among them. The messages are read as VARIANT, which tells a null from an absent key.
    """
    fields = {
        options.get("text_field", "text"): "string",
        options.get("messages_field", "messages"): "variant",
    }
    schema = ", ".join([*columns, *(f"`{name}` {kind}" for name, kind in fields.items())])
    train, evaluation = (
        load_dataset(spark, p, schema if columns else None, fields) for p in (train_path, eval_path)
    )
    return prepare_splits(train, evaluation, *keys, **options)


def profile(df: DataFrame) -> tuple[int, dict | None]:
    """Row count and one example row, in one pass."""
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("*")).alias("example")).first()
    return seen["n"], seen["example"].asDict(recursive=True) if seen["example"] else None
