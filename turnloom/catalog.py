"""Registered queries: each takes (spark, sf_dir), reads whole tables and returns scalars only."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnloom.fixtures import DIALECTS, as_messages, ordered_turns, raw_lines
from turnloom.functions import last_key_wins, not_blank, parse_record, python_strip
from turnloom.functions.values import WHITESPACE
from turnloom.jobs import run_normalise, run_prepare, run_stream
from turnloom.operators.layout import assign_batches, pack_layout, packed_tokens, train_plan
from turnloom.operators.layout import truncate, words, write_batches, write_bucketed, write_steps
from turnloom.operators.messages import normalise_role
from turnloom.operators.sampling import seeded_sample
from turnloom.operators.templates import TEMPLATES, render_chat, strict_render, text_mode
from turnloom.operators.templates import violations
from turnloom.plans.normalise import accepted, normalise, outcome_counts, rejects
from turnloom.plans.prepare import prepare_splits, profile
from turnloom.sources.jsonl import load_dataset, read_lines, read_numbered_lines, write_jsonl
from turnloom.sources.scratch import scratch_path
from turnloom.streaming.normalise import normalise_stream, write_stream

Query = Callable[[SparkSession, str], DataFrame]

SEED = 3407
PACK_SIZE = 512
MAX_WORDS = 128
SHARDS = 16
# Of written samples and rejects, which hold each conversation once per dialect.
PACKED = "gzip"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, *dialects: str) -> DataFrame:
    return raw_lines(spark, sf_dir, *dialects).filter(not_blank("line"))


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id and its typed message list."""
    turns = ordered_turns(_table(spark, sf_dir, "conversations"))
    return turns.select("conv_id", as_messages(F.col("turns")).alias("messages"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("tokens"))


def _exploded(samples: DataFrame, *keys: str) -> DataFrame:
    """One row per message: keys, 1-based idx, role, content."""
    rows = samples.select(*keys, F.posexplode("messages").alias("pos", "message"))
    return rows.select(
        *keys, (F.col("pos") + 1).cast("bigint").alias("idx"), "message.role", "message.content"
    )


def _write_files(lines: DataFrame, *order: str) -> str:
    """Write the lines to a fixed number of folders, each in the given order."""
    path = scratch_path(lines.sparkSession, "lines")
    shard = F.pmod("conv_id", F.lit(SHARDS))
    (
        lines.withColumn("shard", shard)
        .repartition("shard")
        .sortWithinPartitions("shard", *order)
        .select("shard", "line")
        .write.partitionBy("shard")
        .text(path)
    )
    return path


def _line_files(spark: SparkSession, sf_dir: str) -> str:
    """Write all raw lines as their tasks make them; only the turns are shuffled before."""
    path = scratch_path(spark, "lines")
    raw_lines(spark, sf_dir).select("line").write.text(path)
    return path


def _turn_files(spark: SparkSession, sf_dir: str) -> str:
    """Every turn as a JSON line, with a blank line before each conversation."""
    turns = _table(spark, sf_dir, "conversations")
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    line = F.when(F.col("turn") == 0, F.concat(F.lit(" \t\n"), record)).otherwise(record)
    return _write_files(turns.select("conv_id", "turn", line.alias("line")), "conv_id", "turn")


def _shard(file_path: Column) -> Column:
    return F.regexp_extract(file_path, r"shard=(\d+)", 1).cast("bigint")


# --- sources and sinks ---------------------------------------------------------------------


def lines_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.from_json("line", "conv_id bigint, turn bigint, text string").alias("t")
    return (
        read_lines(spark, _turn_files(spark, sf_dir))
        .select(turn)
        .select("t.conv_id", "t.turn", "t.text")
    )


def lines_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.from_json("line", "conv_id bigint, turn bigint").alias("t")
    return (
        read_numbered_lines(spark, _turn_files(spark, sf_dir))
        .select(_shard(F.col("file_path")).alias("shard"), "line_num", turn)
        .select("shard", "line_num", "t.conv_id", "t.turn")
    )


def parse_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_record(_lines(spark, sf_dir))
    return parsed.select("conv_id", "dialect", F.col("record").isNotNull().alias("ok"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip")
    write_jsonl(_conversations(spark, sf_dir), path)
    schema = "conv_id bigint, messages array<struct<role:string,content:string>>"
    return _exploded(load_dataset(spark, path, schema), "conv_id")


def dataset_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose further fields differ: the loader finds all of them and their types."""
    mixed = """CASE turn % 3 WHEN 0 THEN concat(',"mixed":', turn) WHEN 1 THEN ',"mixed":"one"' ELSE '' END"""
    line = f"""concat('{{"note":null', {mixed}, ',', substr(to_json(named_struct(
        'conv_id', conv_id, 'turn', turn, 'score', if(turn % 2 = 0, turn / 4, NULL),
        'a tag', if(turn % 3 = 0, text, NULL),
        'meta', if(turn % 4 = 0, named_struct('role', role, 'parts', array(turn, conv_id)), NULL))), 2))"""
    turns = _table(spark, sf_dir, "conversations")
    path = _write_files(turns.selectExpr("conv_id", "turn", f"{line} AS line"), "conv_id", "turn")
    return load_dataset(spark, path).select(
        "conv_id",
        "turn",
        "score",
        F.col("`a tag`").alias("tag"),
        "meta.role",
        F.get("meta.parts", F.lit(1)).alias("part"),
        F.to_json("mixed").alias("mixed"),
        "note",
    )


# --- shapes --------------------------------------------------------------------------------


def detect_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(_lines(spark, sf_dir)).select("conv_id", "dialect", "shape")


def _norm(dialect: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _exploded(accepted(normalise(_lines(spark, sf_dir, dialect))), "conv_id")

    return query


def plus_infinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number that Python does not read makes the line malformed."""
    judged = normalise(_lines(spark, sf_dir, "plus_infinity"))
    return judged.select("conv_id", "shape", "outcome", "reason")


def output_field_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output field already holds a list: it is taken as it is, whatever its items are."""
    lines = _lines(spark, sf_dir, "role_content", "from_value")
    judged = normalise(lines, output_field="conversations")
    return judged.select(
        "conv_id", "dialect", "shape", "outcome", "reason", F.col("msg_index").cast("bigint")
    )


# --- validation ----------------------------------------------------------------------------


def role_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    alias = F.when(role == "user", "Human").when(role == "assistant", "ChatGPT").otherwise("tool")
    spelled = F.array(role, F.upper(role), F.initcap(role), F.concat(F.lit(" "), role), alias)
    names = _table(spark, sf_dir, "conversations").select(F.explode(spelled).alias("role_in"))
    return (
        names.groupBy("role_in")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("role_in", F.expr(normalise_role("role_in")).alias("role_out"), "n")
    )


def content_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer = F.lit(WHITESPACE)
    padded = F.concat(outer, F.col("text"), F.reverse(outer))
    turns = _table(spark, sf_dir, "conversations").withColumn("padded", padded)
    return turns.select("conv_id", "turn", F.expr(python_strip("padded")).alias("content"))


def accepted_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(accepted(normalise(_lines(spark, sf_dir))), "conv_id", "dialect")


def _reject_columns(failed: DataFrame, *keys: str) -> DataFrame:
    return failed.select(
        *keys,
        "outcome",
        "reason",
        F.col("msg_index").cast("bigint"),
        "detail",
        F.array_join("keys", ",").alias("keys"),
    )


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reject_columns(rejects(normalise(_lines(spark, sf_dir))), "conv_id", "dialect")


def rejected_lines_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_files(raw_lines(spark, sf_dir), "conv_id", "dialect", "part")
    failed = rejects(normalise(read_numbered_lines(spark, path)))
    shard = _shard(F.col("file_path"))
    return _reject_columns(failed.withColumn("shard", shard), "shard", "line_num")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(normalise(_lines(spark, sf_dir)))


def normalise_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from files to files, then the messages it wrote."""
    source = _line_files(spark, sf_dir)
    target = scratch_path(spark, "normalised")
    run_normalise(spark, source, target, compression=PACKED)
    written = _exploded(load_dataset(spark, target))
    return written.groupBy("idx", "role", "content").agg(F.count(F.lit(1)).alias("n"))


def normalise_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples at their place among all samples, as the output files in name order hold them."""
    source = _write_files(raw_lines(spark, sf_dir), "conv_id", "dialect", "part")
    target = scratch_path(spark, "ordered")
    run_normalise(spark, source, target, keep_order=True)
    written = read_numbered_lines(spark, target)
    sizes = written.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    messages = F.from_json("line", "messages array<struct<role:string,content:string>>").messages
    return written.join(before, "file_path").select(
        (F.col("before") + F.col("line_num")).alias("place"),
        F.size(messages).cast("bigint").alias("n_messages"),
        F.array_join(F.transform(messages, lambda m: m.content), " ").alias("contents"),
    )


def normalise_by_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass job: every line's fate from the folder of its outcome."""
    source = _line_files(spark, sf_dir)
    target = scratch_path(spark, "outcomes")
    run_normalise(spark, source, target, by_outcome=True, compression=PACKED)
    schema = "outcome string, reason string, msg_index bigint, messages array<struct<role:string>>"
    written = load_dataset(spark, target, schema)
    n_messages = F.coalesce(F.size("messages"), F.lit(0)).cast("bigint")
    return written.groupBy("outcome", "reason", "msg_index", n_messages.alias("n_messages")).agg(
        F.count(F.lit(1)).alias("n")
    )


def normalise_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome counts that the job returns, however it is run."""
    source = _line_files(spark, sf_dir)
    modes = {
        "plain": {},
        "keep_order": {"keep_order": True},
        "rejects": {"rejects_path": scratch_path(spark, "rejects")},
        "by_outcome": {"by_outcome": True},
    }
    rows = [
        (mode, outcome, n)
        for mode, options in modes.items()
        for outcome, n in run_normalise(
            spark, source, scratch_path(spark, mode), compression=PACKED, **options
        ).items()
    ]
    return spark.createDataFrame(rows, "mode string, outcome string, n bigint")


def stream_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _line_files(spark, sf_dir)
    target = scratch_path(spark, "stream")
    judged = normalise_stream(spark, source)
    write_stream(judged, target, scratch_path(spark, "progress")).awaitTermination()
    written = spark.read.schema(judged.schema).parquet(target)
    origin = F.from_json("line", "conv_id bigint, dialect string").alias("o")
    samples = accepted(written).select(origin, "messages").select("o.*", "messages")
    return _exploded(samples, "conv_id", "dialect")


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a stream that stops after half of the dialects and goes on with the others."""
    source, target = scratch_path(spark, "arriving"), scratch_path(spark, "running")
    names = tuple(DIALECTS)
    for part, dialects in (("one", names[::2]), ("two", names[1::2])):
        raw_lines(spark, sf_dir, *dialects).select("line").write.text(f"{source}/{part}")
        run_stream(spark, f"{source}/*", target)
    return spark.read.schema("outcome string, n bigint").parquet(f"{target}/totals")


# --- training sets -------------------------------------------------------------------------


def strict_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(
        spark, sf_dir, "canonical", "number_content", "null_item", "missing_key", "no_fields"
    )
    messages = F.try_variant_get("record", "$.messages", "variant")
    dataset = parse_record(lines).select("conv_id", "dialect", messages.alias("messages"))
    found = violations(dataset, "conv_id", "dialect")
    return found.withColumn("msg_index", F.col("msg_index").cast("bigint"))


def render_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines to training text: parse, adapt, validate, render."""
    samples = accepted(normalise(_lines(spark, sf_dir, "canonical")))
    return samples.select(
        "conv_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        render_chat(F.col("messages")).alias("text"),
    )


def render_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strict_render(_conversations(spark, sf_dir)).select("conv_id", "text")


def render_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*TEMPLATES, "unheard-of"]
    texts = F.array(
        *(
            F.struct(F.lit(n).alias("template"), render_chat(F.col("messages"), n).alias("text"))
            for n in names
        )
    )
    return _conversations(spark, sf_dir).select("conv_id", F.inline(texts))


# Blocks, a name set under a condition, filters, slices and stripped blanks in one template.
OWN_TEMPLATE = """{#- system text goes into a heading -#}
{% if messages[0].role == 'system' %}
  {% set heading = messages[0].content | trim %}
{% endif %}
{{ heading }}|{{ messages | length }}
{% for message in (messages[1:] if messages[0].role == 'system' else messages) -%}
  {% if message['role'] == 'user' and not loop.last %}
[{{ loop.index }}] {{ message['content'] | trim }}
  {% elif message['role'] not in 'user,assistant' or loop.index0 % 2 == 0 %}
({{ message.role ~ loop.index0 }}) {{ message['content'] }}
  {%- else %}
{{- '>' + message['content'] -}}
  {% endif %}
{% endfor %}"""


def norm_nested_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents that are lists of parts, in three record shapes, with blanks and a long integer."""
    text = "to_json(array(t.text))"
    part = f"""concat('[{{"type": "text", "text": ', substr({text}, 2, length({text}) - 2), ', "n": ', t.turn,
      ', "part": ', t.turn / 4, ', "ok": ', if(t.turn % 2 = 0, 'true', 'false'), '}}, null, 1', repeat('0', 45), ', []]')"""

    def record(field: str, role: str, content: str) -> str:
        item = f"""concat('{{"{role}": "', t.role, '", "{content}": ', {part}, '}}')"""
        return f"""concat('{{"{field}": [', array_join(transform(turns, t -> {item}), ', '), ']}}')"""

    line = f"""CASE conv_id % 3 WHEN 0 THEN {record("messages", "role", "content")}
      WHEN 1 THEN {record("conversations", "from", "value")} ELSE {record("history", "role", "content")} END"""
    lines = ordered_turns(_table(spark, sf_dir, "conversations")).selectExpr("conv_id", f"{line} AS line")
    last_key_wins(spark)
    return _exploded(accepted(normalise(lines)), "conv_id")


def render_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strict_render(_conversations(spark, sf_dir), OWN_TEMPLATE).select("conv_id", "text")


def render_null_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third turn has a null content: it stays, as empty text, in typed and VARIANT lists."""

    def emptied(message: Column, position: Column) -> Column:
        content = F.when(position % 3 != 1, message.content)
        return F.struct(message.role.alias("role"), content.alias("content"))

    lists = _conversations(spark, sf_dir).withColumn("messages", F.transform("messages", emptied))
    plain = lists.select("conv_id", F.lit("typed").alias("form"), render_chat(F.col("messages")).alias("text"))
    text = F.to_json("messages", {"ignoreNullFields": "false"})
    loose = strict_render(lists.withColumn("messages", F.parse_json(text)))
    return plain.unionByName(loose.select("conv_id", F.lit("variant").alias("form"), "text"))


def text_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_mode(_table(spark, sf_dir, "documents")).select("doc_id", "text")


def sample_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return seeded_sample(documents, 150, SEED, "doc_id")


def sample_train_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return seeded_sample(items, 20_000, SEED, "l_orderkey", "l_linenumber")


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _conversations(spark, sf_dir)
    train, evaluation = prepare_splits(
        conversations, conversations, "conv_id", use_chat_template=True, max_samples=15, seed=SEED
    )

    def summary(split: DataFrame, name: str) -> DataFrame:
        return split.agg(
            F.lit(name).alias("split"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.length("text")).alias("n_chars"),
            _digest(F.concat_ws(":", "conv_id", "text")).alias("digest"),
        )

    return summary(train, "train").unionByName(summary(evaluation, "eval"))


def _digest(value: Column) -> Column:
    """A number of the set of values, whatever their order: the sum of their hashes."""
    number = F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.sum(number).cast("decimal(38,0)").cast("string")


def _prepared(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    source, target = scratch_path(spark, "chats"), scratch_path(spark, "prepared")
    write_jsonl(_conversations(spark, sf_dir), source)
    report = run_prepare(
        spark, source, source, target, "conv_id", use_chat_template=True, max_samples=15, seed=SEED
    )
    return target, report


def prepare_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole preparation from files to files, row by row: a sample to train, all to evaluate."""
    target, _ = _prepared(spark, sf_dir)
    splits = [
        load_dataset(spark, f"{target}/{name}").select(F.lit(name).alias("split"), "conv_id", "text")
        for name in ("train", "eval")
    ]
    return splits[0].unionByName(splits[1])


def profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job reports, and the profile of what it wrote; the example is one of its rows."""
    target, report = _prepared(spark, sf_dir)
    written = load_dataset(spark, f"{target}/eval")
    seen = {"job": report["eval"], "written": profile(written)}
    rows = [
        (name, n, written.filter(F.col("text") == example["text"]).count() > 0)
        for name, (n, example) in seen.items()
    ]
    return spark.createDataFrame(rows, "source string, n_rows bigint, example_found boolean")


# --- layout --------------------------------------------------------------------------------


def truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncate(_documents(spark, sf_dir), "tokens", MAX_WORDS).select(
        "doc_id",
        F.col("n_tokens").cast("bigint"),
        "was_truncated",
        F.array_join("tokens", " ").alias("text"),
    )


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = _documents(spark, sf_dir).select("doc_id", F.size("tokens").alias("n_tokens"))
    return pack_layout(sized, "doc_id", "n_tokens", PACK_SIZE)


def pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    packs = packed_tokens(_documents(spark, sf_dir), "doc_id", "tokens", PACK_SIZE)
    return packs.select(
        "pack_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("text"),
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return assign_batches(documents, "doc_id", SEED, batch_size=8, epochs=2, accumulation=4)


def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "batches")
    write_batches(batches(spark, sf_dir), path)
    return spark.read.schema("doc_id bigint, pos bigint, batch bigint, step bigint, epoch int").parquet(path)


def batch_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of every step, read back from storage by step."""
    tag = uuid.uuid4().hex

    def place(name: str) -> tuple[str, str]:
        return f"turnloom_{name}_{tag}", scratch_path(spark, name)

    texts = _table(spark, sf_dir, "documents").select("doc_id", "text")
    samples = write_bucketed(texts, *place("samples"), ["doc_id"], ["doc_id"], SHARDS)
    numbered = write_bucketed(batches(spark, sf_dir), *place("batches"), ["doc_id"], ["doc_id"], SHARDS)
    steps = write_steps(samples, numbered, "doc_id", *place("steps"), SHARDS)
    shown = F.struct("pos", F.md5("text").alias("digest"))
    in_order = F.transform(F.array_sort(F.collect_list(shown)), lambda s: s.digest)
    return steps.groupBy("epoch", "step").agg(F.md5(F.array_join(in_order, ",")).alias("digest"))


def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return train_plan(documents, batch_size=8, epochs=3, accumulation=55)


NORM_DIALECTS = tuple(DIALECTS)[: tuple(DIALECTS).index("plus_infinity")]


def _in_session(query: Query) -> Query:
    """The query with the parser's setting made in the session that runs it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        last_key_wins(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "render_conversations": render_conversations,
    "read_lines": lines_read,
    "read_lines_numbered": lines_numbered,
    "parse_outcomes": parse_outcomes,
    "jsonl_roundtrip": jsonl_roundtrip,
    "dataset_columns": dataset_columns,
    "detect_shape": detect_shape,
    **{f"norm_{dialect}": _norm(dialect) for dialect in NORM_DIALECTS},
    "norm_plus_infinity": plus_infinity,
    "output_field_list": output_field_list,
    "role_normalise": role_normalise,
    "content_strip": content_strip,
    "accepted_samples": accepted_samples,
    "rejects": rejected_lines,
    "rejects_numbered": rejected_lines_numbered,
    "outcome_counts": outcomes,
    "normalise_files": normalise_files,
    "normalise_in_order": normalise_in_order,
    "normalise_by_outcome": normalise_by_outcome,
    "normalise_counts": normalise_counts,
    "stream_normalise": stream_normalise,
    "stream_totals": stream_totals,
    "strict_violations": strict_violations,
    "render_chatml": render_strict,
    "render_named": render_named,
    "render_template_text": render_template_text,
    "norm_nested_content": norm_nested_content,
    "render_null_content": render_null_content,
    "text_mode": text_field,
    "sample_train": sample_train,
    "sample_train_large": sample_train_large,
    "prepare_splits": splits,
    "prepare_job": prepare_job,
    "profile": profile_query,
    "truncate": truncated,
    "pack": pack,
    "pack_tokens": pack_tokens,
    "assign_batches": batches,
    "write_batches": batch_files,
    "batch_texts": batch_texts,
    "train_plan": plan_summary,
}
QUERIES = {name: _in_session(query) for name, query in _QUERIES.items()}
