import logging
import os

import pytest
from pyspark.sql import functions as F

from turnloom.jobs import main
from turnloom.operators.templates import Template, render_chat, strict_render, text_mode, violations
from turnloom.plans.prepare import prepare, prepare_paths, prepare_splits, profile
from turnloom.sources.jsonl import load_dataset, write_jsonl

SCHEMA = "id long, messages array<struct<role:string,content:string>>"
CHAT = [("system", "s"), ("user", "q"), ("assistant", "r")]


def frame(spark, *chats):
    return spark.createDataFrame([(i, c) for i, c in enumerate(chats)], SCHEMA)


def test_chatml_form(spark):
    text = frame(spark, CHAT).select(render_chat(F.col("messages"))).first()[0]
    assert text == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
        "<|im_start|>assistant\nr<|im_end|>"
    )
    longer = frame(spark, CHAT).select(render_chat(F.col("messages"), trailing_newline=True))
    assert longer.first()[0] == text + "\n"


def test_named_templates(spark, caplog):
    def text(name, chat=CHAT):
        return frame(spark, chat).select(render_chat(F.col("messages"), name)).first()[0]

    assert text("llama-3", CHAT[1:2]) == (
        "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nq<|eot_id|>"
    )
    assert text("gemma-3") == (
        "<bos><start_of_turn>user\ns\n\nq<end_of_turn>\n<start_of_turn>model\nr<end_of_turn>\n"
    )
    assert text("gemma-3", CHAT[1:]) == (
        "<bos><start_of_turn>user\nq<end_of_turn>\n<start_of_turn>model\nr<end_of_turn>\n"
    )
    with caplog.at_level(logging.WARNING):
        assert text("no-such-name") == text(None)
    assert "no-such-name" in caplog.text
    assert text(Template("[", ":", "]")) == "[system:s][user:q][assistant:r]"


def test_violations_of_typed_and_variant_fields(spark):
    typed = frame(spark, CHAT, None, [("user", None), None, ("user", "q")])
    found = violations(typed, "id").orderBy("id", "msg_index").collect()
    assert [tuple(r) for r in found] == [
        (1, None, "not_list"),
        (2, 1, "missing_key"),
        (2, 2, "not_object"),
    ]
    loose = spark.sql(
        """SELECT id, parse_json(m) AS messages FROM VALUES
        (0, '[{"role":"user","content":null}]'), (1, '"text"'), (2, '[3,{"role":"user"}]') AS t(id, m)"""
    )
    found = violations(loose, "id").orderBy("id", "msg_index").collect()
    assert [tuple(r) for r in found] == [
        (1, None, "not_list"),
        (2, 1, "not_object"),
        (2, 2, "missing_key"),
    ]


def test_faulty_messages_stop_the_job(spark):
    with pytest.raises(Exception, match="not_object"):
        strict_render(frame(spark, [None])).collect()
    with pytest.raises(ValueError, match="no field 'messages'"):
        strict_render(spark.range(1))
    assert strict_render(frame(spark, [])).first().text == ""


def test_faults_outside_the_sample(spark):
    many = frame(spark, *([CHAT] * 20), [None])
    kept = prepare(many, "id", use_chat_template=True, max_samples=3, seed=1, check_all=False)
    assert kept.count() == 3
    with pytest.raises(ValueError, match="1 rows.*not_object"):
        prepare(many, "id", use_chat_template=True, max_samples=3, seed=1)
    with pytest.raises(Exception, match="not_object"):
        prepare(many, "id", use_chat_template=True, max_samples=99).collect()
    loose = many.withColumn("messages", F.parse_json(F.to_json("messages")))
    with pytest.raises(ValueError, match="not_object"):
        prepare(loose, "id", use_chat_template=True, max_samples=3, formatter=lambda m: F.to_json(m))


def test_a_faulty_row_stops_the_job_before_it_writes(spark, folder):
    chats, out = os.path.join(folder, "chats"), os.path.join(folder, "out")
    write_jsonl(frame(spark, *([CHAT] * 20), [None]), chats)
    options = [f"--train={chats}", f"--output={out}", "--use_chat_template=true", "--max_samples=3", "--key=id"]
    with pytest.raises(ValueError, match="not_object"):
        main(["prepare", *options])
    assert not os.path.exists(out)
    main(["prepare", *options, "--check_all=false"])
    assert os.path.exists(out)


def test_text_mode(spark):
    texts = spark.createDataFrame([("a",), ("b",)], "text string")
    assert prepare(texts).count() == 2
    with pytest.raises(ValueError, match="no field 'text'"):
        text_mode(spark.range(1))
    with pytest.raises(Exception, match="a record has no field"):
        text_mode(spark.createDataFrame([(None,)], "text string")).collect()


def test_template_switch_takes_any_truthy_value(spark):
    assert prepare(frame(spark, CHAT), use_chat_template="qwen3").first().text.startswith("<|im")
    with pytest.raises(ValueError, match="no field 'text'"):
        prepare(frame(spark, CHAT), use_chat_template="")


def test_formatter_replaces_the_template(spark):
    ready = prepare(
        frame(spark, CHAT), use_chat_template=True, formatter=lambda m: F.size(m).cast("string")
    )
    assert ready.first().text == "3"
    with pytest.raises(Exception, match="not_object"):
        prepare(frame(spark, [None]), use_chat_template=True, formatter=lambda m: F.lit("x")).collect()


def test_seed_zero_means_unset(spark):
    many = frame(spark, *([CHAT] * 30))

    def ids(**seeds):
        return {r.id for r in prepare(many, "id", use_chat_template=True, max_samples=5, **seeds).collect()}

    assert ids(seed=9, shuffle_seed=0) == ids(seed=9)
    assert ids(seed=9, shuffle_seed=4) == ids(seed=4)
    assert ids(seed=9) != ids(seed=4)


def test_only_the_training_split_is_sampled(spark):
    many = frame(spark, *([CHAT] * 30))
    train, evaluation = prepare_splits(many, many, "id", use_chat_template=True, max_samples=5)
    assert (train.count(), evaluation.count()) == (5, 30)
    assert prepare_splits(many, None, use_chat_template=True)[1] is None


def test_sampled_rows_are_the_ones_rendered(spark):
    many = frame(spark, *([CHAT] * 30))
    ready = prepare(many, "id", use_chat_template=True, max_samples=5)
    steps = ready._jdf.queryExecution().sparkPlan().toString().strip().split("\n")
    assert not any(word in step for step in steps for word in ("Exchange", "Sort", "TakeOrdered"))
    rendered = [i for i, step in enumerate(steps) if "im_start" in step]
    # Only what was sampled and written is read again and rendered.
    assert rendered and "Scan ExistingRDD" in steps[-1]
    assert ready.count() == 5


def test_paths_and_profile(spark, folder):
    train = os.path.join(folder, "train")
    write_jsonl(frame(spark, *([CHAT] * 12)), train, ["messages"])
    ready, evaluation = prepare_paths(spark, train, use_chat_template=True, max_samples=4)
    assert evaluation is None
    rows, example = profile(ready)
    assert rows == 4 and example["text"].startswith("<|im_start|>system")
    assert profile(ready.filter("false")) == (0, None)
    text_only, _ = prepare_paths(spark, train)
    with pytest.raises(Exception, match="a record has no field"):
        text_only.collect()


def test_null_is_present_and_an_absent_key_is_not(spark, folder):
    path = os.path.join(folder, "a.jsonl")
    with open(path, "w") as f:
        f.write('{"messages":[{"role":"user","content":null},{"role":"user","content":"q"}]}\n')
    ready, _ = prepare_paths(spark, path, use_chat_template=True, template=Template("[", ":", "]"))
    assert ready.first().text == "[user:][user:q]"
    with open(path, "a") as f:
        f.write('{"messages":[{"role":"user"}]}\n')
    with pytest.raises(Exception, match="missing_key"):
        prepare_paths(spark, path, use_chat_template=True)[0].collect()


def test_whole_preparation_from_the_command_line(spark, folder):
    chats, out = os.path.join(folder, "chats"), os.path.join(folder, "out")
    write_jsonl(frame(spark, *([CHAT] * 6)), chats)
    options = {
        "train": chats, "eval": chats, "output": out, "use_chat_template": "true",
        "key": "id", "template": '{"prefix": " ", "infix": " ", "suffix": " "}', "check_all": "true",
        "max_seq_length": "4", "packing": "true", "batch_size": "2", "epochs": "2",
    }
    main(["prepare", *(f"--{name}={value}" for name, value in options.items())])
    written = load_dataset(spark, os.path.join(out, "train"), "id bigint, text string").orderBy("id").collect()
    assert [r.id for r in written] == list(range(6))
    assert written[0].text == " system s  user q  assistant r "
    packs = spark.read.parquet(os.path.join(out, "train_tokens")).orderBy("pack_id").collect()
    assert [len(p.tokens) for p in packs] == [4] * 9
    assert packs[0].tokens == ["system", "s", "user", "q"]
    batches = spark.read.parquet(os.path.join(out, "batches"))
    assert {(r.epoch, r.batch): r["count"] for r in batches.groupBy("epoch", "batch").count().collect()} == {
        (e, b): 2 for e in (0, 1) for b in (0, 1, 2)
    }
    with pytest.raises(ValueError, match="need a key"):
        main(["prepare", f"--train={chats}", f"--output={out}", "--packing=true", "--max_seq_length=4"])


def test_all_fields_are_kept(spark, folder):
    path, out = os.path.join(folder, "a.jsonl"), os.path.join(folder, "out")
    chat = '"messages":[{"role":"user","content":"q"}]'
    with open(path, "w") as f:
        f.write('{"id":1,"source":"a",%s}\n{"id":2,"score":0.5,"tags":["x"],%s}\n' % (chat, chat))
    main(["prepare", f"--train={path}", f"--eval={path}", f"--output={out}", "--use_chat_template=1"])
    for split in ("train", "eval"):
        written = load_dataset(spark, os.path.join(out, split)).orderBy("id").collect()
        assert [(r.id, r.source, r.score, r.tags) for r in written] == [
            (1, "a", None, None), (2, None, 0.5, ["x"]),
        ]
        assert {r.text for r in written} == {"<|im_start|>user\nq<|im_end|>"}
    main(["prepare", f"--train={path}", f"--output={out}", "--use_chat_template=1", "--column=id bigint"])
    assert load_dataset(spark, os.path.join(out, "train")).columns == ["id", "text"]


def test_variant_field_from_a_file(spark, folder):
    path = os.path.join(folder, "a.jsonl")
    with open(path, "w") as f:
        f.write('{"messages":[{"role":"user","content":"q"}]}\n')
    loaded = load_dataset(spark, path, "messages variant")
    assert violations(loaded).count() == 0
    assert strict_render(loaded).first().text == "<|im_start|>user\nq<|im_end|>"
