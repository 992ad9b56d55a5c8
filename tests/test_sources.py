import json
import os

import duckdb
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from turnloom.jobs import main, run_normalise
from turnloom.plans.normalise import accepted, normalise
from turnloom.sources import jsonl
from turnloom.sources.jsonl import dataset_schema, load_dataset, read_lines, read_numbered_lines
from turnloom.sources.jsonl import lines_in_order, read_placed_lines, write_jsonl


def write(folder, name, data):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(data)
    return path


def python_lines(path):
    with open(path, encoding="utf-8") as f:
        return {(n, line.strip()) for n, line in enumerate(f, 1) if line.strip()}


ENDS = {"lf": "\n", "crlf": "\r\n", "cr": "\r"}


def sample_text(end, rows):
    parts = []
    for i in range(rows):
        parts.append(" \t" if i % 7 == 3 else f"　line {i} é ")
        parts.append(end)
    return "".join(parts)


def test_read_lines_strips_and_drops_blanks(spark, folder):
    path = write(folder, "a.jsonl", sample_text("\n", 50))
    got = sorted(r.line for r in read_lines(spark, path).collect())
    assert got == sorted(line for _, line in python_lines(path))


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_line_numbers_match_python(spark, folder, split):
    paths = {
        f"{name}.jsonl": write(folder, f"{name}.jsonl", sample_text(end, 120 + 30 * k))
        for k, (name, end) in enumerate(ENDS.items())
    }
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = read_numbered_lines(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, path in paths.items():
        got = {(r.line_num, r.line) for r in rows if r.file_path.endswith("/" + name)}
        assert got == python_lines(path), name


def test_numbering_never_moves_the_text(spark, folder, monkeypatch):
    path = write(folder, "a.jsonl", sample_text("\n", 500))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = read_numbered_lines(spark, path)
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Sort" not in plan
        assert {(r.line_num, r.line) for r in lines.collect()} == python_lines(path)
        monkeypatch.setattr(jsonl, "BROADCAST_BLOCKS", 3)
        with pytest.raises(ValueError, match="too many blocks"):
            read_numbered_lines(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_changed_splits_fail_instead_of_giving_wrong_numbers(spark, folder):
    path = write(folder, "a.jsonl", sample_text("\n", 500))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    numbered = read_numbered_lines(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        with pytest.raises(Exception, match="split differently"):
            numbered.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_missing_paths(spark, folder):
    missing = os.path.join(folder, "nothing")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_lines(spark, missing)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_dataset(spark, missing)
    assert load_dataset(spark, None) is None


def test_write_creates_parents_overwrites_and_keeps_unicode(spark, folder):
    path = os.path.join(folder, "deep", "er", "out")
    for text in ("old", "né 你好"):
        write_jsonl(spark.createDataFrame([(text,)], "text string"), path)
    parts = [os.path.join(path, n) for n in os.listdir(path) if n.startswith("part-")]
    written = "".join(open(p, encoding="utf-8").read() for p in parts)
    assert written == '{"text":"né 你好"}\n'
    assert load_dataset(spark, path).first().text == "né 你好"


def test_dataset_columns_have_the_types_of_all_records(spark, folder):
    path = write(
        folder,
        "a.jsonl",
        '{"id":1,"x":1.5,"s":"t","m":{"k":1,"z-1":[1,2]},"l":[{"a":1},{"b":"x"}]}\n\n'
        '{"id":2,"x":2,"m":{"k":2.5},"b":true,"w.x":"OBJECT<"}\n{"x":-1e300,"l":[]}\n',
    )
    schema = dataset_schema(spark, path)
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    found = duckdb.sql(f"DESCRIBE SELECT * FROM read_json('{path}')").fetchall()
    plain = {name: kind for name, kind, *_ in found if name not in ("m", "l")}
    assert {f.name: kinds[f.dataType.simpleString()] for f in schema if f.name not in ("m", "l")} == plain
    assert schema["m"].dataType.simpleString() == "struct<k:double,z-1:array<bigint>>"
    assert schema["l"].dataType.simpleString() == "array<struct<a:bigint,b:string>>"
    rows = load_dataset(spark, path).collect()
    assert [r.x for r in rows] == [1.5, 2.0, -1e300] and rows[0].m.k == 1.0 and rows[1]["w.x"] == "OBJECT<"


def test_dataset_columns_of_several_kinds(spark, folder):
    path = write(folder, "a.jsonl", '{"v":1,"n":null,"big":123456789012345678901}\n{"v":"t","o":{}}\n{"v":[1]}\n')
    loaded = load_dataset(spark, path, declared={"text": "string"})
    assert {f.name: f.dataType.simpleString() for f in loaded.schema} == {
        "big": "decimal(38,0)", "n": "string", "o": "variant", "v": "variant", "text": "string",
    }
    assert [r.v for r in loaded.select(F.to_json("v").alias("v")).collect()] == ["1", '"t"', "[1]"]
    assert load_dataset(spark, write(folder, "none.jsonl", "\n")).columns == []
    same = write(folder, "same.jsonl", '{"ID":1}\n{"id":2}\n')
    with pytest.raises(ValueError, match="case only"):
        load_dataset(spark, same)


def test_load_dataset_rejects_malformed_lines(spark, folder):
    path = write(folder, "a.jsonl", '{"text":"x"}\n{"text":\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        load_dataset(spark, path).collect()


def test_normalise_job_from_file_to_file(spark, folder):
    path = write(
        folder,
        "in.jsonl",
        '\n{"prompt":"q","response":"r"}\n{"foo":1}\n \n{"messages":[{"role":"x","content":"y"}]}\n{',
    )
    out, bad = os.path.join(folder, "out"), os.path.join(folder, "bad")
    counts = run_normalise(spark, path, out, output_field="chat", rejects_path=bad)
    assert counts == {"processed": 1, "error": 2, "dropped": 1}
    schema = "chat array<struct<role:string,content:string>>"
    messages = load_dataset(spark, out, schema).first().chat
    assert [(m.role, m.content) for m in messages] == [("user", "q"), ("assistant", "r")]
    failed = spark.read.json(bad).orderBy("line_num").collect()
    assert [(r.line_num, r.reason) for r in failed] == [
        (3, "no_messages"),
        (5, "bad_role"),
        (6, "malformed"),
    ]


def test_normalise_job_writes_compressed_files(spark, folder):
    path = write(folder, "in.jsonl", '{"prompt":"q","response":"r"}\n{"foo":1}\n' * 50)
    bad = os.path.join(folder, "bad")
    for name, options in (
        ("plain", {"rejects_path": bad}),
        ("ordered", {"keep_order": True}),
        ("fates", {"by_outcome": True}),
    ):
        out = os.path.join(folder, name)
        counts = run_normalise(spark, path, out, compression="gzip", **options)
        assert counts == {"processed": 50, "error": 50, "dropped": 0}
        assert spark.read.text(out).count() == (100 if name == "fates" else 50)
    assert spark.read.json(bad).count() == 50
    written = [f for _, _, files in os.walk(folder) for f in files if f.startswith("part-")]
    assert len(written) >= 5 and all(f.endswith(".gz") for f in written)


def test_normalise_job_in_one_pass_by_outcome(spark, folder):
    path = write(
        folder, "in.jsonl", '{"prompt":"q"}\n\n{"foo":1,"bar":2}\n{"messages":[{"role":"x","content":"y"}]}\n'
    )
    out = os.path.join(folder, "out")
    counts = run_normalise(spark, path, out, by_outcome=True)
    assert counts == {"processed": 1, "error": 1, "dropped": 1}

    def only(outcome):
        [line] = [r.value for r in spark.read.text(f"{out}/outcome={outcome}").collect()]
        return json.loads(line)

    assert only("processed") == {"messages": [{"role": "user", "content": "q"}]}
    error, dropped = only("error"), only("dropped")
    assert error.pop("file_path") == dropped.pop("file_path")
    assert error == {"line_num": 3, "reason": "no_messages", "keys": ["foo", "bar"]}
    assert dropped == {"line_num": 4, "reason": "bad_role", "msg_index": 1, "detail": "x"}
    assert load_dataset(spark, f"{out}/outcome=processed").first().messages[0].content == "q"


def in_order(path):
    names = [os.path.join(at, n) for at, _, files in os.walk(path) for n in files if n.startswith("part-")]
    return [json.loads(line) for name in sorted(names) for line in open(name)]


def test_normalise_job_keeps_the_order(spark, folder):
    """Over two files, one of them cut into many blocks, with blanks in a name."""
    os.mkdir(f"{folder}/in")
    first = [f'{{"prompt":"q{i}"}}' for i in range(400)]
    write(f"{folder}/in", "a b.jsonl", "\n".join([*first, "junk", ""]))
    write(f"{folder}/in", "c.jsonl", "".join(f'{{"prompt":"q{i}"}}\n' for i in range(400, 430)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        counts = run_normalise(spark, f"{folder}/in", f"{folder}/out", keep_order=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    written = in_order(f"{folder}/out")
    assert [w["messages"][0]["content"] for w in written] == [f"q{i}" for i in range(430)]
    assert counts == {"processed": 430, "error": 1, "dropped": 0}
    assert len(os.listdir(f"{folder}/out")) > 10
    assert load_dataset(spark, f"{folder}/out").columns == ["messages"]


def test_keeping_the_order_moves_no_text(spark, folder):
    path = write(folder, "in.jsonl", '{"prompt":"q"}\n')
    kept = accepted(normalise(read_placed_lines(spark, path)))
    plan = lines_in_order(kept, ["messages"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "Sort" in plan


def test_command_line_jobs(spark, folder):
    path = write(folder, "in.jsonl", '{"prompt":"q","response":"r"}\n')
    norm, ready = os.path.join(folder, "norm"), os.path.join(folder, "ready")
    main(["normalise", "--input", path, "--output", norm])
    main(["prepare", "--train", norm, "--output", ready, "--use_chat_template", "qwen3"])
    text = load_dataset(spark, f"{ready}/train").first().text
    assert text == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nr<|im_end|>"
