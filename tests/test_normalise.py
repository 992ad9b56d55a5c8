import json

import pytest
from pyspark.sql import functions as F

from turnloom.fixtures import raw_lines
from turnloom.functions import not_blank, python_strip
from turnloom.functions.records import _SEAL
from turnloom.plans.normalise import accepted, normalise, observe_outcomes, outcome_counts, rejects

Q, A = "u:q", "a:r"

GOLDEN = [
    ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"r"}]}', [Q, A]),
    ('{"messages":[{"role":"Human","content":" q "},{"role":"ChatGPT","content":"r\\n"}]}', [Q, A]),
    ('{"messages":[]}', ("error", "no_messages", None)),
    ('{"messages":null,"prompt":"q","response":"r"}', [Q, A]),
    ('{"messages":"text","prompt":"q","response":"r"}', [Q, A]),
    ('{"messages":["x"]}', ("dropped", "not_object", 1)),
    ('{"messages":[null]}', ("dropped", "not_object", 1)),
    ('{"messages":[{"role":"user"}]}', ("dropped", "missing_key", 1)),
    (
        '{"messages":[{"role":"user","content":"q"},{"role":"tool","content":"r"}]}',
        ("dropped", "bad_role", 2),
    ),
    ('{"messages":[{"role":" user","content":"q"}]}', ("dropped", "bad_role", 1)),
    ('{"messages":[{"role":null,"content":"q"}]}', ("dropped", "bad_role", 1)),
    ('{"messages":[{"role":["user"],"content":"q"}]}', ("dropped", "bad_role", 1)),
    ('{"messages":[{"role":true,"content":"q"}]}', ("dropped", "bad_role", 1)),
    ('{"messages":[{"role":"user","content":"\\u00a0\\u3000"}]}', ("dropped", "empty_content", 1)),
    ('{"messages":[{"role":"user","content":0}]}', ("dropped", "empty_content", 1)),
    ('{"messages":[{"role":"user","content":-0.0}]}', ("dropped", "empty_content", 1)),
    ('{"messages":[{"role":"user","content":false}]}', ("dropped", "empty_content", 1)),
    ('{"messages":[{"role":"user","content":null}]}', ("dropped", "empty_content", 1)),
    ('{"messages":[{"role":"user","content":{}}]}', ("dropped", "empty_content", 1)),
    ('{"messages":[{"role":"user","content":5}]}', ["u:5"]),
    ('{"messages":[{"role":"user","content":1.0}]}', ["u:1.0"]),
    ('{"messages":[{"role":"user","content":"0"}]}', ["u:0"]),
    ('{"messages":[{"role":"user","content":"false"}]}', ["u:false"]),
    ('{"messages":[{"role":"user","content":true}]}', ["u:True"]),
    ('{"messages":[{"role":"user","content":["p"]}]}', ["u:['p']"]),
    ('{"messages":[{"role":"user","content":"[1]"},{"content":[1.50,{"b":"x","a":null}],"role":"gpt"}]}',
        ["u:[1]", "a:[1.5, {'b': 'x', 'a': None}]"]),
    ('{"messages":[{"role":"user","content":123456789012345678901234567890123456789012}]}',
        ["u:123456789012345678901234567890123456789012"]),
    ('{"messages":[{"role":"user","content":1e40}]}', ["u:1e+40"]),
    ('{"messages":[{"role":"user","content":[]}]}', ("dropped", "empty_content", 1)),
    ('{"conversations":[3,{"x":[]},{"speaker":"bot","text":{"k":[true]}},{"from":"human","value":["q"]}]}',
        ["a:{'k': [True]}", "u:['q']"]),
    ('{"chat":[{"role":"user"}],"history":[{"role":"user"},{"role":"user","content":[2]}]}', ["u:[2]"]),
    ('{"prompt":{"p":1},"response":["r"]}', ["u:{'p': 1}", "a:['r']"]),
    ('{"instruction":["i"],"input":"","output":{"o":-0}}', ["u:['i']", "a:{'o': 0}"]),
    ('{"messages":[{"role":"user","content":["old"],"content":["new"]}]}', ["u:['new']"]),
    ('{"messages":[{"role":"user","content":"x"}],"messages":[{"role":"user","content":["y"]}]}', ["u:['y']"]),
    ('{"messages":[{"role":"user","content":["x"]},null]}', ("dropped", "not_object", 2)),
    ('{"messages":[{"role":"system","content":"x"}]}', ["s:x"]),
    ('{"messages":[{"role":"user","content":"q","name":"n"}],"id":7}', [Q]),
    ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"r"}]}', [Q, A]),
    (
        '{"conversations":[{"speaker":"BOT","text":"r"},{"role":"ai","content":"t"},'
        '{"from":"human","value":"q"}]}',
        ["a:r", "a:t", Q],
    ),
    ('{"conversations":[{"role":"user"},{"role":"user","content":"q"},3]}', [Q]),
    ('{"conversations":[{"role":"user","from":"human","value":"q"}]}', [Q]),
    ('{"conversations":[{"x":1}]}', ("error", "no_messages", None)),
    ('{"conversations":"zz","prompt":"q"}', ("error", "no_messages", None)),
    ('{"conversations":null,"prompt":"q"}', ("error", "no_messages", None)),
    ('{"conversations":"zz","history":[{"role":"user","content":"q"}]}', [Q]),
    (
        '{"conversations":[],"history":[{"role":"user","content":"q"}]}',
        ("error", "no_messages", None),
    ),
    ('{"instruction":"i","input":"n","output":"o"}', ["u:i\nn", "a:o"]),
    ('{"instruction":"i","input":"","output":"o"}', ["u:i", "a:o"]),
    ('{"instruction":"i","input":" ","output":"o"}', ["u:i", "a:o"]),
    ('{"instruction":"i","input":0}', ["u:i"]),
    ('{"instruction":"i","input":7}', ["u:i\n7"]),
    ('{"instruction":"i"}', ["u:i"]),
    ('{"instruction":"i","output":null}', ("dropped", "empty_content", 2)),
    ('{"instruction":null,"input":"n"}', ["u:None\nn"]),
    ('{"instruction":null}', ("dropped", "empty_content", 1)),
    ('{"instruction":"i","prompt":"p"}', ["u:i"]),
    ('{"prompt":"q","question":"z","answer":"y"}', [Q]),
    ('{"question":"q","answer":"r"}', [Q, A]),
    ('{"dialogue":[],"chat":[{"role":"user","content":"q"}]}', [Q]),
    ('{"dialogue":[3,{"role":"user","content":"q"}]}', [Q]),
    ('{"history":[{"from":"human","value":"q"}]}', ("error", "no_messages", None)),
    ('{"foo":1}', ("error", "no_messages", None)),
    ("{}", ("error", "no_messages", None)),
    ("[1,2]", ("error", "not_object", None)),
    ('"messages"', ("error", "not_object", None)),
    ("null", ("error", "not_object", None)),
    ('{"a":1} junk', ("error", "malformed", None)),
    ('{"prompt":"x","prompt":"q"}', [Q]),
    ('{"prompt":NaN}', ["u:nan"]),
    ('{"score":-Infinity,"prompt":"q"}', [Q]),
    ('{"score":+Infinity,"prompt":"q"}', ("error", "malformed", None)),
]


def lines_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, line string")


def summary(row):
    if row.messages is None:
        return (row.outcome, row.reason, row.msg_index)
    return [f"{m.role[0]}:{m.content}" for m in row.messages]


def test_golden_lines(spark):
    rows = normalise(lines_of(spark, [line for line, _ in GOLDEN])).orderBy("n").collect()
    for row, (line, expected) in zip(rows, GOLDEN, strict=True):
        assert summary(row) == expected, line


def test_fields_can_be_named(spark):
    line = '{"a.b c":[{"from":"human","value":"q"}],"messages":"no list","prompt":"z"}'
    taken = '{"out":[{"role":"user","content":"q"}],"messages":[{"role":"user","content":"z"}]}'
    rows = normalise(lines_of(spark, [line, taken]), input_field="a.b c", output_field="out")
    assert [summary(r) for r in rows.orderBy("n").collect()] == [[Q], [Q]]


def test_input_field_as_output_field_is_taken_unconverted(spark):
    line = '{"conversations":[{"from":"human","value":"q"}]}'
    row = normalise(lines_of(spark, [line]), output_field="conversations").first()
    assert summary(row) == ("dropped", "missing_key", 1)


def test_rejects_show_role_and_first_keys(spark):
    texts = [
        '{"messages":[{"role":"Tool","content":"r"}]}',
        '{"a":1,"b":2,"c":3,"d":4,"e":5,"f":6}',
    ]
    rows = rejects(normalise(lines_of(spark, texts))).orderBy("n").collect()
    assert (rows[0].detail, rows[0]["keys"]) == ("Tool", None)
    assert (rows[1].detail, rows[1]["keys"]) == (None, ["a", "b", "c", "d", "e"])


def test_long_message_text_and_many_turns(spark):
    text = "x" * 3_000_000
    many = json.dumps({"messages": [{"role": "user", "content": f"t{i}"} for i in range(5000)]})
    one = json.dumps({"messages": [{"role": "user", "content": text}]})
    rows = normalise(lines_of(spark, [many, one])).orderBy("n").collect()
    assert len(rows[0].messages) == 5000 and rows[0].messages[4999].content == "t4999"
    assert rows[1].messages[0].content == text


def test_a_text_over_twenty_million_characters_is_kept_whole(spark):
    size = 21_000_000
    lines = spark.range(2).selectExpr(
        "id AS n",
        f"""concat('{{"prompt":"', repeat('x', {size}), '"}}', if(id = 1, ' junk', '')) AS line""",
    )
    rows = normalise(lines).selectExpr("n", "reason", "length(messages[0].content) AS size")
    assert sorted(map(tuple, rows.collect())) == [(0, None, size), (1, "malformed", None)]


def test_outcomes_add_up(spark, sf_dir):
    lines = raw_lines(spark, sf_dir)
    total, blank = lines.count(), lines.filter(~F.expr(not_blank("line"))).count()
    judged = normalise(lines.filter(not_blank("line")))
    counts = {r.outcome: r.n for r in outcome_counts(judged).collect()}
    assert sum(counts.values()) + blank == total
    assert accepted(judged).count() == counts["processed"]
    assert rejects(judged).count() == counts["error"] + counts["dropped"]


def test_counts_by_observation(spark, sf_dir):
    from pyspark.sql import Observation

    judged = normalise(raw_lines(spark, sf_dir).filter(not_blank("line")))
    seen = Observation("seen")
    observe_outcomes(judged, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {r.outcome: r.n for r in outcome_counts(judged).collect()}


def test_accepted_messages_are_clean_and_stable(spark, sf_dir):
    once = accepted(normalise(raw_lines(spark, sf_dir).filter(not_blank("line"))))
    messages = once.select(F.explode("messages").alias("m")).select("m.role", "m.content")
    unclean = ~F.col("role").isin("user", "assistant", "system") | (
        F.expr(python_strip("content")) != F.col("content")
    )
    assert messages.filter(unclean).count() == 0
    again = accepted(
        normalise(
            once.select(
                "conv_id", "dialect", "messages", F.to_json(F.struct("messages")).alias("line")
            ).withColumnRenamed("messages", "before")
        )
    )
    assert again.count() == once.count()
    assert again.filter(F.col("before") != F.col("messages")).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pick", [accepted, rejects, lambda d: d.select("outcome"), outcome_counts])
def test_a_line_is_parsed_once_without_python(spark, pick):
    lines = spark.range(10).selectExpr("id", "concat('{\"prompt\":\"', id, '\"}') AS line")
    plan = plan_of(pick(normalise(lines)))
    # The line itself is parsed once; raw fields are read again only where a content is nested.
    assert plan.count(f',"{_SEAL}"') == 1
    assert "Python" not in plan


def test_normalising_does_not_shuffle(spark):
    lines = spark.range(10).selectExpr("id", "'{}' AS line")
    assert "Exchange" not in plan_of(accepted(normalise(lines)))


def test_a_field_name_beyond_the_reader_is_reported_as_too_large(spark):
    chat = '"messages":[{"role":"user","content":"q"}]'
    lines = [f'{{"{"k" * n}":1,{chat}}}' for n in (50_000, 50_001, 60_000)]
    lines += [f'{{"x":"{"v" * 60_000}",{chat}', "{" + " " * 60_000 + "junk"]
    judged = normalise(spark.createDataFrame([(x,) for x in lines], "line string"))
    assert [(r.outcome, r.reason) for r in judged.select("outcome", "reason").collect()] == [
        ("processed", None), ("error", "too_large"), ("error", "too_large"),
        ("error", "malformed"), ("error", "malformed"),
    ]
