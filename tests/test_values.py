import json
import math
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnloom.functions import clean_text, is_falsy, last_key_wins, let, parse_record, python_str
from turnloom.functions import python_literal, python_strip, typed
from turnloom.functions.values import WHITESPACE

VALUES = """1 0 1.0 1.5 1e22 1e-5 0.0001 0.00012 123456789.125 1e7 1e15 1e16 12345678901234567
12345678901234567890123 true false null "" "x" [] [1] 1.5e300 -2.5 0.001 1234567.0 100000000.0 -7
0.0 2.50 1e0 123456789012.5 NaN Infinity -Infinity 1e400 -1e400""".split()


def judged(spark, texts):
    lines = spark.createDataFrame([(t,) for t in texts], "line string")
    exprs = {"s": python_str("v"), "falsy": is_falsy("v"), "clean": clean_text("v")}
    return (
        parse_record(lines)
        .selectExpr("line", *(f"{let('v', typed('record'), e)} AS {n}" for n, e in exprs.items()))
        .collect()
    )


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {c for c in map(chr, range(0x110000)) if not c.strip()}


def test_strip_matches_python_for_every_bmp_character(spark):
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    texts = [f"{chr(c)}a{chr(c)}b{chr(c)}" for c in points]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.selectExpr("t", f"{python_strip('t')} AS s").collect()
    assert [r.t for r in got if r.s != r.t.strip()] == []


def test_strip_of_blank_and_null(spark):
    rows = spark.createDataFrame([(WHITESPACE,), ("",), (None,), (" a",)], "t string")
    assert [r.s for r in rows.selectExpr(f"{python_strip('t')} AS s").collect()] == ["", "", None, "a"]


def test_str_and_truth_match_python(spark):
    for row in judged(spark, VALUES):
        value = json.loads(row.line)
        assert row.s == str(value), row
        assert row.falsy == (not value), row
        assert row.clean == (str(value).strip() if value else ""), row


def test_objects_and_lists_become_json_text(spark):
    rows = judged(spark, ['{"a": [1, "b"]}', "[null]", "{}"])
    assert [r.clean for r in rows] == ['{"a":[1,"b"]}', "[null]", ""]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=20, max_size=40))
def test_float_text_reads_back_as_the_same_number(spark, numbers):
    texts = [repr(n) for n in numbers]
    for row in judged(spark, texts):
        value = json.loads(row.line)
        if row.s != str(value) and value:
            # JDK 17 prints a few doubles with one digit more than the shortest form.
            assert struct.pack("d", float(row.s)) == struct.pack("d", value) or math.isclose(
                float(row.s), value, rel_tol=1e-15
            )


def test_strict_json_accepts_exactly_one_value(spark):
    good = ['{"a":1}', "[1,2]", '"x"', "5", "null", ' {"a":1}', "NaN", "-Infinity", '{"a":"+Infinity -INF"}', '{"a":"\\u00e9"}', "true"]
    bad = [
        '{"a":1} junk', '{"a":1},{"b":2}', "1],[2", '{"a":1', "{'a':1}", "+Infinity", "-INF", "+INF", '{"a":+Infinity}', "-NaN", "+1", '{"a":1}}', "[1,]",
        "01", '"a', "nul", "1 2", '{"a":"\t"}', '{"a" 1}', ",", '{"a":1}]', '{"a":1},"x"] ',
    ]
    lines = spark.createDataFrame([(t,) for t in good + bad], "line string")
    parsed = {r.line: r.record is not None for r in parse_record(lines).collect()}
    assert parsed == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False)}


def test_last_of_repeated_keys_wins_and_the_setting_is_asked_for(spark):
    lines = spark.createDataFrame([('{"a":1,"b":{"c":1,"c":2},"a":3}',)], "line string")
    assert parse_record(lines).first().record.toPython() == {"a": 3, "b": {"c": 2}}
    other = spark.newSession()
    other.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    with pytest.raises(ValueError, match="allowDuplicateKeys"):
        parse_record(other.sql("SELECT '{}' AS line"))
    last_key_wins(other)
    assert parse_record(other.sql("SELECT '{}' AS line")).count() == 1


def test_a_line_is_judged_alike_at_any_length(spark):
    lines = spark.range(4).selectExpr(
        "id",
        """concat('{"meta":{"a":1,"a":2},"score":', if(id < 2, '', '+'), 'Infinity,"text":"',
            repeat('x', if(id % 2 = 0, 9, 20500000)), '"}') AS line""",
    )
    rows = parse_record(lines).selectExpr("id", "try_variant_get(record, '$.meta.a', 'int') AS a").collect()
    assert sorted(map(tuple, rows)) == [(0, 2), (1, 2), (2, None), (3, None)]


def test_nested_values_print_as_in_python(spark):
    texts = ["", "it's", 'say "x"', "'\"", "a\\b", "\\", "\n\t\r\x00\x1f\x7f", "\x85\xa0\xad", "é\u0301", "\u200b\u2028\ufeff"]
    texts += ["\U0001f600", "\ue000", "\U000e0001", "x" * 100_000, "\\\"" * 5_000, "[1, {\"a\": 2}]", "\u3000 "]
    values = [[t, {t: t}] for t in texts]
    values += [{"b": 1, "a": [True, False, None, [], {}]}, [1.0, -0.0, 1e22, 1e-7, 123456.789], [10**60, -(10**40)]]
    values += [[[[["deep"] * 3]]], [float("nan"), float("inf"), float("-inf")]]
    lines = [json.dumps(v, ensure_ascii=bool(i % 2), indent=2 if i % 3 == 0 else None) for i, v in enumerate(values)]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, raw string")
    got = {r.i: r.t for r in rows.selectExpr("i", f"{python_literal('raw')} AS t").collect()}
    for i, value in enumerate(values):
        assert got[i] == str(json.loads(lines[i])), lines[i][:80]
