"""Raw chat lines made from the conversations table: every conversation in every dialect.

A dialect is one way to write a conversation as JSONL, valid or defective: as one line, or as one
line per pair of a question and its answer. The table itself is clean, so role variants, outer
whitespace and defects come from the dialects. The work grows with the table; no turn is left
out of any dialect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions import quoted

OUTER_LEFT = "\u3000\t"
OUTER_RIGHT = "\xa0 \n"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and the ordered list of its turns (turn, role, text).

    The partition count is fixed because later steps write many lines per conversation, which
    the adaptive merging of small partitions cannot know.
    """
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turn = F.struct("turn", "role", "text")
    return (
        conversations.repartition(parts, "conv_id")
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    )


def as_messages(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t.role.alias("role"), t.text.alias("content")))


def _record(**fields: str) -> str:
    pairs = "".join(f", '{name}', {value}" for name, value in fields.items())
    return f"to_json(named_struct('conv_id', conv_id, 'dialect', dialect{pairs}))"


def _items(
    role_key: str = "role", text_key: str = "content", role: str = "t.role", text: str = "t.text"
) -> str:
    return (
        f"transform(turns, (t, i) -> named_struct('{role_key}', {role}, '{text_key}', {text}))"
    )


def _renamed(**names: str) -> str:
    cases = " ".join(f"WHEN '{standard}' THEN '{name}'" for standard, name in names.items())
    return f"CASE t.role {cases} ELSE t.role END"


_LAST = "i = size(turns) - 1"
_TEXT = "array_join(transform(turns, t -> t.text), ' ')"
_SYSTEM = "get(filter(turns, t -> t.role = 'system'), 0).text"
# Every user turn as p.u, with the assistant's reply to it, if there is one, as p.a.
_PAIRS = """filter(transform(turns, (t, i) -> named_struct('role', t.role, 'u', t.text, 'a',
    if(get(turns, i + 1).role = 'assistant', get(turns, i + 1).text, NULL))), p -> p.role = 'user')"""
_CANONICAL = _record(messages=_items())
_PROMPT = _record(prompt="p.u", response="p.a")
_OUTER = [quoted(side) for side in (OUTER_LEFT, OUTER_RIGHT)]

# The three item forms in turn, then an item of no known form.
_MIXED = f"""concat(transform(turns, (t, i) -> named_struct(
    'role', if(i % 3 = 0, t.role, NULL), 'content', if(i % 3 = 0, t.text, NULL),
    'from', if(i % 3 = 1, t.role, NULL), 'value', if(i % 3 = 1, t.text, NULL),
    'speaker', if(i % 3 = 2, {_renamed(assistant="AI")}, NULL), 'text', if(i % 3 = 2, t.text, NULL))),
  array(named_struct('role', 'user', 'content', string(NULL), 'from', string(NULL),
    'value', string(NULL), 'speaker', string(NULL), 'text', string(NULL))))"""

DIALECTS = {
    "canonical": _CANONICAL,
    "padded": _record(
        messages=_items(role="upper(t.role)", text=f"concat({_OUTER[0]}, t.text, {_OUTER[1]})")
    ),
    "role_content": _record(conversations=_items(role=_renamed(user="human", assistant="gpt"))),
    "from_value": _record(
        conversations=_items("from", "value", _renamed(user="human", assistant="bot"))
    ),
    "speaker_text": _record(
        conversations=_items("speaker", "text", _renamed(user="Human", assistant="ChatGPT"))
    ),
    "mixed": _record(conversations=_MIXED),
    "instruction": _record(instruction="p.u", input=_SYSTEM, output="p.a"),
    "prompt": _PROMPT,
    "question": _record(question="p.u", answer="p.a"),
    "fallback": _record(dialogue="array()", history=_items()),
    # The input field holds text, so only the fallback fields count.
    "shadowed": _record(conversations=_TEXT, chat=_items()),
    "number_content": _record(messages=_items(text="t.turn + 1000")),
    "repeated_key": f"""concat('{{"prompt":"overwritten",', substr({_PROMPT}, 2))""",
    "not_a_number": f"""concat('{{"score":NaN,"low":-Infinity,"sign":"+Infinity",', substr({_CANONICAL}, 2))""",
    "nested_repeat": f"""concat('{{"meta":{{"a":1,"a":2}},', substr({_CANONICAL}, 2))""",
    # From here on: lines that give no sample.
    "plus_infinity": f"""concat('{{"score":+Infinity,', substr({_CANONICAL}, 2))""",
    "trailing_junk": f"concat({_CANONICAL}, ' junk')",
    "truncated": f"left({_CANONICAL}, length({_CANONICAL}) - 1)",
    "not_record": "to_json(transform(turns, t -> t.text))",
    "no_fields": _record(note=_TEXT),
    "empty_list": _record(messages="array()"),
    "blocked_prompt": _record(conversations=_TEXT, prompt=_TEXT),
    "null_item": _record(
        messages=f"concat({_items()}, array(cast(NULL AS struct<role:string,content:string>)))"
    ),
    "missing_key": _record(messages=_items(text=f"if({_LAST}, NULL, t.text)")),
    "bad_role": _record(messages=_items(role=f"if({_LAST}, 'Tool', t.role)")),
    "null_output": f"""concat('{{"output":null,', substr({_record(instruction="p.u")}, 2))""",
    "blank_content": _record(
        messages=_items(text=f"if(i = 0, concat({_OUTER[0]}, {_OUTER[1]}), t.text)")
    ),
    "blank_line": "' \t '",
}


# Dialects with a line for every pair.
PAIRED = ("instruction", "prompt", "question", "repeated_key", "null_output")


def raw_lines(spark: SparkSession, sf_dir: str, *dialects: str) -> DataFrame:
    """conv_id, dialect, part, line: all conversations in each of the named dialects (default: all).

    `part` numbers the lines of one conversation in one dialect.
    """
    names = dialects or tuple(DIALECTS)
    grouped = ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    each = ", ".join(map(quoted, names))
    lines = " ".join(
        f"WHEN {quoted(name)} THEN "
        + (f"transform({_PAIRS}, p -> {DIALECTS[name]})" if name in PAIRED else f"array({DIALECTS[name]})")
        for name in names
    )
    return grouped.selectExpr("*", f"explode(array({each})) AS dialect").selectExpr(
        "conv_id", "dialect", f"posexplode(CASE dialect {lines} END) AS (part, line)"
    )
