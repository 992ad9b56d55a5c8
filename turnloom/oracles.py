"""DuckDB statements for the registered queries, written from the fixture rules."""

from __future__ import annotations

from collections.abc import Iterable

from turnloom.catalog import (
    MAX_WORDS,
    NORM_DIALECTS,
    PACK_SIZE,
    QUERIES,
    SEED,
    SHARDS,
)
from turnloom.fixtures import PAIRED

LIST_DIALECTS = (
    "canonical padded role_content from_value speaker_text mixed fallback shadowed number_content"
    " not_a_number nested_repeat"
).split()
PAIR_DIALECTS = "instruction prompt question repeated_key".split()

# What each defective dialect leads to: outcome, reason, shape, keys of a record without messages.
DEFECTS = {
    "plus_infinity": ("error", "malformed", None, None),
    "trailing_junk": ("error", "malformed", None, None),
    "truncated": ("error", "malformed", None, None),
    "not_record": ("error", "not_object", None, None),
    "no_fields": ("error", "no_messages", "none", "conv_id,dialect,note"),
    "empty_list": ("error", "no_messages", "canonical", "conv_id,dialect,messages"),
    "blocked_prompt": ("error", "no_messages", "none", "conv_id,dialect,conversations,prompt"),
    "null_item": ("dropped", "not_object", "canonical", None),
    "missing_key": ("dropped", "missing_key", "canonical", None),
    "bad_role": ("dropped", "bad_role", "canonical", None),
    "null_output": ("dropped", "empty_content", "instruction", None),
    "blank_content": ("dropped", "empty_content", "canonical", None),
}
SHAPES = {
    **dict.fromkeys(
        ("canonical", "padded", "number_content", "not_a_number", "nested_repeat"), "canonical"
    ),
    **dict.fromkeys(("role_content", "from_value", "speaker_text", "mixed"), "conversation"),
    **dict.fromkeys(("fallback", "shadowed"), "fallback"),
    "instruction": "instruction",
    "prompt": "prompt",
    "repeated_key": "prompt",
    "question": "question",
}


def _literal(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _values(rows: list[tuple[str | None, ...]], name: str, columns: str) -> str:
    body = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return f"(VALUES {body}) AS {name}({columns})"


def _names(dialects: Iterable[str]) -> str:
    return _values([(d,) for d in dialects], "d", "dialect")


_SINGLE = [d for d in (*LIST_DIALECTS, *DEFECTS, "blank_line") if d not in PAIRED]

# good: the messages of lines that give a sample. units: all lines, the blank ones included.
_GOOD = f"""
WITH turns AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations
), firsts AS (
  SELECT conv_id, count(*) AS n_turns, arg_min(text, turn) FILTER (WHERE role = 'system') AS s
  FROM conversations GROUP BY conv_id
), pairs AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS part, text AS u, s,
         CASE WHEN next_role = 'assistant' THEN next_text END AS a
  FROM turns JOIN firsts USING (conv_id) WHERE role = 'user'
), units AS (
  SELECT conv_id, dialect, 0 AS part FROM firsts, {_names(_SINGLE)}
  UNION ALL SELECT conv_id, dialect, part FROM pairs, {_names(PAIRED)}
), good AS (
  SELECT conv_id, dialect, 0 AS part, idx, role,
         CASE WHEN dialect = 'number_content' THEN CAST(turn + 1000 AS VARCHAR) ELSE text END AS content
  FROM turns, {_names(LIST_DIALECTS)}
  UNION ALL
  SELECT conv_id, dialect, part, 1, 'user',
         CASE WHEN dialect = 'instruction' AND s IS NOT NULL THEN u || chr(10) || s ELSE u END
  FROM pairs, {_names(PAIR_DIALECTS)}
  UNION ALL
  SELECT conv_id, dialect, part, 2, 'assistant', a FROM pairs, {_names(PAIR_DIALECTS)} WHERE a IS NOT NULL
)"""

_BAD = f"""{_GOOD}, bad AS (
  SELECT conv_id, dialect, part, outcome, reason, shape, keys,
         CASE dialect WHEN 'null_item' THEN n_turns + 1
                      WHEN 'missing_key' THEN n_turns WHEN 'bad_role' THEN n_turns
                      WHEN 'null_output' THEN 2 WHEN 'blank_content' THEN 1 END AS msg_index,
         CASE WHEN dialect = 'bad_role' THEN 'Tool' END AS detail
  FROM units JOIN firsts USING (conv_id)
  JOIN {_values([(k, *v) for k, v in DEFECTS.items()], "d", "dialect, outcome, reason, shape, keys")}
    USING (dialect)
)"""

# A document's tokens; the blanks are those of the library's word splitter.
_TOKENS = r"""
WITH docs AS (
  SELECT doc_id,
         list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS tokens
  FROM documents
)"""
_STARTS = f"""{_TOKENS}, sized AS (
  SELECT doc_id, tokens, len(tokens) AS n FROM docs
), starts AS (
  SELECT doc_id, tokens, n,
         CAST(coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS BIGINT) AS st
  FROM sized
)"""


def _turn(prefix: str, infix: str, suffix: str, role: str = "role", text: str = "text") -> str:
    return f"'{prefix}' || {role} || {infix} || {text} || '{suffix}'"


_CHATML = _turn("<|im_start|>", "chr(10)", "<|im_end|>")
_LLAMA = _turn("<|start_header_id|>", "'<|end_header_id|>' || chr(10) || chr(10)", "<|eot_id|>")
_GEMMA_ROLE = "CASE role WHEN 'assistant' THEN 'model' ELSE role END"
_GEMMA = _turn("<start_of_turn>", "chr(10)", "<end_of_turn>", _GEMMA_ROLE)

_RENDERED = f"""
  SELECT conv_id, count(*) AS n_messages,
         string_agg({_CHATML}, chr(10) ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id"""

_NAMED = f"""
WITH plain AS ({_RENDERED}), headed AS (
  SELECT *, lag(CASE WHEN role = 'system' THEN text END)
              OVER (PARTITION BY conv_id ORDER BY turn) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx
  FROM conversations
), folded AS (
  SELECT conv_id, turn, role,
         CASE WHEN idx = 2 AND before IS NOT NULL THEN before || chr(10) || chr(10) || text
              ELSE text END AS text
  FROM headed WHERE NOT (idx = 1 AND role = 'system')
)
SELECT 'chatml' AS template, conv_id, text FROM plain
UNION ALL SELECT 'unheard-of', conv_id, text FROM plain
UNION ALL SELECT 'qwen', conv_id, text || chr(10) FROM plain
UNION ALL SELECT 'llama-3', conv_id, '<|begin_of_text|>' || string_agg({_LLAMA}, '' ORDER BY turn)
  FROM conversations GROUP BY conv_id
UNION ALL SELECT 'gemma-3', conv_id, '<bos>' || string_agg({_GEMMA}, chr(10) ORDER BY turn) || chr(10)
  FROM folded GROUP BY conv_id"""

_SHARD = f"conv_id % {SHARDS}"


def _plan(rows: str, batch: int, accumulation: int, epochs: int) -> str:
    step = batch * accumulation
    return f"""
SELECT n_rows, (n_rows + {batch - 1}) // {batch} AS batches_per_epoch,
       (n_rows + {step - 1}) // {step} AS steps_per_epoch,
       (n_rows + {step - 1}) // {step} * {epochs} AS total_steps,
       CASE WHEN n_rows % {batch} = 0 AND n_rows > 0 THEN {batch} ELSE n_rows % {batch} END AS last_batch
FROM (SELECT count(*) AS n_rows FROM {rows})"""


_STRICT = {"null_item": "n_turns + 1", "missing_key": "n_turns", "no_fields": "NULL"}
_STRICT_REASON = {"null_item": "not_object", "missing_key": "missing_key", "no_fields": "not_list"}

_COUNTS = f"""{_BAD}, counts AS (
  SELECT outcome, count(*) AS n FROM (
    SELECT DISTINCT conv_id, dialect, part, 'processed' AS outcome FROM good
    UNION ALL SELECT conv_id, dialect, part, outcome FROM bad
  ) GROUP BY outcome
)"""

_BATCHES = f"""
SELECT epoch, doc_id, pos, pos // 8 AS batch, pos // 32 AS step FROM (
  SELECT epoch, doc_id,
         row_number() OVER (PARTITION BY epoch ORDER BY md5('{SEED}:' || epoch || ':' || doc_id), doc_id)
         - 1 AS pos
  FROM documents, (VALUES (0), (1)) AS e(epoch))"""

_SPLITS = f"""
WITH r AS ({_RENDERED}), splits AS (
  (SELECT 'train' AS split, * FROM r ORDER BY md5('{SEED}:' || conv_id), conv_id LIMIT 15)
  UNION ALL SELECT 'eval', * FROM r
)"""

ORACLES: dict[str, str] = {
    "render_conversations": _RENDERED,
    "read_lines": "SELECT conv_id, turn, text FROM conversations",
    "read_lines_numbered": f"""
SELECT shard, line_num, conv_id, turn FROM (
  SELECT {_SHARD} AS shard, conv_id, turn,
         CAST(sum(CASE WHEN turn = 0 THEN 2 ELSE 1 END)
              OVER (PARTITION BY {_SHARD} ORDER BY conv_id, turn) AS BIGINT) AS line_num
  FROM conversations)""",
    "parse_outcomes": f"""{_GOOD}
SELECT conv_id, dialect, dialect NOT IN ('trailing_junk', 'truncated', 'plus_infinity') AS ok
FROM units WHERE dialect <> 'blank_line'""",
    "jsonl_roundtrip": f"{_GOOD} SELECT conv_id, idx, role, text AS content FROM turns",
    "dataset_columns": """
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN turn / 4 END AS score,
       CASE WHEN turn % 3 = 0 THEN text END AS tag, CASE WHEN turn % 4 = 0 THEN role END AS role,
       CASE WHEN turn % 4 = 0 THEN conv_id END AS part,
       CASE turn % 3 WHEN 0 THEN CAST(turn AS VARCHAR) WHEN 1 THEN '"one"' END AS mixed,
       CAST(NULL AS VARCHAR) AS note
FROM conversations""",
    "detect_shape": f"""{_BAD}
SELECT conv_id, dialect, shape
FROM units JOIN {_values(list(SHAPES.items()), "s", "dialect, shape")} USING (dialect)
UNION ALL SELECT conv_id, dialect, shape FROM bad""",
    **{
        f"norm_{dialect}": f"{_GOOD} SELECT conv_id, idx, role, content FROM good WHERE dialect = '{dialect}'"
        for dialect in NORM_DIALECTS
    },
    "norm_plus_infinity": f"""{_BAD}
SELECT conv_id, shape, outcome, reason FROM bad WHERE dialect = 'plus_infinity'""",
    "output_field_list": f"""{_GOOD}
SELECT conv_id, 'role_content' AS dialect, 'canonical' AS shape, 'processed' AS outcome,
       CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS msg_index FROM firsts
UNION ALL SELECT conv_id, 'from_value', 'canonical', 'dropped', 'missing_key', 1 FROM firsts""",
    "role_normalise": """
SELECT role_in, role_out, count(*) AS n FROM (
  SELECT unnest([role, upper(role), upper(role[1]) || role[2:], ' ' || role,
                 CASE role WHEN 'user' THEN 'Human' WHEN 'assistant' THEN 'ChatGPT' ELSE 'tool' END
                ]) AS role_in
  FROM conversations
) LEFT JOIN (VALUES ('user', 'user'), ('human', 'user'), ('assistant', 'assistant'),
                    ('chatgpt', 'assistant'), ('system', 'system')) AS m(name, role_out)
  ON lower(role_in) = name
GROUP BY role_in, role_out""",
    "content_strip": "SELECT conv_id, turn, text AS content FROM conversations",
    "accepted_samples": f"{_GOOD} SELECT conv_id, dialect, idx, role, content FROM good",
    "rejects": f"{_BAD} SELECT conv_id, dialect, outcome, reason, msg_index, detail, keys FROM bad",
    "rejects_numbered": f"""{_BAD}, lines AS (
  SELECT conv_id, dialect, part, {_SHARD} AS shard,
         row_number() OVER (PARTITION BY {_SHARD} ORDER BY conv_id, dialect, part) AS line_num
  FROM units
)
SELECT shard, line_num, outcome, reason, msg_index, detail, keys
FROM bad JOIN lines USING (conv_id, dialect, part)""",
    "outcome_counts": f"{_COUNTS} SELECT outcome, n FROM counts",
    "stream_totals": f"{_COUNTS} SELECT outcome, n FROM counts",
    "normalise_counts": f"""{_COUNTS}
SELECT mode, outcome, n
FROM counts, (VALUES ('plain'), ('keep_order'), ('rejects'), ('by_outcome')) AS m(mode)""",
    "normalise_files": f"""{_GOOD}
SELECT idx, role, content, count(*) AS n FROM good GROUP BY idx, role, content""",
    "normalise_in_order": f"""{_GOOD}
SELECT row_number() OVER (ORDER BY CAST({_SHARD} AS VARCHAR), conv_id, dialect, part) AS place,
       count(*) AS n_messages, string_agg(content, ' ' ORDER BY idx) AS contents
FROM good GROUP BY conv_id, dialect, part""",
    "normalise_by_outcome": f"""{_BAD}, sized AS (
  SELECT conv_id, dialect, part, count(*) AS n_messages FROM good GROUP BY conv_id, dialect, part
)
SELECT 'processed' AS outcome, NULL AS reason, CAST(NULL AS BIGINT) AS msg_index, n_messages, count(*) AS n
FROM sized GROUP BY n_messages
UNION ALL
SELECT outcome, reason, msg_index, 0, count(*) FROM bad GROUP BY outcome, reason, msg_index""",
    "stream_normalise": f"{_GOOD} SELECT conv_id, dialect, idx, role, content FROM good",
    "strict_violations": f"{_GOOD} "
    + " UNION ALL ".join(
        f"SELECT conv_id, '{d}' AS dialect, CAST({index} AS BIGINT) AS msg_index,"
        f" '{_STRICT_REASON[d]}' AS reason FROM firsts"
        for d, index in _STRICT.items()
    ),
    "render_chatml": f"SELECT conv_id, text FROM ({_RENDERED})",
    "render_named": _NAMED,
    "norm_nested_content": r"""
WITH escaped AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS e
  FROM conversations
)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx, role,
    '[{''type'': ''text'', ''text'': '
    || CASE WHEN contains(text, '''') AND NOT contains(text, '"') THEN '"' || e || '"'
            ELSE '''' || replace(e, '''', '\''') || '''' END
    || ', ''n'': ' || turn || ', ''part'': ' || CAST(CAST(turn / 4.0 AS DOUBLE) AS VARCHAR)
    || ', ''ok'': ' || CASE WHEN turn % 2 = 0 THEN 'True' ELSE 'False' END
    || '}, None, 1' || repeat('0', 45) || ', []]' AS content
FROM escaped""",
    "render_template_text": """
WITH turns AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
         first_value(role) OVER w = 'system' AS headed, first_value(text) OVER w AS head
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), shown AS (
  SELECT *, place - headed::int AS i, n - headed::int AS m,
         trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS bare
  FROM turns
)
SELECT conv_id, max(CASE WHEN headed THEN trim(head, ' ' || chr(9) || chr(10) || chr(13)) ELSE '' END)
    || '|' || max(n) || chr(10)
    || coalesce(string_agg(
         CASE WHEN role = 'user' AND i < m THEN '[' || i || '] ' || bare || chr(10)
              WHEN NOT contains('user,assistant', role) OR (i - 1) % 2 = 0
                THEN '(' || role || (i - 1) || ') ' || text
              ELSE '>' || text END, '' ORDER BY turn) FILTER (WHERE i > 0), '') AS text
FROM shown GROUP BY conv_id""",
    "render_null_content": f"""
WITH holed AS (
  SELECT conv_id, turn, role,
         CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn) % 3 = 2 THEN '' ELSE text END AS text
  FROM conversations
), texts AS (
  SELECT conv_id, string_agg({_CHATML}, chr(10) ORDER BY turn) AS text FROM holed GROUP BY conv_id
)
SELECT conv_id, form, text FROM texts, (VALUES ('typed'), ('variant')) AS f(form)""",
    "prepare_job": f"""{_SPLITS} SELECT split, conv_id, text FROM splits""",
    "profile": """
SELECT source, n_rows, true AS example_found
FROM (SELECT count(DISTINCT conv_id) AS n_rows FROM conversations),
     (VALUES ('job'), ('written')) AS s(source)""",
    "text_mode": "SELECT doc_id, text FROM documents",
    "sample_train": f"""
SELECT doc_id, text FROM documents ORDER BY md5('{SEED}:' || doc_id), doc_id LIMIT 150""",
    "sample_train_large": f"""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY md5('{SEED}:' || l_orderkey || ':' || l_linenumber), l_orderkey, l_linenumber LIMIT 20000""",
    "prepare_splits": f"""{_SPLITS}
SELECT split, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars,
       CAST(sum(CAST('0x' || md5(conv_id || ':' || text)[1:15] AS BIGINT)) AS VARCHAR) AS digest
FROM splits GROUP BY split""",
    "truncate": f"""{_TOKENS}
SELECT doc_id, least(len(tokens), {MAX_WORDS}) AS n_tokens, len(tokens) > {MAX_WORDS} AS was_truncated,
       array_to_string(tokens[1:{MAX_WORDS}], ' ') AS text
FROM docs""",
    "pack": f"""{_STARTS}, pieces AS (
  SELECT doc_id, st, n, unnest(range(st // {PACK_SIZE}, (st + n - 1) // {PACK_SIZE} + 1)) AS pack_id
  FROM starts WHERE n > 0
)
SELECT pack_id, greatest(st - pack_id * {PACK_SIZE}, 0) AS pack_offset, doc_id,
       greatest(pack_id * {PACK_SIZE} - st, 0) AS src_offset,
       least(st + n, (pack_id + 1) * {PACK_SIZE}) - greatest(st, pack_id * {PACK_SIZE}) AS piece_len
FROM pieces""",
    "pack_tokens": f"""{_STARTS}, flat AS (
  SELECT st + unnest(range(n)) AS place, unnest(tokens) AS token FROM starts
)
SELECT place // {PACK_SIZE} AS pack_id, count(*) AS n_tokens, string_agg(token, ' ' ORDER BY place) AS text
FROM flat GROUP BY place // {PACK_SIZE}""",
    "assign_batches": _BATCHES,
    "write_batches": _BATCHES,
    "batch_texts": f"""
SELECT epoch, step, md5(string_agg(md5(text), ',' ORDER BY pos)) AS digest
FROM ({_BATCHES}) JOIN documents USING (doc_id) GROUP BY epoch, step""",
    "train_plan": _plan("documents", 8, 55, 3),
}

assert set(ORACLES) == set(QUERIES)
