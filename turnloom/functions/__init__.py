"""SQL expressions that reproduce Python's text and truth rules on the JVM side."""

from turnloom.functions.records import (
    last_key_wins,
    loose_json,
    parse_record,
    raw_fields,
    raw_items,
    require_last_key_wins,
    strict_json,
    variant_path,
)
from turnloom.functions.values import (
    clean_text,
    column,
    is_falsy,
    let,
    needs_raw,
    not_blank,
    python_float,
    python_literal,
    python_repr,
    python_str,
    python_strip,
    quoted,
    raw_text,
    typed,
    typed_fields,
)

__all__ = [
    "clean_text",
    "column",
    "is_falsy",
    "last_key_wins",
    "let",
    "loose_json",
    "needs_raw",
    "not_blank",
    "parse_record",
    "python_float",
    "python_literal",
    "python_repr",
    "python_str",
    "python_strip",
    "quoted",
    "raw_fields",
    "raw_items",
    "raw_text",
    "require_last_key_wins",
    "strict_json",
    "typed",
    "typed_fields",
    "variant_path",
]
