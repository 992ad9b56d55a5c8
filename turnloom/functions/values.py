"""Python's strip(), str() and truth test as Spark SQL expressions over strings and variants.

Each function takes and returns SQL text, for F.expr or selectExpr. Nested as text, the whole
normaliser is parsed once by Spark; built from Column objects it takes thousands of calls from
the driver's Python and several seconds per plan.
"""

from __future__ import annotations

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def quoted(text: str) -> str:
    """SQL string literal of the text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> str:
    """SQL reference to a column or struct field of this exact name."""
    return "`" + name.replace("`", "``") + "`"


def let(name: str, value: str, body: str) -> str:
    """The body with `name` standing for the value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def python_strip(text: str) -> str:
    """Remove Python whitespace from both ends; Spark's plain trim() knows only the space.

    Trimming a set of characters on the right walks the whole text, so it is done only where
    the last byte can belong to one of them. The text should be a column, field or let name.
    """
    last_byte = f"substr(cast({text} AS binary), -1, 1)"
    endings = ", ".join(f"X'{b:02X}'" for b in sorted({c.encode()[-1] for c in WHITESPACE}))
    opened = f"ltrim({quoted(WHITESPACE)}, {text})"
    trimmed = f"rtrim({quoted(WHITESPACE)}, {opened})"
    return f"CASE WHEN {last_byte} IN ({endings}) THEN {trimmed} ELSE {opened} END"


def not_blank(text: str) -> str:
    """True where the text has a character that python_strip would keep."""
    return f"ltrim({quoted(WHITESPACE)}, {text}) <> ''"


def typed_fields(value: str) -> str:
    """A variant, the name of its type and its text: the fields the rules below work on.

    Type names are STRING, VOID, BOOLEAN, BIGINT, DECIMAL(p,s), DOUBLE, ARRAY.. and OBJECT..
    """
    return (
        f"{value} AS value, schema_of_variant({value}) AS kind,"
        f" try_variant_get({value}, '$', 'string') AS text"
    )


def typed(value: str) -> str:
    """Struct of the typed_fields."""
    return f"struct({typed_fields(value)})"


def _is_integer(v: str) -> str:
    # Integers beyond 64 bits are held as DECIMAL(19..38,0); shorter scale-0 decimals were
    # written with a fraction such as 1.0.
    return rf"({v}.kind = 'BIGINT' OR regexp_like({v}.kind, '^DECIMAL[(](19|[23][0-9]),0[)]$'))"


def _is_float(v: str) -> str:
    return f"({v}.kind = 'DOUBLE' OR startswith({v}.kind, 'DECIMAL'))"


def _double(v: str) -> str:
    return f"try_variant_get({v}.value, '$', 'double')"


def python_float(number: str) -> str:
    """repr() of a double: positional between 1e-4 and 1e16, else like 1e+22; nan, inf, -inf."""
    exponent = "try_cast(split_part(java, 'E', 2) AS int)"
    mantissa = "regexp_replace(split_part(java, 'E', 1), '[.]0$', '')"
    parts = (
        f"struct(java AS plain, {mantissa} AS mantissa,"
        f" replace({mantissa}, '.', '') AS digits, {exponent} AS exponent)"
    )
    layout = """CASE
      WHEN p.exponent IS NULL THEN p.plain
      WHEN p.exponent = -4 THEN concat('0.000', p.digits)
      WHEN p.exponent BETWEEN 7 AND 15 AND length(p.digits) <= p.exponent + 1
        THEN concat(rpad(p.digits, p.exponent + 1, '0'), '.0')
      WHEN p.exponent BETWEEN 7 AND 15
        THEN concat(left(p.digits, p.exponent + 1), '.', substr(p.digits, p.exponent + 2))
      ELSE concat(p.mantissa, if(p.exponent < 0, 'e-', 'e+'),
                  if(abs(p.exponent) < 10, '0', ''), abs(p.exponent)) END"""
    magnitude = let("java", f"cast(abs({number}) AS string)", let("p", parts, layout))
    shown = f"if(isnan({number}), 'nan', if(abs({number}) = double('Infinity'), 'inf', {magnitude}))"
    return f"concat(if({number} < 0, '-', ''), {shown})"


def python_str(v: str) -> str:
    """str() of a JSON value given as a typed() struct. Lists and objects become JSON text.

    A VARIANT has no order of keys and no digits beyond its types; python_literal has both.
    """
    return f"""CASE
      WHEN {v}.kind = 'STRING' THEN {v}.text
      WHEN {v}.kind = 'VOID' THEN 'None'
      WHEN {v}.kind = 'BOOLEAN' THEN if({v}.text = 'true', 'True', 'False')
      WHEN {_is_integer(v)} THEN {v}.text
      WHEN {_is_float(v)} THEN {let("number", _double(v), python_float("number"))}
      ELSE {v}.text END"""


# Characters that repr() of a text does not show as they are: all but letters, marks, digits,
# signs and the plain blank.
_UNSHOWN = r"[\p{C}\p{Z}&&[^ ]]"


def python_repr(text: str) -> str:
    """repr() of a text given as a column, field or let name."""
    escaped = (
        rf"replace(replace(replace(replace({text}, '\\', '\\\\'), '\n', '\\n'), '\r', '\\r'), '\t', '\\t')"
    )
    double = f"""(contains({text}, "'") AND NOT contains({text}, '"'))"""
    inner = f"""if({double}, {escaped}, replace({escaped}, "'", {quoted("\\'")}))"""
    code = """CASE WHEN ascii(c) < 256 THEN concat('\\\\x', lpad(lower(hex(ascii(c))), 2, '0'))
      WHEN ascii(c) < 65536 THEN concat('\\\\u', lpad(lower(hex(ascii(c))), 4, '0'))
      ELSE concat('\\\\U', lpad(lower(hex(ascii(c))), 8, '0')) END"""
    unshown = quoted(_UNSHOWN)
    each = f"transform(regexp_extract_all(inside, '(?s).', 0), c -> if(regexp_like(c, {unshown}), {code}, c))"
    shown = f"if(regexp_like(inside, {unshown}), array_join({each}, ''), inside)"
    mark = f"""if({double}, '"', "'")"""
    return let("inside", inner, f"concat({mark}, {shown}, {mark})")


def python_literal(raw: str) -> str:
    """str() of what json.loads() makes of the raw text of a JSON list or object, at any depth.

    Works on the tokens of the text, so order, repeated keys and numbers are as they were written.
    """
    # Backslashes come in pairs or open an escape; after this no text holds a bare quote.
    plain = rf"""replace(replace({raw}, '\\\\', '\\u005c'), '\\"', '\\u0022')"""
    tokens = f"""regexp_extract_all({plain}, {quoted(r'"[^"]*"|[-+.\w]+|[\[\]{},:]')}, 0)"""
    text = let("decoded", "from_json(concat('[', t, ']'), 'array<string>')[0]", python_repr("decoded"))
    number = let("number", "cast(t AS double)", python_float("number"))
    shown = f"""CASE
      WHEN startswith(t, '"') THEN {text}
      WHEN t = ',' THEN ', ' WHEN t = ':' THEN ': '
      WHEN t IN ('[', ']', '{{', '}}') THEN t
      WHEN t = 'true' THEN 'True' WHEN t = 'false' THEN 'False' WHEN t = 'null' THEN 'None'
      WHEN t = 'NaN' THEN 'nan' WHEN t = 'Infinity' THEN 'inf' WHEN t = '-Infinity' THEN '-inf'
      WHEN t = '-0' THEN '0'
      WHEN regexp_like(t, '^-?[0-9]+$') THEN t
      WHEN startswith(t, '-') AND cast(t AS double) = 0 THEN '-0.0'
      ELSE {number} END"""
    return f"array_join(transform({tokens}, t -> {shown}), '')"


def is_falsy(v: str) -> str:
    """Python's `not value` for a JSON value given as a typed() struct."""
    return f"""CASE
      WHEN {v}.kind = 'STRING' THEN {v}.text = ''
      WHEN {v}.kind = 'VOID' THEN true
      WHEN {v}.kind = 'BOOLEAN' THEN {v}.text = 'false'
      WHEN {_is_integer(v)} OR {_is_float(v)} THEN {_double(v)} = 0
      ELSE {v}.text IN ('[]', '{{}}') END"""


def needs_raw(v: str) -> str:
    """Whether str() of a typed() value takes its raw text: lists, objects and very long integers."""
    return (
        f"(startswith({v}.kind, 'ARRAY') OR startswith({v}.kind, 'OBJECT')"
        f" OR ({v}.kind = 'DOUBLE' AND abs({_double(v)}) >= 1e38))"
    )


def raw_text(v: str, raw: str) -> str:
    """Stripped str() of a typed() value that needs_raw, from its raw JSON text."""
    return f"""CASE WHEN {v}.text IN ('[]', '{{}}') THEN ''
      WHEN {v}.kind <> 'DOUBLE' OR regexp_like({raw}, '^-?[0-9]+$') THEN {python_literal(raw)}
      ELSE {clean_text(v)} END"""


def clean_text(v: str) -> str:
    """Stripped str() of a typed() value, or the empty string where the value is falsy."""
    shown = f"CASE WHEN {is_falsy(v)} THEN '' ELSE {python_str(v)} END"
    return f"""CASE
      WHEN {v}.kind = 'STRING' THEN {python_strip(f"{v}.text")}
      ELSE {let("shown", shown, python_strip("shown"))} END"""
