"""Strict JSON parsing into VARIANT."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from turnloom.functions.values import column, let, quoted

# Closes the parse wrapper below; a random value cannot occur in the data.
_SEAL = uuid.uuid4().hex

# One reader for lines of every length: texts and numbers without a bound, Python's NaN and Infinity.
_OPTIONS = (
    "map('maxStringLen', '2147483647', 'maxNumLen', '2147483647', 'allowSingleQuotes', 'false',"
    " 'allowNonNumericNumbers', 'true')"
)
_ESCAPE, _TEXT, _FOREIGN = quoted(r"(?s)\\."), quoted('"[^"]*"'), quoted("[+]I|-INF")

DUPLICATES = "spark.sql.variant.allowDuplicateKeys"


def variant_path(key: str) -> str:
    """Path literal of one object key, quoted so that dots and blanks in the name are safe."""
    if '"' not in key:
        return quoted(f'$["{key}"]')
    if "'" not in key:
        return quoted(f"$['{key}']")
    raise ValueError(f"field name mixes both quote characters: {key!r}")


def last_key_wins(spark: SparkSession) -> None:
    """Let the last of repeated keys win in this session's parses.

    Spark reads the setting while a parse runs, so it has to stay set.
    """
    spark.conf.set(DUPLICATES, "true")


def require_last_key_wins(spark: SparkSession) -> None:
    if str(spark.conf.get(DUPLICATES)).lower() != "true":
        raise ValueError(f"set {DUPLICATES} to true in the session: the last of repeated keys wins")


def _foreign_number(line: str) -> str:
    """Whether +Infinity, +INF or -INF stands outside of texts; Python does not read these."""
    bare = f"regexp_replace(regexp_replace({line}, {_ESCAPE}, ''), {_TEXT}, '')"
    seen = f"(contains({line}, '+I') OR contains({line}, '-INF'))"
    return f"{seen} AND regexp_like({bare}, {_FOREIGN})"


def loose_json(line: str) -> str:
    """Variant of the first JSON value of the line; NULL where there is none."""
    return f"from_json({line}, 'variant', {_OPTIONS})"


def raw_fields(text: str, *names: str) -> str:
    """Struct of the named fields of a JSON object, each as it stands in the text; texts decoded."""
    fields = ",".join(f"{column(name)} string" for name in dict.fromkeys(names))
    return f"from_json({text}, {quoted(f'struct<{fields}>')}, {_OPTIONS})"


def raw_items(text: str) -> str:
    """The items of a JSON list, each as it stands in the text; texts decoded."""
    return f"from_json({text}, 'array<string>', {_OPTIONS})"


def strict_json(line: str) -> str:
    """Variant of the line, NULL where it is not exactly one JSON value.

    The parser ignores text after the first value. Parsing the line as the first item of a
    sealed two-item list makes such text visible.
    """
    sealed = f"""from_json(concat('[', {line}, ',"{_SEAL}"]'), 'variant', {_OPTIONS})"""
    whole = f"size(pair) = 2 AND try_variant_get(get(pair, 1), '$', 'string') = '{_SEAL}'"
    checked = f"if({whole} AND NOT ({_foreign_number(line)}), get(pair, 0), NULL)"
    return let("pair", f"try_variant_get({sealed}, '$', 'array<variant>')", checked)


def parse_record(df: DataFrame, line: str = "line", into: str = "record") -> DataFrame:
    """Add the parsed line as a VARIANT column; the last of repeated keys wins."""
    require_last_key_wins(df.sparkSession)
    return df.selectExpr("*", f"{strict_json(column(line))} AS {column(into)}")
