"""Chat templates: one message list to one training text."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.operators.shapes import MESSAGES
from turnloom.operators.template_text import is_template_text, render_text

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Template:
    """Text is start + (prefix role infix content suffix), joined by separator, + end."""

    prefix: str
    infix: str
    suffix: str
    separator: str = ""
    start: str = ""
    end: str = ""
    role_names: dict[str, str] = field(default_factory=dict)
    # For formats without a system role: its text opens the message that follows.
    system_glue: str | None = None


# Published chat formats, as template texts.
TEMPLATES = {
    "chatml": (
        "{% for message in messages %}{% if not loop.first %}{{ '\\n' }}{% endif %}"
        "{{ '<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' }}{% endfor %}"
    ),
    "qwen": (
        "{% for message in messages %}"
        "{{ '<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n' }}{% endfor %}"
    ),
    "llama-3": (
        "{{ '<|begin_of_text|>' }}{% for message in messages %}"
        "{{ '<|start_header_id|>' + message['role'] + '<|end_header_id|>\\n\\n' + message['content']"
        " + '<|eot_id|>' }}{% endfor %}"
    ),
    "gemma-3": (
        "{{ '<bos>' }}"
        "{% if messages[0]['role'] == 'system' %}"
        "{% set opening = messages[0]['content'] + '\\n\\n' %}{% set turns = messages[1:] %}"
        "{% else %}{% set opening = '' %}{% set turns = messages %}{% endif %}"
        "{% for message in turns %}"
        "{% set role = 'model' if message['role'] == 'assistant' else message['role'] %}"
        "{{ '<start_of_turn>' + role + '\\n' + (opening if loop.first else '') + message['content']"
        " + '<end_of_turn>\\n' }}{% endfor %}"
    ),
}
DEFAULT_TEMPLATE = "chatml"


def choose_template(name: str | None) -> str:
    """The template's text; the default, with a warning, for a name that is not known."""
    if name is not None and is_template_text(name):
        return name
    if name is not None and name not in TEMPLATES:
        logger.warning(
            "unknown chat template %r, using %r; known: %s",
            name,
            DEFAULT_TEMPLATE,
            ", ".join(TEMPLATES),
        )
    return TEMPLATES.get(name or DEFAULT_TEMPLATE, TEMPLATES[DEFAULT_TEMPLATE])


def _fold_system(messages: Column, glue: str) -> Column:
    opening = F.get(messages, F.lit(0))

    def joined(message: Column, position: Column) -> Column:
        text = F.concat(
            F.coalesce(opening.content, F.lit("")),
            F.lit(glue),
            F.coalesce(message.content, F.lit("")),
        )
        return F.struct(
            message.role.alias("role"),
            F.when(position == 0, text).otherwise(message.content).alias("content"),
        )

    rest = F.transform(F.slice(messages, F.lit(2), F.size(messages)), joined)
    plain = F.transform(messages, lambda m: F.struct(m.role.alias("role"), m.content.alias("content")))
    return F.when(opening.role == "system", rest).otherwise(plain)


def render_chat(
    messages: Column, template: Template | str | None = None, trailing_newline: bool = False
) -> Column:
    """Text of a message list, without a generation prompt.

    The template is a name, a template's own text or a Template. A NULL role or content is
    written as empty text, so that no turn is lost.
    """
    if not isinstance(template, Template):
        text = render_text(choose_template(template), messages)
        return F.concat(text, F.when(F.endswith(text, F.lit("\n")), "").otherwise("\n")) if trailing_newline else text
    chosen = template

    def role_name(role: Column) -> Column:
        named = F
        for standard, name in chosen.role_names.items():
            named = named.when(role == standard, name)
        return named.otherwise(role) if chosen.role_names else role

    def turn(message: Column) -> Column:
        return F.concat(
            F.lit(chosen.prefix),
            F.coalesce(role_name(message.role), F.lit("")),
            F.lit(chosen.infix),
            F.coalesce(message.content, F.lit("")),
            F.lit(chosen.suffix),
        )

    if chosen.system_glue is not None:
        messages = _fold_system(messages, chosen.system_glue)
    body = F.array_join(F.transform(messages, turn), chosen.separator)
    end = chosen.end or ("\n" if trailing_newline else "")
    return F.concat(F.lit(chosen.start), body, F.lit(end))


def message_faults(messages: Column, kind: T.DataType) -> Column:
    """Faults of a message list as ARRAY<STRUCT<msg_index, reason>>, empty where it is sound.

    Accepts a typed list or a VARIANT. A value that is no list gives `not_list` at index NULL.
    """
    if isinstance(kind, T.VariantType):
        messages = F.try_variant_get(messages, "$", MESSAGES)

    def fault(message: Column, position: Column) -> Column:
        reason = F.when(message.isNull(), "not_object").when(
            message.role.isNull() | message.content.isNull(), "missing_key"
        )
        return F.struct((position + 1).alias("msg_index"), reason.alias("reason"))

    found = F.filter(F.transform(messages, fault), lambda f: f.reason.isNotNull())
    no_list = F.array(
        F.struct(F.lit(None).cast("int").alias("msg_index"), F.lit("not_list").alias("reason"))
    )
    return F.when(messages.isNull(), no_list).otherwise(found)


def require_field(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"the dataset has no field {name!r}; it has {', '.join(df.columns)}")


def violations(df: DataFrame, *keys: str, messages_field: str = "messages") -> DataFrame:
    """One row per fault: the keys, msg_index and reason. Empty for a sound dataset."""
    require_field(df, messages_field)
    faults = message_faults(F.col(messages_field), df.schema[messages_field].dataType)
    return df.select(*keys, F.explode(faults).alias("_fault")).select(*keys, "_fault.*")


def observe_faults(df: DataFrame, observation: Observation, messages_field: str = "messages") -> DataFrame:
    """Count the rows with a faulty message list while another action reads them; one as example."""
    faults = message_faults(F.col(messages_field), df.schema[messages_field].dataType)
    faulty = F.size(faults) > 0
    return df.observe(
        observation,
        F.count_if(faulty).alias("rows"),
        F.min(F.when(faulty, F.to_json(faults))).alias("example"),
    )


def strict_render(
    df: DataFrame,
    template: Template | str | None = None,
    messages_field: str = "messages",
    text_field: str = "text",
    trailing_newline: bool = False,
    formatter: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add the text, rendered by the template or the formatter; a faulty message list stops the job."""
    require_field(df, messages_field)
    kind = df.schema[messages_field].dataType
    messages = F.col(messages_field)
    faults = message_faults(messages, kind)
    if formatter is not None:
        rendered = formatter(messages)
    else:
        if isinstance(kind, T.VariantType):
            messages = F.try_variant_get(messages, "$", "array<struct<role:string,content:string>>")
        rendered = render_chat(messages, template, trailing_newline)
    report = F.concat(F.lit(f"field {messages_field!r} is not sound: "), F.to_json(faults))
    text = F.when(F.size(faults) > 0, F.raise_error(report)).otherwise(rendered)
    return df.withColumn(text_field, text)


def text_mode(df: DataFrame, text_field: str = "text") -> DataFrame:
    """The text field as it is; a missing field or value stops the job."""
    require_field(df, text_field)
    text = F.col(text_field)
    missing = F.raise_error(F.lit(f"a record has no field {text_field!r}")).cast("string")
    return df.withColumn(text_field, F.when(text.isNull(), missing).otherwise(text))
