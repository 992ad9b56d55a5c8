"""Shape adapters: one VARIANT record of any supported dialogue shape to one message list.

A message is STRUCT<role: VARIANT, content: VARIANT>. A field that the item lacks is NULL; a
field that is present with the JSON value null is a variant null, which is not NULL. An item
that is no JSON object is a NULL struct. The variant cast keeps all of this apart in one pass.
"""

from __future__ import annotations

from turnloom.functions import column, is_falsy, let, python_str, quoted, raw_fields, raw_items
from turnloom.functions import typed, variant_path

# Field names of the supported record shapes.
INPUT_FIELD = "conversations"
OUTPUT_FIELD = "messages"
STANDARD_FIELD = "messages"
INSTRUCTION = ("instruction", "input", "output")
PAIRS = (("prompt", "response"), ("question", "answer"))
FALLBACK_FIELDS = ("conversation", "dialogue", "chat", "history", "context")
ITEM_FORMS = (("role", "content"), ("from", "value"), ("speaker", "text"))

MESSAGES = "array<struct<role:variant,content:variant>>"
_ITEMS = (
    "array<struct<"
    + ",".join(f"`{name}`:variant" for form in ITEM_FORMS for name in form)
    + ">>"
)
_ENVELOPE = (
    "struct<"
    + ",".join(
        [f"{name}:variant" for name in (*INSTRUCTION, *PAIRS[0], *PAIRS[1])]
        + [f"{name}:{MESSAGES}" for name in (STANDARD_FIELD, *FALLBACK_FIELDS)]
    )
    + ">"
)


def envelope(
    record: str, input_field: str = INPUT_FIELD, output_field: str = OUTPUT_FIELD
) -> str:
    """Everything the adapters look at, read from the record once.

    Fields: known (the fixed fields, NULL where the record is no object), canonical (the list
    under the output field or the standard field), listed (the items of the input field, NULL
    where it is no list) and has_input.
    """
    inside = variant_path(input_field)
    canonical = f"known.{STANDARD_FIELD}"
    if output_field != STANDARD_FIELD:
        own = f"try_variant_get({record}, {variant_path(output_field)}, '{MESSAGES}')"
        canonical = f"coalesce({own}, {canonical})"
    fields = f"""struct(known, {canonical} AS canonical,
      try_variant_get({record}, {inside}, '{_ITEMS}') AS listed,
      try_variant_get({record}, {inside}, 'variant') IS NOT NULL AS has_input)"""
    return let("known", f"try_variant_get({record}, '$', '{_ENVELOPE}')", fields)


def _has_both(item: str, form: tuple[str, str]) -> str:
    return f"({item}.`{form[0]}` IS NOT NULL AND {item}.`{form[1]}` IS NOT NULL)"


def conversation_messages(items: str) -> str:
    """Items in role/content, from/value or speaker/text form; any other item is left out."""
    forms = " ".join(
        f"WHEN {_has_both('item', form)}"
        f" THEN struct(item.`{form[0]}` AS role, item.`{form[1]}` AS content)"
        for form in ITEM_FORMS
    )
    return f"filter(transform({items}, item -> CASE {forms} END), m -> m IS NOT NULL)"


def fallback_messages(known: str) -> str:
    """The first fallback field whose list holds a role/content item; NULL if there is none."""
    lists = ", ".join(
        f"filter({known}.{name}, item -> {_has_both('item', ITEM_FORMS[0])})"
        for name in FALLBACK_FIELDS
    )
    return f"get(filter(array({lists}), kept -> size(kept) > 0), 0)"


def _spoken(role: str, content: str) -> str:
    return f"struct(cast('{role}' AS variant) AS role, {content} AS content)"


def _with_optional_reply(user: str, reply: str) -> str:
    opening, answer = _spoken("user", user), _spoken("assistant", reply)
    return f"if({reply} IS NULL, array({opening}), array({opening}, {answer}))"


def instruction_messages(known: str) -> str:
    """User text is the instruction, with the input below it where that is truthy."""
    instruction, extra, reply = (f"{known}.{name}" for name in INSTRUCTION)
    head, more = let("v", typed(instruction), python_str("v")), python_str("x")
    joined = f"cast(concat({head}, '\n', {more}) AS variant)"
    user = let("x", typed(extra), f"if({is_falsy('x')}, {instruction}, {joined})")
    return _with_optional_reply(f"if({extra} IS NULL, {instruction}, {user})", reply)


def pair_messages(known: str, pair: tuple[str, str]) -> str:
    """A question and its answer, where the record has one."""
    return _with_optional_reply(f"{known}.{pair[0]}", f"{known}.{pair[1]}")


def extract_messages(env: str) -> str:
    """Struct of shape and messages, by precedence.

    A list under the output field or the standard field; the input field; then instruction,
    prompt and question, none of which is tried where the input field is present; then the
    fallback fields. The shape is `none` where nothing fits.
    """
    known = f"{env}.known"

    def found(shape: str, messages: str) -> str:
        return f"struct('{shape}' AS shape, {messages} AS messages)"

    searched = let(
        "m",
        fallback_messages(known),
        "struct(if(m IS NULL, 'none', 'fallback') AS shape, m AS messages)",
    )
    listed = found("conversation", conversation_messages(f"{env}.listed"))
    fixed = [(INSTRUCTION[0], instruction_messages(known))]
    fixed += [(pair[0], pair_messages(known, pair)) for pair in PAIRS]
    later = " ".join(
        f"WHEN {known}.{name} IS NOT NULL THEN {found(name, messages)}" for name, messages in fixed
    )
    return f"""CASE
      WHEN {env}.canonical IS NOT NULL THEN {found("canonical", f"{env}.canonical")}
      WHEN {env}.listed IS NOT NULL THEN {listed}
      WHEN {env}.has_input THEN {searched}
      {later}
      ELSE {searched} END"""


def raw_contents(
    line: str,
    record: str,
    env: str,
    shape: str,
    input_field: str = INPUT_FIELD,
    output_field: str = OUTPUT_FIELD,
) -> str:
    """The raw JSON text of each message's content, in the order of extract_messages.

    It reads the line again and is meant for the few records with nested contents. A list under a
    shape is read as text items, and the same items are left out as there. An instruction that
    was joined with an input is text already and gives NULL.
    """
    known = f"{env}.known"
    fixed = [name for pair in PAIRS for name in pair]
    top = raw_fields(
        line, input_field, output_field, STANDARD_FIELD, *INSTRUCTION, *fixed, *FALLBACK_FIELDS
    )
    content = ITEM_FORMS[0][1]
    canonical = f"top.{column(STANDARD_FIELD)}"
    if output_field != STANDARD_FIELD:
        own = f"try_variant_get({record}, {variant_path(output_field)}, '{MESSAGES}')"
        canonical = f"if({own} IS NOT NULL, top.{column(output_field)}, {canonical})"
    listed = f"transform({raw_items(canonical)}, x -> {raw_fields('x', content)}.{content})"

    def kept(items: str, forms: tuple, name: str) -> str:
        cases = " ".join(
            f"WHEN {_has_both('item', form)} THEN struct(i AS at, '{form[1]}' AS field, {quoted(name)} AS list)"
            for form in forms
        )
        return f"filter(transform({items}, (item, i) -> CASE {cases} END), k -> k IS NOT NULL)"

    def chosen(items: str, places: str) -> str:
        texts = [form[1] for form in ITEM_FORMS]
        by_field = " ".join(f"WHEN '{t}' THEN own.{t}" for t in texts)
        own = let("own", raw_fields("get(raws_of, k.at)", *texts), f"CASE k.field {by_field} END")
        return let("raws_of", raw_items(items), f"transform({places}, k -> {own})")

    conversation = chosen(f"top.{column(input_field)}", kept(f"{env}.listed", ITEM_FORMS, input_field))
    lists = ", ".join(kept(f"{known}.{name}", ITEM_FORMS[:1], name) for name in FALLBACK_FIELDS)
    names = " ".join(f"WHEN '{name}' THEN top.{name}" for name in FALLBACK_FIELDS)
    fallback = let(
        "places",
        f"get(filter(array({lists}), ks -> size(ks) > 0), 0)",
        chosen(f"CASE places[0].list {names} END", "places"),
    )
    instruction, extra, reply = INSTRUCTION
    joined = let("x", typed(f"{known}.{extra}"), is_falsy("x"))
    user = f"if({known}.{extra} IS NULL OR {joined}, top.{instruction}, NULL)"
    pairs = " ".join(f"WHEN '{q}' THEN array(top.{q}, top.{a})" for q, a in PAIRS)
    return let(
        "top",
        top,
        f"""CASE {shape} WHEN 'canonical' THEN {listed}
          WHEN 'conversation' THEN {conversation}
          WHEN 'fallback' THEN {fallback}
          WHEN '{instruction}' THEN array({user}, top.{reply})
          {pairs} END""",
    )
