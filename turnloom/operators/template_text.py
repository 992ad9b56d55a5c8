"""Chat templates given as text, turned into one column expression over a message list.

The subset that published chat templates are written in: text, `{{ value }}`, `{# remark #}`, `for`
over messages, `if`/`elif`/`else`, `set`, and `-` next to a bracket to strip blanks there. Values are
texts, whole numbers, truth values, `messages`, a message and its role and content, `loop.first`,
`last`, `index` and `index0`, and what `+ ~ % == != < > and or not in is if-else`, `[n]`, `[n:]`, the
filters `trim` and `length` and the tests `defined` and `none` make of them. `raise_exception(text)`
stops the job. `add_generation_prompt` is false, as training texts end with their last message.
Blanks before a tag that opens a line and the line feed after a tag are dropped, as is usual for
chat templates. Anything else is refused with the tag or name that is not understood.

A NULL role or content counts as empty text. Text beyond the subset is never run as code.
"""

from __future__ import annotations

import ast
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.values import WHITESPACE

TEXT, NUMBER, TRUTH, LIST, MESSAGE, NOTHING = "text", "number", "truth", "list", "message", "nothing"
# Special tokens that templates name; a training text starts with its own.
SPECIAL = {"bos_token": "", "eos_token": ""}

_PART = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(
    r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~%<>.()\[\]|:,]))",
    re.S,
)


@dataclass(frozen=True)
class Value:
    kind: str
    column: Column | None = None


def is_template_text(template: str) -> bool:
    return "{{" in template or "{%" in template


def _split(source: str) -> list[tuple[str, str]]:
    """('text', ..), ('value', ..) and ('tag', ..) in order, blanks around tags dealt with."""
    parts: list[tuple[str, str]] = []
    at, strip_next, feed_next = 0, False, False

    def add(text: str, found: str) -> None:
        _, opened, blanks = text.rpartition("\n")
        opens_line = not blanks.strip(" \t") and (opened or at == 0)
        if strip_next:
            text = text.lstrip()
        elif feed_next and text.startswith("\n"):
            text = text[1:]
        if found.startswith(("{%-", "{{-", "{#-")):
            text = text.rstrip()
        elif found.startswith(("{%", "{#")) and opens_line and blanks:
            text = text[: -len(blanks)] if text.endswith(blanks) else ""
        if text:
            parts.append(("text", text))

    for found in _PART.finditer(source):
        add(source[at : found.start()], found[0])
        if found[1] is not None:
            parts.append(("value", found[1].strip()))
        elif found[2] is not None:
            parts.append(("tag", found[2].strip()))
        at, strip_next = found.end(), found[0].endswith(("-%}", "-}}", "-#}"))
        feed_next = not found[0].startswith("{{")
    add(source[at:], "")
    if re.search(r"\{\{|\{%|\{#", _PART.sub("", source)):
        raise ValueError("the chat template has a bracket that is not closed")
    return parts


class _Expression:
    """One expression, read from left to right into a Value."""

    def __init__(self, text: str, names: dict[str, Value]) -> None:
        self.text, self.names, self.at = text, names, 0
        self.tokens: list[tuple[str, str]] = []
        end = len(text.rstrip())
        while self.at < end:
            found = _TOKEN.match(text, self.at)
            if not found:
                raise self.refused(text[self.at :])
            kind = ("quote", "number", "name", "sign")[found.lastindex - 1]
            self.tokens.append((kind, found[found.lastindex]))
            self.at = found.end()
        self.at = 0

    def refused(self, what: str) -> ValueError:
        return ValueError(f"the chat template uses {what!r}, which is not supported, in {self.text!r}")

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, word = self.tokens[self.at]
            if kind in ("sign", "name") and word in wanted:
                self.at += 1
                return word
        return None

    def need(self, sign: str) -> None:
        if not self.take(sign):
            rest = self.tokens[self.at][1] if self.at < len(self.tokens) else "the end"
            raise self.refused(rest)

    def whole(self) -> Value:
        value = self.choice()
        if self.at < len(self.tokens):
            raise self.refused(self.tokens[self.at][1])
        return value

    def choice(self) -> Value:
        value = self.either()
        if not self.take("if"):
            return value
        condition = truth(self.either())
        other = self.choice() if self.take("else") else Value(TEXT, F.lit(""))
        return merged(condition, value, other)

    def either(self) -> Value:
        value = self.both()
        while self.take("or"):
            value = Value(TRUTH, truth(value) | truth(self.both()))
        return value

    def both(self) -> Value:
        value = self.negated()
        while self.take("and"):
            value = Value(TRUTH, truth(value) & truth(self.negated()))
        return value

    def negated(self) -> Value:
        return Value(TRUTH, ~truth(self.negated())) if self.take("not") else self.compared()

    def compared(self) -> Value:
        value = self.joined()
        while sign := self.take("==", "!=", "<", ">", "<=", ">=", "in", "not", "is"):
            if sign == "is":
                value = self.tested(value)
                continue
            if sign == "not":
                self.need("in")
            other = self.joined()
            if sign in ("in", "not"):
                if (value.kind, other.kind) != (TEXT, TEXT):
                    raise self.refused("in")
                found = F.contains(other.column, value.column)
                value = Value(TRUTH, found if sign == "in" else ~found)
            elif value.kind != other.kind or value.kind not in (TEXT, NUMBER, TRUTH):
                if sign not in ("==", "!="):
                    raise self.refused(sign)
                value = Value(TRUTH, F.lit(sign == "!="))
            else:
                a, b = value.column, other.column
                value = Value(
                    TRUTH,
                    {"==": a == b, "!=": a != b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[sign],
                )
        return value

    def tested(self, value: Value) -> Value:
        turned = bool(self.take("not"))
        test = self.take("defined", "none", "string")
        if test is None:
            raise self.refused("is")
        holds = {"defined": value.kind != NOTHING, "none": value.kind == NOTHING, "string": value.kind == TEXT}[test]
        return Value(TRUTH, F.lit(holds != turned))

    def joined(self) -> Value:
        value = self.filtered()
        while sign := self.take("+", "~", "%", "-"):
            other = self.filtered()
            if sign == "~" or (sign == "+" and value.kind == other.kind == TEXT):
                value = Value(TEXT, F.concat(shown(value), shown(other)))
            elif value.kind == other.kind == NUMBER:
                a, b = value.column, other.column
                value = Value(NUMBER, a + b if sign == "+" else a - b if sign == "-" else F.pmod(a, b))
            else:
                raise self.refused(sign)
        return value

    def filtered(self) -> Value:
        value = self.part()
        while self.take("|"):
            name = self.take("trim", "length", "count")
            if name == "trim" and value.kind == TEXT:
                value = Value(TEXT, F.rtrim(F.ltrim(value.column, F.lit(WHITESPACE)), F.lit(WHITESPACE)))
            elif name in ("length", "count") and value.kind in (TEXT, LIST):
                size = F.size if value.kind == LIST else F.length
                value = Value(NUMBER, size(value.column))
            else:
                raise self.refused("|")
        return value

    def part(self) -> Value:
        value = self.single()
        while True:
            if self.take("."):
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "the end")
                self.at += 1
                if kind == "name" and name in ("strip", "trim") and value.kind == TEXT and self.take("("):
                    self.need(")")
                    value = Value(TEXT, F.rtrim(F.ltrim(value.column, F.lit(WHITESPACE)), F.lit(WHITESPACE)))
                else:
                    value = self.member(value, name)
            elif self.take("["):
                kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("", "the end")
                if kind == "quote":
                    self.at += 1
                    value = self.member(value, ast.literal_eval(word))
                else:
                    value = self.item(value)
                self.need("]")
            else:
                return value

    def item(self, value: Value) -> Value:
        back = bool(self.take("-"))
        kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("", "the end")
        if kind != "number" or value.kind != LIST:
            raise self.refused(word)
        self.at += 1
        if not back and self.take(":"):
            rest = F.greatest(F.size(value.column) - int(word), F.lit(0))
            return Value(LIST, F.slice(value.column, int(word) + 1, rest))
        place = F.size(value.column) - int(word) if back else F.lit(int(word))
        return Value(MESSAGE, F.get(value.column, place))

    def member(self, value: Value, name: str) -> Value:
        if value.kind == MESSAGE and name in ("role", "content"):
            return Value(TEXT, F.coalesce(value.column.getField(name), F.lit("")))
        if value.kind == MESSAGE:  # messages hold a role and a content only
            return Value(NOTHING)
        raise self.refused(name)

    def single(self) -> Value:
        if self.at >= len(self.tokens):
            raise self.refused("the end")
        kind, word = self.tokens[self.at]
        self.at += 1
        if kind == "quote":
            return Value(TEXT, F.lit(ast.literal_eval(word.replace("\n", "\\n"))))
        if kind == "number":
            return Value(NUMBER, F.lit(int(word)))
        if word == "(":
            value = self.choice()
            self.need(")")
            return value
        if kind != "name":
            raise self.refused(word)
        if word == "loop" and "loop" in self.names:
            self.need(".")
            name = "loop." + self.tokens[self.at][1] if self.at < len(self.tokens) else "loop."
            self.at += 1
            if name not in self.names:
                raise self.refused(name)
            return self.names[name]
        if word.lower() in ("true", "false"):
            return Value(TRUTH, F.lit(word.lower() == "true"))
        if word.lower() == "none":
            return Value(NOTHING)
        if word == "raise_exception":
            self.need("(")
            message = shown(self.choice())
            self.need(")")
            return Value(TEXT, F.raise_error(message).cast("string"))
        if self.take("("):
            raise self.refused(f"{word}()")
        return self.names.get(word, Value(NOTHING))


def truth(value: Value) -> Column:
    if value.kind in (NOTHING, MESSAGE):
        return F.lit(False) if value.kind == NOTHING else value.column.isNotNull()
    if value.kind == TRUTH:
        return value.column
    if value.kind == LIST:
        return F.size(value.column) > 0
    return value.column != F.lit("" if value.kind == TEXT else 0)


def shown(value: Value) -> Column:
    if value.kind == TEXT:
        return value.column
    if value.kind == NUMBER:
        return value.column.cast("string")
    if value.kind == TRUTH:
        return F.when(value.column, "True").otherwise("False")
    if value.kind == NOTHING:
        return F.lit("")
    raise ValueError("the chat template prints a message or a list, which is not supported")


def merged(condition: Column, value: Value, other: Value) -> Value:
    if value.kind == other.kind == NOTHING:
        return value
    if value.kind != other.kind:  # what is not set counts as empty text
        value, other = Value(TEXT, shown(value)), Value(TEXT, shown(other))
    return Value(value.kind, F.when(condition, value.column).otherwise(other.column))


def joined(texts: list[Column]) -> Column:
    return F.concat(*texts) if texts else F.lit("")


class _Reader:
    """The parts of a template, block by block."""

    def __init__(self, source: str) -> None:
        self.parts, self.at = _split(source), 0

    def block(self, names: dict[str, Value], *ends: str) -> tuple[Column, dict[str, Value], str]:
        """Text of the parts up to a closing tag, the names after it and the tag."""
        texts: list[Column] = []
        while self.at < len(self.parts):
            kind, text = self.parts[self.at]
            self.at += 1
            if kind == "text":
                texts.append(F.lit(text))
            elif kind == "value":
                texts.append(shown(_Expression(text, names).whole()))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return joined(texts), names, text
                if word == "for":
                    texts.append(self.loop(rest, names))
                elif word == "if":
                    shown_text, names = self.branch(rest, names)
                    texts.append(shown_text)
                elif word == "set" and (found := re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)):
                    names = {**names, found[1]: _Expression(found[2], names).whole()}
                else:
                    raise ValueError(f"the chat template uses the tag {text!r}, which is not supported here")
        if ends:
            raise ValueError(f"the chat template ends before {' or '.join(ends)}")
        return joined(texts), names, ""

    def branch(self, condition: str, names: dict[str, Value]) -> tuple[Column, dict[str, Value]]:
        chosen = truth(_Expression(condition, names).whole())
        yes, yes_names, end = self.block(names, "elif", "else", "endif")
        no, no_names = F.lit(""), names
        if end.startswith("elif"):
            no, no_names = self.branch(end[4:], names)
        elif end == "else":
            no, no_names, end = self.block(names, "endif")
        after = dict(names)
        for name in [*yes_names, *no_names]:
            a, b = (n.get(name, Value(NOTHING)) for n in (yes_names, no_names))
            after[name] = a if a is b else merged(chosen, a, b)
        return F.when(chosen, yes).otherwise(no), after

    def loop(self, head: str, names: dict[str, Value]) -> Column:
        found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", head, re.S)
        over = _Expression(found[2], names).whole() if found else Value(NOTHING)
        if over.kind != LIST:
            raise ValueError(f"the chat template loops over {head!r}, which is not supported")
        start = self.at

        def body(message: Column, place: Column) -> Column:
            self.at = start
            inner = {
                **names,
                found[1]: Value(MESSAGE, message),
                "loop": Value(NOTHING),
                "loop.index0": Value(NUMBER, place),
                "loop.index": Value(NUMBER, place + 1),
                "loop.first": Value(TRUTH, place == 0),
                "loop.last": Value(TRUTH, place == F.size(over.column) - 1),
            }
            return self.block(inner, "endfor")[0]

        return F.array_join(F.transform(over.column, body), "")


def render_text(template: str, messages: Column) -> Column:
    """The training text that the template makes of a list of messages with role and content."""
    names = {"messages": Value(LIST, messages), "add_generation_prompt": Value(TRUTH, F.lit(False))}
    names |= {name: Value(TEXT, F.lit(token)) for name, token in SPECIAL.items()}
    return _Reader(template).block(names)[0]
