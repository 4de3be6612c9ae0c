"""Chat formatting with a compiler for a small sandboxed template language.

A template is parsed into a syntax tree, constants are folded, and the tree becomes
Python closures that render a conversation and note which characters lie in
generation blocks. The language has

    text, {# comments #}
    {{ expression }}
    {% for name in expression %} ... {% endfor %}      (with loop.first, loop.last, loop.index)
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}

Expressions: strings, integers, true, false, names, name.field, ==, !=, and, or, not,
+ (joins texts, adds numbers), parentheses, and the filters of FILTERS after a bar.
There are no calls, subscripts or assignments; names are those of the rendered
conversation and loops, fields those of its dictionaries. So a template can neither
reach Python objects nor run longer than its text times the turns of nested loops.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Strings with a meaning for this or other templates; inside texts and roles a backslash breaks them up.
CONTROL = ("<|", "</s>", "<s>", "[/INST]", "[INST]", "<</SYS>>", "<<SYS>>")

TEMPLATE = """{# every turn between markers; what an assistant says is learned #}{% for m in messages %}<|turn|>{{ m.role | name }}<|says|>{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}<|done|>
{% endfor %}"""

_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))


def escape(text: str) -> str:
    """No control string is left, and unescape() gives the text back."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "name": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template is not in the language."""


# ---- syntax tree


@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str
    fields: tuple[str, ...]


@dataclass
class Apply:
    """An operator (==, !=, and, or, not, +) or a filter, on one or two expressions."""

    op: str
    args: list[Any]


@dataclass
class Text:
    text: str


@dataclass
class Show:
    value: Any


@dataclass
class Loop:
    name: str
    values: Any
    body: list[Any]


@dataclass
class Choice:
    branches: list[tuple[Any, list[Any]]]  # the last condition may be Const(True)


@dataclass
class Generation:
    body: list[Any]


_PART = re.compile(r"\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+.()|]))", re.DOTALL)
_ESCAPED = {"n": "\n", "t": "\t"}


@dataclass
class _Expression:
    """Parser by descent: or, and, not, comparison, sum, filters, atom."""

    source: str
    tokens: list[str] = field(default_factory=list)
    depth: int = 0

    def parse(self) -> Any:
        at, source = 0, self.source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected character in {source!r}")
            self.tokens.append(m[0].strip())
            at = m.end()
        out = self._or()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0]!r} in {source!r}")
        return out

    def _take(self, *wanted: str) -> str | None:
        return self.tokens.pop(0) if self.tokens and self.tokens[0] in wanted else None

    def _or(self) -> Any:
        self.depth += 1
        if self.depth > 50:
            raise TemplateError("nested too deep")
        left = self._and()
        while self._take("or"):
            left = Apply("or", [left, self._and()])
        self.depth -= 1
        return left

    def _and(self) -> Any:
        left = self._not()
        while self._take("and"):
            left = Apply("and", [left, self._not()])
        return left

    def _not(self) -> Any:
        negations = 0
        while self._take("not"):
            negations += 1
        out = self._compared()
        for _ in range(negations):
            out = Apply("not", [out])
        return out

    def _compared(self) -> Any:
        left = self._sum()
        if op := self._take("==", "!="):
            return Apply(op, [left, self._sum()])
        return left

    def _sum(self) -> Any:
        left = self._filtered()
        while self._take("+"):
            left = Apply("+", [left, self._filtered()])
        return left

    def _filtered(self) -> Any:
        out = self._atom()
        while self._take("|"):
            name = self.tokens.pop(0) if self.tokens else ""
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Apply(f"|{name}", [out])
        return out

    def _atom(self) -> Any:
        if not self.tokens:
            raise TemplateError(f"{self.source!r} ends too early")
        token = self.tokens.pop(0)
        if token == "(":
            out = self._or()
            if not self._take(")"):
                raise TemplateError(f"a bracket stays open in {self.source!r}")
            return out
        if token[0] in "'\"":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPED.get(m[1], m[1]), token[1:-1], flags=re.DOTALL))
        if token.isdigit():
            return Const(int(token))
        if token in ("true", "false"):
            return Const(token == "true")
        if not re.fullmatch(r"[A-Za-z]\w*", token):
            raise TemplateError(f"unexpected {token!r} in {self.source!r}")
        fields = []
        while self._take("."):
            name = self.tokens.pop(0) if self.tokens else ""
            if not re.fullmatch(r"[A-Za-z]\w*", name):
                raise TemplateError(f"no field {name!r}")
            fields.append(name)
        return Name(token, tuple(fields))


def parse(template: str) -> list[Any]:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in _PART.finditer(template):
        parts += [template[at : m.start()], m[0]]
        at = m.end()
    parts.append(template[at:])
    tree, rest = _body([p for p in parts if p and not p.startswith("{#")], ())
    if rest:
        raise TemplateError(f"unexpected {rest[0]!r}")
    return tree


def _body(parts: list[str], ends: tuple[str, ...]) -> tuple[list[Any], list[str]]:
    """Nodes up to a statement that begins with one of the given words, and what is left from there."""
    nodes: list[Any] = []
    while parts:
        part = parts[0]
        if part.startswith("{{"):
            nodes.append(Show(_Expression(part[2:-2]).parse()))
            parts = parts[1:]
        elif part.startswith("{%"):
            word, _, more = part[2:-2].strip().partition(" ")
            if word in ends:
                return nodes, parts
            node, parts = _statement(word, more, parts[1:])
            nodes.append(node)
        else:
            nodes.append(Text(part))
            parts = parts[1:]
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return nodes, []


def _statement(word: str, more: str, parts: list[str]) -> tuple[Any, list[str]]:
    if word == "for":
        m = re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.+)", more, re.DOTALL)
        if not m:
            raise TemplateError(f"for {more!r}")
        body, parts = _body(parts, ("endfor",))
        return Loop(m[1], _Expression(m[2]).parse(), body), parts[1:]
    if word == "generation":
        body, parts = _body(parts, ("endgeneration",))
        return Generation(body), parts[1:]
    if word == "if":
        branches, condition = [], _Expression(more).parse()
        while True:
            body, parts = _body(parts, ("elif", "else", "endif"))
            branches.append((condition, body))
            word, _, more = parts[0][2:-2].strip().partition(" ")
            parts = parts[1:]
            if word == "endif":
                return Choice(branches), parts
            condition = Const(True) if word == "else" else _Expression(more).parse()
    raise TemplateError(f"no statement {word!r}")


# ---- folding


def _operate(op: str, *args: Any) -> Any:
    if op == "==":
        return args[0] == args[1]
    if op == "!=":
        return args[0] != args[1]
    if op == "+":
        return args[0] + args[1] if all(type(x) is int for x in args) else _shown(args[0]) + _shown(args[1])
    if op == "not":
        return not args[0]
    return FILTERS[op[1:]](_shown(args[0]))


def _shown(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError("only texts and numbers can be shown")


def fold(node: Any) -> Any:
    """The same expression with constant parts worked out."""
    if not isinstance(node, Apply):
        return node
    args = [fold(a) for a in node.args]
    if node.op in ("and", "or") and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
    if node.op not in ("and", "or") and all(isinstance(a, Const) for a in args):
        return Const(_operate(node.op, *(a.value for a in args)))
    return Apply(node.op, args)


def fold_body(nodes: list[Any]) -> list[Any]:
    """The same nodes with constants shown as text, choices among constants made, and texts joined."""
    out: list[Any] = []
    for node in nodes:
        new: list[Any] = []
        if isinstance(node, Show):
            value = fold(node.value)
            new = [Text(_shown(value.value))] if isinstance(value, Const) else [Show(value)]
        elif isinstance(node, Choice):
            branches = []
            for condition, body in node.branches:
                condition = fold(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold_body(body)))
                if isinstance(condition, Const):
                    break
            new = branches[0][1] if branches and isinstance(branches[0][0], Const) else [Choice(branches)] if branches else []
        elif isinstance(node, Loop):
            new = [Loop(node.name, fold(node.values), fold_body(node.body))]
        elif isinstance(node, Generation):
            new = [Generation(fold_body(node.body))]
        else:
            new = [node]
        for x in new:
            if isinstance(x, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + x.text)
            elif not isinstance(x, Text) or x.text:
                out.append(x)
    return out


# ---- closures


def _value(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):

        def look(scope: dict, name: str = node.name, fields: tuple = node.fields) -> Any:
            value = scope.get(name)
            for f in fields:
                value = value.get(f) if type(value) is dict else None
            return value

        return look
    args = [_value(a) for a in node.args]
    if node.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    return lambda scope, op=node.op: _operate(op, *(a(scope) for a in args))


Emit = Callable[[dict, list, bool], None]


def _emit(nodes: list[Any]) -> Emit:
    """A closure that appends (text, whether it is generated) for a scope."""
    steps: list[Emit] = []
    for node in nodes:
        if isinstance(node, Text):
            steps.append(lambda scope, out, learned, t=node.text: out.append((t, learned)))
        elif isinstance(node, Show):
            steps.append(lambda scope, out, learned, v=_value(node.value): out.append((_shown(v(scope)), learned)))
        elif isinstance(node, Generation):
            steps.append(lambda scope, out, learned, body=_emit(node.body): body(scope, out, True))
        elif isinstance(node, Choice):
            branches = [(_value(c), _emit(b)) for c, b in node.branches]

            def choose(scope: dict, out: list, learned: bool, branches: list = branches) -> None:
                for condition, body in branches:
                    if condition(scope):
                        return body(scope, out, learned)

            steps.append(choose)
        else:

            def loop(scope: dict, out: list, learned: bool, name: str = node.name, values: Callable = _value(node.values), body: Emit = _emit(node.body)) -> None:
                items = values(scope)
                items = items if type(items) is list else []
                for k, item in enumerate(items):
                    body({**scope, name: item, "loop": {"index": k + 1, "first": k == 0, "last": k == len(items) - 1}}, out, learned)

            steps.append(loop)

    def run(scope: dict, out: list, learned: bool) -> None:
        for step in steps:
            step(scope, out, learned)

    return run


def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages (dictionaries of role and text) to the formatted conversation and the spans, first and
    end in code points, of what generation blocks showed (spans that meet stay apart; empty ones are kept)."""
    run = _emit(fold_body(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out: list[tuple[str, bool]] = []
        run({"messages": messages}, out, False)
        spans, at = [], 0
        for text, learned in out:
            if learned:
                spans.append((at, at + len(text)))
            at += len(text)
        return "".join(t for t, _ in out), spans

    return render


_TURN = re.compile(r"<\|turn\|>(.*?)<\|says\|>(.*?)<\|done\|>\n", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a conversation that TEMPLATE formatted."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


# ---- Spark


def grouped(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns as an array of (turn, role, text), in order of turn, then role, then text.

    Null roles and texts are empty; null turns come first; repeated rows stay; rows without conv_id are one
    conversation.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, formatted, and spans (first and end of what is learned) of every conversation; no rows give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                done = [render([{"role": x["role"], "text": x["text"]} for x in turns]) for turns in part.column("turns").to_pylist()]
                spans = [[{"first": x, "end": y} for x, y in spans] for _, spans in done]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array([t for t, _ in done], pa.string()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
                    names=["conv_id", "formatted", "spans"],
                )

    turns = grouped(conversations)
    kinds = T._parse_datatype_string("formatted string, spans array<struct<first:bigint,end:bigint>>").fields
    return turns.mapInArrow(run, T.StructType([turns.schema["conv_id"], *kinds]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, formatted, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans")), strict=True):
            turns = read_back(formatted)
            learned = "".join(unescape(formatted[s["first"] : s["end"]]) for s in spans)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append(
                {
                    "conv_id": conv_id,
                    "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(),
                    "loss_chars": len(learned),
                    "loss_sha256": hashlib.sha256(learned.encode("utf-8", "surrogatepass")).hexdigest(),
                    "formatted_chars": len(formatted),
                }
            )
        if rows:
            kinds = [("conv_id", batch.schema.field("conv_id").type)] + [(k, pa.int64() if k.startswith("n_") or k.endswith("chars") else pa.string()) for k in list(rows[0])[1:]]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def conversation_report(conversations: DataFrame) -> DataFrame:
    """What can be read back from the formatted text of every conversation: digests of turns and of what is learned.

    Null roles and texts are empty; a null turn comes first; repeated rows are turns of their own, ties go by role and
    text; rows without conv_id are one conversation; texts of any length are whole; other columns are left out; no
    rows, none.
    """
    formatted = format_conversations(conversations)
    kinds = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.mapInArrow(_digests, T.StructType([formatted.schema["conv_id"], *T._parse_datatype_string(kinds).fields]))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations' rows, and conversation -1, whose texts are full of control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text").unionByName(probe)
