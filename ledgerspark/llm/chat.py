"""Chat formatting with a template compiler.

A template is parsed into a syntax tree, constant expressions and neighbouring text are folded, and the tree becomes
nested Python closures that append to one output. The language is closed: names, keys of messages, comparisons,
and/or/not, +, three filters, if, for and generation. There are no calls, no attributes of Python objects and no way to
loop but over a list that was given, so a template always ends.

generation marks what a model is trained on: the closures note where it starts and ends, in code points.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Strings that a template may write and texts must not: escape() breaks them up.
CONTROL = ["<s>", "</s>", *(f"[{slash}{name}]" for name in ("INST", "GEN", "SYS", "ROLE", "TURN") for slash in ("", "/"))]
#: The template of the query. Every turn starts with <s>; its texts hold no control string once escaped.
TEMPLATE = """{% for m in messages %}<s>{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]
{%- elif m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]
{%- elif m.role == 'assistant' %}[GEN] {% generation %}{{ m.text | escape }}{% endgeneration %} [/GEN]</s>
{%- else %}[ROLE] {{ m.role | escape }} [/ROLE][TURN] {{ m.text | escape }} [/TURN]{% endif %}{% endfor %}"""

_ESCAPED = re.compile("|".join(map(re.escape, ["\\", *CONTROL])))


def escape(text: str) -> str:
    """Double every backslash and put one after the first character of every control string."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


class TemplateError(ValueError):
    pass


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper}
_TAG = re.compile(r"\{%(-?)\s*(.*?)\s*(-?)%\}|\{\{\s*(.*?)\s*\}\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[()|.+]))")


# ---- syntax tree -------------------------------------------------------------------------------------------------
@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Key:
    of: Any
    key: str


@dataclass
class Apply:
    """An operation on its arguments; pure, so constant arguments make a constant."""

    name: str
    args: list


@dataclass
class If:
    branches: list[tuple[Any, list]]
    otherwise: list


@dataclass
class For:
    name: str
    over: Any
    body: list


@dataclass
class Generation:
    body: list


def _text(x: Any) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: _text(a) + _text(b), "not": lambda a: not a,
    **{f"|{name}": (lambda f: lambda a: f(_text(a)))(f) for name, f in FILTERS.items()},
}


class _Expression:
    """Recursive descent: or < and < not < comparison < + < filter < value."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append(m.group(m.lastindex) if m.lastindex != 1 else ("text", re.sub(r"\\(.)", r"\1", m[1][1:-1])))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self, *allowed):
        if (token := self.peek()) in allowed:
            self.at += 1
            return token
        return None

    def whole(self):
        tree = self.either()
        if self.peek() is not None:
            raise TemplateError(f"unexpected {self.peek()!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = Apply("or", [tree, self.both()])
        return tree

    def both(self):
        tree = self.negated()
        while self.take("and"):
            tree = Apply("and", [tree, self.negated()])
        return tree

    def negated(self):
        return Apply("not", [self.negated()]) if self.take("not") else self.compared()

    def compared(self):
        tree = self.added()
        if op := self.take("==", "!="):
            tree = Apply(op, [tree, self.added()])
        return tree

    def added(self):
        tree = self.filtered()
        while self.take("+"):
            tree = Apply("+", [tree, self.filtered()])
        return tree

    def filtered(self):
        tree = self.value()
        while self.take("|"):
            name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = Apply(f"|{name}", [tree])
        return tree

    def value(self):
        token = self.peek()
        self.at += 1
        if isinstance(token, tuple):
            return Const(token[1])
        if token == "(":
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        if token is None or not re.match(r"\w", token):
            raise TemplateError(f"unexpected {token!r}")
        if token.isdigit():
            return Const(int(token))
        tree = Const({"true": True, "false": False, "none": None}[token]) if token in ("true", "false", "none") else Name(token)
        while self.take("."):
            key = self.peek()
            self.at += 1
            if not isinstance(key, str) or not re.match(r"[A-Za-z]\w*$", key):
                raise TemplateError(f"bad key {key!r}")
            tree = Key(tree, key)
        return tree


def parse(template: str) -> list:
    """The template's syntax tree. A minus sign inside a tag strips white space on its side."""
    parts, at, strip = [], 0, False
    for m in _TAG.finditer(template):
        text = template[at : m.start()]
        text = text.lstrip() if strip else text
        parts.append(("text", text.rstrip() if m[1] else text))
        if m[2] is not None:
            parts.append(("tag", m[2]))
        elif m[4] is not None:
            parts.append(("value", m[4]))
        at, strip = m.end(), bool(m[3])
    parts.append(("text", template[at:].lstrip() if strip else template[at:]))
    parts.reverse()

    def body(*ends: str) -> tuple[list, str]:
        out = []
        while parts:
            kind, source = parts.pop()
            word = source.split(" ", 1)[0]
            if kind == "text":
                out.append(Const(source))
            elif kind == "value":
                out.append(_Expression(source).whole())
            elif word in ends:
                return out, source
            elif word == "if":
                branches, test = [], source[2:]
                otherwise: list = []
                while True:
                    inner, end = body("elif", "else", "endif")
                    branches.append((_Expression(test).whole(), inner))
                    if end == "else":
                        otherwise, _ = body("endif")
                    if end in ("else", "endif"):
                        break
                    test = end[4:]
                out.append(If(branches, otherwise))
            elif m := re.fullmatch(r"for (\w+) in (.+)", source):
                out.append(For(m[1], _Expression(m[2]).whole(), body("endfor")[0]))
            elif word == "generation":
                out.append(Generation(body("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected tag {source!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return out, ""

    return body()[0]


def fold(node: Any) -> Any:
    """Constant expressions evaluated, dead branches cut, neighbouring text joined."""
    if isinstance(node, list):
        out: list = []
        for x in map(fold, node):
            for y in x if isinstance(x, list) else [x]:
                if isinstance(y, Const) and out and isinstance(out[-1], Const):
                    out[-1] = Const(_text(out[-1].value) + _text(y.value))
                elif not (isinstance(y, Const) and _text(y.value) == ""):
                    out.append(y)
        return out
    if isinstance(node, Apply):
        args = list(map(fold, node.args))
        if node.name in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
        if node.name in OPERATIONS and all(isinstance(a, Const) for a in args):
            return Const(OPERATIONS[node.name](*(a.value for a in args)))
        return Apply(node.name, args)
    if isinstance(node, Key):
        return Key(fold(node.of), node.key)
    if isinstance(node, If):
        branches = []
        for test, inner in node.branches:
            test = fold(test)
            if isinstance(test, Const):
                if not test.value:
                    continue
                return fold(inner) if not branches else If(branches, fold(inner))
            branches.append((test, fold(inner)))
        return If(branches, fold(node.otherwise)) if branches else fold(node.otherwise)
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


# ---- closures ----------------------------------------------------------------------------------------------------
@dataclass
class Output:
    pieces: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _expression(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda names: node.value
    if isinstance(node, Name):
        def name(names: dict) -> Any:
            if node.name not in names:
                raise TemplateError(f"no {node.name!r}")
            return names[node.name]

        return name
    if isinstance(node, Key):
        of = _expression(node.of)

        def key(names: dict) -> Any:
            held = of(names)
            if not isinstance(held, dict):
                raise TemplateError(f"no keys to take {node.key!r} from")
            return held.get(node.key)

        return key
    args = [_expression(a) for a in node.args]
    if node.name == "and":
        return lambda names: args[0](names) and args[1](names)
    if node.name == "or":
        return lambda names: args[0](names) or args[1](names)
    operation = OPERATIONS[node.name]
    if len(args) == 1:
        return lambda names: operation(args[0](names))
    return lambda names: operation(args[0](names), args[1](names))


def _statement(node: Any) -> Callable[[dict, Output], None]:
    if isinstance(node, list):
        steps = [_statement(x) for x in node]

        def run(names: dict, out: Output) -> None:
            for step in steps:
                step(names, out)

        return run
    if isinstance(node, If):
        branches = [(_expression(test), _statement(inner)) for test, inner in node.branches]
        otherwise = _statement(node.otherwise)

        def choose(names: dict, out: Output) -> None:
            for test, inner in branches:
                if test(names):
                    return inner(names, out)
            return otherwise(names, out)

        return choose
    if isinstance(node, For):
        over, inner = _expression(node.over), _statement(node.body)

        def loop(names: dict, out: Output) -> None:
            items = over(names)
            if not isinstance(items, list):
                raise TemplateError("for needs a list")
            for i, item in enumerate(items):
                about = {"first": i == 0, "last": i == len(items) - 1, "index": i + 1}
                inner({**names, node.name: item, "loop": about}, out)

        return loop
    if isinstance(node, Generation):
        inner = _statement(node.body)

        def generation(names: dict, out: Output) -> None:
            start = out.length
            inner(names, out)
            out.spans.append((start, out.length))

        return generation
    value = _expression(node)
    return lambda names, out: out.write(_text(value(names)))


def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages to the formatted text and the spans under the loss mask."""
    run = _statement(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run({"messages": messages}, out)
        return "".join(out.pieces), out.spans

    return render


# ---- on Spark ----------------------------------------------------------------------------------------------------
def _render(batches: Iterator[pa.RecordBatch], template: str) -> Iterator[pa.RecordBatch]:
    render = compile_template(template)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        done = [render(turns.as_py()) for turns in batch.column(1)]
        spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t for t, _ in done], pa.string()), pa.array(spans, spans_type)],
            names=["conv_id", "formatted", "spans"],
        )


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, spans array<struct<start,end>>) per conversation of turns (conv_id, turn, role, text).

    Rows are ordered by turn, ties by role and text; a null turn comes first. A null role or text is empty; rows with a null conv_id are one
    conversation. Repeated rows are turns of their own. Further columns are ignored; an empty table stays empty.
    A conversation is one text, so its rows meet in one task; nothing else is gathered.
    """
    compile_template(template)  # a bad template fails here, not in a task
    text, role = (F.coalesce(c, F.lit("")).alias(c) for c in ("text", "role"))
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", role, text))).alias("turns"))
    # array_sort puts nulls of a struct's field first
    return gathered.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
    ).mapInArrow(partial(_render, template=template), "conv_id bigint, formatted string, spans array<struct<start:int,end:int>>")


_TURN = re.compile(
    r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|\[SYS\] (?P<system>.*?) \[/SYS\]|\[GEN\] (?P<assistant>.*?) \[/GEN\]</s>"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\]\[TURN\] (?P<text>.*?) \[/TURN\])", re.S,
)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn that TEMPLATE wrote."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        if m["role"] is not None:
            turns.append((unescape(m["role"]), unescape(m["text"])))
        else:
            role = m.lastgroup
            turns.append((role, unescape(m[role])))
        at = m.end()
    return turns


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        formatted = batch.column(1).to_pylist()
        turns = [[{"role": r, "text": t} for r, t in read_turns(f)] for f in formatted]
        loss = [[unescape(f[s["start"] : s["end"]]) for s in spans] for f, spans in zip(formatted, batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(loss, pa.list_(pa.string()))],
            names=["conv_id", "formatted", "turns", "loss"],
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss): the turns and the texts under the loss mask, as the output of TEMPLATE has them."""
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(
        _read, "conv_id bigint, formatted string, turns array<struct<role:string,text:string>>, loss array<string>"
    )


def chat_digests(turns: DataFrame) -> DataFrame:
    back = read_back(format_conversations(turns))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(F.concat_ws("", "loss")).cast("bigint").alias("loss_chars"), F.sha2(F.concat_ws("", "loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
