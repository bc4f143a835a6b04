"""Two small boolean languages over a table's metadata, compiled to columns.

Where: ``N6 >= 10 AND (CLASS ~ "sex" OR NOT N3)``. Coverage: the same without ``~``;
there tokens may also be parted by white space only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import normalize_basic

_TOKEN = re.compile(r'\s*(?:(?P<paren>[()])|(?P<op>>=|<=|==|!=|[<>=~])|"(?P<text>(?:\\.|[^"\\])*)"|(?P<number>\d+)|(?P<name>[^\W\d]\w*))')
_OPS = {">=": Column.__ge__, ">": Column.__gt__, "<=": Column.__le__, "<": Column.__lt__, "==": Column.__eq__, "!=": Column.__ne__}
FIELDS = ("TITLE", "SURVEY", "SUBJECT", "VAR", "CLASS", "CAT")


@dataclass(frozen=True)
class Level:
    name: str
    op: str = ">="
    number: int = 1


@dataclass(frozen=True)
class Holds:
    field: str
    text: str


@dataclass(frozen=True)
class Not:
    of: object


@dataclass(frozen=True)
class Both:
    left: object
    right: object


@dataclass(frozen=True)
class Either:
    left: object
    right: object


def _lex(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise SyntaxError(f"unexpected {text[at:].strip()[:1]!r} at {at}")
        kind = m.lastgroup
        value = m[kind]
        if kind == "name":
            value = value.upper()
            kind = value if value in ("AND", "OR", "NOT") else kind
        out.append((kind, re.sub(r"\\(.)", r"\1", value) if kind == "text" else value))
        at = m.end()
    return [*out, ("end", "")]


def parse(text: str, texts: bool = True) -> object:
    """OR binds weakest, then AND, then NOT; a bare level means one or more; keywords in either case."""
    tokens = _lex(text)
    at = 0

    def take(*kinds: str) -> str:
        nonlocal at
        kind, value = tokens[at]
        if kind not in kinds:
            raise SyntaxError(f"expected {' or '.join(kinds)}, found {kind} {value!r}")
        at += 1
        return value

    def chain(word: str, node: type, lower) -> object:
        left = lower()
        while tokens[at][0] == word:
            take(word)
            left = node(left, lower())
        return left

    def unit() -> object:
        if tokens[at][0] == "NOT":
            take("NOT")
            return Not(unit())
        if tokens[at] == ("paren", "("):
            take("paren")
            inner = whole()
            if take("paren") != ")":
                raise SyntaxError("expected )")
            return inner
        name = take("name")
        if tokens[at][0] != "op":
            return Level(name)
        op = take("op")
        if op == "~":
            if not texts:
                raise SyntaxError("~ has no meaning here")
            return Holds(name, take("text"))
        return Level(name, "==" if op == "=" else op, int(take("number")))

    def whole() -> object:
        return chain("OR", Either, lambda: chain("AND", Both, unit))

    node = whole()
    take("end")
    return node


def levels(node: object) -> set[str]:
    if isinstance(node, Level):
        return {node.name}
    if isinstance(node, Not):
        return levels(node.of)
    return levels(node.left) | levels(node.right) if isinstance(node, Both | Either) else set()


def compile_node(node: object, counts: Column, fields: dict[str, Column]) -> tuple[Column, Column]:
    """(truth, reasons): the atoms that hold among those that a left-to-right evaluation reaches.

    ``counts`` is a map from level to number, a level without one counts 0; ``fields`` maps
    a name to an array of normalised texts, an unknown name holds nothing.
    """
    none = F.array().cast("array<string>")
    if isinstance(node, Level):
        truth = _OPS[node.op](F.coalesce(F.try_element_at(counts, F.lit(node.name)), F.lit(0)), F.lit(node.number))
        return truth, F.when(truth, F.array(F.lit(f"{node.name}{node.op}{node.number}"))).otherwise(none)
    if isinstance(node, Holds):
        if node.field.upper() not in fields:
            return F.lit(False), none
        needle = normalize_basic(F.lit(node.text))
        truth = F.coalesce(F.exists(fields[node.field.upper()], lambda item: item.contains(needle)), F.lit(False))
        return truth, F.when(truth, F.array(F.lit(f"{node.field.upper()}~{node.text}"))).otherwise(none)
    if isinstance(node, Not):
        truth, why = compile_node(node.of, counts, fields)
        return ~truth, why
    (left, first), (right, second) = compile_node(node.left, counts, fields), compile_node(node.right, counts, fields)
    if isinstance(node, Both):
        return left & right, F.when(left, F.concat(first, second)).otherwise(first)
    return left | right, F.when(left, first).otherwise(F.concat(first, second))
