"""The line grammar of translation registries: read and write."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: Kinds of variables (fixed values).
KINDS = ("cat", "date", "mun", "uf", "num", "txt", "code", "id", "flag", "unknown")
SCHEMA = "scope string, variable string, kind string, label string, value_map map<string,string>, rules array<string>, aliases array<string>, sources array<string>, pos int"


@dataclass
class Entry:
    scope: str
    variable: str
    kind: str
    label: str
    value_map: dict[str, str] = field(default_factory=dict)
    rules: list[str] = field(default_factory=list)
    aliases: list[str] = field(default_factory=list)
    sources: list[str] = field(default_factory=list)


class GrammarError(ValueError):
    pass


def parse(text: str) -> list[Entry]:
    """``$ VAR KIND LABEL`` or ``@ SCOPE VAR KIND LABEL`` opens an entry; ``= RAW LABEL``, ``> rules``, ``~ aliases``, ``% sources`` add to it; ``#`` comments."""
    out: list[Entry] = []
    for number, line in enumerate(map(str.strip, text.splitlines()), 1):
        if not line or line[0] == "#":
            continue
        mark, body = line[0], line[1:].strip()
        if mark in "$@":
            words = body.split(maxsplit=2 + (mark == "@"))
            if len(words) != 3 + (mark == "@"):
                raise GrammarError(f"line {number}: an entry needs a {'scope, ' * (mark == '@')}variable, kind and label")
            out.append(Entry(*(["GLOBAL"] * (mark == "$") + words)))
        elif mark not in "=>~%":
            raise GrammarError(f"line {number}: unknown mark {mark!r}")
        elif not out:
            raise GrammarError(f"line {number}: nothing to add this to")
        elif mark == "=":
            raw, _, label = body.partition(" ")
            if not label.strip():
                raise GrammarError(f"line {number}: a value needs a label")
            out[-1].value_map[raw] = label.strip()
        else:
            {">": out[-1].rules, "~": out[-1].aliases, "%": out[-1].sources}[mark].extend(body.split())
    return out


def emit(entries: list[Entry]) -> str:
    """Text that ``parse`` reads back, by scope and variable."""
    blocks = []
    for e in sorted(entries, key=lambda e: (e.scope.upper(), e.variable.upper())):
        head = f"$ {e.variable}" if e.scope.upper() == "GLOBAL" else f"@ {e.scope} {e.variable}"
        lines = [f"{head} {e.kind} {e.label}"]
        lines += [f"{mark} {' '.join(words)}" for mark, words in (("~", e.aliases), (">", e.rules), ("%", e.sources)) if words]
        lines += [f"= {raw} {label}" for raw, label in sorted(e.value_map.items())]
        blocks.append("\n".join(lines))
    return "\n\n".join(blocks) + "\n" * bool(blocks)


def registry(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    rows = [(e.scope, e.variable, e.kind, e.label, e.value_map, e.rules, e.aliases, e.sources, i) for i, e in enumerate(entries)]
    return spark.createDataFrame(rows, SCHEMA)
