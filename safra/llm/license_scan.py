"""License scanning by template markup compiled to token automata.

A template is wording with marked regions: ``<<beginOptional>> ... <<endOptional>>``
may be absent, ``<<var;most=N>>`` stands for up to N words of any kind. It is compiled
once into an automaton over words; a text has the license where the automaton accepts,
that is where all mandatory wording stands in order, word for word. The longest mandatory
run of a template is searched first, so automata run only where it occurs.

A license's own label (``mit``, ``isc``, ``bsd-2-clause``, ``bsd-3-clause``) takes its whole
wording, conditions and warranty text included. Labels in ``-grant`` and ``-notice`` say no
more than that the sentence of that kind stands there. Apache and the GPL have only such labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_text, byte_slices, read_table

#: Phrases and their labels (fixed values of the contract).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "<<beginOptional>>the software<<endOptional>> to deal in the software without restriction including without limitation the rights to use "
    "copy modify merge publish distribute sublicense and or sell copies of the software"
)
_BSD_GRANT = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_BSD_CONDITIONS = (
    " <<var;most=1>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "<<var;most=1>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution"
)
_BSD_NAMES = (
    " <<var;most=1>> neither the name of <<var;most=12>> nor the names of <<var;most=12>> contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission"
)
_BSD_WARRANTY = (
    " this software is provided by <<var;most=12>> as is and any express or implied warranties including but not limited to the implied warranties "
    "of merchantability and fitness for a particular purpose are disclaimed in no event shall <<var;most=12>> be liable for any direct indirect "
    "incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use "
    "data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including "
    "negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_ISC_GRANT = "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted"

#: License wording with optional and replaceable regions (fixed texts of public licenses and notices).
TEMPLATES = (
    ("mit-notice", "<<beginOptional>>this work is<<endOptional>> <<var;most=1>> under the mit license"),
    ("mit-grant", _MIT_GRANT),
    (
        "mit",
        _MIT_GRANT + " and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all "
        "copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<var;most=12>> be "
        "liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
        "the software or the use or other dealings in the software",
    ),
    ("apache-notice", "<<beginOptional>>this work is<<endOptional>> licensed under the apache license <<beginOptional>>version<<endOptional>> 2 0"),
    ("gpl-notice", "<<beginOptional>>this work is<<endOptional>> licensed under the gnu general public license <<beginOptional>>version <<var;most=2>><<endOptional>>"),
    ("gpl-grant", "you can redistribute it and or modify it under the terms of the gnu <<beginOptional>>lesser<<endOptional>> general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by nc <<var;most=2>>"),
    ("cc-by-sa", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by sa <<var;most=2>>"),
    ("bsd-grant", _BSD_GRANT),
    ("bsd-2-clause", _BSD_GRANT + _BSD_CONDITIONS + _BSD_WARRANTY),
    ("bsd-3-clause", _BSD_GRANT + _BSD_CONDITIONS + _BSD_NAMES + _BSD_WARRANTY),
    ("isc-grant", _ISC_GRANT),
    (
        "isc",
        _ISC_GRANT + " provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and "
        "<<var;most=12>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no "
        "event shall <<var;most=12>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss "
        "of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    ("copyright", "copyright <<beginOptional>>c<<endOptional>> <<var;most=8>> all rights reserved"),
)

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32 for b in range(256)
)
_MARK = re.compile(r"<<(beginOptional|endOptional|var;most=(\d+))>>|([^<\s]+)")


@dataclass(frozen=True)
class Automaton:
    """``step[s]`` maps a word to the next state, ``wild[s]`` is the next state on any word (or -1), ``skip[s]`` the states reached without a word."""

    label: str
    step: tuple[tuple[bytes, int], ...]
    wild: tuple[int, ...]
    skip: tuple[tuple[int, ...], ...]
    anchor: bytes
    anchor_words: int
    head: int

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            at = todo.pop()
            for s in self.skip[at] if at < len(self.skip) else ():
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accept(self, words: list[bytes], start: int) -> int:
        """End of the shortest acceptance from ``start``, or -1."""
        final = len(self.step)
        states, at = self.closure({0}), start
        while states:
            if final in states:
                return at
            if at == len(words):
                return -1
            word, to = words[at], set()
            for s in states:
                if self.step[s][0] == word and self.step[s][1] >= 0:
                    to.add(self.step[s][1])
                if self.wild[s] >= 0:
                    to.add(self.wild[s])
            states, at = self.closure(to), at + 1
        return -1


def compile_template(label: str, markup: str) -> Automaton:
    """Each word is a state with one step; a region of N words has N states that any word leaves, and that may be skipped."""
    step: list[tuple[bytes, int]] = []
    wild: list[int] = []
    skip: list[list[int]] = []
    opened: list[int] = []
    runs: list[list[bytes]] = [[]]
    heads: list[int] = [0]
    most_before = 0
    for m in _MARK.finditer(markup):
        if m[3]:
            word = m[3].lower().encode()
            step.append((word, len(step) + 1)), wild.append(-1), skip.append([])
            if not opened:
                if not runs[-1]:
                    heads[-1] = most_before
                runs[-1].append(word)
            most_before += 1
            continue
        if runs[-1]:
            runs.append([]), heads.append(0)
        if m[1] == "beginOptional":
            opened.append(len(step))
            step.append((b"", -1)), wild.append(-1), skip.append([len(step)])
        elif m[1] == "endOptional":
            skip[opened.pop()].append(len(step))
        else:
            end = len(step) + int(m[2])
            for _ in range(int(m[2])):
                step.append((b"", -1)), wild.append(len(step)), skip.append([end])
            most_before += int(m[2])
    best = max(range(len(runs)), key=lambda i: len(runs[i]))
    return Automaton(label, tuple(step), tuple(wild), tuple(tuple(x) for x in skip), b" " + b" ".join(runs[best]) + b" ", len(runs[best]), heads[best])


class Scanner:
    """Phrases and automata together; words are runs of ASCII letters, digits and non-ASCII characters."""

    def __init__(self, phrases: tuple = PHRASES, templates: tuple = TEMPLATES):
        self.phrases = [(b" " + p.encode() + b" ", len(p.split()), label, p.split()[0].encode()) for p, label in phrases]
        self.automata = [compile_template(*t) for t in templates]

    @staticmethod
    def _places(joined: bytes, needle: bytes) -> list[int]:
        """Word numbers at which the needle's words stand."""
        out, at, words, seen = [], joined.find(needle), 0, 0
        while at >= 0:
            words += joined.count(b" ", seen, at)
            seen = at
            out.append(words)
            at = joined.find(needle, at + 1)
        return out

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Number of words; phrase matches and template matches as (first word, end, label)."""
        words = text.translate(_FOLD).split()
        joined = b" " + b" ".join(words) + b" "
        base = [(w, w + n, label) for needle, n, label, _ in self.phrases if needle in joined for w in self._places(joined, needle)]
        found = []
        for auto in self.automata:
            if auto.anchor not in joined:
                continue
            done = -1
            for w in self._places(joined, auto.anchor):
                for start in range(max(0, done, w - auto.head), w + 1):
                    end = auto.accept(words, start)
                    if end > w:
                        found.append((start, end, auto.label))
                        done = end
                        break
        return len(words), base, found


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<start:long,end:long,label:string>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: tuple = PHRASES, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per row: the counts, labels and matches of its whole text.

    ``n_base`` counts every place of every phrase; ``first_word`` and ``last_word`` are the
    smallest and largest start of those, or null; ``labels`` adds the templates' labels.
    ``score`` is the share of the words that some match covers (0 without words).
    ``matches`` lists all as word ranges. Null texts count as empty; repeated rows
    repeat; other columns are ignored.
    """
    scanner = Scanner(phrases, templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in byte_slices(np.array([len(t) for t in texts]), 1 << 22):
                rows = []
                for text in texts[a:b]:
                    n, base, found = scanner.scan(text)
                    starts = [x[0] for x in base]
                    covered = {w for x in (*base, *found) for w in range(x[0], x[1])}
                    labels = sorted({x[2] for x in base})
                    rows.append((n, len(base), min(starts, default=None), max(starts, default=None), ",".join(labels), ",".join(sorted({*labels, *(x[2] for x in found)})), len(covered) / n if n else 0.0, [dict(zip(("start", "end", "label"), x, strict=True)) for x in sorted(base + found)]))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), binary_text(F.col(text_col)).alias("text"))
    return rows.mapInArrow(scan, SCHEMA)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
