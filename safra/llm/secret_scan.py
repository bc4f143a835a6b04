"""Secret scanning by inferred format grammars.

Base patterns find credentials of three kinds. From the values that they match (labelled
credentials, at most ``SAMPLE`` distinct values a kind, those of smallest hash) one
probabilistic automaton a kind is inferred: a prefix tree whose states are merged, in
breadth-first order, when the frequencies of their continuations are statistically
compatible over their whole subtrees (Hoeffding bounds). The tree's symbols are what the
values have in common: a character that most values have at a place, punctuation, or else
the narrowest character set of the whole value, within which the characters have
frequencies of their own. Every candidate of every text, a run of the credential alphabet
of ``SHORTEST`` characters or more, is then scored by the logarithm of its likelihood under
each automaton, its end included, over that under the language of the whole corpus, a model of
character pairs counted over all texts outside the base spans. Candidates above the threshold,
which their length sets, become spans beside those of the base patterns. A run that is none as a
whole is scored in parts, from every boundary (``BOUNDARY``) to every later one, up to ``PART``
characters; of parts that overlap the one of the highest ratio is taken.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_slices, materialize, read_table, text_sizes

KINDS = ("assign", "access", "hex")
#: Base patterns of the contract (fixed values); the second group of the first is the value.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_][A-Za-z0-9+/_.=-]{4,}[A-Za-z0-9+/_=]")

SAMPLE = 500
SHORTEST = 6
#: Visits that a state needs before its continuations are tested, or one of its characters stands for itself.
EVIDENCE = 8
ALPHA = 0.05
#: Weight, in visits, of overall frequencies in those of a state that is compared, and in those after a character of the corpus.
PRIOR, PAIR_PRIOR = 0.5, 64
#: Log-likelihood ratio that a candidate must exceed, in all and for each character.
TOTAL, EACH = 25.0, 1.0
#: Where a part of a run may begin after, or end before; and the characters of a part at most (a whole run has no such bound).
BOUNDARY = frozenset("=/_-.+")
PART = 512
#: Judged runs that a task remembers, and the characters of one at most: 40 MB or so in all.
REMEMBERED, REMEMBERED_LENGTH = 1 << 18, 64
#: Character sets from narrow to wide; a value's is the first that holds all its letters and digits.
SETS = {
    "<digit>": "0123456789",
    "<hex>": "0123456789abcdef",
    "<HEX>": "0123456789ABCDEF",
    "<lower>": "abcdefghijklmnopqrstuvwxyz",
    "<upper>": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "<lower+digit>": "0123456789abcdefghijklmnopqrstuvwxyz",
    "<upper+digit>": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "<letter>": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "<any>": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
}
_SETS = [(name, frozenset(chars)) for name, chars in SETS.items()]
PUNCTUATION = "+/_.=-"
ALPHABET = SETS["<any>"] + PUNCTUATION
_CODE = np.zeros(256, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
_WIDTH = len(ALPHABET) + 1


def character_set(value: str) -> str:
    own = set(value).difference(PUNCTUATION)
    return next(name for name, chars in _SETS if own <= chars)


def symbols(values: dict[str, int]) -> list[tuple[list[str], int]]:
    """Each value as symbols. A character stands for itself at a place where half of the values with the same symbols before it have it."""
    out: list[tuple[list[str], int]] = []
    todo: list[tuple[list[str], list[tuple[str, str, int]]]] = [([], [(v, character_set(v), n) for v, n in sorted(values.items())])]
    while todo:
        before, group = todo.pop()
        at = len(before)
        if len(group) == 1 and group[0][2] < EVIDENCE:
            (v, name, n), = group
            out.append(([*before, *(c if c in PUNCTUATION else name for c in v[at:])], n))
            continue
        out += [(before, n) for v, _, n in group if len(v) == at]
        group = [x for x in group if len(x[0]) > at]
        total = sum(n for _, _, n in group)
        seen: Counter = Counter()
        for v, _, n in group:
            seen[v[at]] += n
        literal = {c for c, n in seen.items() if c in PUNCTUATION or (total >= EVIDENCE and 2 * n >= total)}
        following: dict[str, list[tuple[str, str, int]]] = {}
        for x in group:
            following.setdefault(x[0][at] if x[0][at] in literal else x[1], []).append(x)
        todo += [([*before, c], following[c]) for c in sorted(following)]
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns: leftmost, non-overlapping within a kind."""
    out = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out)


class Automaton:
    """Probabilistic automaton over symbols, inferred by merging prefix-tree states; "" is the end of a value."""

    def __init__(self, words: list[tuple[list[str], int]], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[Counter] = [Counter()]
        for word, n in sorted(words):
            state = 0
            for c in word:
                self.seen[state][c] += n
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.seen.append(Counter())
                state = self.next[state][c]
            self.seen[state][""] += n
        overall: Counter = Counter()
        for x in self.seen:
            overall.update(x)
        self.overall = {c: n / overall.total() for c, n in overall.items()}
        self._merge(alpha)

    def _alike(self, a: int, b: int, alpha: float) -> bool:
        """Hoeffding test of every continuation, then of the states reached, over the whole subtree."""
        todo, met = [(a, b)], set()
        while todo:
            pair = todo.pop()
            if pair in met:
                continue
            met.add(pair)
            a, b = pair
            x, y = self.seen[a], self.seen[b]
            m, n = x.total(), y.total()
            if min(m, n) < EVIDENCE:
                continue
            bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(m) + 1 / math.sqrt(n))
            if any(abs(x[c] / m - y[c] / n) > bound for c in x.keys() | y.keys()):
                return False
            todo += [(s, self.next[b][c]) for c, s in self.next[a].items() if c in self.next[b]]
        return True

    def _fold(self, into: int, state: int) -> None:
        todo = [(into, state)]
        while todo:
            a, b = todo.pop()
            self.seen[a].update(self.seen[b])
            for c, s in self.next[b].items():
                if c in self.next[a]:
                    if self.next[a][c] != s:
                        todo.append((self.next[a][c], s))
                else:
                    self.next[a][c] = s

    def _cost(self, seen: Counter, state: int) -> float:
        """Code length of some continuations at a state."""
        own, n = self.seen[state], self.seen[state].total()
        return -sum(k * math.log((own[c] + PRIOR * self.overall[c]) / (n + PRIOR)) for c, k in seen.items())

    def _merge(self, alpha: float) -> None:
        """Red states are final; each blue one, breadth first, joins the compatible red that tells its continuations best, or turns red.

        A state of too few visits for the test stays as it is, and nothing joins it.
        """
        red, fixed = [0], {0}
        queue = deque((0, c) for c in sorted(self.next[0]))
        while queue:
            parent, c = queue.popleft()
            state = self.next[parent].get(c)
            if state is None or state in fixed:
                continue
            tested = self.seen[state].total() >= EVIDENCE
            alike = [r for r in red if tested and self.seen[r].total() >= EVIDENCE and self._alike(r, state, alpha)]
            if alike:
                r = min(alike, key=lambda r: (self._cost(self.seen[state], r), r))
                self.next[parent][c] = r
                self._fold(r, state)
                queue.extend((r, k) for k, s in sorted(self.next[r].items()) if s not in fixed)
            else:
                red.append(state)
                fixed.add(state)
                queue.extend((state, k) for k in sorted(self.next[state]))
        self._compact(red)

    def _compact(self, red: list[int]) -> None:
        number = {s: i for i, s in enumerate(red)}
        following = [{c: number[s] for c, s in self.next[r].items() if s in number} for r in red]
        self.next, self.seen = following, [self.seen[r] for r in red]
        self.log = [{c: math.log(n / x.total()) for c, n in x.items()} for x in self.seen]


class Format:
    """The automaton of a kind, and the frequencies of characters within each set."""

    def __init__(self, values: dict[str, int]):
        words = symbols(values)
        self.automaton = Automaton(words)
        within: dict[str, Counter] = {}
        for value, n in values.items():
            own = within.setdefault(character_set(value), Counter())
            for c in value:
                own[c] += n
        self.within = {name: {c: math.log((own[c] + 0.5) / (sum(own[x] for x in SETS[name]) + 0.5 * len(SETS[name]))) for c in SETS[name]} for name, own in within.items()}

    def score(self, value: str, name: str) -> float:
        """Log-likelihood of a value and its end, given its character set; minus infinity if the automaton does not accept it."""
        within, log, following = self.within.get(name, {}), self.automaton.log, self.automaton.next
        state, total = 0, 0.0
        for c in value:
            own = following[state]
            if c in own:
                total += log[state][c]
                state = own[c]
            elif name in own and c in within:
                total += log[state][name] + within[c]
                state = own[name]
            else:
                return -math.inf
        return total + log[state].get("", -math.inf)

    def walk(self, run: str, start: int) -> Iterator[tuple[int, float]]:
        """(end, score) of the parts of a run from ``start`` to a boundary or its end that the automaton accepts; it goes no further than one of the sets lets it."""
        log, following = self.automaton.log, self.automaton.next
        for name, within in self.within.items():
            state, total = 0, 0.0
            for i in range(start, min(len(run), start + PART) + 1):
                whole = i == len(run)
                if i - start >= SHORTEST and (whole or run[i] in BOUNDARY) and "" in log[state] and character_set(run[start:i]) == name:
                    yield i, total + log[state][""]
                if whole:
                    break
                c, own = run[i], following[state]
                if c in own:
                    total += log[state][c]
                    state = own[c]
                elif name in own and c in within:
                    total += log[state][name] + within[c]
                    state = own[name]
                else:
                    break


def _pair_counts(texts: list[str]) -> np.ndarray:
    """Counts of the pairs of characters within and at the ends of runs of the credential alphabet."""
    code = _CODE[np.frombuffer(("\n" + "\n".join(texts) + "\n").encode(), np.uint8)]
    return np.bincount(code[:-1] * _WIDTH + code[1:], minlength=_WIDTH * _WIDTH)


def learn(docs: DataFrame, text_col: str, sample: int) -> tuple[list[tuple[int, str]], np.ndarray]:
    """(kind, value) of base matches, of each kind at most ``sample`` distinct values; and pair counts of all texts without the base spans."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(_WIDTH * _WIDTH, np.int64)
        for batch in batches:
            values: Counter = Counter()
            for a, b in byte_slices(text_sizes(batch.column(0)), 1 << 20):
                texts = batch.column(0).slice(a, b - a).to_pylist()
                spans: list[str] = []
                for text in texts:
                    for start, end, k in base_spans(text):
                        values[(k, ASSIGN.match(text, start, end)[2] if k == 0 else text[start:end])] += 1
                        spans.append(text[start:end])
                pairs += _pair_counts(texts)
                pairs -= _pair_counts(spans)
            yield _learnt([k for k, _ in values], [v for _, v in values], list(values.values()))
        at = np.flatnonzero(pairs)
        yield _learnt([-1] * len(at), list(map(str, at.tolist())), pairs[at].tolist())

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(gather, "kind int, value string, n long")
    found = materialize(rows.groupBy("kind", "value").agg(F.sum("n").alias("n")), "labelled")
    values = []
    for k in range(len(KINDS)):
        values += [(k, r.value) for r in found.where(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
    pairs = np.zeros(_WIDTH * _WIDTH)
    told = found.where("kind = -1").select(F.col("value").cast("int").alias("pair"), "n").toArrow()  # _WIDTH squared at most
    pairs[told.column("pair").to_numpy()] = told.column("n").to_numpy()
    return values, np.maximum(pairs, 0).reshape(_WIDTH, _WIDTH)


def _learnt(kind: list[int], value: list[str], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(value, pa.string()), pa.array(n, pa.int64())], ["kind", "value", "n"])


#: Start, end, kind and score of what is taken in a run.
Part = tuple[int, int, int, float]


class Grammar:
    """The formats of the kinds, and the model of character pairs that they compete with."""

    def __init__(self, values: list[tuple[int, str]], pairs: np.ndarray | None = None):
        self.formats: dict[int, Format] = {}
        for k in range(len(KINDS)):
            own = Counter(v for kind, v in values if kind == k)
            if own:
                self.formats[k] = Format(own)
        pairs = np.zeros((_WIDTH, _WIDTH)) if pairs is None else pairs.astype(np.float64)
        single = pairs.sum(0) + 0.5
        pairs = pairs + PAIR_PRIOR * single / single.sum()
        pairs[0, 0] = 0  # between runs
        self.plain = np.log(pairs / pairs.sum(1, keepdims=True), where=pairs > 0, out=np.full_like(pairs, -math.inf))
        #: Runs judged so far, and the parts of those that hold credentials.
        self.judged: set[str] = set()
        self.taken: dict[str, list[Part]] = {}

    def _plain(self, run: str, start: int, end: int) -> float:
        """Log-likelihood of a part of a run as ordinary text, between its neighbours."""
        code = np.append(np.append(0, _CODE[np.frombuffer(run.encode(), np.uint8)]), 0)
        return float(self.plain[code[start : end + 1], code[start + 1 : end + 2]].sum())

    def ratio(self, value: str) -> tuple[int, float]:
        """Kind of the best format, and the log-likelihood ratio of the value."""
        name = character_set(value)
        scores = {k: f.score(value, name) for k, f in self.formats.items()}
        best = max(scores, key=lambda k: (scores[k], -k), default=0)
        if not scores or scores[best] == -math.inf:
            return best, -math.inf
        return best, scores[best] - self._plain(value, 0, len(value))

    def judge(self, value: str) -> tuple[int, float] | None:
        """Kind and log-likelihood ratio a character, if the value is taken for a credential."""
        kind, ratio = self.ratio(value)
        return (kind, ratio / len(value)) if ratio > max(TOTAL, EACH * len(value)) else None

    def parts(self, run: str) -> list[Part]:
        """What of a run is taken for credentials: all of it or, if not, its best parts between boundaries that do not overlap."""
        whole = self.judge(run)
        if whole:
            return [(0, len(run), *whole)]
        starts = [i + 1 for i, c in enumerate(run) if c in BOUNDARY]
        if not starts:
            return []
        found = []
        for start in (0, *starts):
            for k, f in self.formats.items():
                for end, score in f.walk(run, start):
                    ratio = score - self._plain(run, start, end)
                    if ratio > max(TOTAL, EACH * (end - start)):
                        found.append((-ratio, k, start, end))
        out: list[Part] = []
        for ratio, k, start, end in sorted(found):
            if all(end <= s or e <= start for s, e, _, _ in out):
                out.append((start, end, k, -ratio / (end - start)))
        return sorted(out)

    def accepted(self, runs: list[str]) -> dict[str, list[Part]]:
        """Those of the runs that hold credentials, with where; what short runs hold is remembered."""
        if len(self.judged) > REMEMBERED:
            self.judged.clear()
            self.taken.clear()
        found, out = set(runs), {}
        for run in found:
            if run in self.judged:
                if run in self.taken:
                    out[run] = self.taken[run]
                continue
            parts = self.parts(run)
            if parts:
                out[run] = parts
            if len(run) <= REMEMBERED_LENGTH:
                self.judged.add(run)
                if parts:
                    self.taken[run] = parts
        return out


def scan_text(text: str, grammar: Grammar) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
    """Base spans, and (start, end, kind, score) of the candidates that the grammars accept outside them."""
    base = base_spans(text)
    extra = []
    taken = grammar.accepted(CANDIDATE.findall(text))
    if taken:
        for m in CANDIDATE.finditer(text):
            for start, end, kind, score in taken.get(m[0], ()):
                start, end = m.start() + start, m.start() + end
                if not any(s < end and start < e for s, e, _ in base):
                    extra.append((start, end, kind, score))
    return base, extra


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_inferred long, top_score double"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per row: counts of base spans by kind, their digest, and all spans of the whole text.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind.
    ``n_inferred`` counts those that only the grammars find, ``top_score`` is their best
    score, the log-likelihood ratio a character (null without). Without any base match in ``docs`` nothing is inferred. Null
    texts count as empty; repeated rows repeat; other columns are ignored.
    """
    grammar = Grammar(*learn(docs, text_col, sample))
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.value
        for batch in batches:
            for a, b in byte_slices(text_sizes(batch.column(1)), 1 << 20):
                rows = []
                for text in batch.column(1).slice(a, b - a).to_pylist():
                    base, extra = scan_text(text, grammar)
                    n = Counter(k for _, _, k in base)
                    digest = hashlib.sha256(_told(base).encode()).hexdigest()
                    rows.append((n[0], n[1], n[2], digest, _told(base + [x[:3] for x in extra]), len(extra), max((x[3] for x in extra), default=None)))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_inferred", "top_score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(scan, SCHEMA)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))
