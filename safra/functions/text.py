"""Text expressions; fuzzy scores are Arrow UDFs, all else is built in."""

from __future__ import annotations

import re
import sys
import unicodedata
from difflib import SequenceMatcher
from itertools import zip_longest

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType

_LATIN = [chr(c) for c in range(0xC0, 0x180)]
_PLAIN = {c: unicodedata.normalize("NFKD", c)[0] for c in _LATIN if len(unicodedata.normalize("NFKD", c)) == 2 and unicodedata.combining(unicodedata.normalize("NFKD", c)[1])}


def strip_accents(text: Column) -> Column:
    """Latin letters without their diacritics, precomposed or combining."""
    return F.regexp_replace(F.translate(text, "".join(_PLAIN), "".join(_PLAIN.values())), r"\p{M}", "")


def normalize_basic(text: Column) -> Column:
    """Lower case without accents; punctuation but hyphens as single spaces."""
    t = F.regexp_replace(F.lower(strip_accents(F.coalesce(text, F.lit("")))), r"[^\p{L}\p{N}_\s -]", " ")
    t = F.trim(F.regexp_replace(t, r"[\s ]+", " "))
    return F.regexp_replace(t, r" *- *", "-")


_MARKS = {c: None for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))}


def _exact(text: str) -> str:
    plain = unicodedata.normalize("NFKD", text).translate(_MARKS).lower()
    return re.sub(r" *- *", "-", re.sub(r"\s+", " ", re.sub(r"[^\w\s-]", " ", plain)).strip())


@F.arrow_udf(StringType())
def normalize_exact(text: pa.Array) -> pa.Array:
    """As ``normalize_basic`` with compatibility decomposition of every script; 64 texts at a time, so a batch is never held as Python strings."""
    parts = [pa.array([_exact(t.as_py() or "") for t in text[i : i + 64]], pa.string()) for i in range(0, len(text), 64)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def name_key(name: Column) -> Column:
    return F.regexp_replace(F.upper(name), r"[^\p{L}\p{N}]", "")


def lenient_double(text: Column) -> Column:
    """Number with a decimal comma or point; null, '', '...' and anything else are null."""
    return F.when(~text.isin("", "..."), F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def grams(text: Column, n: int = 3) -> Column:
    size = F.length(text)
    return F.array_distinct(F.when(size >= n, F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array()))


def tokens(text: Column, least: int = 2) -> Column:
    """Distinct upper-case alphanumeric tokens of ``least`` characters or more."""
    return F.array_distinct(F.filter(F.split(F.upper(text), "[^A-Z0-9]+"), lambda t: F.length(t) >= least))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching blocks (Ratcliff and Obershelp); the order of the two matters."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="float64")


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table a number of one bit a letter."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & whole
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    return 200 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def _partial(a: str, b: str) -> float:
    """Best likeness of the shorter text to a stretch of the longer one of its length, or shorter at either end."""
    if not a or not b:
        return 0.0 if a or b else 100.0
    short, long = sorted((a, b), key=len)
    n = len(short)
    if short in long:
        return 100.0
    ends = [x for i in range(1, n) for x in (long[:i], long[-i:])]
    best = max(_alike(short, x) for x in (*ends, *(long[i : i + n] for i in range(len(long) - n + 1))))
    if n == len(long):
        best = max([best, *(_alike(long, x) for i in range(1, n) for x in (short[:i], short[-i:]))])
    return best


def _token_set(a: str, b: str) -> float:
    """Likeness of the common words with each side's other words to one another, over sets of words."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    if x & y and (x <= y or y <= x):
        return 100.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    l, r = (len(both) + bool(both) + len(s) for s in (left, right))
    best = 100 * (1 - (len(left) + len(right) - 2 * common_length(left, right)) / (l + r))
    if both:
        best = max([best, *(100 * (1 - (1 + len(s)) / (len(both) + n)) for s, n in ((left, l), (right, r)))])
    return best


def _damerau(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours, where a swapped pair may be edited further."""
    far = len(a) + len(b)
    seen: dict[str, int] = {}
    table = {-1: [far] * (len(b) + 2), 0: [far, *range(len(b) + 1)]}
    for i, c in enumerate(a, 1):
        row, last = [far, i], 0
        for j, d in enumerate(b, 1):
            k, m = seen.get(d, 0), last
            if c == d:
                last = j
            swap = table[k - 1][m] + i - k + j - m - 1
            row.append(min(table[i - 1][j] + (c != d), row[j] + 1, table[i - 1][j + 1] + 1, swap))
        table[i] = row
        seen[c] = i
    return table[len(a)][-1]


def _jaro_winkler(a: str, b: str) -> float:
    """Jaro's share of common letters within reach, less half the transpositions; above 0.7, a tenth of the rest for each of up to four common first letters."""
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    free, mine, places = [True] * len(b), [], []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                mine.append(c), places.append(j)
                break
    m = len(mine)
    if not m:
        return 0.0
    moved = sum(c != b[j] for c, j in zip(mine, sorted(places), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = next((i for i, (c, d) in enumerate(zip(a[:4], b[:4], strict=False)) if c != d), min(4, len(a), len(b)))
    return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def _mra_code(name: str) -> str:
    """Match-rating code: no vowels but a first one, no doubled consonants, the first and last three of what is left."""
    letters = [c for c in name.upper() if c != " "]
    kept = [c for i, c in enumerate(letters) if i == 0 or c not in "AEIOU" and c != letters[i - 1]]
    return "".join(kept if len(kept) <= 6 else [*kept[:3], *kept[-3:]])


def _mra_match(a: str, b: str) -> bool | None:
    """Whether the match-rating codes are alike; null where their lengths differ by three or more."""
    x, y = _mra_code(a), _mra_code(b)
    if abs(len(x) - len(y)) >= 3:
        return None
    for _ in range(2):  # letters alike in place go, from the left, then from the right
        rest = [(c, d) for c, d in zip_longest(x, y) if c != d]
        x, y = ("".join(side[i] or "" for side in rest)[::-1] for i in (0, 1))
    total = len(_mra_code(a)) + len(_mra_code(b))
    return 6 - max(len(x), len(y)) >= (5 if total <= 4 else 4 if total <= 7 else 3 if total <= 11 else 2)


# The New York State phonetic code, beginnings, ends, and changes within.
NYSIIS_FIRST = [("MAC", "MCC"), ("KN", "NN"), ("K", "C"), ("PH", "FF"), ("PF", "FF"), ("SCH", "SSS")]
NYSIIS_LAST = [("EE", "Y"), ("IE", "Y"), ("DT", "D"), ("RT", "D"), ("RD", "D"), ("NT", "D"), ("ND", "D")]
NYSIIS_WITHIN = [("EV", "AF"), ("KN", "N"), ("SCH", "SSS"), ("PH", "FF")]
NYSIIS_LETTERS = {"E": "A", "I": "A", "O": "A", "U": "A", "Q": "G", "Z": "S", "M": "N", "K": "C"}


def _nysiis(name: str) -> str:
    letters = "".join(c for c in name.upper() if c.isalpha())
    if not letters:
        return ""
    for old, new in NYSIIS_FIRST:
        if letters.startswith(old):
            letters = new + letters[len(old) :]
            break
    for old, new in NYSIIS_LAST:
        if letters.endswith(old):
            letters = letters[: -len(old)] + new
            break
    code, at = letters[0], 1
    while at < len(letters):
        new, took = letters[at], 1
        for old, by in NYSIIS_WITHIN:
            if letters.startswith(old, at):
                new, took = by, len(old)
                break
        else:
            after = letters[at + 1] if at + 1 < len(letters) else ""
            if new == "H" and (letters[at - 1] not in "AEIOU" or after not in tuple("AEIOU")):
                new = "A" if letters[at - 1] in "AEIOU" else letters[at - 1]
            elif new == "W" and letters[at - 1] in "AEIOU":
                new = "A"
            else:
                new = NYSIIS_LETTERS.get(new, new)
        for c in new:
            code += c if c != code[-1] else ""
        at += took
    if code.endswith("S") and len(code) > 1:
        code = code[:-1]
    if code.endswith("AY"):
        code = code[:-2] + "Y"
    return code[:-1] if code.endswith("A") and len(code) > 1 else code


def _over_pairs(measure, kind):
    """A measure of two texts as an Arrow UDF; null where either is."""

    @F.pandas_udf(kind)
    def told(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else measure(x, y) for x, y in zip(a, b, strict=True)], dtype=object)

    return told


def _over_names(code):
    @F.pandas_udf(StringType())
    def told(a: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else code(x) for x in a], dtype=object)

    return told


likeness = _over_pairs(_alike, DoubleType())
partial_ratio = _over_pairs(_partial, DoubleType())
token_set_ratio = _over_pairs(_token_set, DoubleType())
damerau = _over_pairs(_damerau, IntegerType())
jaro_winkler = _over_pairs(_jaro_winkler, DoubleType())
match_rating = _over_pairs(_mra_match, BooleanType())
match_rating_code = _over_names(_mra_code)
nysiis = _over_names(_nysiis)
