"""Codes: normalisation, hierarchical queries, signatures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(value: str) -> str:
    """The same normalisation for a literal."""
    return "".join(c for c in value.upper() if c.isascii() and c.isalnum())


def normalize_code(code: Column) -> Column:
    """Upper case, letters and digits only; null where nothing is left."""
    return F.nullif(F.regexp_replace(F.upper(code), "[^A-Z0-9]", ""), F.lit(""))


def normalize_codes(codes: Column) -> Column:
    """Normalised codes, each once, in order."""
    return F.array_distinct(F.array_compact(F.transform(codes, normalize_code)))


def municipality(code: Column) -> Column:
    digits = F.regexp_replace(code.cast("string"), "[^0-9]", "")
    return F.when(F.length(digits) == 6, F.concat(digits, F.lit("0"))).when(F.length(digits) == 7, digits)


def signature(fields: Column) -> Column:
    """First 16 hex digits of SHA-1 of the names joined by a bar."""
    return F.substring(F.sha1(F.array_join(fields, "|").cast("binary")), 1, 16)


@dataclass(frozen=True)
class CodeQuery:
    """A node of a code hierarchy, ``A50``, or with descendants a range of nodes, ``A50-A53``."""

    role: str
    node: str
    system: str = ""
    descendants: bool = True

    def matches(self, code: Column, normalized: bool = False) -> Column:
        """Whether a code falls under the node; null codes do not. Conditions on a stored
        column that is already normalised are of forms that reach a Parquet scan."""
        own = code if normalized else normalize_code(code)
        node = clean(self.node)
        if not node:
            return F.lit(False)
        if not self.descendants:
            hit = own == node
        elif "-" in self.node:
            left, right = (clean(part) for part in self.node.split("-", 1))
            if not left or not right:
                return F.lit(False)
            if len(left) == len(right):
                after = right[:-1] + chr(ord(right[-1]) + 1)
                hit = (own >= left) & (own < after)
            else:
                head = F.substring(own, 1, len(left))
                hit = (own >= left) & (head >= left) & (head <= right)
        else:
            hit = own.startswith(node)
        return own.isNotNull() & hit

    def any_of(self, codes: Column) -> Column:
        return F.coalesce(F.exists(codes, lambda c: self.matches(c)), F.lit(False))
