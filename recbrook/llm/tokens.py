"""Token counts by heap-and-linked-list byte-pair merging.

A piece starts as its UTF-8 bytes, a doubly linked list; a heap holds the
adjacent pairs that have a merge rank.  The lowest rank (leftmost on ties) is
popped again and again and merged, and the two new neighbours' pairs pushed.
The count is the initial symbols minus the merges; no ids are emitted.

The merge ranks are read from the tokenizer file on the driver (at most some
50,000 pairs) and broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The white space of the tokenizer's pattern (Unicode
# White_Space) and the pattern itself, from the vocabulary's description.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
           r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
#: Units remembered by one task; beyond that the memory starts afresh.
REMEMBERED = 1_000_000


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: bytes
    that print stand for themselves, the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_table(path: str) -> tuple[dict[int, int], list[str]]:
    """{left symbol << 20 | right symbol: rank} of a byte-level BPE file, where
    symbol 0-255 is a byte and 256 + rank a merge's result, and its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    symbol: dict[str, int] = dict(byte_symbols())
    ranks: dict[int, int] = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks[symbol[left] << 20 | symbol[right]] = rank
        symbol.setdefault(left + right, 256 + rank)
    return ranks, [t["content"] for t in spec.get("added_tokens", [])]


def merged_count(raw: bytes, ranks: dict[int, int]) -> int:
    """Symbols left when no adjacent pair of the piece has a rank."""
    n = len(raw)
    if n < 2:
        return n
    at = list(raw)
    heap = []
    for i in range(n - 1):
        r = ranks.get(at[i] << 20 | at[i + 1])
        if r is not None:
            heap.append(r << 32 | i)
    if not heap:
        return n
    heapify(heap)
    after, before, left = list(range(1, n + 1)), list(range(-1, n - 1)), n
    while heap:
        x = heappop(heap)
        i, r = x & 0xFFFFFFFF, x >> 32
        j = after[i]
        # An entry is stale once either symbol of its pair has been merged.
        if j >= n or at[i] < 0 or ranks.get(at[i] << 20 | at[j]) != r:
            continue
        symbol = at[i] = 256 + r
        at[j] = -1
        k = after[i] = after[j]
        left -= 1
        if k < n:
            before[k] = i
            r = ranks.get(symbol << 20 | at[k])
            if r is not None:
                heappush(heap, r << 32 | i)
        h = before[i]
        if h >= 0:
            r = ranks.get(at[h] << 20 | symbol)
            if r is not None:
                heappush(heap, r << 32 | h)
    return left


class Counter:
    """Counts the tokens of texts; remembers units (white space and the word
    after it) up to a bound.  Units never share a piece of the pattern, since a
    piece with a non-space has no white space after its first character."""

    def __init__(self, ranks: dict[int, int], special: list[str]):
        self.ranks, self.known = ranks, {}
        self.pieces = regex.compile(PATTERN).findall
        self.units = regex.compile("[" + SPACE + "]*[^" + SPACE + "]+|[" + SPACE + "]+").findall
        self.rare = regex.compile("[" + SPACE.replace("\t-\r ", "\t\x0b-\r") + "]").search
        self.special = regex.compile("|".join(map(regex.escape, special))).split if special else None
        self.marks = special

    def unit(self, unit: str) -> int:
        n = sum(merged_count(p.encode("utf-8", "surrogatepass"), self.ranks) for p in self.pieces(unit))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(unit) <= 64:
            self.known[unit] = n
        return n

    def plain(self, text: str) -> int:
        if "  " in text or "\n" in text or self.rare(text):
            units = self.units(text)
        else:  # single spaces only: split and give each word its space back
            units = text.split(" ")
            units = [units[0], *[" " + u for u in units[1:]]]
        get, total = self.known.get, 0
        for u in units:
            n = get(u)
            total += self.unit(u) if n is None else n
        return total

    def count(self, text: str) -> int:
        if self.special and any(m in text for m in self.marks):
            parts = self.special(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with the token count of its text column under the byte-level BPE
    file at ``path``.  Null and empty texts have none; a special string inside
    a text is one token, as the file's library has it by default.  Texts may
    be of any length: a piece of n bytes takes n log n steps.  A column named
    ``out`` is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(merge_table(path))

    @F.pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(*shared.value)
        for texts in batches:
            yield pd.Series([counter.count(t) if t else 0 for t in texts], dtype="int64")

    return df.withColumn(out, counted(F.col(text)))
