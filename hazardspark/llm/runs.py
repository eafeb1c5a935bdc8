"""Periodic runs of words: suffix trees of a text and its reversal, constant-time LCE, Lyndon roots extended both ways.

Ukkonen's algorithm makes the suffix trees of a stretch of words and of its reversal. One tour of a tree lists its
leaves and, between neighbours, the depth of their lowest common ancestor, the least depth the tour comes down to; a
table of minima over spans of powers of two answers the longest common extension of any two positions in constant time.
The tours in rising and in falling order of the words rank the suffixes, and the next lesser rank ends the longest
Lyndon word at a position. Every run has a Lyndon word of one of the two orders as its root, so these words are all
candidates: a root of p words is extended to the right and to the left by what agrees at a distance of p.

Only stretches that can hold a run are given to the trees. In a run of at least 24 words and three periods every eight
words occur again one period on or back, so a stretch is a series of places whose next eight words occur again no
further away than a third of the stretch; a text without such places has no run. The screen is exact for the least
length and exponent of the call.

Defined results: a text without words (null, empty, white space) has no run and collapses to the empty text; words are
compared as they are, case included; equal texts give equal results; rows without an id are treated like others;
repeated rows give repeated results; other columns are ignored; an empty table gives no rows. Memory grows with one
text, never with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import bounded_batches, record

#: Words of a window of the screen at most.
WINDOW = 8


class SuffixTree:
    """Ukkonen's suffix tree of a list of numbers that ends with one that is nowhere else and less than all others."""

    def __init__(self, s: list[int]):
        self.s = s
        n = len(s)
        start, end, link, kids = [0], [0], [0], [{}]
        node, edge, length, remain = 0, 0, 0, 0
        for i in range(n):
            c = s[i]
            remain += 1
            last = -1
            while remain:
                if not length:
                    edge = i
                at = kids[node]
                child = at.get(s[edge])
                if child is None:
                    at[s[edge]] = len(start)
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                    if last >= 0:
                        link[last] = node
                        last = -1
                else:
                    begin = start[child]
                    span = end[child] - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[begin + length] == c:
                        if last >= 0:
                            link[last] = node
                        length += 1
                        break
                    split = len(start)
                    at[s[edge]] = split
                    start[child] = begin + length
                    start.append(begin), end.append(begin + length), link.append(0), kids.append({c: split + 1, s[begin + length]: child})
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                    if last >= 0:
                        link[last] = split
                    last = split
                remain -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - remain + 1
        self.start, self.end, self.kids = start, end, kids

    def tour(self, falling: bool = False) -> tuple[list[int], list[int]]:
        """Suffixes in order, and the depth of the common ancestor of each with the one before. The end comes first."""
        start, end, kids, n = self.start, self.end, self.kids, len(self.s)
        order, lows, low = [], [], 0
        stack = [(0, 0, False)]
        while stack:
            node, depth, later = stack.pop()
            if later:
                low = depth
            below = kids[node]
            if below is None:
                order.append(start[node] - depth)
                lows.append(low)
                continue
            depth += end[node] - start[node]
            symbols = sorted(below, reverse=not falling)
            if falling and symbols[0] < 0:
                symbols.append(symbols.pop(0))
            # Pushed last, visited first.
            last = len(symbols) - 1
            for k, c in enumerate(symbols):
                stack.append((below[c], depth, k < last))
        return order, lows


class Extensions:
    """Longest common extensions to the right of any two positions of a list of numbers."""

    def __init__(self, tree: SuffixTree):
        order, lows = tree.tour()
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.tables = [np.array(lows, np.int32)]
        while 2 << (len(self.tables) - 1) <= len(order):
            half, before = 1 << (len(self.tables) - 1), self.tables[-1]
            self.tables.append(np.minimum(before[:-half], before[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.tables[k][low[at]], self.tables[k][high[at] - (1 << int(k)) + 1])
        return out


def next_lesser(rank: list[int]) -> list[int]:
    """For each place the next one with a lesser value, or the number of places."""
    out, waiting = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            out[waiting.pop()] = i
        waiting.append(i)
    return out


def runs_of_stretch(s: list[int], least: int, exponent: int) -> np.ndarray:
    """Runs (start, length, period) of at least ``least`` words and ``exponent`` periods of a list of numbers from 0."""
    n = len(s)
    tree = SuffixTree([*s, -1])
    right, left = Extensions(tree), Extensions(SuffixTree([*reversed(s), -1]))
    falling = np.empty(n + 1, np.int64)
    falling[tree.tour(falling=True)[0]] = np.arange(n + 1)
    found = []
    for rank in (right.rank, falling):
        ends = np.array(next_lesser(rank.tolist()), np.int64)[:n]
        i = np.arange(n)
        p = ends - i
        i, p = i[p * exponent <= n], p[p * exponent <= n]
        j = i + p
        after = right(i, j)
        before = np.zeros(len(i), np.int64)
        inner = i > 0
        before[inner] = left(n - i[inner], n - j[inner])
        found.append(np.stack((i - before, before + p + after, p), axis=1))
    rows = np.concatenate(found)
    rows = rows[(rows[:, 1] >= least) & (rows[:, 1] >= exponent * rows[:, 2])]
    return np.unique(rows, axis=0)


def stretches(ids: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Start and end of the stretches of words that can hold a run."""
    # A window is no longer than a run of two periods less one place, so that one period on or back it is still inside.
    window = min(WINDOW, least * (exponent - 2) // exponent + 1)
    n = len(ids) - window + 1
    if len(ids) < least:
        return []
    spread = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    spread *= np.uint64(0xBF58476D1CE4E5B9)
    spread ^= spread >> np.uint64(32)
    value = np.zeros(n, np.uint64)
    for k in range(window):
        value = value * np.uint64(0x94D049BB133111EB) + spread[k : k + n]
    order = np.argsort(value, kind="stable")
    step = np.where(value[order[1:]] == value[order[:-1]], np.diff(order), len(ids) + 1)
    near = np.full(n, len(ids) + 1)
    near[order[1:]] = step
    near[order[:-1]] = np.minimum(near[order[:-1]], step)
    held = near * exponent <= len(ids)
    while held.any():
        edges = np.flatnonzero(np.diff(np.concatenate(([0], held.astype(np.int8), [0]))))
        start, end = edges[::2], edges[1::2]
        length = end - start + window - 1
        size = np.zeros(n, np.int64)
        size[held] = np.repeat(length, end - start)
        after = held & (size >= least) & (near * exponent <= size)
        if (after == held).all():
            return list(zip(start.tolist(), (end + window - 1).tolist()))
        held = after
    return []


def runs_of(ids: np.ndarray, least: int = 24, exponent: int = 3) -> np.ndarray:
    """All runs of a text of word numbers, by start and period."""
    found = []
    for start, end in stretches(ids, least, exponent):
        _, part = np.unique(ids[start:end], return_inverse=True)
        rows = runs_of_stretch(part.tolist(), least, exponent)
        rows[:, 0] += start
        found.append(rows)
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def planted(n: int, g: int) -> np.ndarray:
    """Numbers of the words that stand at the places of a text of n words after its tail is made periodic."""
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((np.arange(a), a + np.arange(n - a) % p))


def find(
    docs: DataFrame, least: int = 24, exponent: int = 3, loop: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, runs (array of start, length, period by start and period), collapsed (the words that no run
    repeats, joined by one space). ``loop`` gives a whole number for rows whose tail is made periodic first (a test of
    the detector), null for others."""
    if least < exponent or exponent < 2:
        raise ValueError("a run has two periods at least, each of one word at least")
    bounded_batches(docs.sparkSession)
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        (F.lit(None) if loop is None else loop).cast("long").alias("loop"),
    )
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, g in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "loop"))):
                words = text.encode().split()
                number: dict[bytes, int] = {}
                ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
                if g is not None and words:
                    place = planted(len(words), g)
                    ids = ids[place]
                    words = [words[i] for i in place.tolist()]
                rows = runs_of(ids, least, exponent)
                if len(rows):
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
                    np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                runs = [dict(zip(("start", "length", "period"), r)) for r in rows.tolist()]
                yield record(schema, [doc_id], [runs], [b" ".join(words).decode()])

    return given.mapInArrow(search, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
