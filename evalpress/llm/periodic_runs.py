"""Periodic runs of words: a suffix automaton whose link tree is a link-cut tree.

Words are appended one at a time.  The access from the new prefix to the root
recolours the path with the new end; every path segment that had one colour
before gives the last earlier end of its strings.  If the distance of the two
ends is at most the longest string of the segment, the two occurrences make a
square, and the segment's length says how far to the left its period holds.
A run is the stretch over which the same (start, period) keeps being found.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import bounded_batches, tidy

#: text pieces between these characters are words
SPACES = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Params:
    """A run has at least ``least`` words and ``exponent`` periods (2 or more)."""

    least: int = 6
    exponent: int = 4


def squares(words: Iterable[int]) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) whenever the words up to ``end`` close a square of
    that smallest period; from ``start`` on the period holds.

    State 0 is none and state 1 the empty string.  ``up``, ``low`` and ``high``
    are the splay trees of the link-cut tree, ordered by depth; only the root of
    a splay tree holds its colour.  A state's first transition is kept in two
    lists, as most states have no other; ``more`` has the rest."""
    size, link = [0, 0], [0, 0]
    word, follow, more = [-1, -1], [0, 0], {}
    up, low, high, colour = [0, 0], [0, 0], [0, 0], [-1, -1]

    def go(state: int, w: int) -> int:
        if word[state] == w:
            return follow[state]
        rest = more.get(state)
        return rest.get(w, 0) if rest else 0

    def put(state: int, w: int, to: int) -> None:
        if word[state] in (w, -1):
            word[state], follow[state] = w, to
        else:
            more.setdefault(state, {})[w] = to

    def new(length: int) -> int:
        for column, value in ((size, length), (link, 0), (word, -1), (follow, 0), (up, 0), (low, 0), (high, 0), (colour, -1)):
            column.append(value)
        return len(size) - 1

    def rotate(x: int) -> None:
        y = up[x]
        z = up[y]
        if low[z] == y and z:
            low[z] = x
        elif high[z] == y and z:
            high[z] = x
        else:
            colour[x] = colour[y]
        if low[y] == x:
            b = low[y] = high[x]
            high[x] = y
        else:
            b = high[y] = low[x]
            low[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z

    def splay(x: int) -> None:
        while True:
            y = up[x]
            if not y or (low[y] != x and high[y] != x):
                return
            z = up[y]
            if z and (low[z] == y or high[z] == y):
                rotate(y if (low[z] == y) == (low[y] == x) else x)
            rotate(x)

    last = 1
    for end, w in enumerate(words):
        state = new(size[last] + 1)
        p = last
        while p and not go(p, w):
            put(p, w, state)
            p = link[p]
        if not p:
            link[state] = 1
        else:
            q = go(p, w)
            if size[q] == size[p] + 1:
                link[state] = q
            else:  # the shorter strings of q get a state of their own, right above q and of its colour
                c = new(size[p] + 1)
                word[c], follow[c] = word[q], follow[q]
                if q in more:
                    more[c] = dict(more[q])
                link[c] = link[q]
                splay(q)
                b = low[c] = low[q]
                if b:
                    up[b] = c
                low[q], up[c] = c, q
                while p and go(p, w) == q:
                    put(p, w, c)
                    p = link[p]
                link[q] = link[state] = c
        up[state] = link[state]
        last, below, x = state, 0, state
        while x:  # access
            splay(x)
            seen = colour[x]
            period = end - seen
            if seen >= 0 and period <= size[x]:
                yield seen - size[x] + 1, end, period
            if high[x]:
                colour[high[x]] = seen
            high[x] = below
            below, x = x, up[x]
        splay(state)
        colour[state] = end


def stretches(words: np.ndarray, p: Params) -> list[tuple[int, int]]:
    """(first, after last) of the stretches that can hold a run: each three
    neighbouring words of a run recur in it, once a period; others are no part
    of any run, and no run reaches beyond its stretch."""
    n = len(words)
    often = min(max(p.least, p.exponent) - 2, p.exponent - 1)
    if n < max(p.least, p.exponent):
        return []
    if often < 2 or n < 3:
        return [(0, n)]
    x = words.astype(np.uint64)
    code = (x[:-2] * np.uint64(0x9E3779B97F4A7C15) + x[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + x[2:]
    _, of, count = np.unique(code, return_inverse=True, return_counts=True)
    if count.max() < often:
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (count[of] >= often).astype(np.int8), [0]])))
    return [(s, e + 2) for s, e in edge.reshape(-1, 2).tolist() if e + 2 - s >= max(p.least, p.exponent)]


def runs(words: np.ndarray, p: Params = Params()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by
    start, then period.  Memory grows with the longest stretch of one text that
    repeats itself, about half a kilobyte a word."""
    out: list[tuple[int, int, int]] = []
    for first, after in stretches(words, p):
        ends: dict[tuple[int, int], int] = {}
        for start, end, period in squares(words[first:after].tolist()):
            ends[start, period] = end
        for (start, period), end in ends.items():
            length = end - start + 1
            if length >= max(p.least, p.exponent * period):
                out.append((first + start, length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: no run has them after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_words, its runs by start and period, and ``collapsed``,
    the words without the repeats of any run, joined by one space.

    A null text has no words; repeated rows and null ids give a row each; an
    empty table gives none; other columns are not read.  Row by row: nothing is
    shuffled and no text is cut."""

    def run(batches):
        for b in batches:
            numbers: dict[bytes, int] = {}
            n_words, found, rest = [], [], []
            for data in b.column(1).cast(pa.binary()):
                words = (data.as_py() or b"").split()  # at ASCII white space, as SPACES
                x = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
                r = runs(x, p)
                if r:
                    words = [words[k] for k in np.flatnonzero(kept(len(words), r)).tolist()]
                n_words.append(len(x))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in r])
                rest.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(rest, pa.string())],
                names=[id_col, "n_words", "runs", "collapsed"])

    src = bounded_batches(docs.select(id_col, text_col))
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(tidy(run), f"`{id_col}` {kind}, n_words long, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where each tenth document repeats a part of itself from a
    word on: place and period follow from the id's checksum.  Rows without an
    id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.array_remove(F.split("text", SPACES), ""))
    d = docs.select("doc_id", "text", words.alias("_words"), g.alias("_g"))
    n = F.size("_words").cast("long")
    d = d.withColumn("_n", n).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    d = d.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    left = (F.col("_n") - F.col("_a")).cast("int")
    part = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    again = F.slice(F.flatten(F.array_repeat(part, F.ceil(left / F.col("_p")).cast("int"))), F.lit(1), left)
    text = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), again), " ")
    return d.select("doc_id", F.when(F.col("_a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: least start, then period) and the
    hashes of the runs and of the collapsed text."""
    best = F.array_sort("runs", _longer).getItem(0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    # array_join of no runs is empty; otherwise every line ends in a line feed
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return (found.withColumn("_best", F.when(F.size("runs") > 0, best))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
                    F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
                    F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words"))


def _longer(a: Column, b: Column) -> Column:
    # runs come by start and period already, and the sort is stable
    return (b["length"] - a["length"]).cast("int")


def periodic_runs(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The runs of all documents with planted repeats, one row per document."""
    return digests(find_runs(planted(docs), p))
