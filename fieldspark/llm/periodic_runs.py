"""Periodic runs of words by string synchronising sets.

A run is a stretch with a smallest period q, at least 2 q words long, that no neighbour extends. Periods are looked for at
dyadic scales t = 2, 4, 8 ...; scale t finds those from 4 t to 8 t - 1:

1. Synchronising set. Place i is in it if the least hash of the spans of t words beginning at i, ..., i + t, those of
   highly periodic spans (a period of t / 3 at most) left out, is that of i or of i + t. Whether a place is in it depends on
   the 2 t words from it on alone, so equal contexts have their places in the set together; and among t places in a row
   one is in it, unless they lie in a highly periodic region.
2. Pairs. Two places of the set with equal contexts, 4 t to 8 t - 1 words apart, propose their distance as a period. A run of
   such a period p has one: if no place of its first p - 2 t words were in the set, those and the t words after them were
   one highly periodic region, and p not its smallest period.
3. Extension. Pairs of one distance that follow one another within their contexts belong to one stretch; its first is
   extended to the left and its last to the right, by spans of t words and then word by word.

Highly periodic regions of scale t are the runs of smaller periods, found at the scales before; periods below 8, which no set
shows, are found by comparing the words with those 1, ..., 7 places on. Many texts are worked on as one sequence, with a
word of its own after each text; texts too short for a scale leave it. Time is O(n log n) of vector operations for n words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm import words as W
from fieldspark.llm.shared import Packed, spread, table

U = np.uint64
#: Periods below this are found by direct comparison.
SMALL = 8
#: Words of a run at least.
LEAST = 12
#: Words compared in one vector operation, about.
STEP = 1 << 20


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the longest stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places are in one of the spans."""
    return np.cumsum(np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n] > 0


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` values in a row."""
    size, out = 1, x
    while 2 * size <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - size : len(x) - size + 1]) if size < n else out


def _reach(w: np.ndarray, at: np.ndarray, other: np.ndarray, step: int) -> np.ndarray:
    """How many words are equal from ``at`` and ``other`` on, in the direction of ``step`` (1 or -1), the first included.
    Spans of 16, 32, 64 ... words are compared, and the one that differs word by word."""
    out = np.zeros(len(at), np.int64)
    live, size = np.arange(len(at)), 16
    while len(live):
        kept = []
        few = max(1, STEP // size)
        for k in range(0, len(live), few):
            own = live[k : k + few]
            place = (out[own][:, None] + np.arange(size)) * step
            a, b = at[own][:, None] + place, other[own][:, None] + place
            inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(w))
            differ = ~inside | (w[np.clip(a, 0, len(w) - 1)] != w[np.clip(b, 0, len(w) - 1)])
            some = differ.any(axis=1)
            out[own] += np.where(some, differ.argmax(axis=1), size)
            kept.append(own[~some])
        live, size = np.concatenate(kept), min(2 * size, STEP)
    return out


def _pairs(hashes: np.ndarray, places: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of any two places of equal hashes that are ``low`` to ``high`` - 1 apart."""
    order = np.lexsort((places, hashes))
    h, p = hashes[order], places[order]
    at, out = np.arange(len(p)), []
    gap = 1
    while len(at):
        at = at[at + gap < len(p)]
        far = p[at + gap] - p[at]
        near = (h[at + gap] == h[at]) & (far < high)
        at, far = at[near], far[near]
        out.append((p[at[far >= low]], far[far >= low]))
        gap += 1
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _only_smallest(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs by (start, end), each with the smallest of its periods."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def _scale(w: np.ndarray, span: np.ndarray, t: int, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches with a period from 4 t to 8 t - 1. ``span``: hashes of t words from each place on; ``runs`` of smaller periods."""
    order = W.mix(span ^ U(t))
    periodic = (runs[2] * 3 <= t) & (runs[1] - runs[0] >= t)
    order[_covered(runs[0][periodic], runs[1][periodic] - t + 1, len(order))] = np.iinfo(np.uint64).max
    least = _least(order, t + 1)
    n = len(least)
    places = np.flatnonzero((least != np.iinfo(np.uint64).max) & ((order[:n] == least) | (order[t : t + n] == least)))
    context = W.joined(span[places], span[places + t])
    at, far = _pairs(context, places, 4 * t, 8 * t)
    if not len(at):
        return at, at, far
    by = np.lexsort((at, far))
    at, far = at[by], far[by]
    head = np.ones(len(at), bool)
    head[1:] = (far[1:] != far[:-1]) | (at[1:] - at[:-1] > 2 * t)  # contexts that overlap or touch are one stretch
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(at)) - 1
    far = far[first]
    start = at[first] - _reach(w, at[first] - 1, at[first] - 1 + far, -1)
    end = at[last] + far + _reach(w, at[last], at[last] + far, 1)
    long = end - start >= 2 * far
    return start[long], end[long], far[long]


def find_runs(w: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of at least ``LEAST`` words, by start and end, in texts w[first[i]:first[i+1]] of
    word hashes. Starts and ends are places in ``w``."""
    size = np.diff(first)
    # a word of its own after each text, so that nothing goes on from one to the next
    own = np.repeat(np.arange(len(size)), size)
    x = np.empty(len(w) + len(size), U)
    x[np.arange(len(w)) + own] = w
    x[first[1:] + np.arange(len(size))] = W.mix(np.arange(len(size), dtype=U) + U(0xA5A5A5A5A5A5A5A5))
    offset = first[:-1] + np.arange(len(size))  # of each text in x
    found = []
    for p in range(1, SMALL):
        if len(x) > p:
            a, b = _stretches(x[p:] == x[:-p])
            b = b + p
            long = b - a >= 2 * p
            found.append((a[long], b[long], np.full(int(long.sum()), p)))
    runs = _only_smallest(*(np.concatenate(c) for c in zip(*found))) if found else (np.zeros(0, np.int64),) * 3
    t, y, place, there = 2, x, np.arange(len(x)), np.arange(len(x))
    while len(y) > 8 * t:
        inside = there[runs[0]] >= 0
        begin = there[runs[0][inside]]
        new = _scale(y, _spans(y, t), t, (begin, begin + (runs[1] - runs[0])[inside], runs[2][inside]))
        if len(new[0]):
            runs = _only_smallest(*(np.concatenate(c) for c in zip(runs, (place[new[0]], place[new[1] - 1] + 1, new[2]))))
        t *= 2
        stay = size >= 8 * t
        if not stay.all():  # whole texts leave, so what is left is in order and every run's words still follow one another
            keep = np.repeat(stay, size + 1)
            y, place, size = y[keep], place[keep], size[stay]
            there = np.full(len(x), -1)
            there[place] = np.arange(len(place))
    start, end, period = runs
    long = end - start >= LEAST
    start, end, period = start[long], end[long], period[long]
    text = np.searchsorted(offset, start, "right") - 1
    return start - text, end - text, period


def _spans(y: np.ndarray, t: int) -> np.ndarray:
    """Hashes of the spans of ``t`` words, a power of two."""
    out, size = y, 1
    while size < t:
        out = W.joined(out[:-size], out[size:])
        size *= 2
    return out


def _added(column: pa.Array) -> list[pa.Array]:
    w = W.words(*W.texts(column), W.SPACED, fold=False)
    start, end, period = find_runs(w.hash, w.first)
    keep = np.flatnonzero(~_covered(start + period, end, len(w.hash)))
    text = np.searchsorted(w.first, start, "right") - 1
    order = np.lexsort((period, start))
    values = [start - w.first[text], end - start, period]
    runs = pa.StructArray.from_arrays([pa.array(v[order]) for v in values], ["start", "length", "period"])
    bounds = np.searchsorted(start[order], w.first)
    return [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), runs), W.spelled(w, keep, np.searchsorted(keep, w.first))]


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def add_runs(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period of every run of at least ``LEAST`` words, by start and period; words are
    numbered from 0) and ``collapsed`` (the words that no run contains after its first period, joined by one space).

    Words are what stands between ASCII white space, unchanged. A text without words, or null, has no runs and an empty
    ``collapsed``. Each row is judged by its own text, so repeated rows and ids, and null ones, don't matter. Columns of
    ``docs`` named ``runs`` or ``collapsed`` are replaced; all others pass through, whatever their names. An empty table
    gives an empty table.
    """
    return Packed(docs, text, {"runs": T.ArrayType(RUN), "collapsed": T.StringType()}, keep_text).mapped(lambda: _added)


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``documents``, where each document whose id's crc32 ends in 0 has the words from a place of that
    hash's choice on replaced by repetitions of the first of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    said = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, said).alias("ws"), g.alias("g"))
    placed = chosen.withColumn("n", F.size("ws")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    edited = F.array_join(F.transform("ws", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("ws", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = add_runs(repeated_tails(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))), keep_text=False)
    most = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    out = out.withColumn("most", F.when(F.size("runs") > 0, most))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("most.before")).alias("start"), F.col("most.length").alias("length"), (-F.col("most.shorter")).alias("period"),
        F.floor(1000 * F.col("most.length") / -F.col("most.shorter")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
