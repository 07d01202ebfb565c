"""Spelling variants: words one insertion, deletion or replacement apart, found by bidirectional FM-index search schemes.

Words are counted with sums inside each task before the one shuffle. Two words one error apart, the shorter of L letters,
have their first or their last L // 2 letters in common. So each word goes to the cells of its two halves, for L its own
length and one less; cells are dealt to shards of bounded size, and each shard builds an FM-index of its words and one of
their mirror images (``fm_index``). A search matches one half exactly, from the delimiter on, and goes on across the rest,
allowing one error. A pair counts in the cell of its first halves if they are equal, else in that of its last, so that it
is found once each way, and counts and best neighbours are put together by word in one more shuffle of partial results.

A cell of more than ``CELL`` words is divided by the same argument: what is left between the two ends that its words have in
common is halved again. So no half that is in a third of all words makes a large shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import words as W
from fieldspark.llm.fm_index import Index, flat
from fieldspark.llm.shared import column, removed, slices, spread, table, written

#: Words of a cell, and of a shard (about), at most.
CELL, SHARD = 10_000, 40_000
#: Searches made at a time.
STEP = 1 << 14
#: Bytes of a run whose checksum is taken together with those of others; of a longer one, alone.
SHORT = 64
#: No bound yet from the cell of the last halves.
OPEN = 1 << 30
_step = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _step = np.where(_step & 1, np.uint32(0xEDB88320) ^ (_step >> 1), _step >> 1).astype(np.uint32)


def letter_runs(data: np.ndarray, bounds: np.ndarray) -> W.Words:
    """The longest runs of A-Z, a-z and U+00C0 to U+00FF of some texts (of which each has the first byte C3 in UTF-8 and
    nothing else has), hashed with A-Z in lower case."""
    wide = data == 0xC3
    inside = wide | (((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) & (data < 0x80))
    inside[1:] |= wide[:-1]
    return W.runs_of(data, bounds, inside)


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The crc32 of what ``before`` is the crc32 of, followed by data[start:end]."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size, live, k = end - start, np.flatnonzero((end > start) & (end - start <= SHORT)), 0
    while len(live):
        now = state[live]
        state[live] = _step[(now ^ data[start[live] + k]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
        k += 1
        live = live[size[live] > k]
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > SHORT):
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(before[i]))
    return out


def _counted(slip: int, letters: int):
    """(word, n) of the words of at least ``letters`` code points in a slice of texts."""

    def run(batches):
        for batch in (part for batch in batches for part in slices(batch, 1)):
            w = letter_runs(*W.texts(batch.column(1)))
            data = W.FOLD[w.data]
            points = np.cumsum(np.concatenate([[0], data != 0xC3]))  # a letter beyond ASCII has two bytes
            size = points[w.end] - points[w.start]
            slipped = np.zeros(len(size), bool)
            edited = []
            if slip:
                ids = batch.column(0).to_pylist()
                own = np.repeat(np.arange(len(ids)), np.diff(w.first))
                sums = checksums(data, w.start, w.end, np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)[own])
                slipped = (sums % slip == 0) & np.array([i is not None for i in ids], bool)[own] if ids else slipped
                for k in np.flatnonzero(slipped & (size > letters)).tolist():
                    said = data[w.start[k] : w.end[k]].tobytes().decode()
                    at = int(sums[k]) % len(said)
                    edited.append(said[:at] + said[at + 1 :])
            kept = np.flatnonzero(~slipped & (size >= letters))
            _, first, n = np.unique(w.hash[kept], return_index=True, return_counts=True)
            said = W.spelled(W.Words(data, w.start, w.end, w.hash, w.first), kept[first], np.arange(len(first) + 1))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([said, pa.array(edited, pa.string())]), pa.array(np.concatenate([n, np.ones(len(edited), np.int64)]))], ["word", "n"])

    return run


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", letters: int = 6, least: int = 5, slip: int = 0) -> DataFrame:
    """(word, n) of all words of at least ``letters`` code points that occur ``least`` times or more: the longest runs of
    A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Null texts have none; rows of any ids count alike.

    With ``slip``, a run loses one code point where the crc32 of ``<doc_id>:<word>`` is divisible by it, at that sum modulo
    the word's length; runs in rows of null ids don't.
    """
    rows = docs.select(column(doc_id).alias("id"), column(text).alias("text"))
    return rows.mapInArrow(_counted(slip, letters), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _cells(vocabulary: DataFrame) -> DataFrame:
    """(word, n, length, pre, suf, open, cell): the words of each cell have ``pre`` letters at the front and ``suf`` at the back
    in common, and ``length`` letters or one more. A pair belongs to it if its front in common is shorter than ``open``."""
    rows = vocabulary.select("word", "n", F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("length"), F.lit(0).alias("pre"), F.lit(0).alias("suf"), F.lit(OPEN).alias("open"))
    done = None
    while True:
        half = F.floor((F.col("length") - F.col("pre") - F.col("suf")) / 2).cast("int")
        front = F.struct((F.col("pre") + half).alias("pre"), "suf", "open")
        back = F.struct("pre", (F.col("suf") + half).alias("suf"), F.least("open", F.col("pre") + half).alias("open"))
        rows = rows.withColumn("to", F.explode(F.array(front, back))).select("word", "n", "length", "to.*")
        ends = F.substring("word", F.lit(1), F.col("pre")), F.expr("right(word, suf)")
        rows = written(rows.withColumn("cell", F.xxhash64("length", "pre", "suf", "open", *ends)), "cells")
        large = rows.where("length - pre - suf >= 2").groupBy("cell").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > CELL).select("cell")
        large = written(large, "large-cells")
        some = not large.isEmpty()
        small = rows.join(large, "cell", "left_anti").select("word", "n", "length", "pre", "suf", "open", "cell") if some else rows
        done = small if done is None else done.unionByName(small)
        if not some:
            removed(large)
            return done
        rows = rows.join(large, "cell", "left_semi").drop("cell")


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many symbols are equal from ``a`` and ``b`` on, up to ``most``."""
    out, live = np.zeros(len(a), np.int64), np.flatnonzero(most > 0)
    while len(live):
        live = live[symbols[a[live] + out[live]] == symbols[b[live] + out[live]]]
        out[live] += 1
        live = live[out[live] < most[live]]
    return out


def _searched(rows: pa.Table) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """(words, their counts, query words, found words) of the rows of a shard, some searches at a time."""
    all_words = rows.column("word").to_pylist()
    counts = dict(zip(all_words, rows.column("n").to_pylist()))
    words = sorted(counts)
    place = {w: i for i, w in enumerate(words)}
    mirrored = sorted(range(len(words)), key=lambda i: words[i][::-1])
    symbols, bounds, letters = flat(words)
    indexes = Index(symbols, bounds, len(letters)), Index(*flat([words[i][::-1] for i in mirrored], letters)[:2], len(letters))
    of_mirrored = np.array(mirrored, np.int64)
    own = np.array([place[w] for w in all_words], np.int64)
    length, pre, suf, most = (rows.column(c).to_numpy().astype(np.int64) for c in ("length", "pre", "suf", "open"))
    size = np.diff(bounds)
    n = np.array([counts[w] for w in words], np.int64)
    for forward in (True, False):
        which = np.flatnonzero((pre >= suf) == forward)
        for k in range(0, len(which), STEP):
            part = which[k : k + STEP]
            q = own[part]
            exact = (pre if forward else suf)[part]
            begin, step = (bounds[q], 1) if forward else (bounds[q + 1] - 1, -1)
            query, found = indexes[forward].one_error(symbols, begin, step, size[q], exact, size[q] > length[part])
            found = of_mirrored[found] if forward else found
            part, q = part[query], q[query]
            far = np.maximum(pre[part], np.where(most[part] < OPEN, most[part], 0))
            both = _common(symbols, bounds[q], bounds[found], np.minimum(np.minimum(size[q], size[found]), far))
            right = (both >= pre[part]) & (both < most[part])
            yield words, n, q[right], found[right]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best) of the words of a shard with neighbours in it."""
    for words, n, query, found in _searched(pa.Table.from_batches(batches)):
        if not len(query):
            continue
        order = np.lexsort((found, -n[found], query))  # words are in code-point order
        query, found = query[order], found[order]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        count = np.diff(np.append(first, len(query)))
        names = pa.array(words)
        yield pa.RecordBatch.from_arrays([names.take(pa.array(query[first])), pa.array(count), pa.array(-n[found[first]]), names.take(pa.array(found[first]))], ["word", "n_near", "less", "form"])


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of each of the words with others one insertion, deletion or replacement away: how many,
    and the one of the largest n (ties: the smallest in code-point order). Words are distinct, not null and of two letters
    or more."""
    cells = written(_cells(vocabulary), "cells")
    shards = max(1, -(-cells.count() // SHARD))
    shard = F.pmod("cell", F.lit(shards)).cast("int")
    met = cells.withColumn("shard", shard).groupBy("shard").applyInArrow(_near, "word string, n_near long, less long, form string")
    best = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    return best.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) without circles: the last word that forms lead to. Each round doubles the steps."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.alias("a").join(now.select(F.col("word").alias("w"), F.col("root").alias("further")).alias("b"), F.col("a.root") == F.col("b.w"), "left")
        after = written(ahead.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        removed(now)
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")
        now._written_path = after._written_path


def variants(vocabulary: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``vocabulary`` (word, n).

    Near words differ by exactly one inserted, deleted or replaced code point; ``n_near`` is their number. ``form`` is the near
    word of the largest n (ties: smallest in code-point order), if that, ``form_n``, is at least ``times`` the word's n; else
    both are null. ``root`` is the last word that forms lead to, the word itself without a form. Rows of null words are left
    out, of words that are repeated the counts are added; words of fewer than two letters have no near words. No rows give none.
    """
    known = written(vocabulary.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    near = written(neighbours(known.where(F.char_length("word") >= 2)), "neighbours")
    enough = F.col("form_n") >= times * F.col("n")
    out = written(known.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")), "variants")
    removed(known, near)
    last = roots(out.where("form is not null"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), slip=199))
