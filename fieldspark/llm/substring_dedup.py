"""Substring dedup over a de Bruijn graph of word windows, compacted before anything is compared.

A window of k words is an edge from its first k - 1 words to its last; a document is a walk. Each walk is cut into paths:
the longest runs of windows that have the same anchor, the run of fewer words in them that is least by hash. The anchor
depends on a window's words alone, so equal windows stand in paths of equal anchors, and a shuffle by anchor brings
together all that can be equal. Where all paths of an anchor say the same, no edge of them branches: each is one compact
path, of which the first place in the corpus is known and every other place is repeated from end to end. Only paths of
branching anchors, where a copy begins, ends or differs, are taken apart into their edges, which a second shuffle
compares. Both comparisons are grouped minima, combined before their shuffle, and joins that Spark may split, so that
a passage in a third of all documents costs a row a task and no task has all of its places.

Repeated paths know the place they repeat (document and word). Pieces that follow one another in a document, and whose
places follow one another in the same source, are one long repeated span: ``repeated_spans``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm import words as W
from fieldspark.llm.shared import Packed, bit_table, column, in_bit_table, removed, slices, spread, table, written

#: Bits of the tables that screen anchors before the second shuffle (8 MB each). They never decide: what isn't in a table
#: surely isn't repeated, or doesn't branch, and the rest is compared; full tables only cost a larger shuffle.
SCREEN_BITS = 26
#: Windows whose anchors are looked for at a time.
STEP = 1 << 16


def paths(w: W.Words, k: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, what the path says, first word, number of windows, place of its first window in all windows) of each
    path of some texts, and the hashes of all windows. Hashes are 64 bits wide; a path or window is told by its anchor's
    and its own together."""
    edge, at, text = w.windows(k, False)
    m = max(1, 2 * k // 5)
    inner, begin, _ = w.windows(m, False)
    order = np.full(len(w.hash) + 1, np.iinfo(np.uint64).max, np.uint64)
    order[begin] = W.mix(inner)
    least = np.empty(len(at), np.int64)
    over = np.lib.stride_tricks.sliding_window_view(order, min(k - m + 1, len(order)))
    for i in range(0, len(at), STEP):
        least[i : i + STEP] = at[i : i + STEP] + over[at[i : i + STEP]].argmin(axis=1)
    new = np.ones(len(at), bool)
    new[1:] = least[1:] != least[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    # a path's first and last window overlap or touch, so together they are all of its words
    said = W.mix(W.joined(edge[first], edge[last]) + (last - first).astype(np.uint64))
    return text[first], order[least[first]], said, at[first] - w.first[text[first]], last - first + 1, first, edge


def _found(k: int):
    """Every path of every text, as (id, h, anchor, said, start)."""

    def run(batches):
        for batch in (part for batch in batches for part in slices(batch, 2)):
            text, anchor, said, start, _, _, _ = paths(W.words(*W.texts(batch.column(2)), W.SPACED, fold=False), k)
            own = pa.array(text)
            columns = [batch.column(0).take(own), batch.column(1).take(own), pa.array(anchor.view(np.int64)), pa.array(said.view(np.int64)), pa.array(start.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "h", "anchor", "said", "start"])

    return run


def _screened(k: int, sent):
    """The paths that may be repeated, with their windows' hashes where the anchor may branch."""

    def run(batches):
        often, branching = sent.value
        for batch in (part for batch in batches for part in slices(batch, 2)):
            text, anchor, _, start, n, first, edge = paths(W.words(*W.texts(batch.column(2)), W.SPACED, fold=False), k)
            keep = np.flatnonzero(in_bit_table(often, anchor))
            text, anchor, start, n, first = text[keep], anchor[keep], start[keep], n[keep], first[keep]
            count = np.where(in_bit_table(branching, anchor), n, 0)
            ends = np.cumsum(count)
            at = np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
            windows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(edge[at].view(np.int64)))
            own = pa.array(text)
            columns = [batch.column(0).take(own), batch.column(1).take(own), pa.array(anchor.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), windows]
            yield pa.RecordBatch.from_arrays(columns, ["id", "h", "anchor", "start", "n", "windows"])

    return run


def _rows(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, Column]:
    """(id, h, text) of each row; h, of a column "text", tells documents of one id apart: a hash of the text, or nothing
    where no id is repeated."""
    own = docs.select(column(doc_id).alias("id"), column(text).alias("text"))
    once = own.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()
    h = F.lit(0).cast("long") if once else F.xxhash64(F.coalesce("text", F.lit("")))
    return own.select("id", h.alias("h"), "text"), h


def repeats(rows: DataFrame, k: int) -> DataFrame:
    """The windows of ``rows`` (id, h, text) that start earlier too, in pieces: windows ``start`` to ``start + n - 1`` of a
    document repeat those from ``from.start`` on of document ``from``, their first place."""
    place = F.struct("id", "h", "start")
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_found(k), f"id {kind}, h long, anchor long, said long, start int")
    anchors = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("said").alias("a"), F.max("said").alias("b"), F.min(place).alias("from")).where("c > 1")
    anchors = written(anchors.select("anchor", (F.col("a") != F.col("b")).alias("branches"), "from"), "anchors")
    tables = bit_table(anchors, "anchor", SCREEN_BITS), bit_table(anchors.where("branches"), "anchor", SCREEN_BITS)
    again = rows.mapInArrow(_screened(k, rows.sparkSession.sparkContext.broadcast(tables)), f"id {kind}, h long, anchor long, start int, n int, windows array<long>")
    held = written(again.join(anchors, "anchor").select("anchor", "id", "h", "start", "n", F.when(F.col("branches"), F.col("windows")).alias("windows"), F.when(~F.col("branches"), F.col("from")).alias("from")), "paths")
    removed(anchors)
    whole = held.where("windows is null").select("id", "h", "start", "n", "from")
    edges = held.where("windows is not null").select("anchor", "id", "h", F.posexplode("windows").alias("k", "window"), "start").withColumn("start", F.col("start") + F.col("k"))
    first = edges.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("from")).where("c > 1").drop("c")
    first = written(first, "first-places")  # read back, so that Spark may split a common window's places in the join
    single = edges.join(first, ["anchor", "window"]).select("id", "h", "start", F.lit(1).alias("n"), "from")
    return whole.unionByName(single).where(~F.col("from").eqNullSafe(place))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 20) -> DataFrame:
    """(doc_id, start, n_words, source_id, source_start): the longest spans of each document, of at least ``words`` words,
    that stand before word for word: all of a span's windows have their first place in one document, one after another.

    Words are numbered from 0 in their document. Earlier is in a document of a smaller id, or further front in the same
    one; null ids come before all others. Rows of one id count as documents in the order of a hash of their texts, equal
    rows as one. Texts of fewer words, and null ones, have no windows.
    """
    one = Window.partitionBy("id", "h").orderBy("start")
    found = repeats(_rows(docs, doc_id, text)[0], words)
    source = F.struct("from.id", "from.h", F.col("from.start") - F.col("start"))
    follows = (F.lag(F.col("start") + F.col("n")).over(one) == F.col("start")) & F.lag(source).over(one).eqNullSafe(source)
    spans = found.withColumn("new", F.when(follows, 0).otherwise(1)).withColumn("span", F.sum("new").over(one))
    out = spans.groupBy("id", "h", "span").agg(F.min("start").alias("start"), (F.sum("n") + words - 1).alias("n_words"), F.min_by("from", "start").alias("from"))
    return out.select(F.col("id").alias(doc_id), "start", "n_words", F.col("from.id").alias("source_id"), F.col("from.start").alias("source_start"))


def _cut(k: int):
    def run(batches):
        for batch in (part for batch in batches for part in slices(batch, 1)):
            w = W.words(*W.texts(batch.column(1)), W.SPACED, fold=False)
            pieces = batch.column(2)
            own = np.repeat(np.arange(batch.num_rows), pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            flat = pieces.flatten()
            begin = w.first[:-1][own] + flat.field(0).to_numpy().astype(np.int64)
            size = len(w.hash) + 1
            open_ = np.bincount(begin, minlength=size) - np.bincount(begin + flat.field(1).to_numpy() + k - 1, minlength=size)
            keep = np.cumsum(open_[:-1]) == 0
            before = np.concatenate([[0], np.cumsum(keep)])[w.first]
            said = W.spelled(w, np.flatnonzero(keep), before)
            n = np.diff(w.first)
            yield pa.RecordBatch.from_arrays([batch.column(0), said, pa.array(n), pa.array(n - np.diff(before))], ["row", "text", "n_words", "n_removed"])

    return run


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 20) -> DataFrame:
    """``docs`` with ``text`` cut to the words that no window of ``words`` words covers that starts earlier too (in a document
    of smaller id, or further front in the same one), joined by one space, and ``n_words`` (before) and ``n_removed`` after
    its columns. Windows are judged on the texts as they come.

    Words are what stands between ASCII white space, unchanged. Texts of fewer words keep all of them; a null text, one
    without words, and one whose words all go become empty. Null ids come before all others, rows of one id with
    different texts count as documents in the order of a hash of their texts, and rows equal in both as one document: each
    gives the same result. Columns of ``docs`` named ``n_words`` or ``n_removed`` are replaced; all others pass through,
    whatever their names. An empty table gives an empty table.
    """
    rows, h = _rows(docs, doc_id, text)
    cuts = repeats(rows, words).groupBy("id", "h").agg(F.collect_list(F.struct("start", "n")).alias("cuts"))
    packed = Packed(docs, text, {"n_words": T.LongType(), "n_removed": T.LongType()})
    if text not in packed.keep or doc_id not in packed.others:
        raise ValueError("the id and the text can't be called like the new columns, nor be one column")
    own = packed.rows.select("row", F.coalesce("text", F.lit("")).alias("text"), F.col(f"row.c{packed.others.index(doc_id)}").alias("id"), h.alias("h"))
    met = own.alias("o").join(cuts.alias("c"), F.col("o.id").eqNullSafe(F.col("c.id")) & (F.col("o.h") == F.col("c.h")), "left")
    kept = met.select("row", "text", "cuts").mapInArrow(_cut(words), T.StructType([packed.rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]))
    return packed.unpacked(kept, F.col("n_words"), F.col("n_removed"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return drop_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = r"""
with split as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), words as (
  select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from split
), windows as (
  select doc_id, i, array_to_string(ws[i : i + 19], ' ') as said from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from split)
), again as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by said order by doc_id, i) as nth from windows) where nth > 1
), judged as (
  select w.doc_id, w.i, w.word, w.i - max(a.i) over (partition by w.doc_id order by w.i) < 20 as covered
  from words w left join again a on a.doc_id = w.doc_id and a.i = w.i
), kept as (
  select doc_id, count(*) as n_words, count(*) filter (where covered) as n_removed,
         string_agg(word, ' ' order by i) filter (where covered is not true) as said
  from judged group by doc_id
)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(said, '')) as kept_sha256
from documents d left join kept k on k.doc_id = d.doc_id
"""
