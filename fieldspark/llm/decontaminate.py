"""Benchmark decontamination: a broadcast hash set of normalised test n-grams; training texts are scanned window by
window, hits are verified word by word, and hit spans or contaminated documents are removed.

A benchmark of at most ``BROADCAST_WINDOWS`` windows is broadcast, and no text is shuffled. For a larger one a bit table of
a fixed size is broadcast instead: it lets through the few document windows whose hash may be one of the benchmark's,
and those alone are joined to the benchmark's windows by a salted shuffle.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm import words as W
from fieldspark.llm.shared import Packed, bit_table, column, in_bit_table, removed, spread, table, within, written

U = np.uint64
WINDOW = 13
#: Windows of the benchmark that are broadcast at most, of about 300 bytes each in a worker.
BROADCAST_WINDOWS = 200_000
#: Bits of the table that screens windows of a larger benchmark (8 MB), and salts of the join that follows.
SCREEN_BITS, SALTS = 26, 8
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
NEW = {"n_words": T.LongType(), "n_hit": T.LongType(), "n_items": T.LongType(), "items": T.ArrayType(T.StringType()), "spans": SPANS, "bounds": SPANS}
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
#: A document window that may be the benchmark's: words from and to, bytes from and to, its hash, its words.
MAYBE = T.ArrayType(T.StructType([*[T.StructField(c, T.LongType()) for c in ("start", "end", "first", "last", "h")], T.StructField("said", T.StringType())]))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """(item string, size int, said string, h long): every window of ``n`` words of each item, or its fewer words as one,
    and its hash.

    Items that are null, or whose text is null or has no words, give none.
    """

    def cut(batches):
        for batch in batches:
            data, bounds = W.texts(batch.column(1))
            ids, out = batch.column(0).to_pylist(), []
            for i, j in W.chunks(bounds):
                w = W.words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], W.ALNUM)
                for h, x, k in zip(*(c.tolist() for c in (c.view(np.int64) for c in w.windows(n, True)))):
                    size = min(n, int(w.first[k + 1]) - x)
                    out.append((ids[i + k], size, W.folded(w, x, x + size).decode("utf-8", "replace"), h))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], [], []), (pa.string(), pa.int32(), pa.string(), pa.int64()))], ["item", "size", "said", "h"])

    rows = benchmark.select(column(item).cast("string").alias("item"), column(text).alias("text")).where("item is not null and text is not null")
    return rows.mapInArrow(cut, "item string, size int, said string, h long").distinct()


class WindowSet:
    """The windows of a benchmark: hashes by size for the scan, and what each says, and whose it is, for the verification."""

    def __init__(self, rows: list):
        items: dict[bytes, list[str]] = defaultdict(list)
        by_size: dict[int, set[int]] = defaultdict(set)
        for item, size, said, h in rows:
            items[said.encode()].append(item)
            by_size[size].add(h)
        self.items = {said: tuple(own) for said, own in items.items()}
        self.hashes = {size: W.SortedHashes(np.array(sorted(own), np.int64).view(U)) for size, own in by_size.items()}


_held: dict[str, WindowSet] = {}


def _window_set(name: str, known) -> WindowSet:
    """The broadcast windows as a set, made once a worker; a worker keeps the last one only."""
    if name not in _held:
        _held.clear()
        _held[name] = WindowSet(known.value)
    return _held[name]


def merged(hits: list[tuple[int, int]]) -> list[list[int]]:
    """The union of half-open spans, those that touch joined."""
    out: list[list[int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _found(words: list[int], spans: list[list[tuple[int, int]]], items: list[list[str]], bounds: list[list[tuple[int, int]]]) -> list:
    """Arrow columns of ``NEW``."""
    as_spans = lambda rows: pa.array([[{"start": a, "end": b} for a, b in r] for r in rows], _SPAN)
    hit = [sum(b - a for a, b in r) for r in spans]
    return [pa.array(words, pa.int64()), pa.array(hit, pa.int64()), pa.array([len(i) for i in items], pa.int64()), pa.array(items, pa.list_(pa.string())), as_spans(spans), as_spans(bounds)]


def _scan_texts(data: np.ndarray, bounds: np.ndarray, known: WindowSet):
    """For each text: number of words, merged hit spans in words, items that occur, the spans' bounds in bytes."""
    for i, j in W.chunks(bounds):
        w = W.words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], W.ALNUM)
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set[str]] = defaultdict(set)
        for size, hashes in known.hashes.items():
            h, at, text = w.windows(size, False)
            for x in hashes.find(h)[0]:
                a = int(at[x])
                if found := known.items.get(W.folded(w, a, a + size)):
                    hits[int(text[x])].append((a, a + size))
                    items[int(text[x])].update(found)
        for k in range(j - i):
            first, base, whole = int(w.first[k]), int(bounds[i + k] - bounds[i]), merged(hits.get(k, []))
            yield int(w.first[k + 1]) - first, [(a - first, b - first) for a, b in whole], sorted(items.get(k, ())), [(int(w.start[a]) - base, int(w.end[b - 1]) - base) for a, b in whole]


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted strings), ``spans`` (hit words, start and end)
    and ``bounds`` (the same spans in UTF-8 bytes of the text).

    A document word inside any occurrence of a benchmark window is hit. Null or wordless texts have no words; an empty
    benchmark hits nothing; repeated rows and items count each by themselves and once. Columns of ``docs`` with one of
    the six new names are replaced, all others pass through (without ``keep_text`` the text doesn't).
    """
    windows = written(benchmark_windows(benchmark, item, item_text, n), "benchmark-windows")
    packed = Packed(docs, text, NEW, keep_text)
    if not within(windows, broadcast_windows):
        return _scan_by_join(packed, windows)
    known = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in windows.collect()])
    removed(windows)
    name = uuid.uuid4().hex

    def start():
        own = _window_set(name, known)
        return lambda texts: _found(*([list(c) for c in zip(*_scan_texts(*W.texts(texts), own))] or [[]] * 4))

    return packed.mapped(start)


def _scan_by_join(packed: Packed, windows: DataFrame) -> DataFrame:
    """``scan`` for a benchmark of any size."""
    spark = windows.sparkSession
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most the window's size of them
    sent = spark.sparkContext.broadcast((bit_table(windows, "h", SCREEN_BITS), sizes))
    maybe = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("h", pa.int64()), ("said", pa.string())]))

    def start():
        screen, sizes = sent.value

        def run(texts: pa.Array) -> list:
            words, out = [], []
            data, bounds = W.texts(texts)
            for i, j in W.chunks(bounds):
                w = W.words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], W.ALNUM)
                rows: list[list[dict]] = [[] for _ in range(j - i)]
                for size in sizes:
                    h, at, text = w.windows(size, False)
                    for x in np.flatnonzero(in_bit_table(screen, h)).tolist():
                        a, k = int(at[x]), int(text[x])
                        base, first = int(bounds[i + k] - bounds[i]), int(w.first[k])
                        rows[k].append({"start": a - first, "end": a - first + size, "first": int(w.start[a]) - base, "last": int(w.end[a + size - 1]) - base, "h": int(h[x].view(np.int64)), "said": W.folded(w, a, a + size).decode("utf-8", "replace")})
                words += np.diff(w.first).tolist()
                out += rows
            return [pa.array(words, pa.int64()), pa.array(out, maybe)]

        return run

    # windows alone are shuffled; what is found goes back to the documents that have it
    inner = Packed(packed.rows, "text", {"n_words": T.LongType(), "maybe": MAYBE}, packed.keeps_text)
    rows = written(inner.mapped(start).withColumn("rid", F.monotonically_increasing_id()), "scanned")
    cut = rows.select("rid", F.posexplode("maybe").alias("pos", "m"))
    cut = cut.select("rid", F.struct(F.struct("m.start", "m.end").alias("span"), F.struct(F.col("m.first").alias("start"), F.col("m.last").alias("end")).alias("bound")).alias("hit"), "m.h", "m.said", F.pmod(F.hash("rid", "pos"), F.lit(SALTS)).alias("salt"))
    salted = windows.select("h", "said", "item", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = cut.join(salted, ["h", "said", "salt"]).groupBy("rid").agg(F.collect_set("hit").alias("hits"), F.array_sort(F.collect_set("item")).alias("items"))
    held = ["row", "text"] if packed.keeps_text else ["row"]
    whole = rows.select("rid", *held, "n_words").join(found, "rid", "left").select(*held, "n_words", "hits", "items")
    kinds = T.StructType([*[whole.schema[c] for c in held], *[T.StructField(f"n{k}", kind) for k, kind in enumerate(NEW.values())]])

    def merge(batches):
        for batch in batches:
            words, hits, items = (c.to_pylist() for c in batch.columns[-3:])
            hits = [own or [] for own in hits]
            spans = [merged([(h["span"]["start"], h["span"]["end"]) for h in own]) for own in hits]
            bounds = [_bytes_of(own, found) for own, found in zip(spans, hits)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *_found(words, spans, [own or [] for own in items], bounds)], [*held, *[f"n{k}" for k in range(len(NEW))]])

    return packed.unpacked(whole.mapInArrow(merge, kinds), *[F.col(f"n{k}") for k in range(len(NEW))])


def _bytes_of(spans: list[list[int]], hits: list[dict]) -> list[list[int]]:
    """The bytes of each merged span of words."""
    first, last = ({h["span"][side]: h["bound"][side] for h in hits} for side in ("start", "end"))
    return [[first[a], last[b]] for a, b in spans]


def is_contaminated(share: int = 20):
    """n_hit > 0 and share * n_hit >= n_words."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text: str = "text", item: str = "item_id", item_text: str = "text", n: int = WINDOW, share: int = 20) -> DataFrame:
    """``docs`` without contaminated documents (``mode="documents"``), or with the hit spans cut out of the texts of all
    documents (``mode="spans"``; null stays null); another mode is an error. Columns stay as they are, whatever their names."""
    if mode not in ("documents", "spans"):
        raise ValueError(f'mode is "documents" or "spans", not {mode!r}')
    row = F.struct(F.lit(True).alias("here"), *[column(c).alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text])
    found = scan(docs.select(row.alias("row"), column(text).alias("text")), benchmark, "text", item, item_text, n)
    if mode == "documents":
        return found.where(~is_contaminated(share)).select(*[(F.col("text") if c == text else F.col(f"row.c{k}")).alias(c) for k, c in enumerate(docs.columns)])
    raw = F.encode("text", "utf-8")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("bounds", lambda s: s["end"]))
    starts = F.concat(F.transform("bounds", lambda s: s["start"]), F.array(F.octet_length("text").cast("long")))
    parts = F.zip_with(ends, starts, lambda a, b: F.decode(F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")), "utf-8"))
    cut = F.when(F.col("text").isNotNull(), F.array_join(parts, ""))
    return found.select(*[cut.alias(c) if c == text else F.col(f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = scan(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated")
    )


OP4_SQL = r"""
with item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null and item_id is not null
), item_windows as (
  select distinct cast(item_id as varchar) as item, least(len(w), 13) as size, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') as said
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from item_words where len(w) > 0)
), doc_words as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), doc_windows as (
  select rid, i, s.size, array_to_string(list_slice(w, i, i + s.size - 1), ' ') as said
  from (select rid, w, unnest(range(1, len(w) + 1)) as i from doc_words) d, (select distinct size from item_windows) s
  where i + s.size - 1 <= len(w)
), hits as (
  select rid, i, d.size, item from doc_windows d join item_windows using (said)
), hit_words as (
  select rid, count(distinct i + k) as n_hit from (select distinct rid, i, size from hits) h, range(0, 13) r(k) where k < size group by rid
), hit_items as (
  select rid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by rid
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join hit_words using (rid) left join hit_items using (rid)
"""
