"""Document fingerprints by prefix polynomial hashes.

A text's modular prefix arrays give the hash of any of its spans from two entries; equal spans of any two texts have
equal hashes, and the longest common extension of two places is found by binary search over span hashes. A fingerprint
is the text's length, its prefix hashes at the places of a grid, counted from the start and from the end, and the hashes
of all its spans between anchors that the text itself sets: the least window hashes of each stretch. Spans between
anchors move with the text and their number grows with it, so an edit changes only the few around it. Likeness of two
fingerprints is the larger of what they share as bags of such spans and of what grid spans show.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldspark.llm.shared import Packed, column, slices, spread, table

U = np.uint64
#: Two primes below 2**31 with a base each: together about 62 bits.
PRIMES, BASES = (2147483629, 2147483587), (1103515245, 1664525017)
#: Grid places from either end: at most this many, a power of two of code points apart.
PLACES = 16
#: Anchors: the least hash of the windows (their length second) among each so many neighbours (a power of two), so spans
#: have half as many code points on average. The first pair is for texts of up to SHORT code points only.
ANCHORS, SHORT = ((8, 3), (32, 8)), 512
#: Documents of one range of ids in their order, about; the most ranges (more documents make them larger); and the ids of a
#: range that are looked at to find where it ends.
RANGE_ROWS, MOST_RANGES, SAMPLED = 2_000, 20_000, 20
#: Entries of a table of powers that a worker keeps (16 MB each of four); longer ones are made for the text that needs them.
KEPT_POWERS = 1 << 21

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]
_inverses: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _table(kept: list[np.ndarray], which: int, base: int, n: int) -> np.ndarray:
    have, p = kept[which], PRIMES[which]
    while len(have) < n:  # doubled: b**(k+i) = b**k * b**i
        have = np.concatenate([have, have * U(pow(base, len(have), p)) % U(p)])
    kept[which] = have[:KEPT_POWERS]
    return have[:n]


def _power_table(which: int, n: int) -> np.ndarray:
    """BASES[which] ** 0 ... n-1 modulo its prime."""
    return _table(_powers, which, BASES[which], n)


def _inverse_table(which: int, n: int) -> np.ndarray:
    """The same powers of the base's inverse."""
    return _table(_inverses, which, pow(BASES[which], -1, PRIMES[which]), n)


class PrefixHashes:
    """Prefix sums of code * base**place modulo two primes; answers equality of any spans of one or two texts."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums = []
        for which, p in enumerate(PRIMES):
            terms = (codes.astype(U) + U(1)) * _power_table(which, self.n) % U(p)
            sums = np.zeros(self.n + 1, U)
            np.cumsum(terms, out=sums[1:])  # below 2**31 each: exact for 2**33 code points
            self.sums.append(sums % U(p))

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The hash of the span [a, b), the same wherever the span stands."""
        return tuple((int(s[b]) + p - int(s[a])) * pow(base, -a, p) % p for s, p, base in zip(self.sums, PRIMES, BASES))

    def prefixes(self, places: np.ndarray) -> np.ndarray:
        """Both hashes of the prefixes that end at ``places``, as one number each."""
        return (self.sums[0][places] << U(31)) | self.sums[1][places]


def equal_spans(a: PrefixHashes, i: int, b: PrefixHashes, j: int, k: int) -> bool:
    """Whether a[i:i+k] and b[j:j+k] have the same hash; both sums are moved to one place instead of to none."""
    for which, p in enumerate(PRIMES):
        power, x, y = _power_table(which, max(i, j) + 1), a.sums[which], b.sums[which]
        if (int(x[i + k]) + p - int(x[i])) * int(power[j]) % p != (int(y[j + k]) + p - int(y[j])) * int(power[i]) % p:
            return False
    return True


def longest_common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """The most code points k with a[i:i+k] == b[j:j+k], by binary search over span hashes."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if equal_spans(a, i, b, j, mid):
            low = mid
        else:
            high = mid - 1
    return low


def grid(n: int) -> tuple[int, np.ndarray]:
    """Code points between places, and the places from the start, of a text of ``n``."""
    step = 1
    while n // step > PLACES:
        step *= 2
    return step, np.arange(1, n // step + 1) * step


def anchored(h: PrefixHashes, among: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The spans between a text's anchors as a bag: keys (32 bits of hash, 8 of length) and how often each occurs."""
    cuts = np.array([0, h.n] if h.n else [], np.int64)
    if h.n >= width:
        s, p = h.sums[0], U(PRIMES[0])
        windows = (s[width:] + p - s[:-width]) * _inverse_table(0, h.n - width + 1) % p
        least = (windows << U(32)) | (U(0xFFFFFFFF) - np.arange(len(windows), dtype=U))  # of equal ones the last
        step = 1
        while step < among and len(least) > step:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < among:
            least = least.min(keepdims=True)
        at = (U(0xFFFFFFFF) - (least & U(0xFFFFFFFF))).astype(np.int64)
        at = at[np.flatnonzero(np.diff(at, prepend=0))]
        cuts = np.concatenate([[0], at, [h.n]])
    a, b = cuts[:-1], cuts[1:]
    tag = np.zeros(len(a), U)
    for s, which, p in zip(h.sums, (0, 1), PRIMES):
        tag = (tag << U(31)) | (s[b] + U(p) - s[a]) * _inverse_table(which, h.n + 1)[a] % U(p)
    tag = tag * U(0x9E3779B97F4A7C15) >> U(32)
    return np.unique((tag << U(8)) | (b - a).astype(U), return_counts=True)


def levels(n: int) -> tuple[tuple[int, int], ...]:
    return ANCHORS if n <= SHORT else ANCHORS[1:]


def fingerprint(h: PrefixHashes) -> str:
    """Length, prefix hashes at the grid from the start, then at the grid from the end, and of the whole text; then the
    bags of anchored spans, in each the spans that occur once and the others with their numbers."""
    step, places = grid(h.n)
    marks = np.concatenate([places, h.n - places[::-1], [h.n]]).astype(np.int64)
    said = [h.prefixes(marks).astype("<u8").tobytes()]
    for level in levels(h.n):
        keys, counts = anchored(h, *level)
        once = counts == 1
        keys = np.concatenate([keys[once], keys[~once]])
        more = counts[~once]
        said += [np.array([len(keys), len(more)], "<u4").tobytes(), (keys >> U(8)).astype("<u4").tobytes(), keys.astype(np.uint8).tobytes(), more.astype("<u4").tobytes()]
    return f"{h.n}:" + base64.b64encode(b"".join(said)).decode()


class Marks:
    """A parsed fingerprint: prefix hashes at grid places, from which the hashes of the spans between them follow, and
    the bags of anchored spans."""

    def __init__(self, said: str):
        n, coded = said.split(":", 1)
        self.n = int(n)
        self.step, places = grid(self.n)
        data, k = base64.b64decode(coded), len(places)
        values = np.frombuffer(data, "<u8", 2 * k + 1)
        at = values.nbytes
        self.bags: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for level in levels(self.n):
            size, more = np.frombuffer(data, "<u4", 2, at).tolist()
            keys = np.frombuffer(data, "<u4", size, at + 8).astype(U) << U(8) | np.frombuffer(data, np.uint8, size, at + 8 + 4 * size)
            counts = np.ones(size, np.int64)
            counts[size - more :] = np.frombuffer(data, "<u4", more, at + 8 + 5 * size)
            self.bags[level] = keys, counts
            at += 8 + 5 * size + 4 * more
        self.whole = int(values[-1])
        self.places = (np.append(0, places), np.append(self.n - places[::-1], self.n))
        self.values = (np.append(U(0), values[:k]), values[k:])
        self._spans: dict[tuple[int, int], np.ndarray] = {}

    def spans(self, end: int, step: int) -> np.ndarray:
        """Hashes of the spans of ``step`` from the start (``end`` 0), or to the end (1, the last one first)."""
        if (end, step) not in self._spans:
            skip = step // self.step
            at, v = (self.places[0][::skip], self.values[0][::skip]) if not end else (self.places[1][::-1][::skip][::-1], self.values[1][::-1][::skip][::-1])
            out = np.zeros(len(at) - 1, U)
            for which, (p, part) in enumerate(zip(PRIMES, (v >> U(31), v & U(0x7FFFFFFF)))):
                out = (out << U(31)) | (part[1:] + U(p) - part[:-1]) % U(p) * _inverse_table(which, int(at[-1]) + 1)[at[:-1]] % U(p)
            self._spans[end, step] = out[::-1] if end else out
        return self._spans[end, step]


def likeness(one: str | Marks, other: str | Marks) -> float:
    """1 for fingerprints of equal texts; else the share of the longer text in spans that the texts have in common (below
    1; 0 where either is empty): anchored ones wherever they stand, or grid spans at the same distance from both starts
    or from both ends, whichever is more."""
    a, b = (x if isinstance(x, Marks) else Marks(x) for x in (one, other))
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    short, long = min(a.n, b.n), max(a.n, b.n)
    if not short:
        return 0.0
    step = max(a.step, b.step)
    count = short // step
    edges = []
    for end in (0, 1):
        same = np.flatnonzero(a.spans(end, step)[:count] == b.spans(end, step)[:count]).tolist()
        edges += [(k * step, (k + 1) * step) if not end else (short - (k + 1) * step, short - k * step) for k in same]
    total, reach = 0, 0
    for x, y in sorted(edges):  # what is common both ways counts once
        total += max(0, y - max(x, reach))
        reach = max(reach, y)
    for level in a.bags.keys() & b.bags.keys():
        _, i, j = np.intersect1d(a.bags[level][0], b.bags[level][0], assume_unique=True, return_indices=True)
        common = np.minimum(a.bags[level][1][i], b.bags[level][1][j])
        total = max(total, int(common @ (a.bags[level][0][i] & U(255)).astype(np.int64)))
    return min(total / long, 1 - 1 / (2 * long))


def _range_of(cuts: list, ids: list) -> list[int]:
    """The range of each id: 0 has the largest, the last one (behind all cuts) the smallest and the null ones."""
    return [len(cuts) - (bisect.bisect_right(cuts, i) if i is not None else 0) for i in ids]


def _ranged(sent):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_range_of(sent.value, batch.column(0).to_pylist()), pa.int32()), batch.column(0)], ["range", "id"])

    return run


def _packed(sent):
    def run(batches):
        for batch in (part for batch in batches for part in slices(batch, 1)):
            said = [zlib.compress(t.encode(), 1) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(_range_of(sent.value, batch.column(0).to_pylist()), pa.int32()), batch.column(0), pa.array(said, pa.binary())], ["range", "id", "packed"])

    return run


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, packed, next_packed) where next is the document after this one in descending order of ids, the first after
    the last; packed is the zlib form of the text in UTF-8, since whole texts are shuffled; null texts are empty. Equal
    ids follow each other in an order that only their texts decide; null ids come last.

    Ids, of any type that can be sorted, are cut into ranges at quantiles of a bounded sample of them, and each range is
    ordered by itself; the more documents, the more ranges. The first text of each range also goes to the end of the range
    before it, so that the texts meet in one shuffle and no text is broadcast. Rows of one id are in one range.
    """
    rows = docs.select(column(doc_id).alias("id"), F.coalesce(column(text), F.lit("")).alias("text"))
    known = rows.where("id is not null").select("id")
    total = rows.count()
    ranges = min(MOST_RANGES, total // RANGE_ROWS)
    cuts: list = []
    if ranges > 1:
        share = min(1.0, ranges * SAMPLED / total)
        some = sorted(r["id"] for r in known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30)).distinct().limit(2 * SAMPLED * MOST_RANGES).collect())
        cuts = sorted({some[k * len(some) // ranges] for k in range(1, ranges)}) if some else []
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(cuts)
    kind = T.StructType([T.StructField("range", T.IntegerType()), rows.schema["id"], T.StructField("packed", T.BinaryType())])
    tops = rows.select("id").mapInArrow(_ranged(sent), T.StructType(kind[:2])).groupBy("range").agg(F.max("id").alias("top")).collect()  # a row a range
    if not tops:
        return rows.select("id", F.lit(b"").alias("packed"), F.lit(b"").alias("next_packed"))
    present = sorted(r["range"] for r in tops)
    before = {present[(k + 1) % len(present)]: b for k, b in enumerate(present)}
    top = spark.createDataFrame([(r["range"], r["top"], before[r["range"]]) for r in tops], T.StructType([T.StructField("of", T.IntegerType()), T.StructField("top", rows.schema["id"].dataType), T.StructField("before", T.IntegerType())]))
    # null is the top of the last range alone, where all its ids are null
    first = rows.join(F.broadcast(top), F.col("id").eqNullSafe(F.col("top"))).select("before", "id", "text")
    first = first.select(F.struct("before", "id").alias("id"), "text").mapInArrow(_firsts, "range int, packed binary").groupBy("range").agg(F.min("packed").alias("packed"))
    ends = first.select("range", F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "packed", F.lit(True).alias("end"))
    order = Window.partitionBy("range").orderBy("end", F.col("id").desc_nulls_last(), "packed")
    both = rows.mapInArrow(_packed(sent), kind).withColumn("end", F.lit(False)).unionByName(ends)
    return both.withColumn("next_packed", F.lead("packed").over(order)).where("not end").select("id", "packed", "next_packed")


def _firsts(batches):
    for batch in batches:
        said = [zlib.compress(t.encode(), 1) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).field("before"), pa.array(said, pa.binary())], ["range", "packed"])


COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "same_start")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _compare(batches):
    known: dict[bytes, tuple] = {}

    def of(text: str) -> tuple:
        h = PrefixHashes(_codes(text))
        said = fingerprint(h)
        return text, said, Marks(said), h

    def unpacked(packed: bytes) -> tuple:
        if packed not in known:  # most often the next text is the next row's own
            if len(known) > 2:
                known.clear()
            known[packed] = of(zlib.decompress(packed).decode())
        return known[packed]

    for batch in (part for batch in batches for part in slices(batch, 1, 1 << 18)):
        out = []
        for own, other in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text, a, marks_a, whole_a = unpacked(own)
            nxt, _, marks_c, _ = unpacked(other)
            n = len(text)
            edited, b, marks_b, whole_b = of(text[: n - n // 2] + nxt[: n // 2])
            out.append((n, hashlib.sha256(edited.encode()).hexdigest(), a, b, likeness(marks_a, marks_b), likeness(marks_a, marks_c), longest_common_extension(whole_a, 0, whole_b, 0)))
        columns = zip(*out) if out else [()] * len(COLUMNS)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["id", *COLUMNS])


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, same_start) of each row.

    The edited text has its last n_chars // 2 code points replaced by the first as many (or all) of the next document's,
    see ``with_next``; ``same_start`` is their longest common extension from the start. A null text is empty; a single row's next is itself. Other columns are not looked at.
    """
    pairs = with_next(docs, doc_id, text)
    kinds = (T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType(), T.LongType())
    out = pairs.mapInArrow(_compare, T.StructType([pairs.schema["id"], *[T.StructField(c, k) for c, k in zip(COLUMNS, kinds)]]))
    return out.withColumnRenamed("id", doc_id)


def add_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` after its columns (one of that name is replaced); null counts as empty."""
    start = lambda: lambda texts: [pa.array([fingerprint(PrefixHashes(_codes(t or ""))) for t in texts.to_pylist()], pa.string())]
    return Packed(docs, text, {"fingerprint": T.StringType()}).mapped(start)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
