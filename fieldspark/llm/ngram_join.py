"""N-gram Jaccard join: documents whose sets of word shingles overlap, found by signature trees.

Each text becomes its set of shingle hashes, its tokens. Equal sets are one class from here on, so that a group of copies
of any size is one row. The signature tree over the classes has its nodes in these levels, from the root down:

1. Size ranges. Classes whose sizes are further apart than the threshold allows are in ranges that are never paired.
2. Segments. A bitmap wide enough for a bit a token is cut into more segments than two sets of a range within the threshold
   may differ in tokens, so at least one segment is the same in both. A node is a segment with what it holds, its members
   all classes that agree in it; nodes with different bits in a segment aren't paired there, since all pairs within the
   threshold meet below another segment. Segments are sent as digests, and a shuffle joins members of equal ones, which
   is what makes the traversal of this level linear: a pair of nodes is never looked at unless it is one node. Members that
   meet in several nodes are joined in one of them, the cell of their least class. Common words, lines or passages don't
   gather unlike documents, because whole segments must agree.
3. Inside a cell, nodes of pairs, fours, eights ... of classes in the order of their sizes, each with the OR of its members'
   bitmaps and the range of their sizes. The dual traversal drops a pair of nodes as soon as the largest overlap that
   bitmaps and sizes allow misses the threshold, and checks the pairs of leaves that remain exactly.

A large cell is cut into blocks with its least class in each, so no task has more than one block. Cells with several
blocks and several components are looked at again: members outside the cell's largest component against all its members,
block by block. No link between different components is lost, and pairs within a component are not repeated. Components
are found by star contraction; the smallest id of a component names it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import words as W
from fieldspark.llm.components import components
from fieldspark.llm.shared import bit_table, column, in_bit_table, removed, slices, spread, table, within, written
from fieldspark.llm.signature_tree import forest

U = np.uint64
#: Sets, and tokens, of one block of a cell.
BLOCK_SETS, BLOCK_TOKENS = 1024, 1_000_000
#: Ids of documents in cells that are broadcast to fetch those documents' sets; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Cells of more than one block that are broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 200_000
#: Bits of the table that tells segments of several classes (4 MB).
SCREEN_BITS = 25
#: Names that a task remembers, so that copies within it are routed once.
REMEMBERED = 200_000
#: Ratio of the bounds of a size range at least, and deals tried for a set that fills too few buckets.
RANGE, DEALS = 1.3, 4


@lru_cache(maxsize=8)
def size_ranges(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower bounds of size ranges; for each, the most tokens in which a set of it and one as large or larger differ
    within the threshold; and the number of buckets."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, int(low[-1] * max(RANGE, 100 / percent)) + 1))
    a = np.array(low[1:], np.int64) - 1
    most = (a + a * 100 // percent) * (100 - percent) // (100 + percent)
    return np.array(low[:-1], np.int64), most, most + 1 + np.maximum(2, -(-15 * (most + 1) // 100))


def digests(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The segments of one set's bitmap: of its own size range and, where it may be the larger of a pair, the one below."""
    low, most, buckets = size_ranges(percent)
    n = len(tokens)
    home = int(np.searchsorted(low, n, "right")) - 1
    out = []
    for r in [home, home - 1] if home and n * percent <= 100 * (int(low[home]) - 1) else [home]:
        k, m = int(most[r]), int(buckets[r])
        if not k:
            continue  # only equal sets are within the threshold, and they are one class
        for deal in range(DEALS):
            t = W.mix(tokens + U(deal * 0x9E3779B9 + 1))
            at = ((t >> U(32)) % U(m)).astype(np.int64)
            sums, filled = np.zeros(m, U), np.zeros(m, bool)
            np.add.at(sums, at, W.mix(t ^ U(0xA5A5A5A5)))
            filled[at] = True
            tags = np.arange(m, dtype=U) + U((r * DEALS + deal) << 40)
            out.append(W.mix(sums[filled] ^ W.mix(tags[filled])))
            if int(filled.sum()) > k:
                break
        else:
            out.append(W.mix(W.mix(tags[~filled]) + U(1)))  # two such sets may agree in empty buckets alone
    return np.concatenate(out) if out else np.zeros(0, U)


def _sets(column: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) of each text that has words."""
    data, bounds = W.texts(column)
    for i, j in W.chunks(bounds):
        h, _, text = W.words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], W.SPACED).windows(k, True)
        cut = np.searchsorted(text, np.arange(j - i + 1))
        for x in range(j - i):
            if cut[x] < cut[x + 1]:
                yield i + x, np.unique(h[cut[x] : cut[x + 1]])


def _two(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    with np.errstate(over="ignore"):
        n = U(len(tokens))
        return int(W.mix(np.array([W.mix(tokens).sum() + n]))[0]), int(W.mix(np.array([W.mix(tokens ^ U(0x5851F42D4C957F2D)).sum() ^ (n << U(32))]))[0])


def _named(tokens: np.ndarray) -> tuple[int, str]:
    a, b = _two(tokens)
    return a - (1 << 63), f"{a:016x}{b:016x}"


def _summary(k: int, percent: int):
    """Of each row its set's size and names and, once a task for equal sets, the segments' digests."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, 1):
                count = part.num_rows
                n, node, name = np.zeros(count, np.int64), [None] * count, [None] * count
                keys: list = [None] * count
                for row, tokens in _sets(part.column(1), k):
                    n[row] = len(tokens)
                    name[row], node[row] = _named(tokens)
                    if name[row] not in seen:
                        seen.add(name[row])
                        keys[row] = digests(tokens, percent).view(np.int64)
                if len(seen) > REMEMBERED:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(node, pa.string()), pa.array(name, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "node", "name", "digests"])

    return run


def _screened(sent):
    """The segments that may be shared, as rows."""

    def run(batches):
        table = sent.value
        for batch in batches:
            lists = batch.column(0)
            digest, name = lists.flatten().to_numpy(), np.repeat(batch.column(1).to_numpy(), lists.value_lengths().to_numpy())
            keep = in_bit_table(table, digest.view(U))
            yield pa.RecordBatch.from_arrays([pa.array(digest[keep]), pa.array(name[keep])], ["digest", "name"])

    return run


def _payload(k: int):
    def run(batches):
        for batch in (part for batch in batches for part in slices(batch, 0)):
            found = [(*_named(t), len(t), t.tobytes()) for _, t in _sets(batch.column(0), k)]
            name, node, n, tokens = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array(node, pa.string()), pa.array(n, pa.int64()), pa.array(tokens, pa.binary())], ["name", "node", "n", "tokens"])

    return run


def _joined(percent: int):
    """Links of each cell block; rows come sorted by block: (cell, block, part, node, label, tokens)."""

    def links(rows):
        sets, seen = [], {}
        for node, label, tokens in rows:
            if node not in seen:
                seen[node] = label
                sets.append(np.frombuffer(tokens, U))
        nodes = list(seen)
        labels = np.unique([seen[x] or x for x in nodes], return_inverse=True)[1]
        return [(nodes[i], nodes[j]) for i, j in forest(sets, percent, labels)] if len(sets) > 1 else []

    def run(batches):
        held, rows = None, []
        for batch in (part for batch in batches for part in slices(batch, 5)):
            out = []
            c = [batch.column(i) for i in range(6)]
            for *at, node, label, tokens in zip(*(x.to_pylist() for x in c)):
                if at != held:
                    out += links(rows)
                    held, rows = at, []
                rows.append((node, label, tokens))
            yield _pairs(out)
        yield _pairs(links(rows))

    def _pairs(out):
        a, b = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])

    return run


def _links(rows: DataFrame, percent: int) -> DataFrame:
    return (
        rows.select("cell", "block", "part", "node", "label", "tokens")
        .repartition("cell", "block", "part")
        .sortWithinPartitions("cell", "block", "part")
        .mapInArrow(_joined(percent), "a string, b string")
    )


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    A text's set has its distinct shingles of ``words`` words (lower-cased A-Z, split at ASCII white space); a text of
    fewer words gives all of them as one shingle; one without words, or null, has an empty set and is linked with
    nothing. Two rows link when 100 * |intersection| >= percent * |union|. ``component_id`` is the smallest id that
    links reach, the row's own included. Rows of one id with different texts are linked only where their texts are; a
    row whose id is null has no part in the links and a null component. Other columns are not looked at.
    """
    rows = docs.select(column(doc_id).alias("id"), column(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    base = written(rows.mapInArrow(_summary(words, percent), f"id {id_type}, n long, node string, name long, digests array<long>"), "sets")
    valid = rows.where("id is not null")

    sent = base.where("id is not null and digests is not null").select("digests", "name")
    routes = sent.select(F.explode("digests").alias("digest"), "name")
    least = written(routes.groupBy("digest").agg(F.min("name").alias("cell"), F.max("name").alias("top")).where("cell < top").select("digest", "cell"), "shared-segments")
    # most segments are one class's alone: a bit table of a fixed size keeps nearly all of those out of the second shuffle
    near = sent.mapInArrow(_screened(docs.sparkSession.sparkContext.broadcast(bit_table(least, "digest", SCREEN_BITS))), "digest long, name long")
    cells = written(near.join(least, "digest").select("cell", "name").distinct(), "cells")
    whole, base = base, written(base.drop("digests"), "sets")
    removed(whole, least)

    classes = base.where("n > 0 and id is not null").groupBy("node", "name").agg(F.min("id").alias("low"), F.max("n").alias("n"))
    inside = classes.join(cells.select("name").distinct(), "name")
    wanted = written(inside.select(F.col("low").alias("id"), "name", "node", "n"), "wanted")
    ids = wanted.select("id").distinct()
    fetched = valid.join(F.broadcast(ids) if within(ids, BROADCAST_IDS) else ids, "id", "left_semi")
    sets = written(fetched.select("text").mapInArrow(_payload(words), "name long, node string, n long, tokens binary"), "payload")

    sized = cells.join(wanted.select("name", "n"), "name").groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("t"))
    blocks = sized.select("cell", F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("t") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    large = written(blocks.where("blocks > 1"), "large-cells")
    members = cells.join(F.broadcast(large) if within(large, BROADCAST_CELLS) else large, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    # the least class of a cell stands in each of its blocks
    dealt = members.select(
        "cell", "name", "blocks",
        F.explode(F.when(F.col("name") == F.col("cell"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")))).alias("block"),
    )
    dealt = written(dealt, "dealt")
    first = dealt.join(sets, "name").withColumns({"part": F.lit(0), "label": F.lit(None).cast("string")})
    links = written(_links(first, percent), "links")
    labels = components(links)

    split = dealt.where("blocks > 1")
    if not split.isEmpty():
        rest = split.select("cell", "name", "blocks", "block").join(wanted.select("name", "node"), "name").join(labels, "node", "left")
        rest = rest.withColumn("label", F.coalesce("root", "node"))
        sizes = rest.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("c"))
        largest = sizes.groupBy("cell").agg(F.max(F.struct("c", "label")).getField("label").alias("most"), F.count(F.lit(1)).alias("parts"), F.sum("c").alias("all"), F.max("c").alias("of_most")).where("parts > 1")
        rest = rest.join(largest.select("cell", "most", F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("of_most")) / BLOCK_SETS)).cast("int").alias("chunks")), "cell")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        whole = rest.select("cell", "name", "label", "block", every("chunks").alias("part"))
        apart = rest.where("label <> most").select("cell", "name", "label", every("blocks").alias("block"), F.pmod(F.xxhash64("name", F.lit(1)), F.col("chunks")).cast("int").alias("part"))
        again = whole.unionByName(apart.select("cell", "name", "label", "block", "part")).join(sets, "name")
        more = written(_links(again, percent), "links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))
        removed(more)
    removed(cells, wanted, sets, large, dealt, links)

    owned = classes.select("node", "low").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least_id = owned.groupBy("root").agg(F.min("low").alias("component_id"))
    named = owned.select("node", "root").join(least_id, "root").select("node", "component_id")
    own = lambda c: F.col(c).alias(doc_id)
    linked = base.where("n > 0 and id is not null").join(named, "node").select(own("id"), F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(base.where("n = 0 or id is null").select(own("id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spread(table(spark, sf_dir, "documents")), words=3, percent=90)


