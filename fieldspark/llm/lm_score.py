"""Masked pseudo-likelihood of texts under a bidirectional window network trained in numpy.

Every token (lower-cased alphanumeric word) is predicted from the two before and the two after it, itself hidden: first
its class, then which of the class's ids it has, both by softmax over the same hidden layer. A text's score is the sum of
the log-probabilities of all its tokens. The most frequent words have ids of their own. Each other word shares one by hash
and has in it its own share of the corpus, for which the counts of all words stay a table that is joined to occurrences;
so the probabilities of all words of the corpus sum to one in every context.

What is learned comes from all documents: Spark counts every word, and every position of every text trains the network
once. Texts are dealt to shards by a hash of their rows, each shard trains from the same weights in the order of those
hashes, and the shards' weights are averaged by the positions they saw, in a tree of a few sets a task. Neither the files'
layout nor the number of tasks changes the result. Only the vocabulary, whose size is a parameter, and a few sets of
weights come to the driver.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm import words as W
from fieldspark.llm.shared import Packed, column, removed, slices, spread, table, written

U = np.uint64
WINDOW = 2
#: Tokens of one piece of a text for training (what lies beyond a piece counts as outside the text), and of one step of
#: scoring.
PIECE, STEP = 1 << 16, 1 << 14
#: Sets of weights that one task, or the driver, averages.
MEAN = 16


@dataclass(frozen=True)
class Settings:
    """Words with ids of their own; ids that all other words share, by hash; ids of a class; sizes of embeddings and hidden
    layer; rounds, of which each trains on the positions of one remainder, so that all train once; positions of a shard
    and the most shards (more positions make them larger); positions of a batch; step size (Adagrad) and seed."""

    vocabulary: int = 2304
    rare: int = 384
    width: int = 48
    embedding: int = 12
    hidden: int = 16
    rounds: int = 2
    shard: int = 2_000_000
    most_shards: int = 4096
    batch: int = 8192
    rate: float = 0.06
    seed: int = 7


class Vocabulary:
    """Ids of word hashes: the most frequent words by falling count, then, from the next full class on, shared ids."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, rare_counts: np.ndarray, rare_kinds: np.ndarray, s: Settings):
        """``hashes``, ``counts``: the most frequent words; ``rare_*``: occurrences and kinds of the others by shared id."""
        order = np.lexsort((hashes, -counts))
        at = np.argsort(hashes[order])
        self.sorted, self.ids = hashes[order][at], at
        self.size, self.rare, self.width = len(order), s.rare, s.width
        self.first_rare = -(-self.size // s.width) * s.width
        self.classes = (self.first_rare + -(-s.rare // s.width) * s.width) // s.width
        self.outside = self.classes * s.width  # what is outside the text
        n = np.zeros(self.outside)
        n[: self.size] = counts[order]
        n[self.first_rare : self.first_rare + s.rare] = np.maximum(rare_counts, 0.5)
        n = n.reshape(self.classes, s.width)
        mass = n.sum(axis=1)
        self.log_class = np.log(np.maximum(mass, 0.5) / max(mass.sum(), 1)).astype(np.float32)
        self.log_inside = np.where(n > 0, np.log(np.maximum(n, 0.5) / np.maximum(mass, 0.5)[:, None]), -1e4).astype(np.float32)
        # of one of a shared id's words: all equal, or, see ``score``, one occurrence's share
        self.even, self.one = np.zeros(self.outside, np.float32), np.zeros(self.outside, np.float32)
        own = slice(self.first_rare, self.first_rare + s.rare)
        self.even[own], self.one[own] = -np.log(np.maximum(rare_kinds, 1)), -np.log(np.maximum(rare_counts, 1))

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        out = self.first_rare + (hashes % U(self.rare)).astype(np.int64)
        if self.size:
            at = np.minimum(np.searchsorted(self.sorted, hashes), self.size - 1)
            hit = self.sorted[at] == hashes
            out[hit] = self.ids[at[hit]]
        return out


def contexts(ids: np.ndarray, first: np.ndarray, outside: int) -> np.ndarray:
    """The four neighbours of every token within its text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(ids))
    out = np.full((len(ids), 2 * WINDOW), outside, np.int64)
    for k, d in enumerate([*range(-WINDOW, 0), *range(1, WINDOW + 1)]):
        near = at + d
        ok = (near >= first[text]) & (near < first[text + 1])
        out[ok, k] = ids[near[ok]]
    return out


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(x), in place, and its sums by row (as a product, which is faster than a sum along short rows). What is beyond
    the range of floats is cut to it, alike in training and scoring."""
    np.exp(np.minimum(x, 80, out=x), out=x)
    return x, np.maximum(x @ np.ones(x.shape[1], np.float32), 1e-30)


def _softmax(x: np.ndarray) -> np.ndarray:
    x, total = _exp(x)
    x /= total[:, None]
    return x


def by_class(classes: np.ndarray):
    """(class, places) of each class that occurs."""
    order = np.argsort(classes.astype(np.uint16), kind="stable")  # of 16 bits: sorted by radix
    cut = np.flatnonzero(np.diff(classes[order], prepend=-1))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
        yield int(classes[order[a]]), order[a:b]


class Network:
    """p(class | neighbours) and p(id | class, neighbours): embeddings, one layer of tanh fed by a matrix for each
    neighbour's place, and two levels of softmax. It begins as the unigram model."""

    def __init__(self, v: Vocabulary, s: Settings):
        r = np.random.default_rng(s.seed)
        f = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.width = v.width
        self.weights = [
            f(v.outside + 1, s.embedding, scale=0.1), f(2 * WINDOW, s.embedding, s.hidden, scale=0.3), np.zeros(s.hidden, np.float32),
            f(s.hidden, v.classes, scale=0.01), v.log_class.copy(), f(v.classes, s.hidden, v.width, scale=0.01), v.log_inside.copy(),
        ]
        self.squares: list[np.ndarray] | None = None

    def step(self, near: np.ndarray, ids: np.ndarray, rate: float) -> None:
        """One Adagrad step on the summed cross-entropy of a batch."""
        if self.squares is None:
            self.squares = [np.full(w.shape if k else len(w), 1e-2, np.float32) for k, w in enumerate(self.weights)]
        e, m, b, u, c, w, v = self.weights

        def move(k: int, part, g: np.ndarray) -> None:
            self.squares[k][part] += g * g
            self.weights[k][part] -= rate * g / np.sqrt(self.squares[k][part])

        n = len(near)
        flat = m.reshape(-1, m.shape[2])
        x = e[near].reshape(n, -1)
        h = np.tanh(x @ flat + b)
        classes, place = ids // self.width, ids % self.width
        p = _softmax(h @ u + c)
        p[np.arange(n), classes] -= 1
        dh = p @ u.T
        for k, rows in by_class(classes):
            own = h[rows]
            q = _softmax(own @ w[k] + v[k])
            q[np.arange(len(rows)), place[rows]] -= 1
            dh[rows] += q @ w[k].T
            move(5, k, own.T @ q)
            move(6, k, q.sum(axis=0))
        move(3, ..., h.T @ p)
        move(4, ..., p.sum(axis=0))
        dh *= 1 - h * h
        dx = (dh @ flat.T).reshape(n * 2 * WINDOW, -1)
        move(1, ..., (x.T @ dh).reshape(m.shape))
        move(2, ..., dh.sum(axis=0))
        # embeddings: sums of rows of equal tokens, with one step size a row
        tokens = near.ravel()
        order = np.argsort(tokens.astype(np.uint16), kind="stable")
        cut = np.flatnonzero(np.diff(tokens[order], prepend=-1))
        own, g = tokens[order][cut], np.add.reduceat(dx[order], cut, axis=0)
        self.squares[0][own] += (g * g).mean(axis=1)
        e[own] -= rate * g / np.sqrt(self.squares[0][own])[:, None]

    def pack(self) -> bytes:
        return np.concatenate([w.ravel() for w in self.weights]).astype("<f4").tobytes()

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for k, w in enumerate(self.weights):
            self.weights[k] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size


def _tokens(texts: pa.Array):
    """Words of chunks of some texts."""
    data, bounds = W.texts(texts)
    for i, j in W.chunks(bounds):
        yield i, j, W.words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], W.ALNUM)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word long, n long): how often each word, by its 64-bit hash, occurs in all documents."""

    def count(batches):
        for batch in batches:
            for _, _, w in _tokens(batch.column(0)):
                h, n = np.unique(w.hash, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["word", "n"])

    return docs.select(column(text).alias("text")).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _shared_id(rare: int):
    """The remainder of the unsigned hash, as the lookup takes it."""
    return F.expr(f"cast(pmod(pmod(word, {rare}) + case when word < 0 then {pow(2, 64, rare)} else 0 end, {rare}) as int)")


def vocabulary(counts: DataFrame, s: Settings) -> Vocabulary:
    top = counts.orderBy(F.desc("n"), "word").limit(s.vocabulary).collect()
    known = counts.sparkSession.createDataFrame([(r["word"],) for r in top], "word long")
    rest = counts.join(F.broadcast(known), "word", "left_anti").groupBy(_shared_id(s.rare).alias("id")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    n, kinds = np.zeros(s.rare), np.zeros(s.rare)
    for r in rest:  # a row for each shared id
        n[r["id"]], kinds[r["id"]] = r["n"], r["kinds"]
    return Vocabulary(np.array([r["word"] for r in top], np.int64).view(U), np.array([r["n"] for r in top], np.float64), n, kinds, s)


def _trained(start: tuple[Vocabulary, Network], s: Settings, turn: int):
    """For rows sorted by shard, (shard, seen, weights) after training on the positions of this turn."""

    def one(v: Vocabulary, net: Network, rows) -> tuple[int, bytes] | None:
        near, goal, held, seen = [], [], 0, 0
        random = np.random.default_rng(s.seed + turn)

        def flush(last: bool) -> None:
            nonlocal near, goal, held, seen
            x, y = np.concatenate(near), np.concatenate(goal)
            whole = len(y) if last else len(y) - len(y) % s.batch
            order = random.permutation(whole)
            for k in range(0, whole, s.batch):
                net.step(x[order[k : k + s.batch]], y[order[k : k + s.batch]], s.rate / (1 + turn))
            near, goal, held, seen = [x[whole:]], [y[whole:]], len(y) - whole, seen + whole

        def add(texts: list[bytes]) -> None:
            nonlocal held
            ids = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
            first = np.cumsum([0, *(len(t) // 2 for t in texts)])
            at = np.flatnonzero((np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))) % s.rounds == turn % s.rounds)
            near.append(contexts(ids, first, v.outside)[at])
            goal.append(ids[at])
            held += len(at)

        some, size = [], 0
        for packed in rows:
            some.append(packed)
            size += len(packed) // 2
            if size >= PIECE:
                add(some)
                some, size = [], 0
                if held >= 8 * s.batch:
                    flush(False)
        if some:
            add(some)
        if held:
            flush(True)
        return (seen, net.pack()) if seen else None

    def run(batches):
        v, first = start.value
        rows = ((shard, ids) for batch in batches for shard, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for shard, group in itertools.groupby(rows, key=lambda r: r[0]):
            net = Network(v, s)
            net.weights = [w.copy() for w in first.weights]
            if found := one(v, net, (ids for _, ids in group)):
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([found[0]], pa.int64()), pa.array([found[1]], pa.binary())], ["shard", "seen", "weights"])

    return run


def _mean(rows) -> tuple[int, bytes]:
    total, n = 0.0, 0
    for seen, packed in rows:
        total, n = total + np.frombuffer(packed, "<f4").astype(np.float64) * seen, n + seen
    return n, (total / n).astype("<f4").tobytes()


def _means(batches):
    rows = ((*r,) for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
    for group, own in itertools.groupby(rows, key=lambda r: r[0]):
        n, packed = _mean((seen, weights) for _, _, seen, weights in own)
        yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([n], pa.int64()), pa.array([packed], pa.binary())], ["shard", "seen", "weights"])


def train(docs: DataFrame, s: Settings = Settings(), text: str = "text", counts: DataFrame | None = None) -> tuple[Vocabulary, Network]:
    """Vocabulary and network of the documents' words. Null and empty texts give nothing; without any words the network
    stays the unigram model that it begins as. Rows that are equal in all columns are in one shard. ``counts``: the
    documents' ``word_counts``, where they are at hand."""
    if s.vocabulary + s.rare + 2 * s.width > 1 << 16:
        raise ValueError("ids have 16 bits")
    own = None if counts is not None else written(word_counts(docs, text), "word-counts")
    counts = own if counts is None else counts
    v = vocabulary(counts, s)
    net = Network(v, s)
    spark = docs.sparkSession
    tokens = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, min(s.most_shards, -(-tokens // s.shard)))
    sent = spark.sparkContext.broadcast(v)

    def encode(batches):
        v = sent.value
        for batch in (part for batch in batches for part in slices(batch, 1)):
            key, place, ids = [], [], []
            for i, j, w in _tokens(batch.column(1)):
                found = v.lookup(w.hash).astype("<u2")
                for k in range(i, j):
                    said = found[w.first[k - i] : w.first[k - i + 1]]
                    for a in range(0, len(said), PIECE):
                        key.append(k)
                        place.append(a)
                        ids.append(said[a : a + PIECE].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(key, pa.int64())), pa.array(place, pa.int64()), pa.array(ids, pa.binary())], ["key", "place", "ids"])

    if tokens:
        keyed = docs.select(F.xxhash64(*[column(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]).alias("key"), column(text).alias("text"))
        encoded = written(keyed.mapInArrow(encode, "key long, place long, ids binary"), "encoded")
        dealt = encoded.select(F.pmod(F.xxhash64("key", "place"), F.lit(shards)).cast("int").alias("shard"), "ids", "key", "place")
        for turn in range(s.rounds):
            start = spark.sparkContext.broadcast((v, net))
            parts = dealt.repartition("shard").sortWithinPartitions("shard", "key", "place", "ids").select("shard", "ids").mapInArrow(_trained(start, s, turn), "shard int, seen long, weights binary")
            left = shards
            while left > MEAN:
                left = -(-left // MEAN)
                grouped = parts.select(F.floor(F.col("shard") / MEAN).cast("int").alias("group"), "shard", "seen", "weights")
                parts = grouped.repartition("group").sortWithinPartitions("group", "shard").mapInArrow(_means, "shard int, seen long, weights binary")
            found = sorted(parts.collect())
            if found:
                net.unpack(np.frombuffer(_mean((r["seen"], r["weights"]) for r in found)[1], "<f4"))
        removed(encoded)
    if own is not None:
        removed(own)
    return v, net


class Scorer:
    """Scores texts; the first layer is applied to each token's embedding once, for each of the four places."""

    def __init__(self, v: Vocabulary, net: Network, even: bool):
        self.v, self.net, self.share = v, net, v.even if even else v.one
        self.placed = np.einsum("te,peh->pth", net.weights[0], net.weights[1]).astype(np.float32)

    def tokens(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log p of every token given its neighbours."""
        near = contexts(ids, first, self.v.outside)
        out = self.share[ids]
        _, _, b, u, c, w, v = self.net.weights
        for k in range(0, len(ids), STEP):
            part = slice(k, k + STEP)
            h = self.placed[0][near[part, 0]]
            for p in range(1, 2 * WINDOW):
                h += self.placed[p][near[part, p]]
            h += b
            np.tanh(h, out=h)
            classes, place = ids[part] // self.v.width, ids[part] % self.v.width
            x = h @ u + c
            own = np.minimum(x[np.arange(len(x)), classes], 80)
            own -= np.log(_exp(x)[1])
            for n, rows in by_class(classes):
                x = h[rows] @ w[n] + v[n]
                said = np.minimum(x[np.arange(len(rows)), place[rows]], 80)
                own[rows] += said - np.log(_exp(x)[1])
            out[part] += own
        return out


SCORES = {"n_tokens": T.LongType(), "log_prob": T.DoubleType(), "per_token": T.DoubleType()}


def score(docs: DataFrame, model: tuple[Vocabulary, Network], text: str = "text", counts: DataFrame | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``log_prob`` (sum over all tokens, nats) and ``per_token`` (their mean) after its
    columns. A null or wordless text has no tokens, 0.0 and null. Columns of the three names are replaced, others pass
    through (without ``keep_text`` the text doesn't); null and repeated ids and rows are rows like others.

    With ``counts``, the ``word_counts`` that the model comes from, each rare word has its own share of its shared id
    (a word that they lack counts as once seen); without them the words of a shared id have equal ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    packed = Packed(docs, text, SCORES, keep_text)
    even = counts is None

    def start():
        scorer = Scorer(*sent.value, even)
        v = scorer.v

        def run(texts: pa.Array) -> list:
            n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            word, often, sizes = [], [], np.zeros(len(texts), np.int64)
            for i, j, w in _tokens(texts):
                n[i:j] = np.diff(w.first)
                some = np.flatnonzero(n[i:j])
                if not len(some):
                    continue
                ids = v.lookup(w.hash)
                total[i + some] = np.add.reduceat(scorer.tokens(ids, w.first), w.first[:-1][some], dtype=np.float64)
                at = np.flatnonzero(ids >= v.first_rare)
                if even or not len(at):
                    continue
                own, h = np.repeat(np.arange(i, j), n[i:j])[at], w.hash[at]  # different rare words of each text
                order = np.lexsort((h, own))
                own, h = own[order], h[order]
                cut = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (h[1:] != h[:-1])]))
                word.append(h[cut].view(np.int64))
                often.append(np.diff(np.append(cut, len(h))))
                sizes += np.bincount(own[cut], minlength=len(texts))
            mean = pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0)
            found = [pa.array(n), pa.array(total), mean]
            if not even:
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                found += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))) for x in (word, often)]
            return found

        return run

    if even:
        return packed.mapped(start)
    lists = T.ArrayType(T.LongType())
    inner = Packed(packed.rows, "text", SCORES | {"words": lists, "often": lists}, packed.keeps_text).mapped(start)
    rows = inner.withColumn("rid", F.monotonically_increasing_id())
    head = F.struct(*[c for c in ("row", "text", "n_tokens", "log_prob") if c in rows.columns])
    cut = rows.select("rid", head.alias("head"), "often", F.posexplode_outer("words").alias("pos", "word"))
    first = F.coalesce("pos", F.lit(0)) == 0  # a text stays with its first rare word; one without any is spread
    cut = cut.select("rid", F.when(first, F.col("head")).alias("head"), F.element_at("often", F.col("pos") + 1).alias("times"), F.coalesce("word", F.xxhash64("rid")).alias("word"))
    met = cut.join(counts.hint("shuffle_hash"), "word", "left")
    done = met.groupBy("rid").agg(F.first("head", ignorenulls=True).alias("head"), F.coalesce(F.sum(F.col("times") * F.log("n")), F.lit(0.0)).alias("lift"))
    total, n = F.col("head.log_prob") + F.col("lift"), F.col("head.n_tokens")
    out = done.select(F.col("head.row").alias("row"), *([F.col("head.text").alias("text")] if packed.keeps_text else []), n.alias("n"), total.alias("total"))
    return packed.unpacked(out, F.col("n"), F.col("total"), F.when(F.col("n") > 0, F.col("total") / F.col("n")))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = written(word_counts(docs), "word-counts")
    return score(docs, train(docs, counts=counts), counts=counts, keep_text=False)
