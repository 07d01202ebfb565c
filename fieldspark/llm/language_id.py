"""Language ID by interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

A text is read as its lower-cased letters with one bound symbol for each run of anything else. Every language's model
gives each symbol a probability from the three symbols before it; the language of the lowest cross-entropy per symbol
is predicted. A text is rejected where it has no letters or where even the best model's cross-entropy lies outside of
what the calibration rows of that language show for its length, those left out whose best model isn't their label's.

The models are fitted on a sample of the learning rows of at most ``fit_docs`` different texts a language (those of the
least hash; all of them where there are fewer), counted by Spark; prediction reads every text as a whole.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldspark.llm import words as W
from fieldspark.llm.shared import Packed, removed, spread, table, written

U = np.uint64
ORDER = 4
#: The different texts of a language that its model, and its calibration, are fitted on at most.
FIT_DOCS, CALIBRATION_DOCS = 2_000, 500
#: Symbols: 0 bound, 1 letters that are not among the learned ones, from 2 the learned letters; 16 bits each.
BOUND, OTHER, MOST_LETTERS = 0, 1, 65_000
UNDETERMINED = "und"
#: Bytes of texts predicted at a time, log-probabilities held at a time, and the most languages that one table is for.
SLICE, PIECE_LOGS, MOST_LANGS = 1 << 17, 1 << 19, 1_000
#: A text is rejected beyond this quantile of the deviations of the calibration rows, and this many spreads at least.
QUANTILE, LEAST = 0.99, 6.0
#: Texts of a language from which a fifth can be set aside for calibration; with fewer it uses the fitted ones, whose
#: entropies are lower than those of new documents.
SET_ASIDE = 100
#: Nats a symbol by which whole documents differ besides (mixed, listed, repeated ones are too few to show it).
SPREAD = 0.15


def _usual(h: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Mean entropy of a language's rows, the variance between documents, and that of one symbol: a row of n symbols
    deviates by between + symbol / n. Rows far out for their length (junk with a label) count for nothing."""
    keep = np.zeros(len(h), bool)
    for part in np.array_split(np.argsort(n, kind="stable"), min(4, 1 + len(h) // 20)):
        off = np.abs(h[part] - np.median(h[part]))
        keep[part] = off <= 6 * np.median(off) + 1e-6
    between, symbol = (x.ravel() for x in np.meshgrid(np.geomspace(1e-4, 4, 24), np.geomspace(0.5, 40, 18)))
    for _ in range(3):
        best, best_loss = None, np.inf
        for a, b in zip(between, symbol):
            var = a + b / n[keep]
            mean = np.average(h[keep], weights=1 / var)
            loss = np.sum((h[keep] - mean) ** 2 / var + np.log(var))
            if loss < best_loss:
                best, best_loss = (float(mean), float(a), float(b)), loss
        again = (h - best[0]) ** 2 <= 16 * (best[1] + best[2] / n)
        if not again.any() or (again == keep).all():
            break
        keep = again
    return best


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 where it isn't a letter."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if (s := chr(c)).isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _streams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters (0: bound) of all texts and the bounds of each text; runs of bounds are one, none starts a text."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    cut = heads[bounds]
    letters = _letters()[points]
    keep = letters != 0
    first = np.zeros(len(letters) + 1, bool)
    first[cut] = True
    first = first[:-1]
    after = np.zeros(len(letters), bool)
    after[1:] = keep[:-1]
    keep |= after & ~first  # the first of a run of non-letters is its bound
    total = np.concatenate([[0], np.cumsum(keep)])
    return letters[keep], total[cut]


def _grams(symbols: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """For each symbol, it and the three before it in its text (bounds before the start), 16 bits each."""
    place = np.arange(len(symbols)) - np.repeat(cut[:-1], np.diff(cut))
    s = symbols.astype(U)
    key = s.copy()
    for back in range(1, ORDER):
        before = np.zeros(len(s), U)
        before[back:] = s[:-back] if back else s
        before[place < back] = BOUND
        key |= before << U(16 * back)
    return key


class HashTable:
    """Keys by sorted hash, found through the hash's top bits and a few steps; a row of values for each."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        h = W.mix(keys)
        order = np.argsort(h)
        self.hashes, self.values = np.append(h[order], U(2**64 - 1)), [v[order] for v in values]
        self.shift = U(64 - max(4, int(4 * len(keys)).bit_length()))
        tops = np.arange(1 << (64 - int(self.shift)), dtype=U) << self.shift
        self.start = np.searchsorted(self.hashes[:-1], tops).astype(np.int32)
        self.steps = int(np.diff(np.append(self.start, len(keys))).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether present)."""
        h = W.mix(keys)
        at = self.start[h >> self.shift]
        todo = np.flatnonzero(self.hashes[at] < h)
        for _ in range(self.steps):
            if not len(todo):
                break
            at[todo] += 1
            todo = todo[self.hashes[at[todo]] < h[todo]]
        return at, self.hashes[at] == h


class CharModels:
    """Interpolated Kneser-Ney models of order 4 over one alphabet, for all languages side by side."""

    def __init__(self, langs: list[str], letters: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]]):
        """``letters``: sorted learned letters; ``grams``: for each language packed 4-grams and their counts."""
        self.langs, self.letters = langs, letters
        size = len(letters) + 2
        below = None
        self.tables: list[HashTable] = []
        self.contexts: list[HashTable] = []
        # counts of each order: occurrences at the top, distinct symbols before it below
        orders = []
        for keys, counts in grams:
            own = {ORDER: (keys, counts.astype(np.float64))}
            for o in range(ORDER - 1, 0, -1):
                k, n = np.unique(own[o + 1][0] & U((1 << 16 * o) - 1), return_counts=True)
                own[o] = (k, n.astype(np.float64))
            orders.append(own)
        for o in range(1, ORDER + 1):
            union = np.unique(np.concatenate([x[o][0] for x in orders]))
            context = union >> U(16)
            heads = np.unique(context)
            p, back = np.empty((len(union), len(langs))), np.empty((len(heads), len(langs)))
            lower = below[0][np.searchsorted(below[1], union & U((1 << 16 * (o - 1)) - 1))] if o > 1 else np.full((len(union), len(langs)), 1 / size)
            for i, own in enumerate(orders):
                keys, counts = own[o]
                once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
                d = once / (once + 2 * twice) if once and twice else 0.5
                at = np.searchsorted(heads, keys >> U(16))
                total, kinds = np.bincount(at, counts, len(heads)), np.bincount(at, minlength=len(heads))
                back[:, i] = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
                own_p = np.zeros(len(union))
                own_p[np.searchsorted(union, keys)] = np.maximum(counts - d, 0) / total[at]
                p[:, i] = own_p + back[np.searchsorted(heads, context), i] * lower[:, i]
            below = (p, union)
            self.tables.append(HashTable(union, np.log(p).astype(np.float32)))
            self.contexts.append(HashTable(heads, np.log(back).astype(np.float32)))
        self.unseen = np.float32(-np.log(size))
        self.calibration = None

    def symbols(self, letters: np.ndarray) -> np.ndarray:
        table = self.__dict__.get("_table")
        if table is None:
            table = np.full(sys.maxunicode + 1, OTHER, np.uint16)
            table[self.letters] = np.arange(2, len(self.letters) + 2)
            table[0] = BOUND
            self._table = table
        return table[letters]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def _log(self, keys: np.ndarray, o: int) -> np.ndarray:
        """log p of the last symbol of each packed gram of order ``o``, a column for each language."""
        if o == 0:
            return np.full((len(keys), len(self.langs)), self.unseen, np.float32)
        keys = keys & U((1 << 16 * o) - 1) if o < 4 else keys
        at, ok = self.tables[o - 1].find(keys)
        out = self.tables[o - 1].values[0][np.minimum(at, len(self.tables[o - 1].values[0]) - 1)]
        miss = np.flatnonzero(~ok)
        if len(miss):
            lost = self._log(keys[miss], o - 1)
            c, known = self.contexts[o - 1].find(keys[miss] >> U(16))
            lost[known] += self.contexts[o - 1].values[0][c[known]]
            out[miss] = lost
        return out

    def entropies(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text: nats per symbol under each language, and its symbols (0: no letters)."""
        letters, cut = _streams(data, bounds)
        n = np.diff(cut)
        out = np.zeros((len(n), len(self.langs)))
        grams = _grams(self.symbols(letters), cut) if len(letters) else np.zeros(0, U)
        step = max(1, PIECE_LOGS // len(self.langs))
        for a in range(0, len(grams), step):  # a long text, or one of many languages, is summed piece by piece
            logs = self._log(grams[a : a + step], ORDER)
            first = max(0, int(np.searchsorted(cut, a, "right")) - 1)
            last = int(np.searchsorted(cut, a + len(logs), "left"))
            some = first + np.flatnonzero(n[first:last])
            out[some] -= np.add.reduceat(logs, np.maximum(cut[some] - a, 0), axis=0, dtype=np.float64)
        return out / np.maximum(n, 1)[:, None], n

    def calibrate(self, entropies: np.ndarray, n: np.ndarray, truth: np.ndarray) -> None:
        """Sets each language's usual entropy and spreads, the bound of deviations, and the sharpness of the scores."""
        root = np.sqrt(n)
        clean = entropies.argmin(axis=1) == truth if len(truth) else np.zeros(0, bool)
        mean, between, symbol = np.full(len(self.langs), -float(self.unseen)), np.ones(len(self.langs)), np.ones(len(self.langs))
        for i in range(len(self.langs)):
            own = clean & (truth == i)
            if own.any():
                mean[i], between[i], symbol[i] = _usual(entropies[own, i], n[own])
        between += SPREAD**2
        low, best = entropies[clean, truth[clean]], truth[clean]
        z = (low - mean[best]) / np.sqrt(between[best] + symbol[best] / n[clean])
        bound = max(LEAST, float(np.quantile(z, QUANTILE))) if len(z) else LEAST
        best, sharp = np.inf, 1.0
        for t in np.geomspace(0.01, 10, 31) if len(truth) else []:
            x = -entropies * root[:, None] * t
            x -= x.max(axis=1, keepdims=True)
            loss = -np.mean(x[np.arange(len(truth)), truth] - np.log(np.exp(x).sum(axis=1)))
            if loss < best:
                best, sharp = loss, float(t)
        self.calibration = mean, between, symbol, bound, sharp

    def predict(self, data: np.ndarray, bounds: np.ndarray):
        """(language or ``und``, score, rejected, entropy) lists."""
        h, n = self.entropies(data, bounds)
        mean, between, symbol, bound, sharp = self.calibration
        best = h.argmin(axis=1)
        x = -h * np.sqrt(n)[:, None] * sharp
        x = np.exp(x - x.max(axis=1, keepdims=True))
        score = np.where(n > 0, x.max(axis=1) / x.sum(axis=1), 0.0)
        low = h[np.arange(len(n)), best]
        rejected = (n == 0) | (low - mean[best] > bound * np.sqrt(between[best] + symbol[best] / np.maximum(n, 1)))
        return [self.langs[b] if k else UNDETERMINED for b, k in zip(best, n)], score, rejected, low


def sample(rows: DataFrame, fit_docs: int, calibration_docs: int) -> DataFrame:
    """(lang, text, fitted, measured): the texts that models are fitted on and those that they are calibrated on.

    Different texts of a language count, not their copies: the ``fit_docs`` of the least hash are fitted, and the next
    ``calibration_docs`` measured, exactly. Of a language with fewer, a fifth is measured, or all are for both. No
    language is left out, and none has more than the two numbers together.
    """
    hashed = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    n = hashed.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))  # a row a language
    # with some to spare, the texts below a share of all hashes; what is sent on is bounded whatever the table's size
    share = 1.5 * (fit_docs + calibration_docs) / F.col("n")
    near = hashed.join(F.broadcast(n), "lang").where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    texts = near.groupBy("lang", "h").agg(F.first("text").alias("text"))
    place = texts.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")))
    all_of = place.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    few = F.col("m") < fit_docs + calibration_docs
    fifth = F.ceil(F.when(F.col("m") >= SET_ASIDE, 0.8).otherwise(1.0) * F.col("m"))
    last = F.when(few, F.least(fifth, F.lit(fit_docs))).otherwise(fit_docs)
    fitted = F.col("k") <= last
    measured = F.when(few & (F.col("m") < SET_ASIDE), F.lit(True)).otherwise(~fitted & (F.col("k") <= last + calibration_docs))
    return all_of.select("lang", "text", fitted.alias("fitted"), measured.alias("measured")).where("fitted or measured")


def fit(rows: DataFrame, fit_docs: int = FIT_DOCS, calibration_docs: int = CALIBRATION_DOCS) -> CharModels | None:
    """Models of the languages in ``rows`` (text, lang); None where no row has both. Rows with a null in either count for
    nothing, and so do texts without letters. More than ``MOST_LANGS`` languages are an error."""
    rows = rows.select("text", F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    chosen = written(sample(rows, fit_docs, calibration_docs).repartition(cores), "language-sample")
    if len(chosen.select("lang").distinct().limit(MOST_LANGS + 1).collect()) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            data, bounds = W.texts(batch.column(0))
            out = []
            for i, j in W.chunks(bounds):
                letters, cut = _streams(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                place = np.arange(len(letters)) - np.repeat(cut[:-1], np.diff(cut))
                back = [np.where(place >= k, np.concatenate([np.zeros(k, np.uint32), letters[: len(letters) - k]]) if k else letters, 0) for k in range(ORDER)]
                for lang in set(langs[i:j]):
                    own = np.repeat(langs[i:j] == lang, np.diff(cut))
                    a, n = np.unique(np.stack([x[own] for x in back[::-1]], axis=1), axis=0, return_counts=True)
                    out.append((np.full(len(n), lang, object), a, n))
            if out:
                a = np.concatenate([x[1] for x in out]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[0] for x in out]), pa.string()), *[pa.array(a[:, k]) for k in range(ORDER)], pa.array(np.concatenate([x[2] for x in out]))],
                    ["lang", "a", "b", "c", "d", "n"],
                )

    grams = chosen.where("fitted").select("text", "lang").mapInArrow(count, "lang string, a long, b long, c long, d long, n long").groupBy("lang", "a", "b", "c", "d").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    if not len(grams):
        return None
    points = grams[["a", "b", "c", "d"]].to_numpy()
    seen, often = np.unique(np.repeat(points[:, 3], grams["n"].clip(upper=50)), return_counts=True)
    letters = np.sort(seen[np.argsort(-often, kind="stable")][: MOST_LETTERS + 1])
    letters = letters[letters > 0]
    langs = sorted(grams["lang"].unique())
    symbol = np.where(points == 0, BOUND, OTHER).astype(U)
    at = np.minimum(np.searchsorted(letters, points), len(letters) - 1)
    symbol = np.where((points > 0) & (letters[at] == points), at + 2, symbol).astype(U)
    key = (symbol[:, 0] << U(48)) | (symbol[:, 1] << U(32)) | (symbol[:, 2] << U(16)) | symbol[:, 3]
    packed = []
    for lang in langs:
        own = (grams["lang"] == lang).to_numpy()
        k, inverse = np.unique(key[own], return_inverse=True)
        packed.append((k, np.bincount(inverse, grams["n"].to_numpy()[own])))
    models = CharModels(langs, letters, packed)

    held = models

    def measure(batches):
        for batch in batches:
            data, bounds = W.texts(batch.column(0))
            index = {lang: i for i, lang in enumerate(held.langs)}
            truth = np.array([index.get(x, -1) for x in batch.column(1).to_pylist()])
            h, n = zip(*[held.entropies(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]) for i, j in W.chunks(bounds)]) if len(truth) else ([np.zeros((0, len(held.langs)))], [np.zeros(0, np.int64)])
            h, n = np.concatenate(h), np.concatenate(n)
            ok = (n > 0) & (truth >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(list(h[ok]), pa.list_(pa.float64())), pa.array(n[ok].astype(np.int64)), pa.array(truth[ok].astype(np.int64))], ["h", "n", "truth"])

    seen = chosen.where("measured").select("text", "lang").mapInArrow(measure, "h array<double>, n long, truth long").toArrow().to_pandas()
    h = np.stack(seen["h"].to_numpy()) if len(seen) else np.zeros((0, len(langs)))
    models.calibrate(h, seen["n"].to_numpy(), seen["truth"].to_numpy())
    removed(chosen)
    return models


PREDICTED = {"lang_pred": T.StringType(), "score": T.DoubleType(), "rejected": T.BooleanType(), "entropy": T.DoubleType()}


def predict(docs: DataFrame, models: CharModels | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``rejected`` and ``entropy`` (nats per symbol).

    A null text, or one without letters, is ``und`` with score 0 and rejected; so is every text where there are no
    models. Only the text is looked at. Columns of ``docs`` of the four new names are replaced, others pass through
    (without ``keep_text`` the text doesn't); repeated rows get equal results, an empty table gives an empty one.
    """
    packed = Packed(docs, text, PREDICTED, keep_text)
    if models is None:
        return packed.unpacked(packed.rows, F.lit(UNDETERMINED), F.lit(0.0), F.lit(True), F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def start():
        own = sent.value

        def run(texts: pa.Array) -> list:
            lang, score, rejected, entropy = own.predict(*W.texts(texts))
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_()), pa.array(entropy, pa.float64())]

        return run

    return packed.mapped(start, SLICE)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learning_rows(docs: DataFrame) -> DataFrame:
    """Text and language of the documents to learn from: those with a language, an id and another remainder than 2."""
    return docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    models = fit(learning_rows(docs))
    out = predict(docs.select("doc_id", "text"), models, keep_text=False)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected", "entropy")
