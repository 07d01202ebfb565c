"""Byte-level BPE by tree concatenation: halves of long texts are encoded in parallel, then growing windows around each
join are encoded again until both sides agree exactly.

A text of at most ``leaf_chars`` code points is a leaf. A longer one is halved until all parts are leaves; the leaves go
to different tasks, and the parts of one text come together again in text order for the joins. ``join`` states why the
result is exactly the encoding of the whole text.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm.shared import Packed, spread, table

LEAF_CHARS = 32_768
#: Code points before the end of a text in which what follows may still move a word bound: the longest added token, a
#: contraction or a blank looked ahead for are all shorter.
MARGIN = 16
#: Tokens on each side of a join inside one long word in the first window; doubled while the sides disagree.
FIRST_WINDOW = 4
#: Space-separated units whose encodings a task keeps: the last ones used, from once to twice so many (some 200 bytes each),
#: and the longest that it keeps.
KEPT_UNITS, UNIT_CHARS = 100_000, 64
#: One space between characters that aren't white space: a word of the tokenizer begins there in every context.
UNIT_BOUND = re.compile(r"(?<=\S) (?=\S)")


class Encoded:
    """Token ids of a text, which of them begin a word of the tokenizer, and the text's code points."""

    def __init__(self, text: str, ids: np.ndarray, begins: np.ndarray):
        self.text, self.ids, self.begins = text, ids, begins


class TreeBpe:
    """Encodes leaves with the tokenizer in ``path`` and joins encodings."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.said = [self.lib.id_to_token(i) or "" for i in range(size)]
        own = {i for i, t in self.lib.get_added_tokens_decoder().items()}
        self.bytes_of = np.array([len(s.encode()) if i in own else len(s) for i, s in enumerate(self.said)], np.int64)
        self.forget()

    def forget(self) -> None:
        """Begin with no kept units, as every task does."""
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}  # units whose ids decode to another text

    # leaves

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of texts that each begin with a space that is a word bound: encoded as one text and cut at their bytes."""
        if not units:
            return []
        said = "".join(units)
        ids = np.array(self.lib.encode(said, add_special_tokens=False).ids, "<u4")
        ends = np.cumsum(self.bytes_of[ids])
        cut = np.searchsorted(ends, np.cumsum([len(u.encode()) for u in units])) + 1
        if self.lib.decode(ids.tolist(), skip_special_tokens=False) != said:
            self.odd |= {u: d for u in units if (d := self.decode(np.array(self.lib.encode(u, add_special_tokens=False).ids, "<u4").tobytes())) != u}
        raw, a = ids.tobytes(), 0
        out = []
        for b in cut.tolist():
            out.append(raw[4 * a : 4 * b])
            a = b
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit numbers, decoded text) of each text; each different unit is encoded once."""
        out = []
        for k in range(0, len(texts), 256):
            cut = [UNIT_BOUND.split(text) for text in texts[k : k + 256]]
            heads = [np.array(self.lib.encode(c[0], add_special_tokens=False).ids, "<u4").tobytes() for c in cut]
            young, old, own, missing = self.young, self.old, {}, []
            for u in set().union(*(c[1:] for c in cut)):
                ids = young.get(u)
                if ids is None:
                    ids = old.get(u)
                    if ids is None:
                        missing.append(u)
                        continue
                    young[u] = ids
                own[u] = ids
            for u, ids in zip(missing, self._units([" " + u for u in missing])):
                own[u] = ids
                if len(u) <= UNIT_CHARS:
                    young[u] = ids
            if len(young) > KEPT_UNITS:
                self.old, self.young = young, {}
            for text, head, (first, *rest) in zip(texts[k : k + 256], heads, cut):
                back = text
                if self.odd or not self._returns(first, head):
                    back = self.decode(head) + "".join(self.odd.get(" " + u, " " + u) for u in rest)
                out.append((head + b"".join([own[u] for u in rest]), back))
        return out

    def _returns(self, text: str, ids: bytes) -> bool:
        return self.decode(ids) == text

    def leaf(self, text: str) -> Encoded:
        found = self.lib.encode(text, add_special_tokens=False)
        words = np.array([-1, *(-2 if w is None else w for w in found.word_ids)], np.int64)
        return Encoded(text, np.array(found.ids, "<u4"), (words[1:] != words[:-1]) | (words[1:] == -2))

    # joins

    def _begin_chars(self, e: Encoded, tokens: np.ndarray, from_end: bool) -> np.ndarray:
        """Code points from the text's start (or end) to each of ``tokens``, which begin words, nearest first."""
        sizes = self.bytes_of[e.ids]
        total = int(sizes.sum())
        starts = np.cumsum(sizes) - sizes
        raw = e.text.encode()
        if from_end:
            return np.array([len(raw[int(starts[t]) : total].decode()) for t in tokens], np.int64)
        return np.array([len(raw[: int(starts[t])].decode()) for t in tokens], np.int64)

    def join(self, a: Encoded, b: Encoded) -> Encoded:
        """The encoding of a.text + b.text.

        Words of the tokenizer are found from left to right, and what follows a word's end depends on nothing before it.
        A word of ``a`` that ends MARGIN before a's end is a word of the whole text too, so the window may start there.
        It ends in ``b``, where a word begins both for ``b`` and for the window, MARGIN before the window's end; from
        there on the encoding is b's. The window doubles until there is such a place or b ends.

        Inside one word that runs over the join on both sides, the window has k tokens of each. If its encoding begins
        with the first and ends with the last of them, all neighbours in the joined sequence are neighbours in a right
        encoding, which makes the sequence the encoding of the whole word; else k doubles, up to the whole word.
        """
        if not len(a.ids) or not len(b.ids):
            return Encoded(a.text + b.text, np.concatenate([a.ids, b.ids]), np.concatenate([a.begins, b.begins]))
        text = a.text + b.text
        # the window's start: the last word beginning of a at least MARGIN before its end
        left = np.flatnonzero(a.begins)
        t, chars = 0, len(a.text)
        for k in range(1, len(left) + 1):
            chars = int(self._begin_chars(a, left[-k:][:1], True)[0])
            if chars >= MARGIN:
                t = int(left[-k])
                break
        else:
            t, chars = 0, len(a.text)
        right = np.flatnonzero(b.begins)
        head = int(right[1]) if len(right) > 1 else len(b.ids)  # the end of b's first word
        if (inner := self._inside(a, b, head)) is not None:
            ids, begins = inner
            return Encoded(text, ids, begins)
        size = 4 * MARGIN
        tail = a.text[len(a.text) - chars :] if chars else ""
        while True:
            size = min(size, len(b.text))
            window = self.leaf(tail + b.text[:size])
            if size == len(b.text):
                return Encoded(text, np.concatenate([a.ids[:t], window.ids]), np.concatenate([a.begins[:t], window.begins]))
            in_b = self._places(b, right, size)
            in_window = self._places(window, np.flatnonzero(window.begins), len(window.text))
            for place in sorted(in_b.keys() & {p - chars for p in in_window}):
                if 0 < place <= size - MARGIN:
                    w, q = in_window[place + chars], in_b[place]
                    return Encoded(text, np.concatenate([a.ids[:t], window.ids[:w], b.ids[q:]]), np.concatenate([a.begins[:t], window.begins[:w], b.begins[q:]]))
            size *= 2

    def _places(self, e: Encoded, tokens: np.ndarray, most: int) -> dict[int, int]:
        """Code points before each word beginning -> its token, for those in the first ``most`` code points."""
        raw = e.text[:most].encode()
        sizes = self.bytes_of[e.ids]
        starts = (np.cumsum(sizes) - sizes)[tokens]
        ok = starts < len(raw)
        is_head = np.ones(len(raw) + 1, np.int64)
        is_head[: len(raw)] = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        before = np.cumsum(is_head) - is_head
        return {int(before[s]): int(t) for s, t in zip(starts[ok], tokens[ok])}

    def _inside(self, a: Encoded, b: Encoded, head: int):
        """The joined ids where a's last and b's first word are long and one word together; else None."""
        last = int(np.flatnonzero(a.begins)[-1])
        near = 3 * MARGIN
        if len(a.ids) - last <= 2 * FIRST_WINDOW or head <= 2 * FIRST_WINDOW:
            return None
        x, y = a.text[-near:], b.text[:near]
        if int(self.bytes_of[a.ids[last:]].sum()) <= len(x.encode()) or int(self.bytes_of[b.ids[:head]].sum()) <= len(y.encode()):
            return None
        if len(set(self.lib.encode(x + y, add_special_tokens=False).word_ids)) != 1:
            return None
        k, most = FIRST_WINDOW, max(len(a.ids) - last, head)
        while True:
            i, j = max(last, len(a.ids) - k), min(head, k)
            said = "".join(self.said[t] for t in (*a.ids[i:], *b.ids[:j]))
            got = np.array([t.id for t in self.lib.model.tokenize(said)], "<u4")
            agree = (i == last or (len(got) > 1 and (got[:2] == a.ids[i : i + 2]).all())) and (j == head or (len(got) > 1 and (got[-2:] == b.ids[j - 2 : j]).all()))
            if agree or k >= most:
                flags = np.zeros(len(got), bool)
                flags[0] = i == last
                return np.concatenate([a.ids[:i], got, b.ids[j:]]), np.concatenate([a.begins[:i], flags, b.begins[j:]])
            k *= 2

    def tree(self, parts: list[Encoded]) -> Encoded:
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def decode(self, ids: bytes) -> str:
        return self.lib.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def leaves(text: str, leaf_chars: int) -> list[str]:
    """The parts of a text that is halved until each has at most ``leaf_chars`` code points."""
    if len(text) <= leaf_chars:
        return [text]
    half = len(text) // 2
    return leaves(text[:half], leaf_chars) + leaves(text[half:], leaf_chars)


_loaded: dict[str, TreeBpe] = {}


def _tokenizer(path: str) -> TreeBpe:
    """The tokenizer of this worker, its kept units forgotten, so that none outlives the task that met them."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = TreeBpe(path)
    _loaded[path].forget()
    return _loaded[path]


NEW = {"token_ids": T.BinaryType(), "decoded": T.StringType()}


def encode(docs: DataFrame, path: str, text: str = "text", leaf_chars: int = LEAF_CHARS, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``token_ids`` (binary: ids as little-endian unsigned 32-bit numbers) and ``decoded`` (the ids' text).

    Equal to the tokenizers library's ``encode(text, add_special_tokens=False).ids`` and ``decode(ids,
    skip_special_tokens=False)``; null counts as empty and gives no ids. Columns of ``docs`` of the two new names are
    replaced, others pass through (without ``keep_text`` the text doesn't); null and repeated ids and rows are rows like
    others, an empty table gives an empty one. ``path``: the tokenizer's JSON file, at the same place on all machines.
    """
    packed = Packed(docs, text, NEW, keep_text)
    size = F.coalesce(F.length("text"), F.lit(0))
    every, packed.rows = packed.rows, packed.rows.where(size <= leaf_chars)

    def short():
        bpe = _tokenizer(path)

        def run(texts: pa.Array) -> list:
            found = bpe.encode([t or "" for t in texts.to_pylist()])
            return [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())]

        return run

    def halve(batches):
        for batch in batches:
            rid, part, said = [], [], []
            for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cut = leaves(t, leaf_chars)
                rid += [r] * len(cut)
                part += range(len(cut))
                said += cut
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.string()), pa.array(part, pa.int32()), pa.array(said, pa.string())], ["rid", "part", "text"])

    def encode_leaves(batches):
        bpe = _tokenizer(path)
        for batch in batches:
            found = [bpe.leaf(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f.ids.tobytes() for f in found], pa.binary()), pa.array([f.begins.tobytes() for f in found], pa.binary())], ["rid", "part", "text", "ids", "begins"])

    def join_leaves(batches):
        bpe = _tokenizer(path)
        held, parts = None, []

        def done():
            whole = bpe.tree(parts)
            ids = whole.ids.astype("<u4").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([held]), pa.array([ids], pa.binary()), pa.array([bpe.decode(ids)])], ["rid", "token_ids", "decoded"])

        for batch in batches:
            for rid, said, ids, begins in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if rid != held:
                    if parts:
                        yield done()
                    held, parts = rid, []
                parts.append(Encoded(said, np.frombuffer(ids, "<u4"), np.frombuffer(begins, bool)))
        if parts:
            yield done()

    # equal long texts are encoded once; the hash names the text, and the rows take their text's encoding back
    long = every.where(size > leaf_chars).withColumn("rid", F.sha2("text", 256))
    parts = long.select("rid", "text").dropDuplicates(["rid"]).mapInArrow(halve, "rid string, part int, text string")
    coded = parts.repartition("rid", "part").mapInArrow(encode_leaves, "rid string, part int, text string, ids binary, begins binary")
    whole = coded.repartition("rid").sortWithinPartitions("rid", "part").mapInArrow(join_leaves, "rid string, token_ids binary, decoded string")
    rows = long if packed.keeps_text else long.drop("text")
    return packed.mapped(short, 2 << 20).unionByName(packed.unpacked(rows.join(whole, "rid"), F.col("token_ids"), F.col("decoded")))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = encode(docs, default_path(), keep_text=False)
    return out.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
