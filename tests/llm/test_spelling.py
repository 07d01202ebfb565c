"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fieldspark.llm import fm_index, spelling
from fieldspark.llm import words as W

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RUN = "[A-Za-zÀ-ÿ]+"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=5):
    out = {}
    for w, n in counts.items():
        around = [v for v in counts if near(w, v)]
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[w] = [w, form, None, n, len(around), counts[form] if form else None]
    for row in out.values():
        row[2] = row[0]
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return sorted(map(tuple, out.values()), key=str)


def words_of(r, n, letters, sizes):
    base = ["".join(r.choice(letters) for _ in range(r.choice(sizes))) for _ in range(n)]
    for w in base[: n // 2]:
        for _ in range(3):
            k = r.randrange(len(w))
            base.append(r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1 :]]))
    return base


@pytest.mark.parametrize("seed", range(3))
def test_index_finds_every_word_one_error_away_once(seed):
    r = random.Random(seed)
    for _ in range(40):
        said = sorted(set(words_of(r, r.randint(1, 30), "abcé漢"[: r.randint(1, 5)], range(2, 9))))
        said = [w for w in said if w]
        symbols, bounds, letters = fm_index.flat(said)
        mirrored = sorted(said, key=lambda w: w[::-1])
        back = fm_index.Index(symbols, bounds, len(letters))
        ahead = fm_index.Index(*fm_index.flat([w[::-1] for w in mirrored], letters)[:2], len(letters))
        size = np.diff(bounds)
        for drops in (False, True):
            want = sorted((x, y) for x in said for y in said if near(x, y) and (len(y) < len(x)) == drops)
            for index, own, begin, step in ((back, said, bounds[1:] - 1, -1), (ahead, mirrored, bounds[:-1], 1)):
                q, found = index.one_error(symbols, begin, step, size, np.zeros(len(said), int), np.full(len(said), drops))
                assert sorted((said[i], own[j]) for i, j in zip(q, found)) == want


@pytest.mark.parametrize(("cell", "shard"), [(10_000, 40_000), (3, 20), (12, 60)])
def test_variants(spark, monkeypatch, cell, shard):
    monkeypatch.setattr(spelling, "CELL", cell)  # cells are divided, and shards many
    monkeypatch.setattr(spelling, "SHARD", shard)
    r = random.Random(cell)
    counts = {w: r.choice([5, 6, 7, 30, 31, 200, 900]) for w in words_of(r, 60, "abé", [3, 6, 7, 8]) + words_of(r, 40, "ab", [6]) + ["x" * 60, "x" * 61, "x" * 59 + "y", "aaaaaa", "aaaaaaa", "aaaaaaaa"] if len(w) > 1}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(counts)


def test_checksums():
    r = random.Random(1)
    said = [bytes(r.randrange(256) for _ in range(r.choice([0, 1, 5, 63, 64, 65, 300]))) for _ in range(50)]
    ends = np.cumsum([len(s) for s in said])
    before = np.array([zlib.crc32(str(i).encode()) for i in range(50)], np.uint32)
    got = spelling.checksums(np.frombuffer(b"".join(said), np.uint8), ends - [len(s) for s in said], ends, before)
    assert got.tolist() == [zlib.crc32(s, int(b)) for s, b in zip(said, before)]


def test_letter_runs():
    texts = ["aÀb×ÿ÷z Ā̀é-É_9Z", "", "¿ÀĀ", "[a]{b}@`c", None, "x", "y"]
    w = spelling.letter_runs(*W.texts(pa.array(texts)))
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)] == [x for t in texts for x in re.findall(RUN, t or "")]


def test_query(spark, tmp_path):
    r = random.Random(4)
    vocabulary = words_of(r, 60, "abcÉé", [5, 6, 7, 9])
    weight = [r.choice([1, 1, 3, 40]) for _ in vocabulary]
    texts = [None, "", "12 34", "Z" * 70] + [" ".join(r.choice([str.upper, str])(w) if w.isascii() else w for w in r.choices(vocabulary, weight, k=r.choice([5, 200]))) for _ in range(80)]
    rows = [(17 * k, t) for k, t in enumerate(texts)] + [(None, texts[9]), (17, texts[9]), (17, texts[9])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts, slips = Counter(), 0
    for i, t in rows:
        for w in re.findall(RUN, t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 199 == 0 and i is not None:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
                slips += 1
            counts[w] += len(w) >= 6
    assert slips > 10
    got = sorted(map(tuple, spelling.op13_spelling_variants(spark, str(tmp_path)).collect()), key=str)
    want = brute({w: n for w, n in counts.items() if n >= 5})
    assert got == want and sum(x[1] is not None for x in got) > 5


def test_odd_tables(spark):
    df = spark.createDataFrame([("abcdef", 5, 1), ("abcdef", 20, 1), (None, 7, 1), ("abcdeg", 5, 1), ("", 9, 1), ("a", 9, 1), ("abcdég", 25, 1)], "word string, n long, form int")
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(df).collect()}
    assert got == {"abcdef": (None, "abcdef", 25, 1, None), "abcdeg": ("abcdef", "abcdef", 5, 2, 25), "": (None, "", 9, 0, None), "a": (None, "a", 9, 0, None), "abcdég": (None, "abcdég", 25, 1, None)}
    assert spelling.variants(df.limit(0)).count() == 0
    assert spelling.word_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    named = spark.createDataFrame([(None, "abcdef abcdef", 1)] * 3 + [(1, None, 2)], "`i.d` long, `t``t` string, word int")
    assert [tuple(r) for r in spelling.word_counts(named, "t`t", "i.d", slip=1).collect()] == [("abcdef", 6)]
