"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fieldspark.llm import periodic_runs
from fieldspark.llm import words as W

SPACED = r"[^\x20\x09-\x0D]+"


def brute(w):
    """(start, length, period) of all runs of 12 words at least, by start and period."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            a = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - a >= max(12, 2 * q):
                out.setdefault((a, i + q), q)
            i += 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def collapsed(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sequences(r):
    """Texts with planted, nested and broken repetitions."""
    for _ in range(r.randint(1, 6)):
        n, letters, kind = r.choice([0, 1, 11, 12, 40, 100, 300, 700]), r.choice([1, 2, 3, 8, 1000]), r.random()
        w = [r.randrange(letters) for _ in range(n)]
        if kind < 0.5 and n:
            for _ in range(r.randint(1, 4)):
                a = r.randrange(n)
                p, e = 1 + (n - a) // r.randint(2, 10), r.randint(a, n)
                w[a:e] = [w[a + (i - a) % p] for i in range(a, e)]
        elif kind < 0.7 and n:  # long stretches of one word within each period
            unit = [1] * r.randint(1, 60) + [2] * r.randint(1, 3) + [1] * r.randint(0, 5) + [3]
            w = (unit * n)[:n]
            w[r.randrange(n)] = 9
        elif kind > 0.85 and n:  # Fibonacci words
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            w = b[:n]
        yield w


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_whole_batches(seed):
    r = random.Random(seed)
    for _ in range(60):
        texts = list(sequences(r))
        first = np.cumsum([0, *map(len, texts)])
        hashes = W.mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(7))
        start, end, period = periodic_runs.find_runs(hashes, first)
        want = [(a + int(f), a + int(f) + n, q) for f, t in zip(first, texts) for a, n, q in brute(t)]
        assert sorted(zip(start.tolist(), end.tolist(), period.tolist())) == sorted(want)


def test_long_texts_take_little_time():
    r = np.random.default_rng(0)
    for w in (np.zeros(299_999, int), np.tile(np.arange(9), 40_000), np.tile(r.integers(0, 5, 70_001), 4), np.tile(np.append(np.zeros(999, int), 1), 300)):
        start, end, period = periodic_runs.find_runs(W.mix(w.astype(np.uint64)), np.array([0, len(w)]))
        k = int(np.argmax(end - start))
        assert end[k] - start[k] == len(w) and period[k] == {299_999: 1, 360_000: 9, 280_004: 70_001}.get(len(w), 1000)


def test_query(spark, tmp_path):
    r = random.Random(5)
    texts = [None, "", " \n", "a", "a " * 12, "A a " * 9, "é " * 11] + ["\t".join(f"w{x}" for x in w) for _ in range(40) for w in sequences(r)]
    rows = [(1000 * k + 7, t) for k, t in enumerate(texts)] + [(None, "a b " * 8), (7, "a b " * 8), (7, "a b " * 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        w = re.findall(SPACED, t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        runs = brute(w)
        most = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(runs), *(most or (None,) * 3), 1000 * most[1] // most[2] if most else None, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(collapsed(w, runs))))
    got = periodic_runs.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"] and {t for _, t in got.dtypes[:6]} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if i and t) > 5


def test_odd_tables(spark):
    long = "word and Wörter " * 20_000 + "x" * 50_000
    schema = "doc_id long, text string, `__any` string, row int, here string, `a.b` string, `RUNS` int"
    rows = [(i, t, "any", 1, None, "ab", 7) for i, t in [(None, "a b"), (None, None), (1, "a b"), (1, "a b"), (1, "c"), (2, long), (3, "")]]
    df = spark.createDataFrame(rows, schema)
    got = periodic_runs.add_runs(df).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])[:3], len(r["runs"])) for r in got) == sorted((str(r[0]), str(r[1])[:3], int(r[0] == 2)) for r in rows)
    for r in got:
        assert (r["__any"], r["row"], r["here"], r["a.b"]) == ("any", 1, None, "ab")
        assert r["collapsed"] == ("word and Wörter " + "x" * 50_000 if r["doc_id"] == 2 else r["text"] or "")
    assert periodic_runs.add_runs(df.limit(0)).count() == 0
