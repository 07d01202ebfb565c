"""Substring dedup against a scan of all windows in their order."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fieldspark.llm import substring_dedup

SPACED = r"[^\x20\x09-\x0D]+"


def brute(rows, k):
    """(words, kept text, whether a word is covered by a repeated window) of each (id, text), in the order of ids."""
    seen, out = set(), []
    for _, t in rows:
        w = re.findall(SPACED, t or "")
        covered = [False] * len(w)
        for s in range(len(w) - k + 1):
            window = tuple(w[s : s + k])
            if window in seen:
                covered[s : s + k] = [True] * k
            seen.add(window)
        out.append((w, " ".join(x for x, c in zip(w, covered) if not c), covered))
    return out


@pytest.fixture(scope="module")
def said():
    r = random.Random(12)
    base = [[r.choice("abcdefgh") + str(r.randint(0, 30)) for _ in range(80)] for _ in range(6)]
    out = [None, "", " \n", "a", "A b", "x " * 70, "x " * 19, "x " * 20, "ab ba " * 40, "Case " * 30, "case " * 30]
    for _ in range(120):
        b = r.choice(base)
        i, j = sorted((r.randint(0, 80), r.randint(0, 80)))
        w = [f"n{r.randint(0, 10**6)}" for _ in range(r.randint(0, 12))] + b[i:j] + [f"é{r.randint(0, 10**6)}" for _ in range(r.randint(0, 12))] + b[j:] * r.randint(0, 2)
        out.append(r.choice([" ", "\n", "\t "]).join(w))
    return out + out[20:40]


@pytest.mark.parametrize(("k", "bits"), [(20, 26), (20, 10), (5, 26), (1, 26), (2, 10)])
def test_drop_repeats(spark, said, monkeypatch, k, bits):
    monkeypatch.setattr(substring_dedup, "SCREEN_BITS", bits)  # full tables screen nothing, and nothing changes
    rows = list(enumerate(said))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.drop_repeats(df, words=k).collect()}
    assert got == {i: (len(w), sum(c), kept) for (i, _), (w, kept, c) in zip(rows, brute(rows, k))}


def test_repeated_spans_say_where_they_come_from(spark, said):
    rows = list(enumerate(said))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    covered = {i: set() for i, _ in rows}
    w = {i: re.findall(SPACED, t or "") for i, t in rows}
    spans = substring_dedup.repeated_spans(df).collect()
    for r in spans:
        n = r["n_words"]
        assert n >= 20 and (r["source_id"], r["source_start"]) < (r["doc_id"], r["start"])
        assert w[r["doc_id"]][r["start"] : r["start"] + n] == w[r["source_id"]][r["source_start"] : r["source_start"] + n]
        covered[r["doc_id"]] |= set(range(r["start"], r["start"] + n))
    assert {i: len(c) for i, c in covered.items()} == {i: sum(c) for (i, _), (_, _, c) in zip(rows, brute(rows, 20))}
    assert max(r["n_words"] for r in spans) > 50


def test_odd_tables(spark):
    long = "word and Wörter " * 20_000 + "x" * 50_000
    texts = [(None, "a b"), (None, long), (None, None), (1, long), (1, long), (1, "c"), (2, long), (3, "")]
    schema = "doc_id long, text string, `__any` string, row int, here string, `a.b` string, `N_WORDS` int, id string, h int, cuts int"
    df = spark.createDataFrame([(i, t, "any", 1, None, "ab", 7, "i", 8, 9) for i, t in texts], schema)
    got = substring_dedup.drop_repeats(df).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in got) == sorted([("None", 2, 0), ("None", 60_001, 60_000 - 3), ("None", 0, 0), ("1", 60_001, 60_001), ("1", 60_001, 60_001), ("1", 1, 0), ("2", 60_001, 60_001), ("3", 0, 0)])
    for r in got:
        assert (r["__any"], r["row"], r["here"], r["a.b"], r["id"], r["h"], r["cuts"]) == ("any", 1, None, "ab", "i", 8, 9)
    once = df.where("doc_id is not null").select("doc_id", "text").distinct()
    assert {r["n_removed"] for r in substring_dedup.drop_repeats(once).where("doc_id = 2").collect()} == {60_001}
    assert substring_dedup.drop_repeats(df.limit(0)).count() == 0 and substring_dedup.repeated_spans(df.limit(0)).count() == 0
    named = substring_dedup.drop_repeats(once.select(F.col("doc_id").cast("string").alias("d.x"), F.col("text").alias("t`t")), "d.x", "t`t")
    assert named.columns == ["d.x", "t`t", "n_words", "n_removed"] and named.count() == 4
