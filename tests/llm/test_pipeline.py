"""The pipeline against a brute-force version of its stages, and the SQL of the corpus queries, on the smallest tables."""

import hashlib
import os
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline
from test_text_operators import LOWER, brute_components, brute_scan

from fieldspark.llm import bpe, language_id, registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_run(spark):
    from tokenizers import Tokenizer

    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in t.split("\n")]
    count = defaultdict(set)
    for i, r in rows.items():
        for k in keys(r["text"]):
            count[k].add(i)
    text = {i: "\n".join(x for x, k in zip(r["text"].split("\n"), keys(r["text"])) if not k or len(count[k]) < 10) for i, r in rows.items()}
    groups = brute_components(text.items(), 5, 80)
    kept = [i for i in text if groups[i][1] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [i for i, (n, hit, _) in zip(kept, brute_scan([text[i] for i in kept], items)) if not (hit and 20 * hit >= n)]
    assert len(clean) < len(kept) < len(rows)
    lib = Tokenizer.from_file(bpe.default_path())
    ids = {i: lib.encode(text[i], add_special_tokens=False).ids for i in clean}
    want = {i: (len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(text[i].encode()).hexdigest()) for i, x in ids.items()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == want


def test_language_stage_drops_what_it_rejects(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = [(-1, "1234 5678 !!", "en"), (-2, None, "en"), (-3, "", None), (-4, "жил был пёс и ещё один кот который любил спать на печи весь день " * 3, None), (-5, "qxzjkwv zzxq wqkj vvxzq jjqk " * 12, None)]
    more = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in odd], "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.unionByName(more.select(*[more[c].cast(t) for c, t in docs.dtypes]))
    kept = corpus_pipeline.STAGES[0][1](spark, both, DATA)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_near_duplicates_are_judged_by_id_and_text(spark):
    said = "a b c d e f g"
    rows = [(1, said), (2, said), (2, "x y z q r t u"), (2, "x y z q r t u"), (None, said), (3, None), (3, None), (0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.STAGES[2][1](spark, docs, DATA).collect()]
    assert sorted(kept, key=str) == sorted([(1, said), (2, "x y z q r t u"), (None, said), (3, None), (3, None), (0, "")], key=str)


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA) if "text" in docs.columns else docs
    assert docs.count() == 0


def test_sql_is_text_of_known_queries():
    assert all(isinstance(x, str) for x in registry.SQL.values()) and set(registry.SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = c.execute(registry.SQL[name])
    columns = [d[0] for d in want.description]
    got = registry.QUERIES[name](spark, DATA).select(*columns).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want.fetchall()))


def test_language_left_out_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = language_id.fit(language_id.learning_rows(docs).where("lang <> 'de'"))
    for chars in (40, 100, 200_000):
        found = language_id.predict(docs.selectExpr("lang", f"substring(text, 1, {chars}) as text"), models)
        share = {r[0]: r[1] for r in found.selectExpr("lang", "int(rejected) as r").groupBy("lang").avg("r").collect()}
        assert share.pop("de") > 0.95 and max(share.values()) < 0.02


def test_columns_that_operators_add_themselves_pass(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    own = docs.selectExpr("*", "-7.0d as score", "'mine' as n_lines", "doc_id as `row`", "'x' as lang_pred", "1 as `a.b`")
    said = {r["doc_id"]: r["text"] for r in docs.collect()}
    for stage in corpus_pipeline.STAGES[:2]:
        out = stage[1](spark, own, DATA)
        assert out.columns == own.columns
        rows = out.collect()
        assert len(rows) > 50 and {(r["score"], r["n_lines"], r["lang_pred"], r["a.b"]) for r in rows} == {(-7.0, "mine", "x", 1)}
        assert all(r["row"] == r["doc_id"] and len(r["text"]) <= len(said[r["doc_id"]]) for r in rows)
