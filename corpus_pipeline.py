"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import bpe, decontaminate, language_id, line_dedup, ngram_join
from fieldspark.llm.shared import column, removed, table, within, written

#: Ids of dropped near-duplicates that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 500_000


def _held(docs: DataFrame) -> tuple[DataFrame, list]:
    """(row, text) of each document, with all columns but the text in one struct, so that no column of ``docs`` meets one that
    an operator adds; and the columns that bring the documents back."""
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(*[column(c).alias(f"c{k}") for k, c in enumerate(others)]).alias("row")
    return docs.select(row, "text"), [F.col("text") if c == "text" else F.col(f"row.c{others.index(c)}").alias(c) for c in docs.columns]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those that language ID rejects (no letters, or like none of the languages) go."""
    models = language_id.fit(language_id.learning_rows(docs))
    held, back = _held(docs)
    return language_id.predict(held, models).where("not rejected").select(*back)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; none goes, also where no line stays."""
    held, back = _held(docs)
    return line_dedup.drop_common_lines(held, min_docs=10, min_chars=1).select(*back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that shingles of five words link at 0.8 or more, the one of the smallest id.

    A document is an id with a text: rows of one id with different texts are judged apart, and of rows with equal ids and
    texts one stays. Documents without words, or without an id, are in no group and stay.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.unhex(F.md5("text")).alias("md5")))
    groups = written(ngram_join.jaccard_components(docs.select(key.alias("key"), "text"), doc_id="key", words=5, percent=80).where("n_shingles > 0 and key is not null"), "groups")
    dropped = written(groups.where("component_id < key").select("key").distinct(), "near-duplicates")
    keyed = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), key.alias("key"))
    kept = keyed.join(F.broadcast(dropped) if within(dropped, BROADCAST_IDS) else dropped, "key", "left_anti")
    repeated = written(groups.where("component_id = key").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
        kept = kept.join(repeated, "key", "left_anti").unionByName(once)
    removed(groups)
    return kept.select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover less than a twentieth of the words."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens: their number, the ids' hash and the hash of the text that they decode to."""
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), bpe.default_path(), keep_text=False)
    return out.select(
        "doc_id", "lang", "source",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding", encoding_stage),
]
#: Components of near-duplicates and token ids are beyond SQL; tests compare ``run`` to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs
