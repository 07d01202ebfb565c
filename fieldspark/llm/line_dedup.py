"""Line dedup with DataFrame functions only: explode normalised lines, hash, count distinct documents per hash, drop
lines over the threshold and reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm.shared import Packed, ascii_lower, column, spread, table, within, written

#: Stripped at both ends of a line; the line feed cannot occur inside one.
BLANKS = " \t\n\x0b\x0c\r"
#: Dropped keys up to this number are broadcast (16 bytes each); more are joined by a salted shuffle.
BROADCAST_KEYS = 500_000
SALTS = 32


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hash(line: Column, min_chars: int) -> Column:
    key = line_key(line)
    return F.when(F.length(key) >= min_chars, F.md5(key))


def common_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """One row ``line_hash`` (MD5 as binary) for each line key found in at least ``min_docs`` rows of ``docs``.

    Every row is a document of its own, also where ids repeat. Each document's hashes are made distinct inside its row,
    so that the one shuffle only carries partial counts and a line that is everywhere costs one row per task.
    """
    lines = F.split(ascii_lower(F.coalesce(column(text), F.lit(""))), "\n")
    keys = F.transform(lines, lambda x: F.btrim(x, F.lit(BLANKS)))  # as line_key, but each key is made once a line
    return (
        docs.select(F.explode(F.array_distinct(F.transform(keys, lambda x: F.when(F.length(x) >= min_chars, F.md5(x))))).alias("h"))
        .where("h is not null")
        .select(F.unhex("h").alias("line_hash"))
        .groupBy("line_hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_docs)
        .select("line_hash")
    )


def drop_common_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``text`` cut to its uncommon lines, and ``n_lines`` (before) and ``n_dropped`` after its columns.

    Null or empty text is one empty line and stays as it is (null stays null). A document whose lines all go keeps an
    empty text. Repeated rows and null ids are rows like others. Columns of ``docs`` named ``n_lines`` or ``n_dropped``
    are replaced; all others pass through, whatever their names. An empty table gives an empty table.
    """
    common = written(common_lines(docs, text, min_docs, min_chars), "common-lines")
    packed = Packed(docs, text, {"n_lines": T.LongType(), "n_dropped": T.LongType()})
    rows = packed.rows.withColumn("rid", F.monotonically_increasing_id())
    lines = rows.select("rid", F.when(F.col("text").isNotNull(), F.lit(True)).alias("real"), "row", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    lines = lines.select("rid", "pos", "line", F.when(F.col("pos") == 0, F.struct("real", "row")).alias("head"), F.unhex(_hash(F.col("line"), min_chars)).alias("line_hash"))
    if within(common, BROADCAST_KEYS):
        lines = lines.join(F.broadcast(common.select("line_hash", F.lit(True).alias("hit"))), "line_hash", "left")
    else:
        salted = common.select("line_hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("hit"))
        own = F.coalesce("line_hash", F.encode(F.concat_ws("#", "rid", "pos"), "utf-8"))  # lines without a key match nothing and spread
        lines = lines.withColumn("line_hash", own).withColumn("salt", F.pmod(F.hash("rid", "pos"), F.lit(SALTS))).join(salted, ["line_hash", "salt"], "left")
    kept = F.when(F.col("hit").isNull(), F.struct("pos", "line"))
    out = lines.groupBy("rid").agg(
        F.first("head", ignorenulls=True).alias("head"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count("hit").alias("n_dropped"),
        F.array_join(F.sort_array(F.collect_list(kept)).getField("line"), "\n").alias("kept"),
    )
    out = out.select(F.col("head.row").alias("row"), F.when(F.col("head.real"), F.col("kept")).alias("text"), "n_lines", "n_dropped")
    return packed.unpacked(out, F.col("n_lines"), F.col("n_dropped"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = drop_common_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = r"""
with lines as (
  select doc_id, unnest(l) as line, generate_subscripts(l, 1) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
), keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), common as (
  select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10
)
select doc_id, count(*) as n_lines, count(common.key) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where common.key is null), '')) as kept_sha256
from keyed left join common on keyed.key = common.key
group by doc_id
"""
