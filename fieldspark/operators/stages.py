"""Plans of a backfill: iterations in cells of a season block and a region group, in order; their selection and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the group of countries that no group names.
OTHER = "Other (unmapped country)"
STAGES = "array<struct<group:string,iteration_ids:array<bigint>,matches:bigint,todo:bigint>>"
PLAN = f"name string, generated_at string, blocks array<struct<label:string,seasons:array<string>,stages:{STAGES}>>"


def cells(rows: DataFrame, blocks: dict[str, list[str]], groups: dict[str, list[int]]) -> DataFrame:
    """(block_place, block, group_place, group, iteration_ids, matches, todo) from rows (iteration_id, season, country_id,
    matches, todo).

    Rows of seasons in no block go; countries in no group, and null ones, are in the last group, so that nothing else is
    lost. ``blocks`` and ``groups`` are parameters and small; both are joined as broadcast tables.
    """
    spark = rows.sparkSession
    of_season = {s: (k, b) for k, (b, seasons) in enumerate(blocks.items()) for s in seasons}
    of_country: dict[int, tuple[int, str]] = {}
    for k, (g, countries) in enumerate(groups.items()):
        for c in countries:
            of_country.setdefault(c, (k, g))
    season = spark.createDataFrame([(s, *b) for s, b in of_season.items()], "season string, block_place int, block string")
    country = spark.createDataFrame([(c, *g) for c, g in of_country.items()], "country_id long, group_place int, group string")
    placed = rows.join(F.broadcast(season), "season").join(F.broadcast(country), "country_id", "left")
    placed = placed.withColumns({"group": F.coalesce("group", F.lit(OTHER)), "group_place": F.coalesce("group_place", F.lit(len(groups)))})
    return placed.groupBy("block_place", "block", "group_place", "group").agg(
        F.array_sort(F.collect_set("iteration_id")).alias("iteration_ids"), F.sum("matches").alias("matches"), F.sum("todo").alias("todo")
    )


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """(block_place, block, stage_place, group, iteration_ids, matches, todo) of a plan in a JSON file. A file without a
    list of blocks is an error."""
    plan = spark.read.schema(PLAN).option("multiLine", True).json(path)
    if plan.where("blocks is null").limit(1).count() or plan.isEmpty():
        raise ValueError(f"{path} is no plan: it has no list of blocks")
    block = plan.select(F.posexplode("blocks").alias("block_place", "b"))
    stage = block.select("block_place", F.col("b.label").alias("block"), F.posexplode("b.stages").alias("stage_place", "s"))
    return stage.select("block_place", "block", "stage_place", "s.*")


def selected(stages: DataFrame, blocks: list[str] | None = None) -> DataFrame:
    """The stages of some blocks, all without any named. A name that the plan doesn't have is an error."""
    if not blocks:
        return stages
    known = {r[0] for r in stages.where(F.col("block").isin(blocks)).select("block").distinct().collect()}
    if set(blocks) - known:
        raise ValueError(f"unknown blocks {sorted(set(blocks) - known)}")
    return stages.where(F.col("block").isin(blocks))


def with_countries(rows: DataFrame, iterations: DataFrame) -> DataFrame:
    """Country ids that ``rows`` lack, from newer ``iterations`` (id, country_id)."""
    known = iterations.select(F.col("id").alias("iteration_id"), F.col("country_id").alias("__country")).dropDuplicates(["iteration_id"])
    return rows.join(known, "iteration_id", "left").withColumn("country_id", F.coalesce("country_id", "__country")).drop("__country")


def completed_since(stages: DataFrame, since: Column) -> DataFrame:
    """Stages that were completed after ``since``; those that aren't completed go."""
    return stages.where(F.col("completed_at") > since)


def share_of(total: Column, workers: int) -> Column:
    """What each of some workers does of a total, rounded up."""
    return F.ceil(total / workers).cast("long")


def season_key(season: Column) -> Column:
    """The year by which seasons like 2023, 23/24 or 2023/2024 are ordered, 0 for other text."""
    from fieldspark.functions.scalars import season_year

    return F.coalesce(season_year(season), F.lit(0))


def newest_seasons(rows: DataFrame, season: str, n: int) -> DataFrame:
    """The ``n`` newest different seasons of ``rows``, newest first."""
    return rows.select(season).distinct().orderBy(season_key(F.col(season)).desc(), F.col(season).desc()).limit(n)


def editions(rows: DataFrame, keys: list[str], match: str) -> DataFrame:
    """Different editions, by ``keys``, with the number of their matches."""
    return rows.groupBy(*keys).agg(F.count_distinct(match).alias("matches"))
