"""Models as a graph of DataFrame functions: built in the order of their inputs, tested, and recorded in a run ledger.

Tables are versioned (``sources.versions``): a new state is written, tested where it lies, and published only if its tests
pass, so readers keep the last good one. An incremental model reads the last days of its first input again and upserts what
comes out on its grain, in the slices of the table that it touches; columns that it has newly got are appended.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldspark.operators import incremental, quality
from fieldspark.sources.sinks import exists, swap
from fieldspark.sources.tables import Sources
from fieldspark.sources.versions import State, VersionedTable

VIEW, TABLE, INCREMENTAL = "view", "table", "incremental"


@dataclass(frozen=True)
class Model:
    """A model: its function of the models and sources named in ``inputs``, how it is kept, its grain and tests.

    ``rules``: (name, SQL condition) that no row may break (null doesn't). ``slices`` cuts the table; ``cursor``, of an incremental
    model: the time column of its first input and of itself, and how many days before the newest are read again.
    """

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    kept: str = VIEW
    grain: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    parents: tuple[tuple[str, str, str], ...] = ()
    rules: tuple[tuple[str, str], ...] = ()
    slices: Callable[[], Column] | None = None
    cursor: tuple[str, int] | None = None
    tags: frozenset[str] = frozenset()


def schema_name(own: str | None, target: str, default: str) -> str:
    """Where a model's table goes: the target's default without a schema of its own; its own in ``prod``; else its own with
    the default behind it, so that targets don't meet."""
    if own is None:
        return default
    return own.strip() if target == "prod" else f"{own.strip()}_{default}"


class FailedTest(Exception):
    pass


@dataclass
class Plan:
    """Registered models over some sources; ``target`` is where tables are written."""

    sources: Sources
    target: str
    models: dict[str, Model] = field(default_factory=dict)
    checks: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = field(default_factory=dict)

    def model(self, name: str, *inputs: str, tags: tuple[str, ...] = (), **how):
        def register(build):
            self.models[name] = Model(name, build, inputs, tags=frozenset(tags), **how)
            return build

        return register

    def check(self, name: str, *inputs: str):
        """Register a test over several models: a function of them that gives the rows that fail."""

        def register(rows):
            self.checks[name] = inputs, rows
            return rows

        return register

    def table(self, spark: SparkSession, name: str) -> VersionedTable:
        m = self.models[name]
        return VersionedTable(spark, f"{self.target}/{name}", m.slices() if m.slices else None)

    def order(self, wanted: list[str] | None = None) -> list[str]:
        """Models that ``wanted`` need (all without it), inputs first; a cycle is an error."""
        graph = {m.name: [i for i in m.inputs if i in self.models] for m in self.models.values()}
        full = [n for n in TopologicalSorter(graph).static_order()]
        if wanted is None:
            return full
        need, todo = set(), list(wanted)
        while todo:
            n = todo.pop()
            if n not in need:
                need.add(n)
                todo += graph[n]
        return [n for n in full if n in need]

    def build(self, spark: SparkSession, wanted: list[str] | None = None, test: bool = True) -> dict[str, DataFrame]:
        """Every needed model as a DataFrame; tables are written and read back, so that views over them compute once.

        With ``test``, a model's rules are counted while it is written, its grain and parents are looked at in one more job, and
        a table that fails isn't published; checks follow as soon as all their models are built.
        """
        built: dict[str, DataFrame] = {}
        left = dict(self.checks) if test else {}
        for name in self.order(wanted):
            m = self.models[name]
            inputs = [built[i] if i in built else self.sources.read(spark, i) for i in m.inputs]
            if m.kept == VIEW:
                built[name] = m.build(*inputs)
                if test:
                    _raise_first(name, self._rows_against_rules(m, built[name]) | self._rows_against_keys(m, built[name], built))
            else:
                built[name] = self._kept(spark, m, inputs, built, test)
            built[name].createOrReplaceTempView(name)
            ready = {c: (i, f) for c, (i, f) in left.items() if set(i) <= set(built)}
            _raise_first(name, {c: f(*[built[x] for x in i]) for c, (i, f) in ready.items()})
            left = {c: x for c, x in left.items() if c not in ready}
        return built

    def _kept(self, spark: SparkSession, m: Model, inputs: list[DataFrame], built: dict[str, DataFrame], test: bool) -> DataFrame:
        table = self.table(spark, m.name)
        number = table.number()
        again = m.kept == INCREMENTAL and number > 0
        if again:
            ts, days = m.cursor
            inputs = [incremental.since_last(inputs[0], table.read(), ts, ts, days), *inputs[1:]]
        df, seen = m.build(*inputs), None
        if test and _conditions(m):
            seen = Observation()
            df = df.observe(seen, *[F.count_if(~F.expr(c)).alias(n) for n, c in _conditions(m).items()])
        state: State = table.staged_upsert(df, list(m.grain)) if again else table.staged(df)
        if test:
            broken = {n: k for n, k in seen.get.items() if k} if seen else {}
            if broken:
                raise FailedTest(f"{m.name}: " + ", ".join(f"{n} fails in {k} rows" for n, k in broken.items()))
            _raise_first(m.name, self._rows_against_keys(m, table.of(state), built))
        table.publish(state, number)
        return table.read()

    def _rows_against_rules(self, m: Model, df: DataFrame) -> dict[str, DataFrame]:
        return {n: quality.failing(df, F.expr(c)) for n, c in _conditions(m).items()}

    def _rows_against_keys(self, m: Model, df: DataFrame, built: dict[str, DataFrame]) -> dict[str, DataFrame]:
        found = {"unique": quality.not_unique(df, list(m.grain))} if m.grain else {}
        for key, parent, parent_key in (p for p in m.parents if p[1] in built):  # a build of few models may lack a parent
            found[f"{key} in {parent}"] = quality.orphans(df, key, built[parent], parent_key)
        return found

    def failures(self, built: dict[str, DataFrame], names: list[str] | None = None) -> DataFrame:
        """(check, failures): how many rows each check over the ``built`` models gives (all of them without ``names``)."""
        parts = [f(*[built[i] for i in inputs]).agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("failures")) for name, (inputs, f) in self.checks.items() if (name in names if names else set(inputs) <= set(built))]
        return reduce(DataFrame.unionByName, parts)


def _conditions(m: Model) -> dict[str, str]:
    """What must hold in each row of a model, by name."""
    columns = dict.fromkeys((*m.grain, *m.required))
    return {f"{c} not null": f"`{c}` is not null" for c in columns} | dict(m.rules)


def _raise_first(name: str, found: dict[str, DataFrame]) -> None:
    """Run all tests in one job; rows that fail are an error that shows one of each."""
    if not found:
        return
    some = [rows.limit(1).select(F.lit(what).alias("what"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")) for what, rows in found.items()]
    failed = reduce(DataFrame.union, some).collect()
    if failed:
        raise FailedTest(f"{name}: " + "; ".join(f"{r['what']} fails, for example {r['row']}" for r in failed))


LEDGER = "run_id long, pipeline string, started_at timestamp, ended_at timestamp, status string, notes string"
NOTE_CHARS = 1_000


def recorded(spark: SparkSession, path: str, pipeline: str, run: Callable[[int], None]) -> int:
    """Run ``run(run_id)`` between an opening and a closing entry in the ledger at ``path``; a failure is recorded and raised."""
    from datetime import datetime, timezone

    def save(entry: tuple) -> None:
        row = spark.createDataFrame([entry], LEDGER)
        old = spark.read.schema(LEDGER).parquet(path).where(f"run_id <> {entry[0]}") if exists(spark, path) else None
        swap(row if old is None else old.unionByName(row).coalesce(1), path)

    now = lambda: datetime.now(timezone.utc).replace(tzinfo=None)
    last = spark.read.schema(LEDGER).parquet(path).selectExpr("coalesce(max(run_id), 0)").first()[0] if exists(spark, path) else 0
    run_id, began = last + 1, now()
    save((run_id, pipeline, began, None, "RUNNING", None))
    try:
        run(run_id)
    except Exception as e:
        save((run_id, pipeline, began, now(), "FAILED", str(e)[:NOTE_CHARS]))
        raise
    save((run_id, pipeline, began, now(), "SUCCESS", None))
    return run_id
