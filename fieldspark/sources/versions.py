"""Tables as states: data folders that are never changed, and one small numbered file a state that lists those it consists of.

A new state is written beside the others, can be read and tested there, and becomes the table by the rename of its list to
the next number. That rename is checked and never overwrites: a writer that fails, or that another has overtaken, leaves
the table as it was, and readers of older states keep their files. A table may be cut into slices by a value of its rows
(a month, a hash): an upsert or delete writes only the slices that it touches, and lists the others as they are.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.operators import merge

SLICE = "__slice"
#: The slice of rows without a value for it, and of tables that aren't cut.
NONE = "none"


class Overtaken(RuntimeError):
    """Another writer has put a state after the one that this one began with."""


@dataclass
class State:
    """What a table consists of: its schema, the folder of each slice, and the last batch applied of each feed."""

    schema: T.StructType
    folders: dict[str, str] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "folders": self.folders, "applied": self.applied})

    @staticmethod
    def of(text: str) -> State:
        d = json.loads(text)
        return State(T.StructType.fromJson(d["schema"]), d["folders"], d["applied"])


def _loose(schema: T.StructType) -> T.StructType:
    """The schema with nulls allowed everywhere, as in files."""

    def of(x):
        if isinstance(x, list):
            return [of(y) for y in x]
        return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else of(v) for k, v in x.items()} if isinstance(x, dict) else x

    return T.StructType.fromJson(of(schema.jsonValue()))


def _named(column: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def sliced(by: Column | None) -> Column:
    """A slice's name; what can't stand in a folder's name is replaced, which can only join slices."""
    return F.lit(NONE) if by is None else F.coalesce(F.regexp_replace(by.cast("string"), "[^A-Za-z0-9_.-]", "_"), F.lit(NONE))


class VersionedTable:
    """The table at ``path``; ``by`` cuts it into slices, by an expression of its columns that never changes. ``by_keys`` says that
    it is one of the keys of all upserts alone, which then needn't look for the slices of the rows they replace."""

    def __init__(self, spark: SparkSession, path: str, by: Column | None = None, by_keys: bool = False):
        self.spark, self.path, self.by, self.by_keys = spark, path.rstrip("/"), by, by_keys
        jvm = spark.sparkContext._jvm
        self._path_of, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path_of(self.path).getFileSystem(self._conf)

    # states

    def number(self) -> int:
        """The newest state's number, 0 before the first."""
        return max(self.numbers(), default=0)

    def numbers(self) -> list[int]:
        where = self._path_of(f"{self.path}/states")
        names = [f.getPath().getName() for f in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def exists(self) -> bool:
        return self.number() > 0

    def state(self, number: int | None = None) -> State:
        file = self._fs.open(self._path_of(f"{self.path}/states/{number or self.number():020d}.json"))
        try:
            return State.of(self._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def publish(self, state: State, after: int) -> int:
        """Make ``state`` the one after number ``after``; ``Overtaken`` where there is such a state already."""
        temp, target = (self._path_of(f"{self.path}/states/{name}") for name in (f"{uuid.uuid4().hex}.tmp", f"{after + 1:020d}.json"))
        out = self._fs.create(temp, False)
        try:
            out.write(state.text().encode())
        finally:
            out.close()
        try:
            self._rename(temp, target)
        except Exception as e:
            self._fs.delete(temp, False)
            if "FileAlreadyExists" in str(e):
                raise Overtaken(f"{self.path}: state {after + 1} is there already") from e
            raise
        return after + 1

    def _rename(self, old, new) -> None:
        """A rename that raises unless it has been done, and never overwrites."""
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(option, 1)
        options[0] = getattr(option, "NONE")
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri() if old.toUri().getScheme() else self._fs.getUri(), self._conf).rename(old, new, options)

    # reading

    def read(self, number: int | None = None, slices: set[str] | None = None) -> DataFrame:
        """The newest state, or an older one; of ``slices`` alone if given. Columns that a slice was written without are null."""
        return self.of(self.state(number), slices)

    def of(self, state: State, slices: set[str] | None = None) -> DataFrame:
        folders = [f"{self.path}/{f}" for s, f in state.folders.items() if slices is None or s in slices]
        return self.spark.read.schema(state.schema).parquet(*folders) if folders else self.spark.createDataFrame([], state.schema)

    # writing

    def written(self, df: DataFrame) -> dict[str, str]:
        """The rows of ``df`` in new folders, one for each slice; Spark splits those that are large into several files."""
        own = f"data/{uuid.uuid4().hex}"
        cut = df.withColumn(SLICE, sliced(self.by))
        (cut.hint("rebalance", SLICE) if self.by is not None else cut).write.partitionBy(SLICE).parquet(f"{self.path}/{own}")
        where = self._path_of(f"{self.path}/{own}")
        names = [f.getPath().getName() for f in self._fs.listStatus(where)]
        return {n.removeprefix(f"{SLICE}="): f"{own}/{n}" for n in names if n.startswith(f"{SLICE}=")}

    def staged(self, df: DataFrame) -> State:
        """A state of the rows of ``df``, written but not yet the table's; ``of`` reads it and ``publish`` makes it the newest."""
        applied = self.state().applied if self.exists() else {}
        return State(_loose(df.schema), self.written(df), applied)

    def staged_upsert(self, changes: DataFrame, keys: list[str], gone: DataFrame | None = None, by_keys: list[str] | None = None) -> State:
        """The newest state after rows of ``gone`` (their ``keys``, or ``by_keys``) have left and ``changes`` have replaced rows of
        their keys or come new.

        Only slices that hold such rows before or after are read and written. Columns that the table lacks are appended, and
        null in its other rows; columns that the changes lack are null in theirs; known columns keep their types.
        """
        state = self.state()
        old = self.of(state)
        known = {f.name: f.dataType for f in state.schema}
        changes = changes.select(*[_named(c).cast(known[c]).alias(c) if c in known else _named(c) for c in changes.columns])
        own = VersionedTable(self.spark, f"{self.path}/changes")  # read three times
        changes = own.of(State(_loose(changes.schema), own.written(changes)))
        full = old.limit(0).unionByName(changes, allowMissingColumns=True)
        leaving = full.select(sliced(self.by).alias(SLICE))
        if not self.by_keys:  # else a row that is replaced is in the slice of the one that replaces it
            leaving = leaving.union(old.join(changes.select(*keys).distinct(), keys, "left_semi").select(sliced(self.by).alias(SLICE)))
        if gone is not None:
            leaving = leaving.union(old.join(gone.select(*(by_keys or keys)).distinct(), by_keys or keys, "left_semi").select(sliced(self.by).alias(SLICE)))
        touched = {r[0] for r in leaving.distinct().collect()}
        part = self.of(state, touched)
        if gone is not None:
            part = merge.delete_keys(part, gone, by_keys or keys)
        new = merge.upsert(part, changes, keys)
        folders = {s: f for s, f in state.folders.items() if s not in touched}
        out = State(_loose(new.schema), folders | (self.written(new) if touched else {}), dict(state.applied))
        self._fs.delete(self._path_of(own.path), True)
        return out

    def replace(self, df: DataFrame) -> int:
        number = self.number()
        return self.publish(self.staged(df), number)

    def upsert(self, changes: DataFrame, keys: list[str]) -> int:
        number = self.number()
        return self.publish(self.staged_upsert(changes, keys), number)

    def drop(self) -> None:
        """Delete the table, all its states and data."""
        self._fs.delete(self._path_of(self.path), True)

    def drop_old(self, keep: int = 2) -> None:
        """Delete all states but the newest ``keep``, and data folders that no state left lists. Not while others write."""
        stay = self.numbers()[-keep:]
        used = {f.split("/")[1] for n in stay for f in self.state(n).folders.values()}
        for n in set(self.numbers()) - set(stay):
            self._fs.delete(self._path_of(f"{self.path}/states/{n:020d}.json"), False)
        data = self._path_of(f"{self.path}/data")
        for f in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if f.getPath().getName() not in used:
                self._fs.delete(f.getPath(), True)


