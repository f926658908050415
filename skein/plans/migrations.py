"""Database schemas from migration operations kept as rows.

operations are rows (repo, file, seq, op, table_name, new_name, column, type,
options, columns, unique, index_name, referenced_table, referenced_column); a
repository's files run in the order of their base names, operations of a file
by seq. Renames tie the names that a table has had to one lineage; every
lineage is then replayed by itself, as a stream sorted by time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.session import materialize

OPTIONAL = ["new_name", "column", "type", "options", "columns", "unique", "index_name", "referenced_table", "referenced_column"]


def ordered(operations: DataFrame) -> DataFrame:
    """operations with at, the position in their repository: by base name, file and seq (one range sort, no single task)."""
    have = [F.col(c) if c in operations.columns else F.lit(None).cast("boolean" if c == "unique" else "string").alias(c) for c in OPTIONAL]
    base = F.element_at(F.split("file", "/"), -1)
    rows = operations.select("repo", "file", "seq", "op", "table_name", *have, base.alias("base"))
    return materialize(rows.repartitionByRange("repo", "base", "file", "seq").sortWithinPartitions("repo", "base", "file", "seq").withColumn("at", F.monotonically_increasing_id()).drop("base"), "operations")


def _standing(ops: DataFrame, renames: DataFrame) -> DataFrame:
    """Events of names (repo, name, at, alive): a name stands after any operation on it, and falls by drop or an applied rename."""
    touch = ops.where("op <> 'rename_table'").select("repo", F.col("table_name").alias("name"), "at", (F.col("op") != "drop_table").alias("alive"))
    applied = renames.where("status = 'applied'")
    gone, come = applied.select("repo", F.col("old").alias("name"), "at", F.lit(False).alias("alive")), applied.select("repo", F.col("new").alias("name"), "at", F.lit(True).alias("alive"))
    return touch.unionByName(gone).unionByName(come)


def judged(ops: DataFrame) -> DataFrame:
    """Renames (repo, at, old, new, status): applied, unknown (the old name does not stand) or collides (the new one does).

    All are taken as applied at first; each round judges them by the events
    that the last round left, until nothing changes. The earliest judgement
    that is still wrong is put right in every round, so the rounds end, and
    they end where a replay in order of time would.
    """
    renames = ops.where("op = 'rename_table'").select("repo", "at", F.col("table_name").alias("old"), F.col("new_name").alias("new"), F.lit("applied").alias("status"))
    before = Window.partitionBy("repo", "name").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        renames = materialize(renames, "renames")
        ask = renames.select("repo", "at", F.explode(F.array(F.struct(F.lit("old").alias("end"), F.col("old").alias("name")), F.struct(F.lit("new").alias("end"), F.col("new").alias("name")))).alias("q"))
        ask = ask.select("repo", "at", "q.name", "q.end", F.lit(None).cast("boolean").alias("alive"), F.lit(0).alias("side"))
        both = ask.unionByName(_standing(ops, renames).withColumn("end", F.lit(None).cast("string")).withColumn("side", F.lit(1)))
        stood = both.withColumn("stood", F.coalesce(F.last("alive", ignorenulls=True).over(before), F.lit(False))).where("side = 0")
        ends = stood.groupBy("repo", "at").agg(F.max(F.when(F.col("end") == "old", F.col("stood"))).alias("known"), F.max(F.when(F.col("end") == "new", F.col("stood"))).alias("taken"))
        status = F.when(~F.col("known"), "unknown").when(F.col("taken"), "collides").otherwise("applied")
        now = materialize(renames.withColumnRenamed("status", "was").join(ends, ["repo", "at"]).select("repo", "at", "old", "new", "was", status.alias("status")), "renames")
        if now.where("was <> status").isEmpty():
            return now.drop("was")
        renames = now.drop("was")


def lineages(ops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(operations with lineage, renames with their status).

    An incarnation of a name starts at its first operation after a drop or
    rename; a rename links the incarnation of the old name to that of the new
    one. Links are followed by pointer jumping, so chains of renames take a
    logarithmic number of rounds.
    """
    renames = judged(ops)
    applied = renames.where("status = 'applied'")
    real = materialize(_standing(ops, renames), "standing")
    before = Window.partitionBy("repo", "name").orderBy("at", "alive").rowsBetween(Window.unboundedPreceding, -1)
    real = real.withColumn("stood", F.coalesce(F.last("alive").over(before), F.lit(False)))
    # births: a name is born anew by an applied rename into it, or by the first operation after a drop or an applied rename away
    births = real.where("alive AND NOT stood").select("repo", "name", F.col("at").alias("born"))
    upto = Window.partitionBy("repo", "name").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)

    def placed(rows: DataFrame) -> DataFrame:
        """rows (repo, name, at) with the birth of the incarnation that they find."""
        marks = births.select("repo", "name", F.col("born").alias("at"), F.lit(0).alias("side"))
        both = marks.unionByName(rows.select("repo", "name", "at", F.lit(1).alias("side")))
        return both.withColumn("born", F.last(F.when(F.col("side") == 0, F.col("at")), ignorenulls=True).over(upto)).where("side = 1").drop("side")

    came = placed(applied.select("repo", F.col("old").alias("name"), "at")).select("repo", F.col("at").alias("born"), F.col("born").alias("root"))
    roots = births.select("repo", "born").distinct().join(came, ["repo", "born"], "left").select("repo", "born", F.coalesce("root", "born").alias("root"))
    while True:
        roots = materialize(roots, "roots")
        step = roots.select("repo", F.col("born").alias("root"), F.col("root").alias("next"))
        jumped = roots.join(step, ["repo", "root"])
        if jumped.where("root <> next").isEmpty():
            break
        roots = jumped.select("repo", "born", F.col("next").alias("root"))
    lost = real.where("NOT alive AND NOT stood").select("repo", "at")  # drops of names that do not stand have no lineage
    known = ops.join(lost, ["repo", "at"], "left_anti")
    found = placed(known.select("repo", F.col("table_name").alias("name"), "at")).join(roots, ["repo", "born"]).select("repo", "at", F.col("root").alias("lineage"))
    return ops.join(found, ["repo", "at"], "left"), renames


_STATE = "repo string, lineage long, kind string, ord long, name string, type string, options string, columns array<string>, `unique` boolean, referenced_table string, referenced_column string, file string, table_name string, created boolean, born_at long"
_FIELDS = ["repo", "lineage", "kind", "ord", "name", "type", "options", "columns", "unique", "referenced_table", "referenced_column", "file", "table_name", "created", "born_at"]


class Table:
    """One table while its operations are applied in order."""

    def __init__(self, repo: str, lineage: int, name: str, file: str):
        self.repo, self.lineage, self.name, self.file = repo, lineage, name, file
        self.created = self.dropped = False
        self.columns: dict[str, tuple] = {}
        self.indexes: dict[tuple, None] = {}
        self.keys: dict[tuple, None] = {}
        self.warnings: list[tuple] = []

    def warn(self, file: str, what: str, name: str) -> None:
        self.warnings.append((file, what, name))

    def apply(self, x) -> None:
        if x.op == "create_table":
            if self.created:
                return self.warn(x.file, "duplicate create", self.name)
            self.created, self.file = True, x.file
            if x.options != "id=false":
                implicit = x.options[3:] if (x.options or "").startswith("id=") else "id"
                if implicit not in self.columns:
                    self.columns = {implicit: ("integer", "primary_key"), **self.columns}
        elif x.op == "drop_table":
            self.dropped = True
        elif x.op == "rename_table":
            self.name = x.new_name
        elif x.op == "add_column":
            self.columns.setdefault(x.column, (x.type, x.options))
        elif x.op == "add_index":
            self.indexes.setdefault((tuple(x.columns.split(",")), bool(x.unique), x.index_name or ""))
        elif x.op == "add_foreign_key":
            self.keys.setdefault((x.column.split(",")[0], x.referenced_table, x.referenced_column or "id", x.at))
        elif x.op == "remove_column":
            if self.columns.pop(x.column, None) is None:
                self.warn(x.file, "removed column not found", x.column)
            self.indexes = {i: None for i in self.indexes if x.column not in i[0]}
            self.keys = {k: None for k in self.keys if k[0] != x.column}
        elif x.op == "rename_column":
            if x.column not in self.columns:
                return self.warn(x.file, "renamed column not found", x.column)
            swap = lambda c: x.new_name if c == x.column else c
            self.columns = {swap(c): v for c, v in self.columns.items()}
            self.indexes = {(tuple(map(swap, i[0])), *i[1:]): None for i in self.indexes}
            self.keys = {(swap(k[0]), *k[1:]): None for k in self.keys}
        elif x.op == "change_column":
            if x.column not in self.columns:
                self.warn(x.file, "changed column not found", x.column)
            self.columns[x.column] = (x.type, x.options)

    def rows(self) -> Iterator[tuple]:
        head = (self.repo, self.lineage)
        tail = (self.file, self.name, self.created)
        for i, (file, what, name) in enumerate(self.warnings):
            yield (*head, "warning", i, name, what, None, None, None, None, None, file, self.name, self.created, None)
        if self.dropped:
            return
        yield (*head, "table", 0, self.name, None, None, None, None, None, None, *tail, None)
        for i, (name, (kind, options)) in enumerate(self.columns.items()):
            yield (*head, "column", i, name, kind, options, None, None, None, None, *tail, None)
        for i, (columns, unique, name) in enumerate(self.indexes):
            yield (*head, "index", i, name, None, None, list(columns), unique, None, None, *tail, None)
        seen = set()
        for column, table, other, at in self.keys:
            if (column, table, other) not in seen:
                seen.add((column, table, other))
                yield (*head, "foreign_key", len(seen) - 1, column, None, None, None, None, table, other, *tail, at)


def replay(operations: DataFrame) -> DataFrame:
    """The schema after all operations: rows of kind table, column, index, foreign_key and warning.

    The first create of a table wins and brings an integer key 'id' unless its
    options say id=false or id=<name>; adding a column that exists does nothing;
    indexes and keys are sets; a removed column takes those over it along, a
    renamed one carries them; changing an unknown column warns and adds it. A
    drop or rename of an unknown table, and a rename to a name that stands,
    warn and are ignored. Targets of foreign keys follow later renames. Tables
    without a create get a warning. Only the state of one table is in memory.
    """
    ops = ordered(operations)
    traced, renames = lineages(ops)
    void = renames.where("status <> 'applied'").select("repo", "at")
    live = traced.where("lineage IS NOT NULL").join(void, ["repo", "at"], "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, out = None, []
        for batch in batches:
            for x in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                if table is None or (table.repo, table.lineage) != (x.repo, x.lineage):
                    out += [] if table is None else table.rows()
                    table = Table(x.repo, x.lineage, x.table_name, x.file)
                table.apply(x)
            yield pd.DataFrame(out, columns=_FIELDS)
            out = []
        if table is not None:
            yield pd.DataFrame(list(table.rows()), columns=_FIELDS)

    columns = ["repo", "lineage", "at", "file", "op", "table_name", *OPTIONAL]
    state = live.select(*columns).repartition("repo", "lineage").sortWithinPartitions("repo", "lineage", "at").mapInPandas(run, _STATE)
    state = materialize(state, "schema")
    keys = _followed(state.where("kind = 'foreign_key'"), renames.where("status = 'applied'"))
    state = state.where("kind <> 'foreign_key'").unionByName(keys)
    bad = renames.where("status <> 'applied'").join(ops.select("repo", "at", "file"), ["repo", "at"]).select("repo", F.col("old").alias("table_name"), "file", F.when(F.col("status") == "unknown", "rename of unknown table").otherwise("rename collides").alias("type"))
    lost = traced.where("lineage IS NULL AND op = 'drop_table'").select("repo", "table_name", "file", F.lit("drop of unknown table").alias("type"))
    never = state.where("kind = 'table' AND NOT created").select("repo", "table_name", "file", F.lit("never created").alias("type"))
    more = bad.unionByName(lost).unionByName(never).withColumn("kind", F.lit("warning"))
    return state.drop("born_at", "lineage").unionByName(more, allowMissingColumns=True)


def _followed(keys: DataFrame, renames: DataFrame) -> DataFrame:
    """Foreign keys whose target has the name that later renames gave it, followed rename by rename in order of time."""
    later = renames.select(F.col("repo"), F.col("old").alias("referenced_table"), F.col("at").alias("_at"), F.col("new").alias("_new"))
    while True:
        keys = materialize(keys.withColumn("_id", F.monotonically_increasing_id()), "keys")
        met = keys.join(later, ["repo", "referenced_table"]).where("_at > born_at").groupBy("_id").agg(F.min(F.struct("_at", "_new")).alias("_r"))
        if met.isEmpty():
            return keys.drop("_id")
        moved = keys.join(met, "_id", "left")
        keys = moved.withColumn("referenced_table", F.coalesce("_r._new", "referenced_table")).withColumn("born_at", F.coalesce("_r._at", "born_at")).drop("_id", "_r")
