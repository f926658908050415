"""A typed property graph over DataFrames and its pattern operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import materialize


@dataclass(frozen=True)
class Edge:
    """An edge table: columns src and dst, and the node labels they point to.

    Where every source node has at most one such edge and its node table holds
    the other end in column key, hops follow that column and rows is not read.
    """

    rows: DataFrame
    source: str
    target: str
    key: str | None = None


@dataclass
class PropertyGraph:
    """Node tables (label to DataFrame with column id) and edge tables (label to Edge)."""

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, Edge] = field(default_factory=dict)

    def match(self, label: str, var: str, where: Column | None = None) -> Pattern:
        return Pattern(self, self._node(label, var, where), {var: label})

    def _node(self, label: str, var: str, where: Column | None = None) -> DataFrame:
        df = self.nodes[label]
        df = df if where is None else df.where(where)
        return df.select(*[F.col(c).alias(f"{var}_{c}") for c in df.columns])


@dataclass
class Pattern:
    """A growing match: one row per assignment of its variables; columns are <variable>_<property>."""

    graph: PropertyGraph
    rows: DataFrame
    labels: dict[str, str]

    def hop(self, start: str, edge: str, to: str, edge_var: str | None = None, reverse: bool = False, where: Column | None = None, edge_where: Column | None = None) -> Pattern:
        """(start)-[edge]->(to), or (start)<-[edge]-(to) with reverse; filters apply before the joins."""
        e = self.graph.edges[edge]
        if e.key and edge_var is None and edge_where is None:
            label, ends = (e.source, (f"{to}_{e.key}", f"{start}_id")) if reverse else (e.target, (f"{start}_{e.key}", f"{to}_id"))
            return Pattern(self.graph, self.rows.join(self.graph._node(label, to, where), F.col(ends[0]) == F.col(ends[1])), self.labels | {to: label})
        table = e.rows if edge_where is None else e.rows.where(edge_where)
        near, far, label = ("dst", "src", e.source) if reverse else ("src", "dst", e.target)
        named = table.select(F.col(near).alias("_near"), F.col(far).alias("_far"), *[F.col(c).alias(f"{edge_var}_{c}") for c in table.columns if edge_var and c not in ("src", "dst")])
        rows = self.rows.join(named, F.col(f"{start}_id") == F.col("_near")).drop("_near")
        rows = rows.join(self.graph._node(label, to, where), F.col("_far") == F.col(f"{to}_id")).drop("_far")
        return Pattern(self.graph, rows, self.labels | {to: label})


def walks(edges: DataFrame, low: int, high: int, starts: DataFrame | None = None, distinct: bool = False) -> DataFrame:
    """Bounded walks src->{low,high}: rows (start, end, depth, n) with n the number of walks; distinct drops depth and n.

    A frontier holds each (start, end) pair once with its multiplicity, so
    nodes and edges may repeat and the count stays exact without listing walks.
    Every second step is written out, which keeps plans short.
    """
    e = edges.groupBy("src", "dst").agg(F.count("*").alias("m"))
    front = e.select(F.col("src").alias("start"), F.col("dst").alias("end"), F.col("m").alias("n"))
    if starts is not None:
        front = front.join(starts.select(F.col("id").alias("start")).distinct(), "start", "left_semi")
    out = None
    for depth in range(1, high + 1):
        if depth > 1:
            front = front.join(e, F.col("end") == F.col("src")).groupBy("start", F.col("dst").alias("end")).agg((F.sum(F.lit(1)) if distinct else F.sum(F.col("n") * F.col("m"))).alias("n"))
            if depth % 2 == 0:
                front = materialize(front, "walks")
        if depth >= low:
            part = front.select("start", "end") if distinct else front.select("start", "end", F.lit(depth).alias("depth"), F.col("n").cast("long").alias("n"))
            out = part if out is None else out.unionByName(part)
    return out.distinct() if distinct else out


def cycles(edges: DataFrame, low: int, high: int) -> DataFrame:
    """Nodes on closed walks of low to high edges, and the least length: rows (node, length)."""
    e = materialize(edges.select("src", "dst").distinct(), "cycles")
    front = e.select(F.col("src").alias("start"), F.col("dst").alias("end"))
    found = None
    for depth in range(1, high + 1):
        if depth > 1:  # pairs, not walks: how often a pair is reached does not matter
            front = materialize(front.join(e, F.col("end") == F.col("src")).select("start", F.col("dst").alias("end")).distinct(), "cycles")
        if depth >= low:
            part = front.where("start = end").select(F.col("start").alias("node"), F.lit(depth).alias("length"))
            found = part if found is None else found.unionByName(part)
    return found.groupBy("node").agg(F.min("length").alias("length"))


def closure(edges: DataFrame) -> DataFrame:
    """All (start, end) pairs joined by a path, with the least distance.

    Rounds double the length: what lies beyond 2^k is reached from a node at
    exactly that distance, from which everything up to 2^k is known. It ends
    when a round finds nothing new, however long the paths are.
    """
    e = materialize(edges.select("src", "dst").distinct(), "closure")
    known = e.select(F.col("src").alias("start"), F.col("dst").alias("end"), F.lit(1).alias("distance"))
    reach = 1
    while True:
        far = known.where(F.col("distance") == reach).select("start", F.col("end").alias("_at"))
        step = far.join(known.withColumnRenamed("start", "_at"), "_at").groupBy("start", "end").agg((F.min("distance") + reach).alias("distance"))
        front = materialize(step.join(known, ["start", "end"], "left_anti"), "closure")
        if front.isEmpty():
            break
        known, reach = known.unionByName(front), 2 * reach
    return known


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current catalog: rows (table_name, kind)."""
    return spark.createDataFrame([(t.name, t.tableType) for t in spark.catalog.listTables()], "table_name string, kind string")


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    """Columns of a table in order: rows (column, type)."""
    return spark.createDataFrame([(c.name, c.dataType) for c in spark.catalog.listColumns(table)], "`column` string, type string")


def run_query(spark: SparkSession, query: str, most: int = 50, width: int = 500) -> dict:
    """A query's answer or error as one dict: the first rows with cells cut to width, and the full number of rows."""
    try:
        df = spark.sql(query)
        cells = [F.substring(F.col(f"`{c}`").cast("string"), 1, width).alias(c) for c in df.columns]
        return {"status": "success", "query": query, "row_count": df.count(), "results": [r.asDict() for r in df.limit(most).select(*cells).collect()]}
    except PySparkException as error:
        return {"status": "error", "query": query, "error_message": str(error)}
