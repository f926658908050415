"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of edges (a long, b long): the smallest node that is reachable.

    Every round hooks each node to its least smaller neighbour, jumps pointers
    until the trees are flat and contracts the edges; all rounds are written to
    the shared folder, and only counts reach the driver. Loops and repeated
    edges do no harm; an edge with a null end is left out.
    """
    left = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    left = materialize(left, "edges")
    nodes = left.select(F.col("u").alias("node")).union(left.select("v")).distinct()
    labels = nodes.withColumn("component", F.col("node"))
    while not left.isEmpty():
        up = materialize(left.groupBy("v").agg(F.min("u").alias("p")), "parents")
        far = up.select(F.col("v").alias("q"), F.col("p").alias("pp"))
        for _ in range(2):  # trees are shallow after few jumps; what is left is contracted in the next round
            up = up.join(far, up.p == far.q, "left").select("v", F.coalesce("pp", "p").alias("p"))
        up = materialize(up, "parents")
        labels = materialize(labels.join(up, labels.component == up.v, "left").select("node", F.coalesce("p", "component").alias("component")), "labels")
        # a node whose tree was deeper still points at one that is no root: keep that as an edge
        above = up.select(F.col("v").alias("k"), F.col("p").alias("kp"))
        deep = up.join(above, up.p == above.k).select(F.col("p").alias("u"), F.col("kp").alias("v"))
        for end in ("u", "v"):
            one = up.select(F.col("v").alias("k"), F.col("p").alias("kp"))
            left = left.join(one, F.col(end) == one.k, "left").withColumn(end, F.coalesce("kp", end)).drop("k", "kp")
        left = materialize(left.unionByName(deep).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    return labels
