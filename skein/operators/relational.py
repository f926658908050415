"""Relational operators that the code graph is derived with; every one is DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by a total order, chosen by an aggregate so a hot key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last by a total order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def fan_out(sites: DataFrame, candidates: DataFrame, on: str, cap: int) -> DataFrame:
    """Pairs of sites and their candidates by name, for names with 1 to cap candidates.

    The candidates are counted and cut before the join, so a frequent name never
    multiplies its sites.
    """
    few = candidates.groupBy(on).agg(F.count("*").alias("candidate_count")).where(F.col("candidate_count") <= cap)
    return sites.join(candidates.join(few, on), on)


def fan_out_outcomes(sites: DataFrame, candidates: DataFrame, on: str, cap: int) -> DataFrame:
    """How many sites have no candidate, up to cap, or more (which are counted only)."""
    counts = candidates.groupBy(on).agg(F.count("*").alias("c"))
    outcome = F.when(F.col("c").isNull(), "no_candidates").when(F.col("c") > cap, "fanout_capped").otherwise("heuristic")
    return sites.groupBy(on).agg(F.count("*").alias("n")).join(counts, on, "left").groupBy(outcome.alias("outcome")).agg(F.sum("n").cast("long").alias("n"))


def classify_owners(refs: DataFrame, registry: DataFrame, name: str = "name", source: str = "source", owner: str = "owner") -> DataFrame:
    """refs with status: unowned, local_definition (an own entry wins), ambiguous (several entries, be they of one owner) or owned with its owner.

    Every row of the registry is one entry; entries are counted, not gathered.
    """
    entries = registry.groupBy(name).agg(F.count("*").alias("_entries"), F.min(owner).alias("_owner"))
    own = registry.select(F.col(name), F.col(owner).alias(source), F.lit(True).alias("_own")).distinct()
    out = refs.join(entries, name, "left").join(own, [name, source], "left")
    status = F.when(F.col("_entries").isNull(), "unowned").when(F.col("_own"), "local_definition").when(F.col("_entries") > 1, "ambiguous").otherwise("owned")
    return out.withColumn("status", status).withColumn("owner", F.when(F.col("status") == "owned", F.col("_owner"))).drop("_entries", "_owner", "_own")


def coupling(refs: DataFrame, source: str, target: str, kind: str, kinds: list[str]) -> DataFrame:
    """The matrix of (source, target) pairs with one count per kind, pairs within one source left out."""
    between = refs.where(F.col(source) != F.col(target))
    return between.groupBy(source, target).agg(*[F.sum(F.when(F.col(kind) == k, 1).otherwise(0)).cast("long").alias(k) for k in kinds])


def orphans(edges: DataFrame, key: list[str], ends: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Edges of which at least one end has no node, each once."""
    missing = None
    for column, nodes, pk in ends:
        lost = edges.join(nodes.select(F.col(pk).alias("_pk")), F.col(column) == F.col("_pk"), "left_anti").select(*key)
        missing = lost if missing is None else missing.unionByName(lost)
    return missing.distinct()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def ordered_probe(wanted: DataFrame, key: str, candidates: list[Column], index: DataFrame, name: str) -> DataFrame:
    """Per row the first of its candidate names that the index has; null without any."""
    asked = wanted.select(key, F.posexplode(F.array(*candidates)).alias("pos", "candidate"))
    hit = asked.join(index.select(F.col(name).alias("candidate")).distinct(), "candidate")
    best = hit.groupBy(key).agg(F.min(F.struct("pos", "candidate")).alias("b")).select(key, F.col("b.candidate").alias("resolved"))
    return wanted.join(best, key, "left")


def unique_forward(df: DataFrame, key: str, target: str) -> DataFrame:
    """Keys with exactly one distinct target, and that target."""
    return df.groupBy(key).agg(F.count_distinct(target).alias("n"), F.min(target).alias(target)).where("n = 1").drop("n")


def innermost_span(points: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, order: list[str], width: int) -> DataFrame:
    """Each point with the innermost span (latest start) of its key that contains it; points in no span are left out.

    Spans are cut into buckets of width, so the join is an equi-join on (key,
    bucket) and one long key does not meet all of its spans. Equal points are
    found once and each gets its row.
    """
    keys = points.columns
    counted = points.groupBy(*keys).agg(F.count("*").alias("_times"))
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    met = counted.withColumn("cell", F.floor(F.col(at) / width)).join(cells, [key, "cell"]).where((F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))).drop("cell")
    rest = [c for c in met.columns if c not in (*keys, "_times")]
    best = met.groupBy(*keys, "_times").agg(F.max(F.struct(start, *[c for c in order], *[c for c in rest if c != start and c not in order])).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in rest], F.explode(F.sequence(F.lit(1), "_times")).alias("_nth")).drop("_nth")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """left with the value of the last right row of its key at or before at (one sort of the union by key and time)."""
    marked = left.withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_side", F.lit(1))
    given = right.select(key, at, F.col(value).alias("_v"))
    for c in left.columns:
        if c not in (key, at):
            given = given.withColumn(c, F.lit(None).cast(left.schema[c].dataType))
    both = marked.unionByName(given.withColumn("_side", F.lit(0)))
    w = Window.partitionBy(key).orderBy(F.col(at), F.col("_side"), F.col("_v")).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_side = 1").drop("_side", "_v")


def roll_up(paths: DataFrame, levels: list[str], value: Column, name: str) -> DataFrame:
    """Bottom-up totals: one row per prefix of levels (the total has all levels null), by one rollup aggregate."""
    return paths.rollup(*levels).agg(F.sum(value).cast("long").alias(name), F.grouping_id().alias("_g")).drop("_g")
