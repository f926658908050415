"""Name and member resolution over class frames: walks up and down the heritage, candidates by existence, routing by status.

classes   repo, fqcn, kind; heritage: repo, fqcn, pos, relation, parent (qualified, already found to exist)
members   repo, fqcn, name, member_kind, return_type
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import conventions as C
from skein.functions import names as N
from skein.operators.relational import first_wins
from skein.session import materialize


def lineage(heritage: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (repo, fqcn, ancestor, depth, trail): each class, itself first, with all it extends or uses, in breadth-first order.

    trail sorts the ancestors of a class in the order of a breadth-first walk
    with parents in the order written; an ancestor met twice counts once, at
    its first place. Rounds double the depth: the part of a shortest way beyond
    depth 2^k starts at a class of exactly that depth, whose own ways are known
    as far. The walk ends when a round finds nothing, at whatever depth.
    """
    up = heritage.where("relation IN ('extends', 'uses')").select("repo", N.norm(F.col("fqcn")).alias("fqcn"), N.norm(F.col("parent")).alias("ancestor"), F.lit(1).alias("depth"), F.array(F.col("pos").cast("int")).alias("trail"))
    own = classes.select("repo", N.norm(F.col("fqcn")).alias("fqcn")).distinct().select("repo", "fqcn", F.col("fqcn").alias("ancestor"), F.lit(0).alias("depth"), F.array().cast("array<int>").alias("trail"))
    known = materialize(first_wins(up.where("fqcn <> ancestor"), ["repo", "fqcn", "ancestor", "depth"], [F.col("trail")]), "lineage")
    reach = 1
    while True:
        far = known.where(F.col("depth") == reach).select("repo", "fqcn", F.col("ancestor").alias("_at"), F.col("trail").alias("_trail"))
        step = far.join(known.withColumnRenamed("fqcn", "_at"), ["repo", "_at"])
        step = step.select("repo", "fqcn", "ancestor", (F.col("depth") + reach).alias("depth"), F.concat("_trail", "trail").alias("trail")).where("fqcn <> ancestor")
        step = first_wins(step, ["repo", "fqcn", "ancestor"], [F.col("depth"), F.col("trail")])
        front = materialize(step.join(known.select("repo", "fqcn", "ancestor"), ["repo", "fqcn", "ancestor"], "left_anti"), "lineage")
        if front.isEmpty():
            break
        known, reach = known.unionByName(front), 2 * reach
    met = known.join(own.select("repo", "fqcn"), ["repo", "fqcn"], "left_semi")
    return own.unionByName(met.select(own.columns))


def children(heritage: DataFrame) -> DataFrame:
    """Rows (repo, parent, child): who extends a class directly."""
    return heritage.where("relation = 'extends'").select("repo", F.col("parent"), F.col("fqcn").alias("child")).distinct()


def walk_members(asked: DataFrame, lines: DataFrame, members: DataFrame, behaviors: DataFrame) -> DataFrame:
    """asked (repo, fqcn, member, static) with owner and rule: chain, behavior or magic_call; null where nothing is found.

    First the members along the heritage, nearest first; then those of the
    behaviors registered on the chain (behaviors: repo, fqcn, pos, behavior) and
    on what they extend; then __call or __callStatic along the chain.
    """
    q = asked.withColumn("_c", N.norm(F.col("fqcn"))).withColumn("_m", N.norm(F.col("member"))).withColumn("_magic", F.when(F.col("static"), "__callstatic").otherwise("__call"))
    keys = q.select("repo", "_c", "_m", "_magic").distinct()
    have = members.where("member_kind IN ('method', 'function')").select("repo", N.norm(F.col("fqcn")).alias("ancestor"), N.norm(F.col("name")).alias("has")).distinct()
    chain = keys.join(lines.withColumnRenamed("fqcn", "_c"), ["repo", "_c"])
    own = chain.join(have, ["repo", "ancestor"])
    named = own.where("has = _m").select("repo", "_c", "_m", "_magic", F.lit(0).alias("rank"), "depth", "trail", F.col("ancestor").alias("owner"), F.lit("chain").alias("rule"))
    magic = own.where("has = _magic").select("repo", "_c", "_m", "_magic", F.lit(2).alias("rank"), "depth", "trail", F.col("ancestor").alias("owner"), F.lit("magic_call").alias("rule"))
    mixed = behaviors.select("repo", N.norm(F.col("fqcn")).alias("ancestor"), F.col("pos").alias("_pos"), N.norm(F.col("behavior")).alias("_b"))
    deep = lines.select("repo", F.col("fqcn").alias("_b"), F.col("ancestor").alias("_owner"), F.col("depth").alias("_depth"), F.col("trail").alias("_trail"))
    via = chain.join(mixed, ["repo", "ancestor"]).join(deep, ["repo", "_b"]).join(have.select("repo", F.col("ancestor").alias("_owner"), F.col("has").alias("_m")), ["repo", "_owner", "_m"])
    via = via.select("repo", "_c", "_m", "_magic", F.lit(1).alias("rank"), "depth", F.concat("trail", F.array(F.col("_pos").cast("int"), F.col("_depth")), "_trail").alias("trail"), F.col("_owner").alias("owner"), F.lit("behavior").alias("rule"))
    best = first_wins(named.unionByName(via).unionByName(magic), ["repo", "_c", "_m", "_magic"], [F.col("rank"), F.col("depth"), F.col("trail"), F.col("owner")])
    return q.join(best.select("repo", "_c", "_m", "_magic", "owner", "rule"), ["repo", "_c", "_m", "_magic"], "left").drop("_c", "_m", "_magic")


def overriding(base: DataFrame, lines: DataFrame, members: DataFrame) -> DataFrame:
    """Rows (repo, fqcn, member, descendant): descendants of a class that declare the member again."""
    q = base.select("repo", N.norm(F.col("fqcn")).alias("ancestor"), N.norm(F.col("member")).alias("has"), "fqcn", "member").distinct()
    below = lines.where("depth > 0").select("repo", "ancestor", F.col("fqcn").alias("descendant"))
    have = members.where("member_kind IN ('method', 'function')").select("repo", N.norm(F.col("fqcn")).alias("descendant"), N.norm(F.col("name")).alias("has")).distinct()
    return q.join(below, ["repo", "ancestor"]).join(have, ["repo", "descendant", "has"]).select("repo", "fqcn", "member", "descendant")


def late_binding(sites: DataFrame, lines: DataFrame, members: DataFrame) -> DataFrame:
    """static::member() sites with status: ambiguous where a descendant overrides the member, else resolved; and how many do."""
    counts = overriding(sites, lines, members).groupBy("repo", "fqcn", "member").agg(F.count_distinct("descendant").alias("overrides"))
    out = sites.join(counts, ["repo", "fqcn", "member"], "left").na.fill(0, ["overrides"])
    return out.withColumn("status", F.when(F.col("overrides") > 0, "ambiguous").otherwise("resolved"))


def property_on_chain(asked: DataFrame, lines: DataFrame, members: DataFrame) -> DataFrame:
    """asked (repo, fqcn, prop) with the nearest class of the heritage that declares the property; null without one."""
    q = asked.withColumn("_c", N.norm(F.col("fqcn"))).withColumn("_m", N.norm(F.col("prop")))
    have = members.where("member_kind = 'property'").select("repo", N.norm(F.col("fqcn")).alias("ancestor"), N.norm(F.col("name")).alias("_m")).distinct()
    hit = q.select("repo", "_c", "_m").distinct().join(lines.withColumnRenamed("fqcn", "_c"), ["repo", "_c"]).join(have, ["repo", "ancestor", "_m"])
    best = first_wins(hit.select("repo", "_c", "_m", "depth", "trail", F.col("ancestor").alias("declared_in")), ["repo", "_c", "_m"], [F.col("depth"), F.col("trail")])
    return q.join(best.select("repo", "_c", "_m", "declared_in"), ["repo", "_c", "_m"], "left").drop("_c", "_m")


def return_class(declared: Column, owner: Column) -> Column:
    """The class name in a declared return type: '?' dropped, self, static and $this stand for the owner, built-in types for none."""
    plain = F.regexp_replace(F.trim(declared), r"^\?", "")
    return F.when(F.lower(plain).isin("self", "static", "$this"), owner).otherwise(F.try_element_at(N.class_types(plain), F.lit(1)))


def entity_of_call(receiver_class: Column, method: Column) -> Column:
    """The entity class that a call on a table returns; null for other calls."""
    return F.when(F.lower(method).isin(*C.ENTITY_RETURNING), C.entity_class(receiver_class))


def function_candidates(text: Column, namespace: Column, alias: Column) -> Column:
    """Ordered names that an unqualified function call may mean: its alias alone; else in the namespace, then global."""
    spaced = F.concat(namespace, F.lit("\\"), text)
    return F.when(alias.isNotNull(), F.array(alias)).when(F.coalesce(namespace, F.lit("")) != "", F.array(spaced, text)).otherwise(F.array(text))


def mark_dynamic(sites: DataFrame, members: DataFrame, cap: int = 5) -> DataFrame:
    """Dynamic sites (repo, site_id, name) with the internal methods of that name, attached only where there are 1 to cap."""
    same = members.where("member_kind IN ('method', 'function')").select("repo", N.norm(F.col("name")).alias("_m"), F.concat_ws("::", "fqcn", "name").alias("candidate")).distinct()
    few = same.groupBy("repo", "_m").agg(F.count("*").alias("n")).where(F.col("n") <= cap)
    return sites.withColumn("_m", N.norm(F.col("name"))).join(same.join(few, ["repo", "_m"]), ["repo", "_m"], "left").drop("_m", "n")


def concrete_for_interface(sites: DataFrame, classes: DataFrame, lines: DataFrame, members: DataFrame) -> DataFrame:
    """sites (repo, site_id, fqcn, member, concrete) with the class to point at: the concrete one, if fqcn is an interface and the concrete's heritage declares the member."""
    q = sites.withColumn("_i", N.norm(F.col("fqcn"))).withColumn("_k", N.norm(F.col("concrete"))).withColumn("_m", N.norm(F.col("member")))
    faces = classes.where("kind = 'interface'").select("repo", N.norm(F.col("fqcn")).alias("_i"), F.lit(True).alias("face")).distinct()
    have = members.where("member_kind = 'method'").select("repo", N.norm(F.col("fqcn")).alias("ancestor"), N.norm(F.col("name")).alias("_m")).distinct()
    sure = lines.withColumnRenamed("fqcn", "_k").join(have, ["repo", "ancestor"]).select("repo", "_k", "_m", F.lit(True).alias("sure")).distinct()
    met = q.join(faces, ["repo", "_i"], "left").join(sure, ["repo", "_k", "_m"], "left")
    return met.withColumn("target", F.when(F.col("face") & F.col("sure"), F.col("concrete")).otherwise(F.col("fqcn"))).drop("_i", "_k", "_m", "face", "sure")
