"""References between repositories: strict class names, ownership, import attribution, calls and wiring.

registry   norm_fqcn, repo, fqcn, class_id: the app classes of every repository
aliases    repo, path, alias, fqcn, ord: the `use` lines of a file
references repo, path, namespace, class_id (null in files without classes), kind, text
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import names as N
from skein.operators.relational import classify_owners, first_wins, last_wins
from skein.plans.codegraph import file_id


def registry(classes: DataFrame) -> DataFrame:
    """Classes of the app (vendor copies define nothing), by name in lower case."""
    own = classes.where("fqcn <> ''").where(N.origin(F.col("path")) == "app")
    return own.select(N.norm(F.col("fqcn")).alias("norm_fqcn"), "repo", "fqcn", N.make_id("class", F.col("repo"), F.col("path"), F.col("fqcn")).alias("class_id")).distinct()


def alias_map(aliases: DataFrame) -> DataFrame:
    """(repo, path, alias in lower case) to name; the last use of an alias wins."""
    rows = aliases.select("repo", "path", N.norm(F.col("alias")).alias("alias"), "fqcn", "ord")
    return last_wins(rows, ["repo", "path", "alias"], [F.col("ord"), F.col("fqcn")]).drop("ord")


def strict_names(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """rows (repo, path, namespace, text, ..) with the name that text stands for by the language's rules, never the global one.

    A leading backslash is absolute, 'namespace\\X' is relative, an alias
    replaces the first segment, and all else lies in the current namespace.
    """
    return _met(rows, aliases).drop("first", "_alias", "_aliased")


def _met(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """strict_names with the first segment of text and the alias that it met: rows meet the aliases of their file once."""
    cut = rows.withColumn("first", N.norm(F.substring_index("text", "\\", 1)))
    known = alias_map(aliases).select("repo", "path", F.col("alias").alias("first"), F.col("fqcn").alias("_alias"), F.lit(True).alias("_aliased"))
    met = cut.join(known, ["repo", "path", "first"], "left")
    rest = F.regexp_replace("text", r"^[^\\]*", "")
    here = F.when(F.coalesce("namespace", F.lit("")) != "", F.concat("namespace", F.lit("\\"), "text")).otherwise(F.col("text"))
    there = F.regexp_replace("text", r"^[^\\]*\\", "")
    relative = F.when(F.coalesce("namespace", F.lit("")) != "", F.concat("namespace", F.lit("\\"), there)).otherwise(there)
    name = F.when(F.coalesce("text", F.lit("")) == "", "").when(F.col("text").startswith("\\"), F.regexp_replace("text", r"^\\+", "")).when((F.col("first") == "namespace") & F.col("text").contains("\\"), relative).when(F.col("_alias").isNotNull(), F.concat("_alias", rest)).otherwise(here)
    return met.withColumn("strict", name)


def candidate_names(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """rows with the ordered candidate names of text: the strict one, and for a plain name without alias the global one after it."""
    met = _met(rows, aliases)
    both = F.when(F.col("_aliased").isNotNull() | F.col("text").startswith("\\") | (F.col("first") == "namespace"), F.array("strict")).otherwise(F.array_distinct(F.array("strict", "text")))
    return met.withColumn("candidates", both).drop("first", "_alias", "_aliased")


def class_references(references: DataFrame, aliases: DataFrame) -> DataFrame:
    """References by kind with their strict names.

    Kinds extends, implements, uses, new and instanceof stay; class_literal is a
    class_ref; a callable_string is one too, and already absolute; declared
    types (kind type) are split into type_hints; array_callable names no class.
    """
    typed = references.where("kind = 'type'").withColumn("text", F.explode(N.class_types(F.col("text")))).withColumn("kind", F.lit("type_hint"))
    named = references.where("kind IN ('extends', 'implements', 'uses', 'new', 'instanceof', 'class_literal')").withColumn("kind", F.when(F.col("kind") == "class_literal", "class_ref").otherwise(F.col("kind")))
    text = references.where("kind = 'callable_string'").withColumn("kind", F.lit("class_ref")).withColumn("strict", F.regexp_replace("text", r"^\\+", ""))
    return strict_names(named.unionByName(typed), aliases).unionByName(text).where("strict <> ''")


def _owned(refs: DataFrame, known: DataFrame) -> DataFrame:
    """References whose name has exactly one entry, in another repository, with that entry: one join, on the names with one entry."""
    entry = F.struct(F.col("repo").alias("owner"), F.col("fqcn").alias("symbol"), F.col("class_id").alias("target_class"))
    single = known.groupBy(F.col("norm_fqcn").alias("name")).agg(F.count("*").alias("_n"), F.min(entry).alias("_e")).where("_n = 1 AND _e.owner IS NOT NULL").select("name", "_e.*")
    return refs.withColumn("name", N.norm(F.col("strict"))).join(single, "name").where("NOT (owner <=> repo)")


def cross_refs(references: DataFrame, aliases: DataFrame, known: DataFrame) -> DataFrame:
    """CrossRepoRef: one edge per class, target class and kind, for references made inside classes of the app."""
    own = references.where("class_id IS NOT NULL").where(N.origin(F.col("path")) == "app")
    return _edges(_owned(class_references(own, aliases), known))


def _edges(rows: DataFrame) -> DataFrame:
    return _with_ids(_ends(rows).distinct())


def _ends(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("class_id").alias("source_class"), "target_class", "kind", F.col("repo").alias("source_repo"), F.col("owner").alias("target_repo"), "symbol")


def _with_ids(edges: DataFrame) -> DataFrame:
    return edges.select(N.make_id("xref", F.col("source_class"), F.col("target_class"), F.col("kind")).alias("edge_id"), "*")


def import_refs(aliases: DataFrame, mentions: DataFrame, holders: DataFrame, known: DataFrame) -> DataFrame:
    """Edges of kind import: a `use` of another repository's class belongs to the classes that mention its alias.

    mentions are rows (repo, path, class_id, token in lower case), holders the
    classes (repo, path, class_id) of each file. An alias that no class
    to file_refs. A class stands in one file, so a name that has one alias in
    its file gives each class one edge; only names with several are compared.
    """
    uses = aliases.where(N.origin(F.col("path")) == "app").groupBy("repo", "path", N.norm(F.col("fqcn")).alias("strict")).agg(F.collect_set(F.struct(N.norm(F.col("alias")).alias("token"))).alias("_t"))
    owned = _owned(uses.select("repo", "path", "strict", (F.size("_t") == 1).alias("single"), F.explode("_t").alias("_t")).select("repo", "path", "strict", "single", "_t.token"), known)
    named = owned.join(mentions.distinct(), ["repo", "path", "token"])
    rest = owned.join(mentions.select("repo", "path", "token").distinct(), ["repo", "path", "token"], "left_anti").join(holders.distinct(), ["repo", "path"])
    columns = ["repo", "owner", "symbol", "target_class", "class_id", "single"]
    rows = named.select(*columns).unionByName(rest.select(*columns)).withColumn("kind", F.lit("import"))
    return _with_ids(_ends(rows.where("single")).unionByName(_ends(rows.where("NOT single")).distinct()))


def file_refs(aliases: DataFrame, references: DataFrame, holders: DataFrame, known: DataFrame) -> DataFrame:
    """CrossRepoFileRef: imports and references of functions in files without classes; one edge per file, target and kind."""
    bare = lambda df: df.where(N.origin(F.col("path")) == "app").join(holders.select("repo", "path").distinct(), ["repo", "path"], "left_anti")
    used = bare(aliases).select("repo", "path", F.col("fqcn").alias("strict"), F.lit("import").alias("kind"))
    made = class_references(bare(references), aliases).select("repo", "path", "strict", "kind")
    rows = _owned(used.unionByName(made), known).select(file_id().alias("source_file"), "target_class", F.col("repo").alias("source_repo"), F.col("owner").alias("target_repo"), "symbol", "kind").distinct()
    return rows.select(N.make_id("xfref", F.col("source_file"), F.col("target_class"), F.col("kind")).alias("edge_id"), "*")


def function_calls(sites: DataFrame, candidates: list[Column], functions: DataFrame) -> DataFrame:
    """CrossRepoCalls to functions: the first candidate name that any repository defines decides.

    sites are (repo, caller_method, ..), functions (name, repo, method_id). A
    local definition or several owners make no edge. Sites with the same caller
    and candidates are one question, so no site needs an id.
    """
    names = [f"_c{i}" for i in range(len(candidates))]
    asked = sites.select("repo", "caller_method", *[N.norm(c).alias(n) for c, n in zip(candidates, names)]).distinct()
    defined = functions.select(N.norm(F.col("name")).alias("_defined")).distinct()
    for i, n in enumerate(names):
        asked = asked.join(defined.withColumnRenamed("_defined", f"_d{i}"), F.col(n) == F.col(f"_d{i}"), "left")
    asked = asked.select("repo", "caller_method", F.coalesce(*[f"_d{i}" for i in range(len(names))]).alias("name")).where("name IS NOT NULL").distinct()
    index = functions.select(N.norm(F.col("name")).alias("name"), F.col("repo").alias("owner"), "method_id")
    owned = classify_owners(asked, index, source="repo").where("status = 'owned'")
    return _calls(owned.join(index, ["name", "owner"]).withColumn("symbol", F.col("name")))


def _calls(rows: DataFrame) -> DataFrame:
    best = rows.where("caller_method <> method_id").groupBy("caller_method", F.col("method_id").alias("callee_method"), F.col("repo").alias("source_repo"), F.col("owner").alias("target_repo")).agg(F.min("symbol").alias("symbol"))
    return best.select(N.make_id("xcall", F.col("caller_method"), F.col("callee_method")).alias("edge_id"), "*")


def method_calls(sites: DataFrame, aliases: DataFrame, declared: DataFrame, known: DataFrame) -> DataFrame:
    """CrossRepoCalls through a typed receiver: sites (repo, path, namespace, caller_method, text, member), text the receiver's class as written.

    declared are rows (name, member, owner_class, method_id): for every class
    the members it has by itself or inherits, by descendants' names. The callee
    must be declared by a class whose owner is another repository alone.
    """
    named = strict_names(sites, aliases).where("strict <> ''")
    have = declared.select(N.norm(F.col("name")).alias("name"), N.norm(F.col("member")).alias("_member"), F.col("owner_class").alias("strict"), "method_id")
    met = named.select("repo", "caller_method", N.norm(F.col("strict")).alias("name"), N.norm(F.col("member")).alias("_member")).join(have, ["name", "_member"])
    rows = _owned(met.drop("name"), known)
    return _calls(rows.withColumn("symbol", F.concat("symbol", F.lit("::"), "_member")))


def wiring(bindings: DataFrame, known: DataFrame) -> DataFrame:
    """DiBinds and DiInjects across repositories: bindings (binding_id, repo, kind, source, target) with strict names.

    An end is the wiring repository's own class where it has exactly one, else
    the only class of that name; several make none. Pairs inside the wiring repository are left out,
    pairs inside a third one stay.
    """
    owners = known.groupBy("norm_fqcn").agg(F.count("*").alias("n"), F.min(F.struct("repo", "class_id")).alias("any"))
    own = known.groupBy("norm_fqcn", "repo").agg(F.count("*").alias("n"), F.min("class_id").alias("class_id")).where("n = 1")
    rows = bindings
    for end in ("source", "target"):
        a = owners.select(F.col("norm_fqcn").alias(f"{end}_norm"), F.col("n").alias(f"{end}_n"), F.col("any").alias(f"{end}_any"))
        b = own.select(F.col("norm_fqcn").alias(f"{end}_norm"), "repo", F.col("class_id").alias(f"{end}_own"))
        rows = rows.withColumn(f"{end}_norm", N.norm(F.col(end))).join(a, f"{end}_norm").join(b, [f"{end}_norm", "repo"], "left")
        single = F.col(f"{end}_n") == 1
        rows = rows.withColumn(f"{end}_repo", F.when(F.col(f"{end}_own").isNotNull(), F.col("repo")).when(single, F.col(f"{end}_any.repo"))).withColumn(f"{end}_class", F.when(F.col(f"{end}_own").isNotNull(), F.col(f"{end}_own")).when(single, F.col(f"{end}_any.class_id")))
    kept = rows.where("source_class <> target_class AND NOT (source_repo = repo AND target_repo = repo)")
    best = kept.groupBy("kind", "source_class", "target_class", "source_repo", "target_repo").agg(F.min("target").alias("symbol"))
    edge = F.when(F.col("kind") == "bind", N.make_id("xbind", F.col("source_class"), F.col("target_class"))).otherwise(N.make_id("xinject", F.col("source_class"), F.col("target_class")))
    return best.select(edge.alias("edge_id"), "*")


def dropped(refs: DataFrame, known: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent two-segment namespaces among the names that no repository defines: rows (prefix, n names)."""
    lost = classify_owners(refs.withColumn("name", N.norm(F.col("strict"))), known.select(F.col("norm_fqcn").alias("name"), F.col("repo").alias("owner")), source="repo").where("status = 'unowned'")
    return lost.groupBy(F.substring_index("strict", "\\", 2).alias("prefix")).agg(F.count_distinct("strict").alias("n")).orderBy(F.desc("n"), "prefix").limit(most)


def drop_report(refs: DataFrame, bindings: DataFrame, known: DataFrame) -> DataFrame:
    """Everything that got no edge, and why: rows (reason, name, n).

    ambiguous: a name with several entries, and in how many repositories they
    are; unowned_refs and local_definition: references; di_unowned and
    di_ambiguous: ends of bindings.
    """
    index = known.select(F.col("norm_fqcn").alias("name"), F.col("repo").alias("owner"))
    told = classify_owners(refs.withColumn("name", N.norm(F.col("strict"))), index, source="repo")
    counts = told.where("status IN ('unowned', 'local_definition')").groupBy(F.when(F.col("status") == "unowned", "unowned_refs").otherwise("local_definition").alias("reason")).agg(F.count("*").alias("n"))
    ends = bindings.select("repo", F.explode(F.array("source", "target")).alias("strict")).withColumn("name", N.norm(F.col("strict")))
    entries = index.groupBy("name").agg(F.count("*").alias("entries"), F.count_distinct("owner").alias("n"))
    own = index.groupBy("name", F.col("owner").alias("repo")).agg(F.count("*").alias("own"))
    met = ends.join(entries, "name", "left").join(own, ["name", "repo"], "left")
    reason = F.when(F.col("entries").isNull(), "di_unowned").when((F.col("entries") > 1) & (F.coalesce("own", F.lit(0)) != 1), "di_ambiguous")
    ends_lost = met.withColumn("reason", reason).where("reason IS NOT NULL")
    several = told.where("status = 'ambiguous'").select("name").unionByName(ends_lost.where("reason = 'di_ambiguous'").select("name")).distinct().join(entries, "name")
    counts = counts.unionByName(ends_lost.groupBy("reason").agg(F.count("*").alias("n")))
    return counts.select("reason", F.lit("").alias("name"), "n").unionByName(several.select(F.lit("ambiguous").alias("reason"), "name", "n"))
