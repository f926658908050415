"""Nodes and edges of the code graph, derived from flat entity, resolution and schema frames.

files      repo, path, origin, summary
classes    repo, path, ord, name, namespace, fqcn, kind, modifiers, start_line, end_line
members    repo, path, ord, class_name, namespace, fqcn, name, member_kind, modifiers, return_type, parameters, start_line, end_line
records    repo, path, section (calls, props, class_refs, inherits, imports), ord, class_name, fqcn, member, name, status, via, relation, line,
           target_path, target_owner, target_member, string_path, callable_path, callable_owner, callable_member
candidates repo, path, section, ord, pos, target_path, target_owner, target_member
topics     repo, name, summary, linked_file (one row per linked file)
tables     repo, name, source_file; columns (.., ord, column, type), indexes and foreign_keys of them

A missing string is '' as in the graph; every frame holds several repositories,
and no edge crosses them. An owner is a class's qualified name, or its plain
name without one. Identifiers compare without case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import names as N
from skein.operators.relational import first_wins, last_wins
from skein.session import materialize
from skein.sources.scan import directories

SITE = ["repo", "path", "section", "ord"]


def owner(fqcn: str = "fqcn", name: str = "class_name") -> Column:
    return F.when(F.coalesce(F.col(fqcn), F.lit("")) != "", F.col(fqcn)).otherwise(F.col(name))


def file_id() -> Column:
    return N.make_id("file", F.col("repo"), F.col("path"))


# nodes


def file_nodes(files: DataFrame) -> DataFrame:
    """One row per scanned file."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(file_id().alias("file_id"), name.alias("file_name"), F.regexp_extract(name, r"^.+(\.[^.]*)$", 1).alias("extension"), F.regexp_replace("path", "/?[^/]*$", "").alias("directory"), "path", F.coalesce("origin", F.lit("app")).alias("origin"), F.substring(F.coalesce("summary", F.lit("")), 1, 4000).alias("summary"), "repo")


def class_nodes(classes: DataFrame) -> DataFrame:
    """One row per class id; a later class of the same id in a file wins. Classes without a name are left out."""
    known = owner("fqcn", "name")
    rows = classes.where("name <> ''").select(N.make_id("class", F.col("repo"), F.col("path"), known).alias("class_id"), "name", "namespace", "fqcn", file_id().alias("file_id"), "kind", "modifiers", "start_line", "end_line", N.origin(F.col("path")).alias("origin"), F.concat(known, F.lit(": "), "kind").alias("summary"), "repo", "ord")
    return last_wins(rows, ["class_id"], [F.col("ord")]).drop("ord")


def method_nodes(members: DataFrame) -> DataFrame:
    """One row per member id (methods, functions, properties, enum cases); a later one of the same id wins."""
    full = N.member_name(F.col("fqcn"), F.col("name"), F.col("class_name"), F.col("namespace"))
    class_id = N.make_id("class", F.col("repo"), F.col("path"), owner())
    method_id = N.make_id("method", F.col("repo"), F.col("path"), owner(), F.col("name"))
    text = N.signature(F.col("return_type"), F.col("class_name"), F.col("name"), F.col("parameters"))
    rows = members.where("name <> '' AND class_name <> ''").select(method_id.alias("method_id"), "name", class_id.alias("class_id"), file_id().alias("file_id"), full.alias("fqmn"), text.alias("signature"), "modifiers", "return_type", "start_line", "end_line", N.origin(F.col("path")).alias("origin"), full.alias("summary"), "repo", "member_kind", "ord")
    return last_wins(rows, ["method_id"], [F.col("ord")]).drop("ord")


def module_nodes(topics: DataFrame) -> DataFrame:
    rows = topics.where("name <> ''").select(N.make_id("module", F.col("repo"), F.col("name")).alias("module_id"), "name", F.substring(F.coalesce("summary", F.lit("")), 1, 4000).alias("summary"), "repo")
    return rows.groupBy("module_id", "name", "repo").agg(F.max("summary").alias("summary"))


def directory_nodes(files: DataFrame) -> DataFrame:
    """Every ancestor directory of a file, the root ('.') included."""
    dirs = directories(files, extra=["repo"])
    return dirs.select(N.make_id("dir", F.col("repo"), F.col("dir")).alias("dir_id"), F.element_at(F.split("dir", "/"), -1).alias("name"), "repo", "dir", "parent", "depth")


def _packed(rows: DataFrame, fields: list[str], name: str) -> DataFrame:
    """repo, table, and the rows of a table as one JSON list in order."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("ord", *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return rows.groupBy("repo", "table_name").agg(F.to_json(items).alias(name), F.count("*").alias(f"n_{name}"))


def table_nodes(tables: DataFrame, columns: DataFrame, indexes: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """One row per table, with its columns, indexes and foreign keys as JSON."""
    out = tables.withColumnRenamed("name", "table_name")
    parts = [(columns, ["name", "type"], "columns"), (indexes, ["columns", "unique", "name"], "indexes"), (foreign_keys, ["column", "referenced_table", "referenced_column"], "foreign_keys")]
    for frame, fields, name in parts:
        out = out.join(_packed(frame, fields, name), ["repo", "table_name"], "left")
    summary = F.concat("table_name", F.lit(": "), F.coalesce("n_columns", F.lit(0)).cast("string"), F.lit(" columns"))
    json = [F.coalesce(c, F.lit("[]")).alias(c) for c in ("columns", "indexes", "foreign_keys")]
    return out.select(table_id().alias("table_id"), F.col("table_name").alias("name"), *json, "source_file", F.coalesce(N.plugin_of(F.col("source_file")), F.lit("")).alias("plugin"), summary.alias("summary"), "repo")


def table_id(name: str = "table_name") -> Column:
    return N.make_id("dbtable", F.col("repo"), F.col(name))


def graph_meta(files: DataFrame, target_dir: str, id_scheme: int, id_prefix: str) -> DataFrame:
    """One row per repository: what later runs need to rebuild its ids."""
    return files.select("repo").distinct().select("repo", F.lit(target_dir).alias("target_dir"), F.lit(id_scheme).alias("id_scheme"), F.lit(id_prefix).alias("id_prefix"))


# lookup tables


def class_index(classes: DataFrame, prefix: str) -> DataFrame:
    """(repo, path, owner in lower case) to class id; a class answers to its qualified and to its plain name, the qualified one first."""
    rows = classes.where("name <> ''").select("repo", "path", F.explode(F.array(F.struct(F.lit(0).alias("rank"), owner("fqcn", "name").alias("key")), F.struct(F.lit(1).alias("rank"), F.col("name").alias("key")))).alias("k"), N.make_id("class", F.col("repo"), F.col("path"), owner("fqcn", "name")).alias("id"), "ord")
    rows = rows.select("repo", "path", N.norm(F.col("k.key")).alias("key"), "id", F.col("k.rank").alias("rank"), "ord")
    return first_wins(rows, ["repo", "path", "key"], [F.col("rank"), F.col("ord"), F.col("id")]).select("repo", F.col("path").alias(f"{prefix}_path"), F.col("key").alias(f"{prefix}_key"), F.col("id").alias(f"{prefix}_id"))


def method_index(members: DataFrame, prefix: str) -> DataFrame:
    """(repo, path, owner, member in lower case) to method id; an owner is a qualified or a plain class name."""
    named = members.where("name <> '' AND class_name <> ''")
    rows = named.select("repo", "path", F.explode(F.array(F.struct(F.lit(0).alias("rank"), owner().alias("key")), F.struct(F.lit(1).alias("rank"), F.col("class_name").alias("key")))).alias("k"), N.norm(F.col("name")).alias("member"), N.make_id("method", F.col("repo"), F.col("path"), owner(), F.col("name")).alias("id"), "ord")
    best = rows.groupBy("repo", "path", N.norm(F.col("k.key")).alias("key"), "member").agg(F.min(F.struct("k.rank", "ord", "id"))["id"].alias("id"))
    return best.select("repo", *[F.col(c).alias(f"{prefix}_{c}") for c in ("path", "key", "member", "id")])


def _find_method(rows: DataFrame, members: DataFrame, path: str, key: str, member: str, found: str) -> DataFrame:
    """rows with the id of the method that path, owner and member name; null without one."""
    m = method_index(members, "m")
    on = (rows.repo == m.repo) & (rows[path] == m.m_path) & (N.norm(rows[key]) == m.m_key) & (N.norm(rows[member]) == m.m_member)
    return rows.join(m, on, "left").select(rows["*"], F.col("m_id").alias(found))


def _callers(records: DataFrame, members: DataFrame) -> DataFrame:
    return _find_method(records.withColumn("_owner", owner()), members, "path", "_owner", "member", "caller_id")


def _rank() -> Column:
    """The order in which a file's sections are read."""
    return F.when(F.col("section") == "calls", 0).when(F.col("section") == "props", 1).otherwise(2)


_INSIDE = "target_path IS NOT NULL AND target_path <> ''"


def _scanned(rows: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Rows whose path was scanned in their repository."""
    return rows.join(files.select("repo", F.col("path").alias(path)).distinct(), ["repo", path], "left_semi")


# calls


def method_calls(records: DataFrame, members: DataFrame, files: DataFrame) -> DataFrame:
    """MethodCalls: callable literals, resolved calls and properties, then class references with a member.

    One edge per (caller, callee): the first by file, section and record wins,
    a literal before its own record. A method that calls itself has no edge.
    """
    sites = _callers(records.where("section IN ('calls', 'props', 'class_refs')"), members)
    common = ["repo", "path", "caller_id", _rank().alias("rank"), "ord", "line"]
    literal = sites.where("section <> 'class_refs' AND callable_path <> ''").select(*common, F.lit(0).alias("sub"), F.col("callable_path").alias("p"), F.col("callable_owner").alias("o"), F.col("callable_member").alias("m"), F.col("callable_member").alias("callee_name"), F.lit("convention:callable_literal").alias("resolution"))
    named = F.when(F.coalesce("name", F.lit("")) != "", F.col("name")).otherwise(F.col("target_member"))
    via = F.when(F.col("section") == "class_refs", F.coalesce(F.nullif("via", F.lit("")), F.lit("convention:array_callable"))).otherwise(F.coalesce("via", F.lit("")))
    direct = sites.where(f"status = 'resolved' AND {_INSIDE} AND target_member <> ''").select(*common, F.lit(1).alias("sub"), F.col("target_path").alias("p"), F.col("target_owner").alias("o"), F.col("target_member").alias("m"), named.alias("callee_name"), via.alias("resolution"))
    both = _find_method(_scanned(literal.unionByName(direct), files, "p"), members, "p", "o", "m", "callee_id")
    edges = both.where("caller_id <> callee_id").select(F.col("caller_id").alias("caller_method"), F.col("callee_id").alias("callee_method"), "callee_name", "resolution", F.col("line").alias("call_line"), "path", "rank", "ord", "sub")
    best = first_wins(edges, ["caller_method", "callee_method"], [F.col(c) for c in ("path", "rank", "ord", "sub")])
    return best.select(N.make_id("calls", F.col("caller_method"), F.col("callee_method")).alias("edge_id"), "caller_method", "callee_method", "callee_name", "resolution", "call_line")


def _asked(records: DataFrame, candidates: DataFrame, members: DataFrame) -> DataFrame:
    """What call and property records without a target ask of the members, written once.

    Rows (SITE, site, name, status, own, pos, id): with site, an ambiguous or
    unresolved record, its caller, and own, its member in lower case; without,
    a candidate that exists.
    """
    sites = records.where("section IN ('calls', 'props') AND status NOT IN ('resolved', 'external', 'dynamic')")
    sites = sites.select(*SITE, F.lit(True).alias("site"), "name", "status", F.lit(None).cast("long").alias("pos"), F.col("path").alias("p"), owner().alias("o"), F.col("member").alias("m"))
    none = F.lit(None).cast("string")
    found = candidates.select(*SITE, F.lit(False).alias("site"), none.alias("name"), none.alias("status"), F.col("pos").cast("long").alias("pos"), F.col("target_path").alias("p"), F.col("target_owner").alias("o"), F.col("target_member").alias("m"))
    met = _find_method(sites.unionByName(found), members, "p", "o", "m", "id").where("site OR id IS NOT NULL")
    return materialize(met.select(*SITE, "site", "name", "status", F.when(F.col("site"), N.norm(F.col("m"))).alias("own"), "pos", "id"), "asked")


def _ambiguous(asked: DataFrame) -> DataFrame:
    """Ambiguous call and property records with the ids of their known candidates (before repeats are dropped)."""
    sites = asked.where("site AND status = 'ambiguous'").select(*SITE, "name", F.col("id").alias("caller_id"))
    ids = asked.where("NOT site").groupBy(*SITE).agg(F.array_sort(F.collect_list(F.struct("pos", F.col("id").alias("callee_id")))).alias("ids"))
    return sites.join(ids, SITE, "left").withColumn("n_ids", F.coalesce(F.size("ids"), F.lit(0)))


def _namesakes(members: DataFrame) -> DataFrame:
    """Methods and functions by name in lower case, each once."""
    rows = members.where("name <> '' AND class_name <> '' AND member_kind IN ('method', 'function')")
    return rows.select("repo", N.norm(F.col("name")).alias("key"), N.make_id("method", F.col("repo"), F.col("path"), owner(), F.col("name")).alias("callee_id")).distinct()


def _unresolved(asked: DataFrame, same: DataFrame) -> DataFrame:
    """Unresolved call and property records that have a name, and how many methods other than the caller bear it (same: the namesakes).

    Only a record that names its own member can have its caller among them.
    """
    sites = asked.where("site AND status <> 'ambiguous'").withColumn("key", N.norm(F.coalesce("name", F.lit("")))).select("path", "repo", "section", "ord", "name", "key", "own", F.col("id").alias("caller_id"))
    counts = same.groupBy("repo", "key").agg(F.count("*").alias("namesakes"))
    met = sites.join(counts, ["repo", "key"], "left").withColumn("_self", F.coalesce(F.col("own") == F.col("key"), F.lit(False)) & F.col("namesakes").isNotNull())
    me = same.select("repo", "key", F.col("callee_id").alias("caller_id"), F.lit(1).alias("_one"))
    met = met.where("_self").join(me, ["repo", "key", "caller_id"], "left").unionByName(met.where("NOT _self").withColumn("_one", F.lit(None).cast("int")))
    return met.withColumn("others", F.coalesce("namesakes", F.lit(0)) - F.coalesce("_one", F.lit(0))).drop("_self", "_one", "own")


def possibly_calls(records: DataFrame, candidates: DataFrame, members: DataFrame, cap: int = 5) -> DataFrame:
    """PossiblyCalls: candidates of ambiguous sites, and namesakes of unresolved ones, where there are at most cap.

    Namesakes are counted before they are joined, so a frequent name never
    multiplies its sites. One edge per (caller, callee), the first record wins.
    """
    asked, same = _asked(records, candidates, members), materialize(_namesakes(members), "namesakes")
    several = _ambiguous(asked).where(F.col("n_ids").between(1, cap))
    several = several.select("path", _rank().alias("rank"), "ord", "caller_id", "name", F.lit("ambiguous").alias("reason"), F.col("n_ids").cast("long").alias("candidate_count"), F.posexplode(F.transform("ids", lambda x: x.callee_id)).alias("pos", "callee_id"))
    lost = _unresolved(asked, same).where(F.col("others").between(1, cap) & (F.col("key") != ""))
    few = same.groupBy("repo", "key").agg(F.count("*").alias("n"), F.collect_list("callee_id").alias("all")).where(F.col("n") <= cap + 1).select("repo", "key", "all")
    lost = lost.join(few, ["repo", "key"]).select("path", _rank().alias("rank"), "ord", "caller_id", "name", F.lit("name-heuristic").alias("reason"), F.col("others").cast("long").alias("candidate_count"), F.lit(0).alias("pos"), F.explode("all").alias("callee_id"))
    edges = several.unionByName(lost).where("caller_id <> callee_id")
    edges = edges.select(F.col("caller_id").alias("caller_method"), F.col("callee_id").alias("callee_method"), F.col("name").alias("callee_name"), "reason", "candidate_count", "path", "rank", "ord", "pos")
    best = first_wins(edges, ["caller_method", "callee_method"], [F.col(c) for c in ("path", "rank", "ord", "pos")])
    return best.select(N.make_id("pcalls", F.col("caller_method"), F.col("callee_method")).alias("edge_id"), "caller_method", "callee_method", "callee_name", "reason", "candidate_count")


def resolution_stats(records: DataFrame, candidates: DataFrame, classes: DataFrame, members: DataFrame, files: DataFrame, cap: int = 5) -> DataFrame:
    """Rows (counter, n): the outcome of every call, property and heritage record, per record and not per edge."""
    calls = records.where("section IN ('calls', 'props')")
    # a target is asked once, however many records have it
    asks = calls.where("status = 'resolved'").groupBy("repo", "target_path", "target_owner", "target_member").agg(F.count("*").alias("times"))
    known = files.select("repo", F.col("path").alias("target_path"), F.lit(True).alias("_file")).distinct()
    hit = _find_method(asks.join(known, ["repo", "target_path"], "left"), members, "target_path", "target_owner", "target_member", "callee_id")
    outcome = F.when(F.col("_file").isNull(), "calls_resolved_uninternal").when(F.col("callee_id").isNull(), "calls_resolved_no_member").otherwise("calls_resolved")
    once = F.lit(1).cast("long").alias("times")
    parts = [hit.select(outcome.alias("counter"), "times")]
    parts.append(calls.where("status IN ('external', 'dynamic')").select(F.concat(F.lit("calls_"), "status").alias("counter"), once))
    n, asked = F.col("n_ids"), _asked(records, candidates, members)
    parts.append(_ambiguous(asked).select(F.when(n == 0, "calls_ambiguous_no_internal").when(n > cap, "calls_ambiguous_capped").otherwise("calls_ambiguous").alias("counter"), once))
    others = F.col("others")
    parts.append(_unresolved(asked, materialize(_namesakes(members), "namesakes")).select(F.concat(F.lit("calls_unresolved_"), F.when(F.col("key") == "", "unnamed").when(others <= 0, "no_candidates").when(others > cap, "fanout_capped").otherwise("heuristic")).alias("counter"), once))
    heritage = _heritage(records, classes).select(F.concat(F.lit("inherits_"), F.when(F.col("status") == "external", "external").when(F.col("status") != "resolved", "unresolved").when(F.coalesce(F.col("child_id") != F.col("parent_id"), F.lit(False)), F.lit(None)).otherwise("unmapped")).alias("counter"), once)
    parts.append(heritage.where("counter IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts).groupBy("counter").agg(F.sum("times").alias("n"))


# heritage, imports, dependencies


def _heritage(records: DataFrame, classes: DataFrame) -> DataFrame:
    rows = records.where("section = 'inherits'").withColumn("_owner", owner())
    child, parent = class_index(classes, "child"), class_index(classes, "parent")
    rows = rows.join(child, (rows.repo == child.repo) & (rows.path == child.child_path) & (N.norm(rows["_owner"]) == child.child_key), "left").select(rows["*"], "child_id")
    return rows.join(parent, (rows.repo == parent.repo) & (rows.target_path == parent.parent_path) & (N.norm(rows.target_owner) == parent.parent_key), "left").select(rows["*"], "child_id", "parent_id")


def class_inherits(records: DataFrame, classes: DataFrame) -> DataFrame:
    """ClassInherits: resolved heritage whose two classes are known and differ; one row per record."""
    rows = _heritage(records, classes).where("status = 'resolved' AND child_id <> parent_id")
    return rows.select(N.make_id("inherits", F.col("child_id"), F.col("parent_id")).alias("edge_id"), F.col("child_id").alias("child_class"), F.col("parent_id").alias("parent_class"), F.coalesce("relation", F.lit("extends")).alias("kind"), F.coalesce("via", F.lit("")).alias("resolution"))


def file_imports(records: DataFrame, files: DataFrame) -> DataFrame:
    """FileImports: one edge per pair of files, with the name of the first import."""
    rows = _scanned(records.where("section = 'imports' AND status = 'resolved' AND target_path <> path"), files, "target_path")
    best = first_wins(rows.select("repo", "path", "target_path", "ord", "name"), ["repo", "path", "target_path"], [F.col("ord"), F.col("name")])
    return _file_edge(best, "imp", "target").select("edge_id", "source_file", "target", F.col("name").alias("import"), F.lit("resolved").alias("resolution"))


def _file_edge(rows: DataFrame, kind: str, target: str) -> DataFrame:
    ends = rows.withColumn("source_file", file_id()).withColumn(target, N.make_id("file", F.col("repo"), F.col("target_path")))
    return ends.withColumn("edge_id", N.make_id(kind, F.col("source_file"), F.col(target)))


def file_depends_on(records: DataFrame, classes: DataFrame, files: DataFrame) -> DataFrame:
    """FileDependsOn: every pair of files that a string, callable, call, class reference, heritage or import ties."""
    calls = records.where("section IN ('calls', 'props')")
    ties = [calls.select("repo", "path", F.col("string_path").alias("target_path")), calls.select("repo", "path", F.col("callable_path").alias("target_path"))]
    ties.append(records.where("section IN ('calls', 'props', 'class_refs', 'imports') AND status = 'resolved'").select("repo", "path", "target_path"))
    ties.append(_heritage(records, classes).where("status = 'resolved' AND child_id <> parent_id").select("repo", "path", "target_path"))
    pairs = reduce(DataFrame.unionByName, ties).where("target_path <> path").distinct()
    return _file_edge(_scanned(pairs, files, "target_path"), "dep", "target_file").select("edge_id", "source_file", "target_file", F.lit("resolved").alias("resolution"))


# structure


def file_defines_class(classes: DataFrame) -> DataFrame:
    rows = classes.where("name <> ''").select(file_id().alias("file_id"), N.make_id("class", F.col("repo"), F.col("path"), owner("fqcn", "name")).alias("class_id")).distinct()
    return rows.select(N.make_id("fdc", F.col("file_id"), F.col("class_id")).alias("edge_id"), "file_id", "class_id")


def class_defines_method(members: DataFrame) -> DataFrame:
    rows = members.where("name <> '' AND class_name <> ''").select(N.make_id("class", F.col("repo"), F.col("path"), owner()).alias("class_id"), N.make_id("method", F.col("repo"), F.col("path"), owner(), F.col("name")).alias("method_id")).distinct()
    return rows.select(N.make_id("cdm", F.col("class_id"), F.col("method_id")).alias("edge_id"), "class_id", "method_id")


def file_belongs_to_module(topics: DataFrame, files: DataFrame) -> DataFrame:
    """A linked file belongs to a topic when its base name without extension is unique in the scan."""
    stem = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"^(.+)\.[^.]*$", "$1")
    once = files.groupBy("repo", stem("path").alias("stem")).agg(F.count("*").alias("n"), F.min("path").alias("path")).where("n = 1")
    linked = topics.where("name <> ''").select("repo", "name", F.regexp_replace("linked_file", r"^(.+)\.[^.]*$", "$1").alias("stem"))
    rows = linked.join(once, ["repo", "stem"]).select(file_id().alias("file_id"), N.make_id("module", F.col("repo"), F.col("name")).alias("module_id")).distinct()
    return rows.select(N.make_id("fbm", F.col("file_id"), F.col("module_id")).alias("edge_id"), "file_id", "module_id")


def dir_contains_file(files: DataFrame) -> DataFrame:
    """Every file under its direct parent directory."""
    parent = F.coalesce(F.nullif(F.regexp_replace("path", "/?[^/]*$", ""), F.lit("")), F.lit("."))
    rows = files.select(N.make_id("dir", F.col("repo"), parent).alias("dir_id"), file_id().alias("file_id"))
    return rows.select(N.make_id("dcf", F.col("dir_id"), F.col("file_id")).alias("edge_id"), "dir_id", "file_id")


def table_references(foreign_keys: DataFrame, tables: DataFrame) -> DataFrame:
    """Foreign keys whose two tables exist."""
    known = tables.select("repo", F.col("name").alias("table_name")).distinct()
    rows = foreign_keys.join(known, ["repo", "table_name"], "left_semi").join(known.withColumnRenamed("table_name", "referenced_table"), ["repo", "referenced_table"], "left_semi")
    rows = rows.select(table_id().alias("source_table"), table_id("referenced_table").alias("target_table"), F.col("column").alias("fk_column"), "referenced_column")
    return rows.select(N.make_id("tref", F.col("source_table"), F.col("target_table"), F.col("fk_column")).alias("edge_id"), "source_table", "target_table", "fk_column", "referenced_column")


def class_maps_to_table(classes: DataFrame, literals: DataFrame, tables: DataFrame) -> DataFrame:
    """Table classes by the first literal of a setTable call (literals: repo, path, class_name, ord, arg), else by convention."""
    models = classes.where(F.col("fqcn").contains("\\Model\\Table\\") & F.col("fqcn").endswith("Table"))
    told = literals.groupBy("repo", "path", F.col("class_name").alias("name")).agg(F.min_by("arg", "ord").alias("arg"))
    rows = models.join(told, ["repo", "path", "name"], "left")
    rows = rows.withColumn("table_name", F.coalesce("arg", N.tableize(F.col("name")))).withColumn("via", F.when(F.col("arg").isNull(), "convention").otherwise("settable"))
    known = tables.select("repo", F.col("name").alias("table_name")).distinct()
    rows = rows.join(known, ["repo", "table_name"], "left_semi").select(N.make_id("class", F.col("repo"), F.col("path"), F.col("fqcn")).alias("class_id"), table_id().alias("table_id"), "via")
    return rows.select(N.make_id("c2t", F.col("class_id"), F.col("table_id")).alias("edge_id"), "class_id", "table_id", "via")


def di_edges(bindings: DataFrame, classes: DataFrame) -> DataFrame:
    """DiBinds and DiInjects within a repository.

    bindings are rows (repo, path, ord, kind, target, side, pos, candidate): the
    candidate names of both ends of a binding in order; the first that a class
    of the repository bears is taken. Ends without one make no edge.
    """
    index = classes.where("fqcn <> ''").select("repo", N.norm(F.col("fqcn")).alias("key"), N.make_id("class", F.col("repo"), F.col("path"), F.col("fqcn")).alias("class_id"), "path", "ord")
    index = last_wins(index, ["repo", "key"], [F.col("path"), F.col("ord")]).select("repo", "key", "class_id")
    hit = bindings.withColumn("key", N.norm(F.col("candidate"))).join(index, ["repo", "key"])
    pick = lambda side: F.min_by(F.when(F.col("side") == side, F.col("class_id")), F.when(F.col("side") == side, F.col("pos")))
    ends = hit.groupBy("repo", "path", "ord", "kind").agg(pick("source").alias("source_class"), pick("target").alias("target_class"), F.min("target").alias("symbol"))
    ends = ends.where("kind IN ('bind', 'inject') AND source_class <> target_class")
    best = first_wins(ends.select("kind", "source_class", "target_class", "repo", "symbol", "path", "ord"), ["kind", "source_class", "target_class"], [F.col("path"), F.col("ord")])
    edge = F.when(F.col("kind") == "bind", N.make_id("bind", F.col("source_class"), F.col("target_class"))).otherwise(N.make_id("inject", F.col("source_class"), F.col("target_class")))
    return best.select(edge.alias("edge_id"), "kind", "source_class", "target_class", F.col("repo").alias("source_repo"), F.col("repo").alias("target_repo"), "symbol")
