"""Queries over references between repositories and over migration logs, bound to the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import names as N
from skein.graph_queries import _PART_NAME, _PART_SPACE, BIND, ORACLE, _id, _name, _spark_texts, _sql
from skein.graph_queries import frame as _frame
from skein.plans import crossref as X
from skein.plans import migrations
from skein.queries import query
from skein.session import materialize

BIND |= {
    "defined": """SELECT repo, path, ord, name, namespace, fqcn FROM classes WHERE fqcn <> '' UNION ALL SELECT 'repo' || CAST(ord % 5 AS STRING), 'src/copy' || CAST(ord % 3 AS STRING) || '.php', ord, name, namespace, LOWER(fqcn) FROM classes WHERE fqcn <> '' AND ord % 10 = 3""",
    "aimed": f"SELECT a.ok, a.pk, a.ln, k.repo, k.path, k.name AS class_name, k.fqcn, k.namespace, {_name('a.pk', 'a.ln')} AS member, CASE WHEN p.fqcn = '' THEN p.namespace || chr(92) || 'None' ELSE p.fqcn END AS pf, p.ord AS pord FROM lines a JOIN classes k ON k.ord = a.pk JOIN classes p ON p.ord = a.ok % (SELECT COUNT(*) FROM {{part}})",
    "uses": "SELECT DISTINCT repo, path, 'A' || CAST(ok % 50 AS STRING) AS alias, pf AS fqcn, ok AS ord FROM aimed WHERE ok % 4 < 3",
    "refs": """SELECT repo, path, namespace, fqcn AS own, CASE ok % 9 WHEN 0 THEN 'extends' WHEN 1 THEN 'implements' WHEN 2 THEN 'uses' WHEN 3 THEN 'new' WHEN 4 THEN 'instanceof' WHEN 5 THEN 'class_literal' WHEN 6 THEN 'callable_string' WHEN 7 THEN 'type' ELSE 'array_callable' END AS kind,
      CASE WHEN ok % 9 = 7 THEN '?int|' || chr(92) || pf || '|string' WHEN ok % 9 = 6 THEN chr(92) || pf WHEN pk % 4 = 0 THEN chr(92) || pf WHEN pk % 4 = 1 THEN 'a' || CAST(ok % 50 AS STRING) WHEN pk % 4 = 2 THEN 'A' || CAST(ok % 50 AS STRING) || chr(92) || 'Sub' WHEN ok % 2 = 0 THEN 'namespace' || chr(92) || 'X' || CAST(pk AS STRING) ELSE 'C' || CAST(pk AS STRING) END AS text FROM aimed""",
    "tokens": "SELECT DISTINCT repo, path, fqcn AS own, 'a' || CAST((ok + pk) % 50 AS STRING) AS token FROM aimed WHERE fqcn <> ''",
    "wires": """SELECT CAST(k.ord AS STRING) AS binding_id, k.repo, CASE WHEN k.ord % 2 = 0 THEN 'bind' ELSE 'inject' END AS kind, a.fqcn AS source, UPPER(b.fqcn) AS target FROM classes k JOIN classes a ON a.ord = (k.ord * 7 + 3) % (SELECT COUNT(*) FROM {part}) JOIN classes b ON b.ord = (k.ord * 3 + 1) % (SELECT COUNT(*) FROM {part}) WHERE k.ord % 3 <> 2""",
    "asked": "SELECT CAST(ord AS STRING) || section AS site_id, repo, path, class_name, fqcn, member, 'app' || chr(92) || 'run' || CAST(ln AS STRING) || '_' || CAST(pk - pk % 4 AS STRING) AS a, 'run' || CAST(ln AS STRING) || '_' || CAST(ok % 2000 - (ok % 2000) % 44 AS STRING) AS b FROM sites",
    "functions": "SELECT repo, path, class_name, fqcn, name FROM members WHERE class_name = '(global)'",
    "typed": f"SELECT s.repo, s.path, s.class_name, s.fqcn, s.member, s.namespace, CASE WHEN s.pk % 2 = 0 THEN chr(92) || s.pf ELSE 'A' || CAST(s.ok % 50 AS STRING) END AS text, {_name('s.pord', 's.ln')} AS wanted FROM aimed s",
}
_B = "chr(92)"
_AIMED_NAME, _AIMED_SPACE = _PART_NAME.replace("pk", "pord"), _PART_SPACE.replace("pk", "pord").replace("p_size", "ps")
#: The same frames for Spark: a line meets both its parts as numbers, then its class; what is distinct in a file is dealt by the file, names are made afterwards. Keys of the given tables are unique.
_SPARK_TEXTS = {
    "met_lines": """SELECT DISTINCT ok, pk, ln, pord, ps FROM (SELECT /*+ REPARTITION(pk) */ l.*, u.p_size AS ps FROM (SELECT l_orderkey AS ok, l_partkey AS pk, l_linenumber AS ln, l_orderkey % (SELECT COUNT(*) FROM {part}) AS pord FROM {lineitem}) l JOIN part_units u ON u.pk = l.pord)""",
    "met_rows": "SELECT a.*, k.repo, k.path, k.name AS class_name, k.fqcn, k.namespace FROM met_lines a JOIN classes k ON k.ord = a.pk",
    "aimed": f"SELECT *, {_name('pk', 'ln')} AS member, {_AIMED_SPACE} || chr(92) || CASE WHEN pord % 11 = 0 THEN 'None' ELSE {_AIMED_NAME} END AS pf FROM met_rows",
    "uses": f"""SELECT repo, path, 'A' || CAST(ok % 50 AS STRING) AS alias, {_AIMED_SPACE} || chr(92) || CASE WHEN pord % 11 = 0 THEN 'None' ELSE {_AIMED_NAME} END AS fqcn, ok AS ord FROM (SELECT DISTINCT * FROM (SELECT /*+ REPARTITION(repo, path) */ repo, path, ok, pord, ps FROM aimed WHERE ok % 4 < 3))""",
    "tokens": "SELECT DISTINCT * FROM (SELECT /*+ REPARTITION(repo, path, token) */ * FROM (SELECT repo, path, fqcn AS own, 'a' || CAST((ok + pk) % 50 AS STRING) AS token FROM aimed WHERE fqcn <> ''))",
}


def _texts() -> dict[str, str]:
    """The texts of Spark's frames, each after what it reads."""
    texts = {}
    for x, text in _spark_texts().items():
        if x == "aimed":
            texts |= {y: _SPARK_TEXTS[y] for y in ("met_lines", "met_rows")}
        texts[x] = _SPARK_TEXTS.get(x, text)
    return texts


def frame(t, name: str) -> DataFrame:
    return _frame(t, name, _texts())


def _once(t):
    """frame for a query that reads lines with their classes several times: they are written once, beside each other by part."""
    rows = materialize(frame(t, "met_rows"), "met_rows")
    return lambda t, name: _frame(t, name, _texts() | {"met_rows": "SELECT * FROM {met_rows}"}, {"met_rows": rows})


ORACLE |= {
    "reg": f"SELECT DISTINCT lower(fqcn) AS norm_fqcn, repo, fqcn, {_id('class', 'repo', 'path', 'fqcn')} AS class_id FROM defined WHERE NOT list_contains(string_split(path, '/'), 'vendor')",
    "alias_ix": "SELECT repo, path, lower(alias) AS alias, max_by(fqcn, (ord, fqcn)) AS fqcn FROM uses GROUP BY 1, 2, 3",
    "hinted": f"""SELECT repo, path, namespace, own, CASE WHEN kind = 'class_literal' THEN 'class_ref' ELSE kind END AS kind, text FROM refs WHERE kind NOT IN ('type', 'array_callable', 'callable_string')
      UNION ALL SELECT repo, path, namespace, own, 'type_hint', split_part(text, '|', 2) FROM refs WHERE kind = 'type'""",
    "strict_refs": f"""SELECT r.repo, r.path, r.own, r.kind, CASE WHEN starts_with(text, {_B}) THEN ltrim(text, {_B}) WHEN starts_with(text, 'namespace' || {_B}) THEN namespace || substring(text, 10) WHEN a.fqcn IS NOT NULL THEN a.fqcn || CASE WHEN contains(text, {_B}) THEN substring(text, strpos(text, {_B})) ELSE '' END ELSE namespace || {_B} || text END AS strict
      FROM hinted r LEFT JOIN alias_ix a ON a.repo = r.repo AND a.path = r.path AND a.alias = lower(split_part(r.text, {_B}, 1)) UNION ALL SELECT repo, path, own, 'class_ref', ltrim(text, {_B}) FROM refs WHERE kind = 'callable_string'""",
    "owners": "SELECT norm_fqcn, count(*) AS entries, min(repo) AS owner FROM reg GROUP BY 1",
    "entry": "SELECT norm_fqcn, repo, min_by(fqcn, class_id) AS symbol, min(class_id) AS class_id, count(*) AS n FROM reg GROUP BY 1, 2",
    "app_refs": "SELECT * FROM strict_refs WHERE NOT list_contains(string_split(path, '/'), 'vendor')",
    "owned_refs": "SELECT r.*, o.owner, e.symbol, e.class_id FROM app_refs r JOIN owners o ON o.norm_fqcn = lower(r.strict) JOIN entry e ON e.norm_fqcn = o.norm_fqcn AND e.repo = o.owner WHERE o.entries = 1 AND o.owner <> r.repo",
    "owned_uses": "SELECT u.repo, u.path, u.token, o.owner, e.symbol, e.class_id FROM (SELECT DISTINCT repo, path, fqcn, lower(alias) AS token FROM uses WHERE NOT list_contains(string_split(path, '/'), 'vendor')) u JOIN owners o ON o.norm_fqcn = lower(u.fqcn) JOIN entry e ON e.norm_fqcn = o.norm_fqcn AND e.repo = o.owner WHERE o.entries = 1 AND o.owner <> u.repo",
    "holders": "SELECT DISTINCT repo, path, fqcn AS own FROM classes WHERE fqcn <> '' AND ord % 3 = 0",
}
BIND["holders"] = ORACLE["holders"]


def _class_id(name: str = "own"):
    return F.when(F.col(name) != "", N.make_id("class", F.col("repo"), F.col("path"), F.col(name)))


def _method_id():
    return N.make_id("method", F.col("repo"), F.col("path"), F.when(F.col("fqcn") != "", F.col("fqcn")).otherwise(F.col("class_name")), F.col("member"))


def _registry(t) -> DataFrame:
    return X.registry(frame(t, "defined"))


def _references(t, frame=frame) -> DataFrame:
    return frame(t, "refs").withColumn("class_id", _class_id())


@query(_sql("SELECT * FROM reg"))
def xr_registry(t):
    return _registry(t)


@query(_sql("SELECT repo, path, own, kind, strict, count(*) AS n FROM strict_refs GROUP BY ALL"))
def xr_class_references(t):
    return X.class_references(_references(t), frame(t, "uses")).groupBy("repo", "path", "own", "kind", "strict").agg(F.count("*").alias("n"))


_XREF = "SELECT DISTINCT {0} AS source_class, class_id AS target_class, kind, repo AS source_repo, owner AS target_repo, symbol FROM ".format(_id("class", "repo", "path", "own"))


@query(_sql(f"SELECT {_id('xref', 'source_class', 'target_class', 'kind')} AS edge_id, * FROM ({_XREF} owned_refs WHERE own <> '')"))
def xr_cross_refs(t):
    once = _once(t)
    return X.cross_refs(_references(t, once), once(t, "uses"), _registry(t))


@query(_sql(f"""SELECT {_id('xref', 'source_class', 'target_class', 'kind')} AS edge_id, * FROM ({_XREF} (SELECT u.*, 'import' AS kind, m.own FROM owned_uses u JOIN tokens m ON m.repo = u.repo AND m.path = u.path AND m.token = u.token
UNION ALL SELECT u.*, 'import', h.own FROM owned_uses u JOIN holders h ON h.repo = u.repo AND h.path = u.path WHERE NOT EXISTS (SELECT 1 FROM tokens m WHERE m.repo = u.repo AND m.path = u.path AND m.token = u.token)))"""))
def xr_import_refs(t):
    once = _once(t)
    mentions = once(t, "tokens").select("repo", "path", _class_id().alias("class_id"), "token")
    holders = frame(t, "holders").select("repo", "path", _class_id().alias("class_id"))
    return X.import_refs(once(t, "uses"), mentions, holders, _registry(t))


@query(_sql(f"""SELECT {_id('xfref', 'source_file', 'target_class', 'kind')} AS edge_id, * FROM (SELECT DISTINCT {_id('file', 'repo', 'path')} AS source_file, class_id AS target_class, repo AS source_repo, owner AS target_repo, symbol, kind FROM (
  SELECT repo, path, owner, symbol, class_id, 'import' AS kind FROM owned_uses UNION ALL SELECT repo, path, owner, symbol, class_id, kind FROM owned_refs) x WHERE NOT EXISTS (SELECT 1 FROM holders h WHERE h.repo = x.repo AND h.path = x.path AND h.repo < 'repo2'))"""))
def xr_file_refs(t):
    holders = frame(t, "holders").where("repo < 'repo2'").select("repo", "path", _class_id().alias("class_id"))
    once = _once(t)
    return X.file_refs(once(t, "uses"), _references(t, once), holders, _registry(t))


_MID = _id("method", "repo", "path", "CASE WHEN fqcn <> '' THEN fqcn ELSE class_name END", "{0}")
ORACLE |= {
    "fn": f"SELECT lower(name) AS name, repo, {_MID.format('name')} AS method_id FROM functions",
    "probed": f"""SELECT a.repo, {_MID.format('member')} AS caller_method, CASE WHEN EXISTS (SELECT 1 FROM fn WHERE fn.name = lower(a.a)) THEN lower(a.a) WHEN EXISTS (SELECT 1 FROM fn WHERE fn.name = lower(a.b)) THEN lower(a.b) END AS name FROM asked a""",
    "fn_owner": "SELECT name, count(*) AS entries, min(repo) AS owner FROM fn GROUP BY 1",
}


@query(_sql(f"""SELECT {_id('xcall', 'caller_method', 'callee_method')} AS edge_id, * FROM (SELECT caller_method, fn.method_id AS callee_method, p.repo AS source_repo, o.owner AS target_repo, min(p.name) AS symbol FROM probed p JOIN fn_owner o ON o.name = p.name JOIN fn ON fn.name = p.name AND fn.repo = o.owner
WHERE o.entries = 1 AND o.owner <> p.repo AND caller_method <> fn.method_id GROUP BY 1, 2, 3, 4)"""))
def xr_function_calls(t):
    functions = frame(t, "functions").withColumnRenamed("name", "member").select(F.col("member").alias("name"), "repo", _method_id().alias("method_id"))
    sites = frame(t, "asked").withColumn("caller_method", _method_id())
    return X.function_calls(sites, [F.col("a"), F.col("b")], functions)


@query(None)  # this DuckDB fails on its SQL; a test compares it with a plain loop
def xr_method_calls(t):
    once = _once(t)
    sites = once(t, "typed").withColumn("caller_method", _method_id()).drop("member").withColumnRenamed("wanted", "member").select("repo", "path", "namespace", "caller_method", "text", "member")
    own = frame(t, "members").where("fqcn <> '' AND member_kind = 'method'").withColumnRenamed("name", "member")
    declared = own.select(F.col("fqcn").alias("name"), "member", F.col("fqcn").alias("owner_class"), _method_id().alias("method_id")).distinct()
    return X.method_calls(sites, once(t, "uses"), declared, _registry(t))


ORACLE["ends"] = """SELECT w.*, s.class_id AS s_own, t.class_id AS t_own, so.n AS s_n, st.n AS t_n, so.repo AS s_any_repo, so.id AS s_any, st.repo AS t_any_repo, st.id AS t_any FROM wires w
  JOIN (SELECT norm_fqcn, count(*) AS n, min_by(repo, (repo, class_id)) AS repo, min_by(class_id, (repo, class_id)) AS id FROM reg GROUP BY 1) so ON so.norm_fqcn = lower(w.source) JOIN (SELECT norm_fqcn, count(*) AS n, min_by(repo, (repo, class_id)) AS repo, min_by(class_id, (repo, class_id)) AS id FROM reg GROUP BY 1) st ON st.norm_fqcn = lower(w.target)
  LEFT JOIN (SELECT * FROM entry WHERE n = 1) s ON s.norm_fqcn = lower(w.source) AND s.repo = w.repo LEFT JOIN (SELECT * FROM entry WHERE n = 1) t ON t.norm_fqcn = lower(w.target) AND t.repo = w.repo"""


@query(_sql(f"""SELECT CASE WHEN kind = 'bind' THEN {_id('xbind', 'source_class', 'target_class')} ELSE {_id('xinject', 'source_class', 'target_class')} END AS edge_id, kind, source_class, target_class, source_repo, target_repo, min(target) AS symbol FROM (
  SELECT kind, repo, target, CASE WHEN s_own IS NOT NULL THEN s_own WHEN s_n = 1 THEN s_any END AS source_class, CASE WHEN t_own IS NOT NULL THEN t_own WHEN t_n = 1 THEN t_any END AS target_class, CASE WHEN s_own IS NOT NULL THEN repo WHEN s_n = 1 THEN s_any_repo END AS source_repo, CASE WHEN t_own IS NOT NULL THEN repo WHEN t_n = 1 THEN t_any_repo END AS target_repo FROM ends)
WHERE source_class <> target_class AND NOT (source_repo = repo AND target_repo = repo) GROUP BY kind, source_class, target_class, source_repo, target_repo"""))
def xr_wiring(t):
    return X.wiring(frame(t, "wires"), _registry(t))


@query(_sql(f"SELECT array_to_string(string_split(strict, {_B})[1:2], {_B}) AS prefix, count(DISTINCT strict) AS n FROM strict_refs WHERE lower(strict) NOT IN (SELECT norm_fqcn FROM reg) GROUP BY 1 ORDER BY n DESC, prefix LIMIT 10"))
def xr_dropped(t):
    return X.dropped(X.class_references(_references(t), frame(t, "uses")), _registry(t))


ORACLE["lost_ends"] = """SELECT lower(e.strict) AS name, CASE WHEN o.entries IS NULL THEN 'di_unowned' WHEN o.entries > 1 AND coalesce(x.n, 0) <> 1 THEN 'di_ambiguous' END AS reason FROM (SELECT repo, source AS strict FROM wires UNION ALL SELECT repo, target FROM wires) e
  LEFT JOIN owners o ON o.norm_fqcn = lower(e.strict) LEFT JOIN entry x ON x.norm_fqcn = lower(e.strict) AND x.repo = e.repo"""
ORACLE["classified"] = "SELECT r.*, CASE WHEN o.entries IS NULL THEN 'unowned_refs' WHEN x.n IS NOT NULL THEN 'local_definition' WHEN o.entries > 1 THEN 'ambiguous' ELSE 'owned' END AS reason FROM strict_refs r LEFT JOIN owners o ON o.norm_fqcn = lower(r.strict) LEFT JOIN entry x ON x.norm_fqcn = lower(r.strict) AND x.repo = r.repo"


@query(_sql("""SELECT reason, '' AS name, count(*) AS n FROM classified WHERE reason IN ('unowned_refs', 'local_definition') GROUP BY 1 UNION ALL SELECT reason, '', count(*) FROM lost_ends WHERE reason IS NOT NULL GROUP BY 1
UNION ALL SELECT 'ambiguous', norm_fqcn, count(DISTINCT repo) FROM reg WHERE norm_fqcn IN (SELECT lower(strict) FROM classified WHERE reason = 'ambiguous' UNION SELECT name FROM lost_ends WHERE reason = 'di_ambiguous') GROUP BY 2"""))
def xr_drop_report(t):
    return X.drop_report(X.class_references(_references(t), frame(t, "uses")), frame(t, "wires"), _registry(t))


# migrations: the events of a user are operations on the tables of a project


def _operations(t) -> DataFrame:
    e = t("events").select("event_id", "user_id", F.hash("event_type", "event_id").alias("h"), F.date_format("ts", "yyyyMMddHH").alias("hour"))
    n = lambda k: F.pmod(F.col("h"), F.lit(k))
    table = F.concat(F.lit("t"), F.pmod(F.col("user_id") * 7 + n(3), F.lit(23)).cast("string"))
    ops = ["create_table", "add_column", "add_column", "add_column", "rename_column", "change_column", "remove_column", "add_index", "add_foreign_key", "rename_table", "drop_table", "add_column"]
    op = F.element_at(F.array(*[F.lit(x) for x in ops]), F.pmod(F.floor(F.col("h") / 7), F.lit(len(ops))).cast("int") + 1)
    column = lambda k: F.concat(F.lit("c"), F.pmod(F.floor(F.col("h") / k), F.lit(6)).cast("string"))
    return e.select(
        F.concat(F.lit("p"), F.floor(F.col("user_id") / 20).cast("string")).alias("repo"),
        F.concat(F.lit("plugins/a/config/Migrations/"), "hour", F.lit("_m.php")).alias("file"),
        F.col("event_id").alias("seq"),
        op.alias("op"),
        table.alias("table_name"),
        F.when(op == "rename_table", F.concat(F.lit("t"), F.pmod(F.col("user_id") * 5 + n(11), F.lit(31)).cast("string"))).otherwise(column(31)).alias("new_name"),
        column(13).alias("column"),
        F.element_at(F.array(F.lit("string"), F.lit("integer"), F.lit("text")), n(3) + 1).alias("type"),
        F.when(op == "create_table", F.when(n(4) == 0, "id=false").when(n(4) == 1, "id=key")).otherwise(F.concat(F.lit("limit="), n(50).cast("string"))).alias("options"),
        F.concat_ws(",", column(13), column(17)).alias("columns"),
        (n(2) == 0).alias("unique"),
        F.when(n(5) == 0, "ix").alias("index_name"),
        F.concat(F.lit("t"), F.pmod(F.col("user_id") * 3 + n(5), F.lit(23)).cast("string")).alias("referenced_table"),
        F.when(n(3) > 0, "id").alias("referenced_column"),
    )


@query(None)  # a fold over each table's operations has no short SQL form: tests compare it with a plain replay
def mig_schema(t):
    return migrations.replay(_operations(t))


@query(None)
def mig_renames(t):
    return migrations.lineages(migrations.ordered(_operations(t)))[1]
