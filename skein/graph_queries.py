"""Queries of the code-graph derivation over frames bound to the star-schema tables.

The binding is SQL that Spark and DuckDB both run: suppliers are files, parts
are classes, lineitems are members and the sites in them. {table} stands for a
given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.plans import checks
from skein.plans import codegraph as G
from skein.queries import query
from skein.session import materialize

_NAME = "CASE WHEN {pk} % 3 = 0 THEN 'run' || CAST({ln} AS STRING) ELSE 'run' || CAST({ln} AS STRING) || '_' || CAST({pk} - {pk} % 4 AS STRING) END"


def _name(pk: str, ln: str) -> str:
    return _NAME.replace("{pk}", pk).replace("{ln}", ln)


BIND = {
    "units": """SELECT s_suppkey AS sk, 'repo' || CAST(n_regionkey AS STRING) AS repo, CASE WHEN s_suppkey % 9 = 4 THEN 'vendor/' ELSE 'src/' END || n_name || '/d' || CAST(s_suppkey % 2 AS STRING) || '/Unit'
      || CAST(CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey - s_suppkey % 10 ELSE s_suppkey END AS STRING) || CASE WHEN s_suppkey % 4 = 1 THEN '.ctp' ELSE '.php' END AS path, s_name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "files": "SELECT repo, path, CASE WHEN path LIKE 'vendor/%' THEN 'vendor' ELSE 'app' END AS origin, MIN(s_name) AS summary FROM units GROUP BY repo, path",
    "parts": "SELECT p_partkey AS pk, p_partkey % (SELECT COUNT(*) FROM {supplier}) AS sk, p_size FROM {part}",
    "named": """SELECT repo, path, pk AS ord, sk, CASE WHEN pk % 11 = 0 THEN '(global)' WHEN pk % 3 = 0 THEN 'C' || CAST(pk AS STRING) || 'Table' ELSE 'C' || CAST(pk AS STRING) END AS name,
      'App' || chr(92) || CASE WHEN pk % 3 = 0 THEN 'Model' || chr(92) || 'Table' ELSE 'Core' || CAST(p_size % 5 AS STRING) END AS namespace,
      CASE WHEN pk % 11 = 0 THEN 'module' WHEN p_size % 7 = 0 THEN 'interface' WHEN p_size % 5 = 0 THEN 'trait' ELSE 'class' END AS kind,
      CASE WHEN p_size % 2 = 0 THEN 'abstract' ELSE '' END AS modifiers, 10 * p_size AS start_line, 10 * p_size + 9 AS end_line FROM parts JOIN units USING (sk)""",
    "classes": "SELECT named.*, CASE WHEN name = '(global)' THEN '' ELSE namespace || chr(92) || name END AS fqcn FROM named",
    "lines": "SELECT DISTINCT l_orderkey AS ok, l_partkey AS pk, l_linenumber AS ln FROM {lineitem}",
    "members": f"""SELECT k.repo, k.path, m.pk * 10 + m.ln AS ord, k.name AS class_name, k.namespace, k.fqcn, {_name("m.pk", "m.ln")} AS name,
      CASE WHEN k.name = '(global)' THEN 'function' WHEN m.ln % 5 = 0 THEN 'property' ELSE 'method' END AS member_kind, CASE WHEN m.ln % 2 = 0 THEN 'static' ELSE '' END AS modifiers,
      CASE m.ln % 3 WHEN 0 THEN '' WHEN 1 THEN 'int' ELSE 'string' END AS return_type, '$a' || CAST(m.ln AS STRING) AS parameters, k.start_line + m.ln AS start_line, k.start_line + m.ln AS end_line
      FROM (SELECT DISTINCT pk, ln FROM lines) m JOIN classes k ON m.pk = k.ord""",
    "chain": """SELECT ok, pk, ln, (ok + pk * 3 + ln) % 10 AS code, LEAD(pk * 10 + ln) OVER (PARTITION BY ok ORDER BY pk, ln) AS later, LAG(pk * 10 + ln) OVER (PARTITION BY ok ORDER BY pk, ln) AS earlier FROM lines""",
    "sites": """SELECT a.ok, a.pk, a.ln, a.code, s.repo, s.path, s.class_name, s.fqcn, s.name AS member, s.start_line AS line, (a.ok * 100000 + a.pk) * 10 + a.ln AS ord, CASE WHEN a.ln % 4 = 0 THEN 'props' ELSE 'calls' END AS section,
      t.path AS tpath, CASE WHEN t.fqcn <> '' THEN t.fqcn ELSE t.class_name END AS towner, t.name AS tmember, c.path AS cpath, CASE WHEN c.fqcn <> '' THEN c.fqcn ELSE c.class_name END AS cowner, c.name AS cmember
      FROM chain a JOIN members s ON s.ord = a.pk * 10 + a.ln LEFT JOIN members t ON t.ord = a.later AND t.repo = s.repo LEFT JOIN members c ON c.ord = a.earlier AND c.repo = s.repo""",
    "records": f"""SELECT repo, path, section, ord, class_name, fqcn, member,
      CASE WHEN code = 7 THEN '' WHEN code = 8 THEN 'run' || CAST(ln AS STRING) || '_' || CAST(pk - pk % 4 AS STRING) WHEN code = 9 THEN {_name("pk", "ln").replace("'run'", "'Run'", 1)} ELSE COALESCE(tmember, 'x') END AS name,
      CASE WHEN code <= 3 THEN 'resolved' WHEN code = 4 THEN 'external' WHEN code = 5 THEN 'ambiguous' WHEN code = 6 THEN 'dynamic' ELSE 'unresolved' END AS status,
      CASE WHEN code <= 1 THEN 'lsp' WHEN code <= 3 THEN 'parser' ELSE 'none' END AS via, '' AS relation, line,
      CASE WHEN code = 2 AND ok % 5 = 0 THEN 'gone.php' WHEN code <= 3 THEN tpath END AS target_path, towner AS target_owner, CASE WHEN code = 3 THEN 'none' ELSE tmember END AS target_member,
      CASE WHEN ok % 17 = 0 THEN tpath END AS string_path, CASE WHEN ok % 13 = 0 THEN cpath END AS callable_path, cowner AS callable_owner, cmember AS callable_member FROM sites
    UNION ALL SELECT repo, path, 'class_refs', ord, class_name, fqcn, member, '', 'resolved', '', '', line, cpath, cowner, CASE WHEN ln % 2 = 0 THEN cmember ELSE '' END, NULL, NULL, NULL, NULL FROM sites WHERE ok % 7 = 0
    UNION ALL SELECT k.repo, k.path, 'inherits', k.ord, k.name, k.fqcn, '', '', CASE WHEN k.ord % 6 = 0 THEN 'external' WHEN k.ord % 6 = 1 THEN 'unresolved' ELSE 'resolved' END, 'parser',
      CASE k.ord % 3 WHEN 0 THEN 'extends' WHEN 1 THEN 'implements' ELSE 'uses' END, 0, p.path, CASE WHEN p.fqcn <> '' THEN p.fqcn ELSE p.name END, '', NULL, NULL, NULL, NULL FROM classes k JOIN classes p ON p.ord = k.sk WHERE k.name <> '(global)'
    UNION ALL SELECT DISTINCT a.repo, a.path, 'imports', CAST(l_orderkey * 10 + l_linenumber AS BIGINT), '', '', '', 'Dep' || CAST(l_orderkey AS STRING), CASE WHEN l_linenumber % 2 = 0 THEN 'resolved' ELSE 'external' END, 'parser', '', 0, b.path, '', '', NULL, NULL, NULL, NULL
      FROM {{lineitem}} JOIN classes a ON a.ord = l_partkey JOIN units b ON b.sk = l_suppkey AND b.repo = a.repo""",
    "candidates": """SELECT s.repo, s.path, s.section, s.ord, b.pk * 10 + b.ln AS pos, t.path AS target_path, CASE WHEN t.fqcn <> '' THEN t.fqcn ELSE t.class_name END AS target_owner, CASE WHEN b.ln = 5 THEN 'none' ELSE t.name END AS target_member
      FROM sites s JOIN lines b ON b.ok = s.ok AND b.pk * 10 + b.ln <> s.pk * 10 + s.ln JOIN members t ON t.ord = b.pk * 10 + b.ln AND t.repo = s.repo WHERE s.code = 5""",
    "topics": "SELECT repo, CASE WHEN sk % 7 = 6 THEN '' ELSE 'Topic ' || CAST(sk % 7 AS STRING) END AS name, s_name AS summary, 'Unit' || CAST(sk AS STRING) || '.md' AS linked_file FROM units",
    "tables": """SELECT repo, 'c' || CAST(pk AS STRING) AS name, CASE WHEN pk % 12 = 0 THEN 'plugins/P' || CAST(pk % 5 AS STRING) || '/config/Migrations/m.php' ELSE 'config/Migrations/m.php' END AS source_file FROM parts JOIN units USING (sk) WHERE pk % 6 = 0""",
    "columns": "SELECT DISTINCT t.repo, t.name AS table_name, l.ln AS ord, 'f' || CAST(l.ln AS STRING) AS name, CASE WHEN l.ln = 1 THEN 'integer' ELSE 'string' END AS type FROM tables t JOIN lines l ON t.name = 'c' || CAST(l.pk AS STRING)",
    "indexes": "SELECT repo, table_name, ord, name || ',f1' AS columns, ord = 2 AS \"unique\", 'ix_' || name AS name FROM columns WHERE ord > 4",
    "keys": """SELECT repo, name AS table_name, 1 AS ord, 'f1' AS column_name, CASE WHEN LENGTH(name) % 2 = 0 THEN 'x' ELSE name END AS referenced_table, 'id' AS referenced_column FROM tables
    UNION ALL SELECT a.repo, a.name, 2, 'f2', b.name, 'f1' FROM tables a JOIN parts p ON a.name = 'c' || CAST(p.pk AS STRING) JOIN tables b ON b.name = 'c' || CAST(p.pk - 6 * p.p_size AS STRING) AND b.repo = a.repo""",
    "literals": "SELECT k.repo, k.path, k.name AS class_name, l.ln AS ord, CASE WHEN l.ln % 2 = 0 THEN 'c' || CAST(k.ord - k.ord % 6 AS STRING) ELSE 'none' END AS arg FROM classes k JOIN (SELECT DISTINCT pk, ln FROM lines WHERE ln >= 2 AND pk % 15 = 0) l ON l.pk = k.ord",
    "bindings": """SELECT k.repo, k.path, k.ord, CASE k.ord % 3 WHEN 0 THEN 'other' WHEN 1 THEN 'bind' ELSE 'inject' END AS kind, p.name AS target, e.side, e.pos, CASE WHEN e.pos = 0 AND k.ord % 5 <> 0 THEN 'App' || chr(92) || 'Nope' WHEN e.side = 'source' THEN UPPER(k.fqcn) ELSE p.fqcn END AS candidate
      FROM classes k JOIN classes p ON p.ord = k.sk CROSS JOIN (SELECT 'source' AS side, 0 AS pos UNION ALL SELECT 'source', 1 UNION ALL SELECT 'target', 0 UNION ALL SELECT 'target', 1) e""",
}
_GIVEN = ["supplier", "nation", "part", "lineitem"]


def _of(at: str, text: str) -> str:
    """An expression over the columns of part_units, for the struct of that name."""
    for column in ("n_regionkey", "n_name", "p_size", "s_suppkey"):
        text = text.replace(column, f"{at}.{column}")
    return re.sub(r"\bpk\b", f"{at}.pk", text)


_UNIT_REPO, _UNIT_PATH = re.search(r"AS sk, (.*) AS repo, (.*) AS path", BIND["units"], re.S).groups()
_PART_NAME, _PART_SPACE = re.search(r"sk, (CASE .*) AS name,\s+(.*) AS namespace", BIND["named"], re.S).groups()
_PART_OWNER = f"CASE WHEN pk % 11 = 0 THEN '(global)' ELSE {_PART_SPACE} || chr(92) || ({_PART_NAME}) END"
_LATER, _EARLIER = (f"CASE WHEN {x}.n_regionkey = me.n_regionkey THEN {{}} END" for x in ("later", "earlier"))
#: The same frames for Spark: numbers of a line's part and of its neighbours in the order are shuffled, names are made from them afterwards. Keys of the given tables are unique.
_NARROW = {
    "part_units": "SELECT pk, p_size, s_suppkey, n_name, n_regionkey FROM parts JOIN {supplier} ON s_suppkey = sk JOIN {nation} ON s_nationkey = n_nationkey",
    "line_units": """SELECT DISTINCT ok, pk, ln, me FROM (SELECT /*+ REPARTITION(ok) */ l_orderkey AS ok, l_partkey AS pk, l_linenumber AS ln, named_struct('pk', u.pk, 'ln', l_linenumber, 'p_size', p_size, 's_suppkey', s_suppkey, 'n_name', n_name, 'n_regionkey', n_regionkey) AS me
      FROM {lineitem} LEFT JOIN part_units u ON u.pk = l_partkey) AS x""",
    "order_lines": "SELECT ok, ARRAY_SORT(COLLECT_LIST(STRUCT(pk, ln, me))) AS ordered FROM line_units GROUP BY ok",
    "near_lines": """SELECT ok, x.pk, x.ln, x.me, (ok + x.pk * 3 + x.ln) % 10 AS code, TRY_ELEMENT_AT(ordered, at + 2).me AS later, CASE WHEN at > 0 THEN TRY_ELEMENT_AT(ordered, at).me END AS earlier,
      CASE WHEN (ok + x.pk * 3 + x.ln) % 10 = 5 THEN FILTER(TRANSFORM(ordered, y -> y.me), b -> b.n_regionkey = x.me.n_regionkey AND b.pk * 10 + b.ln <> x.pk * 10 + x.ln) END AS mates FROM (SELECT ok, ordered, POSEXPLODE(ordered) AS (at, x) FROM order_lines) AS o""",
    "line_pairs": "SELECT DISTINCT l_partkey AS pk, l_linenumber AS ln FROM {lineitem}",
    "members": BIND["members"].replace("(SELECT DISTINCT pk, ln FROM lines)", "line_pairs"),
    "sites": f"""SELECT ok, pk, ln, code, {_of("me", _UNIT_REPO)} AS repo, {_of("me", _UNIT_PATH)} AS path, {_of("me", _PART_NAME)} AS class_name, CASE WHEN pk % 11 = 0 THEN '' ELSE {_of("me", _PART_OWNER)} END AS fqcn, {_name("pk", "ln")} AS member, 10 * me.p_size + ln AS line,
      (ok * 100000 + pk) * 10 + ln AS ord, CASE WHEN ln % 4 = 0 THEN 'props' ELSE 'calls' END AS section, {", ".join(f"{case.format(text)} AS {n}{x}" for n, at, case in (("t", "later", _LATER), ("c", "earlier", _EARLIER)) for x, text in (("path", _of(at, _UNIT_PATH)), ("owner", _of(at, _PART_OWNER)), ("member", _name(f"{at}.pk", f"{at}.ln"))))}
      FROM near_lines WHERE me.pk IS NOT NULL""",
    "candidates": f"""SELECT {_of("me", _UNIT_REPO)} AS repo, {_of("me", _UNIT_PATH)} AS path, CASE WHEN ln % 4 = 0 THEN 'props' ELSE 'calls' END AS section, (ok * 100000 + pk) * 10 + ln AS ord, b.pk * 10 + b.ln AS pos, {_of("b", _UNIT_PATH)} AS target_path, {_of("b", _PART_OWNER)} AS target_owner,
      CASE WHEN b.ln = 5 THEN 'none' ELSE {_name("b.pk", "b.ln")} END AS target_member FROM (SELECT ok, pk, ln, me, EXPLODE(mates) AS b FROM near_lines WHERE code = 5 AND me.pk IS NOT NULL) AS x""",
}


def _spark_texts() -> dict[str, str]:
    """The texts of the bound frames with those that _NARROW has in their place, each after what it reads."""
    return {x: BIND[x] for x in ("units", "parts")} | {x: _NARROW[x] for x in ("part_units", "line_units", "order_lines", "near_lines", "line_pairs")} | {x: _NARROW.get(x, text) for x, text in BIND.items()}


#: Hex ids in DuckDB, and lookups that the oracles share.
_ID = "'{k}_' || substring(sha256(concat_ws('|', '{k}', {parts})), 1, 16)"


def _id(kind: str, *parts: str) -> str:
    return _ID.format(k=kind, parts=", ".join(parts))


ORACLE = {
    "methods_ix": f"""SELECT * FROM (SELECT repo, path, lower(key) AS key, lower(name) AS member, {_id("method", "repo", "path", "CASE WHEN fqcn <> '' THEN fqcn ELSE class_name END", "name")} AS id, rank, ord FROM
      (SELECT *, CASE WHEN fqcn <> '' THEN fqcn ELSE class_name END AS key, 0 AS rank FROM members UNION ALL SELECT *, class_name, 1 FROM members)) QUALIFY row_number() OVER (PARTITION BY repo, path, key, member ORDER BY rank, ord, id) = 1""",
    "classes_ix": f"""SELECT * FROM (SELECT repo, path, lower(key) AS key, {_id("class", "repo", "path", "CASE WHEN fqcn <> '' THEN fqcn ELSE name END")} AS id, rank, ord FROM
      (SELECT *, CASE WHEN fqcn <> '' THEN fqcn ELSE name END AS key, 0 AS rank FROM classes UNION ALL SELECT *, name, 1 FROM classes)) QUALIFY row_number() OVER (PARTITION BY repo, path, key ORDER BY rank, ord, id) = 1""",
    "called": """SELECT r.*, m.id AS caller_id, CASE section WHEN 'calls' THEN 0 WHEN 'props' THEN 1 ELSE 2 END AS rk FROM records r
      LEFT JOIN methods_ix m ON m.repo = r.repo AND m.path = r.path AND m.key = lower(CASE WHEN r.fqcn <> '' THEN r.fqcn ELSE r.class_name END) AND m.member = lower(r.member) WHERE section IN ('calls', 'props', 'class_refs')""",
    "ids": "SELECT c.repo, c.path, c.section, c.ord, c.pos, m.id FROM candidates c JOIN methods_ix m ON m.repo = c.repo AND m.path = c.target_path AND m.key = lower(c.target_owner) AND m.member = lower(c.target_member)",
    "counted": "SELECT *, count(*) OVER (PARTITION BY repo, path, section, ord) AS n FROM ids",
    "same": f"""SELECT *, count(*) OVER (PARTITION BY repo, key) AS n FROM (SELECT DISTINCT repo, lower(name) AS key, {_id("method", "repo", "path", "CASE WHEN fqcn <> '' THEN fqcn ELSE class_name END", "name")} AS id FROM members WHERE member_kind <> 'property')""",
    "lost": """SELECT c.*, coalesce(s.n, 0) - CASE WHEN o.id IS NULL THEN 0 ELSE 1 END AS others FROM called c LEFT JOIN (SELECT DISTINCT repo, key, n FROM same) s ON s.repo = c.repo AND s.key = lower(c.name) LEFT JOIN same o ON o.repo = c.repo AND o.key = lower(c.name) AND o.id = c.caller_id
      WHERE c.section <> 'class_refs' AND c.status = 'unresolved'""",
    "heritage": """SELECT r.*, k.id AS child_id, p.id AS parent_id FROM records r LEFT JOIN classes_ix k ON k.repo = r.repo AND k.path = r.path AND k.key = lower(CASE WHEN r.fqcn <> '' THEN r.fqcn ELSE r.class_name END)
      LEFT JOIN classes_ix p ON p.repo = r.repo AND p.path = r.target_path AND p.key = lower(r.target_owner) WHERE section = 'inherits'""",
}


def _needed(names: list[str], texts: dict[str, str]) -> list[str]:
    """The named CTEs and those that they read, in an order in which each follows what it reads."""
    want, grew = set(names), True
    while grew:
        more = {y for x in want for y in texts if y not in want and f" {y}" in texts[x].replace("\n", " ")}
        want, grew = want | more, bool(more)
    return [x for x in texts if x in want]


def _sql(body: str) -> str:
    """DuckDB SQL: the body after the CTEs that it needs."""
    texts = {k: v.replace("{", "").replace("}", "") for k, v in BIND.items()} | ORACLE
    names = _needed([x for x in texts if f" {x}" in f" {body}"], texts)
    return "WITH " + ",\n".join(f"{x} AS ({texts[x]})" for x in names) + "\n" + body


def frame(t, name: str, texts: dict[str, str] | None = None, more: dict[str, DataFrame] | None = None) -> DataFrame:
    """One of the bound frames, in Spark; texts may name frames of more as tables."""
    texts = texts or _spark_texts()
    names = _needed([name], texts)
    given = {x: t(x) for x in _GIVEN} | (more or {})
    text = "WITH " + ",\n".join(f"{x} AS ({texts[x]})" for x in names) + f"\nSELECT * FROM {name}"
    spark = given["part"].sparkSession
    for x in given:  # sizes of the given tables, as numbers
        size = "(SELECT COUNT(*) FROM {" + x + "})"
        text = text.replace(size, str(given[x].count())) if size in text else text
    return spark.sql(text.replace('"unique"', "`unique`"), **{x: df for x, df in given.items() if "{" + x + "}" in text})


class _Once:
    """frame for a query that reads lines or members several times: the lines of each order, and members, are written when first read."""

    def __init__(self, t):
        self._t, self._have = t, {}

    def _written(self, name: str) -> DataFrame:
        if name not in self._have:
            self._have[name] = materialize(frame(self._t, name), name)
        return self._have[name]

    def __call__(self, name: str) -> DataFrame:
        if name == "members":
            return self._written(name)
        texts = _spark_texts() | {"order_lines": "SELECT * FROM {order_lines}"}
        given = {x: self._written(x) for x in _needed([name], texts) if x == "order_lines"}
        return frame(self._t, name, texts, given)


def _keys(t) -> DataFrame:
    return frame(t, "keys").withColumnRenamed("column_name", "column")


# nodes

_FULL = "CASE WHEN class_name = '(global)' THEN CASE WHEN namespace <> '' THEN namespace || chr(92) || name ELSE name END WHEN fqcn <> '' THEN fqcn || '::' || name ELSE class_name || '::' || name END"
_OWNER = "CASE WHEN fqcn <> '' THEN fqcn ELSE class_name END"
_VENDOR = "CASE WHEN list_contains(string_split(path, '/'), 'vendor') THEN 'vendor' ELSE 'app' END"


@query(_sql(f"""SELECT {_id("file", "repo", "path")} AS file_id, string_split(path, '/')[-1] AS file_name, regexp_extract(string_split(path, '/')[-1], '^.+(\\.[^.]*)$', 1) AS extension, regexp_replace(path, '/?[^/]*$', '') AS directory, path, origin, summary, repo FROM files"""))
def nod_files(t):
    return G.file_nodes(frame(t, "files"))


@query(_sql(f"""SELECT {_id("class", "repo", "path", "CASE WHEN fqcn <> '' THEN fqcn ELSE name END")} AS class_id, name, namespace, fqcn, {_id("file", "repo", "path")} AS file_id, kind, modifiers, start_line, end_line, {_VENDOR} AS origin, CASE WHEN fqcn <> '' THEN fqcn ELSE name END || ': ' || kind AS summary, repo
FROM classes QUALIFY row_number() OVER (PARTITION BY repo, path, CASE WHEN fqcn <> '' THEN fqcn ELSE name END ORDER BY ord DESC) = 1"""))
def nod_classes(t):
    return G.class_nodes(frame(t, "classes"))


@query(_sql(f"""SELECT {_id("method", "repo", "path", _OWNER, "name")} AS method_id, name, {_id("class", "repo", "path", _OWNER)} AS class_id, {_id("file", "repo", "path")} AS file_id, {_FULL} AS fqmn, return_type || ' ' || class_name || '.' || name || '(' || parameters || ')' AS signature,
modifiers, return_type, start_line, end_line, {_VENDOR} AS origin, {_FULL} AS summary, repo, member_kind FROM members QUALIFY row_number() OVER (PARTITION BY repo, path, {_OWNER}, name ORDER BY ord DESC) = 1"""))
def nod_methods(t):
    return G.method_nodes(frame(t, "members"))


@query(_sql(f"""SELECT {_id("module", "repo", "name")} AS module_id, name, repo, max(summary) AS summary FROM topics WHERE name <> '' GROUP BY name, repo"""))
def nod_modules(t):
    return G.module_nodes(frame(t, "topics"))


@query(_sql(f"""SELECT {_id("dir", "repo", "dir")} AS dir_id, string_split(dir, '/')[-1] AS name, repo, dir, parent, depth FROM (SELECT DISTINCT repo, CASE WHEN depth = 0 THEN '.' ELSE array_to_string(p[1:depth], '/') END AS dir, CASE WHEN depth = 0 THEN NULL WHEN depth = 1 THEN '.' ELSE array_to_string(p[1:depth-1], '/') END AS parent, CAST(depth AS INTEGER) AS depth
FROM (SELECT repo, string_split(path, '/') AS p, unnest(range(0, len(string_split(path, '/')))) AS depth FROM files))"""))
def nod_directories(t):
    return G.directory_nodes(frame(t, "files"))


@query(_sql(f"""SELECT {_id("dbtable", "t.repo", "t.name")} AS table_id, t.name, coalesce(c.j, '[]') AS columns, coalesce(i.j, '[]') AS indexes, coalesce(k.j, '[]') AS foreign_keys, source_file, CASE WHEN list_contains(string_split(source_file, '/'), 'plugins') THEN string_split(source_file, '/')[list_position(string_split(source_file, '/'), 'plugins') + 1] ELSE '' END AS plugin, t.name || ': ' || coalesce(c.n, 0) || ' columns' AS summary, t.repo
FROM tables t LEFT JOIN (SELECT repo, table_name, count(*) AS n, CAST(to_json(list({{'name': name, 'type': type}} ORDER BY ord)) AS VARCHAR) AS j FROM columns GROUP BY 1, 2) c ON c.repo = t.repo AND c.table_name = t.name
LEFT JOIN (SELECT repo, table_name, CAST(to_json(list({{'columns': string_split(columns, ','), 'unique': "unique", 'name': name}} ORDER BY ord)) AS VARCHAR) AS j FROM indexes GROUP BY 1, 2) i ON i.repo = t.repo AND i.table_name = t.name
LEFT JOIN (SELECT repo, table_name, CAST(to_json(list({{'column': column_name, 'referenced_table': referenced_table, 'referenced_column': referenced_column}} ORDER BY ord)) AS VARCHAR) AS j FROM keys GROUP BY 1, 2) k ON k.repo = t.repo AND k.table_name = t.name"""))
def nod_tables(t):
    indexes = frame(t, "indexes").withColumn("columns", F.split("columns", ","))
    return G.table_nodes(frame(t, "tables"), frame(t, "columns"), indexes, _keys(t))


@query(_sql("SELECT DISTINCT repo, '/srv/code' AS target_dir, CAST(3 AS INTEGER) AS id_scheme, '' AS id_prefix FROM files"))
def nod_graph_meta(t):
    return G.graph_meta(frame(t, "files"), "/srv/code", 3, "")


# edges


_CALL_EDGES = f"""SELECT {_id("calls", "caller_id", "id")} AS edge_id, caller_id AS caller_method, id AS callee_method, callee_name, resolution, line AS call_line FROM (
  SELECT c.path, c.rk, c.ord, 0 AS sub, c.caller_id, m.id, c.callable_member AS callee_name, 'convention:callable_literal' AS resolution, c.line FROM called c JOIN files f ON f.repo = c.repo AND f.path = c.callable_path JOIN methods_ix m ON m.repo = c.repo AND m.path = c.callable_path AND m.key = lower(c.callable_owner) AND m.member = lower(c.callable_member) WHERE c.section <> 'class_refs'
  UNION ALL SELECT c.path, c.rk, c.ord, 1, c.caller_id, m.id, CASE WHEN c.name <> '' THEN c.name ELSE c.target_member END, CASE WHEN c.section = 'class_refs' AND c.via = '' THEN 'convention:array_callable' ELSE c.via END, c.line FROM called c JOIN files f ON f.repo = c.repo AND f.path = c.target_path JOIN methods_ix m ON m.repo = c.repo AND m.path = c.target_path AND m.key = lower(c.target_owner) AND m.member = lower(c.target_member) WHERE c.status = 'resolved' AND c.target_member <> '') e
WHERE caller_id <> id QUALIFY row_number() OVER (PARTITION BY caller_id, id ORDER BY path, rk, ord, sub) = 1"""


@query(_sql(_CALL_EDGES))
def edg_method_calls(t):
    return G.method_calls(frame(t, "records"), frame(t, "members"), frame(t, "files"))


@query(_sql(f"""SELECT {_id("pcalls", "caller_id", "id")} AS edge_id, caller_id AS caller_method, id AS callee_method, name AS callee_name, reason, candidate_count FROM (
  SELECT c.path, c.rk, c.ord, i.pos, c.caller_id, i.id, c.name, 'ambiguous' AS reason, i.n AS candidate_count FROM called c JOIN counted i ON i.repo = c.repo AND i.path = c.path AND i.section = c.section AND i.ord = c.ord WHERE c.status = 'ambiguous' AND i.n <= 5
  UNION ALL SELECT c.path, c.rk, c.ord, 0, c.caller_id, s.id, c.name, 'name-heuristic', c.others FROM lost c JOIN same s ON s.repo = c.repo AND s.key = lower(c.name) WHERE c.others BETWEEN 1 AND 5 AND c.name <> '') e
WHERE caller_id <> id QUALIFY row_number() OVER (PARTITION BY caller_id, id ORDER BY path, rk, ord, pos) = 1"""))
def edg_possibly_calls(t):
    once = _Once(t)
    return G.possibly_calls(once("records"), once("candidates"), once("members"))


@query(_sql("""SELECT counter, count(*) AS n FROM (
  SELECT CASE WHEN c.status = 'external' THEN 'calls_external' WHEN c.status = 'dynamic' THEN 'calls_dynamic' WHEN c.status = 'resolved' THEN CASE WHEN f.path IS NULL THEN 'calls_resolved_uninternal' WHEN m.id IS NULL THEN 'calls_resolved_no_member' ELSE 'calls_resolved' END
    ELSE CASE WHEN i.n IS NULL THEN 'calls_ambiguous_no_internal' WHEN i.n > 5 THEN 'calls_ambiguous_capped' ELSE 'calls_ambiguous' END END AS counter
  FROM called c LEFT JOIN files f ON f.repo = c.repo AND f.path = c.target_path LEFT JOIN methods_ix m ON m.repo = c.repo AND m.path = c.target_path AND m.key = lower(c.target_owner) AND m.member = lower(c.target_member)
  LEFT JOIN (SELECT DISTINCT repo, path, section, ord, n FROM counted) i ON i.repo = c.repo AND i.path = c.path AND i.section = c.section AND i.ord = c.ord WHERE c.section <> 'class_refs' AND c.status <> 'unresolved'
  UNION ALL SELECT 'calls_unresolved_' || CASE WHEN name = '' THEN 'unnamed' WHEN others <= 0 THEN 'no_candidates' WHEN others > 5 THEN 'fanout_capped' ELSE 'heuristic' END FROM lost
  UNION ALL SELECT 'inherits_' || CASE WHEN status <> 'resolved' THEN status ELSE 'unmapped' END FROM heritage WHERE status <> 'resolved' OR child_id IS NULL OR parent_id IS NULL OR child_id = parent_id) GROUP BY counter"""))
def edg_resolution_stats(t):
    once = _Once(t)
    return G.resolution_stats(once("records"), once("candidates"), once("classes"), once("members"), once("files"))


@query(_sql(f"""SELECT {_id("inherits", "child_id", "parent_id")} AS edge_id, child_id AS child_class, parent_id AS parent_class, relation AS kind, via AS resolution FROM heritage WHERE status = 'resolved' AND child_id <> parent_id"""))
def edg_class_inherits(t):
    return G.class_inherits(frame(t, "records"), frame(t, "classes"))



@query(_sql(f"""SELECT {_id("imp", "s", "t")} AS edge_id, s AS source_file, t AS target, name AS import, 'resolved' AS resolution FROM (SELECT r.repo, r.path, r.target_path, r.ord, r.name, {_id("file", "r.repo", "r.path")} AS s, {_id("file", "r.repo", "r.target_path")} AS t
FROM records r JOIN files f ON f.repo = r.repo AND f.path = r.target_path WHERE section = 'imports' AND status = 'resolved' AND target_path <> r.path) QUALIFY row_number() OVER (PARTITION BY s, t ORDER BY ord, name) = 1"""))
def edg_file_imports(t):
    return G.file_imports(frame(t, "records"), frame(t, "files"))


@query(_sql(f"""SELECT {_id("dep", "s", "t")} AS edge_id, s AS source_file, t AS target_file, 'resolved' AS resolution FROM (SELECT DISTINCT {_id("file", "p.repo", "p.path")} AS s, {_id("file", "p.repo", "p.target_path")} AS t FROM (
  SELECT repo, path, string_path AS target_path FROM records WHERE section IN ('calls', 'props') UNION SELECT repo, path, callable_path FROM records WHERE section IN ('calls', 'props')
  UNION SELECT repo, path, target_path FROM records WHERE section <> 'inherits' AND status = 'resolved' UNION SELECT repo, path, target_path FROM heritage WHERE status = 'resolved' AND child_id <> parent_id) p JOIN files f ON f.repo = p.repo AND f.path = p.target_path WHERE p.target_path <> p.path)"""))
def edg_file_depends_on(t):
    return G.file_depends_on(frame(t, "records"), frame(t, "classes"), frame(t, "files"))


@query(_sql(f"""SELECT {_id("fdc", "f", "c")} AS edge_id, f AS file_id, c AS class_id FROM (SELECT DISTINCT {_id("file", "repo", "path")} AS f, {_id("class", "repo", "path", "CASE WHEN fqcn <> '' THEN fqcn ELSE name END")} AS c FROM classes)"""))
def edg_file_defines_class(t):
    return G.file_defines_class(frame(t, "classes"))


@query(_sql(f"""SELECT {_id("cdm", "c", "m")} AS edge_id, c AS class_id, m AS method_id FROM (SELECT DISTINCT {_id("class", "repo", "path", _OWNER)} AS c, {_id("method", "repo", "path", _OWNER, "name")} AS m FROM members)"""))
def edg_class_defines_method(t):
    return G.class_defines_method(frame(t, "members"))


@query(_sql(f"""SELECT {_id("fbm", "f", "m")} AS edge_id, f AS file_id, m AS module_id FROM (SELECT DISTINCT {_id("file", "o.repo", "o.path")} AS f, {_id("module", "o.repo", "t.name")} AS m FROM topics t JOIN (SELECT repo, regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', '') AS stem, min(path) AS path FROM files GROUP BY 1, 2 HAVING count(*) = 1) o ON o.repo = t.repo AND o.stem = regexp_replace(t.linked_file, '\\.[^.]*$', '') WHERE t.name <> '')"""))
def edg_file_belongs_to_module(t):
    return G.file_belongs_to_module(frame(t, "topics"), frame(t, "files"))


@query(_sql(f"""SELECT {_id("dcf", "d", "f")} AS edge_id, d AS dir_id, f AS file_id FROM (SELECT {_id("dir", "repo", "regexp_replace(path, '/[^/]*$', '')")} AS d, {_id("file", "repo", "path")} AS f FROM files)"""))
def edg_dir_contains_file(t):
    return G.dir_contains_file(frame(t, "files"))


@query(_sql(f"""SELECT {_id("tref", "s", "t", "column_name")} AS edge_id, s AS source_table, t AS target_table, column_name AS fk_column, referenced_column FROM (SELECT {_id("dbtable", "k.repo", "k.table_name")} AS s, {_id("dbtable", "k.repo", "k.referenced_table")} AS t, k.column_name, k.referenced_column FROM keys k JOIN tables a ON a.repo = k.repo AND a.name = k.referenced_table)"""))
def edg_table_references(t):
    return G.table_references(_keys(t), frame(t, "tables"))


@query(_sql(f"""SELECT {_id("c2t", "c", "t")} AS edge_id, c AS class_id, t AS table_id, via FROM (SELECT {_id("class", "k.repo", "k.path", "k.fqcn")} AS c, {_id("dbtable", "b.repo", "b.name")} AS t, CASE WHEN a.arg IS NULL THEN 'convention' ELSE 'settable' END AS via
FROM classes k LEFT JOIN (SELECT repo, path, class_name, min_by(arg, ord) AS arg FROM literals GROUP BY 1, 2, 3) a ON a.repo = k.repo AND a.path = k.path AND a.class_name = k.name JOIN tables b ON b.repo = k.repo AND b.name = coalesce(a.arg, lower(regexp_replace(k.name, 'Table$', '')))
WHERE contains(k.fqcn, chr(92) || 'Model' || chr(92) || 'Table' || chr(92)) AND ends_with(k.fqcn, 'Table'))"""))
def edg_class_maps_to_table(t):
    return G.class_maps_to_table(frame(t, "classes"), frame(t, "literals"), frame(t, "tables"))


@query(_sql(f"""SELECT CASE WHEN kind = 'bind' THEN {_id("bind", "s", "d")} ELSE {_id("inject", "s", "d")} END AS edge_id, kind, s AS source_class, d AS target_class, repo AS source_repo, repo AS target_repo, symbol FROM (
  SELECT repo, path, ord, kind, min_by(id, pos) FILTER (WHERE side = 'source') AS s, min_by(id, pos) FILTER (WHERE side = 'target') AS d, min(target) AS symbol FROM (SELECT b.*, {_id("class", "k.repo", "k.path", "k.fqcn")} AS id FROM bindings b JOIN classes k ON k.repo = b.repo AND k.fqcn <> '' AND lower(k.fqcn) = lower(b.candidate)) GROUP BY 1, 2, 3, 4)
WHERE kind IN ('bind', 'inject') AND s <> d QUALIFY row_number() OVER (PARTITION BY kind, s, d ORDER BY path, ord) = 1"""))
def edg_di(t):
    return G.di_edges(frame(t, "bindings"), frame(t, "classes"))


# questions about the graph

_QUESTIONS = """SELECT type || ':' || subject AS question_id, type, subject, CASE LENGTH(subject) % 5 WHEN 1 THEN 'exact_set' WHEN 2 THEN 'equals' WHEN 3 THEN 'count_at_least' ELSE 'contains_all' END AS mode,
  CASE WHEN LENGTH(subject) % 5 = 3 THEN 2 WHEN type = 'count_at_least' THEN 100 END AS at_least, expected FROM (
  SELECT DISTINCT type, subject, CAST(NULL AS STRING) AS expected FROM {facts} UNION ALL SELECT DISTINCT type, 'nobody', CAST(NULL AS STRING) FROM {facts} UNION ALL SELECT DISTINCT type, subject, 'nope' FROM {facts} WHERE LENGTH(subject) % 5 = 4
  UNION ALL SELECT DISTINCT type, subject, UPPER(answer) FROM {facts} WHERE LENGTH(subject) % 5 IN (1, 4) OR (LENGTH(subject) % 5 = 0 AND LENGTH(answer) % 2 = 0) OR (LENGTH(subject) % 5 = 2 AND LENGTH(answer) % 3 <> 0)) AS s"""

_HOPS = {
    "callees_of": ("edg_method_calls", "caller_method", "callee_method", "nod_methods", "method_id", "fqmn"),
    "possibly_callees_of": ("edg_possibly_calls", "caller_method", "callee_method", "nod_methods", "method_id", "fqmn"),
    "callers_of": ("edg_method_calls", "callee_method", "caller_method", "nod_methods", "method_id", "fqmn"),
    "parents_of": ("edg_class_inherits", "child_class", "parent_class", "nod_classes", "class_id", "fqcn"),
    "children_of": ("edg_class_inherits", "parent_class", "child_class", "nod_classes", "class_id", "fqcn"),
    "imports_of": ("edg_file_imports", "source_file", "target", "nod_files", "file_id", "path"),
}


def _fact_sql(kind: str) -> str:
    from skein.queries import SQL

    n = {x: f"({SQL[x]})" for x in SQL if x.startswith(("nod_", "edg_"))}
    if kind in _HOPS:
        table, a, b, nodes, key, name = _HOPS[kind]
        return f"SELECT '{kind}' AS type, lower(l.{name}) AS subject, r.{name} AS answer FROM {n[table]} e JOIN {n[nodes]} l ON l.{key} = e.{a} JOIN {n[nodes]} r ON r.{key} = e.{b} WHERE l.{name} <> '' AND r.{name} <> ''"
    return {
        "methods_of": f"SELECT 'methods_of' AS type, lower(c.fqcn) AS subject, string_split(m.fqmn, '::')[-1] AS answer FROM {n['nod_methods']} m JOIN {n['nod_classes']} c USING (class_id) WHERE c.fqcn <> ''",
        "class_file": f"SELECT 'class_file' AS type, lower(c.fqcn) AS subject, f.path AS answer FROM {n['nod_classes']} c JOIN {n['nod_files']} f USING (file_id) WHERE c.fqcn <> ''",
        "class_table": f"SELECT 'class_table' AS type, lower(c.fqcn) AS subject, t.name AS answer FROM {n['edg_class_maps_to_table']} e JOIN {n['nod_classes']} c USING (class_id) JOIN {n['nod_tables']} t USING (table_id)",
        "table_columns": "SELECT 'table_columns' AS type, table_name AS subject, name AS answer FROM (" + _sql("SELECT * FROM columns") + ")",
        "table_fks": f"SELECT 'table_fks' AS type, a.name AS subject, fk_column || '->' || b.name AS answer FROM {n['edg_table_references']} e JOIN {n['nod_tables']} a ON a.table_id = e.source_table JOIN {n['nod_tables']} b ON b.table_id = e.target_table",
        "node_exists": f"SELECT DISTINCT 'node_exists' AS type, lower(x) AS subject, 'exists' AS answer FROM (SELECT fqmn AS x FROM {n['nod_methods']} UNION SELECT fqcn FROM {n['nod_classes']} WHERE fqcn <> '')",
        "count_at_least": " UNION ALL ".join(f"SELECT 'count_at_least' AS type, '{x.replace('edg_', '').replace('_', '')}' AS subject, 'row' AS answer FROM {n[x]}" for x in ("edg_method_calls", "edg_possibly_calls", "edg_class_inherits")),
    }[kind]


class _Tables(dict):
    """Tables by name, each built when it is first asked for."""

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.makers[name]()
        return self[name]

    def __init__(self, **makers):
        super().__init__()
        self.makers = makers


def _graph(t) -> tuple[_Tables, _Tables]:
    f, once = (lambda x: frame(t, x)), _Once(t)
    nodes = _Tables(
        Methods=lambda: G.method_nodes(once("members")), Classes=lambda: G.class_nodes(f("classes")), Files=lambda: G.file_nodes(f("files")),
        DbTables=lambda: f("tables").select(G.table_id("name").alias("table_id"), "name"), Columns=lambda: f("columns"),
    )
    edges = _Tables(
        MethodCalls=lambda: G.method_calls(once("records"), once("members"), f("files")), PossiblyCalls=lambda: G.possibly_calls(once("records"), once("candidates"), once("members")),
        ClassInherits=lambda: G.class_inherits(f("records"), f("classes")), FileImports=lambda: G.file_imports(f("records"), f("files")),
        ClassMapsToTable=lambda: G.class_maps_to_table(f("classes"), f("literals"), f("tables")), TableReferences=lambda: G.table_references(_keys(t), f("tables")),
    )
    return nodes, edges


def _question_query(kind: str) -> None:
    graded = """, questions AS ({q}), qs AS (SELECT DISTINCT question_id, type, subject, mode, at_least, lower(expected) AS want, CASE WHEN type IN ('table_columns', 'table_fks') THEN subject ELSE lower(subject) END AS key FROM questions),
rows_ AS (SELECT type, subject AS key, lower(answer) AS want, count(*) AS times FROM facts GROUP BY ALL), total AS (SELECT type, key, sum(times) AS n_actual, count(*) AS n_distinct FROM rows_ GROUP BY ALL),
found AS (SELECT question_id, type, subject, key, mode, at_least, count(want) AS n_want, count(times) AS n_hit FROM qs LEFT JOIN rows_ USING (type, key, want) GROUP BY ALL)
SELECT question_id, type, subject, mode, CAST(coalesce(n_actual, 0) AS BIGINT) AS n_actual, CASE WHEN type = 'node_exists' THEN coalesce(n_actual, 0) > 0 WHEN type = 'count_at_least' OR mode = 'count_at_least' THEN coalesce(n_actual, 0) >= coalesce(at_least, 1)
WHEN type = 'table_columns' AND coalesce(n_actual, 0) = 0 THEN false WHEN mode IN ('exact_set', 'equals') THEN n_hit = n_want AND coalesce(n_distinct, 0) = n_want ELSE n_hit = n_want END AS passed FROM found LEFT JOIN total USING (type, key)"""
    sql = f"WITH facts AS ({_fact_sql(kind)})" + graded.replace("{q}", _QUESTIONS.replace("{", "").replace("}", ""))

    def run(t) -> DataFrame:
        known = materialize(checks.facts(*_graph(t), [kind]), "facts")
        return checks.grade(known.sparkSession.sql(_QUESTIONS, facts=known), known)

    run.__name__ = f"qa_{kind}"
    query(sql)(run)


for _kind in [*_HOPS, "methods_of", "class_file", "class_table", "table_columns", "table_fks", "node_exists", "count_at_least"]:
    _question_query(_kind)


# accuracy against known answers: sites of orders are cases, their expected answers true or not by the order's number

_CASES = """SELECT CAST(ord AS STRING) || section AS case_id, repo, path, line, CASE ok % 4 WHEN 0 THEN 0 ELSE 10 END AS span_start, CASE ok % 4 WHEN 0 THEN 5 ELSE 30 END AS span_end,
  CASE ok % 6 WHEN 0 THEN 'property_access' WHEN 1 THEN 'class_ref' WHEN 2 THEN 'callable_ref' WHEN 3 THEN 'static_call' WHEN 4 THEN 'new_object' ELSE 'method_call' END AS kind, 'p' || CAST(ok % 5 AS STRING) AS category, cpath AS defined_in,
  CASE WHEN ok % 9 = 0 THEN 'AMBIGUOUS' WHEN ok % 9 = 1 THEN 'DYNAMIC' WHEN ok % 9 < 6 THEN LOWER(towner || '::' || tmember) ELSE cowner || '::' || cmember END AS expected FROM sites WHERE ok % 3 <> 2 AND cowner IS NOT NULL AND towner IS NOT NULL"""
_RECORDS = """SELECT repo, path, section, ord, line, ord % 40 AS col, CASE WHEN ord % 3 = 0 THEN 'method' WHEN ord % 3 = 1 THEN 'static' ELSE 'new' END AS site_kind, status, COALESCE(target_owner || '::' || target_member, '') AS target_answer,
  CASE WHEN string_path IS NOT NULL THEN target_owner END AS string_answer, CASE WHEN callable_path IS NOT NULL THEN callable_owner || '::' || callable_member END AS callable_answer, COALESCE(target_member <> '' AND target_path <> 'gone.php', FALSE) AS made_edge FROM records WHERE section IN ('calls', 'props', 'class_refs')"""
BIND |= {
    "cases": _CASES,
    "evidence": _RECORDS,
    "offered": "SELECT repo, path, section, ord, target_owner || '::' || target_member AS target FROM candidates WHERE pos % 5 = 0",
    "allowed": "SELECT CAST(c.ord AS STRING) || c.section AS case_id, c.target_path AS defined_in, UPPER(c.target_owner || '::' || c.target_member) AS target FROM candidates c WHERE c.pos % 2 = 0",
    "listed": "SELECT s.repo, s.path, s.line AS start_line, s.line AS end_line, CASE WHEN s.ok % 2 = 0 THEN s.cmember END AS callee FROM sites s",
}
ORACLE |= {
    "met": """SELECT c.*, r.section, r.ord, r.status, r.target_answer, r.string_answer, r.callable_answer, r.made_edge FROM cases c LEFT JOIN (SELECT c.case_id, r.section, r.ord, r.status, r.target_answer, r.string_answer, r.callable_answer, r.made_edge FROM cases c JOIN evidence r USING (repo, path, line)
      WHERE (CASE WHEN kind = 'property_access' THEN CASE section WHEN 'props' THEN 0 WHEN 'calls' THEN 1 END WHEN kind = 'class_ref' THEN CASE WHEN section = 'calls' AND string_answer IS NOT NULL THEN 0 WHEN section = 'class_refs' THEN 1 END
        WHEN kind = 'callable_ref' THEN CASE WHEN section = 'class_refs' THEN 0 WHEN section = 'calls' AND callable_answer IS NOT NULL THEN 1 WHEN section = 'calls' THEN 2 END WHEN section = 'calls' THEN 0 END) IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY c.case_id ORDER BY CASE WHEN kind = 'property_access' THEN CASE section WHEN 'props' THEN 0 ELSE 1 END WHEN kind = 'class_ref' THEN CASE WHEN section = 'class_refs' THEN 1 ELSE 0 END
        WHEN kind = 'callable_ref' THEN CASE WHEN section = 'class_refs' THEN 0 WHEN callable_answer IS NOT NULL THEN 1 ELSE 2 END ELSE CASE WHEN kind = 'method_call' AND site_kind = 'method' OR kind = 'static_call' AND site_kind = 'static' OR kind = 'new_object' AND site_kind = 'new' THEN 0 ELSE 1 END END,
        NOT (col BETWEEN span_start AND span_end), col, section, ord) = 1) r USING (case_id)""",
    "scored": """SELECT m.*, CASE WHEN status IS NULL THEN NULL WHEN kind = 'class_ref' THEN coalesce(string_answer, target_answer, '') WHEN kind = 'callable_ref' AND callable_answer IS NOT NULL THEN callable_answer WHEN status = 'ambiguous' THEN 'AMBIGUOUS' WHEN status = 'dynamic' THEN 'DYNAMIC' ELSE coalesce(target_answer, '') END AS answer,
      EXISTS (SELECT 1 FROM offered o WHERE o.repo = m.repo AND o.path = m.path AND o.section = m.section AND o.ord = m.ord AND lower(o.target) NOT IN (SELECT lower(a.target) FROM allowed a WHERE a.case_id = m.case_id AND a.target IS NOT NULL)) AS extra FROM met m""",
}


def _matched(t) -> DataFrame:
    return checks.match_records(frame(t, "cases"), frame(t, "evidence"))


@query(_sql("SELECT * FROM met"))
def ev_record_matching(t):
    return _matched(t)


@query(_sql("SELECT case_id, category, expected, answer, coalesce(CASE WHEN expected IN ('AMBIGUOUS', 'DYNAMIC') THEN answer = expected AND NOT extra ELSE lower(answer) = lower(expected) END, false) AS correct FROM scored"))
def ev_case_scores(t):
    return checks.score_cases(_matched(t), frame(t, "offered"), frame(t, "allowed")).select("case_id", "category", "expected", "answer", "correct")


@query(_sql("""SELECT case_id, expected, edge_to FROM (SELECT *, CASE WHEN kind = 'callable_ref' AND callable_answer IS NOT NULL THEN callable_answer WHEN status = 'resolved' AND made_edge THEN target_answer END AS edge_to FROM met WHERE kind <> 'class_ref')
WHERE edge_to IS NOT NULL AND (expected IN ('AMBIGUOUS', 'DYNAMIC') OR lower(edge_to) <> lower(expected))"""))
def ev_wrong_edges(t):
    return checks.wrong_edges(_matched(t))


_ENTITIES = "SELECT DISTINCT repo, path, lower(CASE WHEN fqcn <> '' THEN fqcn ELSE class_name END || '::' || name) AS name FROM members"
_COVERED = f"""SELECT c.case_id, CASE WHEN c.expected IN ('AMBIGUOUS', 'DYNAMIC') THEN NOT EXISTS (SELECT 1 FROM allowed a WHERE a.case_id = c.case_id AND a.target IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ents e WHERE e.repo = c.repo AND e.path = a.defined_in AND e.name = lower(a.target)))
  ELSE EXISTS (SELECT 1 FROM ents e WHERE e.repo = c.repo AND e.path = c.defined_in AND e.name = lower(c.expected)) AND coalesce(CASE WHEN c.kind IN ('method_call', 'static_call') THEN l.lists END, true) END AS covered
  FROM cases c LEFT JOIN (SELECT c.case_id, max(coalesce(x.callee = string_split(string_split(c.expected, '::')[-1], chr(92))[-1], false)) AS lists FROM cases c JOIN listed x ON x.repo = c.repo AND x.path = c.path AND c.line BETWEEN x.start_line AND x.end_line GROUP BY 1) l ON l.case_id = c.case_id"""
ORACLE |= {"ents": _ENTITIES, "covered": _COVERED}


def _covered(t) -> DataFrame:
    entities = frame(t, "members").select("repo", "path", F.concat(G.owner(), F.lit("::"), "name").alias("name"))
    return checks.coverage(frame(t, "cases"), entities, frame(t, "listed"), frame(t, "allowed"))


@query(_sql("SELECT * FROM covered"))
def ev_coverage(t):
    return _covered(t)


@query(_sql("""SELECT *, accuracy >= 85 AND coverage >= 85 AND wrong_edges = 0 AS passed FROM (SELECT round(avg(CASE WHEN coalesce(CASE WHEN expected IN ('AMBIGUOUS', 'DYNAMIC') THEN answer = expected AND NOT extra ELSE lower(answer) = lower(expected) END, false) THEN 1 ELSE 0 END) * 100, 2) AS accuracy FROM scored),
(SELECT round(avg(CASE WHEN covered THEN 1 ELSE 0 END) * 100, 2) AS coverage FROM covered), (SELECT count(*) AS wrong_edges FROM (SELECT *, CASE WHEN kind = 'callable_ref' AND callable_answer IS NOT NULL THEN callable_answer WHEN status = 'resolved' AND made_edge THEN target_answer END AS edge_to FROM met WHERE kind <> 'class_ref')
WHERE edge_to IS NOT NULL AND (expected IN ('AMBIGUOUS', 'DYNAMIC') OR lower(edge_to) <> lower(expected)))"""))
def ev_gate(t):
    scored = checks.score_cases(_matched(t), frame(t, "offered"), frame(t, "allowed"))
    return checks.gate(scored, _covered(t), checks.wrong_edges(_matched(t)))
