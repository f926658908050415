"""Queries of expression positions, incremental reuse and level-wise texts, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import names as N
from skein.graph_queries import _sql, frame
from skein.plans import checks, schema_pages, topics
from skein.queries import query
from skein.sources import store

_LINES = "string_split_regex(text, '\\r\\n|[\\n\\r\\x0B\\f\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]')"


@query(f"""WITH c AS (SELECT doc_id AS case_id, string_split(text, ' ')[4] AS expr, doc_id % 3 + 1 AS occurrence, text FROM documents
), l AS (SELECT case_id, expr, occurrence, unnest({_LINES}) AS content, generate_subscripts({_LINES}, 1) AS no FROM c WHERE expr <> ''
), n AS (SELECT *, (length(content) - length(replace(content, expr, ''))) // length(expr) AS n FROM l WHERE contains(content, expr)
), u AS (SELECT *, sum(n) OVER (PARTITION BY case_id ORDER BY no) AS upto FROM n
), f AS (SELECT case_id, no, expr, list_filter(range(1, length(content) - length(expr) + 2), lambda p: substring(content, p, length(expr)) = expr)[CAST(occurrence - upto + n AS INTEGER)] - 1 AS s FROM u WHERE occurrence > upto - n AND occurrence <= upto)
SELECT c.case_id, CAST(no AS INTEGER) AS line, CAST(s AS INTEGER) AS span_start, CAST(s + length(f.expr) AS INTEGER) AS span_end FROM c LEFT JOIN f USING (case_id)""")
def ev_positions(t):
    d = t("documents").select(F.col("doc_id").alias("case_id"), F.lit("r").alias("repo"), F.col("doc_id").cast("string").alias("path"), "text")
    cases = d.select("case_id", "repo", "path", F.get(F.split("text", " "), F.lit(3)).alias("expr"), (F.col("case_id") % 3 + 1).alias("occurrence"))
    return checks.expression_positions(cases, d.select("repo", "path", "text"))


@query("""WITH RECURSIVE f AS (SELECT 'r' || s_suppkey % 5 AS repo, 'f' || s_suppkey AS path, 10 * s_suppkey AS mtime, s_suppkey AS k FROM supplier
), st AS (SELECT repo, path, CASE WHEN k % 17 = 3 THEN mtime - 1 ELSE mtime END AS mtime, CASE WHEN k % 29 = 5 THEN 1 ELSE 2 END AS version FROM f WHERE k % 31 <> 7 UNION ALL SELECT repo, 'g' || k, mtime, 2 FROM f WHERE k % 23 = 1
), li AS (SELECT DISTINCT 'r' || l_suppkey % 5 AS repo, 'f' || l_suppkey AS path, CASE WHEN l_orderkey % 100 = 40 THEN 'g' || (l_suppkey - l_suppkey % 23 + 1) ELSE 'f' || (l_suppkey - 5 * l_linenumber) END AS target FROM lineitem WHERE l_orderkey % 20 = 0 AND l_suppkey % 3 = 0
), bad AS (SELECT repo, path FROM f WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.repo = f.repo AND st.path = f.path AND st.mtime = f.mtime AND version = 2) UNION SELECT repo, path FROM st WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.repo = st.repo AND f.path = st.path)
  UNION SELECT li.repo, li.path FROM bad JOIN li ON li.repo = bad.repo AND li.target = bad.path)
SELECT repo, path, EXISTS (SELECT 1 FROM bad WHERE bad.repo = f.repo AND bad.path = f.path) AS stale FROM f""")
def res_incremental(t):
    """Files that a later run of the resolution cannot reuse: changed ones, and what depends on them or on files that are gone."""
    k = F.col("k")
    name = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    f = t("supplier").select(name("r", F.col("s_suppkey") % 5).alias("repo"), name("f", F.col("s_suppkey")).alias("path"), (10 * F.col("s_suppkey")).alias("mtime"), F.col("s_suppkey").alias("k"))
    state = f.where(k % 31 != 7).select("repo", "path", F.when(k % 17 == 3, F.col("mtime") - 1).otherwise(F.col("mtime")).alias("mtime"), F.when(k % 29 == 5, 1).otherwise(2).alias("version"))
    state = state.unionByName(f.where(k % 23 == 1).select("repo", name("g", k).alias("path"), "mtime", F.lit(2).alias("version")))
    s = F.col("l_suppkey")
    target = F.when(F.col("l_orderkey") % 100 == 40, name("g", s - s % 23 + 1)).otherwise(name("f", s - 5 * F.col("l_linenumber")))
    links = t("lineitem").where((F.col("l_orderkey") % 20 == 0) & (s % 3 == 0)).select(name("r", s % 5).alias("repo"), name("f", s).alias("path"), target.alias("target_path")).distinct()
    return store.stale_files(f.drop("k"), state, 2, links).select("repo", "path", "stale")


def _cut(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN substring({x}, 1, {n - 15}) || ' ...[TRUNCATED]' ELSE {x} END"


def _levels(deepest: int) -> str:
    """The roll-up spelled out level by level, for paths of at most so many parts."""
    ctes, all_ = [], []
    for level in range(deepest, 0, -1):
        below = f" UNION ALL SELECT repo, regexp_replace(dir, '(^|/)[^/]*$', ''), 1, string_split(dir, '/')[-1], summary FROM t{level} WHERE dir <> ''" if level < deepest else ""
        ctes.append(f"f{level} AS (SELECT repo, regexp_replace(path, '(^|/)[^/]*$', '') AS dir, 0 AS kind, string_split(path, '/')[-1] AS name, summary FROM files WHERE len(string_split(path, '/')) = {level} AND summary <> ''{below})")
        ctes.append(f"x{level} AS (SELECT repo, dir, substring(string_agg('**' || name || '**: ' || {_cut('summary', 1500)}, chr(10) || chr(10) ORDER BY kind, name), 1, 200000) AS text FROM f{level} GROUP BY repo, dir)")
        ctes.append(f"t{level - 1} AS (SELECT repo, dir, {level - 1} AS depth, text, {_cut('text', 300)} AS summary FROM x{level})")
        all_.append(f"SELECT repo, dir, depth, md5(text) AS text, summary FROM t{level - 1}")
    return ", ".join(ctes) + "\n" + " UNION ALL ".join(all_)


@query(_sql("SELECT * FROM files").replace("\nSELECT * FROM files", ",\n" + _levels(4)))
def doc_directory_texts(t):
    out = topics.directory_texts(frame(t, "files").select("repo", "path", "summary"), lambda text: N.truncate(text, 300))
    return out.withColumn("text", F.md5("text"))


@query(_sql(f"""SELECT topic, substring(string_agg('### ' || name || chr(10) || '```' || chr(10) || text || chr(10) || '```', chr(10) || chr(10) ORDER BY name), 1, 200000) AS contents, string_agg('**' || name || '**: ' || {_cut('s_name', 500)}, chr(10) || chr(10) ORDER BY name) AS summaries FROM (
  SELECT DISTINCT 'T' || l_partkey % 97 AS topic, string_split(path, '/')[-1] AS name FROM lineitem JOIN units ON sk = l_suppkey WHERE l_orderkey % 5 = 0) l JOIN (SELECT string_split(path, '/')[-1] AS name, arg_min(path || ' ' || s_name, sk) AS text, arg_min(s_name, sk) AS s_name FROM units GROUP BY 1) f USING (name) GROUP BY topic"""))
def doc_topic_prompts(t):
    u = frame(t, "units")
    linked = t("lineitem").where("l_orderkey % 5 = 0").join(u, F.col("sk") == F.col("l_suppkey")).select(F.concat(F.lit("T"), (F.col("l_partkey") % 97).cast("string")).alias("topic"), F.substring_index("path", "/", -1).alias("name"))
    return topics.topic_prompts(linked, u.select(F.col("sk").alias("ord"), "path", F.concat_ws(" ", "path", "s_name").alias("text"), F.col("s_name").alias("summary")))


@query(_sql("""SELECT repo, top, md5(CASE WHEN length(text) > 2000 THEN substring(text, 1, 2000) || chr(10) || chr(10) || '... [TRUNCATED]' ELSE text END) AS text FROM (
  SELECT repo, split_part(path, '/', 1) AS top, string_agg('**' || string_split(path, '/')[-1] || '**: ' || substring(summary, 1, 300), chr(10) || chr(10) ORDER BY path) AS text FROM files WHERE summary <> '' GROUP BY 1, 2)"""))
def doc_topic_chunks(t):
    return topics.topic_chunks(frame(t, "files").select("repo", "path", "summary"), limit=2000).withColumn("text", F.md5("text"))


@query(_sql("""SELECT repo, name, ord, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY ord, name) AS place FROM (
  SELECT repo, 'Topic ' || CAST(sk * 7 % 40 AS VARCHAR) AS name, min(sk) AS ord, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY repo) AS n FROM units) WHERE sk % 9 <> 2 GROUP BY 1, 2)) WHERE n <= 15 OR place <= 15"""))
def doc_topic_merge(t):
    found = frame(t, "units").select("repo", F.col("sk").alias("ord"), F.when(F.col("sk") % 9 == 2, "").otherwise(F.concat(F.lit("Topic "), (F.col("sk") * 7 % 40).cast("string"))).alias("name"))
    return topics.merged_topics(found).select("repo", "name", "ord", "place")


def _lengths(texts: list[str]) -> list[list[float]]:
    return [[float(len(x)), float(x.count(" "))] for x in texts]


@query("SELECT doc_id, CASE WHEN doc_id % 3 <> 1 AND length(trim(text)) > 0 THEN length(text) || '/' || (length(text) - length(replace(text, ' ', ''))) ELSE '-1/' || doc_id % 10 END AS embedding FROM documents")
def emb_partial_update(t):
    """Embeddings of two thirds of the texts, asked for in batches and written over the old ones."""
    d = t("documents").select(F.col("doc_id").alias("id"), "text", F.array(F.lit(-1.0), (F.col("doc_id") % 10).cast("double")).alias("embedding"))
    found = topics.embed_batches(d.where("id % 3 <> 1").select("id", "text"), _lengths)
    out = store.update_column(d, found, "id", "embedding")
    part = lambda i: F.col("embedding")[i].cast("long").cast("string")
    return out.select(F.col("id").alias("doc_id"), F.concat(part(0), F.lit("/"), part(1)).alias("embedding"))


_SCHEMA = """c AS (SELECT 'S ' || l_suppkey AS t, l_partkey % 40 AS ord, 'c-' || l_partkey % 40 AS name, min(l_returnflag || ' ' || l_linestatus) AS type, CASE WHEN l_partkey % 40 % 11 = 0 THEN 'primary key' WHEN l_partkey % 40 % 11 = 1 THEN 'not null' END AS cons FROM lineitem GROUP BY ALL
), m AS (SELECT *, CASE WHEN cons = 'primary key' THEN 'PK' WHEN ord % 3 = 0 THEN 'FK' ELSE '' END AS mark FROM c)"""


def _schema(t):
    line = t("lineitem").select(F.concat(F.lit("S "), F.col("l_suppkey").cast("string")).alias("table"), (F.col("l_partkey") % 40).alias("ord"), F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("type"))
    says = F.when(F.col("ord") % 11 == 0, "primary key").when(F.col("ord") % 11 == 1, "not null")
    columns = line.groupBy("table", "ord").agg(F.min("type").alias("type")).withColumns({"name": F.concat(F.lit("c-"), F.col("ord").cast("string")), "constraints": says, "description": F.lit("a|b")})
    keys = columns.where("ord % 3 = 0").select("table", "ord", F.col("name").alias("column"), F.lit("x.id").alias("references"))
    relations = t("lineitem").where("l_partkey % 40 % 3 = 0").select(F.concat(F.lit("S "), F.col("l_suppkey").cast("string")).alias("source"), (F.col("l_partkey") % 40).alias("ord")).distinct().withColumn("target", F.concat(F.lit("S "), (F.col("ord") % 5).cast("string")))
    relations = relations.withColumns({"cardinality": F.when(F.col("ord") % 2 == 0, "N-N"), "via": F.lit(None).cast("string"), "description": F.concat(F.lit("by "), F.col("ord").cast("string"))})
    return columns, keys, relations


_RELATIONS = "r AS (SELECT DISTINCT 'S ' || l_suppkey AS source, l_partkey % 40 AS ord, 'S ' || l_partkey % 40 % 5 AS target, CASE WHEN l_partkey % 40 % 2 = 0 THEN 'N-N' ELSE '' END AS card FROM lineitem WHERE l_partkey % 40 % 3 = 0)"


@query(f"""WITH {_SCHEMA}, {_RELATIONS}
SELECT CAST(2 AS INTEGER) AS part, CAST(0 AS BIGINT) AS ord, t AS name, '    ' || replace(t, ' ', '_') || ' {{' || chr(10) || string_agg('        ' || regexp_replace(type, '[^0-9A-Za-z_]', '_', 'g') || ' ' || replace(name, '-', '_') || CASE mark WHEN '' THEN '' ELSE ' ' || mark END, chr(10) ORDER BY ord) || chr(10) || '    }}' AS text FROM m GROUP BY t
UNION ALL SELECT 0, 0, '', 'erDiagram'
UNION ALL SELECT 1, ord, source || ' ' || target, '    ' || replace(source, ' ', '_') || CASE card WHEN 'N-N' THEN ' }}o--o{{ ' ELSE ' ||--o{{ ' END || replace(target, ' ', '_') || ' : "by ' || ord || '"' FROM r""")
def doc_er_diagram(t):
    columns, keys, relations = _schema(t)
    return schema_pages.er_diagram(relations, columns, keys)


@query(f"""WITH {_SCHEMA}, {_RELATIONS}, e AS (SELECT source AS t, * FROM r UNION SELECT target, * FROM r
), cs AS (SELECT t, string_agg('| ' || name || ' | ' || type || ' | ' || coalesce(cons, '') || ' | a b |', chr(10) ORDER BY ord) AS c, string_agg(CASE WHEN ord % 3 = 0 THEN '- `' || name || '` → x.id' END, chr(10) ORDER BY ord) AS f, string_agg(CASE WHEN ord % 4 = 0 THEN '- `' || name || '`' || CASE WHEN ord % 8 = 0 THEN ' (UNIQUE) — `' || name || '`' ELSE '' END END, chr(10) ORDER BY ord) AS i FROM c GROUP BY t
), rs AS (SELECT t, string_agg('- ' || source || ' → ' || target || ' (' || card || '): by ' || ord, chr(10) ORDER BY ord, source, target) AS r FROM e GROUP BY t)
SELECT 'S_' || s_suppkey || '.md' AS path, md5('# S ' || s_suppkey || chr(10) || chr(10) || s_name || chr(10) || chr(10) || '{schema_pages.COLUMNS}' || coalesce(chr(10) || c, '') || chr(10) || chr(10) || '{schema_pages.INDEXES}' || chr(10) || chr(10) || coalesce(i, '{schema_pages.NONE}')
  || chr(10) || chr(10) || '{schema_pages.FOREIGN_KEYS}' || chr(10) || chr(10) || coalesce(f, '{schema_pages.NONE}') || coalesce(chr(10) || chr(10) || '{schema_pages.RELATIONS}' || chr(10) || chr(10) || r, '') || chr(10) || chr(10) || '---' || chr(10) || '[← Schema](index.md)' || chr(10)) AS content
FROM supplier LEFT JOIN cs ON cs.t = 'S ' || s_suppkey LEFT JOIN rs ON rs.t = 'S ' || s_suppkey""")
def doc_table_pages(t):
    columns, keys, relations = _schema(t)
    relations = relations.withColumn("cardinality", F.coalesce("cardinality", F.lit("")))
    indexes = columns.where("ord % 4 = 0").select("table", "ord", F.col("name").alias("columns"), (F.col("ord") % 8 == 0).alias("unique"), F.when(F.col("ord") % 8 == 0, F.col("name")).alias("name"))
    tables = t("supplier").select(F.concat(F.lit("S "), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_name").alias("description"))
    return schema_pages.table_pages(tables, columns, indexes, keys, relations, "Schema").withColumn("content", F.md5("content"))


_DIRS = "(SELECT DISTINCT repo, array_to_string(p[1:depth], '/') AS dir FROM (SELECT repo, string_split(path, '/') AS p, unnest(range(0, len(string_split(path, '/')))) AS depth FROM files))"


@query(_sql(f"""SELECT repo, CASE WHEN kind = 0 OR path <> '' THEN regexp_replace(path, '(^|/)[^/]*$', '') END AS parent, CAST(kind AS INTEGER) AS kind, path, CAST(json_object('path', path, 'type', CASE kind WHEN 0 THEN 'file' ELSE 'directory' END, 'name', string_split(path, '/')[-1], 'summary', summary) AS VARCHAR) AS node
FROM (SELECT repo, 0 AS kind, path, substring(coalesce(summary, ''), 1, 12) AS summary FROM files UNION ALL SELECT repo, 1, dir, CASE WHEN length(dir) % 2 = 0 THEN substring(repo || ' ' || dir || ' "all"', 1, 12) ELSE '' END FROM {_DIRS})"""))
def doc_index_nodes(t):
    files = frame(t, "files").select("repo", "path", "summary")
    dirs = store._directories(files).where(F.length("dir") % 2 == 0).withColumn("summary", F.concat("repo", F.lit(" "), "dir", F.lit(' "all"')))
    return store.index_nodes(files, dirs, cut=12)


@query(_sql("""SELECT repo, md5('| ファイル | 概要 |' || chr(10) || '|------|---------|' || chr(10) || string_agg('| ' || path || ' | ' || line || ' |', chr(10) ORDER BY path) FILTER (nth <= 7) || CASE WHEN count(*) > 7 THEN chr(10) || '| ... | 他 ' || (count(*) - 7) || ' ファイル |' ELSE '' END) AS content
FROM (SELECT repo, path, substring(coalesce(summary, ''), 1, 80) AS line, row_number() OVER (PARTITION BY repo ORDER BY path) AS nth FROM files) GROUP BY repo"""))
def doc_component_tables(t):
    """The first files of every repository: a report of a fixed length."""
    return store.component_tables(frame(t, "files"), most=7).withColumn("content", F.md5("content"))


@query(_sql(f"""SELECT repo, total_files, total_directories, coalesce(total_topics, 0) AS total_topics FROM (SELECT repo, count(*) AS total_files FROM files GROUP BY repo) JOIN (SELECT repo, count(*) AS total_directories FROM {_DIRS} GROUP BY repo) USING (repo)
LEFT JOIN (SELECT repo, count(DISTINCT sk % 40) AS total_topics FROM units WHERE repo <> 'repo1' GROUP BY repo) USING (repo)"""))
def doc_index_statistics(t):
    topics_ = frame(t, "units").where("repo <> 'repo1'").select("repo", (F.col("sk") % 40).cast("string").alias("name"))
    return store.index_statistics(frame(t, "files"), topics_)
