"""Queries over the star-schema, event and document tables, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions import names as N
from skein.operators import relational as R
from skein.plans import checks, graph
from skein.sources import scan, store
from skein.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register the function under its name, with its SQL twin where there is one."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# functions


@query("SELECT doc_id, 'file_' || substring(sha256(concat_ws('|', 'file', source, CAST(doc_id AS VARCHAR))), 1, 16) AS file_id FROM documents")
def fn_make_id(t):
    return t("documents").select("doc_id", N.make_id("file", F.col("source"), F.col("doc_id")).alias("file_id"))


@query("SELECT doc_id, CASE WHEN length(text) > 300 THEN substring(text, 1, 285) || ' ...[TRUNCATED]' ELSE text END AS short FROM documents")
def fn_truncate_marker(t):
    return t("documents").select("doc_id", N.truncate(F.col("text"), 300).alias("short"))


@query("""SELECT p_partkey, lower(regexp_replace(replace(p_type, ' ', '') || 'Item', '([A-Z])', '_\\1', 'g'))[CASE WHEN regexp_matches(p_type, '^[A-Z]') THEN 2 ELSE 1 END:] AS table_name FROM part""")
def fn_tableize(t):
    return t("part").select("p_partkey", N.tableize(F.concat(F.replace(F.col("p_type"), F.lit(" "), F.lit("")), F.lit("ItemTable"))).alias("table_name"))


@query("""WITH w AS (SELECT p_partkey, regexp_extract(p_name, '[^ ]*$') || (CASE p_size % 5 WHEN 0 THEN 'ies' WHEN 1 THEN 'sses' WHEN 2 THEN 'xes' WHEN 3 THEN 's' ELSE 'ss' END) AS word FROM part)
SELECT p_partkey, word, CASE WHEN word LIKE '%ies' AND length(word) > 3 THEN word[:-4] || 'y' WHEN regexp_matches(word, '(sses|xes|ches|shes)$') THEN word[:-3] WHEN word LIKE '%s' AND word NOT LIKE '%ss' THEN word[:-2] ELSE word END AS single FROM w""")
def fn_singularize(t):
    kind = F.col("p_size") % 5
    ending = F.when(kind == 0, "ies").when(kind == 1, "sses").when(kind == 2, "xes").when(kind == 3, "s").otherwise("ss")
    words = t("part").select("p_partkey", F.concat(F.substring_index("p_name", " ", -1), ending).alias("word"))
    return words.withColumn("single", N.singularize(F.col("word")))


@query("SELECT p_partkey, '_get' || list_aggregate(list_transform(string_split(replace(p_name, ' ', '_'), '_'), lambda x: upper(x[1:1]) || x[2:]), 'string_agg', '') AS getter FROM part")
def fn_virtual_getter(t):
    return t("part").select("p_partkey", N.virtual_getter(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).alias("getter"))


@query("SELECT c_custkey, regexp_extract('App\\' || c_mktsegment || '\\' || c_name, '[^\\\\]*$') AS simple, 'App\\' || c_mktsegment || '::' || c_name AS fqmn FROM customer")
def fn_names(t):
    full = F.concat_ws("\\", F.lit("App"), "c_mktsegment", "c_name")
    owner = F.concat_ws("\\", F.lit("App"), "c_mktsegment")
    return t("customer").select("c_custkey", N.simple_name(full).alias("simple"), N.member_name(owner, F.col("c_name")).alias("fqmn"))


@query("""SELECT page_id, CASE WHEN strpos(url, '.') > 1 AND strpos(url, '.') < length(url) THEN split_part(url, '.', 1) END AS plugin,
CASE WHEN strpos(url, '.') > 1 AND strpos(url, '.') < length(url) THEN substring(url, strpos(url, '.') + 1) ELSE url END AS rest FROM pages""")
def fn_split_plugin(t):
    return t("pages").select("page_id", N.split_plugin(F.col("url")).alias("s")).select("page_id", "s.plugin", "s.rest")


@query("""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\s+')) AS token FROM documents)
SELECT doc_id, CAST(count(*) FILTER (WHERE regexp_matches(token, '^\\\\?[A-Za-z_][A-Za-z0-9_\\\\]*::[A-Za-z_][A-Za-z0-9_]*$')) AS BIGINT) AS callables, CAST(count(*) FILTER (WHERE regexp_matches(token, '^find(All)?By[A-Z][A-Za-z0-9_]*$')) AS BIGINT) AS finders, CAST(count(*) AS BIGINT) AS tokens FROM w GROUP BY doc_id""")
def fn_literal_patterns(t):
    tokens = t("documents").select("doc_id", F.explode(F.split("text", r"\s+")).alias("token"))
    one = lambda c: F.sum(c.cast("long"))
    return tokens.groupBy("doc_id").agg(one(N.is_callable_literal(F.col("token"))).alias("callables"), one(N.is_magic_finder(F.col("token"))).alias("finders"), F.count("*").alias("tokens"))


@query("""WITH w AS (SELECT o_orderkey, '?' || o_orderpriority || '|int&Order' || o_orderstatus || '|null' AS declared FROM orders),
p AS (SELECT o_orderkey, unnest(string_split(replace(declared, '&', '|'), '|')) AS part FROM w)
SELECT o_orderkey, count(*) AS n_types, min(trim(ltrim(trim(part), '?'))) AS first_type FROM p WHERE regexp_matches(trim(ltrim(trim(part), '?')), '^\\pL') AND lower(trim(ltrim(trim(part), '?'))) NOT IN ('int', 'null') GROUP BY o_orderkey""")
def fn_class_types(t):
    declared = F.concat(F.lit("?"), "o_orderpriority", F.lit("|int&Order"), "o_orderstatus", F.lit("|null"))
    types = t("orders").select("o_orderkey", F.explode(N.class_types(declared)).alias("name"))
    return types.groupBy("o_orderkey").agg(F.count("*").alias("n_types"), F.min("name").alias("first_type"))


@query("SELECT p_partkey, regexp_replace(replace(lower(p_name || ' / ' || p_type), ' ', '_'), '[^\\pL\\pN_]', '', 'g') AS file_name FROM part")
def fn_safe_filename(t):
    return t("part").select("p_partkey", N.safe_filename(F.concat_ws(" / ", "p_name", "p_type")).alias("file_name"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'Item' || l_linenumber || ' ' || l_returnflag || '.' || l_linestatus || '(' || l_partkey || ', ' || l_suppkey || ')' AS signature FROM lineitem")
def fn_signature(t):
    args = F.concat_ws(", ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.signature(F.concat(F.lit("Item"), F.col("l_linenumber").cast("string")), F.col("l_returnflag"), F.col("l_linestatus"), args).alias("signature"))


# sources


@query("SELECT CASE WHEN list_contains(string_split(url, '/'), 'vendor') THEN 'vendor' ELSE 'app' END AS origin, count(*) AS files, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages GROUP BY 1")
def src_origin_stats(t):
    return t("pages").groupBy(N.origin(F.col("url")).alias("origin")).agg(F.count("*").alias("files"), F.sum(F.length("html")).alias("chars"))


@query("""WITH p AS (SELECT string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS p FROM pages), d AS (SELECT DISTINCT unnest(range(0, len(p))) AS depth, p FROM p)
SELECT DISTINCT CASE WHEN depth = 0 THEN '.' ELSE array_to_string(p[1:depth], '/') END AS dir, CASE WHEN depth = 0 THEN NULL WHEN depth = 1 THEN '.' ELSE array_to_string(p[1:depth-1], '/') END AS parent, CAST(depth AS INTEGER) AS depth FROM d""")
def src_directories(t):
    return scan.directories(t("pages").select(F.regexp_replace("url", "^[a-z]+://", "").alias("path")))


@query("SELECT page_id, list_has_any(string_split(url, '/')[:-2], ['build', 'dist']) OR len(list_filter(string_split(url, '/')[:-2], lambda x: starts_with(x, '.'))) > 0 AS skipped FROM pages")
def src_skipped(t):
    return t("pages").select("page_id", N.is_skipped(F.col("url"), ["build", "dist"]).alias("skipped"))


@query("""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target FROM pages) SELECT page_id, target, count(*) AS n FROM l GROUP BY 1, 2""")
def ext_links(t):
    links = t("pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("target"))
    return links.groupBy("page_id", "target").agg(F.count("*").alias("n"))


# relational operators


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def dedupe_first_wins(t):
    return R.first_wins(t("events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1")
def upsert_last_wins(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return R.last_wins(rows, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey")])


@query("SELECT c_custkey, s_suppkey, n AS candidate_count FROM customer JOIN supplier ON c_nationkey = s_nationkey JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) ON k = s_nationkey WHERE n <= 5")
def fanout_capped(t):
    sites, found = t("customer").select("c_custkey", F.col("c_nationkey").alias("k")), t("supplier").select("s_suppkey", F.col("s_nationkey").alias("k"))
    return R.fan_out(sites, found, "k", 5).drop("k")


@query("SELECT CASE WHEN n IS NULL THEN 'no_candidates' WHEN n > 5 THEN 'fanout_capped' ELSE 'heuristic' END AS outcome, count(*) AS n FROM customer LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 0 GROUP BY 1) s ON k = c_nationkey GROUP BY 1")
def fanout_outcome_stats(t):
    found = t("supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("k"))
    return R.fan_out_outcomes(t("customer").select(F.col("c_nationkey").alias("k")), found, "k", 5)


@query("SELECT CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN CASE WHEN o_totalprice > 200000 THEN 'ambiguous' ELSE 'external' END ELSE 'unresolved' END AS outcome, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def status_router_stats(t):
    status = F.col("o_orderstatus")
    outcome = F.when(status == "F", "resolved").when(status == "O", F.when(F.col("o_totalprice") > 200000, "ambiguous").otherwise("external")).otherwise("unresolved")
    return t("orders").groupBy(outcome.alias("outcome"), "o_orderpriority").agg(F.count("*").alias("n"))


_OWNERS = """WITH registry AS (SELECT DISTINCT p_name AS name, p_brand AS owner FROM part WHERE p_size <= 10), refs AS (SELECT DISTINCT p_name AS name, p_type AS kind, p_brand AS source FROM part),
o AS (SELECT name, list_sort(list(owner)) AS owners FROM registry GROUP BY name),
c AS (SELECT refs.*, CASE WHEN owners IS NULL THEN 'unowned' WHEN list_contains(owners, source) THEN 'local_definition' WHEN len(owners) > 1 THEN 'ambiguous' ELSE 'owned' END AS status, owners FROM refs LEFT JOIN o USING (name))"""


def _owners(t):
    registry = t("part").where("p_size <= 10").select(F.col("p_name").alias("name"), F.col("p_brand").alias("owner")).distinct()
    refs = t("part").select(F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_brand").alias("source")).distinct()
    return R.classify_owners(refs, registry)


@query(_OWNERS + " SELECT name, kind, source, status, CASE WHEN status = 'owned' THEN owners[1] END AS owner FROM c")
def owner_classifier(t):
    return _owners(t)


@query(_OWNERS + " SELECT status, count(*) AS n, count(DISTINCT name) AS names FROM c GROUP BY status")
def owner_report(t):
    return _owners(t).groupBy("status").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"))


@query("""WITH u AS (SELECT split_part(p_type, ' ', 1) AS prefix, count(*) AS n FROM part WHERE p_size > 40 GROUP BY 1) SELECT prefix, n FROM u ORDER BY n DESC, prefix LIMIT 10""")
def unowned_prefix_topk(t):
    counts = t("part").where("p_size > 40").groupBy(F.substring_index("p_type", " ", 1).alias("prefix")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "prefix").limit(10)


@query("""WITH r AS (SELECT c_nationkey AS s, s_nationkey AS d, CASE WHEN l_returnflag = 'R' THEN 'calls' WHEN l_returnflag = 'A' THEN 'di' ELSE 'refs' END AS kind FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT s AS source, d AS target, count(*) FILTER (WHERE kind = 'refs') AS refs, count(*) FILTER (WHERE kind = 'calls') AS calls, count(*) FILTER (WHERE kind = 'di') AS di FROM r WHERE s <> d GROUP BY 1, 2""")
def coupling_matrix(t):
    kind = F.when(F.col("l_returnflag") == "R", "calls").when(F.col("l_returnflag") == "A", "di").otherwise("refs")
    refs = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    refs = refs.select(F.col("c_nationkey").alias("source"), F.col("s_nationkey").alias("target"), kind.alias("kind"))
    return R.coupling(refs, "source", "target", "kind", ["refs", "calls", "di"])


@query("SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem) WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') OR NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 1)")
def orphan_check(t):
    ends = [("l_orderkey", t("orders").where("o_orderstatus <> 'P'"), "o_orderkey"), ("l_partkey", t("part").where("p_size > 1"), "p_partkey")]
    return R.orphans(t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber"), ["l_orderkey", "l_partkey", "l_linenumber"], ends)


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(" UNION ALL ".join(f"SELECT '{x}' AS table_name, count(*) AS n FROM {x}" for x in _TABLES))
def table_counts(t):
    return R.table_counts({x: t(x) for x in _TABLES})


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def nodes_by_repo(t):
    return t("documents").groupBy("source", "lang").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT o_custkey AS k, o_orderkey, epoch(o_orderdate)::BIGINT // 86400 AS day FROM orders), p AS (SELECT event_id, user_id AS k, (epoch(ts)::BIGINT // 86400) % 3000 + 8000 AS day FROM events)
SELECT event_id, max_by(o_orderkey, (s.day, o_orderkey)) AS o_orderkey FROM p JOIN s ON p.k = s.k AND s.day <= p.day AND p.day <= s.day + 400 GROUP BY event_id""")
def span_lookup(t):
    day = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / 86400)
    spans = t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey", day("o_orderdate").alias("start"), (day("o_orderdate") + 400).alias("end"))
    points = t("events").select("event_id", F.col("user_id").alias("k"), (day("ts") % 3000 + 8000).alias("day"))
    return R.innermost_span(points, spans, "k", "day", "start", "end", ["o_orderkey"], 200).select("event_id", "o_orderkey")


@query("SELECT p.event_id, p.user_id, (SELECT max_by(v.event_id, (v.ts, v.event_id)) FROM events v WHERE v.user_id = p.user_id AND v.event_type = 'view' AND v.ts <= p.ts) AS last_view FROM events p WHERE p.event_type = 'purchase'")
def asof_assignment(t):
    e = t("events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("last_view"))
    return R.as_of(left, right, "user_id", "ts", "last_view").drop("ts")


@query("""WITH i AS (SELECT DISTINCT p_brand || '/' || p_name AS name FROM part WHERE p_size < 20 UNION SELECT DISTINCT p_name FROM part WHERE p_size > 45)
SELECT p_partkey, CASE WHEN p_brand || '/' || p_name IN (SELECT name FROM i) THEN p_brand || '/' || p_name WHEN p_name IN (SELECT name FROM i) THEN p_name END AS resolved FROM part""")
def ordered_probe(t):
    p = t("part")
    local = F.concat_ws("/", "p_brand", "p_name")
    index = p.where("p_size < 20").select(local.alias("name")).union(p.where("p_size > 45").select("p_name")).distinct()
    return R.ordered_probe(p.select("p_partkey", local.alias("a"), F.col("p_name").alias("b")), "p_partkey", [F.col("a"), F.col("b")], index, "name").select("p_partkey", "resolved")


@query("SELECT concat_ws('/', p_name, CAST(p_size AS VARCHAR)) AS sized, min(p_brand) AS p_brand FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) = 1")
def unique_forward(t):
    return R.unique_forward(t("part").select(F.concat_ws("/", "p_name", F.col("p_size").cast("string")).alias("sized"), "p_brand"), "sized", "p_brand")


@query("SELECT p_name, min(p_brand) AS p_brand FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) = 1")
def unique_forward_all(t):
    return R.unique_forward(t("part").select("p_name", "p_brand"), "p_name", "p_brand")


@query("SELECT p_partkey, p_name FROM part WHERE (p_brand, p_name) IN (SELECT p_brand, p_name FROM part GROUP BY 1, 2 HAVING count(*) = 1)")
def topic_membership_unique(t):
    p = t("part").select("p_partkey", "p_brand", "p_name")
    once = p.groupBy("p_brand", "p_name").agg(F.count("*").alias("n")).where("n = 1").drop("n")
    return p.join(once, ["p_brand", "p_name"]).select("p_partkey", "p_name")


@query("SELECT source, lang, CAST(sum(least(length(text), 300)) AS BIGINT) AS chars FROM documents GROUP BY ROLLUP (source, lang)")
def dir_rollup_bottom_up(t):
    docs = t("documents").select("source", "lang", F.least(F.length("text"), F.lit(300)).alias("n"))
    return R.roll_up(docs, ["source", "lang"], F.col("n"), "chars")


@query("""SELECT user_id, last_type AS state, n_ops, CAST(n_drops AS BIGINT) AS n_drops FROM (SELECT user_id, max_by(event_type, (ts, event_id)) AS last_type, count(*) AS n_ops, count(*) FILTER (WHERE event_type = 'error') AS n_drops FROM events GROUP BY user_id)""")
def mig_replay_last_state(t):
    ops = t("events").groupBy("user_id")
    return ops.agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.count("*").alias("n_ops"), F.sum((F.col("event_type") == "error").cast("long")).alias("n_drops"))


@query("""WITH RECURSIVE c AS (SELECT doc_id, text, 0 AS chunk, 1 AS start FROM documents WHERE length(text) > 0 UNION ALL SELECT doc_id, text, chunk + 1, start + 1000 FROM c WHERE start + 1000 <= length(text))
SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(length(substring(text, start, 1000)) AS INTEGER) AS chars, sha256(substring(text, start, 1000)) AS sha FROM c""")
def chunk_text(t):
    n = F.ceil(F.length("text") / 1000).cast("int")
    cut = t("documents").where(F.length("text") > 0).select("doc_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    part = F.substring(F.col("text"), F.col("chunk") * 1000 + 1, F.lit(1000))
    return cut.select("doc_id", "chunk", F.length(part).alias("chars"), F.sha2(part, 256).alias("sha"))


@query("SELECT d.doc_id, substring(d.source || ' (' || coalesce(d.lang, '') || '): ' || substring(text, 1, 500), 1, 2000) AS text, v.vec_id IS NOT NULL AS embedded FROM documents d LEFT JOIN embeddings v ON v.vec_id = d.doc_id WHERE length(text) > 0")
def emb_text_compose(t):
    text = F.substring(F.concat("source", F.lit(" ("), F.coalesce("lang", F.lit("")), F.lit("): "), F.substring("text", 1, 500)), 1, 2000)
    docs = t("documents").where(F.length("text") > 0).join(t("embeddings").select("vec_id"), F.col("doc_id") == F.col("vec_id"), "left")
    return docs.select("doc_id", text.alias("text"), F.col("vec_id").isNotNull().alias("embedded"))


@query("SELECT o_orderkey, coalesce(n.p, o_orderpriority) AS o_orderpriority FROM orders LEFT JOIN (SELECT l_orderkey, max(l_returnflag) AS p FROM lineitem WHERE l_quantity > 49 GROUP BY 1) n ON l_orderkey = o_orderkey")
def partial_update(t):
    new = t("lineitem").where("l_quantity > 49").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_returnflag").alias("o_orderpriority"))
    return store.update_column(t("orders").select("o_orderkey", "o_orderpriority"), new, "o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, c_name, 'old' AS version FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT o_custkey, 'Customer ' || o_custkey, 'new' FROM (SELECT DISTINCT o_custkey FROM orders)")
def upsert_merge(t):
    new = t("orders").select(F.col("o_custkey").alias("c_custkey")).distinct().select("c_custkey", F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("c_name"), F.lit("new").alias("version"))
    return store.upsert(t("customer").select("c_custkey", "c_name", F.lit("old").alias("version")), new, ["c_custkey"])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(t):
    return store.pending(t("documents").select("doc_id", "source"), t("labels"), ["doc_id"])


# graph patterns


def star(t) -> graph.PropertyGraph:
    """The star schema as a property graph."""
    nodes = {
        "Region": t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "Nation": t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")),
        "Customer": t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")),
        "Supplier": t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")),
        "Order": t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("customer")),
        "Part": t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")),
    }
    e = graph.Edge
    edges = {
        "InRegion": e(t("nation").select(F.col("n_nationkey").alias("src"), F.col("n_regionkey").alias("dst")), "Nation", "Region", "region"),
        "CustomerIn": e(t("customer").select(F.col("c_custkey").alias("src"), F.col("c_nationkey").alias("dst")), "Customer", "Nation", "nation"),
        "SupplierIn": e(t("supplier").select(F.col("s_suppkey").alias("src"), F.col("s_nationkey").alias("dst")), "Supplier", "Nation", "nation"),
        "PlacedBy": e(t("orders").select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst")), "Order", "Customer", "customer"),
        "HasPart": e(t("lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("flag")), "Order", "Part"),
    }
    return graph.PropertyGraph(nodes, edges)


@query("SELECT n_name AS nation, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def gql_one_hop(t):
    return star(t).match("Nation", "n").hop("n", "InRegion", "r").rows.select(F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query("SELECT c_custkey AS customer FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey = 7")
def gql_reverse(t):
    return star(t).match("Nation", "n", F.col("id") == 7).hop("n", "CustomerIn", "c", reverse=True).rows.select(F.col("c_id").alias("customer"))


@query("SELECT o_orderkey AS order_id, c_name AS customer, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def gql_multi_hop(t):
    m = star(t).match("Order", "o").hop("o", "PlacedBy", "c").hop("c", "CustomerIn", "n").hop("n", "InRegion", "r")
    return m.rows.select(F.col("o_id").alias("order_id"), F.col("c_name").alias("customer"), F.col("r_name").alias("region"))


@query("SELECT o_orderkey AS order_id, p_name AS part, l_returnflag AS flag FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_returnflag LIKE 'R%' AND p_size > 30")
def gql_edge_filter(t):
    m = star(t).match("Order", "o").hop("o", "HasPart", "p", "e", where=F.col("size") > 30, edge_where=F.col("flag").like("R%"))
    return m.rows.select(F.col("o_id").alias("order_id"), F.col("p_name").alias("part"), F.col("e_flag").alias("flag"))


@query("SELECT DISTINCT c_mktsegment AS segment, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def gql_distinct(t):
    m = star(t).match("Customer", "c").hop("c", "CustomerIn", "n").hop("n", "InRegion", "r")
    return m.rows.select(F.col("c_segment").alias("segment"), F.col("r_name").alias("region")).distinct()


@query("SELECT r_name AS region, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def gql_group_count(t):
    m = star(t).match("Order", "o").hop("o", "PlacedBy", "c").hop("c", "CustomerIn", "n").hop("n", "InRegion", "r")
    return m.rows.groupBy(F.col("r_name").alias("region")).agg(F.count("*").alias("orders"))


@query("SELECT c_custkey AS customer, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY orders DESC, customer LIMIT 25")
def gql_order_limit(t):
    m = star(t).match("Order", "o").hop("o", "PlacedBy", "c")
    return m.rows.groupBy(F.col("c_id").alias("customer")).agg(F.count("*").alias("orders")).orderBy(F.desc("orders"), "customer").limit(25)


_TRADE = """trade AS (SELECT src, dst FROM (SELECT c_nationkey AS src, s_nationkey AS dst, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, s_nationkey) AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) WHERE r <= 3)"""


def trade(t, every: bool = False) -> DataFrame:
    """Each nation's three largest partners by line count, ties by key; with every, all of its partners."""
    m = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    counts = m.groupBy(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).agg(F.count("*").alias("n"))
    if every:
        return graph.materialize(counts.select("src", "dst"), "trade")
    best = counts.withColumn("r", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("n"), "dst"))).where("r <= 3").select("src", "dst")
    return graph.materialize(best, "trade")


@query("WITH RECURSIVE " + _TRADE + """, w AS (SELECT src AS s, dst AS d, 1 AS depth FROM trade UNION ALL SELECT w.s, trade.dst, depth + 1 FROM w JOIN trade ON w.d = trade.src WHERE depth < 3) SELECT s AS start, d AS "end", depth, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def gql_quantified_bag(t):
    return graph.walks(trade(t), 1, 3)


@query("WITH RECURSIVE " + _TRADE + """, w AS (SELECT src AS s, dst AS d, 1 AS depth FROM trade UNION SELECT w.s, trade.dst, depth + 1 FROM w JOIN trade ON w.d = trade.src WHERE depth < 5) SELECT DISTINCT s AS start, d AS "end" FROM w""")
def gql_quantified_distinct(t):
    return graph.walks(trade(t), 1, 5, distinct=True)


@query("WITH RECURSIVE " + _TRADE + """, w AS (SELECT src AS s, dst AS d, 1 AS depth FROM trade UNION SELECT w.s, trade.dst, depth + 1 FROM w JOIN trade ON w.d = trade.src WHERE depth < 6) SELECT s AS node, min(depth) AS length FROM w WHERE s = d AND depth >= 2 GROUP BY s""")
def gql_cycle(t):
    return graph.cycles(trade(t), 2, 6)


@query("WITH RECURSIVE " + _TRADE + """, w AS (SELECT src AS s, dst AS d, 1 AS depth FROM trade UNION SELECT w.s, trade.dst, depth + 1 FROM w JOIN trade ON w.d = trade.src WHERE depth < 24) SELECT s AS start, d AS "end", min(depth) AS distance FROM w GROUP BY 1, 2""")
def hier_closure(t):
    return graph.closure(trade(t))


# The same over every partner, to the depth of GQ-08, and over the whole region-nation-customer tree.


@query(None)
def gql_quantified_bag_all(t):
    return graph.walks(trade(t, every=True), 1, 3)


@query(None)
def gql_quantified_distinct_all(t):
    return graph.walks(trade(t, every=True), 1, 5, distinct=True)


@query(None)
def gql_cycle_all(t):
    return graph.cycles(trade(t, every=True), 2, 10)


@query("""WITH e AS (SELECT 'r' || n_regionkey AS s, 'n' || n_nationkey AS d FROM nation UNION ALL SELECT DISTINCT 'n' || c_nationkey, 'c' || c_custkey FROM customer)
SELECT s AS start, d AS "end", 1 AS distance FROM e UNION ALL SELECT a.s, b.d, 2 FROM e a JOIN e b ON a.d = b.s""")
def hier_closure_all(t):
    node = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    nations = t("nation").select(node("r", "n_regionkey").alias("src"), node("n", "n_nationkey").alias("dst"))
    customers = t("customer").select(node("n", "c_nationkey").alias("src"), node("c", "c_custkey").alias("dst"))
    return graph.closure(nations.unionByName(customers))


@query("""WITH RECURSIVE w AS (SELECT conv_id, turn AS first, turn AS last, 0 AS depth FROM conversations UNION ALL SELECT w.conv_id, first, c.turn, depth + 1 FROM w JOIN conversations c ON c.conv_id = w.conv_id AND c.turn = w.last + 1 WHERE depth < 3)
SELECT conv_id, first, last, count(*) AS n FROM w WHERE depth > 0 GROUP BY 1, 2, 3""")
def gql_reply_chain(t):
    turns = t("conversations").groupBy("conv_id", "turn").agg(F.count("*").alias("c"))
    node = lambda turn: F.named_struct(F.lit("conv_id"), F.col("conv_id"), F.lit("turn"), turn)
    back = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("c").alias("m"))
    edges = turns.join(back, ["conv_id", "turn"]).select(node(F.col("turn")).alias("src"), node(F.col("turn") + 1).alias("dst"), F.col("c").alias("first_rows"), F.explode(F.array_repeat(F.lit(1), F.col("m").cast("int"))))
    found = graph.walks(edges.select("src", "dst"), 1, 3)
    first = turns.select(node(F.col("turn")).alias("start"), "c")
    return found.join(first, "start").select("start.conv_id", F.col("start.turn").alias("first"), F.col("end.turn").alias("last"), (F.col("n") * F.col("c")).alias("n"))


# checks and scores


def _nations(t) -> DataFrame:
    return t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


@query("WITH " + _TRADE + " SELECT lower(a.n_name) AS subject, array_to_string(list_sort(list(DISTINCT lower(b.n_name))), ',') AS answers FROM trade JOIN nation a ON a.n_nationkey = src JOIN nation b ON b.n_nationkey = dst GROUP BY 1")
def qa_callees(t):
    return checks.neighbours(trade(t), _nations(t)).select("subject", F.array_join("answers", ",").alias("answers"))


@query("WITH " + _TRADE + " SELECT lower(a.n_name) AS subject, array_to_string(list_sort(list(DISTINCT lower(b.n_name))), ',') AS answers FROM trade JOIN nation a ON a.n_nationkey = dst JOIN nation b ON b.n_nationkey = src GROUP BY 1")
def qa_callers(t):
    return checks.neighbours(trade(t), _nations(t), "dst").select("subject", F.array_join("answers", ",").alias("answers"))


def _match_modes(t, edges: DataFrame) -> DataFrame:
    first = t("nation").agg(F.min("n_name").alias("x"))
    modes = F.explode(F.array(*[F.lit(m) for m in ("contains_all", "exact_set", "count_at_least")]))
    asked = t("nation").select(F.col("n_nationkey").alias("question_id"), F.col("n_name").alias("subject"), modes.alias("mode")).join(first)
    asked = asked.withColumn("expected", F.when(F.col("mode") == "count_at_least", F.array(F.lit("3"))).otherwise(F.array("x"))).drop("x")
    return checks.match_modes(asked, checks.neighbours(edges, _nations(t))).select("question_id", "mode", "passed")


@query("WITH " + _TRADE + """, a AS (SELECT src, list(DISTINCT lower(n_name)) AS got FROM trade JOIN nation ON n_nationkey = dst GROUP BY 1),
q AS (SELECT n_nationkey, m.mode, CASE m.mode WHEN 'count_at_least' THEN ['3'] ELSE [lower(r.x)] END AS expected FROM nation, (VALUES ('contains_all'), ('exact_set'), ('count_at_least')) m(mode), (SELECT min(n_name) AS x FROM nation) r)
SELECT n_nationkey AS question_id, mode, coalesce(CASE mode WHEN 'contains_all' THEN list_has_all(got, expected) WHEN 'exact_set' THEN list_sort(got) = expected ELSE len(got) >= 3 END, false) AS passed FROM q LEFT JOIN a ON src = n_nationkey""")
def qa_match_modes(t):
    return _match_modes(t, trade(t))


@query(None)
def qa_callees_all(t):
    return checks.neighbours(trade(t, every=True), _nations(t)).select("subject", F.array_join("answers", ",").alias("answers"))


@query(None)
def qa_callers_all(t):
    return checks.neighbours(trade(t, every=True), _nations(t), "dst").select("subject", F.array_join("answers", ",").alias("answers"))


@query(None)
def qa_match_modes_all(t):
    return _match_modes(t, trade(t, every=True))


@query("SELECT source AS category, count(*) AS cases, CAST(sum(CASE WHEN quality = CASE WHEN length(text) > 1500 THEN 1 ELSE 0 END THEN 1 ELSE 0 END) AS BIGINT) AS correct, round(sum(CASE WHEN quality = CASE WHEN length(text) > 1500 THEN 1 ELSE 0 END THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS percent FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def ev_scores_by_category(t):
    right = F.col("quality") == (F.length("text") > 1500).cast("int")
    cases = t("documents").join(t("labels"), "doc_id").select(F.col("source").alias("category"), right.alias("right"))
    return checks.scores(cases, "category", "right")
