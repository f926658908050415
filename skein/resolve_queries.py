"""Queries of name and member resolution, conventions and topics, bound to the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.cross_queries import _B, _once
from skein.cross_queries import frame as _cross
from skein.functions import conventions as C
from skein.functions import names as N
from skein.graph_queries import BIND, ORACLE, _sql, frame
from skein.operators import relational as R
from skein.plans import crossref as X
from skein.plans import resolve, topics
from skein.queries import query

_N = "(SELECT COUNT(*) FROM {supplier})"
BIND |= {
    "parentage": f"""SELECT k.repo, k.fqcn, 0 AS pos, CASE k.ord % 5 WHEN 0 THEN 'implements' WHEN 1 THEN 'uses' ELSE 'extends' END AS relation, p.fqcn AS parent FROM classes k JOIN classes p ON p.ord = k.ord - {_N} WHERE k.fqcn <> '' AND p.fqcn <> ''
      UNION ALL SELECT k.repo, k.fqcn, 1, 'uses', p.fqcn FROM classes k JOIN classes p ON p.ord = k.ord - 2 * {_N} WHERE k.fqcn <> '' AND p.fqcn <> '' AND k.ord % 4 = 0""",
    "owned": "SELECT repo, fqcn, name, member_kind, return_type FROM members WHERE fqcn <> '' UNION ALL SELECT repo, fqcn, CASE WHEN ord % 2 = 0 THEN '__callStatic' ELSE '__call' END, 'method', '' FROM classes WHERE fqcn <> '' AND ord % 37 = 1",
    "mixins": f"SELECT k.repo, k.fqcn, 0 AS pos, p.fqcn AS behavior FROM classes k JOIN classes p ON p.ord = k.ord - 3 * {_N} WHERE k.fqcn <> '' AND p.fqcn <> '' AND k.ord % 13 = 5",
    "wanted": "SELECT repo, fqcn, 'Run' || CAST(ord % 7 + 1 AS STRING) AS member, ord % 2 = 0 AS static FROM classes WHERE fqcn <> ''",
    "faced": f"SELECT k.repo, CAST(k.ord AS STRING) AS site_id, k.fqcn, 'run' || CAST(k.ord % 7 + 1 AS STRING) AS member, p.fqcn AS concrete FROM classes k JOIN classes p ON p.ord = k.ord - {_N} WHERE k.fqcn <> '' AND p.fqcn <> ''",
}
ORACLE |= {
    "ups": "SELECT DISTINCT repo, lower(fqcn) AS c, lower(parent) AS p, pos FROM parentage WHERE relation IN ('extends', 'uses')",
    "paths": "SELECT repo, lower(fqcn) AS fqcn, lower(fqcn) AS ancestor, 0 AS depth, CAST([] AS INTEGER[]) AS trail FROM (SELECT DISTINCT repo, fqcn FROM classes WHERE fqcn <> '') UNION ALL SELECT a.repo, a.fqcn, u.p, a.depth + 1, list_append(a.trail, u.pos) FROM paths a JOIN ups u ON u.repo = a.repo AND u.c = a.ancestor WHERE a.depth < 39",
    "ranks": "SELECT * FROM paths QUALIFY row_number() OVER (PARTITION BY repo, fqcn, ancestor ORDER BY depth, trail) = 1",
    "has": "SELECT DISTINCT repo, lower(fqcn) AS ancestor, lower(name) AS m FROM owned WHERE member_kind IN ('method', 'function')",
    "below": "SELECT w.repo, w.fqcn, w.member, count(DISTINCT r.fqcn) AS overrides FROM (SELECT DISTINCT repo, fqcn, member FROM wanted) w JOIN ranks r ON r.repo = w.repo AND r.ancestor = lower(w.fqcn) AND r.depth > 0 JOIN has h ON h.repo = r.repo AND h.ancestor = r.fqcn AND h.m = lower(w.member) GROUP BY 1, 2, 3",
}


def _rsql(body: str) -> str:
    """SQL whose CTEs may be recursive."""
    return _sql(body).replace("WITH ", "WITH RECURSIVE ", 1)


def _lines(t) -> DataFrame:
    return resolve.lineage(frame(t, "parentage"), frame(t, "classes").where("fqcn <> ''"))


@query(_rsql("SELECT repo, fqcn, ancestor, depth, array_to_string(trail, '.') AS trail FROM ranks"))
def res_lineage(t):
    return _lines(t).withColumn("trail", F.concat_ws(".", "trail"))


@query(_sql("SELECT DISTINCT repo, parent, fqcn AS child FROM parentage WHERE relation = 'extends'"))
def res_children(t):
    return resolve.children(frame(t, "parentage"))


@query(_rsql("""SELECT w.repo, w.fqcn, w.member, w.static, b.owner, b.rule FROM wanted w LEFT JOIN (SELECT repo, c, m, magic, owner, rule FROM (
  SELECT q.repo, q.c, q.m, q.magic, 0 AS rk, r.depth, r.trail, r.ancestor AS owner, 'chain' AS rule FROM (SELECT DISTINCT repo, lower(fqcn) AS c, lower(member) AS m, CASE WHEN static THEN '__callstatic' ELSE '__call' END AS magic FROM wanted) q JOIN ranks r ON r.repo = q.repo AND r.fqcn = q.c JOIN has h ON h.repo = r.repo AND h.ancestor = r.ancestor AND h.m = q.m
  UNION ALL SELECT q.repo, q.c, q.m, q.magic, 2, r.depth, r.trail, r.ancestor, 'magic_call' FROM (SELECT DISTINCT repo, lower(fqcn) AS c, lower(member) AS m, CASE WHEN static THEN '__callstatic' ELSE '__call' END AS magic FROM wanted) q JOIN ranks r ON r.repo = q.repo AND r.fqcn = q.c JOIN has h ON h.repo = r.repo AND h.ancestor = r.ancestor AND h.m = q.magic
  UNION ALL SELECT q.repo, q.c, q.m, q.magic, 1, r.depth, list_concat(r.trail, [x.pos, d.depth], d.trail), d.ancestor, 'behavior' FROM (SELECT DISTINCT repo, lower(fqcn) AS c, lower(member) AS m, CASE WHEN static THEN '__callstatic' ELSE '__call' END AS magic FROM wanted) q JOIN ranks r ON r.repo = q.repo AND r.fqcn = q.c
    JOIN mixins x ON x.repo = r.repo AND lower(x.fqcn) = r.ancestor JOIN ranks d ON d.repo = r.repo AND d.fqcn = lower(x.behavior) JOIN has h ON h.repo = d.repo AND h.ancestor = d.ancestor AND h.m = q.m)
QUALIFY row_number() OVER (PARTITION BY repo, c, m, magic ORDER BY rk, depth, trail, owner) = 1) b ON b.repo = w.repo AND b.c = lower(w.fqcn) AND b.m = lower(w.member) AND b.magic = CASE WHEN w.static THEN '__callstatic' ELSE '__call' END"""))
def res_member_walk(t):
    return resolve.walk_members(frame(t, "wanted"), _lines(t), frame(t, "owned"), frame(t, "mixins"))


@query(_rsql("SELECT w.repo, w.fqcn, w.member, w.static, coalesce(b.overrides, 0) AS overrides, CASE WHEN b.overrides > 0 THEN 'ambiguous' ELSE 'resolved' END AS status FROM wanted w LEFT JOIN below b ON b.repo = w.repo AND b.fqcn = w.fqcn AND b.member = w.member"))
def res_late_binding(t):
    return resolve.late_binding(frame(t, "wanted"), _lines(t), frame(t, "owned"))


@query(_rsql("""SELECT w.repo, w.fqcn, w.member AS prop, b.ancestor AS declared_in FROM wanted w LEFT JOIN (SELECT r.* , p.m FROM ranks r JOIN (SELECT DISTINCT repo, lower(fqcn) AS a, lower(name) AS m FROM owned WHERE member_kind = 'property') p ON p.repo = r.repo AND p.a = r.ancestor
QUALIFY row_number() OVER (PARTITION BY r.repo, r.fqcn, p.m ORDER BY r.depth, r.trail) = 1) b ON b.repo = w.repo AND b.fqcn = lower(w.fqcn) AND b.m = lower(w.member)"""))
def res_property_chain(t):
    return resolve.property_on_chain(frame(t, "wanted").select("repo", "fqcn", F.col("member").alias("prop")), _lines(t), frame(t, "owned"))


@query(_rsql("""SELECT f.repo, f.site_id, f.fqcn, f.member, f.concrete, CASE WHEN EXISTS (SELECT 1 FROM classes k WHERE k.repo = f.repo AND lower(k.fqcn) = lower(f.fqcn) AND k.kind = 'interface') AND EXISTS (SELECT 1 FROM ranks r JOIN (SELECT DISTINCT repo, lower(fqcn) AS a, lower(name) AS m FROM owned WHERE member_kind = 'method') p ON p.repo = r.repo AND p.a = r.ancestor
WHERE r.repo = f.repo AND r.fqcn = lower(f.concrete) AND p.m = lower(f.member)) THEN f.concrete ELSE f.fqcn END AS target FROM faced f"""))
def res_interface(t):
    return resolve.concrete_for_interface(frame(t, "faced"), frame(t, "classes"), _lines(t), frame(t, "owned"))


@query(_sql("""SELECT f.repo, f.site_id, f.member AS name, s.candidate FROM faced f LEFT JOIN (SELECT DISTINCT repo, lower(name) AS m, fqcn || '::' || name AS candidate FROM owned WHERE member_kind IN ('method', 'function') QUALIFY count(*) OVER (PARTITION BY repo, lower(name)) <= 5) s ON s.repo = f.repo AND s.m = lower(f.member)"""))
def res_dynamic(t):
    return resolve.mark_dynamic(frame(t, "faced").select("repo", "site_id", F.col("member").alias("name")), frame(t, "owned"))


@query(_sql("SELECT repo, path, alias, fqcn FROM alias_ix"))
def res_aliases(t):
    return X.alias_map(_cross(t, "uses"))


@query(_sql(f"""SELECT r.repo, r.path, r.own, r.text, strict, CASE WHEN starts_with(text, {_B}) OR a.fqcn IS NOT NULL OR starts_with(text, 'namespace' || {_B}) THEN strict ELSE strict || ' ' || text END AS candidates, count(*) AS n FROM (SELECT r.*, CASE WHEN starts_with(text, {_B}) THEN ltrim(text, {_B}) WHEN starts_with(text, 'namespace' || {_B}) THEN namespace || substring(text, 10) WHEN x.fqcn IS NOT NULL THEN x.fqcn || CASE WHEN contains(text, {_B}) THEN substring(text, strpos(text, {_B})) ELSE '' END ELSE namespace || {_B} || text END AS strict
  FROM refs r LEFT JOIN alias_ix x ON x.repo = r.repo AND x.path = r.path AND x.alias = lower(split_part(r.text, {_B}, 1)) WHERE kind <> 'type') r LEFT JOIN alias_ix a ON a.repo = r.repo AND a.path = r.path AND a.alias = lower(split_part(r.text, {_B}, 1)) GROUP BY ALL"""))
def res_candidates(t):
    once = _once(t)
    rows = X.candidate_names(once(t, "refs").where("kind <> 'type'"), once(t, "uses"))
    return rows.groupBy("repo", "path", "own", "text", "strict", F.concat_ws(" ", "candidates").alias("candidates")).agg(F.count("*").alias("n"))


_TYPES = "CASE p_partkey % 6 WHEN 0 THEN '?string' WHEN 1 THEN 'self' WHEN 2 THEN '?App\\Core\\' || p_brand WHEN 3 THEN 'int|Foo' WHEN 4 THEN '$this' ELSE '' END"


@query(f"SELECT p_partkey, CASE p_partkey % 6 WHEN 1 THEN 'Owner' || p_size WHEN 4 THEN 'Owner' || p_size WHEN 2 THEN 'App\\Core\\' || p_brand WHEN 3 THEN 'Foo' END AS class FROM part")
def res_return_class(t):
    k = F.col("p_partkey") % 6
    declared = F.when(k == 0, "?string").when(k == 1, "self").when(k == 2, F.concat(F.lit("?App\\Core\\"), "p_brand")).when(k == 3, "int|Foo").when(k == 4, "$this").otherwise("")
    return t("part").select("p_partkey", resolve.return_class(declared, F.concat(F.lit("Owner"), F.col("p_size").cast("string"))).alias("class"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Root' || p_size || '\\Model\\Entity\\' || p_type || 'Item' END AS entity FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 2 = 1""")
def res_entity_call(t):
    table = F.concat(F.lit("Root"), F.col("p_size").cast("string"), F.lit("\\Model\\"), F.when(F.col("p_size") % 3 == 0, "Table").otherwise("View"), F.lit("\\"), "p_type", F.lit("ItemsTable"))
    method = F.when(F.col("p_partkey") % 2 == 0, "firstOrFail").otherwise("find")
    return t("part").select("p_partkey", resolve.entity_of_call(table, method).alias("entity"))


_FUNCTIONS = "SELECT DISTINCT CASE WHEN p_size < 20 THEN 'app' || chr(92) || replace(p_name, ' ', '_') ELSE replace(p_name, ' ', '_') END AS name FROM part WHERE p_partkey % 3 = 0"


@query(f"""WITH f AS ({_FUNCTIONS}), q AS (SELECT p_partkey, replace(p_name, ' ', '_') AS x, p_partkey % 5 = 0 AS aliased FROM part)
SELECT p_partkey, CASE WHEN aliased THEN CASE WHEN 'app' || chr(92) || x IN (SELECT name FROM f) THEN 'app' || chr(92) || x END WHEN 'app' || chr(92) || x IN (SELECT name FROM f) THEN 'app' || chr(92) || x WHEN x IN (SELECT name FROM f) THEN x END AS resolved FROM q""")
def res_function(t):
    p = t("part").withColumn("x", F.regexp_replace("p_name", " ", "_"))
    index = p.where("p_partkey % 3 = 0").select(F.when(F.col("p_size") < 20, F.concat(F.lit("app\\"), "x")).otherwise(F.col("x")).alias("name")).distinct()
    names = resolve.function_candidates(F.col("x"), F.lit("app"), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("app\\"), "x")))
    return R.ordered_probe(p.select("p_partkey", names.alias("names")), "p_partkey", [F.try_element_at("names", F.lit(i)) for i in (1, 2)], index, "name").select("p_partkey", "resolved")


# conventions


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 6 OR p_partkey % 4 = 3 THEN '' ELSE CASE p_partkey % 4 WHEN 1 THEN 'Bill\\' || s || '\\Audits' || x WHEN 2 THEN 'Cake\\' || c || '\\Name' || x ELSE CASE WHEN p_size % 3 = 0 THEN 'Acme\\' || s || '\\U' || p_type || x || ' ' ELSE '' END || 'App\\' || s || '\\U' || p_type || x || ' Cake\\' || c || '\\U' || p_type || x END END AS names
FROM (SELECT *, CASE p_partkey % 7 WHEN 0 THEN 'Model\\Table' WHEN 1 THEN 'Model\\Table' WHEN 2 THEN 'Model\\Behavior' WHEN 3 THEN 'Controller\\Component' ELSE 'View\\Helper' END AS s, CASE p_partkey % 7 WHEN 0 THEN 'Model\\Table' WHEN 1 THEN 'Model\\Table' WHEN 2 THEN 'ORM\\Behavior' WHEN 3 THEN 'Controller\\Component' ELSE 'View\\Helper' END AS c, CASE p_partkey % 7 WHEN 0 THEN 'Table' WHEN 1 THEN 'Table' WHEN 2 THEN 'Behavior' WHEN 3 THEN 'Component' ELSE 'Helper' END AS x FROM part)""")
def fn_loader_candidates(t):
    k = F.col("p_partkey")
    method = F.element_at(F.array(*[F.lit(x) for x in ("fetchTable", "loadModel", "addBehavior", "loadComponent", "loadHelper", "addHelper", "other")]), (k % 7).cast("int") + 1)
    argument = F.when(k % 4 == 1, "Bill.Audits").when(k % 4 == 2, "Cake.Name").when(k % 4 == 3, "1bad").otherwise(F.concat(F.lit("U"), "p_type"))
    root = F.when(F.col("p_size") % 3 == 0, "Acme").when(F.col("p_size") % 3 == 1, "App")
    return t("part").select("p_partkey", F.concat_ws(" ", C.loader_candidates(method, argument, root)).alias("names"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'App\\Model\\Table\\' || p_type || 'Table Cake\\Model\\Table\\' || p_type || 'Table' ELSE '' END AS names FROM part""")
def fn_locator_candidates(t):
    receiver = F.when(F.col("p_size") % 2 == 0, "$this->gettablelocator()").otherwise("$x")
    return t("part").select("p_partkey", F.concat_ws(" ", C.locator_candidates(receiver, F.col("p_type"), F.lit("App"))).alias("names"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'R\\Model\\Entity\\' || p_type || 'Story' WHEN p_size % 3 = 1 THEN 'R\\Model\\Entity\\' || p_type || 'Box' END AS entity, CASE WHEN p_size % 4 = 0 THEN 'R\\Model\\Table\\' || p_type || 'Table' END AS default_table FROM part")
def fn_table_classes(t):
    k = F.col("p_size")
    table = F.concat(F.lit("R\\Model\\Table\\"), "p_type", F.when(k % 3 == 0, "StoriesTable").when(k % 3 == 1, "BoxesTable").otherwise("Stories"))
    controller = F.when(k % 4 == 0, F.concat(F.lit("R\\Controller\\Admin\\"), "p_type", F.lit("Controller"))).when(k % 4 == 1, "R\\Controller\\AppController").otherwise("R\\Service\\Thing")
    return t("part").select("p_partkey", C.entity_class(table).alias("entity"), C.default_table(controller).alias("default_table"))


@query("""SELECT p_partkey, '    ' || regexp_replace(trim(p_name), '[^0-9A-Za-z_]', '_', 'g') || ' ' || CASE p_size % 5 WHEN 0 THEN '}o--o{' WHEN 1 THEN '}o--||' WHEN 2 THEN '||--||' ELSE '||--o{' END || ' ' || regexp_replace(p_brand, '[^0-9A-Za-z_]', '_', 'g') || ' : "' || CASE WHEN p_size % 2 = 0 THEN substring(trim(p_type || ' of ' || p_name || ' and more'), 1, 24) ELSE 'rel' END || '"' AS line, trim(regexp_replace(p_name, 'e', ' ', 'g')) AS cell FROM part""")
def fn_er_relation(t):
    k = F.col("p_size")
    card = F.when(k % 5 == 0, "Many-to-Many").when(k % 5 == 1, "n-1").when(k % 5 == 2, "one-to-one").when(k % 5 == 3, "1-n")
    via = F.when(k % 2 == 0, F.concat("p_type", F.lit(" of "), "p_name", F.lit(" and more")))
    cell = C.markdown_cell(F.regexp_replace("p_name", "e", "|"))
    return t("part").select("p_partkey", C.er_relation(F.col("p_name"), F.col("p_brand"), card, via).alias("line"), cell.alias("cell"))


@query("SELECT doc_id, substring(text, 1, 500) AS cell FROM documents ORDER BY doc_id LIMIT 50")
def fn_result_cap(t):
    return t("documents").select("doc_id", C.result_cell(F.col("text")).alias("cell")).orderBy("doc_id").limit(50)


# topics, roll-ups and texts to embed


@query("""SELECT source AS top, CAST(sum(least(length(text), 300)) AS BIGINT) AS chars, count(*) AS files FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def doc_topic_inputs(t):
    return topics.topic_inputs(t("documents").select(F.concat_ws("/", "source", "lang", F.concat("doc_id", F.lit(".php"))).alias("path"), F.col("text").alias("summary")))


@query("""SELECT o_custkey AS topic, CAST(sum(least(length(text), 15000)) AS BIGINT) AS chars, count(*) AS files FROM (SELECT DISTINCT o_custkey, doc_id, text FROM orders JOIN documents ON doc_id = o_orderkey % 400 WHERE text IS NOT NULL) GROUP BY 1""")
def doc_topic_texts(t):
    linked = t("orders").select(F.col("o_custkey").alias("topic"), (F.col("o_orderkey") % 400).alias("path"))
    return topics.topic_texts(linked, t("documents").select(F.col("doc_id").alias("path"), "text"))


@query("SELECT 'T' || n_name AS name, 'nation' AS linked FROM nation UNION ALL SELECT 'Database schema', 'schema' WHERE NOT EXISTS (SELECT 1 FROM nation WHERE 'T' || n_name = 'Database schema')")
def doc_schema_topic(t):
    own = t("nation").select(F.concat(F.lit("T"), "n_name").alias("name"), F.lit("nation").alias("linked"))
    return topics.with_topic(own, "Database schema", "schema")


@query("""SELECT dir, depth, CAST(sum(least(length(s), 1500)) AS BIGINT) AS chars, count(*) AS files FROM (SELECT unnest([source, source || '/' || coalesce(lang, '-')]) AS dir, unnest([1, 2]) AS depth, text AS s FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2""")
def doc_directory_inputs(t):
    files = t("documents").where("text IS NOT NULL").select(F.concat_ws("/", "source", F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string")).alias("path"), F.col("text").alias("summary"))
    return topics.directory_inputs(files)


@query(_sql("""SELECT c.fqcn, substring(c.name || ' (' || c.kind || '): methods=' || coalesce(m.names, '') || '. ' || substring(coalesce(c.fqcn, '') || ': ' || c.kind, 1, 500), 1, 2000) AS text FROM classes c LEFT JOIN (SELECT repo, path, fqcn, array_to_string(list(name ORDER BY ord), ', ') AS names FROM members WHERE member_kind = 'method' GROUP BY 1, 2, 3) m ON m.repo = c.repo AND m.path = c.path AND m.fqcn = c.fqcn WHERE c.fqcn <> '' AND NOT list_contains(string_split(c.path, '/'), 'vendor')"""))
def emb_class_texts(t):
    return topics.class_texts(frame(t, "classes").where("fqcn <> ''"), frame(t, "members")).select("fqcn", "text")


@query(None)  # hashed features have no SQL form: tests compare them with a plain computation
def emb_batches(t):
    return topics.embedded(t("documents").select(F.col("doc_id").alias("id"), "text"))


@query("SELECT source || '/' || coalesce(lang, '') || '/' || doc_id || '.php' AS path, contains(source || '/' || coalesce(lang, '') || '/' || doc_id || '.php', 'de/') OR contains(substring(coalesce(text, ''), 1, 4000), 'und ') AS is_migration FROM documents")
def src_migration_files(t):
    from skein.sources import scan

    path = F.concat("source", F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".php"))
    return t("documents").select(path.alias("path"), scan.is_migration(path, F.col("text"), ["de/"], "und ").alias("is_migration"))


# sources whose rows reach every branch


@query(_sql("SELECT CASE WHEN list_contains(string_split(path, '/'), 'vendor') THEN 'vendor' ELSE 'app' END AS origin, count(*) AS files, CAST(sum(octet_length(encode(summary))) AS BIGINT) AS bytes FROM files GROUP BY 1"))
def src_vendor_stats(t):
    return frame(t, "files").groupBy(N.origin(F.col("path")).alias("origin")).agg(F.count("*").alias("files"), F.sum(F.octet_length("summary").cast("long")).alias("bytes"))


@query("SELECT p_partkey, p_partkey % 6 IN (0, 2, 4) AS skipped FROM part")
def src_skip_paths(t):
    k = (F.col("p_partkey") % 6).cast("int")
    path = F.element_at(F.array(*[F.lit(x) for x in (".git/a.php", "src/build.php", "src/build/a.php", "builds/a.php", "a/.x/b.php", "src/.a.php")]), k + 1)
    return t("part").select("p_partkey", N.is_skipped(path, ["build", "dist"]).alias("skipped"))


@query("SELECT p_partkey, p_partkey % 7 IN (0, 1) AS callable, p_partkey % 7 IN (3, 4) AS finder FROM part")
def fn_literal_forms(t):
    k = (F.col("p_partkey") % 7).cast("int")
    text = F.element_at(F.array(*[F.concat(F.lit(x), F.when(k != 2, F.regexp_replace("p_type", "[^A-Z]", "")).otherwise("")) for x in ("\\A\\B::run", "Report::", "1A::", "findBy", "findAllBy", "findby", "find")]), k + 1)
    return t("part").select("p_partkey", N.is_callable_literal(text).alias("callable"), N.is_magic_finder(text).alias("finder"))


@query("""WITH RECURSIVE c AS (SELECT doc_id, text, 0 AS chunk, 1 AS s FROM documents WHERE length(text) > 0 UNION ALL SELECT doc_id, text, chunk + 1, e FROM (SELECT *, CASE WHEN s + 1000 > length(text) THEN length(text) + 1 WHEN strpos(reverse(substring(text, s, 1000)), chr(10)) BETWEEN 1 AND 999 THEN s + 1001 - strpos(reverse(substring(text, s, 1000)), chr(10)) ELSE s + 1000 END AS e FROM c) WHERE e <= length(text))
SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, sha256(substring(text, s, coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY s), length(text) + 1) - s)) AS sha FROM c""")
def chunk_lines(t):
    return N.line_chunks(t("documents").select("doc_id", "text"), "doc_id", "text", 1000).select("doc_id", "chunk", F.sha2("part", 256).alias("sha"))
