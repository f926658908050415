import random
from collections import Counter

from pyspark.sql import functions as F

from skein.functions import names as N
from skein.operators import relational as R
from skein.plans import checks, graph
from skein.sources import scan, store


def one(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], list(columns))


def test_identity(spark):
    import hashlib

    df = spark.createDataFrame([("r", "a.php"), (None, "x|y")], "repo string, path string")
    got = [r[0] for r in df.select(N.make_id("file", F.col("repo"), F.col("path"))).collect()]
    assert got == ["file_" + hashlib.sha256(x.encode()).hexdigest()[:16] for x in ("file|r|a.php", "file||x|y")]


def test_names(spark):
    words = [("categories", "category"), ("classes", "class"), ("boxes", "box"), ("churches", "church"), ("dishes", "dish"), ("users", "user"), ("glass", "glass"), ("ies", "ie"), ("data", "data")]
    got = spark.createDataFrame(words, "w string, want string").withColumn("got", N.singularize(F.col("w"))).collect()
    assert all(r.got == r.want for r in got)
    pairs = {"ArticlesTable": "articles", "UserProfilesTable": "user_profiles", "X": "x"}
    assert {r.w: r.t for r in spark.createDataFrame([(k,) for k in pairs], "w string").select("w", N.tableize(F.col("w")).alias("t")).collect()} == pairs
    r = one(spark, p="full_name", q="DebugKit.Toolbar", u="Users", t="?App\\User|int|null&\\Foo").select(N.virtual_getter(F.col("p")), N.split_plugin(F.col("q")).alias("q"), N.split_plugin(F.col("u")).alias("u"), N.class_types(F.col("t")).alias("t")).first()
    assert r[0] == "_getFullName" and (r.q.plugin, r.q.rest) == ("DebugKit", "Toolbar") and (r.u.plugin, r.u.rest) == (None, "Users") and r.t == ["App\\User", "\\Foo"]
    text = one(spark, a="x" * 20, b="y" * 41).select(N.truncate(F.col("a"), 40).alias("a"), N.truncate(F.col("b"), 40).alias("b")).first()
    assert text.a == "x" * 20 and text.b == "y" * 25 + N.TRUNCATED and len(text.b) == 40


def test_paths(spark, tmp_path):
    for path in ("src/A.php", "src/x/B.ctp", "vendor/v/C.php", ".git/D.php", "src/E.txt", "webroot/index.php"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("<?php\nline")
    files = scan.repo_files(spark, str(tmp_path), "r")
    assert {r.path for r in files.collect()} == {"src/A.php", "src/x/B.ctp"}
    both = {(r.path, r.origin, r.content) for r in scan.repo_files(spark, str(tmp_path), "r", include_vendor=True).collect()}
    assert both == {("src/A.php", "app", "<?php\nline"), ("src/x/B.ctp", "app", "<?php\nline"), ("vendor/v/C.php", "vendor", "<?php\nline")}
    assert {(r.dir, r.parent, r.depth) for r in scan.directories(files).collect()} == {(".", None, 0), ("src", ".", 1), ("src/x", "src", 2)}


def test_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, None)], "k int, o int, v string")
    assert {r.k: r.v for r in R.first_wins(df, ["k"], [F.col("o")]).collect()} == {1: "a", 2: None}
    assert {r.k: r.v for r in R.last_wins(df, ["k"], [F.col("o")]).collect()} == {1: "c", 2: None}


def test_fan_out_and_owners(spark):
    sites = spark.createDataFrame([(1, "run"), (2, "run"), (3, "save"), (4, "none")], "site int, name string")
    found = spark.createDataFrame([("run", i) for i in range(6)] + [("save", 9)], "name string, target int")
    assert {(r.site, r.target, r.candidate_count) for r in R.fan_out(sites, found, "name", 5).collect()} == {(3, 9, 1)}
    assert {r.outcome: r.n for r in R.fan_out_outcomes(sites, found, "name", 5).collect()} == {"fanout_capped": 2, "heuristic": 1, "no_candidates": 1}
    refs = spark.createDataFrame([("A", "web"), ("B", "web"), ("C", "web"), ("D", "web")], "name string, source string")
    registry = spark.createDataFrame([("A", "web"), ("A", "api"), ("B", "api"), ("B", "lib"), ("C", "lib")], "name string, owner string")
    assert {r.name: (r.status, r.owner) for r in R.classify_owners(refs, registry).collect()} == {"A": ("local_definition", None), "B": ("ambiguous", None), "C": ("owned", "lib"), "D": ("unowned", None)}


def test_orphans_and_spans(spark):
    edges = spark.createDataFrame([(1, 10), (2, 11), (3, 99), (98, 99)], "s int, d int")
    a, b = spark.createDataFrame([(1,), (2,), (3,)], "id int"), spark.createDataFrame([(10,), (11,)], "id int")
    assert {tuple(r) for r in R.orphans(edges, ["s", "d"], [("s", a, "id"), ("d", b, "id")]).collect()} == {(3, 99), (98, 99)}
    spans = spark.createDataFrame([("f", "class", 1, 100), ("f", "method", 10, 20), ("g", "other", 1, 50)], "file string, name string, start int, end int")
    points = spark.createDataFrame([("f", 15), ("f", 30), ("f", 101), ("g", 50)], "file string, line int")
    got = {(r.file, r.line): r.name for r in R.innermost_span(points, spans, "file", "line", "start", "end", [], 16).collect()}
    assert got == {("f", 15): "method", ("f", 30): "class", ("g", 50): "other"}
    left = spark.createDataFrame([("v", 5), ("v", 1), ("w", 3)], "k string, t int")
    right = spark.createDataFrame([("v", 2, "a"), ("v", 5, "b"), ("w", 9, "c")], "k string, t int, type string")
    assert {(r.k, r.t): r.type for r in R.as_of(left, right, "k", "t", "type").collect()} == {("v", 5): "b", ("v", 1): None, ("w", 3): None}


def test_walks_against_brute_force(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(7), rng.randrange(7)) for _ in range(14)]
    frame = spark.createDataFrame(edges, "src int, dst int")
    want, front = Counter(), Counter(edges)
    for depth in range(1, 5):
        for (s, e), n in front.items():
            want[s, e, depth] += n
        step = Counter()
        for (s, e), n in front.items():
            for a, b in edges:
                if a == e:
                    step[s, b] += n
        front = step
    assert {(r.start, r.end, r.depth): r.n for r in graph.walks(frame, 1, 4).collect()} == dict(want)
    assert {(r.start, r.end) for r in graph.walks(frame, 2, 4, distinct=True).collect()} == {(s, e) for s, e, d in want if d >= 2}
    closed = {}
    for s, e, d in want:
        if s == e and d >= 2:
            closed[s] = min(d, closed.get(s, 9))
    assert {r.node: r.length for r in graph.cycles(frame, 2, 4).collect()} == closed
    reach = {(a, b) for a, b in edges}
    while True:
        more = reach | {(a, d) for a, b in reach for c, d in edges if b == c}
        if more == reach:
            break
        reach = more
    assert {(r.start, r.end) for r in graph.closure(frame).collect()} == reach


def test_checks(spark):
    nodes = spark.createDataFrame([(1, "A::run"), (2, "B::help"), (3, "B::save")], "id int, name string")
    edges = spark.createDataFrame([(1, 2), (1, 3)], "src int, dst int")
    answers = checks.neighbours(edges, nodes)
    asked = [(1, "A::RUN", ["b::HELP"], "contains_all"), (2, "A::run", ["B::help"], "exact_set"), (3, "A::run", ["B::save", "B::help"], "exact_set"), (4, "A::run", ["2"], "count_at_least"), (5, "Z", ["x"], "contains_all"), (6, "A::run", ["3"], "count_at_least")]
    q = spark.createDataFrame(asked, "question_id int, subject string, expected array<string>, mode string")
    assert {r.question_id: r.passed for r in checks.match_modes(q, answers).collect()} == {1: True, 2: False, 3: True, 4: True, 5: False, 6: False}


def test_store(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B", 1.0), (3, "C", 2.0)], "k int, v string, extra double")
    assert {tuple(r) for r in store.upsert(old, new, ["k"]).collect()} == {(1, "a", None), (2, "B", 1.0), (3, "C", 2.0)}
    assert store.missing_columns(old, new) == ["extra"]
    assert {r.k for r in store.pending(new, old, ["k"]).collect()} == {3}
    assert {tuple(r) for r in store.update_column(old, new, "k", "v").collect()} == {(1, "a"), (2, "B")}


def test_entry_queries_match_sql(spark):
    import duckdb

    import __spark_entry__ as e

    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in e.core._TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    text = lambda rows, cols: sorted(str([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in sorted(range(len(cols)), key=lambda i: cols[i])]) for r in rows)
    for name, sql in e.core.SQL.items():
        df = e.core.QUERIES[name](spark, folder)
        got = con.execute(sql)
        cols = [c[0] for c in got.description]
        assert sorted(cols) == sorted(df.columns), name
        assert text([tuple(r) for r in df.collect()], df.columns) == text(got.fetchall(), cols), name
    assert e.entry(spark).count() > 0


def test_graph_queries_over_every_edge(spark):
    import duckdb

    import __spark_entry__ as e

    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in e.core._TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    run = lambda name: e.queries()[name](spark, folder).collect()
    edges = con.execute("SELECT DISTINCT c_nationkey, s_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey").fetchall()
    assert max(Counter(s for s, _ in edges).values()) > 3
    want, front = {}, Counter(edges)
    for depth in range(1, 11):
        want[depth], step = front, Counter()
        for (s, d), n in front.items():
            for a, b in edges:
                if a == d:
                    step[s, b] += n
        front = step
    assert {(r.start, r.end, r.depth): r.n for r in run("gql_quantified_bag_all")} == {(*k, depth): n for depth in (1, 2, 3) for k, n in want[depth].items()}
    assert sorted((r.start, r.end) for r in run("gql_quantified_distinct_all")) == sorted({k for depth in range(1, 6) for k in want[depth]})
    closed = {}
    for depth in range(2, 11):
        for s, d in want[depth]:
            if s == d:
                closed.setdefault(s, depth)
    assert {r.node: r.length for r in run("gql_cycle_all")} == closed
    names = {k: n.lower() for k, n in con.execute("SELECT n_nationkey, n_name FROM nation").fetchall()}
    for name, i in (("qa_callees_all", 0), ("qa_callers_all", 1)):
        got = {r.subject: r.answers for r in run(name)}
        assert got == {names[k]: ",".join(sorted({names[x[1 - i]] for x in edges if x[i] == k})) for k in {x[i] for x in edges}}
    out, first = {k: {names[d] for s, d in edges if s == k} for k in names}, min(names.values())
    modes = {"contains_all": lambda g: first in g, "exact_set": lambda g: g == {first}, "count_at_least": lambda g: len(g) >= 3}
    assert {(r.question_id, r.mode): r.passed for r in run("qa_match_modes_all")} == {(k, m): f(out[k]) for k in names for m, f in modes.items()}
    tree = [("r%d" % r, "n%d" % n) for r, n in con.execute("SELECT n_regionkey, n_nationkey FROM nation").fetchall()] + [("n%d" % n, "c%d" % c) for n, c in con.execute("SELECT c_nationkey, c_custkey FROM customer").fetchall()]
    assert {tuple(r) for r in run("hier_closure_all")} == {(*x, 1) for x in tree} | {(a, d, 2) for a, b in tree for c, d in tree if b == c}
    brands = {}
    for name, brand in con.execute("SELECT p_name, p_brand FROM part").fetchall():
        brands.setdefault(name, set()).add(brand)
    assert {(r.p_name, r.p_brand) for r in run("unique_forward_all")} == {(n, min(b)) for n, b in brands.items() if len(b) == 1}
