"""Derivation, checks, migrations, walks and sinks on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from skein import queries  # noqa: F401
from skein.functions import conventions as C
from skein.functions import names as N
from skein.operators import relational as R
from skein.plans import checks, crossref, graph, migrations, resolve, topics
from skein.sources import scan, store


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("got", "want"),
    [
        (lambda: N.singularize(F.lit("CATEGORIES")), "CATEGORY"),
        (lambda: N.singularize(F.lit("Categories")), "Category"),
        (lambda: N.singularize(F.lit("glass")), "glass"),
        (lambda: N.member_name(F.lit(""), F.lit("f"), F.lit("(global)"), F.lit("A\\B")), "A\\B\\f"),
        (lambda: N.member_name(F.lit(""), F.lit("f"), F.lit("(global)"), F.lit("")), "f"),
        (lambda: N.member_name(F.lit("A\\C"), F.lit("m"), F.lit("C"), F.lit("A")), "A\\C::m"),
        (lambda: F.concat_ws(" ", C.loader_candidates(F.lit("addBehavior"), F.lit("Timestamp"), F.lit("Acme"))), "Acme\\Model\\Behavior\\TimestampBehavior App\\Model\\Behavior\\TimestampBehavior Cake\\ORM\\Behavior\\TimestampBehavior"),
        (lambda: F.concat_ws(" ", C.loader_candidates(F.lit("fetchTable"), F.lit("Bill.AuditsTable"), F.lit("Acme"))), "Bill\\Model\\Table\\AuditsTable"),
        (lambda: C.default_table(F.lit("Bill\\Controller\\Admin\\InvoicesController")), "Bill\\Model\\Table\\InvoicesTable"),
        (lambda: C.er_token(F.lit(None).cast("string")), "x"),
        (lambda: F.concat_ws(",", N.class_types(F.lit("?int|\tFoo \n|Bar&string"))), "Foo,Bar"),
    ],
)
def test_functions(spark, got, want):
    assert one(spark, got()) == want


def test_chunks_are_lossless(spark):
    texts = ["a" * 25, "ab\ncd\n" * 7, "x\n", "", "\n" * 30, "abc\n" + "d" * 40, "é\n日本" * 9]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in N.line_chunks(frame, "id", "text", 10).collect():
        got.setdefault(r.id, {})[r.chunk] = r.part

    def plain(text, size=10):
        out, start = [], 0
        while start < len(text):
            end = min(start + size, len(text))
            if end < len(text) and (cut := text.rfind("\n", start, end)) > start:
                end = cut + 1
            out.append(text[start:end])
            start = end
        return out

    for i, text in enumerate(texts):
        assert [x for _, x in sorted(got.get(i, {}).items())] == plain(text)


def plain_replay(ops):
    """The schema and warnings of one repository by a plain loop over its operations."""
    tables, created, warnings = {}, set(), []
    for x in sorted(ops, key=lambda x: (x["file"].rsplit("/", 1)[-1], x["file"], x["seq"])):
        op, name = x["op"], x["table_name"]
        if op == "drop_table":
            if tables.pop(name, None) is None:
                warnings.append(("drop of unknown table", name))
            created.discard(name)
            continue
        if op == "rename_table":
            new = x["new_name"]
            if name not in tables:
                warnings.append(("rename of unknown table", name))
            elif new in tables:
                warnings.append(("rename collides", name))
            else:
                tables[new] = tables.pop(name)
                if name in created:
                    created.discard(name)
                    created.add(new)
                for t in tables.values():
                    t["keys"] = list(dict.fromkeys((c, new if r == name else r, o) for c, r, o in t["keys"]))
            continue
        t = tables.setdefault(name, {"columns": {}, "indexes": [], "keys": []})
        if op == "create_table":
            if name in created:
                warnings.append(("duplicate create", name))
                continue
            created.add(name)
            implicit = {"id=false": None, "id=key": "key"}.get(x["options"], "id")
            if implicit and implicit not in t["columns"]:
                t["columns"] = {implicit: ("integer", "primary_key"), **t["columns"]}
        elif op == "add_column":
            t["columns"].setdefault(x["column"], (x["type"], x["options"]))
        elif op == "add_index":
            index = (tuple(x["columns"].split(",")), x["unique"], x["index_name"] or "")
            t["indexes"] += [] if index in t["indexes"] else [index]
        elif op == "add_foreign_key":
            key = (x["column"], x["referenced_table"], x["referenced_column"] or "id")
            t["keys"] += [] if key in t["keys"] else [key]
        elif op == "remove_column":
            if t["columns"].pop(x["column"], None) is None:
                warnings.append(("removed column not found", x["column"]))
            t["indexes"] = [i for i in t["indexes"] if x["column"] not in i[0]]
            t["keys"] = [k for k in t["keys"] if k[0] != x["column"]]
        elif op == "rename_column":
            if x["column"] not in t["columns"]:
                warnings.append(("renamed column not found", x["column"]))
                continue
            swap = lambda c: x["new_name"] if c == x["column"] else c  # noqa: E731, B023
            t["columns"] = {swap(c): v for c, v in t["columns"].items()}
            t["indexes"] = [(tuple(map(swap, i[0])), *i[1:]) for i in t["indexes"]]
            t["keys"] = [(swap(k[0]), *k[1:]) for k in t["keys"]]
        elif op == "change_column":
            if x["column"] not in t["columns"]:
                warnings.append(("changed column not found", x["column"]))
            t["columns"][x["column"]] = (x["type"], x["options"])
    warnings += [("never created", name) for name in tables if name not in created]
    return tables, sorted(warnings)


@pytest.mark.parametrize("seed", range(3))
def test_migrations(spark, seed):
    rng = random.Random(seed)
    kinds = ["create_table", "add_column", "add_column", "add_index", "add_foreign_key", "remove_column", "rename_column", "change_column", "rename_table", "drop_table"]
    ops = []
    for repo in ("a", "b"):
        for seq in range(120):
            op, names = rng.choice(kinds), [f"t{i}" for i in range(8)]
            new = rng.choice(names + ["u0", "u1", "u2"]) if op == "rename_table" else f"r{seq}"  # renamed columns never meet one that exists
            ops.append({"repo": repo, "file": f"x{rng.randrange(2)}/{rng.randrange(4)}_m.php", "seq": seq, "op": op, "table_name": rng.choice(names), "new_name": new, "column": f"c{rng.randrange(4)}", "type": rng.choice(["string", "text"]), "options": rng.choice(["id=false", "id=key", "limit=3"]) if op == "create_table" else "limit=3", "columns": f"c{rng.randrange(4)}", "unique": rng.random() < 0.5, "index_name": None, "referenced_table": rng.choice(names), "referenced_column": None})
    schema = "repo string, file string, seq int, op string, table_name string, new_name string, column string, type string, options string, columns string, `unique` boolean, index_name string, referenced_table string, referenced_column string"
    got = migrations.replay(spark.createDataFrame(ops, schema)).collect()
    for repo in ("a", "b"):
        tables, warnings = plain_replay([x for x in ops if x["repo"] == repo])
        mine = [r for r in got if r.repo == repo]
        assert {r.table_name for r in mine if r.kind == "table"} == set(tables)
        for name, t in tables.items():
            rows = sorted((r for r in mine if r.table_name == name), key=lambda r: r.ord or 0)
            assert [(r.name, r.type, r.options) for r in rows if r.kind == "column"] == [(c, *v) for c, v in t["columns"].items()]
            assert [(tuple(r.columns), r["unique"], r.name) for r in rows if r.kind == "index"] == t["indexes"]
            assert {(r.name, r.referenced_table, r.referenced_column) for r in rows if r.kind == "foreign_key"} == set(t["keys"])
        assert sorted((r.type, r.name or r.table_name) for r in mine if r.kind == "warning") == warnings


def test_migrations_of_nothing(spark):
    empty = spark.createDataFrame([], "repo string, file string, seq int, op string, table_name string")
    assert migrations.replay(empty).count() == 0


def test_spans_keep_equal_points(spark):
    points = spark.createDataFrame([("f", 5), ("f", 5), ("f", 99), (None, 5)], "k string, at int")
    spans = spark.createDataFrame([("f", "outer", 1, 10), ("f", "inner", 4, 6)], "k string, name string, start int, end int")
    got = R.innermost_span(points, spans, "k", "at", "start", "end", ["name"], 4).collect()
    assert [r.name for r in got] == ["inner", "inner"]


def test_match_modes(spark):
    questions = spark.createDataFrame([(1, "A", ["x"], "equals"), (2, "a", ["X", "y"], "exact_set"), (3, "a", [], "count_at_least"), (4, "a", ["y"], "contains_all"), (5, "b", [], "exact_set"), (6, "b", [], "count_at_least")], "question_id int, subject string, expected array<string>, mode string")
    answers = spark.createDataFrame([("a", ["x", "y"])], "subject string, answers array<string>")
    assert {r.question_id: r.passed for r in checks.match_modes(questions, answers).collect()} == {1: False, 2: True, 3: True, 4: True, 5: True, 6: False}
    facts = spark.createDataFrame([("callees_of", "a", "X"), ("callees_of", "a", "x"), ("callees_of", "a", "y"), ("count_at_least", "methodcalls", "row"), ("node_exists", "n", "exists")], "type string, subject string, answer string")
    asked = [(1, "callees_of", "A", "equals", None, "x"), (2, "callees_of", "A", "exact_set", None, "X"), (2, "callees_of", "A", "exact_set", None, "Y"), (3, "callees_of", "a", "count_at_least", 3, None), (4, "callees_of", "a", "count_at_least", 4, None), (5, "count_at_least", "MethodCalls", "", None, None), (6, "node_exists", "N", "exact_set", None, None), (7, "node_exists", "q", "exact_set", None, None), (8, "table_columns", "t", "contains_all", None, None)]
    got = checks.grade(spark.createDataFrame(asked, "question_id int, type string, subject string, mode string, at_least int, expected string"), facts).collect()
    assert {r.question_id: r.passed for r in got} == {1: False, 2: True, 3: True, 4: False, 5: True, 6: True, 7: False, 8: False}


def test_cycles_do_not_count_walks(spark):
    dense = spark.createDataFrame([(a, b) for a in range(30) for b in range(30)] * 3, "src int, dst int")
    assert {(r.node, r.length) for r in graph.cycles(dense, 2, 10).collect()} == {(i, 2) for i in range(30)}


def test_member_walk(spark):
    classes = spark.createDataFrame([("r", c) for c in "ABCDE"], "repo string, fqcn string")
    heritage = spark.createDataFrame([("r", "A", 0, "extends", "B"), ("r", "A", 1, "uses", "C"), ("r", "B", 0, "extends", "D"), ("r", "D", 0, "extends", "A"), ("r", "A", 2, "implements", "E")], "repo string, fqcn string, pos int, relation string, parent string")
    members = spark.createDataFrame([("r", "C", "m", "method"), ("r", "D", "m", "method"), ("r", "E", "n", "method"), ("r", "D", "__call", "method"), ("r", "D", "p", "property")], "repo string, fqcn string, name string, member_kind string")
    behaviors = spark.createDataFrame([("r", "B", 0, "E")], "repo string, fqcn string, pos int, behavior string")
    lines = resolve.lineage(heritage, classes)
    asked = spark.createDataFrame([("r", "A", "M", False), ("r", "A", "n", False), ("r", "A", "zz", False), ("r", "A", "zz", True), ("r", None, "m", False)], "repo string, fqcn string, member string, static boolean")
    got = {(r.fqcn, r.member, r.static): (r.owner, r.rule) for r in resolve.walk_members(asked, lines, members, behaviors).collect()}
    assert got == {("A", "M", False): ("c", "chain"), ("A", "n", False): ("e", "behavior"), ("A", "zz", False): ("d", "magic_call"), ("A", "zz", True): (None, None), (None, "m", False): (None, None)}
    assert resolve.property_on_chain(asked.where("member = 'n'").select("repo", "fqcn", F.lit("P").alias("prop")), lines, members).first().declared_in == "d"


def test_strict_names(spark):
    rows = spark.createDataFrame([("r", "f", "N", t) for t in ("\\A\\B", "namespace\\X", "al\\Sub", "AL", "Plain", "", None)], "repo string, path string, namespace string, text string")
    aliases = spark.createDataFrame([("r", "f", "Al", "Old", 1), ("r", "f", "al", "P\\Q", 2)], "repo string, path string, alias string, fqcn string, ord int")
    got = {r.text: (r.strict, r.candidates) for r in crossref.candidate_names(rows, aliases).collect()}
    assert got["\\A\\B"] == ("A\\B", ["A\\B"]) and got["namespace\\X"] == ("N\\X", ["N\\X"])
    assert got["al\\Sub"] == ("P\\Q\\Sub", ["P\\Q\\Sub"]) and got["AL"] == ("P\\Q", ["P\\Q"])
    assert got["Plain"] == ("N\\Plain", ["N\\Plain", "Plain"]) and got[""][0] == "" and got[None][0] == ""


def test_sources_and_sinks(spark, tmp_path):
    repo = tmp_path / "one"
    for path, text in {"src/A.PHP": "<?php a", "vendor/x/B.php": "b", "src/note.md": "# n", "src/c.txt": "c"}.items():
        (repo / path).parent.mkdir(parents=True, exist_ok=True)
        (repo / path).write_text(text)
    (tmp_path / "manifest.json").write_text(json.dumps([str(repo), {"name": "two", "path": str(repo), "include_vendor": True}]))
    files = scan.all_repos(spark, str(tmp_path / "manifest.json"))
    assert {(r.repo, r.path, r.origin) for r in files.collect()} == {("one", "src/A.PHP", "app"), ("two", "src/A.PHP", "app"), ("two", "vendor/x/B.php", "vendor")}
    assert tuple(scan.vendor_stats(spark, str(repo)).first()) == (1, 1)
    assert [tuple(r) for r in scan.markdown(spark, str(repo)).collect()] == [("src/note", "# n")]
    metas = spark.createDataFrame([("a", 3, 3, ""), ("b", 2, 3, ""), ("c", None, 3, "")], "repo string, id_scheme int, version int, id_prefix string")
    assert {r.repo: r.reason for r in scan.usable_repos(metas, 3, 3, "").collect()} == {"a": None, "b": "id scheme", "c": "incomplete"}
    out = str(tmp_path / "stage")
    rows = spark.createDataFrame([("r", 1, "a", 1), ("s", 2, "b", 1)], "repo string, id int, v string, at int")
    store.write_upsert(spark, out, rows, ["repo", "id"], "repo", [F.col("at")])
    store.write_upsert(spark, out, spark.createDataFrame([("r", 1, "old", 2), ("r", 1, "new", 3), ("r", 4, None, 1)], rows.schema), ["repo", "id"], "repo", [F.col("at")])
    assert {(r.repo, r.id, r.v) for r in spark.read.parquet(out).collect()} == {("r", 1, "new"), ("r", 4, None), ("s", 2, "b")}
    store.write_tables({"x": rows, "y": rows.limit(1)}, str(tmp_path / "many"))
    assert spark.read.parquet(str(tmp_path / "many" / "x")).count() == 2
    docs = spark.createDataFrame([("a/b.md", "text"), ("index.md", "top"), ("../evil.md", "no")], "path string, content string")
    assert store.write_documents(docs, str(tmp_path / "docs")) == 2
    assert (tmp_path / "docs" / "a" / "b.md").read_text() == "text" and not (tmp_path / "evil.md").exists()
    pages = {r.path: r.content for r in store.index_pages(spark.createDataFrame([(f"d/{i:03}.php", f"line {i}\nmore") for i in range(203)], "path string, summary string"), 200).collect()}
    assert pages["d/index.md"].count("\n") == 201 and pages["d/index.md"].endswith("3 more")


def test_metadata_and_results(spark):
    spark.createDataFrame([(i, "x" * 600) for i in range(60)], "id int, text string").createOrReplaceTempView("skein_probe")
    assert "skein_probe" in {r.table_name for r in graph.list_tables(spark).collect()}
    assert [(r.column, r.type) for r in graph.list_columns(spark, "skein_probe").collect()] == [("id", "int"), ("text", "string")]
    good = graph.run_query(spark, "SELECT * FROM skein_probe")
    assert good["status"] == "success" and good["row_count"] == 60 and len(good["results"]) == 50 and len(good["results"][0]["text"]) == 500
    bad = graph.run_query(spark, "SELECT nothing FROM nowhere")
    assert bad["status"] == "error" and bad["error_message"]


def test_hashed_texts(spark):
    rows = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, " ")], "id int, text string")
    got = topics.embedded(rows).collect()
    assert [r.id for r in got] == [1] and abs(sum(x * x for x in got[0].embedding) - 1) < 1e-9
    assert list(got[0].embedding) == topics.hashed_features("a b a", 64).tolist()


def test_cross_calls_and_wiring(spark):
    known = spark.createDataFrame([("a\\x", "r1", "A\\X", "cx"), ("a\\y", "r1", "A\\Y", "cy1"), ("a\\y", "r2", "A\\Y", "cy2"), ("a\\z", "r2", "A\\Z", "cz")], "norm_fqcn string, repo string, fqcn string, class_id string")
    declared = spark.createDataFrame([("A\\X", "go", "A\\X", "mx"), ("A\\Y", "go", "A\\Y", "my"), ("A\\Z", "go", "A\\Z", "mz")], "name string, member string, owner_class string, method_id string")
    aliases = spark.createDataFrame([("r2", "f", "Ex", "A\\X", 1)], "repo string, path string, alias string, fqcn string, ord int")
    sites = [("r2", "f", "N", "c1", "Ex", "GO"), ("r2", "f", "N", "c1", "\\A\\X", "go"), ("r2", "f", "N", "c2", "\\A\\Y", "go"), ("r2", "f", "N", "c3", "\\A\\Z", "go"), ("r2", "f", "N", "c4", "\\A\\X", "stop"), ("r2", "f", "N", "c5", None, "go")]
    got = crossref.method_calls(spark.createDataFrame(sites, "repo string, path string, namespace string, caller_method string, text string, member string"), aliases, declared, known).collect()
    assert [(r.caller_method, r.callee_method, r.source_repo, r.target_repo, r.symbol) for r in got] == [("c1", "mx", "r2", "r1", "A\\X::go")]
    wires = [("1", "r2", "bind", "A\\X", "A\\Y"), ("2", "r2", "bind", "A\\Y", "A\\Z"), ("3", "r3", "inject", "A\\X", "A\\Y"), ("4", "r3", "inject", "A\\X", "A\\Z"), ("5", "r1", "bind", "A\\Nope", "A\\X")]
    got = crossref.wiring(spark.createDataFrame(wires, "binding_id string, repo string, kind string, source string, target string"), known).collect()
    assert {(r.kind, r.source_class, r.target_class, r.source_repo, r.target_repo) for r in got} == {("bind", "cx", "cy2", "r1", "r2"), ("inject", "cx", "cz", "r1", "r2")}
