"""Resolution from entities: a small code base with the expected outcome of every rule; long chains end."""

import pytest
from pyspark.sql import functions as F

from skein.plans import graph, resolve
from skein.plans import resolution as R

FILE = "repo string, path string, namespace string, class_name string, fqcn string, "
SCHEMAS = {
    "classes": "repo string, path string, ord long, name string, namespace string, fqcn string, kind string, internal boolean",
    "heritage": FILE + "pos int, relation string, text string, line int, col int",
    "members": FILE + "ord long, name string, member_kind string, return_type string",
    "params": FILE + "member string, pos int, name string, type string",
    "uses": "repo string, path string, kind string, alias string, fqcn string, ord long, line int, col int",
    "sites": FILE + "member string, ord long, line int, col int, kind string, name string, qualified string, receiver string, dynamic boolean, args array<string>",
    "assignments": FILE + "member string, ord long, line int, col int, var string, rhs_kind string, name string, qualified string, receiver string",
    "reads": FILE + "member string, ord long, line int, col int, name string, receiver string",
    "class_refs": FILE + "member string, ord long, line int, col int, kind string, text string, name string",
    "located": "repo string, path string, line int, col int, pos int, fqcn string, name string, member_kind string, target_path string, internal boolean",
}


class Code:
    """Rows of a code base, one file for each class."""

    def __init__(self):
        self.rows = {k: [] for k in SCHEMAS}
        self.n = 0

    def cls(self, fqcn, kind="class", internal=True, extends=(), uses=(), implements=()):
        space, _, name = fqcn.rpartition("\\")
        self.at = ("r", f"{name}.php", space, name, fqcn)
        self.n += 1
        self.rows["classes"].append(("r", self.at[1], self.n, name, space, fqcn, kind, internal))
        for pos, (relation, text) in enumerate([("extends", x) for x in extends] + [("uses", x) for x in uses] + [("implements", x) for x in implements]):
            self.rows["heritage"].append((*self.at, pos, relation, text, pos + 1, 0))
        return self

    def has(self, name, returns="", kind="method", **params):
        self.n += 1
        self.rows["members"].append((*self.at, self.n, name, kind, returns))
        self.member = name
        for pos, (p, type_) in enumerate(params.items()):
            self.rows["params"].append((*self.at, name, pos, "$" + p, type_))
        return self

    def alias(self, alias, fqcn, kind="class"):
        self.n += 1
        self.rows["uses"].append((*self.at[:2], kind, alias, fqcn, self.n, self.n, 0))
        return self

    def call(self, line, receiver, name, kind="method", args=(), dynamic=False, col=5, qualified="", to=None):
        self.n += 1
        self.rows["sites"].append((*self.at, self.member, self.n, line, col, kind, name, qualified, receiver, dynamic, list(args)))
        if to:
            self.set(line, to, "call", col=col)
        return self

    def set(self, line, var, kind, name="", receiver="", col=1, qualified=""):
        self.n += 1
        self.rows["assignments"].append((*self.at, self.member, self.n, line, col, var, kind, name, qualified, receiver))
        return self

    def read(self, line, receiver, name):
        self.n += 1
        self.rows["reads"].append((*self.at, self.member, self.n, line, 9, name, receiver))
        return self

    def ref(self, line, kind, text, name=""):
        self.n += 1
        self.rows["class_refs"].append((*self.at, self.member, self.n, line, 11, kind, text, name))
        return self

    def seen(self, line, col, *targets):
        for pos, (fqcn, name) in enumerate(targets):
            self.rows["located"].append((*self.at[:2], line, col, pos, fqcn, name, "method" if name else "", fqcn.rpartition("\\")[2] + ".php", True))
        return self


def code() -> Code:
    c = Code()
    c.cls("Vendor\\Base", internal=False).has("vendorOnly").has("get").has("first")
    c.cls("App\\Model\\Table\\PostsTable", extends=["\\Vendor\\Base"]).has("initialize").call(1, "$this", "addBehavior", args=["Tree"]).call(2, "$this", "addBehavior", args=["Nope"]).has("findTop", "?Post")
    c.cls("App\\Model\\Table\\UsersTable", extends=["PostsTable"]).has("owner", "\\App\\Svc\\Proxy").has("again", "static")
    c.cls("App\\Model\\Entity\\Post").has("title").has("_getFullName").has("declared", kind="property")
    c.cls("App\\Model\\Behavior\\TreeBehavior").has("initialize").call(1, "$this", "addBehavior", args=["Deep"]).has("climb")
    c.cls("App\\Model\\Behavior\\DeepBehavior").has("initialize").call(1, "$this", "addBehavior", args=["Tree"]).has("dive").has("__call")
    c.cls("App\\Svc\\Face", kind="interface").has("act")
    c.cls("App\\Svc\\Real", implements=["Face"]).has("act").has("getNext").has("make", "self")
    c.cls("App\\Svc\\Other").has("act").has("only").has("title")
    c.cls("App\\Svc\\Proxy").has("__call").call(1, "", "Other", kind="new").has("__get").has("inner", "?Real", kind="property").has("__construct", next="int")
    c.cls("App\\Svc\\Late").has("run").call(1, "static", "step", kind="static").has("step")
    c.cls("App\\Svc\\Later", extends=["Late"]).has("step")
    c.cls("App\\Util\\F").cls("App\\Controller\\PostsController", extends=["AppController"])
    c.has("initialize").call(1, "$this", "fetchTable", args=["Users"]).has("svc", "\\App\\Svc\\Real", kind="property")
    c.alias("Alias", "App\\Svc\\Real").alias("helper", "App\\Util\\help", kind="function").alias("Lost", "App\\Gone")
    c.has("act", p="?Alias", t="\\App\\Model\\Table\\PostsTable")
    return c


CASES = {
    # name: (lines of the method, receiver and member of the site, expected (status, via, owner, member, type, hops))
    "own": (lambda c: c.call(10, "$this", "act"), ("resolved", "convention:chain", "App\\Controller\\PostsController", "act", "app\\controller\\postscontroller", 0)),
    "parent": (lambda c: c.call(10, "parent", "act", kind="static"), ("unresolved", "none", None, None, None, 0)),
    "default table": (lambda c: c.call(10, "$this->Posts", "findTop"), ("resolved", "convention:chain", "App\\Model\\Table\\PostsTable", "findTop", "app\\model\\table\\poststable", 0)),
    "loader property": (lambda c: c.call(10, "$this->Users", "owner"), ("resolved", "convention:chain", "App\\Model\\Table\\UsersTable", "owner", "app\\model\\table\\userstable", 0)),
    "declared property": (lambda c: c.call(10, "$this->svc", "act"), ("resolved", "convention:chain", "App\\Svc\\Real", "act", "app\\svc\\real", 0)),
    "class text": (lambda c: c.call(10, "Alias::class", "make", kind="static"), ("resolved", "convention:chain", "App\\Svc\\Real", "make", "app\\svc\\real", 0)),
    "parameter": (lambda c: c.call(10, "$p", "act"), ("resolved", "convention:chain", "App\\Svc\\Real", "act", "app\\svc\\real", 0)),
    "external": (lambda c: c.call(10, "$t", "vendorOnly"), ("external", "convention:chain", "Vendor\\Base", "vendorOnly", "app\\model\\table\\poststable", 0)),
    "behavior": (lambda c: c.call(10, "$t", "climb"), ("resolved", "convention:behavior", "App\\Model\\Behavior\\TreeBehavior", "climb", "app\\model\\table\\poststable", 0)),
    "inherited behavior of a behavior": (lambda c: c.call(10, "$this->Users", "dive"), ("resolved", "convention:behavior", "App\\Model\\Behavior\\DeepBehavior", "dive", "app\\model\\table\\userstable", 0)),
    "caught by a behavior": (lambda c: c.call(10, "$t", "findByName"), ("resolved", "convention:behavior", "App\\Model\\Behavior\\DeepBehavior", "__call", "app\\model\\table\\poststable", 0)),
    "loaded variable": (lambda c: c.call(9, "$this", "fetchTable", args=["Posts"], to="$x").call(10, "$x", "findTop"), ("resolved", "convention:chain", "App\\Model\\Table\\PostsTable", "findTop", "app\\model\\table\\poststable", 1)),
    "entity of a table": (lambda c: c.call(8, "$t", "get", to="$e").call(10, "$e", "title"), ("resolved", "convention:chain", "App\\Model\\Entity\\Post", "title", "app\\model\\entity\\post", 1)),
    "three calls": (lambda c: c.call(7, "$this->Users", "again", to="$a").call(8, "$a", "again", to="$b").set(9, "$w", "var", "$b").call(9, "$w", "owner", to="$d").call(10, "$d", "only"), ("resolved", "convention:magic_proxy", "App\\Svc\\Other", "only", "app\\svc\\proxy", 3)),
    "proxy with two targets": (lambda c: c.set(9, "$x", "new", "Proxy", qualified="\\App\\Svc\\Proxy").call(10, "$x", "act"), ("resolved", "convention:magic_call", "App\\Svc\\Proxy", "__call", "app\\svc\\proxy", 0)),
    "finder": (lambda c: c.set(9, "$x", "new", "Proxy", qualified="\\App\\Svc\\Proxy").call(10, "$x", "findByName"), ("resolved", "convention:magic_finder", "App\\Svc\\Proxy", "__call", "app\\svc\\proxy", 0)),
    "last assignment": (lambda c: c.set(8, "$x", "new", "x", qualified="\\App\\Svc\\Real").set(9, "$x", "new", "x", qualified="\\App\\Svc\\Other").set(11, "$x", "new", "x", qualified="\\App\\Svc\\Real").call(10, "$x", "only"), ("resolved", "convention:chain", "App\\Svc\\Other", "only", "app\\svc\\other", 0)),
    "null value hides": (lambda c: c.set(8, "$p", "new", "Gone").call(10, "$p", "act"), ("resolved", "convention:chain", "App\\Svc\\Real", "act", "app\\svc\\real", 0)),
    "null copy": (lambda c: c.set(8, "$x", "new", "x", qualified="\\App\\Svc\\Real").set(9, "$x", "var", "$none").call(10, "$x", "act"), ("unresolved", "none", None, None, None, 0)),
    "own result": (lambda c: c.call(9, "$this->Users", "again", to="$u").call(10, "$u", "owner", to="$u"), ("unresolved", "none", None, None, None, 0)),
    "run time": (lambda c: c.set(9, "$x", "dynamic").call(10, "$x", "only"), ("dynamic", "none", None, None, "!dynamic", 0)),
    "static variable": (lambda c: c.call(10, "$q", "make", kind="static"), ("dynamic", "none", None, None, None, 0)),
    "computed": (lambda c: c.call(10, "$this", "act", dynamic=True), ("dynamic", "none", None, None, "app\\controller\\postscontroller", 0)),
    "unknown": (lambda c: c.call(10, "$this", "nothing"), ("unresolved", "none", None, None, "app\\controller\\postscontroller", 0)),
    "new": (lambda c: c.call(10, "", "Proxy", kind="new", qualified="\\App\\Svc\\Proxy"), ("resolved", "parser", "App\\Svc\\Proxy", "__construct", None, 0)),
    "new unknown": (lambda c: c.call(10, "", "Lost", kind="new"), ("unresolved", "none", None, None, None, 0)),
    "function": (lambda c: c.call(10, "", "helper", kind="function"), ("resolved", "convention:function_fallback", "", "App\\Util\\help", None, 0)),
    "located": (lambda c: c.call(10, "$this", "x").seen(10, 5, ("App\\Svc\\Other", "only")), ("resolved", "lsp", "App\\Svc\\Other", "only", "app\\controller\\postscontroller", 0)),
    "located interface": (lambda c: c.call(10, "$p", "act").seen(10, 5, ("App\\Svc\\Face", "act")), ("resolved", "lsp+concrete", "App\\Svc\\Real", "act", "app\\svc\\real", 0)),
    "located twice": (lambda c: c.call(10, "$this", "x").seen(10, 5, ("App\\Svc\\Other", "only"), ("App\\Svc\\Real", "act")), ("ambiguous", "lsp", None, None, "app\\controller\\postscontroller", 0)),
}


def entities(spark, c: Code) -> R.Entities:
    return R.Entities(**{k: spark.createDataFrame(rows, SCHEMAS[k]) for k, rows in c.rows.items()})


@pytest.fixture(scope="module")
def resolved(spark):
    """All cases as methods of one controller, resolved at once."""
    c = code()
    c.rows["classes"].append(("r", "f.php", 900, "(global)", "App\\Util", "", "module", True))
    c.rows["members"].append(("r", "f.php", "App\\Util", "(global)", "", 901, "help", "function", ""))
    for i, (name, (add, _)) in enumerate(CASES.items()):
        c.has(f"case{i}", p="?Alias", t="\\App\\Model\\Table\\PostsTable")
        before = {k: len(v) for k, v in c.rows.items()}
        add(c)
        for k in ("sites", "assignments"):  # lines of one file do not clash
            c.rows[k][before[k] :] = [(*r[:7], r[7] + 100 * (i + 1), *r[8:]) for r in c.rows[k][before[k] :]]
        c.rows["located"][before["located"] :] = [(*r[:2], r[2] + 100 * (i + 1), *r[3:]) for r in c.rows["located"][before["located"] :]]
    c.has("reads", p="\\App\\Svc\\Proxy", e="\\App\\Model\\Entity\\Post")
    c.read(5000, "$e", "full_name").read(5001, "$e", "declared").read(5002, "$p", "next").read(5003, "$p", "inner").read(5004, "$p", "zip").read(5005, "$none", "zip")
    c.ref(5010, "class_literal", "Alias").ref(5011, "class_literal", "Lost").ref(5012, "array_callable", "$this->svc", "act").ref(5013, "array_callable", "$none", "act").ref(5014, "callable_string", "\\App\\Svc\\Real", "make").ref(5015, "callable_string", "\\App\\Svc\\Real", "none")
    c.call(5020, "$this", "go", args=["App\\Svc\\Real::make"])
    ix = R.Index(entities(spark, c))
    return ix, R.Calls(ix)


def test_every_rule_of_a_call(resolved):
    _, calls = resolved
    rows = {(r.member, r.line): r for r in calls.records.collect()}
    got = {}
    for i, name in enumerate(CASES):
        r = rows[(f"case{i}", 100 * (i + 1) + 10)]
        got[name] = (r.status, r.via, r.target_owner, r.target_member, r.type, r.hops)
    assert got == {name: want for name, (_, want) in CASES.items()}
    assert calls.records.count() == calls.ix.e.sites.count()


def test_candidates(resolved):
    _, calls = resolved
    of = {r.member: [(c.owner, c.name) for c in r.candidates] for r in calls.records.where("status IN ('ambiguous', 'dynamic')").collect()}
    names = list(CASES)
    assert of[f"case{names.index('located twice')}"] == [("App\\Svc\\Other", "only"), ("App\\Svc\\Real", "act")]
    assert of[f"case{names.index('run time')}"] == [("App\\Svc\\Other", "only")]
    assert of[f"case{names.index('computed')}"] == []
    assert of["run"] == [("App\\Svc\\Late", "step"), ("App\\Svc\\Later", "step")]


def test_properties_and_references(resolved):
    _, calls = resolved
    got = {r.line: (r.via, r.target_owner, r.target_member) for r in calls.properties().collect()}
    assert got == {5000: ("convention:entity_virtual", "App\\Model\\Entity\\Post", "_getFullName"), 5002: ("convention:magic_proxy", "App\\Svc\\Real", "getNext"), 5004: ("convention:magic_get", "App\\Svc\\Proxy", "__get")}
    got = {r.line: (r.status, r.via, r.target_owner, r.target_member) for r in calls.class_refs().collect()}
    assert got == {
        5010: ("resolved", "parser", "App\\Svc\\Real", ""),
        5011: ("unresolved", "none", None, None),
        5012: ("resolved", "convention:array_callable", "App\\Svc\\Real", "act"),
        5014: ("resolved", "convention:callable_literal", "App\\Svc\\Real", "make"),
        5015: ("unresolved", "none", None, None),
    }


def test_strings_heritage_and_imports(resolved):
    ix, calls = resolved
    said = {r.callable_member for r in calls.strings.where("callable_owner IS NOT NULL").collect()}
    assert said == {"make"}
    assert {(r.string_owner, r.string_rule) for r in calls.strings.where("string_owner IS NOT NULL").collect()} >= {("App\\Model\\Table\\UsersTable", "loader_fetchtable"), ("App\\Model\\Behavior\\TreeBehavior", "loader_addbehavior")}
    got = {(r.class_name, r.relation): (r.status, r.target_owner) for r in R.resolve_heritage(ix).collect()}
    assert got[("PostsTable", "extends")] == ("external", "Vendor\\Base") and got[("UsersTable", "extends")] == ("resolved", "App\\Model\\Table\\PostsTable") and got[("PostsController", "extends")] == ("unresolved", None)
    assert {r.alias: r.status for r in R.resolve_imports(ix).collect()} == {"Alias": "resolved", "helper": "resolved", "Lost": "unresolved"}


def test_records_feed_the_edges(resolved):
    from skein.plans import codegraph

    ix, calls = resolved
    found, candidates = R.records(ix, calls)
    files = ix.e.classes.select("repo", "path").distinct()
    edges = codegraph.method_calls(found, ix.e.members, files)
    assert edges.where("resolution = 'convention:function_fallback'").count() == 1
    assert edges.where("resolution = 'convention:entity_virtual'").count() == 1
    assert edges.where("resolution = 'convention:callable_literal'").count() >= 1
    assert candidates.where("target_path IS NULL").count() == 0


def test_nothing_to_resolve(spark):
    ix = R.Index(entities(spark, Code()))
    calls = R.Calls(ix)
    assert calls.records.count() == calls.properties().count() == calls.class_refs().count() == 0


@pytest.mark.parametrize("n", [60, 200])
def test_long_chains_are_followed_to_their_end(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "src long, dst long")
    got = graph.closure(edges)
    assert got.count() == n * (n + 1) // 2 and got.agg(F.max("distance")).first()[0] == n
    up = spark.createDataFrame([("r", f"c{i}", 0, "extends", f"c{i + 1}") for i in range(n)], "repo string, fqcn string, pos int, relation string, parent string")
    lines = resolve.lineage(up, spark.createDataFrame([("r", f"c{i}") for i in range(n + 1)], "repo string, fqcn string"))
    assert lines.count() == (n + 1) * (n + 2) // 2 and lines.where("size(trail) <> depth").count() == 0


def test_lineage_keeps_the_first_place(spark):
    up = [("r", "a", 0, "extends", "b"), ("r", "a", 1, "uses", "c"), ("r", "b", 0, "extends", "d"), ("r", "c", 0, "uses", "d"), ("r", "d", 0, "extends", "e"), ("r", "e", 0, "extends", "a"), ("r", "c", 1, "extends", "e"), ("r", "a", 2, "implements", "z")]
    lines = resolve.lineage(spark.createDataFrame(up, "repo string, fqcn string, pos int, relation string, parent string"), spark.createDataFrame([("r", x) for x in "abcdez"], "repo string, fqcn string"))
    got = {r.ancestor: (r.depth, list(r.trail)) for r in lines.where("fqcn = 'a'").collect()}
    assert got == {"a": (0, []), "b": (1, [0]), "c": (1, [1]), "d": (2, [0, 0]), "e": (2, [1, 1])}


def test_declarations_are_resolved_without_the_bodies(spark):
    """F13 F22 F10: heritage, property types and forwards read no assignment, property read or class reference."""
    e = entities(spark, code())
    want = R.resolve_heritage(R.Index(e)).collect(), R.Index(e).property_types.collect(), R.Index(e).forwarded.collect()
    e.assignments = e.reads = e.class_refs = None
    got = R.resolve_heritage(R.Index(e)).collect(), R.Index(e).property_types.collect(), R.Index(e).forwarded.collect()
    assert all(want) and [sorted(map(str, x)) for x in got] == [sorted(map(str, x)) for x in want]


def test_sites_without_a_name_in_a_literal_have_no_string_row(spark):
    """F1 F2 F3 F4: only sites that a literal gives a class or a member are written and sent to the others."""
    rows = R.string_targets(R.Index(entities(spark, code()))).collect()
    assert rows and all(r.string_owner or r.callable_owner for r in rows)
