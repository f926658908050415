"""The frames that Spark builds from numbers have the rows of the SQL that both engines share, and move little."""

import pytest

from skein import graph_queries as G


@pytest.fixture
def tables(spark):
    nation = spark.createDataFrame([(i, f"NATION_{i}", i % 3) for i in range(6)], "n_nationkey int, n_name string, n_regionkey int")
    supplier = spark.createDataFrame([(i, f"Supplier{i}", i % 7) for i in range(14)], "s_suppkey long, s_name string, s_nationkey int")  # nation 6 does not exist
    part = spark.createDataFrame([(i, i % 11) for i in range(60)], "p_partkey long, p_size int")
    rows = [(i // 4, (i * i + i // 7) % 66, i % 14, i % 4 + 1) for i in range(600)]  # parts 60 to 65 do not exist
    lineitem = spark.createDataFrame(rows + rows[:50], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
    return {"nation": nation, "supplier": supplier, "part": part, "lineitem": lineitem}.__getitem__


@pytest.mark.parametrize("name", ["members", "sites", "candidates", "records", "evidence"])
def test_frames_have_the_rows_of_the_sql(tables, name):
    want, got = G.frame(tables, name, G.BIND), G.frame(tables, name)
    assert got.dtypes == want.dtypes
    assert want.count() > 0
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_sites_shuffle_lines_twice(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.frame(tables, "sites")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # lines by part and by order; the others are those of part, supplier and nation
    assert plan.count("Exchange hashpartitioning") <= 7


@pytest.mark.parametrize("name", ["r_declared", "r_spots", "r_located"])
def test_resolution_frames_have_the_rows_of_the_sql(tables, name):
    from skein import resolution_queries as Q

    want, got = G.frame(tables, name, G.BIND), G.frame(tables, name, G.BIND | Q._NARROW)
    assert [c for c, _ in got.dtypes] == [c for c, _ in want.dtypes]
    assert want.count() > 0
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_spots_shuffle_lines_once(spark, tables):
    from skein import resolution_queries as Q

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.frame({**{x: tables(x) for x in ("supplier", "nation", "part", "lineitem")}}.__getitem__, "r_lines", G.BIND | Q._NARROW)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(pk") == 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize("name", ["aimed", "uses", "refs", "tokens", "typed"])
def test_cross_frames_have_the_rows_of_the_sql(tables, name):
    """F7 F11 F19 F25: the frames that are written once and read from there."""
    from skein import cross_queries as C

    want, got = G.frame(tables, name, G.BIND), C._once(tables)(tables, name)
    got = got.select(want.columns)
    assert want.count() > 0
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_imports_under_one_alias_are_not_compared(spark):
    """a name under two aliases gives one edge; the rows of names under one alias are not shuffled once more."""
    from skein.plans import crossref as X

    uses = spark.createDataFrame([("a", "f", "X", "N\\One", 1), ("a", "f", "Y", "n\\one", 2), ("a", "f", "Z", "N\\Two", 3), ("a", "f", "W", "N\\Own", 4)], "repo string, path string, alias string, fqcn string, ord long")
    known = spark.createDataFrame([("n\\one", "b", "N\\One", "c1"), ("n\\two", "b", "N\\Two", "c2"), ("n\\own", "a", "N\\Own", "c3")], "norm_fqcn string, repo string, fqcn string, class_id string")
    mentions = spark.createDataFrame([("a", "f", "k1", "x"), ("a", "f", "k1", "y"), ("a", "f", "k2", "y")], "repo string, path string, class_id string, token string")
    holders = spark.createDataFrame([("a", "f", "k1"), ("a", "f", "k3")], "repo string, path string, class_id string")
    edges = X.import_refs(uses, mentions, holders, known)
    assert sorted((r.source_class, r.target_class) for r in edges.collect()) == [("k1", "c1"), ("k1", "c2"), ("k2", "c1"), ("k3", "c2")]
    plan = edges._jdf.queryExecution().optimizedPlan().toString().lstrip()
    assert "Union" in plan and plan.index("Union") < plan.index("Aggregate")


def test_sites_are_not_sorted_for_lookups_of_their_file(spark):
    """F1 F2 F3 F4: what a text means in a file is hashed; the rows that ask keep their places and are not sorted."""
    from types import SimpleNamespace

    from skein.plans import resolution as R

    ix = R.Index(SimpleNamespace())
    ix.texts = spark.createDataFrame([("r", "f", "n", "X", "n\\x")], "repo string, path string, namespace string, text string, key string")
    rows = spark.createDataFrame([("r", "f", "n", "X", 1), ("r", "f", "n", "Y", 2)], "repo string, path string, namespace string, text string, ord long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = ix.meaning(rows.repartition(*R.FILE), "text", key="meant")
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "Sort " not in plan
    assert sorted((r.ord, r.meant) for r in met.collect()) == [(1, "n\\x"), (2, None)]


def test_sites_without_literals_are_not_shuffled(spark):
    """F1 F2 F3 F4: records meet what their literals name; the others stay where they are and have nulls."""
    from skein.plans import resolution as R

    calls = R.Calls.__new__(R.Calls)
    strings = spark.createDataFrame([("r", "f", 1, "A")], "repo string, path string, ord long, string_owner string")
    records = spark.createDataFrame([("r", "f", 1, True), ("r", "f", 2, True), ("r", "f", 3, False)], "repo string, path string, ord long, literal boolean")
    met = calls.told(records, strings)
    assert sorted((r.ord, r.string_owner or "") for r in met.collect()) == [(1, "A"), (2, ""), (3, "")]
    plan = met._jdf.queryExecution().optimizedPlan().toString().lstrip()
    assert plan.startswith("Union")


def test_candidates_read_lines_once(tables):
    """F5 F6 F7 F8: the other lines of a site's order stand beside it; lines are not joined with themselves."""
    plan = G.frame(tables, "candidates")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD [l_orderkey") == 1


@pytest.mark.parametrize("query, asks", [("edg_possibly_calls", 1), ("edg_resolution_stats", 2), ("qa_possibly_callees_of", 1), ("qa_count_at_least", 3)])
def test_members_are_asked_once(tables, monkeypatch, query, asks):
    """F5 F6 F7 F8: callers and candidates are told together (method calls ask twice more), and lines are written once."""
    from skein.plans import codegraph

    index, written, kept = [], [], G.materialize
    monkeypatch.setattr(codegraph, "method_index", lambda *a, made=codegraph.method_index: index.append(1) or made(*a))
    monkeypatch.setattr(G, "materialize", lambda df, name: written.append(name) or kept(df, name))
    if query == "edg_possibly_calls":
        G.edg_possibly_calls(tables)
    elif query == "edg_resolution_stats":
        G.edg_resolution_stats(tables)
    else:
        G.checks.facts(*G._graph(tables), [query[3:]])
    assert len(index) == asks and written.count("order_lines") == 1 and written.count("members") == 1
