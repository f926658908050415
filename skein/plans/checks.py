"""Question checks and accuracy scores over a graph, answered for all questions by joins; no answer set is collected."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbours(edges: DataFrame, names: DataFrame, subject: str = "src") -> DataFrame:
    """Rows (subject, answers): lower-cased names of the nodes on the other end, sorted and distinct."""
    other = "dst" if subject == "src" else "src"
    a = names.select(F.col("id").alias(subject), F.lower("name").alias("subject"))
    b = names.select(F.col("id").alias(other), F.lower("name").alias("answer"))
    return edges.join(a, subject).join(b, other).groupBy("subject").agg(F.array_sort(F.collect_set("answer")).alias("answers"))


def match_modes(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """questions (question_id, subject, expected array, mode) with passed, for answer sets that are small.

    contains_all, exact_set and its other name equals, or count_at_least (one, where expected names no number).
    """
    q = questions.withColumn("subject", F.lower("subject")).withColumn("expected", F.array_sort(F.array_distinct(F.transform("expected", lambda x: F.lower(x)))))
    got = F.coalesce("answers", F.array().cast("array<string>"))
    passed = (
        F.when(F.col("mode").isin("exact_set", "equals"), F.col("expected") == got)
        .when(F.col("mode") == "count_at_least", F.size(got) >= F.coalesce(F.try_element_at("expected", F.lit(1)).cast("int"), F.lit(1)))
        .otherwise(F.size(F.array_except("expected", got)) == 0)
    )
    return q.join(answers, "subject", "left").withColumn("passed", F.coalesce(passed, F.lit(False)))


def scores(cases: DataFrame, category: str, right: str) -> DataFrame:
    """Per category: cases, right ones and percent right (two digits)."""
    return cases.groupBy(category).agg(F.count("*").alias("cases"), F.sum(F.col(right).cast("int")).cast("long").alias("correct")).withColumn("percent", F.round(F.col("correct") * 100.0 / F.col("cases"), 2))


_CALL, _HEIR, _IMPORT = ("caller_method", "callee_method"), ("child_class", "parent_class"), ("source_file", "target")
#: Questions along one edge: edge table, its ends, node table, key and name, and whether the edge is read backwards.
HOPS = {
    "callees_of": ("MethodCalls", _CALL, "Methods", "method_id", "fqmn", False),
    "possibly_callees_of": ("PossiblyCalls", _CALL, "Methods", "method_id", "fqmn", False),
    "callers_of": ("MethodCalls", _CALL, "Methods", "method_id", "fqmn", True),
    "parents_of": ("ClassInherits", _HEIR, "Classes", "class_id", "fqcn", False),
    "children_of": ("ClassInherits", _HEIR, "Classes", "class_id", "fqcn", True),
    "imports_of": ("FileImports", _IMPORT, "Files", "file_id", "path", False),
}
TYPES = [*HOPS, "methods_of", "class_file", "class_table", "table_columns", "table_fks", "node_exists", "count_at_least"]


def facts(nodes: Mapping[str, DataFrame], edges: Mapping[str, DataFrame], types: list[str] | None = None) -> DataFrame:
    """Rows (type, subject, answer): everything that questions of the types can be answered with, one row per edge.

    nodes: Methods, Classes, Files and DbTables, with columns (table_name, name)
    of tables under Columns; edges by table name. Tables that no type needs are
    not looked up. Subjects are in lower case but for table names, answers as
    they are.
    """
    return reduce(DataFrame.unionByName, [_facts(kind, nodes, edges) for kind in types or TYPES])


def _facts(kind: str, nodes: Mapping[str, DataFrame], edges: Mapping[str, DataFrame]) -> DataFrame:
    def rows(df: DataFrame, subject: Column, answer: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("type"), subject.alias("subject"), answer.alias("answer"))

    def classes() -> DataFrame:
        return nodes["Classes"].select("class_id", "fqcn", "file_id").where("fqcn <> ''")

    def tables(key: str, name: str) -> DataFrame:
        return nodes["DbTables"].select(F.col("table_id").alias(key), F.col("name").alias(name))

    if kind in HOPS:
        table, ends, frame, key, name, back = HOPS[kind]
        a, b = reversed(ends) if back else ends
        named = nodes[frame].where(F.col(name) != "")
        left, right = named.select(F.col(key).alias(a), F.lower(name).alias("subject")), named.select(F.col(key).alias(b), F.col(name).alias("answer"))
        return rows(edges[table].select(*ends).join(left, a).join(right, b), F.col("subject"), F.col("answer"))
    if kind == "methods_of":
        return rows(nodes["Methods"].select("class_id", "fqmn").join(classes(), "class_id"), F.lower("fqcn"), F.substring_index("fqmn", "::", -1))
    if kind == "class_file":
        return rows(classes().join(nodes["Files"].select("file_id", "path"), "file_id"), F.lower("fqcn"), F.col("path"))
    if kind == "class_table":
        return rows(edges["ClassMapsToTable"].join(classes(), "class_id").join(tables("table_id", "table_name"), "table_id"), F.lower("fqcn"), F.col("table_name"))
    if kind == "table_columns":
        return rows(nodes["Columns"], F.col("table_name"), F.col("name"))
    if kind == "table_fks":
        met = edges["TableReferences"].join(tables("source_table", "_from"), "source_table").join(tables("target_table", "_to"), "target_table")
        return rows(met, F.col("_from"), F.concat("fk_column", F.lit("->"), "_to"))
    if kind == "node_exists":
        return rows(nodes["Methods"].select(F.lower("fqmn").alias("x")).union(classes().select(F.lower("fqcn"))).distinct(), F.col("x"), F.lit("exists"))
    counted = [rows(edges[table], F.lit(table.lower()), F.lit("row")) for table in ("MethodCalls", "PossiblyCalls", "ClassInherits")]
    return reduce(DataFrame.unionByName, counted)


def grade(questions: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (question_id, type, subject, mode, n_actual, passed).

    questions are rows (question_id, type, subject, mode, at_least, expected),
    one per expected answer (null where none is expected). node_exists ignores
    the mode; count_at_least counts rows, all others compare sets without case.
    A hot subject is aggregated by key before anything is joined.
    """
    folded = F.when(F.col("type").isin("table_columns", "table_fks"), F.col("subject")).otherwise(F.lower("subject"))
    q = questions.withColumn("key", folded).withColumn("want", F.lower("expected")).drop("expected").distinct()
    rows = known.groupBy("type", F.col("subject").alias("key"), F.lower("answer").alias("want")).agg(F.count("*").alias("times"))
    total = rows.groupBy("type", "key").agg(F.sum("times").alias("n_actual"), F.count("*").alias("n_distinct"))
    found = q.join(rows, ["type", "key", "want"], "left").groupBy("question_id", "type", "subject", "key", "mode", "at_least").agg(F.count("want").alias("n_want"), F.count("times").alias("n_hit"))
    out = found.join(total, ["type", "key"], "left").na.fill(0, ["n_actual", "n_distinct"])
    all_there = F.col("n_hit") == F.col("n_want")
    passed = (
        F.when(F.col("type") == "node_exists", F.col("n_actual") > 0)
        .when((F.col("type") == "count_at_least") | (F.col("mode") == "count_at_least"), F.col("n_actual") >= F.coalesce("at_least", F.lit(1)))
        .when((F.col("type") == "table_columns") & (F.col("n_actual") == 0), F.lit(False))
        .when(F.col("mode").isin("exact_set", "equals"), all_there & (F.col("n_distinct") == F.col("n_want")))
        .otherwise(all_there)
    )
    return out.select("question_id", "type", "subject", "mode", "n_actual", passed.alias("passed"))


# accuracy against cases with known answers


def _tier() -> Column:
    """How well a record's list and site kind fit a case; null where they do not."""
    kind, section, site = F.col("kind"), F.col("section"), F.col("site_kind")
    calls = section == "calls"
    fits = ((kind == "method_call") & site.isin("method", "nullsafe")) | ((kind == "static_call") & (site == "static")) | ((kind == "function_call") & (site == "function")) | ((kind == "new_object") & (site == "new"))
    return (
        F.when(kind == "property_access", F.when(section == "props", 0).when(calls, 1))
        .when(kind == "class_ref", F.when(calls & F.col("string_answer").isNotNull(), 0).when(section == "class_refs", 1))
        .when(kind == "callable_ref", F.when(section == "class_refs", 0).when(calls & F.col("callable_answer").isNotNull(), 1).when(calls, 2))
        .otherwise(F.when(calls & fits, 0).when(calls, 1))
    )


def match_records(cases: DataFrame, records: DataFrame) -> DataFrame:
    """Each case (case_id, repo, path, line, span_start, span_end, kind, ..) with the record of its line that stands for it.

    records have section, site_kind, line, col, status, target_answer,
    string_answer, callable_answer and ord. A record of the fitting kind comes
    before any other, one within the span before one outside, then the leftmost.
    Cases without a record are kept, with nulls.
    """
    met = cases.join(records, ["repo", "path", "line"]).withColumn("tier", _tier()).where("tier IS NOT NULL")
    outside = ~F.col("col").between(F.col("span_start"), F.col("span_end"))
    fields = ["section", "ord", "status", "target_answer", "string_answer", "callable_answer", "made_edge"]
    best = met.groupBy("case_id").agg(F.min(F.struct("tier", outside.alias("outside"), "col", *fields)).alias("b"))
    return cases.join(best.select("case_id", *[F.col(f"b.{c}").alias(c) for c in fields]), "case_id", "left")


def answer() -> Column:
    """The answer a matched record gives to its case."""
    status = F.when(F.col("status") == "ambiguous", "AMBIGUOUS").when(F.col("status") == "dynamic", "DYNAMIC").otherwise(F.coalesce("target_answer", F.lit("")))
    return F.when(F.col("kind") == "class_ref", F.coalesce("string_answer", "target_answer", F.lit(""))).when((F.col("kind") == "callable_ref") & F.col("callable_answer").isNotNull(), F.col("callable_answer")).otherwise(status)


def score_cases(matched: DataFrame, offered: DataFrame, allowed: DataFrame) -> DataFrame:
    """matched with answer and correct.

    offered are the candidates of records (repo, path, section, ord, target),
    allowed those of cases (case_id, target). An expected AMBIGUOUS or DYNAMIC
    is right when the record says so and offers nothing beyond the allowed.
    """
    rows = matched.withColumn("answer", F.when(F.col("status").isNotNull(), answer()))
    mine = rows.join(offered.where("target <> ''").select("repo", "path", "section", "ord", F.lower("target").alias("target")).distinct(), ["repo", "path", "section", "ord"])
    extra = mine.join(allowed.select("case_id", F.lower("target").alias("target")), ["case_id", "target"], "left_anti").groupBy("case_id").agg(F.count("*").alias("extra"))
    exact = F.lower("answer") == F.lower("expected")
    open_case = F.col("expected").isin("AMBIGUOUS", "DYNAMIC")
    right = F.when(open_case, (F.col("answer") == F.col("expected")) & F.col("extra").isNull()).otherwise(exact)
    return rows.join(extra, "case_id", "left").withColumn("correct", F.coalesce(right, F.lit(False))).drop("extra")


_EDGE_KINDS = ["method_call", "static_call", "function_call", "callable_ref", "property_access", "new_object"]


def wrong_edges(matched: DataFrame) -> DataFrame:
    """Cases (case_id, expected, edge_to) whose record made an edge that the expected answer rules out; must be none."""
    made = F.when((F.col("kind") == "callable_ref") & F.col("callable_answer").isNotNull(), F.col("callable_answer")).when((F.col("status") == "resolved") & F.col("made_edge"), F.col("target_answer"))
    rows = matched.where(F.col("kind").isin(_EDGE_KINDS)).withColumn("edge_to", made).where("edge_to IS NOT NULL")
    return rows.where(F.col("expected").isin("AMBIGUOUS", "DYNAMIC") | (F.lower("edge_to") != F.lower("expected"))).select("case_id", "expected", "edge_to")


def coverage(cases: DataFrame, entities: DataFrame, listed: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows (case_id, covered).

    entities are rows (repo, path, name) of all qualified names that a file
    declares, listed are rows (repo, path, start_line, end_line, callee) of the
    methods and what they call (callee null where nothing). A case is covered
    when defined_in declares the expected name (for AMBIGUOUS and DYNAMIC, all
    allowed names) and, for calls inside a method, that method lists the callee.
    """
    there = entities.select(F.col("repo"), F.col("path").alias("defined_in"), F.lower("name").alias("name")).distinct().withColumn("declared", F.lit(True))
    definite = cases.where(~F.col("expected").isin("AMBIGUOUS", "DYNAMIC"))
    one = definite.withColumn("name", F.lower("expected")).join(there, ["repo", "defined_in", "name"], "left")
    callee = F.substring_index(F.substring_index("expected", "::", -1), "\\", -1)
    calls = definite.where(F.col("kind").isin("method_call", "static_call", "function_call")).select("case_id", "repo", "path", "line", callee.alias("wanted"))
    inside = calls.join(listed, ["repo", "path"]).where("line BETWEEN start_line AND end_line").groupBy("case_id").agg(F.max(F.coalesce(F.col("callee") == F.col("wanted"), F.lit(False))).alias("lists"))
    one = one.join(inside, "case_id", "left").select("case_id", (F.coalesce("declared", F.lit(False)) & F.coalesce("lists", F.lit(True))).alias("covered"))
    several = cases.where(F.col("expected").isin("AMBIGUOUS", "DYNAMIC")).select("case_id", "repo").join(allowed.select("case_id", "defined_in", F.lower("target").alias("name")), "case_id", "left")
    several = several.join(there, ["repo", "defined_in", "name"], "left").groupBy("case_id").agg(F.min(F.col("name").isNull() | F.coalesce("declared", F.lit(False))).alias("covered"))
    return one.unionByName(several)


def gate(scored: DataFrame, covered: DataFrame, wrong: DataFrame, least: float = 85.0) -> DataFrame:
    """One row: percent correct, percent covered, number of wrong edges, and whether all pass the gate."""
    percent = lambda df, c, name: df.agg(F.round(F.avg(F.col(c).cast("int")) * 100, 2).alias(name))
    row = percent(scored, "correct", "accuracy").crossJoin(percent(covered, "covered", "coverage")).crossJoin(wrong.agg(F.count("*").alias("wrong_edges")))
    return row.withColumn("passed", F.coalesce((F.col("accuracy") >= least) & (F.col("coverage") >= least), F.lit(False)) & (F.col("wrong_edges") == 0))


#: Where a text's lines end.
LINE_END = "\\r\\n|[\\n\\r\\x0B\\f\\x1C-\\x1E\\x85\\u2028\\u2029]"


def expression_positions(cases: DataFrame, texts: DataFrame) -> DataFrame:
    """cases (case_id, repo, path, expr, occurrence) with line, span_start and span_end of the occurrence-th place of expr in texts (repo, path, text).

    Occurrences are counted line by line without overlaps; within the line that
    reaches the count, places may overlap. Lines count from 1, spans from 0, end
    exclusive. All three are null without a text or so many occurrences, for an
    occurrence below 1 and for an empty or null expression. Only lines that hold
    an expression are counted up, so a long file costs its matches.
    """
    wanted = cases.where("expr <> '' AND occurrence >= 1").select("repo", "path", "expr").distinct()
    lines = wanted.join(texts.where("text IS NOT NULL"), ["repo", "path"]).select("repo", "path", "expr", F.posexplode(F.split("text", LINE_END)).alias("no", "content"))
    lines = lines.where(F.expr("contains(content, expr)"))
    n = ((F.length("content") - F.length(F.replace(F.col("content"), F.col("expr")))) / F.length("expr")).cast("long")
    upto = F.sum("n").over(Window.partitionBy("repo", "path", "expr").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = lines.withColumn("n", n).withColumn("upto", upto)
    met = cases.join(counted, ["repo", "path", "expr"]).where("occurrence > upto - n AND occurrence <= upto")
    starts = F.filter(F.sequence(F.lit(1), F.length("content") - F.length("expr") + 1), lambda p: F.substring(F.col("content"), p, F.length("expr")) == F.col("expr"))
    start = F.element_at(starts, (F.col("occurrence") - F.col("upto") + F.col("n")).cast("int")) - 1
    found = met.select("case_id", (F.col("no") + 1).alias("line"), start.alias("span_start"), (start + F.length("expr")).alias("span_end"))
    return cases.select("case_id").join(found, "case_id", "left")
