from skein.plans import crossref


def test_rows_meet_the_aliases_of_their_file_once(spark):
    texts = ["Foo", "foo\\Bar", "\\Abs\\X", "namespace\\Y", "Plain", "", None]
    rows = spark.createDataFrame([("r", "p", "N", t) for t in texts], "repo string, path string, namespace string, text string")
    uses = spark.createDataFrame([("r", "p", "Foo", "Lib\\Foo", 1), ("r", "p", "foo", "Lib\\Later", 2), ("r", "q", "Plain", "No", 1)], "repo string, path string, alias string, fqcn string, ord int")
    out = crossref.candidate_names(rows, uses)
    assert {r.text: (r.strict, r.candidates) for r in out.collect()} == {
        "Foo": ("Lib\\Later", ["Lib\\Later"]),
        "foo\\Bar": ("Lib\\Later\\Bar", ["Lib\\Later\\Bar"]),
        "\\Abs\\X": ("Abs\\X", ["Abs\\X"]),
        "namespace\\Y": ("N\\Y", ["N\\Y"]),
        "Plain": ("N\\Plain", ["N\\Plain", "Plain"]),
        "": ("", [""]),
        None: ("", ["", None]),
    }
    assert set(out.columns) == {"repo", "path", "namespace", "text", "strict", "candidates"}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
