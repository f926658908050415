from skein.llm import minhash


def test_band_entries_are_dealt_once(spark, docs, monkeypatch):
    plans, write = {}, minhash.materialize

    def seen(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, *rest)

    monkeypatch.setattr(minhash, "materialize", seen)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = minhash.near_documents(docs, k=2)
    finally:
        spark.conf.set(key, before)
    assert out.where("component_id < doc_id").count() > 0
    assert plans["buckets"].count("hashpartitioning(key") == 1  # shared keys and the entries that have them come from one shuffle
    assert plans["mixed"].count("hashpartitioning(key") == 1
