import hashlib
import re

import numpy as np

from pyspark.sql import functions as F

from skein.llm import fingerprint, langid, toxicity


def shingles(text, k=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def test_fingerprints(docs, rows):
    out = {r.doc_id: r for r in fingerprint.edited_neighbours(docs).collect()}
    texts = [r[1] or "" for r in sorted(rows)] if all(r[0] is not None for r in rows) else None
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        near = texts[(i + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 2] + near[: len(text) // 2]
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for got, other in ((r.near_edited, edited), (r.near_next, near)):
            a, b = shingles(text), shingles(other)
            assert abs(got - (len(a & b) / len(a | b) if a and b else float(a == b))) < 0.17
    assert out[3].fingerprint == out[40].fingerprint == out[41].fingerprint
    plain = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(docs).collect()}
    assert all(plain[i] == out[i].fingerprint for i in out)


def test_fingerprints_odd(odd, nothing):
    assert fingerprint.edited_neighbours(odd).count() == odd.count()
    assert fingerprint.edited_neighbours(nothing).count() == 0
    one = fingerprint.edited_neighbours(odd.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_language(spark, nothing, odd):
    words = {"aa": "kama lota miru tesa", "bb": "schnurz grufflig zwock", "cc": "éàç ñoô ûîë"}
    rows = [(i, " ".join(words[lang].split()[(i * j) % 3] for j in range(1, 30)), lang) for i in range(90) for lang in [sorted(words)[i % 3]]]
    train = spark.createDataFrame([*rows, (None, None, "aa"), (7, "x", None)], "doc_id long, text string, lang string")
    model = langid.train(train)
    out = langid.predict(train, model).collect()
    right = {r[1]: r[2] for r in rows}
    got = langid.predict(train.where("text IS NOT NULL"), model).join(train.withColumnRenamed("lang", "want"), "doc_id").where("want = lang_pred").count()
    assert got >= 85 and right and all(0 <= r.score <= 1 for r in out)
    test = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (None, words["bb"] * 400)], "doc_id long, text string")
    by = {r.doc_id: r for r in langid.predict(test, model).collect()}
    assert [by[i].lang_pred for i in (1, 2, 3, None)] == ["und", "und", "und", "bb"]
    assert langid.train(nothing) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}


def test_toxicity(spark, docs, nothing, odd):
    rng = np.random.default_rng(2)
    common = ["".join(rng.choice(list("aeioutrnsl"), rng.integers(2, 8))) for _ in range(400)]
    rows, marks = [], []
    for i in range(400):
        w = list(rng.choice(common, 60))
        if i % 4 == 0:
            for at in rng.integers(0, 59, 4):
                w[at] = ["grumblesnarf", "wretchpile"][int(at) % 2]
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 == 0)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*[m for m in marks if m[0] % 3], (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(texts, labels)
    out = {r.doc_id: r for r in toxicity.score(texts, model).collect()}
    held = [i for i in range(400) if i % 3 == 0]
    assert np.mean([out[i].predicted == int(i % 4 == 0) for i in held]) > 0.9
    assert toxicity.reject(texts.withColumn("score", toxicity.F.lit(1)), model).count() == sum(r.predicted == 0 for r in out.values())
    assert toxicity.score(odd, model).count() == odd.count()
    assert toxicity.score(nothing, model).count() == 0
    assert {r.score for r in toxicity.score(odd, toxicity.train(nothing, labels.where("doc_id < 0"))).collect()} == {0.0}


def _long_rows(rng, n):
    """Texts of some 9,000 bytes, every fourth with toxic words in its last tenth only."""
    common = ["".join(rng.choice(list("aeioutrnsl"), rng.integers(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = list(rng.choice(common, 1600))
        if i % 4 == 0:
            for at in rng.integers(1450, 1600, 8):
                w[at] = ["grumblesnarf", "wretchpile"][int(at) % 2]
        rows.append((i, " ".join(w)))
    return rows, common


def test_toxicity_late_in_long_texts(spark):
    rng = np.random.default_rng(5)
    rows, common = _long_rows(rng, 240)
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240) if i % 3], "doc_id long, toxic int")
    model = toxicity.train(texts, labels)
    out = {r.doc_id: r.predicted for r in toxicity.score(texts, model).collect()}
    assert np.mean([out[i] == int(i % 4 == 0) for i in range(0, 240, 3)]) > 0.9
    # a clean text stays clean, and a toxic one toxic, when twenty times as long
    clean = " ".join(rng.choice(common, 30_000))
    assert model.score(clean.encode()) < 0.7 <= model.score((clean + rows[0][1]).encode())
    features = np.array([model.features(" ".join(rng.choice(common, n)).encode()) for n in (1500, 30_000)])
    assert (np.abs(features[1] - features[0]) < 3).all()


def test_toxicity_many_expressions(spark):
    """Expressions that are rarer than the most frequent one by far still mark a text."""
    rng = np.random.default_rng(8)
    word = lambda letters, n: "".join(rng.choice(list(letters), n))
    common = [word("aeioutrnsl", rng.integers(2, 8)) for _ in range(400)]
    rare = [word("bcdfghjkmpqvwxyz", 11) for _ in range(60)]
    rows = []
    for i in range(1200):
        w = list(rng.choice(common, 60))
        if i % 2 == 0:
            for at in rng.integers(0, 59, 3):
                w[at] = "grumblesnarf" if i % 4 == 0 else rare[rng.integers(60)]
        rows.append((i, " ".join(w)))
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(1200) if i % 3], "doc_id long, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    got = {i: model.score(t.encode()) >= 0.7 for i, t in rows if i % 3 == 0}
    assert np.mean([got[i] for i in got if i % 4 == 2]) > 0.8
    assert np.mean([got[i] for i in got if i % 2]) < 0.1
    assert len(model.toxic) - len(model.ordinary) > 500


def test_rejecting_sends_each_text_once(spark):
    model = toxicity.CompressionClassifier(b"", b"")
    model.constant = 0.0
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    out = toxicity.reject(docs, model)
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, None)]
    assert "_scored_" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert toxicity.reject(docs.withColumn("text", F.col("doc_id")), model).count() == 2  # a text of another kind is cast aside
