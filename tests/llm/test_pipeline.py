import re
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from skein.llm import toxicity
from tests.llm.conftest import SCHEMA, sample_rows
from tests.llm.test_dedup import brute_lines, brute_repeats, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Sample documents, some of them toxic, with labels."""
    rng = np.random.default_rng(9)
    rows = sample_rows()
    plain = ["".join(rng.choice(list("bcdfgaeiou"), 5)) for _ in range(300)]
    marks = []
    for i in range(200, 440):
        w = list(rng.choice(plain, 50))
        if i % 4 == 0:
            for at in rng.integers(0, 50, 5):
                w[at] = ["grumblesnarf", "wretchpile", "oafbucket"][int(at) % 3]
        rows.append((i, " ".join(w) + ".", "en", None, 7, None, None))
        marks.append((i, 1, int(i % 4 == 0)))
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([*marks, (None, None, None), (3, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == columns

    before, after = held["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert {r.doc_id for r in after} == {i for i, r in before.items() if model.score((r.text or "").encode()) < 0.7}
    gone = before.keys() - {r.doc_id for r in after}
    assert sum(i >= 200 and i % 4 == 0 for i in gone) >= 50 and sum(i >= 200 and i % 4 != 0 for i in gone) <= 2

    before, after = held["line_dedup"]
    want = brute_lines([(i, r.text) for i, r in before.items()])
    assert {r.doc_id: r.text for r in after} == {i: w[2] for i, w in want.items()}
    assert all(r.n_chars == len(r.text) and r.lang == before[r.doc_id].lang for r in after)

    before, after = held["minhash_dedup"]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, r in before.items() for w in [words(r.text)]}
    kept = {r.doc_id for r in after}
    near = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert all(not near(a, b) for a in kept for b in kept if a < b)
    assert all(any(near(a, b) for b in sets if b != a) for a in sets.keys() - kept)

    before, after = held["suffix_dedup"]
    want = brute_repeats([(i, r.text) for i, r in before.items()], 50)
    assert {r.doc_id: r.text for r in after} == {i: w[3].decode(errors="ignore") for i, w in want.items()}

    before, after = held["packing"]
    real, pieces, bins = Tokenizer.from_file(P.path("byte_bpe_50k.json")), defaultdict(int), defaultdict(int)
    for r in after:
        pieces[r.doc_id] += r.length
        bins[r.sequence_id] += r.length
    assert dict(pieces) == {i: len(real.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in before.items()}
    assert max(bins.values()) <= 1024 and len(bins) <= sum(bins.values()) / 1024 * 1.05 + 1


def test_run_and_empty(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert re.match("toxicity", corpus_pipeline.STAGES[0][0])


def test_clashing_column_names(spark):
    """Columns of any name pass the stages that keep rows."""
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "a", "b"), (2, text, "c", "d"), (3, None, None, None)], "doc_id long, text string, _text string, _gone string")
    model = type("Never", (), {"score": staticmethod(lambda raw: 0.0)})()
    kept = corpus_pipeline.toxicity.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3
    left = corpus_pipeline.drop_near_documents(spark, docs, "")
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]
