import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skein.llm import suffix_tree
from skein.session import discard, materialize


def test_successors_cost_little_and_come_back():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 3000, 0, 0, 1, 500, 0])
    numbers = np.concatenate([np.sort(rng.choice(100_000, n, replace=False)) for n in sizes]).astype(np.int64)
    packed = suffix_tree._pack_successors(numbers, sizes)
    assert (suffix_tree._unpack_successors(packed, sizes) == numbers).all()
    assert len(packed) < 2 * len(numbers)  # five bytes each before
    assert not len(suffix_tree._unpack_successors(suffix_tree._pack_successors(numbers[:0], sizes[:1]), sizes[:1]))


def test_chunks_are_cut_by_bytes():
    texts = ["a" * 40, None, "b" * 70, "", "c" * 300, "d", "e"]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[a:b], pa.string())}) for a, b in ((0, 3), (3, 3), (3, 7))]
    got = [t.column("text").to_pylist() for t in suffix_tree._deal(iter(batches), 100)]
    assert got == [texts[:3], texts[3:5], texts[5:]]


def test_small_chunks_give_the_same_scores(docs):
    frame = docs.withColumn("held_out", F.col("doc_id") % 7 == 0)
    one, many = ({r.doc_id: r.score for r in suffix_tree.score_texts(frame, chunk_bytes=n).collect()} for n in (8 << 20, 500))
    assert one.keys() == many.keys() and all(abs(one[i] - many[i]) < 1e-6 * (1 + abs(one[i])) for i in one)


def _files(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().length()


def test_written_stages_leave_no_shuffle_files(spark):
    before = _files(spark)
    df = materialize(spark.range(1000).repartition(5), "kept")
    wait = time.time() + 20
    while _files(spark) > before and time.time() < wait:
        time.sleep(0.2)
    assert _files(spark) <= before and df.count() == 1000
    discard(df)
    assert not spark._jvm.java.io.File(df.inputFiles()[0].removeprefix("file://")).exists()
