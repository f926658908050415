"""The corpus pipeline: toxicity, line dedup, near-duplicate documents, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on every document that the one
before it kept, and returns a DataFrame; all but the last return the columns of
documents, with n_chars counting the text that is left. Empty tables pass
through every stage; null texts count as empty; other columns may be null.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import lines, minhash, packing, repeats, toxicity
from skein.session import materialize, prepare

#: No SQL: compression lengths, tokenisation and best-fit packing have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def _as_documents(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """An operator's rows (doc_id, text, row) as rows with the columns of docs."""
    have = {"doc_id": F.col("doc_id"), "text": F.col(text), "n_chars": F.length(text).cast("long")}
    return changed.select(*[have.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the classifier learns from the labelled documents."""
    model = toxicity.train(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line resembles; a document without lines left stays, empty."""
    prepare(spark)
    return _as_documents(docs, lines.drop_near_lines(docs), "kept")


def drop_near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least doc_id, of each group of near-duplicates; all documents without words or id."""
    prepare(spark)
    found = minhash.near_documents(docs, k=5)
    gone = materialize(found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 bytes and more that a document of smaller id holds."""
    prepare(spark)
    return _as_documents(docs, repeats.remove_repeats(docs, as_text=True), "kept")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces placed in sequences of at most 1024 tokens."""
    prepare(spark)
    pieces = packing.tokenized_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), cache_words=200_000)  # workers keep it beside what other stages need
    return packing.pack(pieces, max_tokens=1024)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("minhash_dedup", drop_near_documents), ("suffix_dedup", drop_passages), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
