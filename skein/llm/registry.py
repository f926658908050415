"""Queries and SQL of the training-data operators, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import bpe, embeddings, fingerprint, hard_negatives, langid, lines, minhash, oracle, packing, repeats, secrets, suffix_tree, toxicity, vector_codes
from skein.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces, max_tokens=1024)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _held_out(fold: int, folds: int):
    """Whether crc32 of the id as text falls into one fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint.edited_neighbours(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")})


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~_held_out(1, 3)))
    return toxicity.score(docs, model).select("doc_id", _held_out(1, 3).alias("held_out"), "score", "predicted")


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", _held_out(0, 10).alias("held_out"))
    return suffix_tree.score_texts(docs)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_near_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~_held_out(2, 4)))
    return langid.predict(docs, model).select("doc_id", _held_out(2, 4).alias("held_out"), "lang_pred", "score")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_documents(table(spark, sf_dir, "documents"), k=2)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    counts = [secrets.count_of("spans", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.as_text("spans", secrets.BASE), 256).alias("base_sha256"), secrets.as_text("spans").alias("spans"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_embeddings": op1_embeddings, "op2_packing": op2_packing, "op3_fingerprints": op3_fingerprints, "op4_bpe": op4_bpe, "op5_toxicity": op5_toxicity, "op6_lm": op6_lm, "op7_lines": op7_lines, "op8_langid": op8_langid, "op9_repeats": op9_repeats, "op10_minhash": op10_minhash, "op11_secrets": op11_secrets, "op12_negatives": op12_negatives, "op13_codes": op13_codes, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_embeddings": oracle.OP1, "op7_lines": oracle.OP7, "op9_repeats": oracle.OP9, "op10_minhash": oracle.OP10, "op11_secrets": secrets.sql(), "op12_negatives": oracle.OP12, "op13_codes": vector_codes.sql()}
