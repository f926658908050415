"""Inputs of directory and topic summaries, and texts to embed: joins and aggregates around a pluggable writer."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.names import origin, truncate
from skein.operators.relational import first_wins
from skein.session import materialize


def topic_inputs(files: DataFrame, each: int = 300) -> DataFrame:
    """Per top directory: how many file summaries its topics are drawn from, and their characters, cut to `each`."""
    top = F.substring_index("path", "/", 1)
    return files.where("summary IS NOT NULL").groupBy(top.alias("top")).agg(F.sum(F.least(F.length("summary"), F.lit(each))).cast("long").alias("chars"), F.count("*").alias("files"))


def directory_inputs(files: DataFrame, each: int = 1500) -> DataFrame:
    """Per directory below the root: files in it at any depth, and the characters of their summaries, cut to `each`.

    Each file adds one row per ancestor, summed before the shuffle, so a
    directory's summaries never meet in one task.
    """
    parts = F.split("path", "/")
    rows = files.select(F.length("summary").alias("n"), parts.alias("p"), F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("depth"))
    return rows.groupBy(F.array_join(F.slice("p", F.lit(1), F.col("depth")), "/").alias("dir"), "depth").agg(F.sum(F.least("n", F.lit(each))).cast("long").alias("chars"), F.count("*").alias("files"))


def bounded_concat(rows: DataFrame, keys: list[str], order: list[Column], text: str, separator: str, limit: int) -> DataFrame:
    """keys with text: the rows' texts in order, joined, cut to limit characters.

    Running lengths decide first which rows lie within the limit; only those
    are gathered, so a group costs the limit and not its rows.
    """
    before = F.sum(F.length(text) + len(separator)).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.select(*keys, F.coalesce(before, F.lit(0)).alias("_at"), F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_no"), F.substring(text, 1, limit).alias("_text")).where(F.col("_at") < limit + len(separator))  # a text that starts beyond the limit still brings its separator
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_no", "_text"))), lambda x: x["_text"]), separator)
    return placed.groupBy(*keys).agg(F.substring(joined, 1, limit).alias(text))


def directory_texts(files: DataFrame, summarize, each: int = 1500, limit: int = 200_000) -> DataFrame:
    """Rows (repo, dir, depth, text, summary) of every directory, deepest level first, from files (repo, path, summary).

    A directory's text lists its files, then its subdirectories, each as
    '**name**: summary' with the summary cut to `each`; its own summary is
    summarize(text), a column expression, and goes into its parent's text. The
    root is ''. Files and directories without a summary are left out, and so
    are directories with nothing to list. One job a level; every level is
    written, so an executor that is lost costs one.
    """
    parts = F.split("path", "/")
    rows = files.where("summary <> ''").select("repo", F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/").alias("dir"), F.size(parts).alias("level"), F.lit(0).alias("kind"), F.element_at(parts, -1).alias("name"), "summary")
    rows = materialize(rows, "summaries")
    deepest = rows.agg(F.max("level")).first()[0] or 0
    done, below = None, None
    for level in range(deepest, 0, -1):
        here = rows.where(F.col("level") == level)
        here = here if below is None else here.unionByName(below)
        line = F.concat(F.lit("**"), "name", F.lit("**: "), truncate(F.col("summary"), each))
        text = bounded_concat(here.withColumn("text", line), ["repo", "dir"], [F.col("kind"), F.col("name")], "text", "\n\n", limit)
        text = materialize(text.select("repo", "dir", F.lit(level - 1).alias("depth"), "text", summarize(F.col("text")).alias("summary")), "directories")
        done = text if done is None else done.unionByName(text)
        up = F.split("dir", "/")
        below = text.where("dir <> '' AND summary <> ''").select("repo", F.array_join(F.slice(up, F.lit(1), F.size(up) - 1), "/").alias("dir"), F.lit(level - 1).alias("level"), F.lit(1).alias("kind"), F.element_at(up, -1).alias("name"), "summary")
    return done if done is not None else rows.select("repo", "dir", F.lit(0).alias("depth"), F.col("summary").alias("text"), "summary")


def topic_chunks(files: DataFrame, each: int = 300, limit: int = 200_000) -> DataFrame:
    """Rows (repo, top, text): what the topics of each top directory are drawn from, files (repo, path, summary) in order of their paths.

    Every file is '**name**: ' and the first `each` characters of its summary;
    beyond limit characters a text ends with a mark. Files at the root count
    only where a repository has no directory with summaries; top is '' then.
    """
    rows = files.where("summary <> ''").select("repo", "path", F.when(F.col("path").contains("/"), F.substring_index("path", "/", 1)).otherwise("").alias("top"), F.concat(F.lit("**"), F.substring_index("path", "/", -1), F.lit("**: "), F.substring("summary", 1, each)).alias("text"))
    below = rows.where("top <> ''").select("repo").distinct().withColumn("below", F.lit(True))
    rows = rows.join(below, "repo", "left").where("top <> '' OR below IS NULL").drop("below")
    whole = rows.groupBy("repo", "top").agg((F.sum(F.length("text") + 2) - 2).alias("chars"))
    text = bounded_concat(rows, ["repo", "top"], [F.col("path")], "text", "\n\n", limit).join(whole, ["repo", "top"])
    return text.select("repo", "top", F.when(F.col("chars") > limit, F.concat("text", F.lit("\n\n... [TRUNCATED]"))).otherwise(F.col("text")).alias("text"))


def merged_topics(found: DataFrame, most: int = 15) -> DataFrame:
    """found (repo, ord, name, ..) of all chunks: each name once, the first by ord; where more than `most` were found, the first `most` names."""
    named = found.where("name <> ''")
    first = first_wins(named, ["repo", "name"], [F.col("ord")])
    many = found.groupBy("repo").agg(F.count("*").alias("found"))
    ranked = first.join(many, "repo").withColumn("place", F.row_number().over(Window.partitionBy("repo").orderBy("ord", "name")))
    return ranked.where((F.col("found") <= most) | (F.col("place") <= most)).drop("found")


def topic_prompts(linked: DataFrame, files: DataFrame, each: int = 15_000, limit: int = 200_000, short: int = 500) -> DataFrame:
    """Rows (topic, contents, summaries) from linked (topic, name) and files (ord, path, text, summary).

    Names are base names and mean the first file that bears them. Contents hold
    '### name' and the text's first `each` characters in a fence, by name, cut
    to limit as a whole; summaries hold '**name**: summary', cut to `short`
    each, of all files. A topic whose files are all missing has empty texts.
    """
    named = files.select(F.substring_index("path", "/", -1).alias("name"), "ord", "text", "summary")
    first = first_wins(named, ["name"], [F.col("ord")]).drop("ord")
    met = linked.select("topic", "name").distinct().join(first, "name")
    fence = F.concat(F.lit("### "), "name", F.lit("\n```\n"), F.substring("text", 1, each), F.lit("\n```"))
    contents = bounded_concat(met.where("text IS NOT NULL").withColumn("contents", fence), ["topic"], [F.col("name")], "contents", "\n\n", limit)
    line = F.concat(F.lit("**"), "name", F.lit("**: "), truncate(F.col("summary"), short))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("name", line.alias("line")))), lambda x: x["line"])
    summaries = met.where("summary <> ''").groupBy("topic").agg(F.array_join(lines, "\n\n").alias("summaries"))
    out = linked.select("topic").distinct().join(contents, "topic", "left").join(summaries, "topic", "left")
    return out.select("topic", F.coalesce("contents", F.lit("")).alias("contents"), F.coalesce("summaries", F.lit("")).alias("summaries"))


def topic_texts(linked: DataFrame, files: DataFrame, each: int = 15000) -> DataFrame:
    """Per topic: its distinct linked files that exist, and their characters, cut to `each`."""
    met = linked.distinct().join(files.where("text IS NOT NULL").select("path", F.least(F.length("text"), F.lit(each)).alias("n")), "path")
    return met.groupBy("topic").agg(F.sum("n").cast("long").alias("chars"), F.count("*").alias("files"))


def with_topic(topics: DataFrame, name: str, linked: str) -> DataFrame:
    """topics with one more, unless one of that name is there."""
    spark = topics.sparkSession
    extra = spark.createDataFrame([(name, linked)], "name string, linked string")
    return topics.unionByName(extra.join(topics.where(F.col("name") == name).select("name").distinct(), "name", "left_anti").select("name", "linked"))


def class_texts(classes: DataFrame, members: DataFrame, limit: int = 2000) -> DataFrame:
    """'<name> (<kind>): methods=a, b. <summary>' of every app class, at most limit characters."""
    named = members.where("member_kind = 'method'").groupBy("repo", "path", "fqcn").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("names"))
    rows = classes.where(origin(F.col("path")) == "app").join(named, ["repo", "path", "fqcn"], "left")
    summary = F.substring(F.concat("fqcn", F.lit(": "), "kind"), 1, 500)
    text = F.concat("name", F.lit(" ("), "kind", F.lit("): methods="), F.coalesce(F.array_join("names", ", "), F.lit("")), F.lit(". "), summary)
    return rows.select("repo", "path", "fqcn", F.substring(text, 1, limit).alias("text"))


def hashed_features(text: str, size: int) -> np.ndarray:
    """A unit vector of signed word counts, the stand-in for an embedding service."""
    out = np.zeros(size)
    for word in text.lower().split():
        h = crc32(word.encode())
        out[(h >> 1) % size] += 1 if h & 1 else -1
    norm = np.linalg.norm(out)
    return out / norm if norm else out


def embedded(texts: DataFrame, embed=hashed_features, size: int = 64) -> DataFrame:
    """Rows (id, embedding) for texts that are not empty, one Arrow batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [embed(x, size).tolist() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.float64()))], ["id", "embedding"])

    rows = texts.where(F.length(F.trim("text")) > 0).select(F.col("id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "id long, embedding array<double>")


def _asked(embed: Callable[[list[str]], list[list[float]]], texts: list[str], attempts: int, wait: float) -> tuple[list, str | None]:
    """The vectors of one batch, or what went wrong; a service that is short of quota is asked again, later each time."""
    for attempt in range(attempts):
        try:
            found = [[float(x) for x in v] for v in embed(texts)]
            return (found, None) if len(found) == len(texts) else ([None] * len(texts), f"{len(found)} vectors for {len(texts)} texts")
        except Exception as e:  # whatever a service raises concerns this batch alone
            error = f"{type(e).__name__}: {e}"
            if attempt + 1 < attempts and ("429" in error or "Resource exhausted" in error):
                time.sleep(wait * 2**attempt)
            else:
                break
    return [None] * len(texts), error


def embed_batches(texts: DataFrame, embed: Callable[[list[str]], list[list[float]]], batch: int = 20, attempts: int = 5, wait: float = 2.0) -> DataFrame:
    """Rows (id, embedding, error) for texts (id, text) that are not blank, asked for `batch` at a time.

    A batch that fails leaves its rows with a null embedding and the error:
    those are the report of failed ids, and store.update_column keeps what
    their rows had. attempts must be 1 or more.
    """
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                found, error = _asked(embed, part.column(1).to_pylist(), attempts, wait)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.float64())), pa.array([error] * part.num_rows, pa.string())], ["id", "embedding", "error"])

    rows = texts.where(F.length(F.trim("text")) > 0).select("id", F.col("text").cast("string"))
    return rows.mapInArrow(run, f"id {kind}, embedding array<double>, error string")
