"""Parquet stage tables: upserts, partial updates, additive schemas, resume."""

from __future__ import annotations

import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructField, StructType

from skein.operators.relational import last_wins
from skein.session import materialize


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new in place of old rows with the same key; columns that one side lacks become null. new must have one row per key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def update_column(rows: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """rows with column replaced where changes has the key."""
    new = changes.select(F.col(key).alias("_k"), F.col(column).alias("_new"))
    return rows.join(new, F.col(key) == F.col("_k"), "left").withColumn(column, F.coalesce("_new", column)).drop("_k", "_new")


def pending(current: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that no earlier run has finished with the same keys (path, time, version)."""
    return current.join(done.select(*keys).distinct(), keys, "left_anti")


def stale_files(files: DataFrame, state: DataFrame, version: int, links: DataFrame) -> DataFrame:
    """files (repo, path, mtime) with stale: whether their stored results cannot be reused.

    state holds (repo, path, mtime, version) of what is stored, links (repo,
    path, target_path) which files a file's results were found in. A file is
    stale where nothing is stored for its time and this version, and where it
    depends, over any number of links, on a stale file or on one that is gone.
    A null time never matches.
    """
    kept = files.join(state.where(F.col("version") == version).select("repo", "path", "mtime").distinct(), ["repo", "path", "mtime"], "left_semi")
    gone = state.select("repo", "path").distinct().join(files.select("repo", "path"), ["repo", "path"], "left_anti")
    fresh = files.select("repo", "path").join(kept.select("repo", "path"), ["repo", "path"], "left_anti")
    known = materialize(fresh.unionByName(gone).distinct(), "stale")
    users = materialize(links.where("path <> target_path").select("repo", F.col("target_path").alias("_at"), "path").distinct(), "users")
    front = known
    while True:
        step = front.withColumnRenamed("path", "_at").join(users, ["repo", "_at"]).select("repo", "path").distinct()
        front = materialize(step.join(known, ["repo", "path"], "left_anti"), "stale")
        if front.isEmpty():
            break
        known = known.unionByName(front)
    return files.join(known.withColumn("stale", F.lit(True)), ["repo", "path"], "left").withColumn("stale", F.coalesce("stale", F.lit(False)))


def merge_results(files: DataFrame, stored: DataFrame, computed: DataFrame, version: int) -> DataFrame:
    """Results of all files: stored rows of those that are not stale, computed rows of the others, stamped with time and version.

    files comes from stale_files; stored and computed hold rows (repo, path, ..);
    results of files that are gone are left out.
    """
    columns = [c for c in computed.columns if c not in ("mtime", "version")]
    good = files.where("NOT stale").select("repo", "path", "mtime")
    bad = files.where("stale").select("repo", "path", "mtime")
    rows = stored.select(columns).join(good, ["repo", "path"]).unionByName(computed.select(columns).join(bad, ["repo", "path"]))
    return rows.withColumn("version", F.lit(version))


#: Types in the order in which values may widen without loss.
WIDER = [["tinyint", "smallint", "int", "bigint"], ["tinyint", "smallint", "int", "double"], ["float", "double"], ["date", "timestamp_ntz"], ["date", "timestamp"]]


def schema_changes(have: DataType, want: DataType, at: str = "") -> list[tuple[str, str, str, str]]:
    """Differences (column, change, have, want) between two schemas: add, widen, conflict, or extra; nested columns are dotted.

    Columns compare without case. extra columns stay as they are. A column that
    must not be null cannot be added to rows that exist, nor may one that holds
    nulls become so: both are conflicts.
    """
    out = []
    if isinstance(have, StructType) and isinstance(want, StructType):
        old = {f.name.lower(): f for f in have}
        for f in want:
            name, mine = f"{at}{f.name}", old.pop(f.name.lower(), None)
            if mine is None:
                out.append((name, "add" if f.nullable else "conflict", "", f.dataType.simpleString()))
            elif mine.nullable and not f.nullable:
                out.append((name, "conflict", f"{mine.dataType.simpleString()} null", f"{f.dataType.simpleString()} not null"))
            else:
                out += schema_changes(mine.dataType, f.dataType, f"{name}.")
        return out + [(f"{at}{f.name}", "extra", f.dataType.simpleString(), "") for f in old.values()]
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return schema_changes(have.elementType, want.elementType, f"{at}element.")
    if isinstance(have, MapType) and isinstance(want, MapType):
        return schema_changes(have.keyType, want.keyType, f"{at}key.") + schema_changes(have.valueType, want.valueType, f"{at}value.")
    a, b = have.simpleString(), want.simpleString()
    if a == b:
        return []
    decimals = isinstance(have, DecimalType) and isinstance(want, DecimalType) and want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
    wider = decimals or any(a in order and b in order and order.index(a) < order.index(b) for order in WIDER)
    return [(at.rstrip("."), "widen" if wider else "conflict", a, b)]


def migrate_table(spark: SparkSession, path: str, want: StructType, partition: list[str] | None = None) -> list[tuple[str, str, str, str]]:
    """Bring the parquet table at path to the wanted schema and say what changed; a missing table is created empty.

    Added columns are null, widened ones cast, extra ones kept at the end. Any
    conflict raises before anything is written. Rows are written beside the
    table and then in its place, so a failed job leaves it as it was.
    """
    try:
        old = spark.read.parquet(path)
    except AnalysisException:
        spark.createDataFrame([], want).write.parquet(path)
        return [(f.name, "add", "", f.dataType.simpleString()) for f in want]
    readable = StructType([f if f.nullable else StructField(f.name, f.dataType, True) for f in want])  # files do not keep what must not be null
    changes = schema_changes(old.schema, readable)
    if wrong := [c for c in changes if c[1] == "conflict"]:
        raise ValueError("; ".join(f"{column}: {a} cannot become {b}" for column, _, a, b in wrong))
    if not any(c[1] in ("add", "widen") for c in changes):
        return changes
    names = {c.lower(): c for c in old.columns}
    columns = [(F.col(f"`{names[f.name.lower()]}`") if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in want]
    wanted = {f.name.lower() for f in want}
    rows = materialize(old.select(*columns, *[F.col(f"`{c}`") for c in old.columns if c.lower() not in wanted]), "migrated")
    rows.write.mode("overwrite").partitionBy(*(partition or [])).parquet(path)
    return changes


def verify_tables(spark: SparkSession, folder: str, wanted: dict[str, StructType]) -> list[tuple[str, str, str, str, str]]:
    """What differs between the tables below folder and their wanted schemas: rows (table, column, problem, have, want); a table that is not there is missing."""
    out = []
    for name, want in wanted.items():
        try:
            have = spark.read.parquet(f"{folder.rstrip('/')}/{name}").schema
        except AnalysisException:
            out.append((name, "", "missing", "", ""))
            continue
        readable = StructType([StructField(f.name, f.dataType, True) for f in want])
        out += [(name, *change) for change in schema_changes(have, readable) if change[1] != "extra"]
    return out


def missing_columns(have: DataFrame, want: DataFrame) -> list[str]:
    """Columns an additive migration would add, in the order of want."""
    return [c for c in want.columns if c not in have.columns]


def write_upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition: str, order: list[Column]) -> None:
    """Merge new into the parquet table at path, key by key; of several new rows with one key the last by order wins.

    Only the partitions that new touches are read and written again. They are
    written beside the table first, so a lost job leaves the table as it was.
    """
    new = last_wins(new, keys, order).select(*new.columns)
    try:
        old = spark.read.parquet(path)
    except AnalysisException:
        new.write.partitionBy(partition).parquet(path)
        return
    touched = old.join(F.broadcast(new.select(partition).distinct()), partition, "left_semi")  # one row per partition folder
    merged = materialize(upsert(touched, new, keys), "upsert")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_tables(tables: dict[str, DataFrame], folder: str, at_once: int = 4) -> None:
    """Write every table below folder, several jobs at once."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(df.write.mode("overwrite").parquet, f"{folder.rstrip('/')}/{name}") for name, df in tables.items()]:
            done.result()


def write_documents(documents: DataFrame, folder: str) -> int:
    """Write rows (path, content) as files below a folder that all executors share; paths that lead out of it are left out. Returns how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = os.path.join(folder, path)
                os.makedirs(os.path.dirname(at), exist_ok=True)
                with open(at, "w", encoding="utf-8") as f:
                    f.write(content or "")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    inside = documents.where(~F.array_contains(F.split("path", "/"), "..") & ~F.col("path").startswith("/")).select("path", "content")
    return inside.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def index_pages(files: DataFrame, most: int = 200) -> DataFrame:
    """Per directory a page (path, content): one line per file with the first 80 characters of its summary's first line, at most `most` and how many more."""
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    line = F.concat(F.lit("- "), F.element_at(F.split("path", "/"), -1), F.lit(": "), F.substring(F.substring_index(F.coalesce("summary", F.lit("")), "\n", 1), 1, 80))
    ranked = files.select(directory.alias("dir"), "path", line.alias("line")).withColumn("nth", F.row_number().over(Window.partitionBy("dir").orderBy("path")))
    total = files.groupBy(directory.alias("dir")).agg(F.count("*").alias("n"))
    shown = ranked.where(F.col("nth") <= most).groupBy("dir").agg(F.array_sort(F.collect_list(F.struct("nth", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    page = F.concat(F.lit("# "), "dir", F.lit("\n"), text, F.when(F.col("n") > most, F.concat(F.lit("\n"), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise(""))
    return shown.join(total, "dir").select(F.concat("dir", F.when(F.col("dir") == "", "").otherwise("/"), F.lit("index.md")).alias("path"), page.alias("content"))


def _directories(files: DataFrame) -> DataFrame:
    """Rows (repo, dir) of every directory that holds a file at any depth; the root is ''. Combined before the shuffle."""
    parts = F.split("path", "/")
    depth = F.explode(F.sequence(F.lit(0), F.size(parts) - 1))
    return files.where("path IS NOT NULL").select("repo", parts.alias("parts"), depth.alias("depth")).select("repo", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("dir")).distinct()


def index_nodes(files: DataFrame, directories: DataFrame, cut: int = 500) -> DataFrame:
    """The summary tree as rows (repo, parent, kind, path, node), one per file and directory.

    files are (repo, path, summary), directories (repo, dir, summary) where
    there is one. node is JSON (path, type, name, summary of at most `cut`
    characters, '' for none). A node's children are the rows whose parent is
    its path, files (kind 0) before directories (kind 1), each by path; the
    root has the path '' and no parent. The tree is not nested into one text,
    which would pass a whole repository through one task.
    """
    summary = F.substring(F.coalesce("summary", F.lit("")), 1, cut)
    mine = files.where("path IS NOT NULL").select("repo", F.lit(0).alias("kind"), "path", summary.alias("summary"))
    known = directories.select(F.col("repo").alias("r"), F.col("dir").alias("d"), "summary")
    every = _directories(files)
    every = every.join(known, every["repo"].eqNullSafe(known["r"]) & (every["dir"] == known["d"]), "left").select("repo", F.lit(1).alias("kind"), F.col("dir").alias("path"), summary.alias("summary"))
    rows = mine.unionByName(every)
    parts = F.split("path", "/")
    above = F.when((F.col("kind") == 0) | (F.col("path") != ""), F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/"))
    kind = F.when(F.col("kind") == 0, "file").otherwise("directory")
    node = F.to_json(F.struct("path", kind.alias("type"), F.element_at(parts, -1).alias("name"), "summary"))
    return rows.select("repo", above.alias("parent"), "kind", "path", node.alias("node"))


def component_tables(files: DataFrame, most: int = 200) -> DataFrame:
    """Rows (repo, content): a Markdown table of a repository's files by path, at most `most`, then how many more there are.

    A line shows the first 80 characters of a summary's first line. Files are
    ranked before the shuffle too, so a repository costs `most` rows a task.
    """
    # fixed values: the table's head and last line
    head, rest = "| ファイル | 概要 |\n|------|---------|", ("| ... | 他 ", " ファイル |")
    rows = files.where("path IS NOT NULL").select("repo", "path", F.substring(F.substring_index(F.coalesce("summary", F.lit("")), "\n", 1), 1, 80).alias("line"))
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("repo").orderBy("path", "line"))).where(F.col("nth") <= most)
    lines = ranked.groupBy("repo").agg(F.array_sort(F.collect_list(F.struct("nth", F.concat(F.lit("| "), "path", F.lit(" | "), "line", F.lit(" |")).alias("line")))).alias("lines"))
    total = rows.groupBy(F.col("repo").alias("r")).agg(F.count("*").alias("n"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    more = F.when(F.col("n") > most, F.concat(F.lit("\n" + rest[0]), (F.col("n") - most).cast("string"), F.lit(rest[1]))).otherwise("")
    return lines.join(total, F.col("repo").eqNullSafe(F.col("r"))).select("repo", F.concat(F.lit(head + "\n"), text, more).alias("content"))


def index_statistics(files: DataFrame, topics: DataFrame) -> DataFrame:
    """Rows (repo, total_files, total_directories, total_topics): distinct paths, directories with the root, distinct names of topics (repo, name)."""
    count = lambda rows, name: rows.groupBy("repo").agg(F.count("*").alias(name))
    sums = count(files.where("path IS NOT NULL").select("repo", "path").distinct(), "total_files")
    for rows, name in ((_directories(files), "total_directories"), (topics.where("name IS NOT NULL").select("repo", "name").distinct(), "total_topics")):
        more = count(rows, name).withColumnRenamed("repo", "r")
        sums = sums.join(more, sums["repo"].eqNullSafe(more["r"]), "left").drop("r").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    return sums
