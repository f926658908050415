"""Scans of source trees."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.names import is_skipped, origin

#: Directories that a scan never enters.
SKIP_DIRS = [".git", ".svn", ".hg", "node_modules", "__pycache__", ".idea", ".vscode", "build", "dist", "bin", "venv", ".venv", "vendor", "tmp", "logs", "webroot"]


def repo_files(spark: SparkSession, root: str, repo: str, include_vendor: bool = False, extensions: tuple[str, ...] = ("php", "ctp")) -> DataFrame:
    """Rows (repo, path, origin, content, modified): one whole file each, below no hidden or skipped directory."""
    base = root.rstrip("/")
    cases = ",".join("".join(f"[{c}{c.upper()}]" for c in e) for e in extensions)
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{{{cases}}}").text(base, wholetext=True)
    full = F.col("_metadata.file_path")
    path = F.regexp_replace(full, "^.*?" + base.replace("file://", "").replace(".", r"\.") + "/", "")
    skip = [d for d in SKIP_DIRS if not (include_vendor and d == "vendor")]
    files = read.select(F.lit(repo).alias("repo"), path.alias("path"), F.col("value").alias("content"), F.col("_metadata.file_modification_time").alias("modified"))
    kept = files.where(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*extensions) & ~is_skipped(F.col("path"), skip))
    return kept.withColumn("origin", origin(F.col("path")))


def directories(files: DataFrame, path: str = "path", extra: list[str] | None = None) -> DataFrame:
    """Every ancestor of every path up to the root '.': rows (dir, parent, depth), for each value of the extra columns."""
    parts, extra = F.split(path, "/"), extra or []
    dirs = files.select(*extra, F.explode(F.sequence(F.lit(0), F.size(parts) - 1)).alias("depth"), parts.alias("p")).select(*extra, F.when(F.col("depth") == 0, ".").otherwise(F.array_join(F.slice("p", F.lit(1), F.col("depth")), "/")).alias("dir"), "depth").distinct()
    parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == 1, ".").otherwise(F.regexp_replace("dir", "/[^/]*$", ""))
    return dirs.select(*extra, "dir", parent.alias("parent"), "depth")


def is_migration(path: Column, content: Column, folders: list[str], marker: str) -> Column:
    """Whether a file is a migration: below one of the folders, or marked within its first 4000 characters."""
    inside = reduce(lambda a, b: a | b, [path.contains(f) for f in folders])
    return inside | F.substring(F.coalesce(content, F.lit("")), 1, 4000).contains(marker)


def manifest(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """(repo, root, include_vendor) of a JSON list of paths or of objects with path and, at will, name and include_vendor."""
    entries = json.loads(spark.read.text(path, wholetext=True).first()[0])
    out = []
    for entry in entries:
        entry = {"path": entry} if isinstance(entry, str) else entry
        root = entry["path"].rstrip("/")
        out.append((entry.get("name") or root.rsplit("/", 1)[-1], root, bool(entry.get("include_vendor", False))))
    return out


def all_repos(spark: SparkSession, path: str) -> DataFrame:
    """The files of every repository that a manifest names."""
    return reduce(DataFrame.unionByName, [repo_files(spark, root, repo, vendor) for repo, root, vendor in manifest(spark, path)])


def vendor_stats(spark: SparkSession, root: str) -> DataFrame:
    """One row: files below a vendor folder and their bytes, from the listing alone (contents are not read)."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return read.where(F.array_contains(F.split("path", "/"), "vendor")).agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def usable_repos(metas: DataFrame, id_scheme: int, version: int, id_prefix: str) -> DataFrame:
    """metas (repo, id_scheme, version, id_prefix) with reason: null where a repository can be cross-referenced, else why not."""
    reason = F.when(F.col("id_scheme") != id_scheme, "id scheme").when(F.col("version") != version, "entity version").when(F.col("id_prefix") != id_prefix, "id prefix")
    return metas.withColumn("reason", F.when(F.col("id_scheme").isNull() | F.col("version").isNull(), "incomplete").otherwise(reason))


def markdown(spark: SparkSession, root: str) -> DataFrame:
    """Rows (name, text): markdown files by their path below root without extension."""
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True)
    base = root.rstrip("/").replace("file://", "")
    return read.select(F.regexp_replace(F.col("_metadata.file_path"), "^.*?" + re.escape(base) + r"/|\.md$", "").alias("name"), F.col("value").alias("text"))
