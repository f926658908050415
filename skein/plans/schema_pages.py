"""Schema documents: the entity diagram and a page per table, from frames of tables, columns, indexes, foreign keys and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.conventions import er_relation, er_token, markdown_cell

# Headings of a table's page.
COLUMNS = "## カラム\n\n| カラム | 型 | 制約 | 説明 |\n|------|----|------|------|"
INDEXES, FOREIGN_KEYS, RELATIONS, NONE = "## インデックス", "## 外部キー", "## リレーション", "なし"


def _ordered(rows: DataFrame, line: Column) -> DataFrame:
    """Per table its rows' lines by ord, equal ones by text; a group is one table's columns or keys."""
    lines = rows.select("table", F.struct("ord", line.alias("line")).alias("at")).groupBy("table").agg(F.array_sort(F.collect_list("at")).alias("at"))
    return lines.select("table", F.array_join(F.transform("at", lambda x: x["line"]), "\n").alias("text"))


def page_name(table: Column) -> Column:
    """The file of a table's page; 'table.md' for one without a name."""
    safe = F.regexp_replace(F.trim(F.when(table != "", table).otherwise("table")), "[^0-9A-Za-z_.-]", "_")
    return F.concat(F.when(safe == "", "table").otherwise(safe), F.lit(".md"))


def key_marks(columns: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """columns (table, ord, name, type, constraints) with mark: PK where the constraints say so, else FK for the column of a foreign key, else ''.

    Columns without a name are left out; a name is compared as it is written.
    """
    keys = foreign_keys.select("table", F.col("column").alias("name")).distinct().withColumn("is_key", F.lit(True))
    says = F.upper(F.coalesce("constraints", F.lit("")))
    mark = F.when(says.contains("PK") | says.contains("PRIMARY"), "PK").when(F.col("is_key"), "FK").otherwise("")
    named = columns.where("name <> ''").select("table", "ord", "name", "type", "constraints")
    return named.join(keys, ["table", "name"], "left").select("table", "ord", "name", "type", mark.alias("mark"))


def er_blocks(columns: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """Rows (table, text): the diagram's block of every table that has a named column. A null type reads 'any'."""
    key = F.when(F.col("mark") == "", "").otherwise(F.concat(F.lit(" "), "mark"))
    line = F.concat(F.lit("        "), er_token(F.coalesce("type", F.lit("any"))), F.lit(" "), er_token(F.col("name")), key)
    return _ordered(key_marks(columns, foreign_keys), line).select("table", F.concat(F.lit("    "), er_token(F.col("table")), F.lit(" {\n"), "text", F.lit("\n    }")).alias("text"))


def er_diagram(relations: DataFrame, columns: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """Rows (part, ord, name, text) whose texts, by part, ord and name, are the diagram: its head, relations, blocks.

    relations are (ord, source, target, cardinality, via, description); those
    without an end are left out. The rows stay distributed, as a schema of many
    repositories may be large.
    """
    head = columns.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("ord"), F.lit("").alias("name"), F.lit("erDiagram").alias("text"))
    label = F.when(F.col("via") != "", F.col("via")).otherwise(F.col("description"))
    lines = relations.where("source <> '' AND target <> ''").select(F.lit(1), F.col("ord").cast("long"), F.concat_ws(" ", "source", "target"), er_relation(F.col("source"), F.col("target"), F.col("cardinality"), label))
    return head.union(lines).union(er_blocks(columns, foreign_keys).select(F.lit(2), F.lit(0).cast("long"), "table", "text"))


def table_pages(tables: DataFrame, columns: DataFrame, indexes: DataFrame, foreign_keys: DataFrame, relations: DataFrame, topic: str) -> DataFrame:
    """Rows (path, content): a page for every row of tables (name, description) that has a name.

    columns are (table, ord, name, type, constraints, description), indexes
    (table, ord, columns, unique, name), foreign_keys (table, ord, column,
    references), relations as for the diagram. A relation is on the pages of
    both its ends. Nulls are empty cells.
    """
    cell = lambda c: markdown_cell(F.col(c))
    rows = F.concat(F.lit("| "), F.concat_ws(" | ", cell("name"), cell("type"), cell("constraints"), cell("description")), F.lit(" |"))
    index = F.concat(F.lit("- `"), cell("columns"), F.lit("`"), F.when(F.col("unique"), " (UNIQUE)").otherwise(""), F.when(F.col("name") != "", F.concat(F.lit(" — `"), "name", F.lit("`"))).otherwise(""))
    key = F.concat(F.lit("- `"), cell("column"), F.lit("` → "), cell("references"))
    end = F.explode(F.array_distinct(F.array("source", "target")))
    relation = F.concat(F.lit("- "), cell("source"), F.lit(" → "), cell("target"), F.lit(" ("), cell("cardinality"), F.lit("): "), cell("description"))
    pages = tables.where("name <> ''").select("name", F.trim(F.coalesce("description", F.lit(""))).alias("about"))
    parts = {"c": (columns, rows), "i": (indexes, index), "f": (foreign_keys, key), "r": (relations.withColumn("table", end), relation)}
    for at, (frame, line) in parts.items():
        pages = pages.join(_ordered(frame, line).select(F.col("table").alias("name"), F.col("text").alias(at)), "name", "left")
    about = F.when(F.col("about") == "", "").otherwise(F.concat("about", F.lit("\n\n")))
    body = F.concat(F.lit(COLUMNS), F.coalesce(F.concat(F.lit("\n"), "c"), F.lit("")), F.lit(f"\n\n{INDEXES}\n\n"), F.coalesce("i", F.lit(NONE)), F.lit(f"\n\n{FOREIGN_KEYS}\n\n"), F.coalesce("f", F.lit(NONE)))
    more = F.coalesce(F.concat(F.lit(f"\n\n{RELATIONS}\n\n"), "r"), F.lit(""))
    return pages.select(page_name(F.col("name")).alias("path"), F.concat(F.lit("# "), "name", F.lit("\n\n"), about, body, more, F.lit(f"\n\n---\n[← {topic}](index.md)\n")).alias("content"))
