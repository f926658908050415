"""Identity, naming and path functions of the code graph, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types that name no class.
BUILTIN_TYPES = ["int", "integer", "float", "double", "string", "bool", "boolean", "array", "void", "mixed", "null", "callable", "iterable", "object", "never", "true", "false", "self", "static", "parent", "this", "resource", "numeric"]
TRUNCATED = " ...[TRUNCATED]"


def make_id(kind: str, *parts: Column) -> Column:
    """Deterministic id: kind, then 16 hex digits of the sha256 of all parts joined by '|'. A null part counts as ''."""
    joined = F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{kind}_"), F.substring(F.sha2(joined, 256), 1, 16))


def norm(name: Column) -> Column:
    """Case-insensitive form of an identifier."""
    return F.lower(name)


def simple_name(name: Column) -> Column:
    """The last segment of a backslash-separated name."""
    return F.substring_index(name, "\\", -1)


def member_name(fqcn: Column, member: Column, owner: Column | None = None, namespace: Column | None = None) -> Column:
    """class::member; for functions outside classes (owner '(global)') namespace\\member, or the member alone."""
    blank = lambda c: F.lit("") if c is None else F.coalesce(c, F.lit(""))
    inside = F.when(blank(fqcn) != "", F.concat(fqcn, F.lit("::"), member)).when(blank(owner) != "", F.concat(blank(owner), F.lit("::"), member)).otherwise(member)
    outside = F.when(blank(namespace) != "", F.concat(blank(namespace), F.lit("\\"), member)).otherwise(member)
    return F.when(blank(owner) == "(global)", outside).otherwise(inside)


def signature(returns: Column, owner: Column, member: Column, parameters: Column) -> Column:
    """'<return type> <class>.<member>(<parameters>)'; a missing part is empty."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(part(returns), F.lit(" "), part(owner), F.lit("."), part(member), F.lit("("), part(parameters), F.lit(")"))


def truncate(text: Column, limit: int) -> Column:
    """Texts over limit characters cut so that, with the marker, they have exactly limit."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - len(TRUNCATED)), F.lit(TRUNCATED))).otherwise(text)


def split_plugin(name: Column) -> Column:
    """struct(plugin, rest) of 'Plugin.Rest'; without both parts the whole is the rest and plugin is null."""
    at = F.instr(name, ".")
    two = (at > 1) & (at < F.length(name))
    return F.struct(F.when(two, F.substring_index(name, ".", 1)).alias("plugin"), F.when(two, F.expr("1")).isNotNull().alias("qualified"), F.when(two, F.regexp_replace(name, r"^[^.]*\.", "")).otherwise(name).alias("rest"))


def singularize(word: Column) -> Column:
    """English singular by suffix: ies, sses, xes, ches, shes, s."""
    low, n = F.lower(word), F.length(word)
    cut = lambda k: F.substring(word, F.lit(1), n - k)
    return (
        F.when(low.endswith("ies") & (n > 3), F.concat(cut(3), F.when(word.rlike("I[Ee][Ss]$"), "Y").otherwise("y")))
        .when(low.rlike("(sses|xes|ches|shes)$"), cut(2))
        .when(low.endswith("s") & ~low.endswith("ss"), cut(1))
        .otherwise(word)
    )


def tableize(name: Column) -> Column:
    """Table name of a table class: without the suffix 'Table', an underscore before inner capitals, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, "Table$", ""), "(?<!^)(?=[A-Z])", "_"))


def virtual_getter(prop: Column) -> Column:
    """full_name -> _getFullName: the first letter of every part upper, the rest as it is."""
    parts = F.transform(F.split(prop, "_"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20)))
    return F.concat(F.lit("_get"), F.array_join(parts, ""))


def is_callable_literal(text: Column) -> Column:
    """Whether a string literal names Class::member."""
    return text.rlike(r"^\\?[A-Za-z_][A-Za-z0-9_\\]*::[A-Za-z_][A-Za-z0-9_]*$")


def is_magic_finder(name: Column) -> Column:
    return name.rlike("^find(All)?By[A-Z][A-Za-z0-9_]*$")


def class_types(declared: Column) -> Column:
    """Class names in a declared type: unions and intersections split, '?' and built-in types dropped."""
    parts = F.transform(F.split(F.translate(declared, "&", "|"), r"\|"), lambda p: F.regexp_replace(p, r"^[\s?]+|\s+$", ""))
    return F.filter(parts, lambda p: p.rlike(r"^\\|^\p{L}") & ~F.lower(F.substring_index(p, "\\", -1)).isin(BUILTIN_TYPES))


def safe_filename(topic: Column) -> Column:
    """Lower case, spaces to underscores, letters, digits and underscores only."""
    return F.regexp_replace(F.replace(F.lower(topic), F.lit(" "), F.lit("_")), r"[^\p{L}\p{N}_]", "")


def origin(path: Column) -> Column:
    """'vendor' when a path segment is 'vendor', else 'app'."""
    return F.when(F.array_contains(F.split(path, "/"), "vendor"), "vendor").otherwise("app")


def is_skipped(path: Column, skip: list[str]) -> Column:
    """Whether a directory of the path starts with a dot or is in skip."""
    parts = F.split(path, "/")
    return F.exists(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.startswith(".") | p.isin(skip))


def plugin_of(path: Column) -> Column:
    """The segment after 'plugins'; null without one."""
    parts = F.split(path, "/")
    at = F.array_position(parts, "plugins")
    return F.when((at > 0) & (at < F.size(parts)), F.get(parts, at.cast("int")))


def line_chunks(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Rows (key, chunk, part): texts in chunks of at most size characters that end after a newline where one lies past their start.

    A window without a newline past its first character is cut hard; the chunks
    of a text concatenate to it. Where a cut falls depends on the one before,
    so each text is walked once, in Arrow batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, parts = [], [], []
            for i, whole in enumerate(batch.column(1).to_pylist()):
                start, chunk = 0, 0
                while start < len(whole):
                    end = min(start + size, len(whole))
                    newline = whole.rfind("\n", start, end) if end < len(whole) else -1
                    end = newline + 1 if newline > start else end
                    rows.append(i)
                    at.append(chunk)
                    parts.append(whole[start:end])
                    start, chunk = end, chunk + 1
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(at, pa.int32()), pa.array(parts, pa.string())], [key, "chunk", "part"])

    rows = df.where(F.length(text) > 0).select(key, F.col(text).cast("string"))
    return rows.mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, chunk int, part string")
