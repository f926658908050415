"""Resolution of what a code base refers to: names, property types, receivers and calls, from parsed entities alone.

Every frame below holds plain rows, one for each thing that a parser found;
`ord` is unique within a file, and a method is (repo, path, class_name, fqcn, member).

classes      repo, path, ord, name, namespace, fqcn, kind, internal (false: known, but outside the graph)
heritage     repo, path, namespace, class_name, fqcn, pos, relation, text, line, col
members      repo, path, namespace, class_name, fqcn, ord, name, member_kind, return_type
params       repo, path, namespace, class_name, fqcn, member, pos, name, type
uses         repo, path, kind, alias, fqcn, ord, line, col
sites        repo, path, namespace, class_name, fqcn, member, ord, line, col, kind, name, qualified, receiver, dynamic, args (string literals, null for others)
assignments  repo, path, namespace, class_name, fqcn, member, ord, line, col, var, rhs_kind, name, qualified, receiver
reads        repo, path, namespace, class_name, fqcn, member, ord, line, col, name, receiver
class_refs   repo, path, namespace, class_name, fqcn, member, ord, line, col, kind, text, name
located      repo, path, line, col, pos, fqcn, name, member_kind, target_path, internal: definitions that a language server gave; may be empty

Names of classes, functions and members compare without case. `Index` writes
the lookups once; the rules are joins against them. Receivers that an earlier
call's result is assigned to are typed in rounds, one for each call that a chain
of assignments passes through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import conventions as C
from skein.functions import names as N
from skein.operators.relational import classify_owners, first_wins
from skein.plans.crossref import candidate_names
from skein.plans.resolve import lineage
from skein.session import materialize

#: The type of a receiver whose class is computed at run time.
DYNAMIC = "!dynamic"
#: Loader methods (lower case) that give a property of the class a type.
PROPERTY_LOADERS = ["fetchtable", "loadmodel", "loadcomponent", "loadhelper"]
#: Magic methods whose instantiations a proxy may forward to.
MAGIC = ["__call", "__callStatic", "__get", "__set"]
#: Return types that name no class.
PLAIN = ["void", "bool", "int", "float", "string", "array", "mixed", "null", "callable", "iterable", "object", "never", "true", "false"]

FILE = ["repo", "path"]
CLASS = [*FILE, "class_name", "fqcn"]
METHOD = [*CLASS, "member"]
#: The number first: sorts compare it before they compare texts.
SITE = ["ord", *FILE]
_WORD = r"^[A-Za-z_]\w*$"


def _bare(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\?+", ""))


def _receiver(rows: DataFrame, receiver: str = "receiver") -> DataFrame:
    """rows with how their receiver is typed (own, parent, prop, var, text; null: not at all) and by which text."""
    r = F.trim(F.coalesce(F.col(receiver), F.lit("")))
    kind = F.when(r.isin("$this", "self", "static", "self()", "static()"), "own").when(r == "parent", "parent").when(r.rlike(r"^\$this->[A-Za-z_]\w*$"), "prop").when(r.startswith("$this->"), None)
    kind = kind.when(r.rlike(r"^\$[A-Za-z_]\w*$"), "var").when(r.startswith("$") | (r == ""), None).otherwise("text")
    text = F.when(kind == "prop", N.norm(F.substring_index(r, "->", -1))).when(kind == "text", F.regexp_replace(r, "::class$", "")).otherwise(r)
    return rows.withColumns({"r_kind": kind, "r_text": text})


def _place(rows: DataFrame) -> Column:
    """Where a row stands in its file, as one number."""
    return F.coalesce("line", F.lit(0)).cast("long") * (1 << 24) + F.coalesce("col", F.lit(0))


def _made_name() -> Column:
    return F.trim(F.coalesce(F.nullif("qualified", F.lit("")), "name"))


def _first_literal() -> Column:
    return F.try_element_at("args", F.lit(1))


def _last_before(assignments: DataFrame, queries: DataFrame, at: Column, asked: Column, keys: list[str]) -> DataFrame:
    """queries (keys, var, id) with prev: the ord of the last assignment of var whose place `at` is not after `asked`; one sort of both."""
    both = assignments.select(*keys, "var", at.alias("_at"), F.col("ord").alias("_ord"), F.lit(None).cast("long").alias("id"))
    both = both.unionByName(queries.select(*keys, "var", asked.alias("_at"), F.lit(None).cast("long").alias("_ord"), "id"))
    last = F.last("_ord", ignorenulls=True).over(Window.partitionBy(*keys, "var").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return both.repartition(*FILE).withColumn("prev", last).where("id IS NOT NULL").select(*keys, "var", "id", "prev")


def _of_file(rows: DataFrame) -> DataFrame:
    """Lookups of a file, one row for each name in it: they are hashed, so the many rows that ask are not sorted."""
    return rows.hint("shuffle_hash")


@dataclass
class Entities:
    classes: DataFrame
    heritage: DataFrame
    members: DataFrame
    params: DataFrame
    uses: DataFrame
    sites: DataFrame
    assignments: DataFrame
    reads: DataFrame
    class_refs: DataFrame
    located: DataFrame


class Index:
    """Lookups over entities, each written once when it is first read."""

    def __init__(self, entities: Entities, promoted: bool = False):
        """With promoted, parameters of a constructor give properties of their name a type, after all other sources."""
        self.e, self.promoted = entities, promoted

    @cached_property
    def classes(self) -> DataFrame:
        """(repo, key) to the class of that name: internal ones first, then by file."""
        rows = self.e.classes.where("fqcn <> '' AND name <> '(global)'").select("repo", N.norm(F.col("fqcn")).alias("key"), "path", "ord", "fqcn", "name", "kind", "internal")
        return materialize(first_wins(rows, ["repo", "key"], [~F.col("internal"), F.col("path"), F.col("ord")]), "classes")

    @cached_property
    def functions(self) -> DataFrame:
        """(repo, key) to the internal function of that full name."""
        full = F.when(F.coalesce("namespace", F.lit("")) != "", F.concat("namespace", F.lit("\\"), "name")).otherwise(F.col("name"))
        rows = self.e.members.where("class_name = '(global)' AND member_kind = 'function'").select("repo", N.norm(full).alias("key"), "path", "ord")
        return materialize(first_wins(rows, ["repo", "key"], [F.col("path"), F.col("ord")]).select("repo", "key", F.col("path").alias("target_path")), "functions")

    @cached_property
    def facts(self) -> DataFrame:
        """classes with construct: the name of the constructor that a class declares itself."""
        builds = self.owned.where("has = '__construct'").select("repo", "key", F.lit("__construct").alias("construct")).distinct()
        return materialize(self.classes.join(builds, ["repo", "key"], "left"), "facts")

    def _mean(self, parts: list[DataFrame], classes: DataFrame) -> DataFrame:
        """(repo, path, namespace, text) to the class that a text in that file means: the first of its candidate names that exists."""
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        named = candidate_names(rows.where("text <> ''").distinct(), self.e.uses.where("kind = 'class'")).select("repo", "path", "namespace", "text", F.posexplode("candidates").alias("pos", "candidate"))
        found = named.withColumn("key", N.norm(F.col("candidate"))).join(classes.drop("name", "ord").withColumnsRenamed({"path": "target_path", "kind": "class_kind"}), ["repo", "key"])
        return first_wins(found.drop("candidate"), ["repo", "path", "namespace", "text"], [F.col("pos")]).drop("pos")

    @cached_property
    def declared_texts(self) -> DataFrame:
        """Meanings of what heritage, members and parameters say and of what magic methods make: no other body is read for them."""
        e = self.e
        made = e.sites.where(F.col("member").isin(*MAGIC) & (F.col("kind") == "new"))
        said = ((e.heritage, F.trim("text")), (e.members, _bare(F.col("return_type"))), (e.params, _bare(F.col("type"))), (made, _made_name()))
        return materialize(self._mean([rows.select("repo", "path", "namespace", text.alias("text")) for rows, text in said], self.classes), "texts", together=True)

    @cached_property
    def texts(self) -> DataFrame:
        """Meanings of what the bodies say."""
        e = self.e
        said = [(e.sites.where("kind = 'new'"), _made_name()), (e.assignments.where("rhs_kind = 'new'"), _made_name()), (e.class_refs.where("kind = 'class_literal'"), F.trim("text"))]
        for rows, column in ((e.sites, "receiver"), (e.reads, "receiver"), (e.class_refs.where("kind = 'array_callable'"), "text")):
            said.append((_receiver(rows, column).where("r_kind = 'text'").drop("text"), F.col("r_text")))
        return materialize(self._mean([rows.select("repo", "path", "namespace", text.alias("text")) for rows, text in said], self.facts), "texts", together=True)

    def meaning(self, rows: DataFrame, text: str, declared: bool = False, **names: str) -> DataFrame:
        """rows with columns of the class that their text means, under the given names; null where it means none. Texts of declarations are told by declared."""
        found = (self.declared_texts if declared else self.texts).select("repo", "path", "namespace", F.col("text").alias(text), *[F.col(c).alias(n) for c, n in names.items()])
        return rows.join(_of_file(found), ["repo", "path", "namespace", text], "left")

    @cached_property
    def parents(self) -> DataFrame:
        """Heritage with the class each text means: (repo, key, pos, relation, parent)."""
        rows = self.meaning(self.e.heritage.where("fqcn <> ''").withColumn("text", F.trim("text")), "text", declared=True, key="parent")
        mine = self.classes.select("repo", "path", F.col("fqcn"), "key")  # of classes of one name only the first counts
        return materialize(rows.join(mine, ["repo", "path", "fqcn"]).select("repo", "key", "pos", "relation", "parent"), "parents")

    @cached_property
    def lines(self) -> DataFrame:
        """Each class with what it extends or uses, transitively, in breadth-first order."""
        known = self.parents.where("parent IS NOT NULL").select("repo", F.col("key").alias("fqcn"), "pos", "relation", "parent")
        return materialize(lineage(known, self.classes.select("repo", F.col("key").alias("fqcn"))), "lines")

    @cached_property
    def owned(self) -> DataFrame:
        """Members of each class as declared: (repo, key, has, member_kind, name, return_type, namespace, target_path, internal, ord)."""
        mine = self.classes.select("repo", "path", "fqcn", "key", "internal")
        rows = self.e.members.join(mine, ["repo", "path", "fqcn"])
        return materialize(rows.select("repo", "key", N.norm(F.col("name")).alias("has"), "member_kind", "name", "return_type", "namespace", F.col("path").alias("target_path"), "internal", "ord", "path"), "owned")

    @cached_property
    def methods(self) -> DataFrame:
        """(repo, key, has) to the first method of that name, as a target."""
        rows = self.owned.where("member_kind IN ('method', 'function')").select("repo", "key", "has", "ord", "name", "target_path", "internal")
        first = first_wins(rows, ["repo", "key", "has"], [F.col("ord")]).drop("ord")
        return materialize(first.join(self.classes.select("repo", "key", F.col("fqcn").alias("owner")), ["repo", "key"]), "methods")

    def loaded(self, rows: DataFrame, method: Column, args: Column, root: Column, receiver: Column | None = None) -> DataFrame:
        """rows (id columns) with the first class that a loader call's literal names and exists: key, rule."""
        found = C.loader_candidates(method, args, root)
        rule = F.concat(F.lit("loader_"), F.lower(method))
        if receiver is not None:
            at = F.when((F.size(found) == 0) & (F.lower(method) == "get"), C.locator_candidates(receiver, args, root))
            found, rule = F.coalesce(at, found), F.when(at.isNotNull(), "locator_get").otherwise(rule)
        asked = rows.select("*", rule.alias("rule"), F.posexplode(found).alias("_pos", "_name")).withColumn("key", N.norm(F.col("_name"))).drop("_name")
        hit = asked.join(self.classes.select("repo", "key", F.col("fqcn").alias("loaded"), F.col("path").alias("loaded_path"), F.col("internal").alias("loaded_internal")), ["repo", "key"])
        return first_wins(hit, rows.columns, [F.col("_pos")]).drop("_pos")

    @cached_property
    def behaviors(self) -> DataFrame:
        """(repo, key, pos, behavior): behaviors that the methods of an internal class register by literal, in the order written."""
        mine = self.classes.where("internal").select("repo", "path", "fqcn", "key")
        calls = self.e.sites.where("lower(name) = 'addbehavior'").where(_first_literal().isNotNull()).join(mine, ["repo", "path", "fqcn"])
        root = F.substring_index("fqcn", "\\", 1)
        rows = calls.groupBy("repo", F.col("key").alias("of"), _first_literal().alias("literal"), root.alias("root")).agg(F.min("ord").alias("ord"))  # each question once
        hit = self.loaded(rows, F.lit("addBehavior"), F.col("literal"), F.col("root"))
        return materialize(hit.groupBy("repo", F.col("of").alias("key"), F.col("key").alias("behavior")).agg(F.min("ord").alias("pos")), "behaviors")

    @cached_property
    def stops(self) -> DataFrame:
        """(repo, key, at, prefix, place, mixed): the classes where a member of a class is looked for.

        First its heritage (place: breadth-first), then, in the same way, each
        behavior registered on an internal class of it, whose stops follow
        prefix. A behavior that registers itself again on its own way is not
        entered twice.
        """
        chain = self.lines.select("repo", F.col("fqcn").alias("cur"), F.col("ancestor").alias("at"), F.concat(F.array("depth"), "trail").alias("place"))
        front = self.classes.select("repo", "key", F.col("key").alias("cur"), F.array().cast("array<long>").alias("prefix"), F.array("key").alias("seen"))
        every, mixed = front, self.behaviors.select("repo", F.col("key").alias("at"), F.col("pos").cast("long").alias("pos"), "behavior")
        while True:
            step = front.join(chain, ["repo", "cur"]).join(mixed, ["repo", "at"]).where(~F.array_contains("seen", F.col("behavior")))
            step = step.select("repo", "key", F.col("behavior").alias("cur"), F.concat("prefix", F.array(F.lit(1).cast("long")), F.col("place").cast("array<long>"), F.array("pos")).alias("prefix"), F.concat("seen", F.array("behavior")).alias("seen"))
            front = materialize(step, "stops")
            if front.isEmpty():
                break
            every = every.unionByName(front)
        met = every.join(chain, ["repo", "cur"])
        return materialize(met.select("repo", "key", "at", "prefix", F.col("place").cast("array<long>").alias("place"), (F.size("prefix") > 0).alias("mixed")), "stops")

    @cached_property
    def visible(self) -> DataFrame:
        """(repo, key, has) to the declaration that a call of a member on a class reaches: its place, rule (chain or behavior) and target."""
        got = self.stops.join(self.methods.withColumnRenamed("key", "at"), ["repo", "at"])
        order = F.concat("prefix", F.array(F.lit(0).cast("long")), "place")
        rows = got.select("repo", "key", "has", order.alias("place"), F.when(F.col("mixed"), "behavior").otherwise("chain").alias("rule"), F.struct("owner", "name", "target_path", "internal").alias("hit"))
        return materialize(first_wins(rows, ["repo", "key", "has"], [F.col("place"), F.col("hit")]), "visible")

    @cached_property
    def magic(self) -> DataFrame:
        """(repo, key, static) to the magic method that catches what is not declared; behaviors catch by __call only."""
        got = self.stops.join(self.methods.where("has IN ('__call', '__callstatic')").withColumnRenamed("key", "at"), ["repo", "at"])
        got = got.where("NOT mixed OR has = '__call'").withColumn("static", F.explode(F.array(F.lit(False), F.lit(True)))).where("mixed OR static = (has = '__callstatic')")
        order = F.concat("prefix", F.array(F.lit(2).cast("long")), "place")
        rows = got.select("repo", "key", "static", order.alias("place"), F.when(F.col("mixed"), "behavior").otherwise("magic_call").alias("rule"), F.struct("owner", "name", "target_path", "internal").alias("hit"))
        return materialize(first_wins(rows, ["repo", "key", "static"], [F.col("place"), F.col("hit")]), "magic")

    def walk(self, rows: DataFrame, on: str, member: Column, static: Column) -> DataFrame:
        """rows with rule and hit: where a member of the class `on` is declared, else mixed in, else caught."""
        asked = rows.withColumns({"_has": N.norm(member), "_static": static})
        named = self.visible.select("repo", F.col("key").alias(on), F.col("has").alias("_has"), F.struct("place", "rule", "hit").alias("_named"))
        caught = self.magic.select("repo", F.col("key").alias(on), F.col("static").alias("_static"), F.struct("place", "rule", "hit").alias("_caught"))
        met = asked.join(named, ["repo", on, "_has"], "left").join(caught, ["repo", on, "_static"], "left")
        best = F.least("_named", "_caught")  # nulls are passed over
        return met.withColumns({"rule": best["rule"], "hit": best["hit"]}).drop("_has", "_static", "_named", "_caught")

    @cached_property
    def forwards(self) -> DataFrame:
        """(repo, key, type): classes that a proxy may forward to: of its properties, constructor parameters and instantiations in magic methods."""
        e, mine = self.e, self.classes.select("repo", "path", "fqcn", "key")
        made = e.sites.where(F.col("member").isin(*MAGIC) & (F.col("kind") == "new")).select("repo", "path", "namespace", "fqcn", _made_name().alias("text"))
        props = e.members.where("member_kind = 'property'").select("repo", "path", "namespace", "fqcn", _bare(F.col("return_type")).alias("text"))
        given = e.params.where("member = '__construct'").select("repo", "path", "namespace", "fqcn", _bare(F.col("type")).alias("text"))
        rows = self.meaning(props.unionByName(given).unionByName(made), "text", declared=True, key="type").where("type IS NOT NULL").join(mine, ["repo", "path", "fqcn"])
        return materialize(rows.select("repo", "key", "type").distinct(), "forwards")

    @cached_property
    def forwarded(self) -> DataFrame:
        """(repo, key, has) to the one declaration, on the heritage of what a proxy may forward to; absent where several declare the member."""
        chain = self.visible.where("rule = 'chain'").select("repo", F.col("key").alias("type"), "has", "hit")
        rows = self.forwards.join(chain, ["repo", "type"]).select("repo", "key", "has", "hit").distinct()
        return materialize(rows.groupBy("repo", "key", "has").agg(F.count("*").alias("n"), F.first("hit").alias("forward")).where("n = 1").drop("n"), "forwarded")

    @cached_property
    def property_types(self) -> DataFrame:
        """(repo, path, class_name, fqcn, prop) to (key, source): declared types, then loader aliases, then a controller's default table.

        The last declaration of a property counts, the first loader of an
        alias; a source counts only where the class exists and none before it
        gave the property a type.
        """
        declared = self.meaning(self.e.members.where("member_kind = 'property'").withColumn("text", _bare(F.col("return_type"))), "text", declared=True, key="key").where("key IS NOT NULL")
        declared = declared.select(*CLASS, N.norm(F.col("name")).alias("prop"), F.lit(0).alias("rank"), (-F.col("ord")).alias("at"), "key")
        calls = self.e.sites.where(F.lower("name").isin(*PROPERTY_LOADERS)).where(_first_literal().isNotNull())
        rows = calls.groupBy(*CLASS, "name", _first_literal().alias("literal"), _root().alias("root")).agg(F.min("ord").alias("ord"))  # each question once
        hit = self.loaded(rows, F.col("name"), F.col("literal"), F.col("root"))
        alias = N.split_plugin(F.col("literal"))["rest"]
        loaders = hit.select(*CLASS, N.norm(alias).alias("prop"), F.lit(1).alias("rank"), F.col("ord").alias("at"), "key")
        table = C.default_table(F.col("fqcn"))
        tables = self.e.classes.where(table.isNotNull()).select("repo", "path", F.col("name").alias("class_name"), "fqcn", N.norm(table).alias("key")).join(self.classes.select("repo", "key", F.col("name").alias("table")), ["repo", "key"])
        tables = tables.select(*CLASS, N.norm(F.regexp_replace("table", "Table$", "")).alias("prop"), F.lit(2).alias("rank"), F.lit(0).cast("long").alias("at"), "key")
        if self.promoted:
            given = self.meaning(self.e.params.where("member = '__construct'").withColumn("text", _bare(F.col("type"))), "text", declared=True, key="key").where("key IS NOT NULL")
            tables = tables.unionByName(given.select(*CLASS, N.norm(F.regexp_replace("name", r"^\$", "")).alias("prop"), F.lit(3).alias("rank"), F.col("pos").cast("long").alias("at"), "key"))
        best = first_wins(declared.unionByName(loaders).unionByName(tables), [*CLASS, "prop"], [F.col("rank"), F.col("at")])
        return materialize(best.select(*CLASS, "prop", "key", F.element_at(F.array(*map(F.lit, ["declared", "loader", "default_table", "promoted"])), F.col("rank") + 1).alias("source")), "property_types")

    @cached_property
    def returns(self) -> DataFrame:
        """(repo, key, has) to the class that a member of a class is declared to return."""
        first = first_wins(self.owned.select("repo", "key", "has", "ord", "return_type", "namespace", "path"), ["repo", "key", "has"], [F.col("ord")])
        rows = first.withColumn("text", _bare(F.col("return_type"))).where("text <> ''").where(~F.lower("text").isin(*PLAIN))
        own = F.lower("text").isin("static", "self", "$this")
        found = self.meaning(rows.withColumnRenamed("key", "of"), "text", declared=True, key="type")
        return materialize(found.select("repo", F.col("of").alias("key"), "has", F.when(own, F.col("of")).otherwise(F.col("type")).alias("returned")).where("returned IS NOT NULL"), "returns")

    @cached_property
    def entity_of(self) -> DataFrame:
        """(repo, key) of a table class to the entity class of it, where that exists."""
        rows = self.classes.select("repo", F.col("key").alias("of"), N.norm(C.entity_class(F.col("fqcn"))).alias("key")).where("key IS NOT NULL")
        return materialize(rows.join(self.classes.select("repo", "key"), ["repo", "key"]).select("repo", F.col("of").alias("key"), F.col("key").alias("entity")), "entities")

    @cached_property
    def first_parent(self) -> DataFrame:
        """(repo, path, class_name, fqcn) to what `parent` means: the first class extended, if it exists."""
        rows = self.e.heritage.where("relation = 'extends'").select(*CLASS, "namespace", "pos", F.trim("text").alias("text"))
        first = first_wins(rows, CLASS, [F.col("pos")])
        met = self.meaning(first, "text", declared=True, key="parent_key").where("parent_key IS NOT NULL")
        return materialize(met.select(*CLASS, "parent_key"), "first_parents", together=True)

    @cached_property
    def param_types(self) -> DataFrame:
        """(METHOD, r_text) to the class that a parameter is declared to be, if it exists."""
        rows = self.e.params.select(*METHOD, "namespace", F.col("name").alias("r_text"), "pos", _bare(F.col("type")).alias("text"))
        met = self.meaning(rows, "text", declared=True, key="param").where("param IS NOT NULL")
        return materialize(first_wins(met.select(*METHOD, "r_text", "pos", "param"), [*METHOD, "r_text"], [F.col("pos")]).drop("pos"), "param_types", together=True)

    @cached_property
    def places(self) -> DataFrame:
        """(FILE, line, col) to what is located there: _seen, the members in order, and _at, the first of all; with whether their classes are interfaces or have a constructor."""
        known = self.facts.select("repo", F.col("key").alias("_key"), (F.col("kind") == "interface").alias("face"), "construct")
        at = self.e.located.select(*FILE, "line", "col", "pos", F.struct(F.col("fqcn").alias("owner"), "name", "target_path", "internal").alias("hit"), "member_kind", N.norm(F.col("fqcn")).alias("_key"))
        at = at.join(known, ["repo", "_key"], "left").drop("_key")
        calls = at.where("hit.name <> '' AND member_kind IN ('method', 'function')").withColumns({"_o": N.norm(F.col("hit.owner")), "_m": N.norm(F.col("hit.name"))})
        calls = first_wins(calls.drop("member_kind", "construct"), [*FILE, "line", "col", "_o", "_m"], [F.col("pos")])
        calls = calls.groupBy(*FILE, "line", "col").agg(F.array_sort(F.collect_list(F.struct("pos", "hit", "face"))).alias("_seen"))
        first = first_wins(at.drop("member_kind", "face"), [*FILE, "line", "col"], [F.col("pos")]).select(*FILE, "line", "col", F.col("hit").alias("_at"), F.col("construct").alias("_at_construct"))
        return materialize(calls.join(first, [*FILE, "line", "col"], "full"), "places", together=True)

    def typed(self, rows: DataFrame) -> DataFrame:
        """rows of _receiver with fixed: the type of a receiver that is no variable."""
        met = rows.join(_of_file(self.first_parent), CLASS, "left").join(_of_file(self.property_types.select(*CLASS, F.col("prop").alias("r_text"), F.col("key").alias("prop_key"))), [*CLASS, "r_text"], "left")
        met = self.meaning(met, "r_text", key="text_key")
        fixed = F.when(F.col("r_kind") == "own", F.nullif(N.norm(F.col("fqcn")), F.lit(""))).when(F.col("r_kind") == "parent", F.col("parent_key")).when(F.col("r_kind") == "prop", F.col("prop_key")).when(F.col("r_kind") == "text", F.col("text_key"))
        return met.withColumn("fixed", fixed).drop("parent_key", "prop_key", "text_key")


def _root() -> Column:
    return F.when(F.col("fqcn").contains("\\"), F.substring_index("fqcn", "\\", 1)).otherwise("App")


# names (heritage, imports)


def resolve_heritage(ix: Index) -> DataFrame:
    """Heritage with status, via and target: the located class first, else the first candidate name that exists."""
    rows = ix.e.heritage.withColumn("text", F.trim("text"))
    at = ix.e.located.select(*FILE, "line", "col", (F.coalesce("name", F.lit("")) != "").alias("_member"), "pos", F.struct("fqcn", "target_path", "internal").alias("hit"))
    best = first_wins(at, [*FILE, "line", "col"], [F.col("_member"), F.col("pos")]).select(*FILE, "line", "col", F.col("hit").alias("_located"))
    met = ix.meaning(rows, "text", declared=True, fqcn="_fqcn", target_path="_path", internal="_internal").join(best, [*FILE, "line", "col"], "left")
    named = F.when(F.col("_fqcn").isNotNull(), F.struct(F.col("_fqcn").alias("fqcn"), F.col("_path").alias("target_path"), F.col("_internal").alias("internal")))
    hit = F.coalesce("_located", named)
    via = F.when(F.col("_located").isNotNull(), "lsp").when(F.col("_fqcn").isNotNull(), "parser").otherwise("none")
    return met.select(*CLASS, "pos", "relation", "text", "line", _status(hit).alias("status"), via.alias("via"), hit["fqcn"].alias("target_owner"), hit["target_path"].alias("target_path"))


def resolve_imports(ix: Index) -> DataFrame:
    """`use` lines with status and target file: a function of that name, an internal class, else what is located there."""
    rows = ix.e.uses.withColumn("key", N.norm(F.col("fqcn")))
    functions = ix.functions.select("repo", "key", F.lit("function").alias("kind"), F.col("target_path").alias("_function"))
    classes = ix.classes.where("internal").select("repo", "key", F.col("path").alias("_class"))
    at = first_wins(ix.e.located.select(*FILE, "line", "col", "pos", F.struct("target_path", "internal").alias("hit")), [*FILE, "line", "col"], [F.col("pos")]).select(*FILE, "line", "col", F.col("hit").alias("_located"))
    met = rows.join(functions, ["repo", "key", "kind"], "left").join(classes, ["repo", "key"], "left").join(at, [*FILE, "line", "col"], "left")
    known = F.coalesce("_function", "_class")
    status = F.when(known.isNotNull() | F.col("_located.internal"), "resolved").when(F.col("_located").isNotNull(), "external").otherwise("unresolved")
    return met.select(*FILE, "ord", "kind", "alias", "fqcn", "line", status.alias("status"), F.coalesce(known, F.col("_located.target_path")).alias("target_path"))


def _status(hit: Column) -> Column:
    return F.when(hit.isNull(), "unresolved").when(hit["internal"], "resolved").otherwise("external")


# strings


def string_targets(ix: Index) -> DataFrame:
    """Call sites with the class that a loader's literal names (string_*), and the member that a Class::member literal names (callable_*); sites with neither have no row."""
    s = ix.e.sites.where(F.size("args") > 0)
    rows = s.where(_first_literal().isNotNull() & (F.coalesce("name", F.lit("")) != "")).select(*SITE, "name", "receiver", _first_literal().alias("literal"), _root().alias("root"))
    asked = ["repo", "name", "receiver", "literal", "root"]
    rows = rows.withColumn("receiver", F.coalesce("receiver", F.lit("")))
    told = ix.loaded(rows.select(asked).distinct(), F.col("name"), F.col("literal"), F.col("root"), F.col("receiver"))  # each question once
    loaded = rows.join(told, asked)
    loaded = loaded.select(*SITE, F.col("loaded").alias("string_owner"), F.col("key").alias("string_key"), F.col("loaded_path").alias("string_path"), F.col("loaded_internal").alias("string_internal"), F.col("rule").alias("string_rule"))
    literal = F.try_element_at(F.filter("args", lambda a: a.isNotNull() & N.is_callable_literal(a)), F.lit(1))
    named = s.select(*SITE, F.regexp_replace(literal, r"^\\+", "").alias("literal")).where("literal IS NOT NULL")
    named = named.select(*SITE, N.norm(F.substring_index("literal", "::", 1)).alias("key"), F.substring_index("literal", "::", -1).alias("wanted"))
    met = ix.walk(named, "key", F.col("wanted"), F.lit(False)).where("hit IS NOT NULL")
    met = met.select(*SITE, F.col("hit.owner").alias("callable_owner"), F.col("hit.name").alias("callable_member"), F.col("hit.target_path").alias("callable_path"), F.col("hit.internal").alias("callable_internal"))
    return loaded.repartition(*FILE).join(met, SITE, "full")


# receivers and calls


class Calls:
    """Types of receivers and outcomes of call sites, found together.

    A variable's type is that of its last assignment before the place that asks;
    copies of variables are followed to where the value was made (roots). Values
    made by a call have a type once that call is resolved, so sites are resolved
    in rounds; within a round everything is a join.
    """

    def __init__(self, ix: Index, literals: bool = True, forwarding: bool = True):
        """Without literals, loader calls give their result no type; without forwarding, a caught call stays at the magic method."""
        self.ix, self.forwarding = ix, forwarding
        strings = string_targets(ix)
        self.strings = materialize(strings if literals else strings.where(F.lit(False)), "strings", together=True)
        self._link()
        self._run()

    # which assignment each variable stands for

    def _roots(self) -> DataFrame:
        """Assignments with the assignment that made their value: itself, or for a copy that of the variable copied at that place (null: none)."""
        a = self.ix.e.assignments.select(*METHOD, "ord", "var", "rhs_kind", "name", "line", "col")
        after = lambda n: F.struct(F.coalesce("line", F.lit(0)).cast("long").alias("a"), F.col("ord").cast("long").alias("b"), F.lit(n).alias("c"))
        copies = a.where("rhs_kind = 'var'").select(*METHOD, F.col("name").alias("var"), F.col("ord").alias("id"), "ord", "line")
        prev = _last_before(a, copies, after(1), after(0), METHOD).select(*FILE, F.col("id").alias("ord"), "prev")
        root = a.select(*FILE, "ord", "rhs_kind").repartition(*FILE).join(prev, SITE, "left").select(*FILE, "ord", F.when(F.col("rhs_kind") == "var", F.col("prev")).otherwise(F.col("ord")).alias("root"), (F.col("rhs_kind") == "var").alias("copy"))
        root = materialize(root, "roots", together=True)
        while not root.where("copy AND root IS NOT NULL").isEmpty():  # each round doubles how far copies are followed
            next_ = root.select(*FILE, F.col("ord").alias("root"), F.col("root").alias("_to"), F.col("copy").alias("_copy"))
            met = root.repartition(*FILE).join(next_, ["root", *FILE], "left")
            root = materialize(met.select(*FILE, "ord", F.when(F.col("copy"), F.col("_to")).otherwise(F.col("root")).alias("root"), (F.col("copy") & F.coalesce("_copy", F.lit(False))).alias("copy")), "roots", together=True)
        return root.select(*FILE, "ord", "root")

    def _asked(self, rows: DataFrame, rooted: DataFrame) -> DataFrame:
        """rows (METHOD, namespace, ord, line, r_kind, r_text) with fixed, param (a variable's declared type) and what rooted says of the variable's last assignment (prev)."""
        e, ix = self.ix.e, self.ix
        a = e.assignments.select(*METHOD, "ord", "var", "line")
        here = F.struct(F.coalesce("line", F.lit(0)).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.col("ord").cast("long").alias("c"))
        there = F.struct(F.coalesce("line", F.lit(0)).cast("long").alias("a"), F.lit(1).cast("long").alias("b"), F.lit(0).cast("long").alias("c"))
        asked = rows.where("r_kind = 'var'").select(*METHOD, F.col("r_text").alias("var"), F.col("ord").alias("id"), "line")
        last = _last_before(a, asked, here, there, METHOD).where("prev IS NOT NULL").select(*FILE, F.col("id").alias("ord"), "prev")
        last = last.join(rooted, ["prev", *FILE]).drop("prev")
        met = ix.typed(rows.repartition(*FILE)).join(_of_file(ix.param_types), [*METHOD, "r_text"], "left")
        return met.join(last, SITE, "left")

    def _link(self) -> None:
        e, ix = self.ix.e, self.ix
        self.roots = self._roots()
        made = e.assignments.where("rhs_kind <> 'var'").withColumn("text", F.trim(F.coalesce(F.nullif("qualified", F.lit("")), "name")))
        made = ix.meaning(made.repartition(*FILE), "text", key="new_key").withColumn("r_text", N.norm(F.col("name"))).join(_of_file(ix.property_types.select(*CLASS, F.col("prop").alias("r_text"), F.col("key").alias("prop_key"))), [*CLASS, "r_text"], "left")
        kind = F.col("rhs_kind")
        known = F.when(kind == "dynamic", DYNAMIC).when(kind == "new", F.col("new_key")).when((kind == "prop") & (F.col("receiver") == "$this"), F.col("prop_key"))
        calls = e.sites.groupBy(*METHOD, "line", "col").agg(F.max("ord").alias("site"))
        made = made.select(*METHOD, "ord", "line", "col", "var", "rhs_kind", known.alias("known")).join(calls, ["line", "col", *METHOD], "left")
        made = made.join(self.strings.select(*FILE, F.col("ord").alias("site"), "string_key").where("string_key IS NOT NULL"), ["site", *FILE], "left")
        made = made.withColumn("calls", kind == "call").withColumn("settled", ~F.col("calls") | F.col("site").isNull() | F.col("string_key").isNotNull())
        type_ = F.when(F.col("calls"), F.col("string_key")).otherwise(F.col("known"))
        made = made.withColumns({"type": type_, "hops": F.when(F.col("calls") & F.col("string_key").isNotNull(), 1).otherwise(0), "ready": F.when(F.col("calls"), _place(made)).otherwise(F.lit(-1).cast("long"))})
        self.made = materialize(made.select(*METHOD, F.col("ord").alias("root"), "line", "var", "site", "calls", "settled", "type", "hops", "ready"), "made", together=True)
        # each assignment with what is known of the value that it stands for
        made = self.made.select(*FILE, "root", "ready", "settled", F.col("type").alias("r_type"), F.col("hops").alias("r_hops"))
        rooted = self.roots.where("root IS NOT NULL").repartition(*FILE).join(made, ["root", *FILE])
        self.rooted = materialize(rooted.withColumnRenamed("ord", "prev"), "rooted", together=True)

    # rounds

    def _run(self) -> None:
        """Sites are prepared in one pass over them; later rounds read what they wait for only."""
        e = self.ix.e
        asked = self._prepare(self._asked(_receiver(e.sites, "receiver"), self.rooted))
        # a call's value is seen only after the call
        mine = F.col("root").isNotNull() & (F.col("ready") < _place(asked))
        asked = asked.withColumns({"of_root": F.col("root"), "root": F.when(mine, F.col("root")), "type": F.when(mine & F.col("settled"), F.col("r_type")), "hops": F.when(mine & F.col("settled"), F.col("r_hops"))})
        open_ = materialize(asked.drop("ready", "r_text", "r_hops"), "asked", together=True)
        # values made by calls, with the receiver that an entity-returning call has at its own line
        own = open_.select(*FILE, F.col("ord").alias("site"), F.col("fixed").alias("of_fixed"), F.col("param").alias("of_param"), "of_root", F.col("settled").alias("of_known"), F.col("r_type").alias("of_type"))
        waiting = self.made.where("calls AND NOT settled").select(*FILE, "root", "site").repartition(*FILE).join(own, ["site", *FILE])
        other = F.col("of_root") != F.col("root")
        waiting = materialize(waiting.withColumns({c: F.when(other, F.col(c)) for c in ("of_root", "of_known", "of_type")}), "waiting", together=True)
        open_ = open_.drop("of_root", "settled", "r_type")
        mine = F.col("root").isNull() | F.col("hops").isNotNull()
        ready = open_.where(mine).withColumns({"type": F.when(F.col("r_kind") == "var", F.coalesce("type", "param")).otherwise(F.col("fixed")), "hops": F.when(F.col("type").isNotNull(), F.col("hops")).otherwise(F.lit(0))})
        pending = open_.where(~mine).drop("type", "hops")
        self.records, fresh, held, self.learned = self._route(ready), [], None, None
        fresh = [waiting.repartition(*FILE).join(self._outcome(self.records), ["site", *FILE])]
        while True:
            met = self._met(fresh + [held] * (held is not None))
            types = materialize(self._values(met.where("told")), "values", together=True)
            if types.isEmpty():
                break
            self.learned = types if self.learned is None else self.learned.unionByName(types)
            held, fresh = met.where("NOT told").drop("told"), []
            now = materialize(pending.repartition(*FILE).join(types.withColumn("_now", F.lit(True)), ["root", *FILE], "left"), "pending", together=True)
            ready = now.where("_now").withColumn("type", F.coalesce("type", "param")).drop("_now")
            pending = now.where("_now IS NULL").drop("type", "hops", "_now")
            if not ready.isEmpty():
                done = self._route(ready)
                self.records = self.records.unionByName(done)
                fresh = [waiting.repartition(*FILE).join(self._outcome(done), ["site", *FILE])]
        late = pending.withColumns({"type": F.col("param"), "hops": F.lit(0)})  # values that never settle: lines that assign to one another
        if not late.isEmpty():
            self.records = self.records.unionByName(self._route(late))

    def _outcome(self, done: DataFrame) -> DataFrame:
        return done.select(*FILE, F.col("ord").alias("site"), F.col("target_owner").alias("_owner"), F.col("target_member").alias("_member"), F.col("hops").alias("_hops"))

    def _met(self, parts: list[DataFrame]) -> DataFrame:
        """Values whose call is resolved, with told: whether all that their type depends on is known."""
        met = parts[0]
        for more in parts[1:]:
            met = met.unionByName(more)
        if self.learned is not None:
            found = self.learned.select(*FILE, F.col("root").alias("of_root"), F.col("type").alias("_of"), F.lit(True).alias("_found"))
            met = met.repartition(*FILE).join(found, ["of_root", *FILE], "left")
            met = met.withColumns({"of_type": F.coalesce("of_type", "_of"), "of_known": F.coalesce("_found", "of_known")}).drop("_of", "_found")
        entity = F.coalesce(F.lower("_member").isin(*C.ENTITY_RETURNING), F.lit(False))
        return materialize(met.withColumn("told", ~entity | F.col("of_root").isNull() | F.coalesce("of_known", F.lit(False))), "met", together=True)

    def _values(self, met: DataFrame) -> DataFrame:
        """Types (root, type, hops) of the values that are told."""
        ix = self.ix
        met = met.withColumn("key", F.when(F.lower("_member").isin(*C.ENTITY_RETURNING), F.coalesce("of_fixed", "of_type", "of_param")))
        met = met.join(ix.entity_of, ["repo", "key"], "left").drop("key")
        met = met.withColumns({"key": N.norm(F.col("_owner")), "has": N.norm(F.col("_member"))}).join(ix.returns, ["repo", "key", "has"], "left")
        return met.select(*FILE, "root", F.coalesce("entity", "returned").alias("type"), (F.col("_hops") + 1).alias("hops"))

    def _prepare(self, sites: DataFrame) -> DataFrame:
        """Sites with all that does not depend on a type: what is located there, the class made, the function called, namesakes."""
        ix = self.ix
        s = sites.withColumns({"receiver": F.trim(F.coalesce("receiver", F.lit(""))), "name": F.coalesce("name", F.lit("")), "_dynamic": F.coalesce("dynamic", F.lit(False))})
        # what a language server located
        s = s.join(ix.places, ["line", "col", *FILE], "left").withColumn("_n", F.coalesce(F.size("_seen"), F.lit(0)))
        # new: the class, at its own constructor
        s = ix.meaning(s.withColumn("_new", F.when(F.col("kind") == "new", F.trim(F.coalesce(F.nullif("qualified", F.lit("")), "name")))), "_new", fqcn="_new_owner", target_path="_new_path", internal="_new_internal", construct="_new_construct")
        made = F.coalesce("_at", F.when(F.col("_new_owner").isNotNull(), F.struct(F.col("_new_owner").alias("owner"), F.lit("").alias("name"), F.col("_new_path").alias("target_path"), F.col("_new_internal").alias("internal"))))
        construct = F.when(F.col("_at").isNotNull(), F.col("_at_construct")).otherwise(F.col("_new_construct"))
        s = s.withColumns({"_made": F.when(F.col("kind") == "new", made), "_construct": F.when(F.col("kind") == "new", construct)}).drop("_new", "_new_owner", "_new_path", "_new_internal", "_new_construct", "_at_construct")
        # functions: the alias, else here, else global
        alias = first_wins(ix.e.uses.where("kind = 'function'").select(*FILE, N.norm(F.col("alias")).alias("_alias"), (-F.col("ord")).alias("at"), F.col("fqcn").alias("_means")), [*FILE, "_alias"], [F.col("at")]).drop("at")
        text = F.trim(F.coalesce(F.nullif("qualified", F.lit("")), "name"))
        f = candidate_names(s.where("kind = 'function'").select(*SITE, "namespace", text.alias("text")), ix.e.uses.where("kind = 'class'"))
        f = f.withColumn("_alias", N.norm(F.col("text"))).join(alias, [*FILE, "_alias"], "left")
        spaced = F.when(F.coalesce("namespace", F.lit("")) != "", F.array(F.concat("namespace", F.lit("\\"), "text"), F.col("text"))).otherwise(F.array("text"))
        names = F.when(F.col("text").contains("\\"), F.col("candidates")).when(F.col("_means").isNotNull(), F.array("_means")).otherwise(spaced)
        f = f.select(*SITE, F.posexplode(names).alias("_pos", "_called")).withColumn("key", N.norm(F.col("_called"))).join(ix.functions, ["repo", "key"])
        f = first_wins(f.select(*SITE, "_pos", "_called", F.col("target_path").alias("_function")), SITE, [F.col("_pos")]).drop("_pos")
        one = F.when(F.col("_n") == 1, F.col("_seen")[0])
        s = s.join(f, SITE, "left").withColumns({"_one": one["hit"], "_is_face": one["face"], "literal": F.coalesce(F.size("args") > 0, F.lit(False))})
        return s.withColumn("_seen", F.transform("_seen", lambda x: x["hit"])).drop("qualified", "dynamic", "args")

    def _route(self, sites: DataFrame) -> DataFrame:
        """Prepared sites (written) with their receiver's type, each with the one rule that settles it: status, via, target and candidates.

        Sites stay with their file. What is looked up by a class or a name is
        asked aside, by narrow rows of the sites that need it, which come back
        to the file; sites that ask nothing are not shuffled.
        """
        ix, s = self.ix, sites
        keep = [*METHOD, "ord", "line", "name", "kind", "receiver", "type", "hops", "literal"]
        # members, by the receiver's type
        static = (F.col("kind") == "static") & ~F.col("receiver").isin("parent", "self", "static")
        typed = s.where(F.col("type").isNotNull() & (F.col("type") != DYNAMIC))
        plain = ~F.coalesce("_dynamic", F.lit(False)) & ~F.coalesce("kind", F.lit("")).isin("new", "function") & (F.col("_n") == 0)
        named = ix.walk(typed.where(plain).select(*SITE, "type", "name", static.alias("_s")).repartition("repo", "type"), "type", F.col("name"), F.col("_s"))
        named = named.where("hit IS NOT NULL").withColumns({"key": F.col("type"), "has": N.norm(F.col("name"))}).join(ix.forwarded if self.forwarding else ix.forwarded.where(F.lit(False)), ["repo", "key", "has"], "left")
        named = named.select(*SITE, "rule", "hit", "forward")
        # an interface's method that was located, at the concrete class
        one = F.col("_one")
        faces = ix.classes.where("kind = 'interface'").select("repo", F.col("key").alias("_face"), F.lit(True).alias("_still"))
        sure = ix.walk(typed.where("_is_face").select(*SITE, "type", "_one"), "type", one["name"], F.lit(False)).where("rule = 'chain'")
        sure = sure.withColumn("_face", N.norm(F.col("hit.owner"))).join(faces, ["repo", "_face"], "left_anti").select(*SITE, F.col("hit").alias("_c_hit"))
        runtime = (F.col("type") == DYNAMIC) | ((F.col("kind") == "static") & F.col("receiver").startswith("$") & F.col("type").isNull())
        same = s.where(runtime).select(*SITE, N.norm(F.col("name")).alias("key")).join(self._namesakes, ["repo", "key"]).drop("key")
        asks = F.coalesce((F.col("type").isNotNull() & (F.col("type") != DYNAMIC) & (plain | F.coalesce("_is_face", F.lit(False)))) | runtime, F.lit(False))
        s = s.where(asks).repartition(*FILE).join(named, SITE, "left").join(sure, SITE, "left").join(same, SITE, "left").unionByName(s.where(~asks), allowMissingColumns=True)
        concrete = F.col("_c_hit").isNotNull()
        # one rule for each site, in order
        magic = F.col("rule") == "magic_call"
        target = lambda h: F.struct(h["owner"].alias("owner"), h["name"].alias("name"), h["target_path"].alias("target_path"), h["internal"].alias("internal"))
        none = F.lit(None).cast("struct<owner: string, name: string, target_path: string, internal: boolean>")
        called = F.struct(F.lit("").alias("owner"), F.col("_called").alias("name"), F.col("_function").alias("target_path"), F.lit(True).alias("internal"))
        constructed = F.struct(F.col("_made.owner").alias("owner"), F.coalesce("_construct", F.lit("")).alias("name"), F.col("_made.target_path").alias("target_path"), F.col("_made.internal").alias("internal"))
        case = (
            F.when(F.col("_dynamic"), "dynamic").when((F.col("kind") == "new") & F.col("_made").isNotNull(), "new").when(F.col("kind") == "new", "nothing")
            .when(F.col("_n") == 1, "located").when(F.col("_n") > 1, "several").when((F.col("kind") == "function") & F.col("_function").isNotNull(), "function").when(F.col("kind") == "function", "nothing")
            .when(runtime, "runtime").when(F.col("hit").isNotNull(), "member").otherwise("nothing")
        )
        s = s.withColumn("_case", case)
        is_ = lambda x: F.col("_case") == x
        hit = F.when(is_("new"), constructed).when(is_("located") & concrete, target(F.col("_c_hit"))).when(is_("located"), target(one)).when(is_("function"), called).when(is_("member") & magic & F.col("forward").isNotNull(), target(F.col("forward"))).when(is_("member"), target(F.col("hit"))).otherwise(none)
        rule = F.when(magic & F.col("forward").isNotNull(), "magic_proxy").when(magic & N.is_magic_finder(F.col("name")), "magic_finder").otherwise(F.col("rule"))
        via = F.when(is_("new"), F.when(F.col("_at").isNotNull(), "lsp").otherwise("parser")).when(is_("located"), F.when(concrete, "lsp+concrete").otherwise("lsp")).when(is_("several"), "lsp").when(is_("function"), "convention:function_fallback").when(is_("member"), F.concat(F.lit("convention:"), rule)).otherwise("none")
        several = F.transform("_seen", target)
        few = F.when(is_("several"), several).when(is_("runtime"), F.col("_same"))
        status = F.when(is_("several"), "ambiguous").when(is_("dynamic") | is_("runtime"), "dynamic").otherwise(_status(hit))
        s = materialize(s.select(*keep, "namespace", hit.alias("_target"), via.alias("via"), status.alias("status"), few.alias("candidates")), "routed", together=True)
        # static:: where descendants declare the member again
        asked = s.where("kind = 'static' AND receiver = 'static' AND _target IS NOT NULL").select(*SITE, N.norm(F.col("_target.owner")).alias("_t"), N.norm(F.col("_target.name")).alias("_m"))
        below = asked.join(self._overrides(asked.select("repo", "_t", "_m").distinct()), ["repo", "_t", "_m"]).drop("_t", "_m")
        late = s.where("kind = 'static' AND receiver = 'static'").repartition(*FILE).join(below, SITE, "left")
        none_below = F.lit(None).cast("array<string>").alias("_below")
        s = materialize(late, "late", together=True).unionByName(s.where("NOT (kind <=> 'static' AND receiver <=> 'static')").select("*", none_below))
        late = F.col("_below").isNotNull()
        told = F.when(late, F.concat(F.array("_target"), F.transform("_below", lambda c: F.struct(c.alias("owner"), F.col("_target.name").alias("name"), F.lit("").alias("target_path"), F.lit(True).alias("internal"))))).otherwise(F.col("candidates"))
        out = F.when(~late, F.col("_target"))
        return s.select(*keep, F.when(late, "ambiguous").otherwise(F.col("status")).alias("status"), "via", out["owner"].alias("target_owner"), out["name"].alias("target_member"), out["target_path"].alias("target_path"), F.coalesce(told, F.array().cast("array<struct<owner: string, name: string, target_path: string, internal: boolean>>")).alias("candidates"))

    @cached_property
    def _namesakes(self) -> DataFrame:
        """(repo, key) of member names that at most five internal classes declare as a method, with the targets; counted before they are gathered."""
        rows = self.ix.e.members.where("member_kind = 'method' AND class_name <> '(global)'").select("repo", N.norm(F.col("name")).alias("key"), F.struct(F.when(F.col("fqcn") != "", F.col("fqcn")).otherwise(F.col("class_name")).alias("owner"), "name", F.col("path").alias("target_path"), F.lit(True).alias("internal")).alias("hit"), "path", "ord")
        rows = rows.join(self.ix.e.classes.where("internal").select("repo", "path").distinct(), ["repo", "path"], "left_semi")
        few = rows.groupBy("repo", "key").agg(F.count("*").alias("n")).where("n <= 5").drop("n")
        got = rows.join(few, ["repo", "key"]).groupBy("repo", "key").agg(F.array_sort(F.collect_list(F.struct("path", "ord", "hit"))).alias("all"))
        return materialize(got.select("repo", "key", F.transform("all", lambda x: x["hit"]).alias("_same")), "namesakes")

    @cached_property
    def _below(self) -> DataFrame:
        """(repo, _t, below): classes and the internal classes that extend them, transitively."""
        ups = self.ix.parents.where("relation = 'extends' AND parent IS NOT NULL").select("repo", F.col("key").alias("fqcn"), F.col("parent"), "pos", "relation")
        rows = lineage(ups, self.ix.classes.select("repo", F.col("key").alias("fqcn"))).where("depth > 0 AND ancestor <> fqcn")
        return materialize(rows.select("repo", F.col("ancestor").alias("_t"), F.col("fqcn").alias("below")).join(self.ix.classes.where("internal").select("repo", F.col("key").alias("below")), ["repo", "below"]), "below")

    def _overrides(self, asked: DataFrame) -> DataFrame:
        """(repo, _t, _m) with the descendants of a class that declare the member again, by name."""
        met = asked.join(self._below, ["repo", "_t"]).join(self.ix.methods.select("repo", F.col("key").alias("below"), F.col("has").alias("_m"), "owner"), ["repo", "below", "_m"])
        return met.groupBy("repo", "_t", "_m").agg(F.array_sort(F.collect_set("owner")).alias("_below"))

    # what reads the settled types

    def told(self, records: DataFrame, strings: DataFrame) -> DataFrame:
        """records with what their literals name; sites without a literal are not shuffled."""
        asked = records.where("literal").repartition(*FILE).join(strings, SITE, "left")
        return asked.unionByName(records.where("NOT literal"), allowMissingColumns=True)

    @cached_property
    def types(self) -> DataFrame:
        """(FILE, prev) to the type of the value that an assignment stands for."""
        types = self.rooted.select(*FILE, "prev", "root", "r_type")
        if self.learned is not None:
            types = types.repartition(*FILE).join(self.learned.select(*FILE, "root", "type"), ["root", *FILE], "left").withColumn("r_type", F.coalesce("type", "r_type"))
        return materialize(types.select(*FILE, "prev", "r_type"), "types", together=True)

    def _settled(self, rows: DataFrame, receiver: str) -> DataFrame:
        met = self._asked(_receiver(rows, receiver), self.types)
        return met.withColumn("type", F.when(F.col("r_kind") == "var", F.coalesce("r_type", "param")).otherwise(F.col("fixed"))).drop("r_type")

    def properties(self) -> DataFrame:
        """Property reads that reach an accessor: a virtual getter on the heritage, a proxied getter, or __get; declared properties have no row."""
        ix = self.ix
        rows = materialize(self._settled(ix.e.reads, "receiver").where("type IS NOT NULL"), "settled", together=True).repartition("repo", "type")
        declared = ix.lines.join(ix.owned.where("member_kind = 'property'").select("repo", F.col("key").alias("ancestor"), "has").distinct(), ["repo", "ancestor"]).select("repo", F.col("fqcn").alias("type"), F.col("has").alias("_has")).distinct()
        rows = rows.withColumn("_has", N.norm(F.col("name"))).join(declared, ["repo", "type", "_has"], "left_anti").drop("_has")
        keep = [*METHOD, "ord", "line", "name", "receiver", "type"]
        got = ix.walk(rows.select(*keep), "type", N.virtual_getter(F.col("name")), F.lit(False)).withColumns({"_v_rule": F.col("rule"), "_v_hit": F.col("hit")}).drop("rule", "hit")
        got = ix.walk(got, "type", F.lit("__get"), F.lit(False))
        plain = F.concat(F.lit("get"), F.upper(F.substring("name", 1, 1)), F.expr("substring(name, 2)"))
        got = got.withColumns({"key": F.col("type"), "has": N.norm(plain)}).join(ix.forwarded, ["repo", "key", "has"], "left")
        virtual, caught = F.col("_v_rule") == "chain", F.col("rule").isin("chain", "magic_call")
        hit = F.when(virtual, F.col("_v_hit")).when(caught, F.coalesce("forward", "hit"))
        via = F.when(virtual, "convention:entity_virtual").when(F.col("forward").isNotNull(), "convention:magic_proxy").otherwise("convention:magic_get")
        got = materialize(got.select(*keep, hit.alias("hit"), via.alias("via")).where("hit IS NOT NULL"), "accessors", together=True)
        return got.select(*keep, _status(F.col("hit")).alias("status"), "via", F.col("hit.owner").alias("target_owner"), F.col("hit.name").alias("target_member"), F.col("hit.target_path").alias("target_path"))

    def class_refs(self) -> DataFrame:
        """References to classes with status, via and target; array callables on receivers of unknown or run-time class have no row."""
        ix = self.ix
        keep = [*METHOD, "ord", "line", "kind", "name", "status", "via", "target_owner", "target_member", "target_path"]
        refs = ix.e.class_refs
        named = ix.meaning(refs.where("kind = 'class_literal'").withColumn("text", F.trim("text")), "text", fqcn="target_owner", target_path="target_path", internal="_internal")
        named = named.withColumns({"status": F.when(F.col("target_owner").isNull(), "unresolved").when(F.col("_internal"), "resolved").otherwise("external"), "via": F.when(F.col("target_owner").isNull(), "none").otherwise("parser"), "target_member": F.when(F.col("target_owner").isNotNull(), "")})
        arrays = materialize(self._settled(refs.where("kind = 'array_callable'"), "text").where(F.col("type").isNotNull() & (F.col("type") != DYNAMIC)), "settled", together=True)
        strings = refs.where("kind = 'callable_string'").withColumn("type", N.norm(F.regexp_replace("text", r"^\\+", "")))
        out = named.select(keep)
        for rows, via in ((arrays, "convention:array_callable"), (strings, "convention:callable_literal")):
            met = ix.walk(rows.repartition("repo", "type"), "type", F.col("name"), F.lit(False))
            out = out.unionByName(met.withColumns({"status": _status(F.col("hit")), "via": F.when(F.col("hit").isNull(), "none").otherwise(via), "target_owner": F.col("hit.owner"), "target_member": F.col("hit.name"), "target_path": F.col("hit.target_path")}).select(keep))
        return out


def records(ix: Index, calls: Calls) -> tuple[DataFrame, DataFrame]:
    """(records, candidates) as plans.codegraph reads them: calls, props, class_refs, inherits and imports of all files."""
    cols = ["section", *FILE, "ord", "class_name", "fqcn", "member", "name", "status", "via", "relation", "line", "target_path", "target_owner", "target_member", "string_path", "callable_path", "callable_owner", "callable_member"]
    none = F.lit(None).cast("string")
    inside = F.when(F.col("status") == "resolved", F.col("target_path"))
    blank = {c: none for c in ("string_path", "callable_path", "callable_owner", "callable_member")} | {"relation": F.lit("")}
    strings = calls.strings.select(*SITE, F.when(F.col("string_internal"), F.col("string_path")).alias("string_path"), F.when(F.col("callable_internal"), F.col("callable_path")).alias("callable_path"), "callable_owner", "callable_member")
    # functions stand under their namespaced name, as members of the file's (global) class they are looked up by the plain one
    owner = F.when(F.col("target_owner") == "", "(global)").otherwise(F.col("target_owner"))
    member = F.when(F.col("target_owner") == "", F.substring_index("target_member", "\\", -1)).otherwise(F.col("target_member"))
    parts = [calls.told(calls.records, strings).withColumns({"section": F.lit("calls"), "relation": F.lit(""), "target_path": inside, "target_owner": owner, "target_member": member})]
    parts.append(calls.properties().withColumns({"section": F.lit("props"), "target_path": inside} | blank))
    parts.append(calls.class_refs().withColumns({"section": F.lit("class_refs"), "target_path": inside} | blank))
    parts.append(resolve_heritage(ix).withColumns({"section": F.lit("inherits"), "target_path": inside} | blank | {"relation": F.col("relation"), "ord": F.col("pos").cast("long"), "member": F.lit(""), "name": F.lit(""), "target_member": F.lit("")}))
    parts.append(resolve_imports(ix).withColumns({"section": F.lit("imports"), "target_path": inside} | blank | {"class_name": F.lit(""), "name": F.col("fqcn"), "fqcn": F.lit(""), "member": F.lit(""), "via": F.lit("parser"), "target_owner": F.lit(""), "target_member": F.lit("")}))
    out = parts[0].select(cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(cols))
    some = calls.records.where("status = 'ambiguous'").select(*FILE, F.lit("calls").alias("section"), "ord", F.posexplode("candidates").alias("pos", "c"))
    paths = ix.classes.select("repo", F.col("key").alias("_key"), F.col("path").alias("_path"))
    some = some.withColumn("_key", N.norm(F.col("c.owner"))).join(paths, ["repo", "_key"], "left")
    return out, some.select(*FILE, "section", "ord", F.col("pos").cast("long").alias("pos"), F.coalesce(F.nullif("c.target_path", F.lit("")), "_path").alias("target_path"), F.col("c.owner").alias("target_owner"), F.col("c.name").alias("target_member"))


def cross_method_calls(entities: Entities, known: DataFrame) -> DataFrame:
    """CrossRepoCalls of methods: every site typed over the classes of all repositories together, chains of calls included.

    The callee must be declared by a class with exactly one entry in known
    (norm_fqcn, repo, fqcn, class_id), in another repository; vendor copies
    define nothing. Sites are method, nullsafe and static calls with a name;
    properties may take their type from constructor parameters.
    """
    app = {}
    for name in Entities.__dataclass_fields__:
        rows = getattr(entities, name).where(N.origin(F.col("path")) == "app")
        rows = rows.withColumns({"path": F.concat("repo", F.lit(":"), "path"), "repo": F.lit("*")})
        app[name] = rows.limit(0) if name == "located" else rows
    app["sites"] = app["sites"].where("kind IN ('method', 'nullsafe', 'static') AND name <> '' AND NOT coalesce(dynamic, false)")
    ix = Index(Entities(**app), promoted=True)
    calls = Calls(ix, literals=False, forwarding=False).records.where("target_member <> ''")
    found = calls.select(F.substring_index("path", ":", 1).alias("repo"), F.regexp_replace("path", "^[^:]*:", "").alias("path"), "class_name", "fqcn", "member", "target_owner", "target_member", "target_path")
    caller = N.make_id("method", F.col("repo"), F.col("path"), F.when(F.col("fqcn") != "", F.col("fqcn")).otherwise(F.col("class_name")), F.col("member"))
    refs = found.select("repo", caller.alias("caller_method"), N.norm(F.col("target_owner")).alias("name"), "target_owner", "target_member", F.regexp_replace("target_path", "^[^:]*:", "").alias("callee_path"))
    owned = classify_owners(refs, known.select(F.col("norm_fqcn").alias("name"), F.col("repo").alias("owner")), source="repo").where("status = 'owned'")
    callee = N.make_id("method", F.col("owner"), F.col("callee_path"), F.col("target_owner"), F.col("target_member"))
    edges = owned.select("caller_method", callee.alias("callee_method"), F.col("repo").alias("source_repo"), F.col("owner").alias("target_repo"), F.concat_ws("::", "target_owner", "target_member").alias("symbol"))
    best = edges.groupBy("caller_method", "callee_method", "source_repo", "target_repo").agg(F.min("symbol").alias("symbol"))
    return best.select(N.make_id("xcall", F.col("caller_method"), F.col("callee_method")).alias("edge_id"), "*")
