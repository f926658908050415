"""Naming conventions of the framework: from loader calls, tables and controllers to class names; ER diagram parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.names import singularize, split_plugin

#: Loader method (lower case) to sub-namespace and class suffix.
LOADERS = {
    "fetchtable": ("Model\\Table", "Table"),
    "loadmodel": ("Model\\Table", "Table"),
    "addbehavior": ("Model\\Behavior", "Behavior"),
    "loadcomponent": ("Controller\\Component", "Component"),
    "loadhelper": ("View\\Helper", "Helper"),
    "addhelper": ("View\\Helper", "Helper"),
}
#: Sub-namespaces of the framework's own classes where they differ by loader.
CORE_LOADERS = {"addbehavior": "ORM\\Behavior", "loadcomponent": "Controller\\Component", "loadhelper": "View\\Helper", "addhelper": "View\\Helper"}
#: Methods of a table that return one of its entities.
ENTITY_RETURNING = ["get", "first", "firstorfail", "newentity", "newemptyentity", "patchentity", "findorcreate"]


def loader_candidates(method: Column, argument: Column, root: Column) -> Column:
    """array<string>: class names that a loader call with a literal may mean, most specific first.

    The named plugin alone; else the caller's root namespace, the app's and the
    framework's. Empty for other methods and arguments that are no identifier.
    """
    key, parts = F.lower(method), split_plugin(argument)
    pick = lambda values: F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)
    space, suffix = pick({k: v[0] for k, v in LOADERS.items()}), pick({k: v[1] for k, v in LOADERS.items()})
    core = F.coalesce(F.when(key.isin(*CORE_LOADERS), pick(CORE_LOADERS)), space)
    name = F.when(parts["rest"].endswith(suffix), parts["rest"]).otherwise(F.concat(parts["rest"], suffix))
    under = lambda base, sub: F.concat(base, F.lit("\\"), sub, F.lit("\\"), name)
    own = F.when((F.coalesce(root, F.lit("")) != "") & ~root.isin("App", "Cake"), F.array(under(root, space))).otherwise(F.array().cast("array<string>"))
    roots = F.when(parts["plugin"].isNotNull(), F.array(F.when(parts["plugin"] == "Cake", under(parts["plugin"], core)).otherwise(under(parts["plugin"], space)))).otherwise(F.concat(own, F.array(under(F.lit("App"), space), under(F.lit("Cake"), core))))
    return F.when(key.isin(*LOADERS) & parts["rest"].rlike(r"^[A-Za-z_]\w*$"), roots).otherwise(F.array().cast("array<string>"))


def locator_candidates(receiver: Column, argument: Column, root: Column) -> Column:
    """As fetchTable, where the receiver of get() is a table locator."""
    found = loader_candidates(F.lit("fetchTable"), argument, root)
    return F.when(F.coalesce(receiver, F.lit("")).rlike(r"(?i)getTableLocator\(\)|TableRegistry|tableLocator"), found).otherwise(F.array().cast("array<string>"))


def entity_class(table_class: Column) -> Column:
    """Root\\Model\\Entity\\<singular> of Root\\Model\\Table\\<name>Table; null for other classes."""
    pattern = r"^(.*)\\Model\\Table\\(\w+)Table$"
    name = F.concat(F.regexp_extract(table_class, pattern, 1), F.lit("\\Model\\Entity\\"), singularize(F.regexp_extract(table_class, pattern, 2)))
    return F.when(table_class.rlike(pattern), name)


def default_table(controller: Column) -> Column:
    """Root\\Model\\Table\\<name>Table of Root\\Controller\\..\\<name>Controller; null for the App and Error controllers and other classes."""
    pattern = r"^(.*)\\Controller\\(?:\w+\\)*(\w+)Controller$"
    name = F.regexp_extract(controller, pattern, 2)
    return F.when(controller.rlike(pattern) & ~name.isin("App", "Error", ""), F.concat(F.regexp_extract(controller, pattern, 1), F.lit("\\Model\\Table\\"), name, F.lit("Table")))


def er_operator(cardinality: Column) -> Column:
    """The diagram's relation operator; one to many by default."""
    c = F.lower(F.coalesce(cardinality, F.lit("")))
    return F.when(c.rlike("n-n|many-to-many|多対多"), "}o--o{").when(c.rlike("^n-1|many-to-one|多対一"), "}o--||").when(c.rlike("1-1|one-to-one|一対一"), "||--||").otherwise("||--o{")


def er_token(name: Column) -> Column:
    """Letters, digits and underscores; 'x' for nothing."""
    token = F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), "[^0-9A-Za-z_]", "_")
    return F.when(token == "", "x").otherwise(token)


def er_relation(source: Column, target: Column, cardinality: Column, via: Column) -> Column:
    """One line of the diagram, labelled with at most 24 characters of via."""
    label = F.substring(F.trim(F.regexp_replace(F.coalesce(via, F.lit("")), '["\\n]', " ")), 1, 24)
    return F.concat(F.lit("    "), er_token(source), F.lit(" "), er_operator(cardinality), F.lit(" "), er_token(target), F.lit(' : "'), F.when(label == "", "rel").otherwise(label), F.lit('"'))


def markdown_cell(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[|\n]", " "))


def result_cell(value: Column, limit: int = 500) -> Column:
    """A query result as text of at most limit characters."""
    return F.substring(value.cast("string"), 1, limit)
