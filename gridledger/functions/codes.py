"""Fifteen-digit programme codes: their parts, zero-padded ancestors, shells and code hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where a code is cut into levels.
LENGTH = 15
CUTS = (1, 3, 5, 6, 7, 8, 13)
COST_LABELS = {"1": "General Administration and Support", "2": "Support to Operations", "3": "Operations", "4": "Special Purpose Funds"}
PARTS = {"cost_structure": (1, 1), "outcome": (2, 2), "program": (4, 2), "subprogram": (6, 1), "identifier": (7, 1), "order_no": (8, 5), "suffix": (13, 3)}


def is_code(code: Column) -> Column:
    return F.coalesce(code.rlike(r"^\d{15}$"), F.lit(False))


def split(code: Column) -> Column:
    return F.when(is_code(code), F.struct(*[F.substring(code, a, n).alias(name) for name, (a, n) in PARTS.items()]))


def is_project(code: Column) -> Column:
    """A locally funded or foreign assisted project: the identifier digit is 2 or 3."""
    return is_code(code) & F.substring(code, 7, 1).isin("2", "3")


def ancestors(code: Column) -> Column:
    """Zero-padded prefixes of a code, the nearest last; not the code itself, none twice, none all zero."""
    cut = [F.rpad(F.substring(code, 1, n), LENGTH, "0") for n in CUTS]
    return F.when(is_code(code), F.filter(F.array_distinct(F.array(*cut)), lambda a: (a != code) & (a != "0" * LENGTH)))


def _level(code: Column, names: tuple) -> Column:
    """names[i] for the first cut from which on all digits are zero, else the last name."""
    out = names[-1]
    for cut, name in reversed(list(zip((1, 3, 5, 6, 7), names))):
        out = F.when(F.substring(code, cut + 1, LENGTH - cut) == "0" * (LENGTH - cut), name).otherwise(out)
    return out


def shell_kind(code: Column) -> Column:
    """Kind of a synthesized ancestor, by its trailing zeros."""
    return _level(code, tuple(F.lit(f"prexc_{k}") for k in ("cost", "oo", "program", "subprogram", "identifier", "shell")))


def shell_label(code: Column) -> Column:
    p = split(code)
    cost = F.concat(F.lit("Cost structure "), p["cost_structure"])
    for digit, name in COST_LABELS.items():
        cost = F.when(p["cost_structure"] == digit, F.lit(name)).otherwise(cost)
    named = lambda word, part: F.concat(F.lit(f"{word} "), part)
    return _level(code, (cost, named("Organizational Outcome", p["outcome"]), named("Program", p["program"]), named("Sub-program", p["subprogram"]), named("Identifier", p["identifier"]), named("PREXC", code)))


def code_parents(nodes: DataFrame) -> DataFrame:
    """id, code_parent: the nearest existing ancestor by code, else the layout parent.

    nodes: table_id, doc_pos, id, parent, code. Of nodes with one code the last stands for it. One hash join
    on (table, code) of exploded ancestors, at most seven a node.
    """
    index = nodes.where(is_code(F.col("code"))).groupBy("table_id", "code").agg(F.max_by("id", "doc_pos").alias("found"))
    up = nodes.select("table_id", "id", F.posexplode(ancestors(F.col("code"))).alias("depth", "code"))
    best = up.join(index, ["table_id", "code"]).groupBy("table_id", "id").agg(F.max_by("found", "depth").alias("found"))
    return nodes.join(best, ["table_id", "id"], "left").select("table_id", "id", F.coalesce("found", "parent").alias("code_parent"))


def shells(nodes: DataFrame) -> DataFrame:
    """table_id, id, code, kind, label, parent of the ancestors that no node has, each once; the parent is the next shell or node up, or root."""
    have = nodes.where(is_code(F.col("code"))).select("table_id", "code").distinct()
    needed = nodes.select("table_id", F.explode(ancestors(F.col("code"))).alias("code")).distinct()
    missing = needed.join(have, ["table_id", "code"], "left_anti").select("table_id", F.concat(F.lit("prexc:"), "code").alias("id"), "code", shell_kind(F.col("code")).alias("kind"), shell_label(F.col("code")).alias("label"))
    index = nodes.where(is_code(F.col("code"))).groupBy("table_id", "code").agg(F.max_by("id", "doc_pos").alias("found"))
    everything = index.unionByName(missing.select("table_id", "code", F.col("id").alias("found")))
    up = missing.select("table_id", "id", F.posexplode(ancestors(F.col("code"))).alias("depth", "code"))
    best = up.join(everything, ["table_id", "code"]).groupBy("table_id", "id").agg(F.max_by("found", "depth").alias("found"))
    return missing.join(best, ["table_id", "id"], "left").select("table_id", "id", "code", "kind", "label", F.coalesce("found", F.lit("root")).alias("parent"))


def dual_hierarchy(nodes: DataFrame) -> DataFrame:
    """nodes with parent_pdf (by layout), parent_prexc (by code, existing nodes only) and parent (by code, shells
    included; uncoded nodes keep theirs)."""
    by_code = code_parents(nodes)
    shell = shells(nodes)
    index = nodes.where(is_code(F.col("code"))).groupBy("table_id", "code").agg(F.max_by("id", "doc_pos").alias("found"))
    everything = index.unionByName(shell.select("table_id", "code", F.col("id").alias("found")))
    up = nodes.select("table_id", "id", F.posexplode(ancestors(F.col("code"))).alias("depth", "code"))
    nearest = up.join(everything, ["table_id", "code"]).groupBy("table_id", "id").agg(F.max_by("found", "depth").alias("nearest"))
    out = nodes.withColumnRenamed("parent", "parent_pdf").join(by_code.withColumnRenamed("code_parent", "parent_prexc"), ["table_id", "id"]).join(nearest, ["table_id", "id"], "left")
    return out.withColumn("parent", F.coalesce("nearest", "parent_pdf")).drop("nearest")


def rewire_stats(dual: DataFrame) -> DataFrame:
    """table_id, n_nodes, n_rewired: coded nodes whose parent changed."""
    changed = is_code(F.col("code")) & ~F.col("parent").eqNullSafe(F.col("parent_pdf"))
    return dual.groupBy("table_id").agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(changed).alias("n_rewired"))
