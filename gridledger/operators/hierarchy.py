"""Hierarchies: levels from indents, parents from row order, and questions about trees.

Trees are node tables with a parent column. Questions about them walk a level a step, down from the top or up from
what was asked for, and touch a node once; nothing is collected, and cycles end a walk.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.functions import lexical
from gridledger.operators.keys import by_document, document_of, key_type
from gridledger.sources.scratch import stage_table

# Fixed values, in points: distances of levels, and how far a row may lie from its level's centre.
SECTION_DISTANCE = 540.0
UNIT_TOLERANCE, UNIT_GAP, UNIT_MIDPOINT = 4.0, 8.0, 466.5
PLAN_GAP, PLAN_STEP, PLAN_TOLERANCE = 6.0, 18.0, 4.0
SURE_DELTA = 1.5


# ---- rows and levels -------------------------------------------------------------------------------------
def segments(pages: DataFrame) -> DataFrame:
    """page, segment_id, gap_reset (and document): runs of consecutive pages; state isn't carried over a gap.

    The window is a document's pages.
    """
    own = document_of(pages)
    w = Window.partitionBy(*own).orderBy("page")
    gap = F.coalesce(F.col("page") != F.lag("page").over(w) + 1, F.lit(False))
    marked = pages.select(*own, "page").distinct().withColumn("gap_reset", gap)
    return marked.withColumn("segment_id", F.sum(F.col("gap_reset").cast("int")).over(w).cast("bigint")).select(*own, "page", "segment_id", "gap_reset")


@by_document("page")
def gap_clusters(distances: DataFrame, gap: float, key: str = "page") -> DataFrame:
    """key, cluster_no, centre, n: distances in descending order, a new cluster where the step down exceeds gap."""
    w = Window.partitionBy(key).orderBy(F.desc("distance"))
    new = F.coalesce((F.lag("distance").over(w) - F.col("distance") > gap).cast("int"), F.lit(0))
    numbered = distances.withColumn("_s", new).withColumn("cluster_no", F.sum("_s").over(w.rangeBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    return numbered.groupBy(key, "cluster_no").agg(F.median("distance").alias("centre"), F.count(F.lit(1)).alias("n"))


@by_document("page")
def unit_tiers(distances: DataFrame, key: str = "page") -> DataFrame:
    """key, region_centre, office_centre, weak, extra: the first cluster is the region tier, all others the office
    tier; a single cluster is one of both, by the midpoint."""
    w = Window.partitionBy(key).orderBy(F.desc("distance"))
    new = F.coalesce((F.lag("distance").over(w) - F.col("distance") > UNIT_GAP).cast("int"), F.lit(0))
    numbered = distances.withColumn("_s", new).withColumn("c", F.sum("_s").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    centres = numbered.groupBy(key).agg(F.median(F.when(F.col("c") == 0, F.col("distance"))).alias("first"), F.median(F.when(F.col("c") > 0, F.col("distance"))).alias("rest"), (F.max("c") + 1).alias("n"))
    single = F.col("n") == 1
    region = F.when(~single | (F.col("first") >= UNIT_MIDPOINT), F.col("first"))
    office = F.when(single & (F.col("first") < UNIT_MIDPOINT), F.col("first")).otherwise(F.col("rest"))
    return centres.select(key, region.alias("region_centre"), office.alias("office_centre"), single.alias("weak"), (F.col("n") > 2).alias("extra"))


def nearest(value: Column, centres: Column) -> Column:
    """Index of the nearest of an array of centres, the first of equals."""
    ranked = F.transform(centres, lambda c, i: F.struct(F.abs(value - c).alias("d"), i.alias("i")))
    return F.array_min(ranked)["i"]


@by_document("page")
def rank_ladder(clusters: DataFrame, centres: list[float], key: str = "page") -> DataFrame:
    """key, cluster_no, centre, rank: the lowest cluster snaps to the nearest global centre, each one above it ranks
    higher by its distance in steps (at least one), never above 0. Half steps round to even."""
    levels = F.array(*[F.lit(float(c)) for c in centres])
    up = Window.partitionBy(key).orderBy("centre")
    below = F.lag("centre").over(up)
    step = F.when(below.isNotNull(), F.greatest(F.lit(1), F.bround((F.col("centre") - below) / PLAN_STEP).cast("int")))
    lowest = nearest(F.first("centre").over(up), levels)
    climbed = F.coalesce(F.sum(step).over(up.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return clusters.withColumn("rank", F.greatest(F.lit(0), lowest - climbed).cast("bigint"))


def assignment(distance: Column, centre: Column, tolerance: float) -> Column:
    """struct(delta, confidence, outside): how well a row fits its level's centre."""
    delta = F.abs(distance - centre)
    return F.struct(F.round(delta, 3).alias("delta"), F.when(delta <= SURE_DELTA, F.lit("high")).otherwise(F.lit("medium")).alias("confidence"), (delta > tolerance).alias("outside"))


@by_document("page")
def row_totals(cells: DataFrame) -> DataFrame:
    """table and row with role, text, value of the last amount that isn't empty; a cell with several amounts has no value.

    cells: page, row_id, column_id, role, text, n_money.
    """
    entry = F.struct("role", "text", F.when(F.col("n_money") <= 1, lexical.amount(F.col("text"))).alias("value"))
    return cells.where((F.col("role") != "Labels") & (lexical.clean(F.col("text")) != "")).groupBy("page", "row_id").agg(F.max_by(entry, "column_id").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "text")))).alias("amounts"))


@by_document("table_id")
def continuation_merge(rows: DataFrame) -> DataFrame:
    """table_id, doc_pos, id, label, n_merged: a row with a label but neither distance nor amount goes on the row before it.

    rows: table_id, doc_pos, id, label, distance, n_amounts. The running number of emitted rows is the group.
    """
    w = Window.partitionBy("table_id").orderBy("doc_pos")
    goes_on = F.col("distance").isNull() & (F.col("n_amounts") == 0) & (lexical.clean(F.col("label")) != "")
    group = F.sum((~goes_on).cast("int")).over(w)
    grouped = rows.withColumn("_g", group).groupBy("table_id", "_g").agg(F.array_sort(F.collect_list(F.struct("doc_pos", "id", "label"))).alias("r"))
    return grouped.select("table_id", F.col("r")[0]["doc_pos"].alias("doc_pos"), F.col("r")[0]["id"].alias("id"), lexical.clean(F.concat_ws(" ", "r.label")).alias("label"), (F.size("r") - 1).cast("bigint").alias("n_merged"))


@by_document("table_id")
def latest_match(rows: DataFrame, subtotals: DataFrame) -> DataFrame:
    """table_id, subtotal_id, parent_id: the latest earlier row with the subtotal's label, or with one s more or less at its end; else null.

    rows: table_id, doc_pos, id, key; subtotals: table_id, doc_pos, id, key. A subtotal asks for each of the three labels.
    All are put in one order by (table, label), and the last row before each question is carried forward: one sort, no
    row meets another. Empty labels match nothing.
    """
    key = F.col("key")
    r = rows.where(key != "").select("table_id", "doc_pos", "key", F.col("id").alias("row_id"), F.lit(None).cast("string").alias("subtotal_id"))
    forms = F.array_compact(F.array(key, F.concat(key, F.lit("s")), F.when(key.endswith("s"), F.substr(key, F.lit(1), F.length(key) - 1))))
    s = subtotals.select("table_id", "doc_pos", F.explode(F.coalesce(forms, F.array(F.lit("")))).alias("key"), F.lit(None).cast("string").alias("row_id"), F.col("id").alias("subtotal_id"))
    w = Window.partitionBy("table_id", "key").orderBy("doc_pos", F.col("subtotal_id").isNull())
    here = F.when(F.col("row_id").isNotNull(), F.struct("doc_pos", "row_id"))
    found = r.unionByName(s).withColumn("at", F.last(here, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return found.where(F.col("subtotal_id").isNotNull()).groupBy("table_id", "subtotal_id").agg(F.max("at")["row_id"].alias("parent_id"))


# ---- parents from row order ------------------------------------------------------------------------------
#: Levels of a stack: a rank that a table can't mean.
MOST_LEVELS = 200


@by_document("table_id")
def stack_parents(rows: DataFrame, partition: list[str]) -> DataFrame:
    """rows with parent: the nearest earlier open row of a lesser rank, else root.

    rows: id, doc_pos, rank, expense, top_section, marked, attached (rows that hang on the open row and don't
    open themselves). Popping every entry of an equal or greater rank leaves the last row of each lesser level, if
    no row since has popped it; both are running lasts in one sort per partition. The levels are those that occur; more than
    MOST_LEVELS of them are an error. A row without rank that isn't attached neither opens nor closes a level.
    """
    own = F.when(F.col("expense"), -1.0).when(F.col("top_section"), 0.0).when((F.col("rank") == 0) & F.col("marked"), 0.5).otherwise(F.col("rank").cast("double"))
    stored = F.when(F.col("top_section") & F.col("marked") & (F.col("rank") == 0) & ~F.col("expense"), 0.5).otherwise(own)
    seen = rows.where(~F.col("attached")).select(F.explode(F.array(own, stored)).alias("level")).where("level is not null").distinct().limit(MOST_LEVELS + 1).collect()
    if len(seen) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} levels")
    levels = sorted(r["level"] for r in seen)
    if not levels:
        return rows.withColumn("parent", F.lit("root"))
    rows = rows.withColumns({"_own": F.when(~F.col("attached"), own), "_stored": F.when(~F.col("attached"), stored)})
    before = Window.partitionBy(*partition).orderBy("doc_pos").rowsBetween(Window.unboundedPreceding, -1)
    here = F.struct("doc_pos", "id")
    rows = rows.withColumns({f"_at{i}": F.last(F.when(F.col("_stored") == level, here), ignorenulls=True).over(before) for i, level in enumerate(levels)})
    rows = rows.withColumns({f"_pop{i}": F.last(F.when(F.col("_own") <= level, F.col("doc_pos")), ignorenulls=True).over(before) for i, level in enumerate(levels)})
    search = F.when(F.col("attached"), F.lit(float("inf"))).otherwise(own)
    open_rows = [F.when((F.lit(level) < search) & (F.col(f"_at{i}.doc_pos") == F.col(f"_pop{i}")), F.col(f"_at{i}")) for i, level in enumerate(levels)]
    found = F.greatest(*open_rows) if len(open_rows) > 1 else open_rows[0]
    parent = F.when(F.coalesce(F.col("expense"), F.lit(False)), F.lit("root")).otherwise(F.coalesce(found["id"], F.lit("root")))
    kept = [c for c in rows.columns if not c.startswith("_")]
    return rows.withColumn("parent", parent).select(*kept, "parent")


# Findings of a row's cells that its node takes over.
INHERITED = ("multiple_money_candidates_in_cell", "multiple_main_text_candidates_in_row", "main_text_candidate_outside_label_cell")


@by_document("page")
def unit_rows(views: DataFrame, centres: DataFrame, findings: DataFrame) -> DataFrame:
    """Views of operating-unit rows with kind, tier, centre, delta, confidence, flags, match_key and target.

    views: page, row_id, label, first_line, code, distance, terminal_distance, n_amounts; centres: page, region_centre,
    office_centre; findings: page, row_id, code. A row is, by the first that holds, a continuation, a subtotal, a
    grand total (a total beyond the section distance), funding, a programme or an activity by its code, a region or an
    uncoded row of tier 1, or an office. A row that fits no centre is in tier 2. match_key is the label by which
    subtotals find a row (null if they can't), target the label that a subtotal looks for.
    """
    label = lexical.clean(F.col("label"))
    inherited = findings.where(F.col("code").isin(*INHERITED)).groupBy("page", "row_id").agg(F.array_sort(F.collect_list("code")).alias("inherited"))
    rows = views.join(centres.select("page", "region_centre", "office_centre"), "page", "left").join(inherited, ["page", "row_id"], "left")
    distance, coded = F.col("distance"), lexical.code_kind(F.col("code"))
    to_region, to_office = F.abs(distance - F.col("region_centre")), F.abs(distance - F.col("office_centre"))
    near_region = to_region.isNotNull() & (to_office.isNull() | (to_region <= to_office))
    unfit = distance.isNull() | (to_region.isNull() & to_office.isNull())
    special = (
        F.when(distance.isNull() & (F.col("n_amounts") == 0) & (label != ""), F.lit("continuation"))
        .when(lexical.is_subtotal(label), F.lit("subtotal"))
        .when(lexical.is_total(label) & (F.col("terminal_distance") >= SECTION_DISTANCE), F.lit("grand_total"))
        .when(label.isin(*lexical.UNIT_FUNDING), F.lit("funding"))
    )
    tier = F.when(coded.isNotNull(), 1).when(~unfit & near_region, 1).otherwise(2)
    kind = F.coalesce(special, lexical.unit_kind(label, F.col("code"), tier))
    body, fitted = special.isNull(), special.isNull() & coded.isNull() & ~unfit
    centre = F.when(body & coded.isNotNull(), F.col("region_centre")).when(fitted, F.when(near_region, F.col("region_centre")).otherwise(F.col("office_centre")))
    delta = F.abs(distance - centre)
    flag = lambda when, code: F.when(when, F.lit(code))
    own = F.array_compact(
        F.array(
            flag(special == "continuation", "continuation_merged"),
            flag(special == "funding", "funding_metadata_excluded"),
            flag(body & distance.isNull() & (F.col("n_amounts") > 0), "row_without_anchor_distance"),
            flag(body & coded.isNull() & unfit, "unclassified_distance"),
            flag(fitted & (delta > UNIT_TOLERANCE), "outside_center_tolerance"),
            flag(body & (F.lower(lexical.clean(F.col("first_line"))) == "office"), "suspect_leading_continuation"),
            flag(kind == "tier1_uncoded", "unclassified_distance"),
        )
    )
    wanted = F.ltrim(F.regexp_replace(label, lexical.SUBTOTAL, ""), F.lit(" ,"))
    sure = F.when(special.isin("subtotal", "grand_total", "funding"), F.lit("semantic")).when(body & coded.isNotNull(), F.lit("code")).when(fitted & (delta <= SURE_DELTA), F.lit("high")).when(body, F.lit("medium"))
    return rows.withColumns(
        {
            "kind": kind, "tier": F.when(special == "grand_total", 0).when(special == "funding", 2).when(body, tier).cast("bigint"), "centre": F.round(centre, 3), "delta": F.round(delta, 3), "confidence": sure,
            "flags": F.concat(F.coalesce("inherited", F.array().cast("array<string>")), own),
            "match_key": F.when(~F.coalesce(special.isin("continuation", "funding"), F.lit(False)), lexical.normalize_label(label)),
            "target": F.when(special == "subtotal", lexical.normalize_label(wanted)),
        }
    ).drop("inherited", "region_centre", "office_centre")


@by_document("table_id")
def unit_parents(rows: DataFrame) -> DataFrame:
    """table_id, id, parent, flag, match: parents of operating-unit rows by a stack with programme memory.

    rows: table_id, doc_pos, id, kind (section, subsection, program, activity, region, tier1_uncoded, office,
    subtotal, grand_total, funding), code, segment_id, section_letter, match_key, target. A subtotal belongs to the latest
    earlier row whose match_key is its target, plural or not, else to the open section. The memory of programmes by code
    prefix, and that of labels, outlive gaps and pops, so a table is one sequential group. A row without a code
    neither sets nor finds a programme.
    """

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_pos", kind="stable")
        stack: list[tuple[int, str, bool]] = [(0, "root", False)]
        programs: dict[str, str] = {}
        letters: dict[str, str] = {}
        labelled: dict[str, tuple[int, str]] = {}
        segment, out = None, []
        parent_of: dict[str, str] = {}

        def pop(least: int) -> None:
            while len(stack) > 1 and stack[-1][0] >= least:
                stack.pop()

        for n, r in enumerate(pdf.itertuples()):
            flags, match = [], None
            if segment is not None and r.segment_id != segment:
                stack, letters = [(0, "root", False)], {}
                flags.append("carry_gap_reset")
            segment = r.segment_id
            prefix = r.code[:6] if isinstance(r.code, str) else None
            if r.kind in ("section", "subsection"):
                parent = letters.get(r.section_letter, "root") if r.kind == "subsection" else "root"
                if r.kind == "section" and isinstance(r.section_letter, str):
                    letters[r.section_letter] = r.id
                stack = [(0, r.id, False)]
            elif r.kind == "grand_total":
                parent = "root"
            elif r.kind == "subtotal":
                target = r.target if isinstance(r.target, str) and r.target else None
                known = [labelled[t] for t in (target, f"{target}s", target[:-1] if target.endswith("s") else None) if t in labelled] if target else []
                match, parent = ("label", max(known)[1]) if known else ("open_section", stack[0][1])
                flags += [] if known else ["subtotal_parent_unmatched"]
            elif r.kind == "funding":
                pop(2)
                parent = stack[-1][1]
            elif r.kind == "program":
                pop(1)
                parent = stack[-1][1]
                if prefix:
                    programs[prefix] = r.id
                stack.append((1, r.id, True))
            elif r.kind == "activity":
                program = programs.get(prefix)
                if program:
                    while len(stack) > 1 and stack[-1][0] >= 1 and stack[-1][1] != program:
                        stack.pop()
                    parent = program
                else:
                    pop(1)
                    parent = stack[-1][1]
                    flags.append("activity_without_program_parent")
                stack.append((1, r.id, True))
            elif r.kind in ("region", "tier1_uncoded"):
                pop(2)
                tier, top, coded = stack[-1]
                parent = top
                if tier == 1 and not coded:
                    stack.pop()
                    parent = parent_of[top]
                stack.append((1, r.id, False))
            else:
                pop(2)
                parent = stack[-1][1]
                stack.append((2, r.id, False))
            if isinstance(r.match_key, str) and r.match_key:
                labelled[r.match_key] = (n, r.id)
            parent_of[r.id] = parent
            out.append((r.table_id, r.id, parent, ",".join(flags) or None, match))
        return pd.DataFrame(out, columns=["table_id", "id", "parent", "flag", "match"])

    columns = ["table_id", "doc_pos", "id", "kind", "code", "segment_id", "section_letter", "match_key", "target"]
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])
    return rows.groupBy("table_id").applyInPandas(group, f"table_id {key_type(rows, 'table_id')}, id string, parent string, flag string, match string")


# ---- questions about trees -------------------------------------------------------------------------------
def _edges(nodes: DataFrame, parent: str) -> DataFrame:
    """id, parent of the nodes whose parent is a node; nodes at the top have a null parent."""
    known = nodes.select(F.col("id").alias("known")).distinct()
    return stage_table(nodes.select("id", F.col(parent).alias("up")).join(known, F.col("up") == F.col("known"), "left").select("id", F.col("known").alias("parent")), "tree-edges")


def _levels(edges: DataFrame, goes_on: DataFrame | None = None) -> list[DataFrame]:
    """id, parent of each level of a tree from the top, a step a level and a row a node. With goes_on (ids), only its
    nodes' children follow. What hangs on a cycle is never reached, so the walk ends whatever the parents are."""
    below = edges.where(F.col("parent").isNotNull())
    level = stage_table(edges.where(F.col("parent").isNull()), "tree-level")
    out = []
    while not level.isEmpty():
        out.append(level)
        from_here = level.select(F.col("id").alias("parent"))
        if goes_on is not None:
            from_here = from_here.join(goes_on.select(F.col("id").alias("parent")).distinct(), "parent", "left_semi")
        level = stage_table(below.join(from_here, "parent").select("id", "parent"), "tree-level")
    return out


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames) if frames else empty.limit(0)


@by_document("id", "parent")
def depths(nodes: DataFrame, parent: str = "parent") -> DataFrame:
    """id, depth: hops to the top, which is a node without parent, or whose parent isn't a node. What hangs on a cycle has depth 0."""
    edges = _edges(nodes, parent)
    found = [level.select("id", F.lit(k).cast("bigint").alias("depth")) for k, level in enumerate(_levels(edges))][1:]
    deep = _union(found, edges.select("id", F.lit(0).cast("bigint").alias("depth")))
    return nodes.select("id").join(deep, "id", "left").select("id", F.coalesce("depth", F.lit(0).cast("bigint")).alias("depth"))


@by_document("id", "parent")
def cycles(nodes: DataFrame, parent: str = "parent") -> DataFrame:
    """id of the nodes that no top leads to: those on a cycle and those that hang on one."""
    edges = _edges(nodes, parent)
    return edges.select("id").join(_union(_levels(edges), edges).select("id"), "id", "left_anti").distinct()


@by_document("id", "parent")
def descendant_max_page(nodes: DataFrame) -> DataFrame:
    """id, max_page: the last page of a node and all below it. Levels are folded from the deepest up, a row a node."""
    edges = _edges(nodes, "parent")
    pages = nodes.select("id", "page")
    done, below = [], None
    for level in reversed(_levels(edges)):
        own = level.join(pages, "id")
        if below is not None:
            under = below.groupBy(F.col("parent").alias("id")).agg(F.max("max_page").alias("under"))
            own = own.join(under, "id", "left").withColumn("page", F.greatest("page", "under"))
        below = stage_table(own.select("id", "parent", F.col("page").alias("max_page")), "tree-pages")
        done.append(below.select("id", "max_page"))
    found = _union(done, pages.withColumnRenamed("page", "max_page"))
    return pages.join(found, "id", "left").select("id", F.coalesce("max_page", "page").alias("max_page"))


@by_document("id", "parent", "child")
def expand_shells(nodes: DataFrame) -> DataFrame:
    """parent, child: children with synthetic ones replaced by their own children, at any depth. nodes: id, parent, synthetic.

    Only synthetic children are followed; one that a parent has met already isn't followed again, so a cycle ends.
    """
    links = stage_table(nodes.where(F.col("parent").isNotNull()).select("id", "parent", F.coalesce("synthetic", F.lit(False)).alias("synthetic")), "shell-links")
    below = links.select(F.col("parent").alias("shell"), F.col("id").alias("child"), "synthetic")
    level = links.select("parent", F.col("id").alias("child"), "synthetic")
    out, shells = [level.where("not synthetic").select("parent", "child")], []
    while True:
        met = level.where("synthetic").select("parent", F.col("child").alias("shell")).distinct()
        fresh = stage_table(met.join(_union(shells, met), ["parent", "shell"], "left_anti") if shells else met, "shells")
        if fresh.isEmpty():
            return reduce(DataFrame.unionByName, out).distinct() if shells else out[0]
        shells.append(fresh)
        level = stage_table(fresh.join(below, "shell").select("parent", "child", "synthetic"), "shell-level")
        out.append(level.where("not synthetic").select("parent", "child"))


def children(nodes: DataFrame, parent: str = "parent") -> DataFrame:
    """id, children: child ids in document order."""
    return nodes.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("id")).agg(F.array_sort(F.collect_list(F.struct("doc_pos", F.col("id").alias("child")))).alias("c")).select("id", F.col("c.child").alias("children"))


@by_document("id", "parent")
def expand_ancestors(nodes: DataFrame, ids: DataFrame, parent: str = "parent") -> DataFrame:
    """id of all ancestors of some nodes: those that must be open for the nodes to be seen. ids: id.

    Only the ancestors themselves are walked, each once however many nodes lie below it.
    """
    edges = _edges(nodes, parent).where(F.col("parent").isNotNull())
    level, found = stage_table(ids.select("id").distinct(), "tree-level"), []
    while True:
        up = edges.join(level, "id", "left_semi").select(F.col("parent").alias("id")).distinct()
        level = stage_table(up.join(_union(found, up), "id", "left_anti") if found else up, "tree-level")
        if level.isEmpty():
            return _union(found, level)
        found.append(level)


@by_document("id", "parent")
def search(nodes: DataFrame, matches: Column, parent: str = "parent") -> DataFrame:
    """id, matched: nodes that match, and all their ancestors."""
    hits = stage_table(nodes.where(matches).select("id"), "tree-hits")
    above = expand_ancestors(nodes, hits, parent)
    return hits.withColumn("matched", F.lit(True)).unionByName(above.join(hits, "id", "left_anti").withColumn("matched", F.lit(False)))


@by_document("id", "parent")
def visible(nodes: DataFrame, expanded: DataFrame, parent: str = "parent", included: DataFrame | None = None) -> DataFrame:
    """id of the nodes all of whose ancestors are expanded, and that are included, if that is given. expanded, included: id."""
    edges = _edges(nodes, parent)
    seen = _union(_levels(edges, expanded), edges).select("id")
    return seen if included is None else seen.join(included.select("id").distinct(), "id", "left_semi")


@by_document("id", "parent")
def row_list(nodes: DataFrame, expanded: DataFrame, parent: str = "parent", included: DataFrame | None = None) -> DataFrame:
    """id, doc_pos, depth, has_children of the rows that a reader sees in document order, by the hierarchy of a parent column."""
    seen = visible(nodes, expanded, parent, included)
    ids = nodes.select(F.col("id").alias("up"))
    parents = nodes.select(F.col(parent).alias("up")).join(ids, "up", "left_semi").distinct().select(F.col("up").alias("id"), F.lit(True).alias("has"))
    rows = nodes.select("id", "doc_pos").join(seen, "id", "left_semi").join(depths(nodes, parent), "id").join(parents, "id", "left")
    return rows.select("id", "doc_pos", "depth", F.coalesce("has", F.lit(False)).alias("has_children"))


def invariants(nodes: DataFrame) -> DataFrame:
    """violation, id: ids that come twice, row numbers with gaps, parents that don't resolve, nodes without parent
    besides the root, boxes without page, cycles; children that their parents don't know or the other way round, if
    there is a column of them; and the like for both parents of a dual hierarchy. A sound tree gives no rows."""
    say = lambda rows, what: rows.select(F.lit(what).alias("violation"), "id")
    twice = nodes.groupBy("id").count().where("count > 1")
    n = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("row_index").alias("m"), F.countDistinct("row_index").alias("d"))
    gaps = n.where("n > 0 and (m <> n - 1 or d <> n)").withColumn("id", F.lit("*"))
    lost = nodes.where("parent is not null").join(nodes.select(F.col("id").alias("parent")).distinct(), "parent", "left_anti")
    rootless = nodes.where("parent is null and kind <> 'table_root'")
    boxes = nodes.where("has_bbox and page is null")
    if "children" in nodes.columns:
        said = nodes.select(F.col("id").alias("up"), F.explode("children").alias("id"))
        kept = nodes.where("parent is not null").select(F.col("parent").alias("up"), "id")
        unlike = say(said.join(kept, ["up", "id"], "left_anti"), "child_not_of_parent").unionByName(say(kept.join(said, ["up", "id"], "left_anti"), "parent_without_child"))
    else:
        unlike = say(nodes.limit(0), "child_not_of_parent")
    if {"parent_pdf", "parent_prexc"} <= set(nodes.columns):
        root = F.col("kind") == "table_root"
        for c in ("parent_pdf", "parent_prexc"):
            lost_one = nodes.where(F.col(c).isNotNull()).join(nodes.select(F.col("id").alias(c)).distinct(), c, "left_anti")
            unlike = unlike.unionByName(say(lost_one, f"{c}_missing")).unionByName(say(nodes.where(root & F.col(c).isNotNull()), f"root_has_{c}")).unionByName(say(nodes.where(~root & F.col(c).isNull()), f"{c}_null"))
    loops = say(cycles(nodes), "parent_cycle")
    return unlike.unionByName(loops).unionByName(say(twice, "duplicate_id")).unionByName(say(gaps, "row_index_not_dense")).unionByName(say(lost, "parent_missing")).unionByName(say(rootless, "parent_null")).unionByName(say(boxes, "bbox_without_page"))
