"""The stages in order, from tokens to checked totals: geometry, sections, hierarchy, reconciliation.

Tokens of many documents carry a column document, and every table then has it; pages of unlike documents never meet.
Each stage takes the tables of the one before and returns its own, by name; run() writes every stage's tables,
so a later run can begin at any stage with what is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridledger.functions import lexical
from gridledger.operators import bands, geometry, hierarchy, sections, totals
from gridledger.operators.keys import document_of
from gridledger.sources.scratch import stage_table

Tables = dict[str, DataFrame]

#: Calibrated level centres, in points left of the amount anchor; the first is the highest level.
CENTRES = (514.6, 496.5, 479.0, 461.0, 444.0, 426.0, 409.0, 391.3)


def geometry_stage(tables: Tables, page_width: float = 720.0, page_height: float = 864.0, **_) -> Tables:
    """bands, gaps, phrases, columns, column_members, anchors, distances, pairs, separators from tokens."""
    tokens = geometry.usable(tables["tokens"])
    own = document_of(tokens)
    page = [*own, "page"]
    widths = tokens.withColumn("w", lexical.char_width(F.col("text"), F.col("x1") - F.col("x0"))).groupBy(*page).agg(F.coalesce(F.median("w"), F.lit(5.0)).alias("char_width"))
    found = stage_table(bands.baseline_bands(tokens), "stage-bands")
    banded = stage_table(tokens.drop("band_id").join(found.select(*page, "token_id", "band_id"), [*page, "token_id"]).join(widths, page), "stage-banded")
    wide = F.col("char_width")
    phrases = stage_table(geometry.phrases(banded, wide), "stage-phrases")
    height = F.lit(page_height)
    drifts = stage_table(geometry.page_drift(geometry.money_window(phrases, F.lit(page_width))), "stage-drifts")
    straight = stage_table(geometry.without_drift(phrases, drifts, height), "stage-straight")
    money = geometry.money_window(straight, F.lit(page_width)).join(widths, page).withColumn("tolerance", F.greatest(F.lit(6.0), 1.5 * wide))
    clusters = geometry.running_median_clusters(money, "right_x", ["x1", "y1", "phrase_id"], "tolerance", id_column="phrase_id")
    members = stage_table(money.join(clusters.select(*page, F.col("id").alias("phrase_id"), F.col("cluster").alias("column_id")), [*page, "phrase_id"]), "stage-columns")
    columns = stage_table(geometry.anchored_columns(members, F.col("tolerance"), height).withColumn("left_x", F.col("amount_left_x")), "stage-anchored")
    anchors = geometry.reference_anchor(columns)
    return {
        "bands": found, "gaps": geometry.token_gaps(banded, wide), "phrases": phrases, "column_members": members, "columns": columns,
        "anchors": anchors, "distances": geometry.relative_anchors(straight, anchors), "pairs": geometry.label_amount_pairs(phrases), "separators": geometry.separators(phrases),
    }


def section_stage(tables: Tables, wraps_down: bool = False, page_width: float = 720.0, page_height: float = 864.0, **_) -> Tables:
    """sections (columns with their edges), rows, cells from geometry. A row begins at each label that claims amounts
    or stands at the left of its band."""
    phrases = tables["phrases"].where(sections.outside_gutter(F.lit(page_height)))
    page = [*document_of(phrases), "page"]
    w = Window.partitionBy(*page).orderBy("left_x")
    amounts = tables["columns"].where("recurring").select(*page, F.row_number().over(w).cast("bigint").alias("column_id"), "left_x", F.lead("left_x").over(w).alias("right_x"))
    amounts = amounts.withColumns({"is_last": F.col("right_x").isNull(), "right_x": F.coalesce("right_x", F.lit(page_width)), "role": F.concat(F.lit("Amount "), F.col("column_id").cast("string"))})
    labels = amounts.groupBy(*page).agg(F.min("left_x").alias("right_x")).select(*page, F.lit(0).cast("bigint").alias("column_id"), F.lit(0.0).alias("left_x"), "right_x", F.lit(False).alias("is_last"), F.lit("Labels").alias("role"))
    columns = labels.unionByName(amounts).withColumns({"left_slope": F.lit(0.0), "right_slope": F.lit(0.0)})
    main = phrases.where("observation in ('text_candidate', 'mixed_candidate')").groupBy(*page, "band_id").agg(F.min_by(F.struct("phrase_id", "y1"), F.struct("x0", "phrase_id")).alias("p"))
    boundaries = main.select(*page, F.col("p.y1").alias("y"), "band_id", F.col("p.phrase_id").alias("label_id"))
    rows = sections.row_bounds(boundaries, wraps_down)
    in_rows, in_columns = sections.in_row(phrases, rows, wraps_down), sections.in_column(phrases, columns)
    return {"sections": columns, "rows": rows, "cells": sections.cells(phrases, rows, columns, in_rows, in_columns)}


def hierarchy_stage(tables: Tables, centres: tuple[float, ...] = CENTRES, **_) -> Tables:
    """nodes of one table a document: level from the label's distance to the amount anchor, drift taken out, parent from row order."""
    own = document_of(tables["phrases"])
    page = [*own, "page"]
    label = tables["distances"].select(*page, F.col("phrase_id").alias("anchor_id"), "distance").where("distance is not null")
    placed = tables["rows"].join(label, [*page, "anchor_id"]).select(*page, "row_id", "distance")
    cells = tables["cells"]
    text = cells.where("role = 'Labels'").select(*page, "row_id", F.col("text").alias("label"))
    total = hierarchy.row_totals(cells.withColumn("n_money", F.size("phrase_ids"))).select(*page, "row_id", F.col("total.value").alias("amount"))
    rows = placed.join(text, [*page, "row_id"], "left").join(total, [*page, "row_id"], "left")
    rows = rows.withColumns({"funding": lexical.is_funding(F.col("label")), "subtotal": lexical.is_subtotal(F.col("label")), "total": lexical.is_total(F.col("label"))})
    levels = F.array(*[F.lit(float(c)) for c in centres])
    rank = hierarchy.nearest(F.col("distance"), levels)
    upper = F.upper("label")
    shaped = rows.select(
        *own, F.lit(1).cast("bigint").alias("table_id"), (F.col("page") * 100_000 + F.col("row_id")).alias("doc_pos"), F.format_string("p%d:r%d", "page", "row_id").alias("id"), "page", "label", "amount", "distance", rank.cast("bigint").alias("rank"),
        upper.isin(*lexical.EXPENSE_CLASSES).alias("expense"), upper.isin(*lexical.TOP_SECTIONS).alias("top_section"), lexical.marker(F.array().cast("array<string>"), F.col("label")).isNotNull().alias("marked"),
        (F.col("funding") | F.col("subtotal") | F.col("total")).alias("attached"),
        F.when(F.col("funding"), F.lit("funding")).when(F.col("subtotal"), F.lit("subtotal")).when(F.col("total"), F.lit("grand_total")).otherwise(lexical.plan_kind(F.col("label"), rank)).alias("kind"),
    )
    segments = hierarchy.segments(shaped.select(*page))
    nodes = hierarchy.stack_parents(shaped.join(segments.select(*page, "segment_id"), page), ["table_id", "segment_id"])
    return {"nodes": nodes.select(*own, "table_id", "doc_pos", "id", "parent", "kind", "page", "rank", "label", "amount", F.lit(None).cast("string").alias("code"), (F.col("kind") == "funding").alias("excluded"), F.lit(False).alias("synthetic"))}


def totals_stage(tables: Tables, tolerance: int = 0, **_) -> Tables:
    checks = totals.parent_totals(tables["nodes"], tolerance)
    return {"checks": checks, "status_counts": totals.status_counts(checks)}


STAGES: dict[str, Callable[..., Tables]] = {"geometry": geometry_stage, "sections": section_stage, "hierarchy": hierarchy_stage, "totals": totals_stage}


def run(spark: SparkSession, tokens: DataFrame | None, path: str, first: str = "geometry", last: str = "totals", **options) -> Tables:
    """Runs the stages from first to last; their tables are written under path, and earlier stages' are read from there."""
    names = list(STAGES)
    begin, end = names.index(first), names.index(last)
    if end < begin:
        raise ValueError(f"{last} comes before {first}")
    tables: Tables = {} if tokens is None else {"tokens": tokens}
    known = {"geometry": ("bands", "gaps", "phrases", "column_members", "columns", "anchors", "distances", "pairs", "separators"), "sections": ("sections", "rows", "cells"), "hierarchy": ("nodes",)}
    for name in names[:begin]:
        tables |= {t: spark.read.parquet(f"{path}/{name}/{t}") for t in known[name]}
    for name in names[begin : end + 1]:
        for table, df in STAGES[name](tables, **options).items():
            df.write.mode("overwrite").parquet(f"{path}/{name}/{table}")
            tables[table] = spark.read.parquet(f"{path}/{name}/{table}")
    return tables
