"""Table sections: columns, rows and cells as interval joins, and findings about them.

Every interval join carries the page as an equality, so it is a hash or merge join on the page with the
interval as its residual condition; what meets is bounded by one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.operators.keys import by_document, document_of

# Fixed values.
GUTTER_PT, GUTTER_SHARE = 45.0, 0.055
FLAG_MESSAGES = {
    "multiple_main_text_candidates_in_row": "Row contains more than one main label candidate.",
    "multiple_main_text_candidates_in_cell": "Label cell contains more than one main label candidate.",
    "multiple_money_candidates_in_cell": "Amount cell contains more than one money candidate.",
    "main_text_candidate_outside_label_cell": "Main label candidate was assigned outside the label column.",
    "no_recurring_amount_column": "No amount-column anchor was detected.",
    "no_main_text_anchor": "No main label anchor was available for the label column.",
    "reviewed_root_band_missing": "The reviewed root band is absent from current geometry.",
    "no_main_text_boundaries": "No main label boundaries were available for row construction.",
    "unclassified_row_wrap_direction": "The row wrap direction is not classified.",
}


def outside_gutter(height: Column, y1: Column | None = None) -> Column:
    """Whether a box lies below the top gutter of its page."""
    return (F.col("y1") if y1 is None else y1) > F.least(F.lit(GUTTER_PT), GUTTER_SHARE * height)


def layout_spans(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """pages with table_type and wrap_direction of the first span (by order) that holds the page, else unclassified/review.

    spans: order, start_page, end_page, table_type, wrap_direction. Spans are a reviewed list of a few rows.
    """
    held = pages.join(F.broadcast(spans), F.col("page").between(F.col("start_page"), F.col("end_page")), "left")
    first = F.min_by(F.struct("table_type", "wrap_direction"), F.struct("order")).alias("s")
    own = document_of(pages)
    return held.groupBy(*own, "page").agg(first).select(*own, "page", F.coalesce("s.table_type", F.lit("unclassified")).alias("table_type"), F.coalesce("s.wrap_direction", F.lit("review")).alias("wrap_direction"))


def clip_bands(bands: DataFrame, seeds: DataFrame) -> DataFrame:
    """Bands inside the reviewed table: from the body band on its first page, to the terminal band on its last.

    seeds: first_page, first_band, last_page, last_band (null: open).
    """
    kept = bands.join(F.broadcast(seeds), F.col("page").between(F.col("first_page"), F.col("last_page")))
    starts = (F.col("page") != F.col("first_page")) | F.col("first_band").isNull() | (F.col("band_id") >= F.col("first_band"))
    ends = (F.col("page") != F.col("last_page")) | F.col("last_band").isNull() | (F.col("band_id") <= F.col("last_band"))
    return kept.where(starts & ends).select(*[bands[c] for c in bands.columns])


@by_document("page")
def in_column(phrases: DataFrame, columns: DataFrame) -> DataFrame:
    """page, phrase_id, column_id: the column whose slanted edges hold the phrase's centre; the last one includes its right edge.

    columns: page, column_id, left_x, left_slope, right_x, right_slope, is_last (edges at y = 0).
    """
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    left, right = F.col("left_x") + F.col("left_slope") * y, F.col("right_x") + F.col("right_slope") * y
    inside = (x >= left) & ((x < right) | (F.col("is_last") & (x == right)))
    return phrases.join(columns, "page").where(inside).select("page", "phrase_id", "column_id")


@by_document("page")
def row_bounds(boundaries: DataFrame, wraps_down: bool) -> DataFrame:
    """page, row_id, upper, lower, anchor_id: rows between consecutive boundaries.

    boundaries: page, y, band_id, label_id. Downward wrapping anchors a row to its upper boundary and leaves the
    last row open below; otherwise to its lower one, and the first row is open above.
    """
    w = Window.partitionBy("page").orderBy("y", "label_id")
    number = (F.row_number().over(w) - 1).cast("bigint")
    if wraps_down:
        return boundaries.select("page", number.alias("row_id"), F.col("band_id").alias("upper"), F.lead("band_id").over(w).alias("lower"), F.col("label_id").alias("anchor_id"))
    return boundaries.select("page", number.alias("row_id"), F.lag("band_id").over(w).alias("upper"), F.col("band_id").alias("lower"), F.col("label_id").alias("anchor_id"))


@by_document("page")
def in_row(phrases: DataFrame, rows: DataFrame, wraps_down: bool) -> DataFrame:
    """page, phrase_id, row_id: bands in [upper, lower) if labels wrap down, else in (upper, lower]; null is open."""
    band = F.col("band_id")
    if wraps_down:
        inside = (F.col("upper").isNull() | (band >= F.col("upper"))) & (F.col("lower").isNull() | (band < F.col("lower")))
    else:
        inside = (F.col("upper").isNull() | (band > F.col("upper"))) & (F.col("lower").isNull() | (band <= F.col("lower")))
    return phrases.join(rows, "page").where(inside).select("page", "phrase_id", "row_id")


@by_document("page")
def cells(phrases: DataFrame, rows: DataFrame, columns: DataFrame, in_rows: DataFrame, in_columns: DataFrame) -> DataFrame:
    """page, row_id, column_id, role, phrase_ids, text, empty: every row by every column of a page.

    Labels hold text and mixed phrases, amounts hold money; the grid is joined on the page.
    """
    grid = rows.select("page", "row_id").distinct().join(columns.select("page", "column_id", "role").distinct(), "page")
    held = in_rows.join(in_columns, ["page", "phrase_id"]).join(phrases.select("page", "phrase_id", "band_id", "x0", "text", "observation"), ["page", "phrase_id"])
    fits = F.when(F.col("role") == "Labels", F.col("observation").isin("text_candidate", "mixed_candidate")).otherwise(F.col("observation") == "money_candidate")
    found = grid.join(held, ["page", "row_id", "column_id"], "left").withColumn("item", F.when(fits, F.struct("band_id", "x0", "phrase_id", "text")))
    out = found.groupBy("page", "row_id", "column_id", "role").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return out.select("page", "row_id", "column_id", "role", F.col("items.phrase_id").alias("phrase_ids"), F.concat_ws(" ", "items.text").alias("text"), (F.size("items") == 0).alias("empty"))


def crossing(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column, dx: Column, dy: Column) -> Column:
    """struct(x, y) where the lines a-b and c-d meet; parallel lines are an error."""
    det = (ax - bx) * (cy - dy) - (ay - by) * (cx - dx)
    p, q = ax * by - ay * bx, cx * dy - cy * dx
    safe = F.when(F.abs(det) < 1e-12, F.raise_error(F.lit("lines are parallel")).cast("double")).otherwise(det)
    return F.struct(((p * (cx - dx) - (ax - bx) * q) / safe).alias("x"), ((p * (cy - dy) - (ay - by) * q) / safe).alias("y"))


@by_document("page")
def headers(bands: DataFrame, phrases: DataFrame) -> DataFrame:
    """page, role, text, n_lines: header sections with their bands' texts as lines. bands: page, band_id, role."""
    lines = bands.join(phrases, ["page", "band_id"]).groupBy("page", "role", "band_id").agg(F.array_sort(F.collect_list(F.struct("x0", "phrase_id", "text"))).alias("t"))
    lines = lines.select("page", "role", "band_id", F.concat_ws(" ", "t.text").alias("line"))
    out = lines.groupBy("page", "role").agg(F.array_sort(F.collect_list(F.struct("band_id", "line"))).alias("l"))
    return out.select("page", "role", F.concat_ws("\n", "l.line").alias("text"), F.size("l").cast("bigint").alias("n_lines"))


@by_document("page")
def findings(members: DataFrame) -> DataFrame:
    """page, code, row_id, column_id: rows and cells with several labels or amounts, and labels outside the label column.

    members: page, row_id, column_id, role, phrase_id, kind (main_text, money or other).
    """
    count = lambda kind: F.count_if(F.col("kind") == kind)
    none = F.lit(None).cast("bigint")
    by_row = members.groupBy("page", "row_id").agg(count("main_text").alias("n")).where("n > 1").select("page", F.lit("multiple_main_text_candidates_in_row").alias("code"), "row_id", none.alias("column_id"))
    by_cell = members.groupBy("page", "row_id", "column_id", "role").agg(count("main_text").alias("t"), count("money").alias("m"))
    labels = by_cell.where("role = 'Labels' and t > 1").select("page", F.lit("multiple_main_text_candidates_in_cell").alias("code"), "row_id", "column_id")
    money = by_cell.where("role <> 'Labels' and m > 1").select("page", F.lit("multiple_money_candidates_in_cell").alias("code"), "row_id", "column_id")
    outside = by_cell.where("role <> 'Labels' and t > 0").select("page", F.lit("main_text_candidate_outside_label_cell").alias("code"), "row_id", "column_id")
    return by_row.unionByName(labels).unionByName(money).unionByName(outside)


@by_document("page")
def flag_objects(findings: DataFrame) -> DataFrame:
    """page, flag_id, code, severity, object_type, object_id, message: what a finding is about, the closest there is.

    findings: page, seq, code, severity, cell_id, row_id, column_id, band_id.
    """
    ids = Window.partitionBy("page").orderBy("seq")
    kinds = (("cell_id", "cell_section"), ("row_id", "row_section"), ("column_id", "column_section"), ("band_id", "band"))
    kind = F.lit("page")
    for column, name in reversed(kinds):
        kind = F.when(F.col(column).isNotNull(), F.lit(name)).otherwise(kind)
    message = F.col("code")
    for code, text in FLAG_MESSAGES.items():
        message = F.when(F.col("code") == code, F.lit(text)).otherwise(message)
    return findings.select(
        "page", (F.row_number().over(ids) - 1).cast("bigint").alias("flag_id"), "code", F.coalesce("severity", F.lit("review")).alias("severity"), kind.alias("object_type"),
        F.coalesce(*[F.col(c) for c, _ in kinds]).alias("object_id"), message.alias("message"),
    )


@by_document("page")
def best_region(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """page, line_id, region_id: the region with the largest shared area (of equals the lower priority number);
    a region that only holds the line's centre counts as area 1."""
    w = F.greatest(F.lit(0.0), F.least("x1", "rx1") - F.greatest("x0", "rx0"))
    h = F.greatest(F.lit(0.0), F.least("y1", "ry1") - F.greatest("y0", "ry0"))
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    centred = cx.between(F.col("rx0"), F.col("rx1")) & cy.between(F.col("ry0"), F.col("ry1"))
    area = F.when(w * h > 0, w * h).when(centred, F.lit(1.0)).otherwise(F.lit(0.0))
    r = regions.select("page", "region_id", "priority", F.col("x0").alias("rx0"), F.col("y0").alias("ry0"), F.col("x1").alias("rx1"), F.col("y1").alias("ry1"))
    met = lines.join(r, "page").withColumn("area", area).where("area > 0")
    return met.groupBy("page", "line_id").agg(F.max_by("region_id", F.struct(F.col("area"), -F.col("priority"), -F.col("region_id"))).alias("region_id"))


@by_document("page")
def majority_region(tokens: DataFrame) -> DataFrame:
    """page, line_id, region_id that most tokens of a line have; of equals the one met first. tokens: page, line_id, pos, region_id."""
    counts = tokens.where(F.col("region_id").isNotNull()).groupBy("page", "line_id", "region_id").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    return counts.groupBy("page", "line_id").agg(F.max_by("region_id", F.struct(F.col("n"), -F.col("first"))).alias("region_id"))


@by_document("page")
def grid_lines(boxes: DataFrame, value: Column, gap: float, key: str = "page") -> DataFrame:
    """key, line_no, position, n: one-dimensional single-link groups (a new one where the step to the last member exceeds gap) and their means."""
    w = Window.partitionBy(key).orderBy("v")
    starts = boxes.withColumn("v", value).withColumn("s", F.coalesce((F.col("v") - F.lag("v").over(w) > gap).cast("int"), F.lit(0)))
    numbered = starts.withColumn("line_no", F.sum("s").over(w.rangeBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    return numbered.groupBy(key, "line_no").agg(F.round(F.avg("v"), 4).alias("position"), F.count(F.lit(1)).alias("n"))
