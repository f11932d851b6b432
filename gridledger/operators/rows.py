"""Row views of a table page: label, amounts, total, code and evidence of each row section; lines and gaps of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.functions import lexical
from gridledger.operators import hierarchy
from gridledger.operators.keys import by_document

# Fixed value: texts that a section header inside a row can't be.
PAGE_HEADER = r"(?i)^\d+\s+EXPENDITURE PROGRAM\b"
GENERIC = "(?:text_candidate|mixed_candidate)"


@by_document("page")
def left_prefixes(phrases: DataFrame, in_rows: DataFrame, labels: DataFrame) -> DataFrame:
    """page, row_id, phrase_id, text, observation of the phrases whose centre lies left of their row's label column.

    labels: page, row_id, left_x.
    """
    held = in_rows.join(phrases, ["page", "phrase_id"]).join(labels, ["page", "row_id"])
    return held.where((F.col("x0") + F.col("x1")) / 2 < F.col("left_x")).select("page", "row_id", "phrase_id", "text", "observation", "band_id", "x0")


@by_document("page")
def row_views(rows: DataFrame, cells: DataFrame, prefixes: DataFrame) -> DataFrame:
    """page, row_id, label, role, total, n_amounts, code, distance of rows that have a label or an amount.

    rows: page, row_id, distance; cells: page, row_id, column_id, role, text, n_money; prefixes as left_prefixes()
    gives them. The code is the first programme code left of the label.
    """
    amounts = hierarchy.row_totals(cells).select("page", "row_id", F.col("total.role").alias("role"), F.col("total.value").alias("total"), F.size("amounts").cast("bigint").alias("n_amounts"))
    labels = cells.where("role = 'Labels'").groupBy("page", "row_id").agg(lexical.clean(F.min_by("text", "column_id")).alias("label"))
    code = prefixes.where("observation = 'code_candidate'").groupBy("page", "row_id").agg(F.min_by("text", F.struct("band_id", "x0", "phrase_id")).alias("code"))
    out = rows.select("page", "row_id", "distance").join(labels, ["page", "row_id"], "left").join(amounts, ["page", "row_id"], "left").join(code, ["page", "row_id"], "left")
    label, n = F.coalesce("label", F.lit("")), F.coalesce("n_amounts", F.lit(0).cast("bigint"))
    return out.where((label != "") | (n > 0)).select("page", "row_id", label.alias("label"), "role", "total", n.alias("n_amounts"), F.trim("code").alias("code"), "distance")


@by_document("page")
def embedded_headers(phrases: DataFrame, in_rows: DataFrame) -> DataFrame:
    """page, row_id, phrase_id, seq, text: section headers inside body rows, in order of their bands.

    phrases: page, phrase_id, band_id, text, observation, distance.
    """
    text = lexical.clean(F.col("text"))
    head = phrases.where((F.col("distance") >= hierarchy.SECTION_DISTANCE) & F.col("observation").rlike(f"^{GENERIC}$"))
    head = head.where(~text.rlike(PAGE_HEADER) & ~lexical.is_subtotal(F.col("text")) & ~lexical.is_total(F.col("text")))
    w = Window.partitionBy("page", "row_id").orderBy("band_id", "phrase_id")
    return head.join(in_rows, ["page", "phrase_id"]).select("page", "row_id", "phrase_id", (F.row_number().over(w) - 1).cast("bigint").alias("seq"), text.alias("text"))


@by_document("page")
def label_lines(lines: DataFrame, gaps: DataFrame) -> DataFrame:
    """page, row_id, band_id, fill, run_gap_pt, run_gap_spaces, trail_gap_pt of the lines of label cells with two or more.

    lines: page, row_id, band_id, text, x0, x1, cell_x0, cell_x1, token_ids; gaps: page, band_id, gap_id,
    left_token_id, right_token_id, gap_pt, spaces. The run gap is the widest gap from a token of the line to one
    that isn't (of equal ones the last).
    """
    counted = lines.where(lexical.clean(F.col("text")) != "").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("page", "row_id"))).where("_n >= 2")
    leaving = counted.join(gaps, ["page", "band_id"]).where(F.array_contains("token_ids", F.col("left_token_id")) & ~F.array_contains("token_ids", F.col("right_token_id")))
    widest = leaving.groupBy("page", "row_id", "band_id").agg(F.max_by(F.struct("gap_pt", "spaces"), F.struct("gap_pt", "gap_id")).alias("g"))
    width = F.greatest(F.col("cell_x1") - F.col("cell_x0"), F.lit(1.0))
    return counted.join(widest, ["page", "row_id", "band_id"], "left").select(
        "page", "row_id", "band_id", ((F.col("x1") - F.col("x0")) / width).alias("fill"), F.round(F.coalesce("g.gap_pt", F.lit(0.0)), 3).alias("run_gap_pt"),
        F.round(F.coalesce("g.spaces", F.lit(0.0)), 3).alias("run_gap_spaces"), F.round(F.col("cell_x1") - F.col("x1"), 3).alias("trail_gap_pt"),
    )


def seed_roles(columns: DataFrame, seeds: DataFrame) -> DataFrame:
    """page, column_id, role: the reviewed role of a column on its seed page, else Labels and Amount 1, 2, ... from the left.

    columns: page, column_id, left_x; seeds: page, column_id, role, a reviewed list of a few rows.
    """
    place = F.row_number().over(Window.partitionBy("page").orderBy("left_x", "column_id")) - 1
    generic = F.when(place == 0, F.lit("Labels")).otherwise(F.concat(F.lit("Amount "), place.cast("string")))
    named = columns.select("page", "column_id", generic.alias("generic"))
    return named.join(F.broadcast(seeds.select("page", "column_id", "role")), ["page", "column_id"], "left").select("page", "column_id", F.coalesce("role", "generic").alias("role"))


@by_document("page")
def displacements(clusters: DataFrame, centres: list[float], tolerance: float = hierarchy.PLAN_TOLERANCE) -> DataFrame:
    """page, cluster_no, centre, profile, displacement of clusters farther than tolerance from every calibrated centre."""
    levels = F.array(*[F.lit(float(c)) for c in centres])
    profile = F.element_at(levels, hierarchy.nearest(F.col("centre"), levels) + 1)
    moved = F.abs(F.col("centre") - profile)
    return clusters.where(moved > tolerance).select("page", "cluster_no", F.round("centre", 3).alias("centre"), profile.alias("profile"), F.round(moved, 3).alias("displacement"))


@by_document("table_id")
def open_at_end(rows: DataFrame) -> DataFrame:
    """table_id, n_open: rows whose level is still open after a table's last row: no later row ranks as low.

    rows: table_id, doc_pos, rank; rows that don't open a level have a null rank. One sort a table.
    """
    after = Window.partitionBy("table_id").orderBy("doc_pos").rowsBetween(1, Window.unboundedFollowing)
    lowest = F.min("rank").over(after)
    still = rows.where(F.col("rank").isNotNull()).withColumn("_l", lowest).where(F.col("_l").isNull() | (F.col("_l") > F.col("rank")))
    return still.groupBy("table_id").agg(F.count(F.lit(1)).alias("n_open"))


def type_gate(pages: DataFrame, expected: str) -> tuple[DataFrame, DataFrame]:
    """Pages of the expected table type, and page, message of the others."""
    other = ~F.col("table_type").eqNullSafe(F.lit(expected))
    failed = pages.where(other).select("page", F.concat(F.lit(f"expected {expected}, found "), F.coalesce("table_type", F.lit("none"))).alias("message"))
    return pages.where(~other), failed


def span_split(pages: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """Pages inside and outside the reviewed span."""
    inside = F.col("page").between(first, last)
    return pages.where(inside), pages.where(~inside)


@by_document("page")
def page_slice(nodes: DataFrame, flags: DataFrame) -> DataFrame:
    """page, n_nodes, n_flags: what a tree holds for each page."""
    n = nodes.where(F.col("page").isNotNull()).groupBy("page").agg(F.count(F.lit(1)).alias("n_nodes"))
    f = flags.groupBy("page").agg(F.count(F.lit(1)).alias("n_flags"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return n.join(f, "page", "full_outer").select("page", zero("n_nodes"), zero("n_flags"))


def centre_statistics(rows: DataFrame) -> DataFrame:
    """level, n, n_pages, least, greatest, p05, p95, mad, furthest: how the distances of each level lie around its centre.

    rows: page, level, centre, distance. Exact percentiles.
    """
    w = Window.partitionBy("level")
    r = rows.withColumn("_m", F.median("distance").over(w))
    q = lambda p: F.percentile("distance", F.lit(p))
    return r.groupBy("level").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("page").alias("n_pages"), F.min("distance").alias("least"), F.max("distance").alias("greatest"), q(0.05).alias("p05"), q(0.95).alias("p95"),
        F.median(F.abs(F.col("distance") - F.col("_m"))).alias("mad"), F.max(F.abs(F.col("distance") - F.col("centre"))).alias("furthest"),
    )


@by_document("page")
def apply_repair(claims: DataFrame, phrases: DataFrame, chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claims (page, label_id, amount_id) and phrases with closed chains applied: each amount goes to its new label and that label's band.

    Amounts that a chain rebinds lose their old claim; everything else stays. Geometry that depends on claims
    and bands is derived again from what this returns.
    """
    new = chains.where(F.coalesce("closed", F.lit(False))).select("page", "amount_id", F.col("label_id").alias("new_label"))
    rebound = claims.join(new.select("page", "amount_id"), ["page", "amount_id"], "left_anti").unionByName(new.select("page", F.col("new_label").alias("label_id"), "amount_id"))
    band = phrases.select("page", F.col("phrase_id").alias("new_label"), F.col("band_id").alias("new_band"))
    moved = new.join(band, ["page", "new_label"]).select("page", F.col("amount_id").alias("phrase_id"), "new_band")
    out = phrases.join(moved, ["page", "phrase_id"], "left").withColumn("band_id", F.coalesce("new_band", "band_id")).drop("new_band")
    return rebound.select("page", "label_id", "amount_id"), out


@by_document("page")
def mean_confidence(tokens: DataFrame, value: Column) -> DataFrame:
    """page, confidence: mean of the tokens that have one, four decimals."""
    return tokens.groupBy("page").agg(F.round(F.avg(value), 4).alias("confidence"))
