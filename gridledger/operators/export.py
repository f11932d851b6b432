"""Export views: resolved columns, wide amounts, flat rows, CSV and JSON, page spans, flag filters, sorting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.functions import codes
from gridledger.operators import hierarchy
from gridledger.operators.keys import by_document, document_of
from gridledger.sources.scratch import stage_table

# Names of resolved columns from the right, and the order in which they are shown.
ANCHOR_ROLES = ("Total", "CO", "MOOE", "PS")
SHOWN = ("PS", "MOOE", "CO")


@by_document("page")
def role_resolution(roles: DataFrame) -> DataFrame:
    """page, role, resolved: used generic roles ("Amount 3") from the right are Total, CO, MOOE, PS; more stay unmapped.

    roles: page, role of the nodes' amounts.
    """
    generic = roles.where(~F.col("role").isin(*ANCHOR_ROLES)).select("page", "role").distinct()
    ordinal = F.coalesce(F.regexp_extract("role", r"(?:^| )(\d+)$", 1).try_cast("bigint"), F.lit(0))
    place = F.row_number().over(Window.partitionBy("page").orderBy(F.desc(ordinal), F.desc("role")))
    return generic.select("page", "role", F.get(F.array(*[F.lit(r) for r in ANCHOR_ROLES]), place - 1).alias("resolved"))


def amount_pick(role: str, total_role: Column, total_value: Column, value: Column) -> Column:
    """A column's amount: the row's total if it stands in that column, else the amount itself."""
    return F.coalesce(F.when(total_role == role, total_value), value)


def wide_amounts(amounts: DataFrame) -> DataFrame:
    """id, ps, mooe, co, total: amounts by resolved role in columns. amounts: id, role, value."""
    return amounts.groupBy("id").agg(*[F.max(F.when(F.col("role") == r, F.col("value"))).alias(r.lower()) for r in (*SHOWN, "Total")])


def slim_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes of an export: no synthetic ones, tier as tier_pdf, dense row numbers in document order; both parents of a
    dual hierarchy with the parts of the code (prexc), and description, whole label, stations and places, as far as nodes have them."""
    w = Window.partitionBy(*document_of(nodes), "table_id").orderBy("doc_pos")
    more = [c for c in ("parent_pdf", "parent_prexc", "label_ocr", "description", "chainages", "coordinates", "bbox") if c in nodes.columns]
    parts = [codes.split(F.col("code")).alias("prexc")] if "parent_prexc" in nodes.columns else []
    kept = nodes.where(~F.coalesce("synthetic", F.lit(False)))
    return kept.select(*document_of(nodes), "table_id", (F.row_number().over(w) - 1).cast("bigint").alias("row_index"), "id", "kind", "page", F.col("tier").alias("tier_pdf"), "label", "code", "parent", *more, *parts)


def column_rank(role: Column) -> Column:
    """Where an amount column is shown: known roles in their order, numbered ones by number, others by name, the total last."""
    known = F.array_position(F.array(*[F.lit(r) for r in SHOWN]), role)
    number = F.regexp_extract(role, r"(?i)^Amount\s+(\d+)$", 1).try_cast("bigint")
    return F.when(known > 0, known).when(role == "Total", F.lit(10_000)).otherwise(F.coalesce(100 + number, F.lit(1_000)))


def column_vocabulary(amounts: DataFrame) -> DataFrame:
    """position, role of all amount columns in the order in which they are shown. The roles of a table are few."""
    w = Window.orderBy(column_rank(F.col("role")), "role")
    return amounts.select("role").distinct().select((F.row_number().over(w) - 1).cast("bigint").alias("position"), "role")


@by_document("table_id")
def page_span(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("page").isNotNull()).groupBy("table_id").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count(F.lit(1)).alias("n_nodes"))


def table_of_page(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """page, table_id of the tables whose span holds the page. Spans are one row a table."""
    return pages.join(spans, F.col("page").between(F.col("first_page"), F.col("last_page"))).select("page", "table_id")


@by_document("page")
def flag_filter(pages: DataFrame, flags: DataFrame, include: list[str] | None, exclude: list[str]) -> DataFrame:
    """page: those with an included flag (null: all pages; empty: none) and without excluded ones. flags: page, code."""
    kept = pages if include is None else pages.join(flags.where(F.col("code").isin(include) if include else F.lit(False)).select("page").distinct(), "page", "left_semi")
    return kept.join(flags.where(F.col("code").isin(exclude)).select("page").distinct(), "page", "left_anti") if exclude else kept


@by_document("page")
def hit_test(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """point_id, box_id: the box that holds a point with the closest centre line, then the lowest, then the smallest.

    Both sides carry the page. points: page, point_id, px, py.
    """
    inside = F.col("px").between(F.col("x0"), F.col("x1")) & F.col("py").between(F.col("y0"), F.col("y1"))
    height, width = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    rank = F.struct(F.abs((F.col("y0") + F.col("y1")) / 2 - F.col("py")).alias("d"), height.alias("h"), (width * height).alias("a"), F.col("box_id"))
    return points.join(boxes, "page").where(inside).groupBy("point_id").agg(F.min_by("box_id", rank).alias("box_id"))


def natural_key(text: Column) -> Column:
    """A key that orders numbers in texts by value: each is its count of digits, then its digits, without leading zeros."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"\d+|\D+"), 0)

    def sized(p: Column) -> Column:
        digits = F.regexp_replace(p, "^0+", "")
        return F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)

    return F.concat_ws("", F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), sized(p)).otherwise(p)))


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with their place (from 0) in a total order: ranges of it are numbered apart, and start where the ranges before them end."""
    dealt = stage_table(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("_inside", inside).join(starts, "_range").withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint")).drop("_range", "_inside", "_start")


def sorted_rows(rows: DataFrame, column: str, ascending: bool = True, tie: str = "row_index") -> DataFrame:
    """Rows in natural order of a text column, with place; empties last when ascending and first when descending."""
    empty = F.col(column).isNull() | (F.col(column) == "")
    key = natural_key(F.col(column))
    order = [empty.asc(), key.asc(), F.col(tie).asc()] if ascending else [empty.desc(), key.desc(), F.col(tie).asc()]
    return ranked(rows, order, "place")


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV as spreadsheets read it: a header, minimal quotes doubled inside, CRLF, nulls empty; rows in row_index order."""
    rows.repartitionByRange("row_index").sortWithinPartitions("row_index").write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("nullValue", "").option("lineSep", "\r\n").csv(path)


def tree_json(nodes: DataFrame) -> DataFrame:
    """table_id, row_index, json: a compact object a node; one line a node keeps a table of any size writable."""
    return nodes.select("table_id", "row_index", F.to_json(F.struct(*[c for c in nodes.columns if c != "table_id"])).alias("json"))


UNIT_COLUMNS = ("row_index", "id", "kind", "page", "tier_pdf", "label", "code", "parent_id_pdf", "parent_id_prexc", "depth_pdf", "depth_prexc", "prexc_identifier", "ps", "mooe", "co", "total")
PLAN_COLUMNS = ("row_index", "id", "kind", "page", "tier_pdf", "label", "code", "parent_id", "amount", "chainages", "lat", "lon")
PLAN_ROLE = "AMOUNT (Php)"


def _picked(amounts: DataFrame, totals: DataFrame) -> DataFrame:
    """id, role, value with the row's total in the place of its column's amount. amounts, totals: id, role, value."""
    total = totals.where(F.col("value").isNotNull()).select("id", "role", F.col("value").alias("t_value"))
    both = amounts.select("id", "role", "value").join(total, ["id", "role"], "full_outer")
    return both.select("id", "role", F.coalesce("t_value", "value").alias("value"))


@by_document("id", "parent", "parent_pdf", "parent_prexc", "parent_id_pdf", "parent_id_prexc")
def unit_csv_rows(nodes: DataFrame, amounts: DataFrame, totals: DataFrame) -> DataFrame:
    """UNIT_COLUMNS of slim nodes with both parents, without the table root. A parent that isn't exported counts for depth as none."""
    wide = wide_amounts(_picked(amounts, totals))
    rows = nodes.where("kind <> 'table_root'").join(wide, "id", "left")
    for name in ("pdf", "prexc"):
        rows = rows.join(hierarchy.depths(nodes, f"parent_{name}").withColumnRenamed("depth", f"depth_{name}"), "id")
    return rows.withColumns({"parent_id_pdf": F.col("parent_pdf"), "parent_id_prexc": F.col("parent_prexc"), "prexc_identifier": F.col("prexc.identifier")}).select(*document_of(rows), *UNIT_COLUMNS)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\\\])', r"\\$1"), F.lit('"'))


def stations_json(chainages: Column) -> Column:
    """Stations as JSON with a space after each comma and colon; what a station doesn't say is left out, and no stations are null."""
    one = lambda s: F.concat(
        F.lit('{"kind": '), _quoted(s["kind"]), F.lit(', "from": '), _quoted(s["from"]), F.when(s["to"].isNotNull(), F.concat(F.lit(', "to": '), _quoted(s["to"]))).otherwise(F.lit("")),
        F.when(s["incomplete"], F.lit(', "incomplete": true')).otherwise(F.lit("")), F.lit("}"),
    )
    return F.when(F.size(chainages) > 0, F.concat(F.lit("["), F.array_join(F.transform(chainages, one), ", "), F.lit("]")))


@by_document("id", "parent", "parent_id")
def plan_csv_rows(nodes: DataFrame, amounts: DataFrame, totals: DataFrame, read: DataFrame) -> DataFrame:
    """PLAN_COLUMNS of slim nodes, without the table root; lat and lon are those of the first place.

    read: id, chainages, coordinates as label_anatomy() gives them.
    """
    amount = _picked(amounts, totals).where(F.col("role") == PLAN_ROLE).groupBy("id").agg(F.max("value").alias("amount"))
    first = F.get("coordinates", F.lit(0))
    rows = nodes.drop("chainages", "coordinates").where("kind <> 'table_root'").join(amount, "id", "left").join(read.select("id", stations_json(F.col("chainages")).alias("chainages"), first["lat"].alias("lat"), first["lon"].alias("lon")), "id", "left")
    return rows.withColumn("parent_id", F.col("parent")).select(*document_of(rows), *PLAN_COLUMNS)


def station_chip(kind: Column, start: Column, stop: Column) -> Column:
    """A road station as a short label: K 0564+150 – 0564+200."""
    return F.concat(kind, F.lit(" "), start, F.when(stop.isNotNull(), F.concat(F.lit(" – "), stop)).otherwise(F.lit("")))


def flag_source(index_total: int, summary_total: int) -> str:
    """Where flagged pages are read from: the index, if it knows as many flags as the stages' summaries."""
    return "index" if index_total >= summary_total else "summary"
