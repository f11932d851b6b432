"""Registered queries: each applies one operator to an input made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger.functions import codes, flags, lexical
from gridledger.operators import anatomy, bands, export, geometry, hierarchy, regions, sections, totals
from gridledger.operators import rows as row_ops
from gridledger.plans.inputs import read_input
from gridledger.sources import documents, specs

QUERIES = {}


def query(*inputs):
    """Registers a function of input frames under its name, as (spark, sf_dir) -> DataFrame."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(read_input(spark, sf_dir, n) for n in inputs))
        return f

    return register


# ---- reconciliation and trees ----------------------------------------------------------------------------
@query("tree")
def parent_total_check(tree):
    return totals.parent_totals(tree)


@query("tree")
def parent_total_partial_span(tree):
    return totals.parent_totals(tree, tolerance=1, last_page=400, span_end=690)


@query("tree")
def parent_total_through_shells(tree):
    return totals.parent_totals(tree, expand=True)


@query("tree")
def parent_total_status_counts(tree):
    return totals.status_counts(totals.parent_totals(tree))


@query("tree")
def parent_total_diagnostics(tree):
    return totals.diagnostics(totals.parent_totals(tree))


@query("tree")
def parent_total_page_slice(tree):
    return totals.page_slice(totals.parent_totals(tree))


@query("tree")
def tree_depth(tree):
    return hierarchy.depths(tree)


@query("tree")
def tree_descendant_max_page(tree):
    return hierarchy.descendant_max_page(tree)


@query("tree")
def tree_search_with_ancestors(tree):
    return hierarchy.search(tree, lexical.haystack(F.col("label"), F.col("code"), F.col("kind")).contains("urgent") & (F.col("page") <= 20))


@query("tree")
def tree_visible_rows(tree):
    expanded = tree.where("kind in ('table_root', 'region') or (kind = 'office' and page % 2 = 0) or (kind = 'program' and page % 3 = 0)").select("id")
    return hierarchy.visible(tree, expanded)


@query("tree")
def tree_children_lists(tree):
    return hierarchy.children(tree).select("id", F.concat_ws(",", "children").alias("children"))


@query("tree")
def tree_invariants(tree):
    """Over a tree with planted faults: an office and a row number are missing, some boxes have no page."""
    w = Window.orderBy("doc_pos")
    broken = tree.withColumn("row_index", F.row_number().over(w) - 1).where("id <> 'n3' and id <> 'r1'")
    return hierarchy.invariants(broken.withColumn("has_bbox", F.lit(True)))


@query("tree")
def shell_expansion(tree):
    return hierarchy.expand_shells(tree)


@query("tree")
def kind_counts(tree):
    return tree.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


# ---- hierarchy from rows ---------------------------------------------------------------------------------
@query("rows")
def stack_parent_by_rank(rows):
    out = hierarchy.stack_parents(rows.select("table_id", "doc_pos", "id", "rank", "expense", "top_section", "marked", "attached"), ["table_id"])
    return out.select("table_id", "id", "parent")


@query("rows")
def unit_stack_parents(rows):
    kind = F.expr("CASE WHEN doc_pos % 19 = 0 THEN 'section' WHEN doc_pos % 23 = 0 THEN 'subtotal' WHEN doc_pos % 29 = 0 THEN 'funding' WHEN rank = 0 THEN 'program' WHEN rank < 3 THEN 'activity' WHEN rank < 5 THEN 'region' ELSE 'office' END")
    shaped = rows.withColumns({"kind": kind, "code": F.concat(F.lit("31010"), (F.col("supp") % 9).cast("string"), F.lpad(F.col("part").cast("string"), 9, "0")), "segment_id": F.expr("page div 40"), "section_letter": F.lit(None).cast("string")})
    return hierarchy.unit_parents(shaped)


@query("row_pages")
def segment_carry(pages):
    return hierarchy.segments(pages)


@query("ticks")
def gap_clusters(ticks):
    return hierarchy.gap_clusters(ticks.withColumnRenamed("user_id", "page"), gap=6.0)


@query("ticks")
def unit_tier_centres(ticks):
    return hierarchy.unit_tiers(ticks.withColumnRenamed("user_id", "page"))


@query("ticks")
def nearest_centre(ticks):
    centres = F.array(*[F.lit(c) for c in (514.6, 496.5, 480.0, 60.0, 45.0, 30.0, 15.0, 5.0)])
    return ticks.select("event_id", hierarchy.nearest(F.col("distance"), centres).cast("bigint").alias("level"))


@query("ticks")
def rank_ladder(ticks):
    clusters = hierarchy.gap_clusters(ticks.withColumnRenamed("user_id", "page"), gap=6.0)
    return hierarchy.rank_ladder(clusters, [120.0, 100.0, 80.0, 60.0, 45.0, 30.0, 15.0, 0.0]).select("page", "cluster_no", "rank")


@query("ticks")
def centre_assignment(ticks):
    a = hierarchy.assignment(F.col("distance"), F.round(F.col("distance") / 10) * 10, 4.0)
    return ticks.select("event_id", a["delta"].alias("delta"), a["confidence"].alias("confidence"), a["outside"].alias("outside"))


@query("tokens")
def row_total_cells(tokens):
    cells = tokens.select("page", F.col("band_id").alias("row_id"), F.col("token_id").alias("column_id"), F.when(F.col("token_id") % 4 == 1, F.lit("Labels")).otherwise(F.concat(F.lit("Amount "), (F.col("token_id") % 8).cast("string"))).alias("role"), "text", (F.col("token_id") % 3).alias("n_money"))
    out = hierarchy.row_totals(cells)
    return out.select("page", "row_id", F.col("total.role").alias("role"), F.col("total.text").alias("text"), F.col("total.value").alias("value"), F.size("amounts").cast("bigint").alias("n_amounts"))


@query("rows")
def continuation_merge(rows):
    shaped = rows.select("table_id", "doc_pos", "id", F.concat(F.lit("part  "), F.col("part").cast("string")).alias("label"), F.when(F.col("supp") % 4 > 0, F.col("rank").cast("double")).alias("distance"), (F.col("qty") % 2).alias("n_amounts"))
    return hierarchy.continuation_merge(shaped)


@query("rows")
def subtotal_latest_match(rows):
    key = F.concat((F.col("part") % 40).cast("string"), F.lit(" item"), F.repeat(F.lit("s"), F.col("qty").cast("int") % 3))
    keyed = rows.withColumn("key", key)
    return hierarchy.latest_match(keyed.where("supp % 9 > 0").select("table_id", "doc_pos", "id", "key"), keyed.where("supp % 9 = 0").select("table_id", "doc_pos", "id", "key"))


# ---- geometry --------------------------------------------------------------------------------------------
@query("rows")
def median_mad(rows):
    return geometry.median_mad(rows.withColumn("v", F.col("amount").cast("double")), "rank", "v")


@query("rows")
def line_fit(rows):
    """Integers in the sums, so that the fit doesn't depend on their order."""
    out = geometry.line_fit(rows.select("rank", F.col("qty").cast("double").alias("x"), F.col("line").cast("double").alias("y")), "rank", "x", "y")
    return out.select("rank", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query("phrases")
def column_drift_pairs(phrases):
    edges = phrases.where("observation = 'money_candidate'").select("page", F.expr("cast(floor(x1 / 30) as bigint)").alias("column_id"), F.col("phrase_id").alias("id"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    out = geometry.column_drift(edges, ["page", "column_id"])
    return out.select("page", "column_id", F.round("drift", 6).alias("drift"))


@query("tokens")
def baseline_tolerance(tokens):
    return geometry.baseline_tolerance(tokens.withColumn("y1", F.col("y1") + F.col("token_id") % 5))


@query("marked")
def token_gap(tokens):
    return geometry.token_gaps(tokens, F.lit(5.0))


@query("marked")
def phrase_materialize(tokens):
    out = geometry.phrases(tokens, F.lit(5.0))
    return out.select("page", "band_id", "phrase_id", "text", "x0", "y0", "x1", "y1", F.size("token_ids").cast("bigint").alias("n_tokens"), "observation")


@query("phrases")
def money_anchor_window(phrases):
    return geometry.money_window(phrases, F.lit(720.0)).select("page", "phrase_id", "x1")


@query("phrases")
def amount_column_clusters(phrases):
    shaped = phrases.where("observation = 'money_candidate'").select("page", F.col("phrase_id").alias("id"), "x1", "y1", F.lit(7.5).alias("tolerance"))
    return geometry.running_median_clusters(shaped, "x1", ["x1", "y1", "id"], "tolerance")


@query("phrases")
def column_summary(phrases):
    return geometry.column_summary(phrases.where("observation = 'money_candidate'").withColumn("column_id", F.expr("cast(floor(x1 / 60) as bigint)")))


@query("phrases")
def reference_anchor(phrases):
    return geometry.reference_anchor(geometry.column_summary(phrases.where("observation = 'money_candidate'").withColumn("column_id", F.expr("cast(floor(x1 / 60) as bigint)"))))


@query("phrases")
def label_amount_pairing(phrases):
    out = geometry.label_amount_pairs(phrases)
    return out.select("page", "band_id", "label_id", F.concat_ws(",", F.transform("amount_ids", lambda x: x.cast("string"))).alias("amount_ids"))


@query("phrases")
def separator_candidates(phrases):
    return geometry.separators(phrases)


@query("phrases")
def alignment_fits(phrases):
    columns = phrases.where("observation = 'money_candidate'").select("page", "phrase_id", F.expr("cast(floor(x1 / 60) as bigint)").alias("column_id"))
    out = geometry.alignment_fits(phrases, columns)
    return out.select("page", "column_id", "n_pairs", F.round("slope", 6).alias("slope"), F.round("slope_mad", 6).alias("slope_mad"), "review")


@query("phrases")
def page_drifts(phrases):
    out = geometry.page_drift(phrases.where("observation = 'money_candidate'"))
    return out.select("page", F.round("drift", 6).alias("drift"))


def _straightened(phrases):
    drifts = phrases.select("page", (0.015625 * (F.col("page") % 3)).alias("drift")).distinct()
    return geometry.without_drift(phrases, drifts, F.lit(864.0))


@query("phrases")
def anchored_columns(phrases):
    members = _straightened(phrases.where("observation = 'money_candidate'")).withColumn("column_id", F.expr("cast(floor(x1 / 60) as bigint)"))
    return geometry.anchored_columns(members, F.lit(32.0), F.lit(864.0))


@query("phrases")
def relative_anchors(phrases):
    anchors = phrases.where("page % 5 > 0").select("page", F.lit(700.0).alias("reference_x")).distinct()
    return geometry.relative_anchors(_straightened(phrases), anchors)


@query("phrases")
def orphan_amounts(phrases):
    pairs = geometry.label_amount_pairs(phrases).select("page", F.explode("amount_ids").alias("phrase_id"))
    return phrases.where("observation = 'money_candidate'").join(pairs, ["page", "phrase_id"], "left_anti").select("page", "phrase_id")


@query("tokens")
def baseline_bands(tokens):
    return bands.baseline_bands(tokens)


@query("phrases")
def chain_repair(phrases):
    claimed = F.when((F.col("observation") == "money_candidate") & (F.col("phrase_id") % 5 > 0), F.col("phrase_id") - 1)
    role = F.when(F.col("observation") == "money_candidate", F.lit("amount")).otherwise(F.lit("label"))
    return bands.chain_repair(phrases.select("page", F.col("phrase_id").alias("item_id"), role.alias("role"), "y0", "y1", claimed.alias("claimed_by")))


@query("tokens")
def unassigned_tokens(tokens):
    """What is left when the usable tokens go."""
    marked = tokens.withColumn("text", F.when(F.col("token_id") % 16 == 1, F.lit(" ")).otherwise(F.col("text")))
    return marked.join(geometry.usable(marked, F.col("y0") < 20).select("token_id"), "token_id", "left_anti").select("page", "token_id")


# ---- sections --------------------------------------------------------------------------------------------
def _spans(frame):
    return frame.sparkSession.createDataFrame([(1, 13, 108, "by_ou", "wraps_up"), (2, 100, 690, "pap", "wraps_down")], "`order` int, start_page bigint, end_page bigint, table_type string, wrap_direction string")


@query("all_pages")
def layout_span_lookup(pages):
    return sections.layout_spans(pages, _spans(pages))


@query("tokens")
def band_range_clip(tokens):
    band = tokens.select("page", "band_id").distinct()
    seeds = tokens.sparkSession.createDataFrame([(13, 40, 60, 90)], "first_page bigint, first_band bigint, last_page bigint, last_band bigint")
    return sections.clip_bands(band, seeds)


@query("phrases")
def gutter_exclusion(phrases):
    return phrases.where(~sections.outside_gutter(F.lit(864.0))).select("page", "phrase_id")


def _columns(phrases):
    edges = [(k, 180.0 * k, 180.0 * (k + 1), k == 4) for k in range(5)]
    c = phrases.sparkSession.createDataFrame(edges, "column_id bigint, left_x double, right_x double, is_last boolean")
    c = c.withColumns({"left_slope": F.lit(0.01), "right_slope": F.lit(0.01), "role": F.when(F.col("column_id") == 0, F.lit("Labels")).otherwise(F.concat(F.lit("Amount "), F.col("column_id").cast("string")))})
    return phrases.select("page").distinct().join(F.broadcast(c))


@query("phrases")
def column_interval_join(phrases):
    return sections.in_column(phrases, _columns(phrases))


def _boundaries(phrases):
    return phrases.where("phrase_id % 8 = 1 and band_id % 3 = 0").select("page", F.col("band_id").cast("double").alias("y"), "band_id", F.col("phrase_id").alias("label_id"))


@query("phrases")
def row_boundaries_up(phrases):
    return sections.row_bounds(_boundaries(phrases), wraps_down=False)


@query("phrases")
def row_range_join_up(phrases):
    return sections.in_row(phrases, sections.row_bounds(_boundaries(phrases), wraps_down=False), wraps_down=False)


@query("phrases")
def row_range_join_down(phrases):
    return sections.in_row(phrases, sections.row_bounds(_boundaries(phrases), wraps_down=True), wraps_down=True)


@query("phrases")
def cell_grid(phrases):
    rows = sections.row_bounds(_boundaries(phrases), wraps_down=True)
    columns = _columns(phrases)
    out = sections.cells(phrases, rows, columns, sections.in_row(phrases, rows, True), sections.in_column(phrases, columns))
    return out.select("page", "row_id", "column_id", "role", F.concat_ws(",", F.transform("phrase_ids", lambda x: x.cast("string"))).alias("phrase_ids"), "text", "empty")


@query("phrases")
def header_sections(phrases):
    b = phrases.where("band_id < 6").select("page", "band_id").distinct().withColumn("role", F.when(F.col("band_id") < 2, F.lit("title")).otherwise(F.lit("columns")))
    return sections.headers(b, phrases)


@query("phrases")
def cardinality_findings(phrases):
    role = F.when(F.col("x0") < 300, F.lit("Labels")).otherwise(F.lit("Amount 1"))
    kind = F.when(F.col("observation") == "money_candidate", F.lit("money")).when(F.col("observation") == "text_candidate", F.lit("main_text")).otherwise(F.lit("other"))
    members = phrases.select("page", F.col("band_id").alias("row_id"), F.when(F.col("x0") < 300, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("column_id"), role.alias("role"), "phrase_id", kind.alias("kind"))
    return sections.findings(members)


@query("findings")
def flag_objects(findings):
    return sections.flag_objects(findings)


@query("phrases")
def best_overlap_region(phrases):
    regions = phrases.select("page", F.col("phrase_id").alias("region_id"), (F.col("phrase_id") % 3).alias("priority"), F.col("x0").alias("x0"), F.col("y0").alias("y0"), (F.col("x0") + 100).alias("x1"), (F.col("y0") + 30).alias("y1"))
    return sections.best_region(phrases.withColumnRenamed("phrase_id", "line_id"), regions)


@query("tokens")
def majority_region(tokens):
    return sections.majority_region(tokens.select("page", F.col("band_id").alias("line_id"), F.col("token_id").alias("pos"), F.when(F.col("token_id") % 7 > 0, F.expr("cast(floor(x0 / 240) as bigint)")).alias("region_id")))


@query("tokens")
def grid_rows(tokens):
    return sections.grid_lines(tokens, F.col("x0"), 18.0)


@query("phrases")
def polygon_corners(phrases):
    p = sections.crossing(F.col("x0"), F.lit(0.0), F.col("x0") + 10, F.lit(1000.0), F.lit(0.0), F.col("y0"), F.lit(720.0), F.col("y0") + 8)
    return phrases.select("phrase_id", F.round(p["x"], 4).alias("x"), F.round(p["y"], 4).alias("y"))


# ---- text ------------------------------------------------------------------------------------------------
@query("marked")
def observation_classify(tokens):
    return tokens.select("token_id", lexical.observation(F.col("text")).alias("observation"), lexical.observation_confidence(F.col("text")).alias("confidence"))


@query("marked")
def amount_parse(tokens):
    return tokens.select("token_id", lexical.amount(F.col("text")).alias("amount"))


@query("labels")
def label_normalize(labels):
    return labels.select("id", lexical.normalize_label(F.col("label")).alias("label"), lexical.clean(F.col("label")).alias("cleaned"))


@query("labels")
def kind_classify(labels):
    return labels.select("id", lexical.plan_kind(F.col("label"), F.col("rank")).alias("kind"))


@query("coded")
def unit_kind_classify(coded):
    return coded.select("id", lexical.unit_kind(F.concat(F.lit("Region "), F.when(F.col("doc_pos") % 3 == 0, F.lit("IV")).otherwise(F.lit("q"))), F.col("code"), F.col("doc_pos") % 2).alias("kind"))


@query("labels")
def label_predicates(labels):
    c = F.col("label")
    return labels.select("id", lexical.is_subtotal(c).alias("subtotal"), lexical.is_total(c).alias("total"), lexical.is_funding(c).alias("funding"), lexical.chainage_cue(c).alias("station_cue"))


@query("labels")
def slug(labels):
    return labels.select("id", lexical.slug(F.col("label")).alias("slug"))


@query("labels")
def marker_extract(labels):
    prefixes = F.array(F.when(F.col("id") % 4 == 0, F.lit("x")).otherwise(F.lit("1.")), F.lit("a)"))
    return labels.select("id", lexical.marker(F.when(F.col("id") % 3 == 0, prefixes).otherwise(F.array().cast("array<string>")), F.col("label")).alias("marker"))


@query("ticks")
def coordinate_order(ticks):
    p = lexical.latitude_first(F.col("distance"), F.lit(121.5))
    q = lexical.latitude_first(F.lit(121.5), F.col("distance"))
    d = lexical.dms(F.lit(14.0), F.col("distance"), F.lit(30.0), F.when(F.col("event_id") % 2 == 0, F.lit("S")).otherwise(F.lit("N")))
    return ticks.select("event_id", p["swapped"].alias("swapped_a"), q["swapped"].alias("swapped_b"), F.round(d, 6).alias("degrees"))


@query("tokens")
def overlap_confidence(tokens):
    r = lexical.overlap_ratio(F.col("y0"), F.col("y1"), F.lit(100.0), F.lit(106.0))
    return tokens.select("token_id", F.round(r, 4).alias("overlap"), F.round(lexical.char_width(F.col("text"), F.col("x1") - F.col("x0")), 4).alias("char_width"))


@query("orders")
def size_labels(orders):
    return orders.select("o_orderkey", lexical.human_size(F.col("o_orderkey") * 397).alias("size"))


@query("labels")
def label_anatomy(labels):
    return anatomy.label_anatomy(labels).select("id", "label", "label_ocr", F.size("chainages").cast("bigint").alias("n_chainages"), F.size("coordinates").cast("bigint").alias("n_coordinates"))


@query("labels")
def label_anatomy_stats(labels):
    return anatomy.anatomy_stats(anatomy.label_anatomy(labels))


@query("labels")
def title_description(labels):
    numbers = labels.withColumn("line_no", F.explode(F.sequence(F.lit(1), F.lit(2))))
    text = F.when(F.col("line_no") == 1, F.col("label")).when(F.col("id") % 2 == 0, F.lit("This aims to  widen roads")).otherwise(F.lit("K12 goes on"))
    return anatomy.split_lines(numbers.select("id", "line_no", text.alias("text"), F.when(F.col("id") % 3 == 0, F.lit(80.0)).otherwise(F.lit(10.0)).alias("run_gap_pt"), F.lit(2.0).alias("run_gap_spaces")))


# ---- codes -----------------------------------------------------------------------------------------------
@query("coded")
def code_split(coded):
    p = codes.split(F.col("code"))
    return coded.select("id", *[p[name].alias(name) for name in codes.PARTS], lexical.code_kind(F.col("code")).alias("kind"), codes.is_project(F.col("code")).alias("is_project"))


@query("coded")
def code_ancestors(coded):
    return coded.select("id", F.posexplode(codes.ancestors(F.col("code"))).alias("depth", "ancestor")).select("id", F.col("depth").cast("bigint").alias("depth"), "ancestor")


@query("coded")
def code_longest_prefix_parent(coded):
    return codes.code_parents(coded)


@query("coded")
def code_shell_synthesis(coded):
    return codes.shells(coded)


@query("coded")
def code_dual_hierarchy(coded):
    return codes.dual_hierarchy(coded).select("table_id", "id", "parent_pdf", "parent_prexc", "parent")


@query("coded")
def code_rewire_stats(coded):
    return codes.rewire_stats(codes.dual_hierarchy(coded))


# ---- export ----------------------------------------------------------------------------------------------
@query("amounts")
def role_resolution(amounts):
    return export.role_resolution(amounts)


@query("amounts")
def amount_pivot(amounts):
    resolved = amounts.join(export.role_resolution(amounts), ["page", "role"]).where(F.col("resolved").isNotNull())
    return export.wide_amounts(resolved.select("id", F.col("resolved").alias("role"), "value"))


@query("tree")
def export_rows(tree):
    return export.slim_nodes(tree.withColumns({"table_id": F.lit(1).cast("bigint"), "tier": F.length("kind").cast("bigint")}))


@query("amounts")
def column_vocabulary(amounts):
    return export.column_vocabulary(amounts.select(F.when(F.col("value") % 3 == 0, F.lit("Total")).when(F.col("value") % 3 == 1, F.lit("MOOE")).otherwise(F.col("role")).alias("role")))


@query("rows")
def page_span(rows):
    return export.page_span(rows)


@query("rows", "all_pages")
def table_of_page(rows, pages):
    return export.table_of_page(pages, export.page_span(rows).select("table_id", "first_page", "last_page"))


@query("findings")
def flag_page_filter(findings):
    """The excluded flag only counts on every third page, so that some pages are left."""
    flagged = findings.where("code <> 'main_text_candidate_outside_label_cell' or page % 3 = 0")
    return export.flag_filter(findings.select("page").distinct(), flagged, ["no_main_text_anchor", "multiple_money_candidates_in_cell"], ["main_text_candidate_outside_label_cell"])


@query("phrases")
def box_hit_test(phrases):
    points = phrases.select("page", F.col("phrase_id").alias("point_id"), (F.col("x0") + 1).alias("px"), (F.col("y0") + 3).alias("py"))
    return export.hit_test(points, phrases.withColumnRenamed("phrase_id", "box_id"))


@query("part")
def natural_sort(part):
    return export.sorted_rows(part.select(F.col("p_partkey").alias("row_index"), F.when(F.col("p_partkey") % 7 > 0, F.col("p_brand")).alias("brand")), "brand", ascending=False)


@query("tree")
def tree_lines(tree):
    rows = export.slim_nodes(tree.withColumns({"table_id": F.lit(1).cast("bigint"), "tier": F.lit(2).cast("bigint")}))
    return export.tree_json(rows.select("table_id", "row_index", "id", "kind"))


# ---- sources ---------------------------------------------------------------------------------------------
@query("labels")
def lenient_page_lists(labels):
    spec = F.concat((F.col("id") % 9).cast("string"), F.lit("-"), (F.col("id") % 13).cast("string"), F.lit(",x, 3 ,5-4,"), (F.col("id") % 5 + 1).cast("string"))
    return labels.select("id", F.concat_ws(",", F.transform(specs.lenient_pages(spec), lambda x: x.cast("string"))).alias("pages"))


@query("all_pages")
def page_spec_filter(pages):
    wanted = specs.page_frame(pages.sparkSession, specs.parse_pages("1-2,3,5-7,20-40"))
    return pages.join(F.broadcast(wanted), "page", "left_semi")


@query("lines")
def recognised_tokens(lines):
    x = (F.col("part") % 300).cast("double")
    box = lambda a: F.array(F.array(a, F.lit(10.0)), F.array(a + 50, F.lit(10.0)), F.array(a + 50, F.lit(30.0)), F.array(a, F.lit(30.0)))
    words = F.when(F.col("line") % 2 == 0, F.array(F.lit("a"), F.col("qty").cast("string"))).otherwise(F.array().cast("array<string>"))
    points = F.when(F.col("line") % 2 == 0, F.array(box(x), box(x + 60))).otherwise(F.array().cast("array<array<array<double>>>"))
    item = F.struct("line", F.struct(F.lit("t").alias("text"), F.lit(0.9).alias("score"), box(x).alias("points"), words.alias("words"), points.alias("word_points")).alias("l"))
    pages = lines.groupBy(F.col("l_orderkey").alias("page")).agg(F.transform(F.array_sort(F.collect_list(item)), lambda i: i["l"]).alias("lines"))
    out = documents.recognised_tokens(pages, 200.0)
    return out.select("page", "token_id", "line_id", "text", F.col("bbox.x0").alias("x0"), F.col("bbox.x1").alias("x1"))


@query("all_pages")
def page_union(pages):
    return documents.merge_pages(pages.where("page % 2 = 0"), pages.where("page % 3 = 0"))


@query("part")
def index_upsert(part):
    old = part.select("p_partkey", "p_brand")
    new = part.where("p_partkey % 5 = 0").select("p_partkey", F.lit("new").alias("p_brand"))
    return documents.upsert(old, new, "p_partkey")


@query("nation")
def storage_estimate(nation):
    spark = nation.sparkSession
    costs = spark.createDataFrame(list(documents.STAGE_BYTES.items()), "stage string, bytes_per_page bigint")
    return documents.storage_estimate(spark.createDataFrame([("002.10",), ("002.20",), ("002.50",)], "stage string"), costs, n_pages=722, fixed=1000)


@query("findings")
def flag_index(findings):
    return documents.flag_index(findings.where("code <> 'other_code'"))


@query("findings")
def stage_qa_rollup(findings):
    pages = findings.groupBy("page").agg(F.count(F.lit(1)).alias("n_flags")).select(F.concat(F.lit("002."), (F.col("page") % 4).cast("string")).alias("stage"), "page", (F.col("page") % 4 != 2).alias("ok"), "n_flags")
    return documents.stage_summary(pages)


@query("events")
def json_props_projection(events):
    return events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("lineitem", "orders", "customer", "nation", "supplier")
def reconcile_union_rollup(lineitem, orders, customer, nation, supplier):
    """Two branches of amounts at one grain, dimensions by outer join, a composite key, and a rewritten sort key."""
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    sold = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"]).join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    a = sold.groupBy(F.lit("C").alias("branch"), F.col("c_nationkey").cast("bigint").alias("nationkey"), F.concat_ws("_", "l_returnflag", "l_linestatus", F.col("c_mktsegment")).alias("fund")).agg(cents.alias("cents"))
    bought = lineitem.join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"], "left")
    b = bought.groupBy(F.lit("S").alias("branch"), F.col("s_nationkey").cast("bigint").alias("nationkey"), F.concat_ws("_", "l_returnflag", "l_linestatus").alias("fund")).agg(cents.alias("cents"))
    n = nation.select(F.col("n_nationkey").cast("bigint").alias("nationkey"), F.translate("n_name", "\r\n\t", "   ").alias("nation")).distinct()
    return a.unionByName(b).join(F.broadcast(n), "nationkey", "left").select("branch", "nation", "fund", F.replace("fund", F.lit("_"), F.lit("2")).alias("sort_key"), "cents")


# ---- row views and regions -------------------------------------------------------------------------------
@query("phrases")
def left_of_label(phrases):
    in_rows = phrases.select("page", "phrase_id", F.col("band_id").alias("row_id"))
    labels = phrases.where("phrase_id % 8 = 1").select("page", F.col("band_id").alias("row_id"), F.col("x0").alias("left_x"))
    return row_ops.left_prefixes(phrases, in_rows, labels).select("page", "row_id", "phrase_id")


@query("phrases")
def row_views(phrases):
    base = phrases.withColumn("row_id", F.col("band_id"))
    rows = base.select("page", "row_id").distinct().withColumn("distance", F.col("row_id") * 2.0)
    cells = base.select("page", "row_id", F.col("phrase_id").alias("column_id"), F.when(F.col("phrase_id") % 4 == 1, F.lit("Labels")).otherwise(F.concat(F.lit("Amount "), (F.col("phrase_id") % 8).cast("string"))).alias("role"), F.when(F.col("phrase_id") % 3 == 0, F.lit(" ")).otherwise(F.col("text")).alias("text"), F.lit(1).alias("n_money"))
    prefixes = base.where("phrase_id % 8 = 6").select("page", "row_id", "phrase_id", "text", F.lit("code_candidate").alias("observation"), "band_id", "x0")
    return row_ops.row_views(rows, cells, prefixes)


@query("phrases")
def embedded_headers(phrases):
    shaped = phrases.withColumn("distance", F.col("x0"))
    return row_ops.embedded_headers(shaped, phrases.select("page", "phrase_id", F.expr("band_id div 4").alias("row_id")))


@query("tokens")
def label_line_metrics(tokens):
    lines = tokens.where("token_id % 4 < 2").groupBy("page", F.expr("band_id div 2").alias("row_id"), "band_id").agg(F.min("text").alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.collect_set("token_id").alias("token_ids"))
    lines = lines.withColumns({"cell_x0": F.lit(0.0), "cell_x1": F.lit(800.0)})
    out = row_ops.label_lines(lines, geometry.token_gaps(tokens, F.lit(5.0)))
    return out.withColumn("fill", F.round("fill", 6))


@query("phrases")
def seed_role_lookup(phrases):
    seeds = phrases.sparkSession.createDataFrame([(13, 8, "Total"), (13, 6, "CO")], "page bigint, column_id bigint, role string")
    columns = phrases.groupBy("page", F.expr("cast(floor(x1 / 90) as bigint)").alias("column_id")).agg(F.min("x0").alias("left_x"))
    return row_ops.seed_roles(columns, seeds)


@query("ticks")
def centre_displacement(ticks):
    return row_ops.displacements(hierarchy.gap_clusters(ticks.withColumnRenamed("user_id", "page"), gap=6.0), [120.0, 100.0, 80.0, 60.0, 45.0, 30.0, 15.0, 0.0])


@query("rows")
def open_levels_at_end(rows):
    return row_ops.open_at_end(rows.select("table_id", "doc_pos", F.when(~F.col("attached"), F.col("rank")).alias("rank")))


@query("all_pages")
def type_gate_failures(pages):
    return row_ops.type_gate(sections.layout_spans(pages, _spans(pages)), "pap")[1]


@query("all_pages")
def pages_off_span(pages):
    return row_ops.span_split(pages, 13, 108)[1]


@query("tree", "findings")
def tree_page_slice(tree, findings):
    return row_ops.page_slice(tree, findings)


@query("ticks")
def centre_statistics(ticks):
    rows = ticks.select(F.col("user_id").alias("page"), F.expr("cast(floor(distance / 25) as bigint)").alias("level"), (F.floor(F.col("distance") / 25) * 25.0).alias("centre"), "distance")
    out = row_ops.centre_statistics(rows)
    return out.select("level", "n", "n_pages", "least", "greatest", F.round("p05", 6).alias("p05"), F.round("p95", 6).alias("p95"), F.round("mad", 6).alias("mad"), F.round("furthest", 6).alias("furthest"))


@query("tokens")
def page_confidence(tokens):
    return row_ops.mean_confidence(tokens, F.when(F.col("token_id") % 3 > 0, (F.col("token_id") % 64) / 64.0))


@query("phrases")
def repaired_claims(phrases):
    claims = phrases.where("phrase_id % 4 = 2 and phrase_id % 5 > 0").select("page", (F.col("phrase_id") - 1).alias("label_id"), F.col("phrase_id").alias("amount_id"))
    chains = phrases.where("phrase_id % 24 = 2").select("page", F.col("phrase_id").alias("amount_id"), (F.col("phrase_id") + 8).alias("label_id"), (F.col("phrase_id") % 7 > 0).alias("closed"))
    return row_ops.apply_repair(claims, phrases, chains)[0]


@query("phrases")
def label_indent_clusters(phrases):
    shaped = phrases.where("observation <> 'money_candidate'").select("page", F.col("phrase_id").alias("id"), "x0", "y0", F.lit(5.0).alias("tolerance"))
    return geometry.running_median_clusters(shaped, "x0", ["x0", "y0", "id"], "tolerance")


@query("phrases")
def layout_region_filter(phrases):
    boxes = phrases.select("page", F.when(F.col("phrase_id") % 5 == 0, F.lit("header")).otherwise(F.lit("table")).alias("label"), (F.col("phrase_id") % 100 / 100.0).alias("score"), "x0", "y0", "x1", "y1")
    return regions.layout_regions(boxes, 144.0)


@query("tokens")
def money_or_year(tokens):
    return tokens.select("token_id", regions.is_money(F.when(F.col("token_id") % 4 == 0, F.concat(F.lit("20"), F.lpad("text", 2, "0"))).otherwise(F.col("text"))).alias("is_money"))


@query("phrases")
def cell_text_fill(phrases):
    cells = phrases.select("page", F.col("phrase_id").alias("cell_id"), "x0", "y0", (F.col("x0") + 90).alias("x1"), (F.col("y0") + 40).alias("y1"))
    return regions.cell_texts(cells, phrases.withColumnRenamed("phrase_id", "line_id"))


@query("tokens")
def grid_quality(tokens):
    return regions.grid_quality(tokens.select("page", F.col("y0").alias("row"), F.expr("cast(floor(x0 / 90) as bigint)").alias("col")))


@query("row_pages")
def zone_schema(pages):
    p = F.col("page")
    zones = pages.select("page", F.lit(0).alias("zone_id"), F.when(p % 11 == 0, F.lit("text")).when(p % 13 == 0, F.lit("figure")).otherwise(F.lit("table")).alias("label"), (p % 4).alias("n_roles"), F.when(p % 4 < 2, p % 6).otherwise(0).alias("n_money_columns"), (p % 9 == 0).alias("amount_header"), (p % 17 == 0).alias("year_or_unit"))
    return regions.zone_schemas(zones)


@query("labels")
def header_cues(labels):
    text = F.when(F.col("id") % 4 == 0, F.lit("Amount  (PhP)")).when(F.col("id") % 4 == 1, F.lit("FY 2027, Proposed")).when(F.col("id") % 4 == 2, F.lit("(in thousand pesos)")).otherwise(F.lit("amounts of 12027"))
    c = regions.header_cues(text)
    return labels.select("id", c["amount_header"].alias("amount_header"), c["year"].alias("year"), c["unit"].alias("unit"))


@query("labels")
def header_roles(labels):
    text = F.when(F.col("id") % 4 == 0, F.concat(F.lit("Personnel"), F.when(F.col("id") % 8 == 0, F.lit("  Services")).otherwise(F.lit("")))).when(F.col("id") % 4 == 1, F.lit("Capital Outlay, total")).when(F.col("id") % 4 == 2, F.lit("MOOE")).otherwise(F.lit("cost"))
    return labels.select("id", regions.header_role(text).alias("role"))


def _dual(tree):
    """Programmes hang on their office in print and on the root by code."""
    return tree.withColumns({"table_id": F.lit(1).cast("bigint"), "tier": F.length("kind").cast("bigint"), "parent_pdf": F.col("parent"), "parent_prexc": F.when(F.col("kind") == "program", F.lit("root")).otherwise(F.col("parent"))})


@query("tree", "amounts")
def csv_rows(tree, amounts):
    values = amounts.select(F.concat(F.lit("c"), F.expr("value div 64").cast("string")).alias("id"), F.when(F.col("value") % 2 == 0, F.lit("PS")).otherwise(F.lit("Total")).alias("role"), "value").groupBy("id", "role").agg(F.max("value").alias("value"))
    totals_of = values.where("role = 'Total'").select("id", "role", (F.col("value") + 1).alias("value"))
    return export.unit_csv_rows(export.slim_nodes(_dual(tree)), values, totals_of)


@query("tree", "labels")
def plan_csv_rows(tree, labels):
    """Labels read for stations and places, on the nodes of the customers of the same number."""
    read = anatomy.label_anatomy(labels).select(F.concat(F.lit("c"), "id").alias("id"), "chainages", "coordinates")
    amounts = tree.where("amount is not null").select("id", F.lit("AMOUNT (Php)").alias("role"), F.col("amount").alias("value"))
    out = export.plan_csv_rows(export.slim_nodes(_dual(tree)), amounts, amounts.limit(0), read)
    return out.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


@query("tree")
def tree_row_list(tree):
    expanded = tree.where("kind <> 'office' or page % 2 = 0").select("id")
    return hierarchy.row_list(_dual(tree), expanded, "parent_prexc")


@query("tree")
def tree_expand_ancestors(tree):
    return hierarchy.expand_ancestors(tree, tree.where("page = 7 and kind = 'activity'").select("id"))


@query("labels")
def station_chips(labels):
    return labels.select("id", export.station_chip(F.lit("K"), F.col("rank").cast("string"), F.when(F.col("id") % 2 == 0, F.lit("end"))).alias("chip"))


@query("findings")
def flag_messages(findings):
    code = F.when(F.col("seq") % 3 == 0, F.lit("continuation_merged")).when(F.col("seq") % 3 == 1, F.lit("weak_page_fit")).otherwise(F.col("code"))
    return findings.select("page", "seq", flags.severity(code, "unit").alias("severity"), flags.message(code, "unit").alias("message"))


def _page_lines(tokens):
    return tokens.groupBy("page", F.col("band_id").alias("line_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "token_id", "text"))), lambda t: t["text"]), " ").alias("text"))


@query("tokens")
def page_extracts(tokens):
    out = regions.page_extracts(tokens.withColumn("confidence", (F.col("token_id") % 64) / 64.0), _page_lines(tokens))
    say = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return out.select("page", "label", say("token_ids"), say("line_ids"), "n_tokens", "n_lines", "mean_confidence")


@query("tokens")
def zone_texts(tokens):
    lines = _page_lines(tokens)
    zones = lines.groupBy("page", (F.col("line_id") % 2).alias("zone_id")).agg(F.collect_list("line_id").alias("line_ids"))
    return regions.zone_texts(zones, lines)


@query("labels")
def label_previews(labels):
    return labels.select("id", lexical.preview(F.concat("label", F.lit(" "), "label")).alias("preview"))
