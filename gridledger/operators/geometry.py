"""Token geometry: gaps and phrases on bands, columns, indents, fits, label and amount pairs.

Windows and joins are keyed by (page, band) or page, which is the unit that data is partitioned by, so every
step after the first shuffle by page keeps its partitioning. Only the running-median clusterings, whose next
step depends on all earlier ones, run as one group a page.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.functions import lexical
from gridledger.operators.keys import by_document, key_type

# Fixed values of the geometry, in points unless named otherwise.
GAP_SPACES = 3.0
GAP_PT = 9.0
MARKER_GAP_PT = 9.0
COLUMN_SEARCH = 0.38
COLUMN_MEMBERS = 3
BASELINE_SHARE, BASELINE_LEAST, BASELINE_MOST = 0.22, 1.25, 3.0
DRIFT_LEAST_DY, DRIFT_MOST_DY, DRIFT_MOST_DX, DRIFT_MOST = 8.0, 120.0, 12.0, 0.05
LABEL_AMOUNT_GAP = 40.0


# ---- statistics ------------------------------------------------------------------------------------------
def median_mad(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, n, median, mad: exact medians, the deviation from the group's own median."""
    w = Window.partitionBy(key)
    centred = rows.withColumn("_m", F.median(value).over(w))
    return centred.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first("_m").alias("median"), F.median(F.abs(F.col(value) - F.col("_m"))).alias("mad"))


def line_fit(rows: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """key, slope, intercept by least squares; one point or no spread in x has slope 0 through the mean of y."""
    n, mx, my = F.count(F.lit(1)), F.avg(x), F.avg(y)
    spread = F.sum(F.col(x) * F.col(x)) - n * mx * mx
    product = F.sum(F.col(x) * F.col(y)) - n * mx * my
    slope = F.when((n < 2) | (F.abs(spread) < 1e-9), F.lit(0.0)).otherwise(product / spread)
    return rows.groupBy(key).agg(slope.alias("slope"), (my - slope * mx).alias("intercept"))


def column_drift(edges: DataFrame, key: list[str], x: str = "x", y: str = "y", order: str = "id") -> DataFrame:
    """key, drift: median dx/dy over all pairs of a column that are 8 to 120 points apart and shift at most 12.

    A pair is met once, by order of id; pairs are bounded by the rows of a column of one page.
    """
    a, b = edges.alias("a"), edges.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
    dy, dx = F.col(f"b.{y}") - F.col(f"a.{y}"), F.col(f"b.{x}") - F.col(f"a.{x}")
    near = F.abs(dy).between(DRIFT_LEAST_DY, DRIFT_MOST_DY) & (F.abs(dx) <= DRIFT_MOST_DX) & (F.col(f"a.{order}") < F.col(f"b.{order}"))
    condition = near
    for c in same:
        condition = condition & c
    drift = a.join(b, condition).groupBy(*[F.col(f"a.{k}").alias(k) for k in key]).agg(F.median(dx / dy).alias("d"))
    return edges.select(*key).distinct().join(drift, key, "left").select(*key, F.when(F.abs("d") <= DRIFT_MOST, F.col("d")).otherwise(F.lit(0.0)).alias("drift"))


@by_document("page")
def baseline_tolerance(tokens: DataFrame) -> DataFrame:
    """page, tolerance of baselines: a share of the median height, within bounds."""
    height = F.coalesce(F.median(F.col("y1") - F.col("y0")), F.lit(8.0))
    return tokens.groupBy("page").agg(F.greatest(F.lit(BASELINE_LEAST), F.least(F.lit(BASELINE_MOST), BASELINE_SHARE * height)).alias("tolerance"))


# ---- gaps and phrases ------------------------------------------------------------------------------------
def usable(tokens: DataFrame, chrome: Column | None = None) -> DataFrame:
    """Tokens with a box and text that aren't page furniture."""
    kept = tokens.where(F.col("x0").isNotNull() & F.col("y0").isNotNull() & (lexical.clean(F.col("text")) != ""))
    return kept.where(~F.coalesce(chrome, F.lit(False))) if chrome is not None else kept


def _split_tokens(tokens: DataFrame, char_width: Column) -> DataFrame:
    """tokens with gap (to the token before on the band), spaces (the gap in character widths) and reason: why a phrase
    starts at the token, null if none does.

    Of several reasons the last of these stands: a wide gap; a programme code at the band's left, before the second token;
    a currency sign whose tokens up to the next sign are a whole amount; a marker of one or two tokens at the band's
    left that stands apart from the label, be it by its box or by the width that its signs should have.
    """
    key = ["page", "band_id"]
    band = Window.partitionBy(*key).orderBy("x0", "token_id")
    rows = tokens.withColumns({"_w": char_width, "_n": F.row_number().over(band), "_t": F.regexp_replace("text", r"(?U)\s", "")})
    rows = rows.withColumns({"gap": F.col("x0") - F.lag("x1").over(band), "_sign": F.col("_t").rlike(lexical.CURRENCY_START).cast("int")})
    rows = rows.withColumns({"spaces": F.col("gap") / F.greatest(F.col("_w"), F.lit(0.01)), "_run": F.sum("_sign").over(band)})
    run = Window.partitionBy(*key, "_run").orderBy("x0", "token_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_amount", F.concat_ws("", F.collect_list("_t").over(run)))
    one, two = F.lag("_t").over(band), F.concat(F.lag("_t", 2).over(band), F.lag("_t").over(band))
    lead = F.when((F.col("_n") == 2) & one.rlike(lexical.MARKER), one).when((F.col("_n") == 3) & two.rlike(lexical.MARKER), two)
    counted = F.col("x0") - F.first("x0").over(band) - F.length(lead) * F.col("_w")
    reason = F.coalesce(
        F.when(lead.isNotNull() & (F.greatest("gap", counted) >= MARKER_GAP_PT), F.when(counted > F.col("gap"), F.lit("marker_compensated_gap")).otherwise(F.lit("marker_raw_gap"))),
        F.when((F.col("_n") > 1) & (F.col("_sign") == 1) & F.col("_amount").rlike(lexical.CURRENCY), F.lit("currency_prefix_boundary")),
        F.when((F.col("_n") == 2) & one.rlike(lexical.PROGRAM_CODE), F.lit("program_code_boundary")),
        F.when((F.col("gap") >= GAP_PT) & (F.col("spaces") >= GAP_SPACES), F.lit("gap_spaces")),
    )
    return rows.withColumn("reason", reason).drop("_w", "_n", "_t", "_sign", "_run", "_amount")


@by_document("page")
def token_gaps(tokens: DataFrame, char_width: Column) -> DataFrame:
    """page, band_id, gap_id, left_token_id, right_token_id, gap_pt, spaces, split, reason (null: no split) of neighbours on a band."""
    band = Window.partitionBy("page", "band_id").orderBy("x0", "token_id")
    rows = _split_tokens(tokens, char_width).withColumn("left_token_id", F.lag("token_id").over(band)).where(F.col("left_token_id").isNotNull())
    ids = Window.partitionBy("page").orderBy("band_id", "x0", "token_id")
    return rows.select(
        "page", "band_id", (F.row_number().over(ids) - 1).cast("bigint").alias("gap_id"), "left_token_id", F.col("token_id").alias("right_token_id"), F.round("gap", 3).alias("gap_pt"), F.round("spaces", 3).alias("spaces"),
        F.col("reason").isNotNull().alias("split"), "reason",
    )


@by_document("page")
def phrase_ordinals(tokens: DataFrame, char_width: Column) -> DataFrame:
    """tokens with ordinal, the number of their phrase on its band: a running sum of the places where a phrase starts."""
    band = Window.partitionBy("page", "band_id").orderBy("x0", "token_id")
    marked = _split_tokens(tokens, char_width)
    return marked.withColumn("ordinal", F.sum(F.col("reason").isNotNull().cast("int")).over(band).cast("bigint")).drop("gap", "spaces", "reason")


@by_document("page")
def phrases(tokens: DataFrame, char_width: Column) -> DataFrame:
    """page, band_id, phrase_id, text, x0, y0, x1, y1, token_ids, observation of contiguous tokens."""
    grouped = (
        phrase_ordinals(tokens, char_width)
        .groupBy("page", "band_id", "ordinal")
        .agg(
            F.array_sort(F.collect_list(F.struct("x0", "token_id", "text"))).alias("t"),
            F.round(F.min("x0"), 2).alias("x0"), F.round(F.min("y0"), 2).alias("y0"), F.round(F.max("x1"), 2).alias("x1"), F.round(F.max("y1"), 2).alias("y1"),
        )
    )
    ids = Window.partitionBy("page").orderBy("band_id", "ordinal")
    text = lexical.joined(F.col("t.text"))
    return grouped.select("page", "band_id", (F.row_number().over(ids) - 1).cast("bigint").alias("phrase_id"), text.alias("text"), "x0", "y0", "x1", "y1", F.col("t.token_id").alias("token_ids"), lexical.observation(text).alias("observation"))


# ---- columns, indents, pairs -----------------------------------------------------------------------------
@by_document("page")
def money_window(phrases: DataFrame, width: Column) -> DataFrame:
    """Amounts of at least four digits whose right edge lies in the right part of the page."""
    money = phrases.where((F.col("observation") == "money_candidate") & (F.length(F.regexp_replace("text", r"\D", "")) >= 4))
    furthest = F.max("x1").over(Window.partitionBy("page"))
    return money.withColumn("_r", furthest).where(F.col("x1") >= F.col("_r") - COLUMN_SEARCH * width).drop("_r")


class RunningMedians:
    """Groups of numbers whose centres are the medians of their members so far.

    Members are kept sorted, and so are the centres, so a number finds the nearest one by bisection.
    """

    def __init__(self) -> None:
        self.members: list[list[float]] = []
        self.centres: list[float] = []
        self._order: list[tuple[float, int]] = []

    def add(self, value: float, tolerance: float) -> int:
        """The group that value joins: the nearest within tolerance, the oldest of equally near ones, else a new one."""
        at = bisect_left(self._order, (value, -1))
        near = []
        if at < len(self._order):
            near.append(self._order[at])
        if at:  # of equal centres below the first is the oldest
            near.append(self._order[bisect_left(self._order, (self._order[at - 1][0], -1))])
        best = min(((abs(value - c), k) for c, k in near if abs(value - c) <= tolerance), default=None)
        if best is None:
            k = len(self.centres)
            self.members.append([])
            self.centres.append(value)
        else:
            k = best[1]
            del self._order[bisect_left(self._order, (self.centres[k], k))]
        m = self.members[k]
        insort(m, value)
        h = len(m) // 2
        self.centres[k] = m[h] if len(m) % 2 else (m[h - 1] + m[h]) / 2
        insort(self._order, (self.centres[k], k))
        return k


@by_document("page")
def running_median_clusters(rows: DataFrame, value: str, order: list[str], tolerance: str, schema_key: str = "page", id_column: str = "id") -> DataFrame:
    """key, id, cluster, centre: each value joins the nearest cluster within tolerance (of equally near ones the
    oldest), whose centre is the median of its members so far, or starts one. Sequential by nature: one group a key."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        medians = RunningMedians()
        found = [medians.add(float(v), float(t)) for v, t in zip(pdf[value], pdf[tolerance])]
        return pd.DataFrame({schema_key: pdf[schema_key], "id": pdf[id_column], "cluster": found, "centre": [float(medians.centres[k]) for k in found]})

    rows = rows.select(*dict.fromkeys([schema_key, id_column, value, tolerance, *order]))
    return rows.groupBy(schema_key).applyInPandas(group, f"{schema_key} {key_type(rows, schema_key)}, id bigint, cluster bigint, centre double")


@by_document("page")
def column_summary(members: DataFrame) -> DataFrame:
    """page, column_id, n_phrases, right_x, right_mad, left_x, recurring of clustered amounts."""
    keyed = members.withColumn("_k", F.struct("page", "column_id"))
    stats = median_mad(keyed, "_k", "x1").select(F.col("_k.page").alias("page"), F.col("_k.column_id").alias("column_id"), F.col("n").alias("n_phrases"), F.round("median", 2).alias("right_x"), F.round("mad", 2).alias("right_mad"))
    left = members.groupBy("page", "column_id").agg(F.min("x0").alias("left_x"))
    return stats.join(left, ["page", "column_id"]).withColumn("recurring", F.col("n_phrases") >= COLUMN_MEMBERS)


@by_document("page")
def reference_anchor(columns: DataFrame) -> DataFrame:
    """page, reference_x, support: the rightmost recurring column, else the rightmost."""
    best = F.max_by(F.struct("right_x", "recurring"), F.struct("recurring", "right_x")).alias("b")
    return columns.groupBy("page").agg(best).select("page", F.col("b.right_x").alias("reference_x"), F.when(F.col("b.recurring"), F.lit("recurring")).otherwise(F.lit("singleton")).alias("support"))


@by_document("page")
def label_amount_pairs(phrases: DataFrame) -> DataFrame:
    """page, band_id, label_id, amount_ids: the leftmost text that ends before a band's first amount claims all its amounts."""
    amounts = phrases.where("observation = 'money_candidate'").groupBy("page", "band_id").agg(F.min("x0").alias("first_x"), F.array_sort(F.collect_list("phrase_id")).alias("amount_ids"))
    labels = phrases.where("observation in ('text_candidate', 'mixed_candidate')").join(amounts, ["page", "band_id"]).where("x1 <= first_x")
    return labels.groupBy("page", "band_id").agg(F.min_by("phrase_id", F.struct("x0", "phrase_id")).alias("label_id"), F.first("amount_ids").alias("amount_ids"))


@by_document("page")
def separators(phrases: DataFrame) -> DataFrame:
    """page, band_id, amount_id, label_id, x, gap: for each amount the text whose right edge is nearest on its left."""
    amounts = phrases.where("observation = 'money_candidate'").select("page", "band_id", F.col("phrase_id").alias("amount_id"), F.col("x0").alias("amount_x"))
    labels = phrases.where("observation in ('text_candidate', 'mixed_candidate')").select("page", "band_id", F.col("phrase_id").alias("p"), F.col("x1").alias("label_x"))
    best = amounts.join(labels, ["page", "band_id"]).where("label_x <= amount_x").groupBy("page", "band_id", "amount_id", "amount_x").agg(F.max_by(F.struct("p", "label_x"), F.struct("label_x", F.col("p"))).alias("b"))
    return best.select("page", "band_id", "amount_id", F.col("b.p").alias("label_id"), F.round((F.col("b.label_x") + F.col("amount_x")) / 2, 2).alias("x"), F.round(F.col("amount_x") - F.col("b.label_x"), 2).alias("gap"))


@by_document("page")
def alignment_fits(phrases: DataFrame, columns: DataFrame) -> DataFrame:
    """page, column_id, n_pairs, slope, slope_mad, review: how bottoms rise from the leftmost text left of an amount on its
    band to the amount, between their middles, where these are at least 40 points apart; fewer than three pairs are
    for review, and a column without pairs has slope 0. Markers, codes and other amounts are no such text.

    columns: page, column_id, phrase_id of clustered amounts.
    """
    middle = (F.col("x0") + F.col("x1")) / 2
    amounts = phrases.join(columns, ["page", "phrase_id"]).select("page", "band_id", "column_id", middle.alias("ax"), F.col("y1").alias("ay"), F.col("x0").alias("ax0"), F.col("phrase_id").alias("amount_id"))
    peers = phrases.where("observation in ('text_candidate', 'mixed_candidate')").select("page", "band_id", F.col("phrase_id").alias("peer"), F.col("x0").alias("px0"), middle.alias("px"), F.col("x1").alias("px1"), F.col("y1").alias("py"))
    pairs = amounts.join(peers, ["page", "band_id"]).where("px1 < ax0").groupBy("page", "column_id", "amount_id", "ax", "ay").agg(F.min_by(F.struct("px", "py"), F.struct("px0", "peer")).alias("p"))
    apart = pairs.where(F.col("ax") - F.col("p.px") >= LABEL_AMOUNT_GAP)
    slopes = apart.select(F.struct("page", "column_id").alias("k"), ((F.col("ay") - F.col("p.py")) / (F.col("ax") - F.col("p.px"))).alias("slope"))
    fits = median_mad(slopes, "k", "slope").select("k.page", "k.column_id", "n", "median", "mad")
    every = columns.select("page", "column_id").distinct().join(fits, ["page", "column_id"], "left")
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return every.select("page", "column_id", n.alias("n_pairs"), F.coalesce("median", F.lit(0.0)).alias("slope"), F.coalesce("mad", F.lit(0.0)).alias("slope_mad"), (n < COLUMN_MEMBERS).alias("review"))


# ---- drift of a page's columns ---------------------------------------------------------------------------
def _middle_y() -> Column:
    return (F.col("y0") + F.col("y1")) / 2


@by_document("page")
def page_drift(money: DataFrame) -> DataFrame:
    """page, drift: how far right edges shift with height, from all near pairs of a page's amounts."""
    return column_drift(money.select("page", F.col("phrase_id").alias("id"), F.col("x1").alias("x"), _middle_y().alias("y")), ["page"])


@by_document("page")
def without_drift(phrases: DataFrame, drifts: DataFrame, page_height: Column) -> DataFrame:
    """phrases with left_x and right_x as they would be at the page's middle height, and drift."""
    shift = F.col("drift") * (_middle_y() - page_height / 2)
    out = phrases.join(drifts.select("page", "drift"), "page", "left").withColumn("drift", F.coalesce("drift", F.lit(0.0)))
    return out.withColumns({"left_x": F.col("x0") - shift, "right_x": F.col("x1") - shift})


@by_document("page")
def anchored_columns(members: DataFrame, tolerance: Column, page_height: Column) -> DataFrame:
    """page, column_id, n_phrases, right_x, right_mad, raw_right_x, amount_left_x, top, bottom, right_top, right_bottom,
    left_top, left_bottom, context_confidence, recurring of clustered amounts as without_drift() gives them.

    right_top to left_bottom: where the column's slanted edges are at its top and bottom. The confidence that its members are
    amounts grows with their number, up to three, and falls with the spread of their edges.
    """
    w = Window.partitionBy("page", "column_id")
    rows = members.withColumns({"_t": tolerance, "_h": page_height, "_m": F.median("right_x").over(w)})
    g = rows.groupBy("page", "column_id").agg(
        F.count(F.lit(1)).alias("n_phrases"), F.first("_m").alias("right"), F.median(F.abs(F.col("right_x") - F.col("_m"))).alias("mad"), F.median("x1").alias("raw"), F.min("left_x").alias("left"),
        F.min("y0").alias("top"), F.max("y1").alias("bottom"), F.first("drift").alias("drift"), F.first("_t").alias("_t"), F.first("_h").alias("_h"),
    )
    at = lambda x, y: F.round(F.col(x) + F.col("drift") * (F.col(y) - F.col("_h") / 2), 2)
    context = F.least(F.lit(1.0), F.col("n_phrases") / COLUMN_MEMBERS) * F.greatest(F.lit(0.0), 1 - F.col("mad") / F.col("_t"))
    return g.select(
        "page", "column_id", "n_phrases", F.round("right", 3).alias("right_x"), F.round("mad", 3).alias("right_mad"), F.round("raw", 3).alias("raw_right_x"), F.round("left", 3).alias("amount_left_x"), F.round("top", 2).alias("top"), F.round("bottom", 2).alias("bottom"),
        at("right", "top").alias("right_top"), at("right", "bottom").alias("right_bottom"), at("left", "top").alias("left_top"), at("left", "bottom").alias("left_bottom"), F.round(context, 3).alias("context_confidence"), (F.col("n_phrases") >= COLUMN_MEMBERS).alias("recurring"),
    )


@by_document("page")
def relative_anchors(phrases: DataFrame, anchors: DataFrame) -> DataFrame:
    """page, phrase_id, edge, corrected_x, distance of phrases as without_drift() gives them: amounts by their right edge, texts by
    their left one, and how far that lies left of the page's anchor (null without one). Markers and codes have none."""
    rows = phrases.where("observation not in ('marker_candidate', 'code_candidate')").join(anchors.select("page", "reference_x"), "page", "left")
    amount = F.col("observation") == "money_candidate"
    x = F.when(amount, F.col("right_x")).otherwise(F.col("left_x"))
    return rows.select("page", "phrase_id", F.when(amount, F.lit("right")).otherwise(F.lit("left")).alias("edge"), F.round(x, 3).alias("corrected_x"), F.round(F.col("reference_x") - x, 3).alias("distance"))
