"""The document-table operators on small cases with known results, and on random cases against plain Python."""

import random
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridledger.functions import codes, lexical
from gridledger.operators import anatomy, bands, export, geometry, hierarchy, regions, sections, totals
from gridledger.sources import documents, specs


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def texts(spark, f, cases):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string").select("i", f(F.col("t")).alias("x")).orderBy("i").collect()
    return [r.x for r in rows]


# ---- text
def test_observation(spark):
    cases = {"a.": "marker_candidate", "12)": "marker_candidate", "310101100238000": "code_candidate", "P 12,345": "money_candidate", "php1,000.50": "money_candidate", "12,345,000": "money_candidate", "12": "money_candidate", "A-12": "mixed_candidate", "Road": "text_candidate", "(12)": "text_candidate", "": "text_candidate"}
    assert texts(spark, lexical.observation, cases) == list(cases.values())
    assert texts(spark, lexical.observation_confidence, ["a.", "12", "x", "12,345"]) == [1.0, 0.45, 0.0, 1.0]


def test_amounts_lose_sign_and_point(spark):
    assert texts(spark, lexical.amount, ["(1,000)", "1,000.50", "12, 345", "x", "", None]) == [1000, 100050, 12345, None, None, None]
    assert one(spark, lexical.read_amount(F.lit(12.0), F.lit("99"))) == 12
    assert one(spark, lexical.read_amount(F.lit(12.5), F.lit("99"))) == 99


def test_joined(spark):
    parts = lambda *p: F.array(*[F.lit(x) for x in p])
    assert one(spark, lexical.joined(parts("Road", "(", "North", ")", ",", "12", "%", ""))) == "Road (North), 12%"


def test_labels(spark):
    assert texts(spark, lexical.normalize_label, ["A.1 Region(s) of", "a.  Regional Office/s", "  X  y", "Plain"]) == ["region of", "regional office s", "x y", "plain"]
    assert texts(spark, lexical.clean, ["a  \n b", None]) == ["a b", ""]
    assert texts(spark, lambda c: lexical.plan_kind(c, F.lit(2)), ["CAPITAL OUTLAYS", "OPERATIONS", "ORGANIZATIONAL OUTCOME 1", "Region IV-A", "Central Office", "Roads PROGRAM", "x"]) == ["expense_class", "section", "outcome", "region", "office", "program", "group"]
    assert texts(spark, lambda c: lexical.plan_kind(c, F.lit(7)), ["Roads PROGRAM"]) == ["project"]
    assert texts(spark, lexical.is_subtotal, ["Sub-total, x", "Sub total", "Subtotals", "Total"]) == [True, True, False, False]
    assert texts(spark, lexical.is_funding, ["GOP", "loan proceeds", "GOP x"]) == [True, True, False]
    assert texts(spark, lexical.slug, ["By OU / 2027!", "--"]) == ["by-ou-2027", ""]
    assert texts(spark, lambda c: lexical.marker(F.array(F.lit("x"), F.lit("b.")), c), ["1. z"]) == ["b."]
    assert texts(spark, lambda c: lexical.marker(F.array().cast("array<string>"), c), ["1. z", "z"]) == ["1.", None]


def test_degrees(spark):
    assert one(spark, lexical.dms(F.lit(11.0), F.lit(46.0), F.lit(32.0), F.lit("N"))) == pytest.approx(11.775555555)
    assert one(spark, lexical.dms(F.lit(11.0), F.lit(60.0), F.lit(0.0), F.lit("N"))) is None
    assert tuple(one(spark, lexical.latitude_first(F.lit(123.8), F.lit(7.98)))) == (7.98, 123.8, True)


# ---- codes
def test_codes(spark):
    code = "310101100238000"
    assert tuple(one(spark, codes.split(F.lit(code)))) == ("3", "10", "10", "1", "1", "00238", "000")
    assert one(spark, codes.ancestors(F.lit(code))) == ["300000000000000", "310000000000000", "310100000000000", "310101000000000", "310101100000000"][:5]
    assert one(spark, codes.ancestors(F.lit("123"))) is None
    assert texts(spark, codes.is_project, ["310101200238000", code, None]) == [True, False, False]
    assert texts(spark, codes.shell_kind, ["300000000000000", "310000000000000", "310100000000000", "310101000000000", "310101100000000", "310101110000000"]) == ["prexc_cost", "prexc_oo", "prexc_program", "prexc_subprogram", "prexc_identifier", "prexc_shell"]


def test_code_parents_and_shells(spark):
    rows = [(1, 1, "pro", "root", "310101000000000"), (1, 2, "act", "pro0", "310101100238000"), (1, 3, "note", "act", None), (1, 4, "far", "root", "120000000000001"), (1, 5, "pro2", "root", "310101000000000")]
    nodes = spark.createDataFrame(rows, "table_id bigint, doc_pos bigint, id string, parent string, code string")
    out = {r.id: r for r in codes.dual_hierarchy(nodes).collect()}
    assert (out["act"].parent_prexc, out["act"].parent) == ("pro2", "prexc:310101100000000")
    assert out["note"].parent == "act" and out["far"].parent_prexc == "root" and out["far"].parent == "prexc:120000000000000"
    shells = {r.code: r.parent for r in codes.shells(nodes).collect()}
    assert shells["310101100000000"] == "pro2" and shells["310000000000000"] == "prexc:300000000000000" and shells["300000000000000"] == "root"


# ---- geometry
def tokens(spark, rows):
    return spark.createDataFrame([(1, b, i, t, float(x0), float(x1), 100.0 + b, 108.0 + b) for i, (b, t, x0, x1) in enumerate(rows)], "page bigint, band_id bigint, token_id bigint, text string, x0 double, x1 double, y0 double, y1 double")


def test_phrases(spark):
    row = [(0, "a", 10, 14), (0, ".", 14, 16), (0, "Infrastructure", 40, 110), (0, "Planning", 114, 150), (0, "12,345,000", 300, 350)]
    out = geometry.phrases(tokens(spark, row), F.lit(5.0)).orderBy("phrase_id").collect()
    assert [(r.text, r.observation) for r in out] == [("a.", "marker_candidate"), ("Infrastructure Planning", "text_candidate"), ("12,345,000", "money_candidate")]
    code = geometry.phrases(tokens(spark, [(0, "310101100238000", 10, 85), (0, "Road", 88, 108)]), F.lit(5.0)).orderBy("phrase_id").collect()
    assert [r.text for r in code] == ["310101100238000", "Road"]


def split(spark, row, width=5.0):
    t = tokens(spark, row)
    texts = [r.text for r in geometry.phrases(t, F.lit(width)).orderBy("phrase_id").collect()]
    return texts, [r.reason for r in geometry.token_gaps(t, F.lit(width)).orderBy("gap_id").collect()]


def test_why_phrases_split(spark):
    currency = [(0, "TOTAL", 40, 80), (0, "P", 280, 282), (0, "14", 289, 297), (0, ",", 299, 301), (0, "922", 304, 316), (0, "P603", 324, 340), (0, ",", 343, 345), (0, "000", 348, 360)]
    assert split(spark, currency) == (["TOTAL", "P 14, 922", "P603, 000"], ["currency_prefix_boundary", None, None, None, "currency_prefix_boundary", None, None])
    assert split(spark, [(0, "Rent", 10, 30), (0, "P", 33, 38), (0, "1,234", 40, 65)]) == (["Rent", "P 1,234"], ["currency_prefix_boundary", None])
    assert split(spark, [(0, "Phase", 10, 30), (0, "P", 33, 38), (0, "one", 40, 55)]) == (["Phase P one"], [None, None])  # a letter is no currency
    assert split(spark, [(0, "P1", 10, 20), (0, "and", 22, 30), (0, "PHP5", 33, 50)]) == (["P1 and", "PHP5"], [None, "currency_prefix_boundary"])
    # A marker whose full stop has too wide a box, from its left edge and its signs.
    assert split(spark, [(0, "1", 181.08, 182.52), (0, ".", 185.4, 192.6), (0, "Preventive", 199.8, 237.24)], 3.74) == (["1.", "Preventive"], [None, "marker_compensated_gap"])
    assert split(spark, [(0, "12", 10, 20), (0, ")", 20, 24), (0, "Roads", 34, 60)]) == (["12)", "Roads"], [None, "marker_raw_gap"])
    assert split(spark, [(0, "a.", 10, 20), (0, "Roads", 28, 60)]) == (["a. Roads"], [None])
    assert split(spark, [(0, "Alpha", 10, 30), (0, "Beta", 38, 54)], 4.0) == (["Alpha Beta"], [None])
    assert split(spark, [(0, "1" + "0" * 14, 131.4, 190.8), (0, "General", 201.24, 226.44), (0, "Administration", 236.16, 290.52)]) == (["1" + "0" * 14, "General Administration"], ["program_code_boundary", None])


def plain_medians(values, tolerance):
    """Each value to the nearest running median within tolerance, the oldest of equals."""
    members, centres, out = [], [], []
    for v in values:
        near = [(abs(v - c), k) for k, c in enumerate(centres) if abs(v - c) <= tolerance]
        k = min(near)[1] if near else len(members)
        if not near:
            members.append([])
            centres.append(v)
        members[k].append(v)
        centres[k] = statistics.median(members[k])
        out.append((k, centres[k]))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=40), st.integers(1, 6))
def test_running_medians_as_plainly(values, tolerance):
    medians = geometry.RunningMedians()
    got = []
    for v in values:
        k = medians.add(float(v), tolerance)
        got.append((k, medians.centres[k]))
    assert got == plain_medians(values, tolerance)


def test_votes_on_a_slope():
    import numpy as np

    x = np.tile(np.arange(5) * 100.0, 6)
    slopes = [0.004, 0.004, 0.004, 0.0045, 0.0035, 0.02 + 0.001]
    y = np.repeat(np.arange(6) * 50.0, 5) + x * np.repeat(slopes, 5)
    found = bands.consensus([bands.Band(list(range(5 * k, 5 * k + 5)), 0.0) for k in range(6)], x, y, 150.0, 2.0)
    # The last band is too steep to vote; the others agree, with a spread of nothing.
    assert found.accepted and found.value == pytest.approx(0.004) and found.confidence == pytest.approx(5 / 6)
    spread = bands.consensus([bands.Band(list(range(5 * k, 5 * k + 5)), 0.0) for k in range(3)], x, y + x * np.repeat([0.001, 0, -0.001, 0, 0, 0], 5), 150.0, 2.0)
    assert spread.confidence == pytest.approx(3 / 6 * (1 - 0.001 / 0.0025))
    assert not bands.consensus([bands.Band([0, 1, 2, 3, 4], 0.0)], x, y, 150.0, 2.0).accepted and not bands.consensus([], x, y, 150.0, 2.0).accepted


def test_halves_of_a_row_merge():
    import numpy as np

    def join(right, rise):
        box = np.array([[40, 92, 90, 100], [95, 92, 140, 100], [right, 92 + rise, right + 40, 100 + rise], [40, 112, 90, 120]], float)
        x, y = (box[:, 0] + box[:, 2]) / 2, box[:, 3]
        made = [bands.Band([0, 1], 100.0), bands.Band([2], 100.0 + rise), bands.Band([3], 120.0)]
        return [sorted(b.rows) for b in bands.reconciled(made, box, x, y, 2.0, 360.0)]

    assert join(400, 3.0) == [[0, 1, 2], [3]]
    assert join(400, 12.0) == [[0, 1], [2], [3]]  # too steep
    assert join(180, 1.0) == [[0, 1], [2], [3]]  # too near
    assert join(130, 0.5) == [[0, 1], [2], [3]]  # one lies over the other


def test_columns_and_pairs(spark):
    rows = [(1, b, 2 * b, "Label", "text_candidate", 100.0, 140.0, 20.0 * b, 20.0 * b + 8) for b in range(3)] + [(1, b, 2 * b + 1, "1,000", "money_candidate", 500.0, 560.0, 20.0 * b, 20.0 * b + 8) for b in range(3)]
    p = spark.createDataFrame(rows, "page bigint, band_id bigint, phrase_id bigint, text string, observation string, x0 double, x1 double, y0 double, y1 double")
    money = p.where("observation = 'money_candidate'").withColumn("column_id", F.lit(0).cast("bigint"))
    c = geometry.column_summary(money).first()
    assert (c.n_phrases, c.right_x, c.right_mad, c.left_x, c.recurring) == (3, 560.0, 0.0, 500.0, True)
    assert [(r.label_id, r.amount_ids) for r in geometry.label_amount_pairs(p).orderBy("band_id").collect()] == [(0, [1]), (2, [3]), (4, [5])]
    f = geometry.alignment_fits(p, money.select("page", "phrase_id", "column_id")).first()
    assert (f.n_pairs, f.slope, f.review) == (3, 0.0, False)
    assert geometry.reference_anchor(geometry.column_summary(money)).first().support == "recurring"


def test_running_median_clusters(spark):
    rows = [(1, i, x, 6.0) for i, x in enumerate([440.0, 441.0, 560.0, 558.0, 445.0])]
    out = geometry.running_median_clusters(spark.createDataFrame(rows, "page bigint, id bigint, x double, tolerance double"), "x", ["x", "id"], "tolerance")
    assert {r.id: r.cluster for r in out.collect()} == {0: 0, 1: 0, 4: 0, 2: 1, 3: 1}


def test_bands_follow_a_slope_and_keep_rows_apart(spark):
    rng = random.Random(1)
    rows = []
    for line in range(8):
        for k in range(8):
            x = 40.0 + 80 * k
            y = 100 + 14 * line + 0.012 * x
            rows.append((1, line * 8 + k, x, y - 8, x + 40, y + rng.uniform(-0.1, 0.1)))
    out = bands.baseline_bands(spark.createDataFrame(rows, "page bigint, token_id bigint, x0 double, y0 double, x1 double, y1 double")).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.band_id, set()).add(r.token_id // 8)
    assert len(out) == 64 and all(len(g) == 1 for g in groups.values()) and len(groups) == 8


def items(spark, labels, amounts):
    rows = [(1, i, "label", y0, y0 + 8, None) for i, y0 in labels] + [(1, i, "amount", y0, y0 + 8, c) for i, y0, c in amounts]
    return spark.createDataFrame(rows, "page bigint, item_id bigint, role string, y0 double, y1 double, claimed_by bigint")


def test_repair(spark):
    run = lambda *a: bands.chain_repair(items(spark, *a)).collect()
    above = [(10 + i, 100.0 * i + 96, i) for i in range(1, 4)]
    labels = [(i, 100.0 * i + 100) for i in range(1, 4)]
    assert [r.reason for r in run(labels, above)] == ["no_orphans"]
    assert [r.reason for r in run(labels, [(10 + i, 100.0 * i + 103, i) for i in range(1, 4)] + [(20, 500.0, None)])] == ["amounts_not_above_labels_convention"]
    # an orphan above a label whose own amount stands below it: both move down one label
    chain = run(labels + [(5, 505.0), (6, 520.0)], above + [(30, 492.0, None), (31, 509.0, 5)])
    assert [(r.amount_id, r.label_id, r.closed) for r in sorted(chain, key=lambda r: r.step)] == [(30, 5, True), (31, 6, True)]
    open_chain = run(labels, above + [(30, 900.0, None)])
    assert [(r.closed, r.reason) for r in open_chain] == [(False, "no_closed_chains")]


# ---- sections
def test_rows_wrap_both_ways(spark):
    b = spark.createDataFrame([(1, 10.0, 2, 7), (1, 30.0, 5, 8)], "page bigint, y double, band_id bigint, label_id bigint")
    p = spark.createDataFrame([(1, i, i) for i in range(8)], "page bigint, phrase_id bigint, band_id bigint")
    down = {r.phrase_id: r.row_id for r in sections.in_row(p, sections.row_bounds(b, True), True).collect()}
    up = {r.phrase_id: r.row_id for r in sections.in_row(p, sections.row_bounds(b, False), False).collect()}
    assert down == {2: 0, 3: 0, 4: 0, 5: 1, 6: 1, 7: 1} and up == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1}


def test_crossing(spark):
    at = one(spark, sections.crossing(*[F.lit(float(v)) for v in (0, 0, 10, 10, 0, 10, 10, 0)]))
    assert tuple(at) == (5.0, 5.0)
    with pytest.raises(Exception, match="parallel"):
        one(spark, sections.crossing(*[F.lit(float(v)) for v in (0, 0, 1, 0, 0, 1, 1, 1)]))


# ---- hierarchy
def fold(rows):
    """The stack as it is told: pop what ranks no less, the top is the parent."""
    stack, out = [], {}
    for pos, own, stored, attached, expense in rows:
        if attached:
            out[pos] = stack[-1][1] if stack else "root"
            continue
        while stack and stack[-1][0] >= own:
            stack.pop()
        out[pos] = "root" if expense or not stack else stack[-1][1]
        if expense:
            stack = []
        stack.append((stored, f"r{pos}"))
    return out


def test_stack_parents_are_the_fold(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for table in range(60):
        told = []
        for pos in range(40):
            rank, marked, expense, attached = rng.randrange(8), rng.random() < 0.4, rng.random() < 0.03, rng.random() < 0.1
            top = rank == 0 and rng.random() < 0.4
            attached = attached and not expense and not top
            own = -1.0 if expense else 0.0 if top else 0.5 if rank == 0 and marked else float(rank)
            stored = 0.5 if top and marked and rank == 0 and not expense else own
            told.append((pos, own, stored, attached, expense))
            rows.append((table, pos, f"r{pos}", rank, expense, top, marked, attached))
        want |= {(table, f"r{pos}"): parent for pos, parent in fold(told).items()}
    df = spark.createDataFrame(rows, "table_id bigint, doc_pos bigint, id string, rank int, expense boolean, top_section boolean, marked boolean, attached boolean")
    got = {(r.table_id, r.id): r.parent for r in hierarchy.stack_parents(df, ["table_id"]).collect()}
    assert got == want


def test_unit_parents(spark):
    a, b = "310101", "320202"
    rows = [("s", "section", None, 0, "A"), ("p", "program", a + "000000000", 0, None), ("x", "activity", a + "100001000", 0, None), ("r", "region", None, 0, None), ("o", "office", None, 0, None), ("f", "funding", None, 0, None), ("r2", "region", None, 0, None), ("q", "program", b + "000000000", 0, None), ("y", "activity", a + "100002000", 0, None), ("z", "activity", "990000100002000", 1, None), ("g", "grand_total", None, 1, None), ("u", "subsection", None, 1, "A")]
    df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "table_id bigint, doc_pos bigint, id string, kind string, code string, segment_id bigint, section_letter string")
    out = {r.id: (r.parent, r.flag) for r in hierarchy.unit_parents(df).collect()}
    assert {k: p for k, (p, _) in out.items()} == {"s": "root", "p": "s", "x": "p", "r": "x", "o": "r", "f": "r", "r2": "x", "q": "s", "y": "p", "z": "root", "g": "root", "u": "root"}
    assert out["z"][1] == "carry_gap_reset,activity_without_program_parent"


def test_unit_rows_and_their_parents(spark):
    """Rows by what they say, and subtotals by the labels before them."""
    program, activity = "310101" + "0" * 9, "310101100001000"
    #        row_id label first_line code distance terminal n_amounts -> kind, tier, flags, parent
    told = [
        (0, "Operations", None, program, 500.0, None, 1, "program", 1, [], "root"),
        (1, "Road works", None, activity, 480.0, None, 1, "activity", 1, [], "p1:r0"),
        (2, "Region IV-A", None, None, 476.5, None, 1, "region", 1, [], "p1:r1"),
        (3, "Office", "Office ", None, 460.0, None, 1, "office", 2, ["suspect_leading_continuation"], "p1:r2"),
        (4, "goes on", None, None, None, None, 0, "continuation", None, ["continuation_merged"], None),
        (5, "No distance", None, None, None, None, 2, "office", 2, ["row_without_anchor_distance", "unclassified_distance"], "p1:r2"),
        (6, "Loan Proceeds", None, None, 440.0, None, 1, "funding", 2, ["funding_metadata_excluded"], "p1:r2"),
        (7, "Somewhere", None, None, 481.0, None, 1, "tier1_uncoded", 1, ["outside_center_tolerance", "unclassified_distance"], "p1:r1"),
        (8, "Sub-total, Road Work", None, None, 480.0, None, 1, "subtotal", None, ["multiple_money_candidates_in_cell"], "p1:r1"),
        (9, "Sub total Bridges", None, None, 480.0, None, 1, "subtotal", None, [], "root"),
        (10, "Total, all", None, None, 480.0, 541.0, 1, "grand_total", 0, [], "root"),
        (11, "Total of some", None, None, 460.0, 100.0, 1, "office", 2, [], "p1:r7"),
        (12, "Null code", None, None, 476.0, None, 1, "tier1_uncoded", 1, ["unclassified_distance"], "p1:r1"),
    ]
    views = spark.createDataFrame([(1, *t[:7]) for t in told], "page bigint, row_id bigint, label string, first_line string, code string, distance double, terminal_distance double, n_amounts bigint")
    centres = spark.createDataFrame([(1, 476.0, 460.0)], "page bigint, region_centre double, office_centre double")
    found = spark.createDataFrame([(1, 8, "multiple_money_candidates_in_cell"), (1, 8, "no_main_text_anchor")], "page bigint, row_id bigint, code string")
    rows = hierarchy.unit_rows(views, centres, found)
    assert {r.row_id: (r.kind, r.tier, list(r.flags)) for r in rows.collect()} == {t[0]: t[7:10] for t in told}
    shaped = rows.where("kind <> 'continuation'").selectExpr("cast(1 as bigint) as table_id", "row_id as doc_pos", "concat('p1:r', row_id) as id", "kind", "code", "cast(0 as bigint) as segment_id", "cast(null as string) as section_letter", "match_key", "target")
    out = {r.id: (r.parent, r.flag, r.match) for r in hierarchy.unit_parents(shaped).collect()}
    assert {f"p1:r{t[0]}": t[10] for t in told if t[10]} == {k: p for k, (p, _, _) in out.items()}
    assert out["p1:r8"][1:] == (None, "label") and out["p1:r9"][1:] == ("subtotal_parent_unmatched", "open_section")
    # A program or activity kind without a code neither sets nor finds a programme.
    odd = spark.createDataFrame([(1, 0, "a", "program", None, 0, None), (1, 1, "b", "activity", None, 0, None)], "table_id bigint, doc_pos bigint, id string, kind string, code string, segment_id bigint, section_letter string")
    assert {r.id: (r.parent, r.flag) for r in hierarchy.unit_parents(odd).collect()} == {"a": ("root", None), "b": ("root", "activity_without_program_parent")}


def test_ranks_of_any_depth_open_levels(spark):
    rows = [(1, 0, "a", 0), (1, 1, "b", 8), (1, 2, "c", 9), (1, 3, "d", 12), (1, 4, "e", 9), (1, 5, "f", None)]
    df = spark.createDataFrame([(*r, False, False, False, False) for r in rows], "table_id bigint, doc_pos bigint, id string, rank int, expense boolean, top_section boolean, marked boolean, attached boolean")
    got = {r.id: r.parent for r in hierarchy.stack_parents(df, ["table_id"]).collect()}
    assert {k: got[k] for k in "abcde"} == {"a": "root", "b": "a", "c": "b", "d": "c", "e": "b"}
    many = spark.range(300).selectExpr("cast(1 as bigint) as table_id", "id as doc_pos", "cast(id as string) as id", "cast(id as int) as rank", "false as expense", "false as top_section", "false as marked", "false as attached")
    with pytest.raises(ValueError):
        hierarchy.stack_parents(many, ["table_id"])


def test_ladder_and_nearest(spark):
    centres = [514.6, 496.5, 479.0, 461.0, 444.0, 426.0, 409.0, 391.3]
    clusters = spark.createDataFrame([(1, i, c) for i, c in enumerate([514.4, 496.0, 478.0, 391.2])], "page bigint, cluster_no bigint, centre double")
    assert [r["rank"] for r in hierarchy.rank_ladder(clusters, centres).orderBy("cluster_no").collect()] == [0, 1, 2, 7]
    assert one(spark, hierarchy.nearest(F.lit(10.0), F.array(F.lit(5.0), F.lit(15.0)))) == 0


def tree(spark, rows):
    return spark.createDataFrame([(i, p, k, c, False, s, pg, a, n) for n, (i, p, k, c, s, pg, a) in enumerate(rows)], "id string, parent string, kind string, code string, excluded boolean, synthetic boolean, page bigint, amount bigint, doc_pos bigint")


def test_depth_search_and_visibility(spark):
    t = tree(spark, [("root", None, "table_root", None, False, None, None), ("a", "root", "x", None, False, 1, 1), ("b", "a", "x", None, False, 2, 1), ("c", "b", "x", None, False, 9, 1), ("d", "a", "x", None, False, 3, 1)])
    assert {r.id: r.depth for r in hierarchy.depths(t).collect()} == {"root": 0, "a": 1, "b": 2, "c": 3, "d": 2}
    assert {r.id: r.max_page for r in hierarchy.descendant_max_page(t).collect()} == {"root": 9, "a": 9, "b": 9, "c": 9, "d": 3}
    assert {r.id: r.matched for r in hierarchy.search(t, F.col("id") == "c").collect()} == {"c": True, "b": False, "a": False, "root": False}
    assert {r.id for r in hierarchy.visible(t, spark.createDataFrame([("root",), ("a",)], "id string")).collect()} == {"root", "a", "b", "d"}
    loop = tree(spark, [("a", "b", "x", None, False, 1, 1), ("b", "a", "x", None, False, 1, 1)])
    assert {r.id: r.depth for r in hierarchy.depths(loop).collect()} == {"a": 0, "b": 0} and {r.id for r in hierarchy.cycles(loop).collect()} == {"a", "b"}
    assert hierarchy.search(loop, F.col("id") == "a").count() == 2 and hierarchy.visible(loop, loop.select("id")).count() == 0
    orphan = tree(spark, [("a", "gone", "x", None, False, 4, 1), ("b", "a", "x", None, True, 7, 1), ("c", "b", "x", None, True, 1, 1), ("d", "c", "x", None, False, None, 1)])
    assert {r.id: r.depth for r in hierarchy.depths(orphan).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert {r.id: r.max_page for r in hierarchy.descendant_max_page(orphan).collect()} == {"a": 7, "b": 7, "c": 1, "d": None}
    assert {(r.parent, r.child) for r in hierarchy.expand_shells(orphan).collect()} == {("gone", "a"), ("a", "d"), ("b", "d"), ("c", "d")}
    shells = tree(spark, [("a", "b", "x", None, True, 1, 1), ("b", "a", "x", None, True, 1, 1), ("c", "a", "x", None, False, 1, 1)])
    assert {(r.parent, r.child) for r in hierarchy.expand_shells(shells).collect()} == {("a", "c"), ("b", "c")}
    ids = lambda *a: spark.createDataFrame([(x,) for x in a], "id string")
    assert {r.id for r in hierarchy.expand_ancestors(t, ids("c", "d")).collect()} == {"b", "a", "root"} and hierarchy.expand_ancestors(t, ids("root", "?")).count() == 0
    assert [tuple(r) for r in hierarchy.row_list(t, ids("root", "a"), included=ids("root", "b", "c", "d")).orderBy("doc_pos").collect()] == [("root", 0, 0, True), ("b", 2, 2, True), ("d", 4, 2, False)]
    # A chain longer than any limit on levels.
    chain = spark.range(90).selectExpr("cast(id as string) as id", "if(id = 0, null, cast(id - 1 as string)) as parent", "id as page")
    assert hierarchy.expand_ancestors(chain, ids("89")).count() == 89


def test_documents_are_kept_apart(spark):
    """Two documents with the same pages and ids give what each gives alone."""
    one = [("root", None, 1), ("a", "root", 2), ("b", "a", 5)]
    other = [("root", None, 1), ("a", None, 3), ("b", "root", 4)]
    both = spark.createDataFrame([("x", *r) for r in one] + [("y", *r) for r in other], "document string, id string, parent string, page bigint")
    for f in (hierarchy.depths, hierarchy.descendant_max_page, lambda t: hierarchy.search(t, F.col("page") == 4)):
        apart = {("x", *r) for r in f(both.where("document = 'x'").drop("document")).collect()} | {("y", *r) for r in f(both.where("document = 'y'").drop("document")).collect()}
        assert {tuple(r) for r in f(both).collect()} == apart
    pages = spark.createDataFrame([("x", 1), ("x", 2), ("x", 4), ("y", 2), ("y", 3)], "document string, page bigint")
    assert {tuple(r) for r in hierarchy.segments(pages).collect()} == {("x", 1, 0, False), ("x", 2, 0, False), ("x", 4, 1, True), ("y", 2, 0, False), ("y", 3, 0, False)}


@pytest.mark.parametrize(
    "kids, parent, options, status, difference",
    [
        ([("x", None, 40), ("x", None, 60)], 100, {}, "pass", 0),
        ([("x", None, 40), ("x", None, 50)], 100, {}, "mismatch", 10),
        ([("x", None, 100), ("subtotal", None, 100)], 100, {}, "pass", 0),
        ([("x", None, 100), ("funding", None, 30)], 100, {}, "pass", 0),
        ([("x", None, 100), ("x", "310101200238000", 30)], 100, {}, "pass", 0),
        ([("x", None, 40), ("x", None, None)], 100, {}, "incomplete_children", 60),
        ([("x", None, 40)], None, {}, "missing_parent_total", None),
        ([("subtotal", None, 40)], 100, {}, "no_additive_children", 100),
        ([("x", None, 90)], 100, {"last_page": 5, "span_end": 9}, "boundary_incomplete", 10),
        ([("x", None, 110)], 100, {"last_page": 5, "span_end": 9}, "mismatch", -10),
        ([("x", None, 99)], 100, {"tolerance": 1}, "pass", 1),
    ],
)
def test_totals(spark, kids, parent, options, status, difference):
    rows = [("root", None, "table_root", None, False, None, None), ("p", "root", "program", None, False, 5, parent)]
    rows += [(f"k{i}", "p", kind, code, False, 5, amount) for i, (kind, code, amount) in enumerate(kids)]
    out = [r for r in totals.parent_totals(tree(spark, rows), **options).collect() if r.parent_id == "p"]
    assert [(r.status, r.difference) for r in out] == [(status, difference)]


def test_totals_through_shells(spark):
    rows = [("p", None, "program", None, False, 5, 100), ("s", "p", "x", None, True, None, None), ("s2", "s", "x", None, True, None, None), ("a", "s", "x", None, False, 5, 40), ("b", "s2", "x", None, False, 5, 60)]
    out = totals.parent_totals(tree(spark, rows), expand=True).collect()
    assert [(r.parent_id, r.child_sum, r.status) for r in out] == [("p", 100, "pass")]


# ---- anatomy
STATIONS = {
    "Abbut-Conner Rd · K0564 + 150 – K0564 + 200": ("Abbut-Conner Rd", [("K", "0564+150", "0564+200", False)]),
    "AH Lacson Ave - K0010 + (-337.40) - K0010 + 077": ("AH Lacson Ave", [("K", "0010+(-337.40)", "0010+077", False)]),
    "Abra Cervantes Road - Sta. 17+340 -Sta. 18+200, Abra": ("Abra Cervantes Road, Abra", [("Sta", "17+340", "18+200", False)]),
    "Flood (C0+000 to C0+220), Caloocan City": ("Flood, Caloocan City", [("C", "C0+000", "C0+220", False)]),
    "Bypass, Chainage 400 - Chainage 1860, Quezon": ("Bypass, Quezon", [("Chainage", "400", "1860", False)]),
    "Calapan South Rd - K0154 + 1037 - K0lSS + 207": ("Calapan South Rd", [("K", "0154+1037", "0155+207", False)]),
    "X Road K0076+114 - K0076+": ("X Road", [("K", "0076+114", "0076+", True)]),
    "Z Bridge": ("Z Bridge", []),
}


@pytest.mark.parametrize("label", STATIONS)
def test_stations(label):
    title, found = anatomy.stations(label)
    assert (title, [(f["kind"], f["from"], f["to"], f["incomplete"]) for f in found]) == STATIONS[label]


COORDINATES = {
    "Malabon City (14.701817, 120.928578)": ("Malabon City", [(14.701817, 120.928578)]),
    "Lanao del Norte (123.806752°, 7.980467°)": ("Lanao del Norte", [(7.980467, 123.806752)]),
    "Antipolo City (14.S64132°N, 121.176475°E)": ("Antipolo City", [(14.564132, 121.176475)]),
    "Burauen, Leyte (LS: 10.9730N, 124.9025E) (RS: 10.9800N, 124.9100E)": ("Burauen, Leyte", [(10.973, 124.9025), (10.98, 124.91)]),
    "Catbalogan City (11 °46'32.00\"N, 124°53'6.04\"E)": ("Catbalogan City", [(11.7755556, 124.8850111)]),
    "City 14.593238, 120.983126": ("City", [(14.593238, 120.983126)]),
    "Road 12.5, 13.5": ("Road 12.5, 13.5", []),
}


@pytest.mark.parametrize("label", COORDINATES)
def test_coordinates(label):
    title, found = anatomy.coordinates(label)
    assert (title, [(f["lat"], f["lon"]) for f in found]) == COORDINATES[label]


def test_anatomy_of_a_table_and_cues(spark):
    labels = [*STATIONS, *COORDINATES, None, ""]
    out = {r.id: r for r in anatomy.label_anatomy(spark.createDataFrame([(str(i), t) for i, t in enumerate(labels)], "id string, label string")).collect()}
    for i, t in enumerate(STATIONS):
        assert out[str(i)].label == STATIONS[t][0] and (out[str(i)].label_ocr is None) == (not STATIONS[t][1])
    # the cheap cues let through all that parses
    cues = texts(spark, lambda c: lexical.chainage_cue(c) | lexical.coordinate_cue(c), labels)
    assert all(cue for cue, t in zip(cues, labels) if t and (anatomy.stations(t)[1] or anatomy.coordinates(t)[1]))


def test_title_and_description(spark):
    rows = [(1, 1, "Flood Program", 321.48, 60.0), (1, 2, "This aims to  protect", 0.0, 0.0), (2, 1, "Road K0012+100", 300.0, 60.0), (2, 2, "The rest", 0.0, 0.0), (3, 1, "One", 1.0, 1.0)]
    out = {r.id: (r.title, r.description) for r in anatomy.split_lines(spark.createDataFrame(rows, "id bigint, line_no int, text string, run_gap_pt double, run_gap_spaces double")).collect()}
    assert out == {1: ("Flood Program", "This aims to protect"), 2: ("Road K0012+100 The rest", None), 3: ("One", None)}


# ---- export and sources
def test_roles(spark):
    rows = [(1, f"Amount {i}") for i in range(1, 6)] + [(2, "Amount 2"), (2, "Total")]
    out = {(r.page, r.role): r.resolved for r in export.role_resolution(spark.createDataFrame(rows, "page bigint, role string")).collect()}
    assert out == {(1, "Amount 5"): "Total", (1, "Amount 4"): "CO", (1, "Amount 3"): "MOOE", (1, "Amount 2"): "PS", (1, "Amount 1"): None, (2, "Amount 2"): "Total"}


def test_csv_reads_back(spark, tmp_path):
    import csv

    rows = [(i, 'say "x", y' if i % 2 else None, i * 10) for i in range(20)]
    export.write_csv(spark.createDataFrame(rows, "row_index bigint, label string, total bigint").coalesce(1), str(tmp_path / "out"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert b"\r\n" in raw
    lines = [r for r in csv.reader(raw.decode().splitlines()) if r and r[0] != "row_index"]
    assert [(int(a), b or None, int(c)) for a, b, c in lines] == rows


def test_natural_order(spark):
    rows = [(0, "b10"), (1, "b9"), (2, None), (3, "a"), (4, "B9")]
    df = spark.createDataFrame(rows, "row_index bigint, t string")
    assert [r.row_index for r in export.sorted_rows(df, "t").orderBy("place").collect()] == [3, 1, 4, 0, 2]
    assert [r.row_index for r in export.sorted_rows(df, "t", ascending=False).orderBy("place").collect()] == [2, 0, 1, 4, 3]


def test_page_specs(spark):
    assert specs.parse_pages("1-2,3,5-7") == [1, 2, 3, 5, 6, 7]
    for bad in ("0", "3-2", "", "x", "1,,2"):
        with pytest.raises(ValueError):
            specs.parse_pages(bad)
    assert specs.pages_from_object([{"page": 3}, {"pages": "5-6"}, "9", [1]]) == [1, 3, 5, 6, 9]
    assert texts(spark, specs.lenient_pages, ["1-3, x,5,4-2,0", None]) == [[1, 2, 3, 5], []]
    assert texts(spark, specs.page_of_path, ["a/page-0012.json", "a/other.json"]) == [12, None]
    assert specs.safe_name("a.json") == "a.json"
    for bad in ("../a.json", "a/b.json", "a.txt"):
        with pytest.raises(ValueError):
            specs.safe_name(bad)


def test_pages_and_stages(spark, tmp_path):
    import json

    (tmp_path / "pages").mkdir()
    for p in (1, 12):
        (tmp_path / "pages" / f"page-{p:04d}.json").write_text(json.dumps({"tokens": [{"text": f"t{p}"}]}))
    (tmp_path / "pages" / "notes.json").write_text("{}")
    out = documents.read_pages(spark, str(tmp_path / "pages"), "tokens array<struct<text:string>>")
    assert sorted((r.page, r.tokens[0].text) for r in out.collect()) == [(1, "t1"), (12, "t12")]
    stage = str(tmp_path / "stage")
    put = lambda rows, f: f(spark.createDataFrame(rows, "page bigint, v string"), stage)
    put([(1, "a"), (2, "b")], documents.write_stage)
    put([(2, "c"), (3, "d")], documents.write_stage)
    assert sorted((r.page, r.v) for r in spark.read.parquet(stage).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    put([(2, "e")], documents.write_slice)
    assert [(r.page, r.v) for r in spark.read.parquet(stage).collect()] == [(2, "e")]
    assert documents.admitted(10, documents.HEADROOM_BYTES + 10) and not documents.admitted(11, documents.HEADROOM_BYTES + 10)
    (tmp_path / "f").write_bytes(b"abc")
    assert documents.file_digest(str(tmp_path / "f")).startswith("ba7816bf")


def test_continuations_and_subtotals(spark):
    rows = [(1, 1, "a", "Regional", 450.0, 1), (1, 2, "b", "Office X", None, 0), (1, 3, "c", "Other", 450.0, 1), (1, 4, "d", "end", None, 0)]
    out = hierarchy.continuation_merge(spark.createDataFrame(rows, "table_id bigint, doc_pos bigint, id string, label string, distance double, n_amounts bigint")).orderBy("doc_pos").collect()
    assert [(r.id, r.label, r.n_merged) for r in out] == [("a", "Regional Office X", 1), ("c", "Other end", 1)]
    kind = "table_id bigint, doc_pos bigint, id string, key string"
    found = hierarchy.latest_match(spark.createDataFrame([(1, 1, "a", "road"), (1, 3, "b", "roads"), (1, 9, "c", "road")], kind), spark.createDataFrame([(1, 5, "s", "road"), (1, 6, "t", "dam")], kind))
    assert {r.subtotal_id: r.parent_id for r in found.collect()} == {"s": "b", "t": None}


def test_scratch_of_a_job_goes_with_it(spark):
    from gridledger.sources import scratch

    outer = scratch.stage_table(spark.range(3), "outer")
    path = scratch.scratch_path(spark, "kept")
    with scratch.job(spark):
        inner = scratch.scratch_path(spark, "inner")
        kept = scratch.stage_table(scratch.stage_table(outer, "inner", inner), "kept", path)
        with scratch.job(spark):
            deeper = scratch.scratch_path(spark, "deeper")
            scratch.stage_table(spark.range(2), "deeper", deeper)
        assert scratch.exists(spark, inner) and not scratch.exists(spark, deeper)
    assert not scratch.exists(spark, inner) and kept.count() == 3 and outer.count() == 3
    scratch.drop(spark, path)
    assert not scratch.exists(spark, path)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from gridledger.sources import scratch

    session = lambda master, folder: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder), sparkContext=SimpleNamespace(master=master, applicationId="a"))
    assert scratch.scratch_dir(session("spark://x:7077", "hdfs://y/z/")) == "hdfs://y/z"
    assert scratch.scratch_dir(session("local[8]", None)).endswith("gridledger-a")
    for master in ("spark://x:7077", "yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            scratch.scratch_dir(session(master, None))


def test_natural_order_of_long_numbers(spark):
    texts = ["310101200007000", "310101200006999", "31010120000700", "a310101200007001", "310101200007001", "9", "010", "a9", "b2", "310101200007000" * 2, "310101200007000" * 2 + "1"]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_index bigint, code string")
    out = [r.code for r in export.sorted_rows(rows, "code").orderBy("place").collect()]
    assert out == ["9", "010", "31010120000700", "310101200006999", "310101200007000", "310101200007001", "310101200007000" * 2, "310101200007000" * 2 + "1", "a9", "a310101200007001", "b2"]


def test_header_words(spark):
    cases = {
        "Personnel": "PS", "PERSONNEL  SERVICES": "PS", "ps": "PS", "ups": None, "Maintenance": "MOOE", "M.O.O.E. mooe": "MOOE", "Capital\n Outlays": "CO", "capital, outlay": None,
        "Co": "CO", "Cost": None, "Grand Total": "Total", "totals": None, "Total, Personnel": "PS", "": None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.role for r in rows.select("t", regions.header_role(F.col("t")).alias("role")).collect()} == cases
    cues = {"Amount (PhP)": (True, False, False), "amount ( PHP )": (True, False, False), "Amount PHP": (False, False, False), "FY 2027": (False, True, False), "12027": (False, False, False), "GAA  Targets": (False, True, False), "(In Thousand Pesos)": (False, False, True)}
    rows = spark.createDataFrame([(t,) for t in cues], "t string").select("t", regions.header_cues(F.col("t")).alias("c"))
    assert {r.t: (r.c.amount_header, r.c.year, r.c.unit) for r in rows.collect()} == cues
    money = {"2027": False, "2,027,000": True, "P 1,234.50": True, "PHP1": True, "(1,234)": True, "-5": True, "(-5.5)": True, "1900": False, "1899": True, "20.27": False, ",5": False, "5.": False, ".5": False, "P": False, "": False, "1 2": False, "5-": False, "P2027": False, "20,27": False}
    rows = spark.createDataFrame([(t,) for t in money], "t string").select("t", regions.is_money(F.col("t")).alias("m"))
    assert {r.t: r.m for r in rows.collect()} == money


def test_titles_are_put_together_again():
    cases = {
        "A ({}) B": "A B", "A ( {}, {} ; {} ) B": "A B", "A - {}, B": "A, B", "A, - {} B": "A, B", "A - {} - B": "A - B", "A, {}, {}, B": "A, B", "A {} , B": "A, B", "A-B {}.": "A-B",
        "{} - A": "A", "A ({}": "A", "{}) A": "A", "A (LZ) - {} - {} - {}": "A (LZ)", "A / {}": "A", "A {} B/C": "A B/C", "A. {}": "A", "Abbut-Conner {} x": "Abbut-Conner x",
    }
    for given, want in cases.items():
        text, spans = "", []
        for k, part in enumerate(given.split("{}")):
            if k:
                spans.append(anatomy.Span(len(text), len(text) + 2, {}))
                text += "##"
            text += part
        assert anatomy.without(text, spans) == want, given


def test_more_stations_and_places():
    read = lambda label: (anatomy.stations(label)[0], [(f["kind"], f["from"], f["to"], f["incomplete"]) for f in anatomy.stations(label)[1]])
    assert read("Maharlika Highway (LZ) • K0028+150 - K0031+420 • K0035+000 - K0038+200 • K0040+100 - K0042+500") == ("Maharlika Highway (LZ)", [("K", "0028+150", "0031+420", False), ("K", "0035+000", "0038+200", False), ("K", "0040+100", "0042+500", False)])
    assert read("Road KOOS?+150 to K0060+4?4") == ("Road", [("K", "0057+150", "0060+474", False)])
    assert read("Bypass Chainage 14268 - Chainage") == ("Bypass", [("Chainage", "14268", None, True)])
    assert read("Bypass Chainaqe 1+200 - 2+300.5, X") == ("Bypass, X", [("Chainage", "1+200", "2+300.5", False)])
    assert read("Dike KM 12+300") == ("Dike", [("KM", "12+300", None, False)])
    assert read("Ab K0012+100 - K0013") == ("Ab", [("K", "0012+100", "0013", True)])
    assert read("Ab Sta. 1+200 - Sta. 3+100") == ("Ab Sta. 1+200 - Sta. 3+100", [])  # of a title with letters enough, two would be left
    assert read("K0012345+100 Road") == ("K0012345+100 Road", [])
    place = lambda label: (anatomy.coordinates(label)[0], [(f["lat"], f["lon"], f["kind"], f["role"], f["swapped"], f["incomplete"]) for f in anatomy.coordinates(label)[1]])
    assert place("Ormoc (11°0'32.5\"N, 124°5154.78E)") == ("Ormoc", [(11.0090278, 124.8652167, "dms", None, False, False)])
    assert place("Naga (13°37'13.95°N, 123°11'5.1\"E)") == ("Naga", [(13.6205417, 123.1847500, "dms", None, False, False)])
    assert place("Leyte (10.5, 24.813)") == ("Leyte", [(10.5, 124.813, "decimal", None, False, False)])
    assert place("Samar (124.21693°' 8.191074°)") == ("Samar", [(8.191074, 124.21693, "decimal", None, True, False)])
    assert place("Oriental. 8.499076°, 124.660310°") == ("Oriental", [(8.499076, 124.66031, "decimal", None, False, False)])
    assert place("City (14.63001 °N, 121.121") == ("City", [(14.63001, 121.121, "decimal", None, False, True)])
    assert place("City (14.6300,") == ("City", [(14.63, None, "decimal", None, False, True)])
    assert place("South 8.1S, 125.2E") == ("South", [(-8.1, 125.2, "decimal_hem", None, False, False)])
    assert place("(RS: 10.98N, 124.91E) Bank") == ("Bank", [(10.98, 124.91, "decimal_hem", "RS", False, False)])
    assert place("Sta 12.5, 13.5 Lobo, Solo") == ("Sta 12.5, 13.5 Lobo, Solo", [])


def test_payloads_of_a_page(spark):
    from gridledger.sources import documents

    box = [[10.0, 20.0], [30.0, 40.0]]
    flat = "texts:array<string>,scores:array<double>,polygons:array<array<array<double>>>,words:array<array<string>>,word_boxes:array<array<array<array<double>>>>"
    kind = f"page bigint, payloads array<struct<{flat},res:array<struct<{flat}>>>>"
    words = (["a b", "c"], [0.91234, 0.5], [box, box], [["a", " ", "b", "more"], []], [[box, box, box], []])
    alone = (["d"], None, [box], None, None)
    none = (None,) * 5
    rows = [(1, [(*words, None), None, (*none, [alone, none, words]), (*none, None)]), (2, [])]
    df = spark.createDataFrame(rows, kind).select("page", documents.payload_lines(F.col("payloads")).alias("lines"))
    out = documents.recognised_tokens(df, 72.0).orderBy("token_id").collect()
    assert [(r.page, r.line_id, r.text, r.confidence) for r in out] == [(1, 0, "a", 0.9123), (1, 0, "b", 0.9123), (1, 1, "c", 0.5), (1, 2, "d", None), (1, 3, "a", 0.9123), (1, 3, "b", 0.9123), (1, 4, "c", 0.5)]
    assert out[0].bbox.x1 == 30.0


def test_manifests_exports_and_runs(tmp_path):
    import hashlib

    source = tmp_path / "volume.pdf"
    source.write_bytes(b"%PDF" * 400_000)
    manifest = documents.run_manifest(str(source), [3, 1, 3], {"dpi": 200, "a": 1}, {"numpy": "2"})
    assert manifest == {"document": {"name": "volume.pdf", "sha256": hashlib.sha256(b"%PDF" * 400_000).hexdigest()}, "pages": [1, 3], "settings": {"a": 1, "dpi": 200}, "packages": {"numpy": "2"}}
    out = tmp_path / "export"
    out.mkdir()
    for name in ("kept.json", "old.json", "old.csv", "note.txt"):
        (out / name).write_text("")
    with pytest.raises(ValueError):
        documents.prune_stale(str(out), {"kept.json"})
    (out / "index.json").write_text("{}")
    assert documents.prune_stale(str(out), {"kept.json"}) == ["old.csv", "old.json"] and sorted(p.name for p in out.iterdir()) == ["index.json", "kept.json", "note.txt"]
    for run in ("b", "a", "c"):
        (tmp_path / "runs" / run).mkdir(parents=True)
    for run in ("b", "a"):
        (tmp_path / "runs" / run / "viewer.json").write_text("{}")
    assert documents.list_runs(str(tmp_path / "runs")) == ["a", "b"] and documents.list_runs(str(tmp_path / "none")) == []
    assert export.flag_source(3, 3) == "index" and export.flag_source(2, 3) == "summary"


def test_confidences_and_column_order(spark):
    assert one(spark, lexical.assignment_confidence(F.lit(1.0), F.lit(0.5), F.lit(0.0))) == 0.7
    roles = ["Total", "Amount 10", "Amount 2", "other", "CO", "another", "PS", "amount 3", "MOOE"]
    out = export.column_vocabulary(spark.createDataFrame([(r,) for r in roles + roles], "role string")).orderBy("position").collect()
    assert [r.role for r in out] == ["PS", "MOOE", "CO", "Amount 2", "amount 3", "Amount 10", "another", "other", "Total"]


def test_zone_texts_end_after_forty_lines(spark):
    lines = spark.createDataFrame([(1, i, None if i == 3 else f"l{i}") for i in range(60)] + [(2, 0, "x")], "page bigint, line_id bigint, text string")
    zones = spark.createDataFrame([(1, 0, list(range(59, -1, -1))), (1, 1, [5, 5, 77]), (2, 0, [])], "page bigint, zone_id bigint, line_ids array<bigint>")
    out = {(r.page, r.zone_id): r.text for r in regions.zone_texts(zones, lines).collect()}
    assert out == {(1, 0): " ".join("" if i == 3 else f"l{i}" for i in range(40)), (1, 1): "l5", (2, 0): ""}


def test_exported_rows(spark):
    kind = "id string, parent string, kind string, code string, synthetic boolean, page bigint, doc_pos bigint, label string, table_id bigint, tier bigint, parent_pdf string, parent_prexc string"
    rows = [("root", None, "table_root", None, False, None, 0, "all", 1, 0, None, None), ("s", "root", "shell", None, True, None, 1, "shell", 1, 0, "root", "root"), ("a", "root", "program", "310101000000000", False, 3, 2, "A", 1, 1, "root", "s"), ("b", "a", "activity", "310101200007000", False, 4, 3, "B", 1, 1, "a", "a")]
    nodes = export.slim_nodes(spark.createDataFrame(rows, kind))
    amounts = spark.createDataFrame([("a", "PS", 5), ("a", "Total", 9), ("b", "CO", 1), ("b", "AMOUNT (Php)", 7)], "id string, role string, value bigint")
    totals_of = spark.createDataFrame([("a", "Total", 10), ("b", "Total", None), ("b", "MOOE", 4)], "id string, role string, value bigint")
    unit = export.unit_csv_rows(nodes, amounts, totals_of).orderBy("row_index").collect()
    assert tuple(unit[0].asDict()) == export.UNIT_COLUMNS
    # a's parent by code is a shell, which isn't exported, so a is at the top there
    assert [tuple(r)[7:] for r in unit] == [("root", "s", 1, 0, "0", 5, None, None, 10), ("a", "a", 2, 1, "2", None, 4, 1, None)]
    station = "array<struct<kind:string,from:string,to:string,incomplete:boolean>>"
    read = spark.createDataFrame([("a", [("K", "1+2", None, False), ("C", "C0+1", "C0+2", True)], [(1.5, 2.5), (3.5, 4.5)]), ("b", [], [])], f"id string, chainages {station}, coordinates array<struct<lat:double,lon:double>>")
    plan = export.plan_csv_rows(nodes, amounts, totals_of.limit(0), read).orderBy("row_index").collect()
    assert tuple(plan[0].asDict()) == export.PLAN_COLUMNS
    assert [(r.parent_id, r.amount, r.chainages, r.lat, r.lon) for r in plan] == [("root", None, '[{"kind": "K", "from": "1+2"}, {"kind": "C", "from": "C0+1", "to": "C0+2", "incomplete": true}]', 1.5, 2.5), ("a", 7, None, None, None)]
