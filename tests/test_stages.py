"""From tokens to totals on a page drawn here."""

import pytest

from gridledger.operators import anatomy
from gridledger.plans import stages


def page(rows):
    """Tokens of (label, indent, amount) rows: labels from the left, amounts flush right at 680."""
    out, n = [], 0
    for i, (label, x, amount) in enumerate(rows):
        y = 100.0 + 16 * i
        for word in label.split():
            out.append((1, n, word, x, x + 5.0 * len(word), y, y + 8))
            x += 5.0 * len(word) + 5
            n += 1
        if amount:
            out.append((1, n, amount, 680 - 5.0 * len(amount), 680.0, y, y + 8))
            n += 1
    return out


def test_tokens_to_totals(spark, tmp_path):
    top, mid, low = 680 - 514.6, 680 - 496.5, 680 - 479.0
    rows = [("Roads", top, "100,000"), ("North Area", mid, "60,000"), ("Bridge One", low, "20,000"), ("Bridge Two", low, "40,000"), ("South Area", mid, "40,000"), ("GOP", low, "40,000"), ("Ports", top, "9,000"), ("Pier", mid, "8,000")]
    tokens = spark.createDataFrame(page(rows), "page bigint, token_id bigint, text string, x0 double, x1 double, y0 double, y1 double")
    out = stages.run(spark, tokens, str(tmp_path), last="hierarchy")
    assert [(r.role, r.text) for r in out["cells"].where("row_id = 1").orderBy("column_id").collect()] == [("Labels", "North Area"), ("Amount 1", "60,000")]
    nodes = {r.label: r for r in out["nodes"].collect()}
    name = {r.id: k for k, r in nodes.items()} | {"root": "root"}
    assert {k: name[r.parent] for k, r in nodes.items()} == {"Roads": "root", "North Area": "Roads", "Bridge One": "North Area", "Bridge Two": "North Area", "South Area": "Roads", "GOP": "South Area", "Ports": "root", "Pier": "Ports"}
    checks = stages.run(spark, None, str(tmp_path), first="totals")["checks"].collect()
    assert {name[r.parent_id]: (r.status, r.difference) for r in checks} == {"Roads": ("pass", 0), "North Area": ("pass", 0), "South Area": ("no_additive_children", 40000), "Ports": ("mismatch", 1000)}
    with pytest.raises(ValueError):
        stages.run(spark, tokens, str(tmp_path), first="totals", last="geometry")


def test_documents_with_equal_pages_stay_apart(spark, tmp_path):
    """Two documents give the union of what each gives alone, from tokens to checks."""
    top, mid = 680 - 514.6, 680 - 496.5
    drawn = {"x": [("Roads", top, "100,000"), ("North", mid, "60,000"), ("South", mid, "40,000")], "y": [("Ports", top, "9,000"), ("Pier", mid, "8,000"), ("Quay", mid, "500"), ("Dock", mid, "500")]}
    kind = "document string, page bigint, token_id bigint, text string, x0 double, x1 double, y0 double, y1 double"
    rows = {d: [(d, *t) for t in page(r)] for d, r in drawn.items()}
    both = stages.run(spark, spark.createDataFrame(rows["x"] + rows["y"], kind), str(tmp_path / "both"))
    for table in ("bands", "gaps", "phrases", "columns", "pairs", "cells", "nodes", "checks"):
        got = {str(tuple(r)) for r in both[table].collect()}
        columns = [c for c in both[table].columns if c != "document"]
        want = set()
        for d in drawn:
            name = str(tmp_path / d)
            if table == "bands":
                stages.run(spark, spark.createDataFrame(rows[d], kind).drop("document"), name)
            stage = next(k for k in ("geometry", "sections", "hierarchy", "totals") if (tmp_path / d / k / table).exists())
            want |= {str((d, *r)) for r in spark.read.parquet(f"{name}/{stage}/{table}").select(*columns).collect()}
        order = [both[table].columns.index(c) for c in ("document", *columns)]
        assert {str(tuple(r[i] for i in order)) for r in both[table].collect()} == want and got, table


def test_enriched_labels(spark):
    rows = [(1, 1, "Road Program", 300.0, 60.0), (1, 2, "This aims to widen K0012 + 100 - K0013 + 200", 0.0, 0.0), (2, 1, "Pier (14.701817, 120.928578)", 0.0, 0.0), (3, 1, "Plain", 0.0, 0.0)]
    out = {r.id: r for r in anatomy.enriched_labels(spark.createDataFrame(rows, "id bigint, line_no int, text string, run_gap_pt double, run_gap_spaces double")).collect()}
    assert (out["1"].label, out["1"].description, out["1"].chainages[0]["to"]) == ("Road Program", "This aims to widen", "0013+200")
    assert (out["2"].label, out["2"].coordinates[0].lat, out["2"].label_ocr) == ("Pier", 14.701817, "Pier (14.701817, 120.928578)")
    assert (out["3"].label, out["3"].label_ocr, out["3"].description) == ("Plain", None, None)
