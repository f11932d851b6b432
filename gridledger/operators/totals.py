"""Reconciliation: does a parent's amount equal the sum of its additive children?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions import codes
from gridledger.operators import hierarchy
from gridledger.operators.keys import by_document

COMPARABLE = ("pass", "mismatch")
REVIEW = ("mismatch", "missing_parent_total", "incomplete_children")


def exclusion(kind: Column, excluded: Column, code: Column) -> Column:
    """Why a child doesn't add up into its parent; null if it does."""
    return (
        F.when(kind.isin("subtotal", "grand_total"), F.lit("semantic_aggregate"))
        .when(F.coalesce(excluded, F.lit(False)) | (kind == "funding"), F.lit("funding_metadata"))
        .when(codes.is_project(code), F.lit("prexc_project_sibling"))
    )


def status(n_additive: Column, parent_amount: Column, n_missing: Column, difference: Column, boundary: Column, tolerance: Column) -> Column:
    """The first that holds, in this order."""
    return (
        F.when(n_additive == 0, F.lit("no_additive_children"))
        .when(parent_amount.isNull(), F.lit("missing_parent_total"))
        .when(n_missing > 0, F.lit("incomplete_children"))
        .when(boundary & (difference < -tolerance), F.lit("mismatch"))
        .when(boundary, F.lit("boundary_incomplete"))
        .when(F.abs(difference) <= tolerance, F.lit("pass"))
        .otherwise(F.lit("mismatch"))
    )


@by_document("id", "parent", "parent_id", "child")
def parent_totals(nodes: DataFrame, tolerance: int = 0, last_page: int | None = None, span_end: int | None = None, expand: bool = False) -> DataFrame:
    """One check per parent with children and a page: parent_id, parent_amount, child_sum, difference, counts, status.

    nodes: id, parent, kind, code, excluded, synthetic, page, amount. If the last page read lies before the end
    of the reviewed span, parents whose descendants reach that page may lack children. With expand, synthetic
    children count as theirs. One join of children to parents and one aggregation, combined before the shuffle.
    """
    tol = F.lit(max(0, tolerance)).cast("bigint")
    why = exclusion(F.col("kind"), F.col("excluded"), F.col("code"))
    child = nodes.select(F.col("id").alias("child"), "parent", "amount", why.alias("why"))
    if expand:
        child = hierarchy.expand_shells(nodes).join(child.drop("parent"), "child")
    add = F.col("why").isNull()
    sums = child.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(add).alias("n_additive"), F.count_if(~add).alias("n_excluded"), F.count_if(add & F.col("amount").isNull()).alias("n_missing"),
        F.coalesce(F.sum(F.when(add, F.col("amount"))), F.lit(0)).cast("bigint").alias("child_sum"),
    )
    parents = nodes.where(F.col("page").isNotNull() & ~F.coalesce("synthetic", F.lit(False))).select("id", F.col("kind").alias("parent_kind"), F.col("page").alias("parent_page"), F.col("amount").alias("parent_amount"))
    checks = parents.join(sums, "id")
    if last_page is not None and span_end is not None and last_page < span_end:
        checks = checks.join(hierarchy.descendant_max_page(nodes), "id").withColumn("boundary", F.col("max_page") == last_page).drop("max_page")
    else:
        checks = checks.withColumn("boundary", F.lit(False))
    difference = F.col("parent_amount") - F.col("child_sum")
    return checks.select(
        F.col("id").alias("parent_id"), "parent_kind", "parent_page", "parent_amount", "child_sum", difference.alias("difference"), "n_children", F.col("n_additive").alias("n_additive_children"), F.col("n_excluded").alias("n_excluded_children"),
        F.col("n_missing").alias("n_missing_children"), F.col("boundary").alias("boundary_incomplete"),
        status(F.col("n_additive"), F.col("parent_amount"), F.col("n_missing"), difference, F.col("boundary"), tol).alias("status"),
    )


def diagnostics(checks: DataFrame) -> DataFrame:
    """n_checks, n_comparable, n_review, and the passing share of the comparable."""
    comparable, review = F.col("status").isin(*COMPARABLE), F.col("status").isin(*REVIEW)
    return checks.agg(F.count(F.lit(1)).alias("n_checks"), F.count_if(comparable).alias("n_comparable"), F.count_if(review).alias("n_review"), F.count_if(F.col("status") == "pass").alias("n_pass"))


def status_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


def page_slice(checks: DataFrame) -> DataFrame:
    """page, n_checks, n_review: the checks by the parent's page."""
    return checks.groupBy(F.col("parent_page").alias("page")).agg(F.count(F.lit(1)).alias("n_checks"), F.count_if(F.col("status").isin(*REVIEW)).alias("n_review"))
