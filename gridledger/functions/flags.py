"""Vocabularies of quality flags: what each code says, and which only inform."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes and messages that readers of the results look for.
UNIT_MESSAGES = {
    "outside_center_tolerance": "Row distance exceeds the ±4 pt center tolerance.",
    "weak_page_fit": "Page distance fit used fewer than two supported clusters.",
    "extra_distance_cluster": "Page fit found more than two clusters; extras merged into the office tier.",
    "no_distance_clusters": "Page had no fittable body-row distances.",
    "parent_carry_missing": "Row starts a requested page range without carried parent context.",
    "carry_gap_reset": "Parent carry was reset at a page gap per reviewed carry policy.",
    "subtotal_parent_unmatched": "Sub-total label matched no earlier row; attached to the open section.",
    "suspect_leading_continuation": "Label begins with a wrap fragment such as 'Office'.",
    "row_without_anchor_distance": "Row has amounts but no anchor distance for its label.",
    "unclassified_distance": "Row distance could not be assigned to a fitted center.",
    "activity_without_program_parent": "Coded activity row has no preceding program with the same code prefix.",
    "continuation_merged": "Continuation fragment row was merged into the previous row.",
    "funding_metadata_excluded": "Funding metadata row is excluded from the hierarchy.",
    "multiple_money_candidates_in_cell": "Inherited from stage 002.20: ambiguous amount cell.",
    "multiple_main_text_candidates_in_row": "Inherited from stage 002.20: ambiguous row label.",
    "main_text_candidate_outside_label_cell": "Inherited from stage 002.20: label candidate outside label column.",
}
PLAN_MESSAGES = {
    "outside_center_tolerance": "Row distance exceeds the fitted center tolerance.",
    "parent_carry_missing": "Requested pages begin without the reviewed PAP start context.",
    "carry_gap_reset": "Parent carry was reset because the requested pages are not contiguous.",
    "funding_metadata_excluded": "Funding metadata is retained but excluded from hierarchy inference.",
    "merged_funding_label": "GOP and Loan Proceeds were merged into one retained funding row.",
    "formatting_displacement": "A page-local hierarchy center is displaced from the calibrated profile.",
    "end_of_span_open_stack": "The reviewed PAP span ends with hierarchy parents still open.",
    "unclassified_distance": "Row distance could not be assigned to a calibrated PAP level.",
    "multiple_money_candidates_in_cell": "Inherited from stage 002.20: ambiguous amount cell.",
    "no_recurring_amount_column": "Inherited from stage 002.20: no recurring amount column.",
}
#: Codes that ask for a review of a unit table.
UNIT_REVIEW = tuple(c for c in UNIT_MESSAGES if c not in ("continuation_merged", "funding_metadata_excluded"))
INFORMING = {"unit": ("continuation_merged", "funding_metadata_excluded"), "plan": ("funding_metadata_excluded", "end_of_span_open_stack")}


def message(code: Column, table: str) -> Column:
    """The text of a flag of a unit or plan table; an unknown code speaks for itself."""
    known = F.create_map(*[F.lit(x) for pair in (UNIT_MESSAGES if table == "unit" else PLAN_MESSAGES).items() for x in pair])
    return F.coalesce(known[code], code)


def severity(code: Column, table: str) -> Column:
    return F.when(code.isin(*INFORMING[table]), F.lit("info")).otherwise(F.lit("review"))
