"""Column functions over recovered text: classes of phrases, amounts, labels, markers, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text classes, label vocabularies and patterns of the document family.
MARKER = r"^(\d{1,2}|[A-Za-z])[.)]$"
PROGRAM_CODE = r"^\d{12,}$"
CURRENCY = r"(?i)^P(HP)?\d[\d,]*(\.\d+)?$"
CURRENCY_START = r"(?i)^P(HP)?\d*$"
COMMA_MONEY = r"^\d{1,3}(,\d{3})+(\.\d+)?$"
BARE_NUMBER = r"^\d+(\.\d+)?$"
FUNDING = r"(?i)^(GOP|Loan Proceeds|GOP Loan Proceeds)$"
UNIT_FUNDING = ("GOP", "GOP Counterpart", "Loan Proceeds")
SUBTOTAL = r"(?i)^sub[\s-]*total\b"
TOTAL = r"(?i)^total\b"
EXPENSE_CLASSES = ("MAINTENANCE AND OTHER OPERATING EXPENSES", "CAPITAL OUTLAYS")
TOP_SECTIONS = ("GENERAL ADMINISTRATIVE AND SUPPORT", "SUPPORT TO OPERATIONS", "OPERATIONS")
REGION = r"(?i)\bRegion(\s+[IVX]+(-[A-Z])?)?\b|National Capital Region|Administrative Region|Nationwide|BARMM"
OFFICE = r"(?i)\b(Central|Regional|District Engineering|Bureau Proper)\s+Office\b|^Central Office$|^Bureau Proper$"
OUTCOME = r"(?i)ORGANIZATIONAL OUTCOME"
PROGRAM = r"(?i)\bPROGRAM\b"
UNIT_REGION = r"(?i)Region\s+[IVX]+[A-Z]*\b|National Capital Region|\(NCR\)|Administrative Region|\(CAR\)|Island Region|\(NIR\)"
PROSE_LEAD = r"^(The|This)\s+"
PROSE_VERB = r"(?i)\b(is a sub-program|aims to|involves|encompasses|covers the|focuses specifically|seeks to|program focuses|program aims)\b"
MIN_RUN_GAP_PT = 72.0
MIN_RUN_GAP_SPACES = 15.0


def clean(text: Column) -> Column:
    """Runs of any white space as one space, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def observation(text: Column) -> Column:
    """Class of a phrase, by the first pattern that its text without spaces matches."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")
    out = F.when(t.rlike(r"\d") & t.rlike(r"[^\d,.()-]"), F.lit("mixed_candidate")).otherwise(F.lit("text_candidate"))
    for pattern, name in ((BARE_NUMBER, "money"), (COMMA_MONEY, "money"), (CURRENCY, "money"), (PROGRAM_CODE, "code"), (MARKER, "marker")):
        out = F.when(t.rlike(pattern), F.lit(f"{name}_candidate")).otherwise(out)
    return out


def observation_confidence(text: Column) -> Column:
    """1 for what is certain, 0.45 for a number without separators, 0 for words."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")
    sure = t.rlike(MARKER) | t.rlike(PROGRAM_CODE) | t.rlike(CURRENCY) | t.rlike(COMMA_MONEY)
    return F.when(sure, F.lit(1.0)).when(t.rlike(BARE_NUMBER), F.lit(0.45)).otherwise(F.lit(0.0))


def joined(parts: Column) -> Column:
    """Token texts as a phrase: no space before closing signs or after an opening bracket."""
    closing = F.array(*[F.lit(c) for c in (".", ",", ")", ":", ";", "%")])

    def step(acc: Column, part: Column) -> Column:
        p = F.trim(part)
        tight = (acc == "") | F.array_contains(closing, p) | acc.endswith("(")
        return F.when((p == "") | p.isNull(), acc).when(tight, F.concat(acc, p)).otherwise(F.concat(acc, F.lit(" "), p))

    return F.aggregate(parts, F.lit(""), step)


def char_width(text: Column, width: Column) -> Column:
    """Width of a character, from texts of two or more that aren't spaces."""
    n = F.length(F.regexp_replace(text, r"(?U)\s", ""))
    return F.when(n >= 2, width / n)


def overlap_ratio(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Shared height over the lesser height (at least .01)."""
    shared = F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))
    return shared / F.greatest(F.lit(0.01), F.least(a1 - a0, b1 - b0))


def assignment_confidence(bottom: Column, overlap: Column, height: Column) -> Column:
    return F.round(0.55 * bottom + 0.30 * overlap + 0.15 * height, 3)


def amount(text: Column) -> Column:
    """The digits of a text as a number, sign and point ignored; null without digits."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\D", "").try_cast("bigint")


def read_amount(value: Column, text: Column) -> Column:
    """A number if it is whole, else what amount() reads in the text."""
    return F.coalesce(F.when(value == F.floor(value), value.cast("bigint")), amount(text))


def normalize_label(label: Column) -> Column:
    """Lower case, without plural brackets and section prefixes, other signs as spaces."""
    t = F.trim(F.regexp_replace(F.lower(F.coalesce(label, F.lit(""))), r"\(\s*s\s*\)", " "))
    t = F.regexp_replace(t, r"^[a-z]\.\d*\s+(?=\S)", "")
    return F.trim(F.regexp_replace(t, r"[^a-z0-9]+", " "))


def is_funding(label: Column) -> Column:
    return clean(label).rlike(FUNDING)


def is_subtotal(label: Column) -> Column:
    return clean(label).rlike(SUBTOTAL)


def is_total(label: Column) -> Column:
    return clean(label).rlike(TOTAL)


def code_kind(code: Column) -> Column:
    """program if the last nine of fifteen digits are zero, activity if not, else null."""
    return F.when(code.rlike(r"^\d{15}$"), F.when(F.substring(code, 7, 9) == "000000000", F.lit("program")).otherwise(F.lit("activity")))


def plan_kind(label: Column, rank: Column) -> Column:
    """Kind of a project-plan row from its label, else from its geometric rank."""
    t = clean(label)
    named = F.upper(t)
    return (
        F.when(named.isin(*EXPENSE_CLASSES), F.lit("expense_class"))
        .when(named.isin(*TOP_SECTIONS), F.lit("section"))
        .when(t.rlike(OUTCOME), F.lit("outcome"))
        .when(t.rlike(REGION), F.lit("region"))
        .when(t.rlike(OFFICE), F.lit("office"))
        .when(t.rlike(PROGRAM) & (rank <= 3), F.lit("program"))
        .when(rank >= 7, F.lit("project"))
        .when(rank >= 5, F.lit("intermediate"))
        .otherwise(F.lit("group"))
    )


def unit_kind(label: Column, code: Column, tier: Column) -> Column:
    """Kind of an operating-unit row: by code, else region or uncoded in tier 1, else office."""
    return F.coalesce(code_kind(code), F.when(tier == 1, F.when(clean(label).rlike(UNIT_REGION), F.lit("region")).otherwise(F.lit("tier1_uncoded"))).otherwise(F.lit("office")))


def marker(prefixes: Column, label: Column) -> Column:
    """The first prefix that is a marker, else a marker that the label starts with."""
    found = F.get(F.filter(prefixes, lambda p: F.trim(p).rlike(r"^([A-Za-z]|\d+)[.)]$")), F.lit(0))
    lead = F.regexp_extract(clean(label), r"^(([A-Za-z]|\d+)[.)])\s+", 1)
    return F.coalesce(F.trim(found), F.when(lead != "", lead))


def starts_prose(text: Column) -> Column:
    t = clean(text)
    return t.rlike(PROSE_LEAD) | F.substring(t, 1, 200).rlike(PROSE_VERB)


def chainage_cue(label: Column) -> Column:
    """Whether a text may hold a road station; cheaper than parsing it, and true for all that parse."""
    t = F.upper(F.regexp_replace(F.coalesce(label, F.lit("")), r"(?U)\s+", ""))
    return t.rlike(r"K[0-9OILSBZG|!?]{2,5}\+|STA\.?[0-9OILSBZG|!?]+\+|C[0O]\+|KM[0-9OILSBZG|!?]+\+|CHAINA[GQ]E[0-9OILSBZG|!?]")


def coordinate_cue(label: Column) -> Column:
    """Whether a text may hold a coordinate: a digit or a look-alike beside a point, degree sign or bracket."""
    return F.coalesce(label, F.lit("")).rlike(r"(?i)\b[LR]S\s*:|[0-9OIlLSBZGsboz|]\s*[.°º]|\(\s*[0-9OIlLSBZGsboz|]")


def splits_title(first_text: Column, run_gap_pt: Column, run_gap_spaces: Column, second_text: Column) -> Column:
    """Whether a label's first line is a title and the second starts a description: a wide gap, then prose."""
    wide = (run_gap_pt >= MIN_RUN_GAP_PT) | (run_gap_spaces >= MIN_RUN_GAP_SPACES)
    goes_on = clean(second_text).rlike(r"(?i)^(K\d|[\d,]|Sta\.?\s*\d|Chainage\s*\d|C0\+|KM\d)")
    return wide & ~chainage_cue(first_text) & ~goes_on & ~is_funding(first_text) & ~is_funding(second_text) & starts_prose(second_text)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def human_size(n: Column) -> Column:
    """Bytes with a unit: whole bytes, else one decimal, halves to even."""
    kb, mb = 1024.0, 1024.0 * 1024.0
    return F.when(n < kb, F.format_string("%d B", n)).when(n < mb, F.format_string("%.1f KB", F.bround(n / kb, 1))).otherwise(F.format_string("%.1f MB", F.bround(n / mb, 1)))


def dms(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column) -> Column:
    """Degrees, minutes, seconds as degrees; null if minutes or seconds are out of range."""
    value = F.abs(degrees) + minutes / 60.0 + seconds / 3600.0
    signed = F.when(F.upper(hemisphere).isin("S", "W"), -value).otherwise(value)
    return F.when((minutes >= 0) & (minutes < 60) & (seconds >= 0) & (seconds < 60), signed)


def latitude_first(a: Column, b: Column) -> Column:
    """struct(lat, lon, swapped) of an unordered pair, by the bounds of the country."""
    lat, lon = (lambda x: x.between(4.0, 22.0)), (lambda x: x.between(116.0, 128.0))
    swap = ~(lat(a) & lon(b)) & ((lon(a) & lat(b)) | (~((a <= 35) & (b >= 100)) & (a >= 100) & (b <= 35)))
    return F.struct(F.when(swap, b).otherwise(a).alias("lat"), F.when(swap, a).otherwise(b).alias("lon"), swap.alias("swapped"))


def haystack(*parts: Column) -> Column:
    """What a search looks at: all parts that there are, in lower case."""
    return F.lower(F.concat_ws(" ", *parts))


PREVIEW = 48


def preview(label: Column) -> Column:
    """The first signs of a label, for the details of a flag."""
    return F.substring(label, 1, PREVIEW)
