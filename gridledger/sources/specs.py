"""Page specifications: lists like 1-2,3,5-7, strictly or leniently read, and named page sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_pages(spec: str) -> list[int]:
    """Sorted distinct pages of a list like "1-2,3,5-7"; raises for an empty list, pages below 1 and falling ranges."""
    pages: set[int] = set()
    for part in spec.split(","):
        low, dash, high = part.strip().partition("-")
        try:
            a = int(low)
            b = int(high) if dash else a
        except ValueError:
            raise ValueError(f"not a page or a range of pages: {part!r}") from None
        if a < 1 or b < a:
            raise ValueError(f"pages start at 1 and ranges rise: {part!r}")
        pages.update(range(a, b + 1))
    if not pages:
        raise ValueError("no pages")
    return sorted(pages)


def pages_from_object(value) -> list[int]:
    """Pages of a number, a list like "1-3", an object with page or pages, or lists of these."""
    if isinstance(value, bool):
        raise ValueError("not a page: a truth value")
    if isinstance(value, int):
        return parse_pages(str(value))
    if isinstance(value, str):
        return parse_pages(value)
    if isinstance(value, dict):
        return pages_from_object(value["page"] if "page" in value else value["pages"])
    if isinstance(value, list):
        return sorted({p for v in value for p in pages_from_object(v)})
    raise ValueError(f"not pages: {value!r}")


def page_frame(spark: SparkSession, pages: list[int]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in pages], "page bigint")


def lenient_pages(spec: Column) -> Column:
    """Array of the distinct pages of a list; what isn't a page or a rising range is passed over."""
    parts = F.split(F.coalesce(spec, F.lit("")), ",")
    ends = F.transform(parts, lambda p: F.struct(F.trim(F.regexp_extract(p, r"^\s*(\d+)\s*(-\s*\d+\s*)?$", 1)).try_cast("bigint").alias("a"), F.regexp_extract(p, r"^\s*\d+\s*-\s*(\d+)\s*$", 1).try_cast("bigint").alias("b")))
    sound = F.filter(ends, lambda e: (e["a"] >= 1) & (F.coalesce(e["b"], e["a"]) >= e["a"]))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(sound, lambda e: F.sequence(e["a"], F.coalesce(e["b"], e["a"]))))))


def page_of_path(path: Column) -> Column:
    """Page number in a name like page-0012.json; null for other names."""
    return F.regexp_extract(path, r"page-(\d+)\.json$", 1).try_cast("bigint")


def safe_name(name: str) -> str:
    """A single path component that ends in .json; raises for others."""
    if not name.endswith(".json") or "/" in name or "\\" in name or name in (".json",) or ".." in name:
        raise ValueError(f"not a plain .json name: {name!r}")
    return name
