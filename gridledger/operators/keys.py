"""The document as part of every key.

Operators are written for the pages, tables or nodes of one document. by_document() lets them take the tables of many:
where a frame has a column `document`, the named columns become pairs of document and value before the operator sees
them, and columns of its own again afterwards. A pair joins, groups, partitions and sorts as a number does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOCUMENT = "document"


def _paired(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    if DOCUMENT not in df.columns:
        return df
    pairs = {n: F.when(F.col(n).isNotNull(), F.struct(F.col(DOCUMENT), F.col(n).alias("value"))) for n in names if n in df.columns}
    return df.withColumns(pairs).drop(DOCUMENT) if pairs else df


def _parted(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    kinds = dict(df.dtypes)
    paired = [n for n in df.columns if n in names and kinds[n].startswith(f"struct<{DOCUMENT}:")]
    if not paired:
        return df
    document = F.coalesce(*[F.col(f"{n}.{DOCUMENT}") for n in paired])
    return df.select(document.alias(DOCUMENT), *[F.col(f"{c}.value").alias(c) if c in paired else F.col(f"`{c}`") for c in df.columns])


def by_document(*names: str) -> Callable:
    """Makes an operator on frames keyed by these columns one on frames that may be keyed by document as well."""

    def wrap(f: Callable) -> Callable:
        @wraps(f)
        def operator(*args, **options):
            frames = [a for a in (*args, *options.values()) if isinstance(a, DataFrame)]
            if not any(DOCUMENT in a.columns for a in frames):
                return f(*args, **options)
            pair = lambda a: _paired(a, names) if isinstance(a, DataFrame) else a
            out = f(*(pair(a) for a in args), **{k: pair(a) for k, a in options.items()})
            return tuple(_parted(x, names) for x in out) if isinstance(out, tuple) else _parted(out, names)

        return operator

    return wrap


def document_of(df: DataFrame) -> list[str]:
    """The document column, if a frame has one."""
    return [DOCUMENT] if DOCUMENT in df.columns else []


def key_type(df: DataFrame, name: str) -> str:
    """A column's type, for the schema of a grouped function."""
    return dict(df.dtypes)[name]
