"""Rows that a batch cannot use: counted while the batch is written, and kept with their reasons.

A check is a condition that a row fails on. ``measured`` counts the failures of all checks
in the action that writes the rows (observed metrics: no pass of their own); ``rejected``
gives the rows that fail any, each with the names of the checks it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalars import not_sentinel, parse_date, to_number


def bad_document(json_col: str) -> Column:
    """Text that is no JSON document."""
    c = F.col(json_col)
    return c.isNotNull() & F.try_parse_json(c).isNull()


def bad_date(col: str, *formats: str) -> Column:
    """Text (not a no-data marker) that no format reads."""
    parsed = F.coalesce(*[parse_date(F.col(col), f) for f in formats])
    return F.col(col).isNotNull() & not_sentinel(F.col(col)) & parsed.isNull()


def bad_number(col: str, dtype: str = "double") -> Column:
    return F.col(col).isNotNull() & to_number(F.col(col), dtype).isNull()


def left_out(col: str, values) -> Column:
    """A category (not a no-data marker) that a pivot over ``values`` has no column for."""
    return F.col(col).isNotNull() & not_sentinel(F.col(col)) & ~F.col(col).isin(*values)


def _fails(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def measured(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and the counts that the first action over it fills in: ``rows`` and
    one for each check (``Observation.get``)."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(_fails(c)).alias(n) for n, c in checks.items()]), seen


def rejected(df: DataFrame, checks: dict[str, Column], reasons_col: str = "reasons") -> DataFrame:
    """The rows that fail, with the names of the failed checks in the order of ``checks``."""
    reasons = F.array_compact(F.array(*[F.when(_fails(c), F.lit(n)) for n, c in checks.items()]))
    return df.withColumn(reasons_col, reasons).where(F.size(reasons_col) > 0)
