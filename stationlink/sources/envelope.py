"""Envelope tables: ``id, json_data (JSON text), execute_date``.

The serving tier's time-range extract and its argument checks are here too."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def unwrap_envelope(df: DataFrame, schema: StructType, json_col: str = "json_data",
                    keep: tuple = ("execute_date",)) -> DataFrame:
    """Parse the JSON text on the executors into typed columns and keep ``keep``.

    A malformed or missing document gives nulls (``from_json`` is permissive)."""
    j = F.from_json(F.col(json_col), schema, {"mode": "PERMISSIVE"})
    return df.select(j.alias("_j"), *keep).select("_j.*", *keep)


def _parse14(s: str) -> datetime:
    if not (isinstance(s, str) and len(s) == 14 and s.isdigit()):
        raise ValueError(f"expected a 14-digit timestamp yyyyMMddHHmmss, got {s!r}")
    return datetime.strptime(s, "%Y%m%d%H%M%S")


def check_range_args(table: str, start: str, end: str, tables) -> tuple[datetime, datetime]:
    """Validate a range request: known table, 14-digit stamps, start not after end."""
    if table not in tables:
        raise ValueError(f"unknown table {table!r}")
    lo, hi = _parse14(start), _parse14(end)
    if lo > hi:
        raise ValueError("start is after end")
    return lo, hi


def extract_range(df: DataFrame, lo, hi, ts_col: str = "execute_date",
                  order_cols: tuple = ("id",)) -> DataFrame:
    """Rows with ``lo < ts < hi`` (both ends exclusive), newest first.

    The predicate reaches the Parquet scan (and partition pruning when the data is
    stored by day)."""
    def lit_ts(v):
        if isinstance(v, datetime):
            v = v.strftime("%Y-%m-%d %H:%M:%S.%f")
        # text -> timestamp_ntz: no session time zone is involved
        return F.lit(v).cast("timestamp_ntz") if isinstance(v, str) else v

    lo_c, hi_c = lit_ts(lo), lit_ts(hi)
    out = df.where((F.col(ts_col) > lo_c) & (F.col(ts_col) < hi_c))
    return out.orderBy(*[F.col(c).desc() for c in order_cols], F.col(ts_col).desc())
