"""Scalar column functions. Each returns a Column built from Spark built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SENTINELS

_STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}
_TIME_CODES = ("%H", "%M", "%S")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strftime_to_java(fmt: str) -> str:
    """Turn a strftime pattern into a Spark datetime pattern (%Y %m %d %H %M %S)."""
    out = fmt
    for k, v in _STRFTIME.items():
        out = out.replace(k, v)
    if "%" in out:
        raise ValueError(f"unsupported strftime code in {fmt!r}")
    return out


def parse_date(c, fmt: str, strict: bool = False) -> Column:
    """Parse text by a strftime format. Date-only formats give a DATE, formats with a
    time of day a TIMESTAMP. Permissive by default: bad text becomes null."""
    pattern = strftime_to_java(fmt)
    has_time = any(code in fmt for code in _TIME_CODES)
    if strict:
        return F.to_timestamp(_c(c), pattern) if has_time else F.to_date(_c(c), pattern)
    return F.try_to_timestamp(_c(c), F.lit(pattern)) if has_time else F.try_to_date(_c(c), pattern)


def to_number(c, dtype: str = "double") -> Column:
    """Numeric coercion; text that is not a number becomes null (never raises)."""
    return _c(c).try_cast(dtype)


def strip_ws(c) -> Column:
    """Strip leading and trailing whitespace (tabs and newlines too, not only blanks)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def not_sentinel(c) -> Column:
    """True when the value is not one of the no-data markers (null stays null)."""
    return ~_c(c).isin(*SENTINELS)


def l1_distance(x1, y1, x2, y2, wx: float = 1.0, wy: float = 1.0) -> Column:
    """Weighted L1 distance ``wx*|x1-x2| + wy*|y1-y2|``."""
    dx = F.abs(_c(x1) - _c(x2))
    dy = F.abs(_c(y1) - _c(y2))
    if wx != 1.0:
        dx = F.lit(wx) * dx
    if wy != 1.0:
        dy = F.lit(wy) * dy
    return dx + dy


def binarize(c) -> Column:
    """Counts to labels: positive -> 1, anything else unchanged (0 stays 0)."""
    return F.when(_c(c) > 0, F.lit(1)).otherwise(_c(c))


def json_field(c, path: str, dtype: str | None = None) -> Column:
    """JSON path extraction from JSON text; optional permissive cast."""
    v = F.get_json_object(_c(c), path)
    return v.try_cast(dtype) if dtype else v


def typed_null(dtype: str = "string") -> Column:
    return F.lit(None).cast(dtype)
