"""Panel building: master enrichment, category pivot, key-aligned left join, key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import not_sentinel, strip_ws, to_number


def enrich_left(df: DataFrame, master: DataFrame, key: str, master_key: str,
                master_cols: list) -> DataFrame:
    """Left join with a master table; rows without a master row keep nulls.
    The master is small in practice (stations): Catalyst broadcasts it by its size
    statistics, otherwise it is a shuffled join."""
    m = master.select(F.col(master_key).alias("_mk"), *master_cols)
    return df.join(m, df[key] == m["_mk"], "left").drop("_mk")


def clean_categories(df: DataFrame, cat_col: str, count_col: str) -> DataFrame:
    """Drop no-data markers and rows without category or count; count to int
    (text that is not a number is dropped, like a missing count)."""
    return (df.where(not_sentinel(F.col(cat_col)))
              .withColumn(count_col, to_number(F.col(count_col), "int"))
              .na.drop(subset=[cat_col, count_col]))


def pivot_sum(df: DataFrame, keys: list, cat_col: str, val_col: str, values: list,
              fill: int | None = 0, out_type: str = "bigint") -> DataFrame:
    """One column per category value (explicit list: no extra job to find the values,
    the schema does not depend on the data), sum of ``val_col``, ``fill`` in empty cells.

    Written as conditional sums in one aggregation: one shuffle on ``keys`` with
    map-side partial sums (``GroupedData.pivot`` plans two, first on keys + category,
    then on keys). Rows of other categories still make their key's row, as in a pivot."""
    cat = F.col(cat_col)
    p = df.groupBy(*keys).agg(*[F.sum(F.when(cat == F.lit(v), F.col(val_col))).cast(out_type).alias(str(v))
                                for v in values])
    if fill is not None:
        p = p.na.fill(fill, subset=[str(v) for v in values])
    return p


def panel_join(readings: DataFrame, pivot: DataFrame, keys: list) -> DataFrame:
    """Left join on the shared keys (``USING`` form: every key appears once). Days
    without a pivot row keep nulls; they are filled at training time."""
    return readings.join(pivot, list(keys), "left")


def missing_keys(left: DataFrame, right: DataFrame, keys: list) -> DataFrame:
    """Distinct key combinations of ``left`` that ``right`` does not have."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def trim_keys(df: DataFrame, cols: list) -> DataFrame:
    """Strip whitespace from join keys (both sides must be trimmed before joining)."""
    return df.select(*[strip_ws(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
