"""Sinks: run-partitioned Parquet, complete-year archive, JSON records, file marks."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_run(df: DataFrame, path: str, run_id: str, run_col: str = "run_id",
              compression: str = "gzip") -> None:
    """ACTION. Write ``df`` under ``path/run_id=<run_id>/``. Dynamic partition overwrite:
    a rerun of the same run replaces its own partition and leaves the others, so a
    retried job is idempotent."""
    (df.withColumn(run_col, F.lit(run_id))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(run_col)
       .parquet(path))


def complete_years(df: DataFrame, date_col: str, year_col: str = "year") -> tuple[DataFrame, DataFrame]:
    """Split into (complete years, live remainder): every year before the newest one is
    complete. Rows without a date stay live. The newest year is found by a scalar subquery
    (no collect)."""
    y = df.withColumn(year_col, F.year(F.col(date_col)))
    newest = y.agg(F.max(year_col)).scalar()
    old = F.coalesce(F.col(year_col) < newest, F.lit(False))
    return y.where(old), y.where(~old).drop(year_col)


def archive_years(df: DataFrame, date_col: str, path: str, compression: str = "gzip",
                  run_id: str | None = None, run_col: str = "run_id") -> DataFrame:
    """ACTION. Write complete years to ``path/year=<y>/run_id=<run>/`` and return the live
    remainder (lazy). A rerun of the same ``run_id`` replaces its own partitions only; late
    rows of an archived year, in another run, are added to it. Without a ``run_id`` each
    call is a run of its own."""
    run_id = run_id or uuid.uuid4().hex
    archived, live = complete_years(df, date_col)
    (archived.withColumn(run_col, F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", compression).partitionBy("year", run_col).parquet(path))
    return live


def json_records(df: DataFrame, cols: list, out_col: str = "json",
                 ts_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSS", keep: list = ()) -> DataFrame:
    """One JSON object per row (``keep`` columns alongside), keys in ``cols`` order,
    timestamps in ISO form, null fields written as null."""
    opts = {"timestampFormat": ts_format, "timestampNTZFormat": ts_format, "ignoreNullFields": "false"}
    return df.select(*keep, F.to_json(F.struct(*cols), opts).alias(out_col))


def file_high_water(spark: SparkSession, path: str, base: str,
                    pattern: str = r"(?:_|run_id=)(\d{14})") -> DataFrame:
    """Newest 14-digit run stamp found in the names of the files under ``path``; ``base``
    when there is none or no such folder. Names of ``write_run`` count too. One row, column ``mark`` (lazy; reads file metadata only)."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(F.lit(base).alias("mark"))  # first run: no folder yet
    stamp = F.regexp_extract(F.col("path"), pattern, 1)
    return (files.select(F.when(stamp != "", stamp).alias("s"))
                 .agg(F.coalesce(F.max("s"), F.lit(base)).alias("mark")))
