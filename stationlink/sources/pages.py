"""Landed API pages: one JSON document per fetched page.

A page carries a result code, the total row count the service reports for the request
and an array of rows. Flattening keeps the rows of good pages and gives one sentinel
row for a request whose total is 0; a completeness report compares the rows landed per
request with the stated total (a missing last page or a dropped tail shows up there)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SENTINELS


def page_schema(row_schema: T.StructType, request_cols: tuple = ("request_date",),
                code_field: str = "code", total_field: str = "totalCnt", rows_field: str = "row") -> T.StructType:
    """Schema of one landed page: request columns, result code, stated total, row array."""
    return T.StructType([T.StructField(c, T.StringType()) for c in request_cols] + [
        T.StructField(code_field, T.StringType()), T.StructField(total_field, T.LongType()),
        T.StructField(rows_field, T.ArrayType(row_schema))])


def read_pages(spark: SparkSession, path: str, row_schema: T.StructType, **kw) -> DataFrame:
    """Landed pages (JSON lines, one page per line, any number of files: the page results
    are concatenated by the scan itself). Explicit schema: no inference pass."""
    return spark.read.schema(page_schema(row_schema, **kw)).json(path)


def flatten_pages(pages: DataFrame, rows_field: str = "row", code_field: str = "code",
                  total_field: str = "totalCnt", ok_codes: tuple = ("INFO-000",),
                  request_cols: tuple = ("request_date",),
                  sentinel: dict | None = None) -> DataFrame:
    """Explode the row array of every good page; a page with total 0 gives one row built
    from ``sentinel`` (column -> value, other row fields null). Rows keep the request
    columns. Pages with a bad code are dropped (see ``page_completeness``)."""
    good = pages.where(F.col(code_field).isin(*ok_codes))
    exploded = good.select(*request_cols, F.col(total_field).alias("_total"),
                           F.explode_outer(F.col(rows_field)).alias("_r"))
    row_fields = [f.name for f in pages.schema[rows_field].dataType.elementType.fields]
    sentinel = sentinel or {}
    cols = []
    for f in row_fields:
        v = F.col(f"_r.{f}")
        if f in sentinel:
            v = F.when((F.col("_total") == 0) & F.col("_r").isNull(), F.lit(sentinel[f])).otherwise(v)
        cols.append(v.alias(f))
    keep = F.col("_r").isNotNull() | (F.col("_total") == 0)
    return exploded.where(keep).select(*request_cols, *cols)


def page_completeness(pages: DataFrame, rows_field: str = "row", code_field: str = "code",
                      total_field: str = "totalCnt", ok_codes: tuple = ("INFO-000",),
                      request_cols: tuple = ("request_date",)) -> DataFrame:
    """Per request: pages, bad pages, rows landed, stated total and ``complete``."""
    return (pages.groupBy(*request_cols)
            .agg(F.count(F.lit(1)).alias("pages"),
                 F.sum(F.when(~F.col(code_field).isin(*ok_codes), 1).otherwise(0)).alias("bad_pages"),
                 F.sum(F.coalesce(F.size(F.col(rows_field)), F.lit(0))).cast("bigint").alias("rows_landed"),
                 F.max(total_field).cast("bigint").alias("total"))
            .withColumn("complete", (F.col("bad_pages") == 0) & (F.col("rows_landed") >= F.col("total"))))


def rows_or_sentinel(keys: DataFrame, rows: DataFrame, key_cols: list, sentinel: dict) -> DataFrame:
    """The flat form of page flattening: ``rows`` plus one sentinel row for every key of
    ``keys`` that has no row. No array is built per key (a key can be arbitrarily large):
    the empty keys come from an anti join."""
    empty = keys.select(*key_cols).distinct().join(rows.select(*key_cols).distinct(), key_cols, "left_anti")
    filler = [F.lit(sentinel.get(f.name)).cast(f.dataType).alias(f.name)
              for f in rows.schema.fields if f.name not in key_cols]
    return rows.unionByName(empty.select(*key_cols, *filler))


@dataclass(frozen=True)
class Service:
    """Where a service's responses hold the result code, the stated total and the rows
    (paths into the JSON document), the codes of good responses, and what a day without
    rows is filled with: ``date_field`` takes the request's date, the others a marker."""

    code: str
    total: str
    rows: str
    ok_codes: tuple
    date_field: str
    marked: tuple = ()
    marker: str = SENTINELS[0]


def outbreak_service(section: str) -> Service:
    """Outbreak records: everything below one section of the document."""
    return Service(f"$.{section}.result.code", f"$.{section}.totalCnt", f"$.{section}.row", ("INFO-000",), "OCCRRNC_DE", ("LKNTS_NM",))


READING_SERVICE = Service("$.response.header.resultCode", "$.response.body.totalCount", "$.response.body.items.item", ("00",), "tm", ("stnNm",))


def parse_responses(raw: DataFrame, service: Service, json_col: str = "body", request_cols: tuple = ("request_date",)) -> DataFrame:
    """Landed responses (request columns and the document as text) in the shape that
    ``flatten_pages`` and ``page_completeness`` take: code, total and an array of rows, which
    stay semi-structured. A row that is not in an array is an array of one; a document
    that cannot be read has no code."""
    doc = raw.select(*request_cols, F.try_parse_json(F.col(json_col)).alias("_v"))
    one = F.try_variant_get("_v", service.rows, "variant")
    rows = F.coalesce(F.try_variant_get("_v", service.rows, "array<variant>"),
                      F.when(F.schema_of_variant(one).startswith("OBJECT"), F.array(one)), F.array().cast("array<variant>"))
    return doc.select(*request_cols, F.try_variant_get("_v", service.code, "string").alias("code"),
                      F.try_variant_get("_v", service.total, "bigint").alias("totalCnt"), rows.alias("row"))


def flatten_responses(pages: DataFrame, service: Service, fields: T.StructType, request_cols: tuple = ("request_date",),
                      date_col: str = "request_date") -> DataFrame:
    """The rows of all good pages of ``parse_responses`` with typed ``fields`` (what cannot be
    read as its type is null), and one row for each request that states a total of 0, with
    the request's date and the service's marker."""
    good = pages.where(F.col("code").isin(*service.ok_codes))
    rows = good.select(*request_cols, F.explode("row").alias("_r")).select(
        *request_cols, *[F.try_variant_get("_r", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields])
    empty = good.groupBy(*request_cols).agg(F.max("totalCnt").alias("_t")).where("_t = 0")
    fill = {service.date_field: F.col(date_col).cast("string"), **{m: F.lit(service.marker) for m in service.marked}}
    return rows.unionByName(empty.select(*request_cols, *[fill.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]))
