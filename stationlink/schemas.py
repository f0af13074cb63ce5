"""Schemas, table configuration and fixed values of the source data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values (must equal the source system's) -------------------------
# Sentinel written into the category / station column for a day without data;
# both spellings occur in the source system and mean the same thing.
SENTINELS = ("no_data", "nodata")
# Default high-water mark when a table is empty.
BASE_DATE = "2024-01-01"
# Ingest lags this many days behind today.
INGEST_LAG_DAYS = 14
# Outbreak record fields.
OUTBREAK_FIELDS = (
    "FARM_NM", "ROW_NUM", "LKNTS_NM", "OCCRRNC_DE", "FARM_LOCPLC", "CESSATION_DE",
    "LVSTCKSPC_NM", "DGNSS_ENGN_NM", "LVSTCKSPC_CODE", "DGNSS_ENGN_CODE",
    "ICTSD_OCCRRNC_NO", "OCCRRNC_LVSTCKCNT", "FARM_LOCPLC_LEGALDONG_CODE",
)
# Station reading fields: what the service says about the page, then the reading.
READING_FIELDS = (
    "numOfRows", "pageNo", "totalCount", "resultCode", "resultMsg", "dataType",
    "stnId", "stnNm", "tm", "avgTa", "minTa", "minTaHrmt", "maxTa", "maxTaHrmt",
    "sumRnDur", "mi10MaxRn", "mi10MaxRnHrmt", "hr1MaxRn", "hr1MaxRnHrmt", "sumRn",
    "maxInsWs", "maxInsWsWd", "maxInsWsHrmt", "maxWs", "maxWsWd", "maxWsHrmt", "avgWs",
    "hr24SumRws", "maxWd", "avgTd", "minRhm", "minRhmHrmt", "avgRhm", "avgPv", "avgPa",
    "maxPs", "maxPsHrmt", "minPs", "minPsHrmt", "avgPs", "ssDur", "sumSsHr",
    "hr1MaxIcsrHrmt", "hr1MaxIcsr", "sumGsr", "ddMefs", "ddMefsHrmt", "ddMes", "ddMesHrmt",
    "sumDpthFhsc", "avgTca", "avgLmac", "avgTs", "minTg", "avgCm5Te", "avgCm10Te",
    "avgCm20Te", "avgCm30Te", "avgM05Te", "avgM10Te", "avgM15Te", "avgM30Te", "avgM50Te",
    "sumLrgEv", "sumSmlEv", "n99Rn", "iscs", "sumFogDur",
)
# Weather features used for training, in this order.
FEATURES = ("avgTa", "minTa", "maxTa", "avgRhm")
# Disease targets (pivot values), in this order.
TARGETS = (
    "가금티푸스", "결핵병", "고병원성조류인플루엔자", "낭충봉아부패병",
    "돼지생식기호흡기증후군", "브루셀라병", "사슴만성소모성질병",
    "아프리카돼지열병", "추백리",
)
# Target kept for training only when its total is above this.
TARGET_MIN_TOTAL = 300
# Boosted trees: rounds, depth, seed.
GBT_PARAMS = {"maxIter": 50, "maxDepth": 5, "seed": 42}
# Seed of sampling and splitting.
SEED = 42
# Station master CSV columns: name, latitude, longitude, end date.
STATION_CSV_COLUMNS = ("지점명", "위도", "경도", "종료일")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableConf:
    """Per-table configuration: the date column and its strftime format, the key
    column that ties a row to a station and the column it is derived from."""

    date_col: str
    date_format: str
    essential_col: str = "stnNm"
    reference_col: str = "stnNm"
    fields: tuple = field(default_factory=tuple)


OUTBREAK_CONF = TableConf("OCCRRNC_DE", "%Y%m%d", "stnNm", "FARM_LOCPLC", OUTBREAK_FIELDS)
READING_CONF = TableConf("tm", "%Y-%m-%d", "stnNm", "stnNm")

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("json_data", T.StringType()),
    T.StructField("execute_date", T.TimestampType()),
])

OUTBREAK_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in OUTBREAK_FIELDS])

READING_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in ("stnId", "stnNm", "tm")]
    + [T.StructField(f, T.StringType()) for f in FEATURES]
)

# The whole record; READING_SCHEMA holds the fields that the panel's keys and features need.
FULL_READING_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in READING_FIELDS])

STATION_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()),
    T.StructField("end_date", T.DateType()),
])

GAZETTEER_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("wide", T.StringType()),
    T.StructField("narrow", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()),
])
