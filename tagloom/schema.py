"""Fixed schemas shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the event contract.
SOURCE_ARCHIVE = "piapi"
QUALITY_GOOD = "GOOD"
QUALITY_NO_POINT = "BAD_POINT_NOT_FOUND"
QUALITY_STATUS_PREFIX = "BAD_STATUS_"
QUALITY_DIGITAL = "DIGITAL_STATE"
VALUE_NUMERIC = "numeric"
VALUE_ERROR = "error"
VALUE_DIGITAL = "digital"
STATE_SOURCE_CACHED = "cache"
STATE_SOURCE_UNRESOLVED = "unresolved"

# Our addition: a grid instant with no reading at or before it.
QUALITY_NO_DATA = "BAD_NO_DATA"

EVENT_COLUMNS = [
    "source", "server", "site", "tag", "timestamp", "value", "quality", "point_id",
    "value_type", "digital_code", "digital_set_id", "digital_state_id",
    "digital_state_name", "raw_istat", "event_id",
]

INTEGER_COLUMNS = ["point_id", "digital_code", "digital_set_id", "digital_state_id", "raw_istat"]

# The columns a merge may change on an existing event.
MERGE_UPDATED_COLUMNS = [
    "value", "quality", "point_id", "value_type", "digital_code", "digital_set_id",
    "digital_state_id", "digital_state_name", "raw_istat",
]


def _event_type(name: str) -> T.DataType:
    if name == "timestamp":
        return T.TimestampType()
    return T.LongType() if name in INTEGER_COLUMNS else T.StringType()


EVENT_SCHEMA = T.StructType([T.StructField(c, _event_type(c)) for c in EVENT_COLUMNS])

TABLE_COLUMNS = EVENT_COLUMNS + ["ingestion_timestamp", "event_date"]

READING_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("rval", T.DoubleType()),
    T.StructField("istat", T.LongType()),
    T.StructField("status", T.LongType()),
])

POINT_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("point_id", T.LongType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("server_key", T.StringType()),
    T.StructField("digital_code", T.LongType()),
    T.StructField("digital_state_name", T.StringType()),
    T.StructField("digital_set_id", T.LongType()),
    T.StructField("digital_state_id", T.LongType()),
    T.StructField("state_source", T.StringType()),
])

SITE_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
])
