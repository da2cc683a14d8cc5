"""Fixed data contracts: input schemas, output columns, sentinels, labels."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The nested event record. Every leaf is text, the time included.
# ---------------------------------------------------------------------------
_EVENT_DDL = """
    anonymousId STRING,
    context STRUCT<userAgent: STRING, ip: STRING, locale: STRING, page: STRUCT<url: STRING>>,
    messageId STRING,
    hospitalId STRING,
    properties STRUCT<
        path: STRING,
        page: STRING,
        button: STRUCT<name: STRING, hospital: ARRAY<STRING>>,
        action: STRUCT<name: STRING, hospital: ARRAY<STRING>>,
        properties: STRUCT<hospitalId: STRING, pageName: STRING, routeName: STRING, `to`: STRING>
    >,
    event STRING,
    timestamp STRING,
    type STRING,
    userId STRING
"""
CORRUPT = "_corrupt_record"


def event_schema(corrupt: bool = True) -> T.StructType:
    """Schema of one event; ``corrupt`` adds the column for malformed lines."""
    schema = T.StructType.fromDDL(_EVENT_DDL)
    return schema.add(CORRUPT, "string") if corrupt else schema


# The 28 output columns of a flattened event, in order, each with
# the path it is read from. A number in brackets is a 0-based array position.
EVENT_COLUMNS = (
    ("anonymousId", "anonymousId"),
    ("context_useragent", "context.userAgent"),
    ("context_ip", "context.ip"),
    ("context_locale", "context.locale"),
    ("context_page_url", "context.page.url"),
    ("context", "context"),
    ("messageId", "messageId"),
    ("properties_path", "properties.path"),
    ("properties_page", "properties.page"),
    ("properties_button_name", "properties.button.name"),
    ("properties_action_name", "properties.action.name"),
    ("properties_action_hospital_id", "properties.action.hospital[0]"),
    ("properties_action_hospital_name", "properties.action.hospital[1]"),
    ("properties_button_hospital_num", "properties.button.hospital[0]"),
    ("properties_button_hospital_name", "properties.button.hospital[1]"),
    ("properties_properties_hospitalid", "properties.properties.hospitalId"),
    ("properties_properties_pagename", "properties.properties.pageName"),
    ("properties_properties_routename", "properties.properties.routeName"),
    ("properties_properties_to", "properties.properties.to"),
    ("properties", "properties"),
    ("event", "event"),
    ("timestamp", "local_timestamp"),
    ("yw", "yw"),
    ("ywd", "ywd"),
    ("ym", "ym"),
    ("ymd", "ymd"),
    ("type", "type"),
    ("userId", "userId"),
)

# The nested projection offered as SQL, whole arrays kept.
EVENT_SQL_COLUMNS = (
    ("anonymousid", "anonymousId"),
    ("context_useragent", "context.userAgent"),
    ("context_ip", "context.ip"),
    ("context_locale", "context.locale"),
    ("context_page_url", "context.page.url"),
    ("context", "context"),
    ("messageid", "messageId"),
    ("properties_path", "properties.path"),
    ("properties_page", "properties.page"),
    ("properties_button_name", "properties.button.name"),
    ("properties_action_name", "properties.action.name"),
    ("properties_action_hospital", "properties.action.hospital"),
    ("properties_button_hospital", "properties.button.hospital"),
    ("properties_properties_hospitalid", "properties.properties.hospitalId"),
    ("properties_properties_pagename", "properties.properties.pageName"),
    ("properties_properties_routename", "properties.properties.routeName"),
    ("properties_properties_to", "properties.properties.to"),
    ("properties", "properties"),
    ("event", "event"),
    ("type", "type"),
    ("userId", "userId"),
)

# Names under which a time column may arrive.
TIME_COLUMNS = ("Timestamp", "timestampAt", "timestamp_At", "timestamp")

# ---------------------------------------------------------------------------
# Daily weather readings.
# ---------------------------------------------------------------------------
READING_KEYS = ("STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME")
READING_SENTINELS = (99.99, 999.9, 9999.9)
# description, column, unit
READING_STATS = (
    ("Highest temperature", "MAX", "°F"),
    ("Highest all-day average temperature", "TEMP", "°F"),
    ("Highest wind gust", "GUST", "mph"),
    ("Highest average wind speed", "WDSP", "mph"),
    ("Highest precipitation", "PRCP", "inches"),
)
READING_SCHEMA = (
    "STATION STRING, DATE STRING, LATITUDE DOUBLE, LONGITUDE DOUBLE, ELEVATION DOUBLE, "
    "NAME STRING, MAX DOUBLE, TEMP DOUBLE, GUST DOUBLE, WDSP DOUBLE, PRCP DOUBLE"
)

# The layout of stored metrics.
METRIC_SCHEMA = "metric STRING, value BIGINT"

# Defaults of the calendar and of the session rule.
LOCAL_ZONE = "Asia/Seoul"
SESSION_GAP_MINUTES = 30
DAY_MS = 86_400_000
