"""Explicit schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DATE, _TS, _NTZ, _BOOL = T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType()
_RATES = T.MapType(_STRING, _DOUBLE)
_TEXT_MAP = T.MapType(_STRING, _STRING)
_TEXT_MAP_BY_DATE = T.MapType(_STRING, _TEXT_MAP)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# A raw response as handed over by an extractor: the body is still JSON text.
RESPONSE = _struct(
    source=_STRING, body=_STRING, http_status_code=_INT, extraction_timestamp=_NTZ
)

# Fields read from any of the response bodies, latest and historical alike.
SNAPSHOT_BODY = _struct(
    base=_STRING, source=_STRING, date=_STRING, timestamp=_LONG, rates=_TEXT_MAP, quotes=_TEXT_MAP
)
RANGE_BODY = _struct(
    base=_STRING, source=_STRING, rates=_TEXT_MAP_BY_DATE, quotes=_TEXT_MAP_BY_DATE
)

LANDED = _struct(
    extraction_id=_STRING, extraction_timestamp=_NTZ, source=_STRING, source_tier=_STRING,
    base_currency=_STRING, rate_date=_DATE, rates=_RATES, api_response_raw=_STRING,
    http_status_code=_INT, response_size_bytes=_INT,
)

SILVER = _struct(
    extraction_id=_STRING, extraction_timestamp=_NTZ, source=_STRING, source_tier=_STRING,
    base_currency=_STRING, rate_date=_DATE, rates=_RATES, http_status_code=_INT,
)

STAGING = _struct(
    extraction_id=_STRING, extraction_timestamp=_NTZ, source=_STRING, source_tier=_STRING,
    base_currency=_STRING, target_currency=_STRING, exchange_rate=_DOUBLE, rate_date=_DATE,
    currency_pair=_STRING, inverse_rate=_DOUBLE, dbt_loaded_at=_TS,
)

FACT = _struct(
    extraction_id=_STRING, extraction_timestamp=_NTZ, rate_date=_DATE, currency_pair=_STRING,
    base_currency=_STRING, target_currency=_STRING, exchange_rate=_DOUBLE, inverse_rate=_DOUBLE,
    source=_STRING, source_tier=_STRING, validation_status=_STRING, severity=_STRING,
    consensus_variance=_DOUBLE, dbt_loaded_at=_TS, model_name=_STRING,
)

DIMENSION = _struct(
    country_code=_STRING, country_name=_STRING, currency_code=_STRING, region=_STRING
)

CYCLES = _struct(
    api_source=_STRING, cycle_start=_NTZ, cycle_end=_NTZ, request_count=_LONG, throttled=_BOOL,
    closed=_BOOL, batch_id=_LONG,
)
