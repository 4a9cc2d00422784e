"""Currency-rate views over the supplied tables.

The text is valid in Spark SQL and in DuckDB.  ``{table}`` and ``{view}`` placeholders are filled
with DataFrames on the Spark side and with names of common table expressions on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CODES = tuple(f"C{i:02d}" for i in range(25))
MATRIX_CODES = CODES[:10]

FX_QUOTES = """
SELECT concat(CASE event_type WHEN 'click' THEN 'er' WHEN 'purchase' THEN 'cl' ELSE 'fr' END,
              '_', CAST(event_id AS STRING)) AS extraction_id,
       ts AS extraction_timestamp,
       event_id,
       user_id,
       event_type,
       CASE event_type WHEN 'click' THEN 'exchangerate' WHEN 'purchase' THEN 'currencylayer'
                       ELSE 'frankfurter' END AS source,
       CASE event_type WHEN 'click' THEN 'secondary' WHEN 'purchase' THEN 'secondary'
                       ELSE 'primary' END AS source_tier,
       CASE WHEN event_id % 50 = 0 THEN 'EUR' ELSE 'USD' END AS base_currency,
       concat('C', lpad(CAST(user_id % 25 AS STRING), 2, '0')) AS target_currency,
       CAST(ts AS DATE) AS rate_date,
       CASE WHEN event_type = 'error' THEN CAST(NULL AS DOUBLE)
            ELSE CAST(1 + user_id % 25 AS DOUBLE)
                 * (CAST(1 AS DOUBLE) + (value - CAST(245 AS DOUBLE)) / CAST(20000 AS DOUBLE))
       END AS exchange_rate,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status_code
FROM {events}
"""

_WIDE_COLUMNS = ",\n       ".join(
    f"MAX(CASE WHEN target_currency = '{c}' THEN exchange_rate END) AS rates__{c.lower()}"
    for c in CODES
)

# Six-hour batches in the landing layout, one column per currency.
FX_LANDED_WIDE = f"""
SELECT source, MAX(source_tier) AS source_tier, base_currency, rate_date,
       CAST(floor(hour(extraction_timestamp) / 6) AS INT) AS slot,
       concat(source, '_', CAST(rate_date AS STRING), '_', base_currency, '_',
              CAST(CAST(floor(hour(extraction_timestamp) / 6) AS INT) AS STRING)) AS extraction_id,
       MAX(extraction_timestamp) AS extraction_timestamp,
       200 AS http_status_code,
       {_WIDE_COLUMNS}
FROM {{fx_quotes}} GROUP BY 1, 3, 4, 5
"""

FX_LANDED_LONG = """
SELECT source, base_currency, rate_date,
       CAST(floor(hour(extraction_timestamp) / 6) AS INT) AS slot,
       target_currency, MAX(exchange_rate) AS exchange_rate, MAX(extraction_timestamp) AS ts
FROM {fx_quotes} GROUP BY 1, 2, 3, 4, 5
"""

FX_SERIES = """
SELECT rate_date, base_currency, target_currency, exchange_rate,
       CAST(1 AS DOUBLE) / exchange_rate AS inverse_rate
FROM (SELECT CAST(l_shipdate AS DATE) AS rate_date, 'USD' AS base_currency,
             concat('C', lpad(CAST(l_suppkey % 25 AS STRING), 2, '0')) AS target_currency,
             CAST(1 + l_suppkey % 25 AS DOUBLE)
               * (CAST(1 AS DOUBLE) + (l_discount - l_tax) / CAST(4 AS DOUBLE)) AS exchange_rate,
             ROW_NUMBER() OVER (PARTITION BY l_suppkey % 25, CAST(l_shipdate AS DATE)
                                ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                         l_extendedprice) AS rn
      FROM {lineitem}) t
WHERE rn = 1
"""

FX_DIM = """
SELECT concat('N', CAST(n_nationkey AS STRING)) AS country_code, n_name AS country_name,
       concat('C', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS currency_code, r_name AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

FX_CALLS = """
SELECT event_id AS call_id, ts AS called_at,
       CASE event_type WHEN 'click' THEN 'exchangerate' WHEN 'purchase' THEN 'currencylayer'
                       ELSE 'frankfurter' END AS api_source,
       event_type <> 'error' AS success
FROM {events}
"""

# One response per event: throttled, failing and broken ones among them.
FX_RESPONSES = """
SELECT extraction_id, source, extraction_timestamp,
       CASE WHEN event_type <> 'error' THEN 200 WHEN user_id % 3 = 0 THEN 429 ELSE 500 END
         AS http_status_code,
       CASE WHEN source = 'currencylayer' AND user_id % 7 = 0
              THEN '{{"success": false, "error": {{"code": 104, "info": "limit reached"}}}}'
            WHEN source = 'currencylayer' AND user_id % 7 = 1
              THEN '{{"success": false, "error": {{"code": 101, "info": "bad key"}}}}'
            WHEN source = 'currencylayer'
              THEN '{{"success": true, "source": "USD", "quotes": {{"USDC01": 1.5}}}}'
            WHEN user_id % 11 = 0 THEN '{{"base": "USD", "rates": '
            ELSE '{{"base": "USD", "rates": {{"C01": 1.5}}}}' END AS body,
       user_id, event_type
FROM {fx_quotes}
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_QUOTES, events=_table(spark, sf_dir, "events"))


def fx_landed_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_LANDED_WIDE, fx_quotes=fx_quotes(spark, sf_dir))


def fx_landed_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_LANDED_LONG, fx_quotes=fx_quotes(spark, sf_dir))


def fx_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_SERIES, lineitem=_table(spark, sf_dir, "lineitem"))


def fx_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        FX_DIM, nation=_table(spark, sf_dir, "nation"), region=_table(spark, sf_dir, "region")
    )


def fx_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_CALLS, events=_table(spark, sf_dir, "events"))


def fx_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_RESPONSES, fx_quotes=fx_quotes(spark, sf_dir))
