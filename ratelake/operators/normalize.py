"""Raw API responses to landed records.

Input rows follow ``schemas.RESPONSE``.  Every step is row-wise, so a job over any number of
responses is a single map stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.config import DEFAULT_SOURCES, SourceSpec
from ratelake.functions.columns import (
    RATE_PREFIX,
    double_map,
    empty_rates,
    strip_prefix,
)

THROTTLED_STATUS = 429
QUOTA_ERROR_CODE = 104
_VERDICT = "success string, error struct<code: string>, broken string"


def _per_source(sources: Sequence[SourceSpec], value) -> Column:
    """A constant chosen by the ``source`` column."""
    out = F.lit(None)
    for spec in sources:
        out = F.when(F.col("source") == spec.name, F.lit(value(spec))).otherwise(out)
    return out


def _flagged(sources: Sequence[SourceSpec], attribute: str) -> Column:
    return F.col("source").isin([s.name for s in sources if getattr(s, attribute)])


def classify_response(
    responses: DataFrame, sources: Sequence[SourceSpec] = DEFAULT_SOURCES
) -> DataFrame:
    """Add ``outcome``: OK, THROTTLED or ERROR.

    A 429 is a throttle whatever the body; other 4xx and 5xx are errors.  One source reports
    failures inside a 200 body, where error code 104 means that its quota is used up.  The body is
    parsed once.
    """
    parsed = F.from_json("body", _VERDICT, {"columnNameOfCorruptRecord": "broken"})
    refused = _flagged(sources, "has_success_flag") & (
        F.coalesce(F.col("_v.success"), F.lit("false")) != "true"
    )
    quota_gone = F.coalesce(F.col("_v.error.code") == str(QUOTA_ERROR_CODE), F.lit(False))
    status = F.coalesce(F.col("http_status_code"), F.lit(0))
    outcome = (
        F.when(status == THROTTLED_STATUS, "THROTTLED")
        .when(~status.between(200, 399), "ERROR")
        .when(F.col("_v").isNull() | F.col("_v.broken").isNotNull(), "ERROR")
        .when(refused & quota_gone, "THROTTLED")
        .when(refused, "ERROR")
        .otherwise("OK")
    )
    return responses.withColumn("_v", parsed).withColumn("outcome", outcome).drop("_v")


def split_responses(
    responses: DataFrame, sources: Sequence[SourceSpec] = DEFAULT_SOURCES
) -> tuple[DataFrame, DataFrame]:
    """(landable, quarantined) responses."""
    tagged = classify_response(responses, sources)
    ok = F.col("outcome") == "OK"
    return tagged.where(ok).drop("outcome"), tagged.where(~ok)


def with_days(sources: Sequence[SourceSpec] = DEFAULT_SOURCES) -> Column:
    """Whether a historical response has any date: without one ``explode_range`` gives no record."""
    body = F.from_json("body", schemas.RANGE_BODY)
    days = F.when(_flagged(sources, "quotes_prefixed"), body["quotes"]).otherwise(body["rates"])
    return F.coalesce(F.size(days) > 0, F.lit(False))


def rate_date(date_text: Column, epoch: Column, extracted_at: Column) -> Column:
    """Response date, else the date of its epoch field, else the extraction date."""
    return F.coalesce(
        date_text.try_cast("date"),
        F.timestamp_seconds(epoch).cast("date"),
        extracted_at.cast("date"),
    )


def _epoch_text(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp")).cast("string")


def snapshot_id(sources: Sequence[SourceSpec] = DEFAULT_SOURCES) -> Column:
    """``<source>_yyyymmdd_hhmmss``; sources with dated ids use the range form."""
    ts = F.col("extraction_timestamp")
    plain = F.concat_ws("_", F.col("source"), F.date_format(ts, "yyyyMMdd_HHmmss"))
    return F.when(_flagged(sources, "snapshot_id_has_date"), range_id(sources)).otherwise(plain)


def range_id(sources: Sequence[SourceSpec] = DEFAULT_SOURCES) -> Column:
    """``<prefix>_<date>_<base>_<epoch second>``."""
    return F.concat_ws(
        "_",
        _per_source(sources, lambda s: s.range_id_prefix),
        F.col("rate_date").cast("string"),
        F.col("base_currency"),
        _epoch_text(F.col("extraction_timestamp")),
    )


def _clean_rates(sources: Sequence[SourceSpec]) -> Column:
    """Base prefix off where the source uses one, all values double, missing map empty."""
    raw = F.coalesce(F.col("_rates"), F.expr("cast(map() as map<string,string>)"))
    named = F.when(
        _flagged(sources, "quotes_prefixed"), strip_prefix(raw, F.col("base_currency"))
    ).otherwise(raw)
    return F.coalesce(double_map(named), empty_rates())


def _as_landed(df: DataFrame) -> DataFrame:
    return df.select(
        "extraction_id",
        F.col("extraction_timestamp").cast("timestamp_ntz").alias("extraction_timestamp"),
        "source",
        "source_tier",
        "base_currency",
        "rate_date",
        "rates",
        F.col("body").alias("api_response_raw"),
        F.col("http_status_code").cast("int").alias("http_status_code"),
        F.octet_length("body").alias("response_size_bytes"),
    )


def normalize_snapshot(
    responses: DataFrame, sources: Sequence[SourceSpec] = DEFAULT_SOURCES
) -> DataFrame:
    """One landed record per "latest" response."""
    parsed = F.from_json("body", schemas.SNAPSHOT_BODY)
    prefixed = _flagged(sources, "quotes_prefixed")
    df = (
        responses.withColumn("_b", parsed)
        .withColumn("source_tier", _per_source(sources, lambda s: s.landed_tier))
        .withColumn(
            "base_currency",
            F.coalesce(
                F.when(prefixed, F.col("_b.source")).otherwise(F.col("_b.base")),
                _per_source(sources, lambda s: s.default_base),
            ),
        )
        .withColumn(
            "rate_date",
            rate_date(F.col("_b.date"), F.col("_b.timestamp"), F.col("extraction_timestamp")),
        )
        .withColumn(
            "_rates", F.when(prefixed, F.col("_b.quotes")).otherwise(F.col("_b.rates"))
        )
        .withColumn("rates", _clean_rates(sources))
        .withColumn("extraction_id", snapshot_id(sources))
    )
    return _as_landed(df)


def explode_range(
    responses: DataFrame, sources: Sequence[SourceSpec] = DEFAULT_SOURCES
) -> DataFrame:
    """One landed record per date of a historical response ``{date: {currency: rate}}``."""
    prefixed = _flagged(sources, "quotes_prefixed")
    df = (
        responses.withColumn("_b", F.from_json("body", schemas.RANGE_BODY))
        .withColumn("source_tier", _per_source(sources, lambda s: s.landed_tier))
        .withColumn(
            "base_currency",
            F.coalesce(
                F.when(prefixed, F.col("_b.source")).otherwise(F.col("_b.base")),
                _per_source(sources, lambda s: s.default_base),
            ),
        )
        .select(
            "source", "body", "http_status_code", "extraction_timestamp", "source_tier",
            "base_currency",
            F.explode(
                F.when(prefixed, F.col("_b.quotes")).otherwise(F.col("_b.rates"))
            ).alias("_day", "_rates"),
        )
        .withColumn("rate_date", F.col("_day").try_cast("date"))
        .withColumn("rates", _clean_rates(sources))
        .withColumn("extraction_id", range_id(sources))
    )
    return _as_landed(df)


def map_codes(df: DataFrame, map_col: str = "rates") -> list[str]:
    """Distinct map keys; the result is a list of currency codes, not of rows."""
    keys = df.select(F.explode(F.map_keys(map_col)).alias("k")).distinct()
    return sorted(r.k for r in keys.toLocalIterator() if r.k)


def flatten_map(
    df: DataFrame,
    map_col: str = "rates",
    prefix: str = RATE_PREFIX,
    codes: Sequence[str] | None = None,
) -> DataFrame:
    """Map to one ``<prefix><code>`` column per currency (the landing layout).

    With the codes known this is a plain projection: no pivot, no shuffle.
    """
    codes = map_codes(df, map_col) if codes is None else codes
    wide = [
        F.try_element_at(F.col(map_col), F.lit(code)).alias(f"{prefix}{code.lower()}")
        for code in codes
    ]
    return df.select(*[c for c in df.columns if c != map_col], *wide)
