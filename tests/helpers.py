from datetime import date, datetime

from ratelake import schemas


def day(text):
    return date.fromisoformat(text)


def ts(text):
    return datetime.fromisoformat(text)


def silver_row(rate_date, rates, source="frankfurter", extracted=None, eid=None, base="USD"):
    extracted = extracted or f"{rate_date}T06:00:00"
    return (
        eid or f"{source}_{extracted}", ts(extracted), source, "primary", base, day(rate_date),
        rates, 200,
    )


def silver_frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SILVER)


def quotes(spark, *rows):
    """Rows of (source, target, date, extracted, rate), id and base filled in."""
    full = [
        (f"{src}-{target}-{at}", ts(at), src, "primary", "USD", target, rate, day(d))
        for src, target, d, at, rate in rows
    ]
    return spark.createDataFrame(
        full,
        "extraction_id string, extraction_timestamp timestamp_ntz, source string, "
        "source_tier string, base_currency string, target_currency string, "
        "exchange_rate double, rate_date date",
    )


def series(spark, *rows):
    """Fact-like rows of (target, date, rate)."""
    return spark.createDataFrame(
        [(day(d), "USD", t, r, 1 / r if r else None) for t, d, r in rows],
        "rate_date date, base_currency string, target_currency string, exchange_rate double, "
        "inverse_rate double",
    )


def rows(df, *columns):
    columns = columns or tuple(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
