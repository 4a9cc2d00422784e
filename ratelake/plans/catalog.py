"""Every operator as a query over the supplied tables: name -> (spark, sf_dir) -> DataFrame.

Inputs are whole tables through the views of ``views.py``.  Doubles are rounded to nine places in
the result only, so that both engines' summation orders compare equal.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.config import EngineConfig
from ratelake.functions.columns import double_map, epoch_second, strip_prefix
from ratelake.operators import consensus as cons
from ratelake.operators import dq, fact, hot, marts, normalize, quota, silver, staging
from ratelake.operators.ranking import first_per_key
from ratelake.plans import views
from ratelake.plans.runs import FACT, HOT, QUARANTINE, RateJobs
from ratelake.session import prepare, scratch_path
from ratelake.sources import hot_table, landing, seeds, tables
from ratelake.streaming import quota_stream, silver_stream

CFG = EngineConfig(top_currencies=views.MATRIX_CODES)
CYCLE = 7 * 86_400
AS_OF = datetime(2024, 2, 1, 12, 30)
RUN_DAY = date(2024, 1, 20)
SOURCE_STAGING_KEYS = ("source", *staging.STAGING_KEYS)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir.rstrip("/"))

        _QUERIES[name] = run
        return run

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def r9(c: Column | str, name: str | None = None) -> Column:
    name = name or c
    return F.round(F.col(c) if isinstance(c, str) else c, 9).alias(name)


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles of a result to nine places; load times are left out."""
    return df.select(
        *[
            r9(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
            for f in df.schema.fields
            if f.name not in ("dbt_loaded_at", "synced_at")
        ]
    )


# -- shared inputs ----------------------------------------------------------------------------


def _stg(spark, sf_dir) -> DataFrame:
    """Staging rows of all sources, straight from the quotes."""
    return staging.stage_quotes(views.fx_quotes(spark, sf_dir), SOURCE_STAGING_KEYS)


def _records(spark, sf_dir) -> DataFrame:
    """Landed records with their rate map."""
    return silver.rebuild_map(views.fx_landed_wide(spark, sf_dir))


def _silver(spark, sf_dir) -> DataFrame:
    return silver.dedup_latest(_records(spark, sf_dir))


def _consensus(spark, sf_dir) -> DataFrame:
    return cons.build_consensus([_stg(spark, sf_dir)])


def _fact(spark, sf_dir) -> DataFrame:
    """Consensus and pick fused, so the quotes are scanned once."""
    return fact.validate_and_pick([_stg(spark, sf_dir)])


def _both(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(staging, consensus, fact) over staging rows that are written first, as a run does."""
    path = scratch_path(spark, "staging")
    _stg(spark, sf_dir).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows, cons.build_consensus([rows]), fact.validate_and_pick([rows])


def _newest_day(spark, sf_dir) -> Column:
    """Newest date of the daily series, from its one source column."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.agg(F.max(F.col("l_shipdate").cast("date"))).scalar()


def _long(records: DataFrame) -> DataFrame:
    return staging.unnest_rates(records).select(
        "extraction_id", "source", "base_currency", "rate_date", "target_currency",
        r9("exchange_rate"),
    )


def _snapshot_responses(spark, sf_dir) -> DataFrame:
    """JSON bodies, one per (source, base, date, slot), built from the landed rates.

    A body lists at most one entry per currency.  Base and date are left out now and then, so the
    fallbacks are used; the third source has prefixed keys and an epoch.
    """
    rates = views.fx_landed_long(spark, sf_dir)
    prefixed = F.col("source") == "currencylayer"
    key = F.when(prefixed, F.concat("base_currency", "target_currency")).otherwise(
        F.col("target_currency")
    )
    grouped = rates.groupBy("source", "base_currency", "rate_date", "slot").agg(
        F.max("ts").alias("extraction_timestamp"),
        F.map_from_entries(
            F.collect_list(
                F.when(
                    F.col("exchange_rate").isNotNull(), F.struct(key.alias("k"), "exchange_rate")
                )
            )
        ).alias("m"),
    )
    default = F.when(F.col("source") == "frankfurter", "EUR").otherwise("USD")
    base = F.when((F.col("slot") == 3) & (F.col("base_currency") == default), None).otherwise(
        F.col("base_currency")
    )
    day = F.when(F.col("slot") == 2, None).otherwise(F.col("rate_date").cast("string"))
    empty = F.size("m") == 0
    first_two = F.to_json(
        F.struct(base.alias("base"), day.alias("date"), F.when(~empty, F.col("m")).alias("rates"))
    )
    third = F.to_json(
        F.struct(
            F.lit(True).alias("success"),
            base.alias("source"),
            day.alias("date"),
            F.unix_timestamp(F.col("extraction_timestamp").cast("timestamp")).alias("timestamp"),
            F.when(~empty, F.col("m")).alias("quotes"),
        )
    )
    return grouped.select(
        "source",
        F.when(prefixed, third).otherwise(first_two).alias("body"),
        F.lit(200).alias("http_status_code"),
        "extraction_timestamp",
    )


def _range_responses(spark, sf_dir) -> DataFrame:
    """Historical bodies ``{date: {currency: rate}}``, one per source, base and week."""
    prefixed = F.col("source") == "currencylayer"
    key = F.when(prefixed, F.concat("base_currency", "target_currency")).otherwise(
        F.col("target_currency")
    )
    per_day = (
        _stg(spark, sf_dir)
        .groupBy("source", "base_currency", "rate_date")
        .agg(
            F.map_from_entries(F.collect_list(F.struct(key.alias("k"), "exchange_rate"))).alias("m")
        )
    )
    per_week = per_day.groupBy(
        "source", "base_currency", F.trunc("rate_date", "week").alias("week")
    ).agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("rate_date").cast("string").alias("d"), "m"))
        ).alias("days")
    )
    body = F.when(
        prefixed,
        F.to_json(F.struct(F.lit(True).alias("success"),
                           F.col("base_currency").alias("source"), F.col("days").alias("quotes"))),
    ).otherwise(F.to_json(F.struct(F.col("base_currency").alias("base"),
                                   F.col("days").alias("rates"))))
    return per_week.select(
        "source",
        body.alias("body"),
        F.lit(200).alias("http_status_code"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("extraction_timestamp"),
    )


# -- response normalisation -------------------------------------------------------------------


def _landed_rows(landed: DataFrame) -> DataFrame:
    return (
        landed.select(
            "extraction_id", "source", "source_tier", "base_currency", "rate_date",
            "http_status_code", F.explode("rates").alias("target_currency", "exchange_rate"),
        )
        .withColumn("exchange_rate", F.round("exchange_rate", 9))
    )


@query("norm_snapshot")
def _q(spark, sf_dir):
    return _landed_rows(normalize.normalize_snapshot(_snapshot_responses(spark, sf_dir)))


@query("norm_range_explode")
def _q(spark, sf_dir):
    return _landed_rows(normalize.explode_range(_range_responses(spark, sf_dir)))


@query("norm_strip_base_prefix")
def _q(spark, sf_dir):
    base = F.col("base_currency")
    quoted = F.create_map(
        F.concat(base, F.col("target_currency")), F.col("exchange_rate"),
        F.concat(base, base), F.lit(1.0),
    )
    stripped = strip_prefix(quoted, base)
    return views.fx_quotes(spark, sf_dir).select(
        "extraction_id", F.explode(stripped).alias("code", "rate")
    ).select("extraction_id", "code", r9("rate"))


@query("norm_cast_rates")
def _q(spark, sf_dir):
    texts = F.create_map(
        F.lit("rate"), F.col("exchange_rate").cast("string"),
        F.lit("whole"), F.col("user_id").cast("string"),
        F.lit("broken"), F.lit("n/a"),
    )
    return views.fx_quotes(spark, sf_dir).select(
        "extraction_id", F.explode(double_map(texts)).alias("code", "rate")
    ).select("extraction_id", "code", r9("rate"))


@query("norm_rate_date")
def _q(spark, sf_dir):
    kind = F.col("user_id") % 3
    text = F.when(kind == 0, F.date_sub("rate_date", 1).cast("string"))
    epoch = F.when(
        kind == 1,
        F.unix_timestamp(F.col("extraction_timestamp").cast("timestamp")) - 2 * 86_400,
    )
    return views.fx_quotes(spark, sf_dir).select(
        "extraction_id",
        normalize.rate_date(text, epoch, F.col("extraction_timestamp")).alias("rate_date"),
    )


@query("norm_extraction_id")
def _q(spark, sf_dir):
    return views.fx_quotes(spark, sf_dir).select(
        "event_id",
        normalize.snapshot_id().alias("snapshot_id"),
        normalize.range_id().alias("range_id"),
    )


@query("norm_classify_response")
def _q(spark, sf_dir):
    tagged = normalize.classify_response(views.fx_responses(spark, sf_dir))
    return tagged.select("extraction_id", "source", "http_status_code", "outcome")


@query("norm_flatten_map")
def _q(spark, sf_dir):
    records = _records(spark, sf_dir).select("extraction_id", "rates")
    return _rounded(normalize.flatten_map(records, codes=views.CODES))


def _land(spark, sf_dir, label: str) -> str:
    """The landed rates of every source as JSON files below a fresh folder, one root per source."""
    root = scratch_path(spark, label)
    wide = views.fx_landed_wide(spark, sf_dir).drop("slot")
    for s in CFG.sources:
        mine = wide.where(F.col("source") == s.name)
        for mode in ("daily", "backfill"):
            landing.land_append(mine, f"{root}/{s.name}", mode)
    return root


@query("land_append")
def _q(spark, sf_dir):
    root = scratch_path(spark, "land")
    landing.land_append(views.fx_landed_wide(spark, sf_dir).drop("slot"), root, "daily")
    lines = landing.scan_lines(spark, landing.LandingScan((f"{root}/daily",), "*.json*"))
    return _long(silver.records_from_json_lines(lines))


# -- sources and sinks ------------------------------------------------------------------------


@query("scan_jsonl_union")
def _q(spark, sf_dir):
    root = scratch_path(spark, "union")
    landing.land_append(views.fx_landed_wide(spark, sf_dir).drop("slot"), root, "daily")
    wide = landing.scan_jsonl_union(spark, f"{root}/daily", recursive=True)
    records = silver.rebuild_map(wide.withColumn("rate_date", F.col("rate_date").cast("date")))
    return _long(records)


@query("scan_or_empty")
def _q(spark, sf_dir):
    """Only one source has landed; the others come back empty with the same columns."""
    root = scratch_path(spark, "or-empty")
    wide = views.fx_landed_wide(spark, sf_dir).drop("slot")
    landing.land_append(wide.where("source = 'frankfurter'"), f"{root}/frankfurter", "daily")
    columns = "extraction_id string, source string, base_currency string, rate_date date"
    return reduce(
        DataFrame.unionByName,
        [
            landing.scan_or_empty(spark, f"{root}/{s.name}/daily/*/*/*/*.json*", columns)
            for s in CFG.sources
        ],
    )


@query("resolve_landing_paths")
def _q(spark, sf_dir):
    root = _land(spark, sf_dir, "resolve")
    found = []
    for s in CFG.sources:
        scan = landing.resolve_landing(
            spark, f"{root}/{s.name}", "backfill", date(2024, 1, 1)
        )
        found.append(silver.records_from_json_lines(landing.scan_lines(spark, scan)))
    return _long(reduce(DataFrame.unionByName, found))


@query("scan_latest_version")
def _q(spark, sf_dir):
    store = tables.RateTables(spark, scratch_path(spark, "versions"))
    rows = _stg(spark, sf_dir).select(*SOURCE_STAGING_KEYS, "exchange_rate")
    store.overwrite("rates", rows, "rate_date")
    store.overwrite("rates", rows.withColumn("exchange_rate", F.col("exchange_rate") * 2),
                    "rate_date")
    return _rounded(store.read("rates"))


@query("scan_seed_csv")
def _q(spark, sf_dir):
    path = scratch_path(spark, "seed")
    views.fx_dim(spark, sf_dir).write.csv(path, header=True)
    return seeds.scan_seed_csv(spark, path)


@query("version_registry")
def _q(spark, sf_dir):
    entries = views.fx_quotes(spark, sf_dir).select(
        F.col("source").alias("table_name"),
        F.col("base_currency").alias("slice"),
        F.col("extraction_id").alias("location"),
        F.col("event_id").alias("version"),
        F.col("extraction_timestamp").alias("updated_at"),
    )
    return first_per_key(entries, ["table_name", "slice"], [F.col("version").desc()])


def _hot_table(spark, sf_dir) -> hot_table.HotTable:
    """The stored hot table over every date, as a run's sync writes it, sorted for lookups.

    Written twice, which must change nothing.  Rates at nine places as in the oracle.
    """
    rates = _fact(spark, sf_dir).withColumns(
        {c: F.round(c, 9) for c in ("exchange_rate", "inverse_rate")}
    )
    dim = marts.dim_countries(views.fx_dim(spark, sf_dir))
    with_pair = marts.with_country(rates, dim).select(
        "rate_date", "base_currency", "target_currency", "country_name", "region",
        "exchange_rate", "inverse_rate", "consensus_variance", "validation_status",
        "currency_pair",
    )
    store = hot_table.HotTable(tables.RateTables(spark, scratch_path(spark, "hot")), HOT)
    items = hot.to_hot_items(with_pair, AS_OF)
    for _ in range(2):
        store.sync(items)
        items = store.tables.read(HOT)
    return store


def _as_text(items: DataFrame) -> DataFrame:
    """Decimals of hot items as their text, so that the conversion itself is compared."""
    return items.withColumns({c: F.col(c).cast("string") for c in hot.NUMERIC}).drop("synced_at")


@query("hot_upsert")
def _q(spark, sf_dir):
    items = _hot_table(spark, sf_dir).tables.read(HOT)
    return _as_text(items.where(F.col("rate_date") == items.agg(F.max("rate_date")).scalar()))


@query("hot_get")
def _q(spark, sf_dir):
    return _as_text(_hot_table(spark, sf_dir).get("USD/C07", date(2024, 1, 15)))


@query("hot_lookup")
def _q(spark, sf_dir):
    found = _hot_table(spark, sf_dir).lookup("currency_pair", "USD/C07", ascending=False, limit=10)
    return _as_text(found)


@query("hot_lookup_by_target")
def _q(spark, sf_dir):
    found = _hot_table(spark, sf_dir).lookup("target_currency", "C03", date(2024, 1, 5), date(2024, 1, 25))
    return _as_text(found)


@query("preview_topn")
def _q(spark, sf_dir):
    return _rounded(hot.preview(_fact(spark, sf_dir), 10, "extraction_id"))


# -- silver -----------------------------------------------------------------------------------


@query("silver_discover_rate_cols")
def _q(spark, sf_dir):
    """Quotes per discovered column; a column that only looks like one is not discovered."""
    wide = views.fx_landed_wide(spark, sf_dir).withColumn("ratesXYeur", F.lit(1.0))
    found = silver.discover_rate_columns(wide)
    counts = wide.agg(*[F.count(c).alias(c) for c in found])
    entries = F.array(*[F.struct(F.lit(c).alias("rate_column"), F.col(c).alias("quotes"))
                        for c in found])
    return counts.select(F.inline(entries))


@query("silver_null_profile")
def _q(spark, sf_dir):
    return silver.null_profile(views.fx_landed_wide(spark, sf_dir))


@query("silver_null_profile_lines")
def _q(spark, sf_dir):
    """As above from landed lines, with one more currency that is NULL in every record."""
    root = scratch_path(spark, "null-lines")
    wide = views.fx_landed_wide(spark, sf_dir).drop("slot")
    landing.land_append(wide.withColumn("rates__zzz", F.lit(None).cast("double")), root, "daily")
    lines = landing.scan_lines(spark, landing.LandingScan((f"{root}/daily",), "*.json*"))
    return silver.null_profile_of_lines(lines)


@query("silver_rebuild_map")
def _q(spark, sf_dir):
    return _long(_records(spark, sf_dir))


@query("silver_date_window")
def _q(spark, sf_dir):
    kept = silver.date_window(_records(spark, sf_dir), "daily", RUN_DAY.isoformat())
    return kept.select("extraction_id", "rate_date")


@query("silver_date_window_backfill")
def _q(spark, sf_dir):
    kept = silver.date_window(_records(spark, sf_dir), "backfill", "2024-01-10", "2024-01-12")
    return kept.select("extraction_id", "rate_date")


@query("silver_valid_map_keys")
def _q(spark, sf_dir):
    marked = F.create_map(
        F.when(F.col("user_id") % 4 == 0, "").otherwise(F.col("target_currency")),
        F.col("user_id").cast("double"),
    )
    quotes = views.fx_quotes(spark, sf_dir).select("extraction_id", marked.alias("rates"))
    dropped = silver.drop_bad_rows(quotes).select("extraction_id", F.lit("row").alias("by"),
                                                  F.explode("rates").alias("code", "rate"))
    cleaned = silver.clean_map_keys(quotes).select("extraction_id", F.lit("entry").alias("by"),
                                                   F.explode("rates").alias("code", "rate"))
    return dropped.unionByName(cleaned)


@query("silver_dedup_latest")
def _q(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "rate_date", "source", "base_currency", "extraction_id", "extraction_timestamp"
    )


@query("silver_evolve_schema")
def _q(spark, sf_dir):
    rows = _stg(spark, sf_dir)
    old = rows.where(F.col("rate_date") < F.lit(RUN_DAY)).select("extraction_id", "exchange_rate")
    new = rows.where(F.col("rate_date") >= F.lit(RUN_DAY)).select(
        "extraction_id", "exchange_rate", "source_tier"
    )
    return _rounded(silver.evolve_union(old, new))


@query("silver_create_if_missing")
def _q(spark, sf_dir):
    store = tables.RateTables(spark, scratch_path(spark, "create"))
    batch = silver.build_silver(_records(spark, sf_dir).drop("slot"), "backfill", "1970-01-01",
                                "2999-12-31")
    store.upsert("rates", batch, silver.SILVER_KEYS)
    return _long(store.read("rates"))


@query("keyed_upsert")
def _q(spark, sf_dir):
    store = tables.RateTables(spark, scratch_path(spark, "upsert"))
    rows = _stg(spark, sf_dir).select(*SOURCE_STAGING_KEYS, "exchange_rate")
    store.upsert("rates", rows, SOURCE_STAGING_KEYS)
    revised = rows.where(F.col("rate_date") >= F.lit(RUN_DAY)).withColumn(
        "exchange_rate", F.col("exchange_rate") * 3
    )
    store.upsert("rates", revised, SOURCE_STAGING_KEYS)
    return _rounded(store.read("rates"))


# -- staging ----------------------------------------------------------------------------------


@query("stg_filter_execution_date")
def _q(spark, sf_dir):
    return staging.filter_execution_date(_silver(spark, sf_dir), RUN_DAY).select(
        "extraction_id", "rate_date"
    )


@query("stg_incremental_watermark")
def _q(spark, sf_dir):
    rows = _silver(spark, sf_dir).select("extraction_id", "rate_date")
    loaded = rows.where(F.col("rate_date") <= F.lit(RUN_DAY)).agg(F.max("rate_date")).first()[0]
    return staging.incremental_watermark(rows, "daily", loaded)


@query("stg_unnest_rates")
def _q(spark, sf_dir):
    return _long(_silver(spark, sf_dir))


@query("stg_dedup_pair")
def _q(spark, sf_dir):
    quotes = views.fx_quotes(spark, sf_dir).select(*staging.QUOTE_COLUMNS)
    newest = staging.dedup_pair(quotes, SOURCE_STAGING_KEYS)
    return newest.select(*SOURCE_STAGING_KEYS, "extraction_id", r9("exchange_rate"))


@query("stg_project")
def _q(spark, sf_dir):
    quotes = views.fx_quotes(spark, sf_dir).withColumn(
        "target_currency", F.concat(F.lit("rates__"), F.lower("target_currency"))
    )
    return _rounded(staging.project_staging(staging.positive_rates(quotes)))


@query("stg_positive_filter")
def _q(spark, sf_dir):
    quotes = views.fx_quotes(spark, sf_dir).select(*staging.QUOTE_COLUMNS)
    newest = staging.dedup_pair(quotes, SOURCE_STAGING_KEYS)
    return staging.positive_rates(newest).select(*SOURCE_STAGING_KEYS, "extraction_id")


@query("stg_full")
def _q(spark, sf_dir):
    records = _records(spark, sf_dir)
    per_source = [
        staging.build_staging(
            records.where(F.col("source") == s.name), "daily", RUN_DAY, CFG.lookback_days
        )
        for s in CFG.sources
    ]
    return _rounded(reduce(DataFrame.unionByName, per_source))


# -- consensus --------------------------------------------------------------------------------


def _rates(spark, sf_dir) -> DataFrame:
    return cons.union_sources([_stg(spark, sf_dir)])


@query("cons_union_sources")
def _q(spark, sf_dir):
    return _rounded(_rates(spark, sf_dir))


@query("cons_median")
def _q(spark, sf_dir):
    wide = cons.pivot_rates(_rates(spark, sf_dir))
    return wide.select(*cons.CONSENSUS_KEYS, r9("consensus_rate"), "source_count")


@query("cons_breakdown")
def _q(spark, sf_dir):
    wide = cons.pivot_rates(_rates(spark, sf_dir))
    return wide.select(*cons.CONSENSUS_KEYS, cons.source_breakdown().alias("source_breakdown"))


@query("cons_pivot_rates")
def _q(spark, sf_dir):
    return _rounded(cons.pivot_rates(_rates(spark, sf_dir)))


@query("cons_deviation")
def _q(spark, sf_dir):
    wide = cons.add_deviations(cons.pivot_rates(_rates(spark, sf_dir)))
    return _rounded(
        wide.select(*cons.CONSENSUS_KEYS, "frank_dev", "er_dev", "cl_dev", "variance_pct")
    )


@query("cons_flag")
def _q(spark, sf_dir):
    return cons.score_consensus(_rates(spark, sf_dir)).select(
        *cons.CONSENSUS_KEYS, "status", "severity"
    )


@query("cons_incremental")
def _q(spark, sf_dir):
    covered = cons.consensus_window(
        _rates(spark, sf_dir), "daily", RUN_DAY, CFG.lookback_days, date(2024, 1, 21)
    )
    return _rounded(cons.pivot_rates(covered))


@query("cons_full")
def _q(spark, sf_dir):
    return _rounded(_consensus(spark, sf_dir))


# -- fact -------------------------------------------------------------------------------------

LINEAGE = (
    *fact.FACT_KEYS, "extraction_id", "extraction_timestamp", "currency_pair", "source",
    "source_tier", "exchange_rate", "inverse_rate",
)


@query("fact_latest_per_source")
def _q(spark, sf_dir):
    return _rounded(fact.latest_per_source(_stg(spark, sf_dir)))


@query("fact_key_universe")
def _q(spark, sf_dir):
    return fact.key_universe(fact.latest_per_source(_stg(spark, sf_dir)))


@query("fact_priority_coalesce")
def _q(spark, sf_dir):
    return _rounded(
        fact.priority_pick(fact.latest_per_source(_stg(spark, sf_dir))).select(*LINEAGE)
    )


@query("fact_priority_backfill")
def _q(spark, sf_dir):
    picked = fact.priority_pick(
        fact.latest_per_source(_stg(spark, sf_dir)), CFG.by_priority("backfill")
    )
    return _rounded(picked.select(*LINEAGE))


@query("fact_exclude_anomalies")
def _q(spark, sf_dir):
    rows, flagged, _ = _both(spark, sf_dir)
    kept = fact.exclude_anomalies(rows, flagged)
    return _rounded(kept.select(*SOURCE_STAGING_KEYS, "extraction_id", "exchange_rate"))


@query("fact_lookback")
def _q(spark, sf_dir):
    rows = _stg(spark, sf_dir)
    newest = rows.agg(F.max("rate_date")).first()[0]
    return fact.fact_lookback(rows, "daily", newest_loaded=newest).select(
        *SOURCE_STAGING_KEYS, "extraction_id"
    )


@query("fact_full")
def _q(spark, sf_dir):
    """As a run does it: the consensus is a table of its own."""
    rows, flagged, _ = _both(spark, sf_dir)
    return _rounded(fact.build_fact([rows], flagged))


@query("fact_fused")
def _q(spark, sf_dir):
    return _rounded(_fact(spark, sf_dir))


# -- dimension and marts ----------------------------------------------------------------------


@query("dim_countries")
def _q(spark, sf_dir):
    seed = views.fx_dim(spark, sf_dir).withColumn("currency_code", F.lower("currency_code"))
    return marts.dim_countries(seed)


@query("mart_latest_rates")
def _q(spark, sf_dir):
    dim = marts.dim_countries(views.fx_dim(spark, sf_dir))
    mart = marts.mart_latest_rates(_fact(spark, sf_dir), dim)
    return _rounded(marts.in_order(mart, "mart_latest_rates"))


@query("mart_moving_average")
def _q(spark, sf_dir):
    return _rounded(marts.rate_analysis(views.fx_series(spark, sf_dir)).drop("daily_change"))


@query("mart_daily_change")
def _q(spark, sf_dir):
    return _rounded(marts.rate_analysis(views.fx_series(spark, sf_dir)).drop("ma_7_day"))


@query("mart_rate_analysis_incremental")
def _q(spark, sf_dir):
    series = views.fx_series(spark, sf_dir)
    newest = spark.range(1).select(_newest_day(spark, sf_dir)).first()[0]
    return _rounded(
        marts.rate_analysis_incremental(series, "daily", newest_loaded=newest - timedelta(days=30))
    )


@query("mart_cross_rates")
def _q(spark, sf_dir):
    mart = marts.cross_rates(
        views.fx_series(spark, sf_dir), CFG.top_currencies, newest=_newest_day(spark, sf_dir)
    )
    return _rounded(marts.in_order(mart, "mart_currency_conversions"))


MONTH_KEYS = ("month", "year", "month_num", "target_currency")


@query("mart_monthly_stats")
def _q(spark, sf_dir):
    series = views.fx_series(spark, sf_dir)
    mart = marts.monthly_summary(series, _newest_day(spark, sf_dir))
    return _rounded(
        marts.in_order(mart, "mart_monthly_summary").drop("opening_rate", "closing_rate")
    )


@query("mart_monthly_open_close")
def _q(spark, sf_dir):
    series = views.fx_series(spark, sf_dir)
    mart = marts.monthly_summary(series, _newest_day(spark, sf_dir))
    return _rounded(mart.select(*MONTH_KEYS, "opening_rate", "closing_rate"))


@query("mart_lag_returns")
def _q(spark, sf_dir):
    metrics = marts.volatility_metrics(views.fx_series(spark, sf_dir))
    return _rounded(metrics.drop("volatility_7d", "volatility_30d"))


@query("mart_rolling_stddev")
def _q(spark, sf_dir):
    metrics = marts.volatility_metrics(views.fx_series(spark, sf_dir))
    return _rounded(
        metrics.select("rate_date", "target_currency", "volatility_7d", "volatility_30d")
    )


@query("mart_risk_level")
def _q(spark, sf_dir):
    series = views.fx_series(spark, sf_dir)
    mart = marts.rate_volatility(series, _newest_day(spark, sf_dir))
    return _rounded(marts.in_order(mart, "mart_rate_volatility"))


@query("mart_health")
def _q(spark, sf_dir):
    _, flagged, rates = _both(spark, sf_dir)
    return _rounded(marts.health_metrics(rates, flagged, AS_OF))


@query("hot_latest_slice")
def _q(spark, sf_dir):
    """From a stored fact: only the slice of its newest date is read."""
    dim = marts.dim_countries(views.fx_dim(spark, sf_dir))
    store = tables.RateTables(spark, scratch_path(spark, "latest"))
    store.overwrite(FACT, _fact(spark, sf_dir), "rate_date")
    newest = store.newest_date(FACT)
    rates = store.read(FACT, schemas.FACT, newest, newest)
    return _rounded(marts.hot_latest_slice(rates, dim, newest))


# -- data quality -----------------------------------------------------------------------------


@query("dq_not_null")
def _q(spark, sf_dir):
    columns = ("extraction_id", "exchange_rate", "rate_date", "target_currency")
    return dq.row_checks(views.fx_quotes(spark, sf_dir), [dq.not_null(c) for c in columns])


@query("dq_accepted_values")
def _q(spark, sf_dir):
    return dq.row_checks(
        views.fx_quotes(spark, sf_dir),
        [
            dq.accepted_values("base_currency", ["USD"]),
            dq.accepted_values("source", ["frankfurter", "exchangerate"]),
        ],
    )


@query("dq_unique_combination")
def _q(spark, sf_dir):
    quotes = views.fx_quotes(spark, sf_dir)
    return dq.report(
        dq.unique_combination(quotes, SOURCE_STAGING_KEYS),
        dq.unique_combination(_stg(spark, sf_dir), SOURCE_STAGING_KEYS),
    )


@query("dq_expression_true")
def _q(spark, sf_dir):
    return dq.row_checks(
        views.fx_quotes(spark, sf_dir),
        [
            dq.expression_true("exchange_rate", "> 0"),
            dq.expression_true("exchange_rate", "< 12.5"),
        ],
    )


@query("dq_contract")
def _q(spark, sf_dir):
    return dq.contract_violations(_fact(spark, sf_dir))


@query("dq_contract_enforced")
def _q(spark, sf_dir):
    return _rounded(dq.enforce_contract(_fact(spark, sf_dir)).select(*LINEAGE))


@query("dq_recency")
def _q(spark, sf_dir):
    rates = _fact(spark, sf_dir)
    return dq.report(
        dq.recency(rates, "rate_date", AS_OF, 7), dq.recency(rates, "rate_date", AS_OF, 0)
    )


@query("dq_row_count")
def _q(spark, sf_dir):
    _, flagged, rates = _both(spark, sf_dir)
    health = marts.health_metrics(rates, flagged, AS_OF)
    return dq.report(
        dq.row_count_equals(health, 1), dq.row_count_equals(views.fx_series(spark, sf_dir), 1)
    )


@query("dq_min_distinct")
def _q(spark, sf_dir):
    series = views.fx_series(spark, sf_dir)
    return dq.report(
        dq.min_distinct(series, "target_currency", 10),
        dq.min_distinct(series, "target_currency", 100),
    )


@query("dq_severity")
def _q(spark, sf_dir):
    ok = views.fx_quotes(spark, sf_dir).agg(
        F.round(F.count_if(F.col("exchange_rate").isNotNull()) / F.count(F.lit(1)), 4).alias(
            "ok_rate"
        ),
        F.count_distinct("target_currency").cast("double").alias("currency_count"),
    )
    return dq.report(
        dq.severity(ok, "ok_rate", 0.90, 0.80), dq.severity(ok, "currency_count", 100, 0)
    )


@query("dq_declared_suites")
def _q(spark, sf_dir):
    rows, flagged, rates = _both(spark, sf_dir)
    name = F.lit(None).cast("string")
    for source in CFG.sources:
        name = F.when(F.col("source") == source.name, source.staging_table).otherwise(name)
    return dq.tagged_suites(rows.withColumn("table", name), flagged, rates, CFG.sources)


# -- quota ------------------------------------------------------------------------------------


def _cycles(spark, sf_dir) -> DataFrame:
    return quota.assign_cycles(views.fx_calls(spark, sf_dir), CYCLE)


def _usage(spark, sf_dir) -> DataFrame:
    calls = views.fx_calls(spark, sf_dir)
    return quota.quota_usage(
        _cycles(spark, sf_dir), calls.agg(F.max("called_at")).scalar(), cycle_seconds=CYCLE
    )


@query("quota_cycles")
def _q(spark, sf_dir):
    return _cycles(spark, sf_dir).select("api_source", "cycle_start", "cycle_end",
                                         "request_count")


@query("quota_usage")
def _q(spark, sf_dir):
    return _usage(spark, sf_dir)


@query("quota_status")
def _q(spark, sf_dir):
    wanted = views.fx_calls(spark, sf_dir).select("api_source").unionByName(
        views.fx_dim(spark, sf_dir).select(F.col("region").alias("api_source"))
    )
    return quota.quota_status(_usage(spark, sf_dir), wanted)


@query("quota_failover")
def _q(spark, sf_dir):
    return quota.quota_failover(_usage(spark, sf_dir))


@query("source_gating")
def _q(spark, sf_dir):
    status = quota.quota_status(_usage(spark, sf_dir))
    runs = (("daily", False), ("daily", True), ("backfill", False))
    return reduce(
        DataFrame.unionByName,
        [
            quota.source_gating(status, mode, third).select(
                F.lit(mode).alias("mode"), F.lit(third).alias("include_third"), "*"
            )
            for mode, third in runs
        ],
    )


# -- runs and streams -------------------------------------------------------------------------


def _jobs(spark, sf_dir, label: str) -> RateJobs:
    return RateJobs(
        spark,
        tables.RateTables(spark, scratch_path(spark, f"{label}-tables")),
        _land(spark, sf_dir, f"{label}-landing"),
        CFG,
        seed=views.fx_dim(spark, sf_dir),
        as_of=AS_OF,
    )


@query("daily_run")
def _q(spark, sf_dir):
    jobs = _jobs(spark, sf_dir, "daily")
    jobs.run_daily(RUN_DAY, include_third=True)
    return _rounded(jobs.tables.read(FACT, schemas.FACT))


@query("backfill_run")
def _q(spark, sf_dir):
    jobs = _jobs(spark, sf_dir, "backfill")
    jobs.run_backfill(date(2024, 1, 1), date(2024, 1, 31))
    return _rounded(jobs.tables.read(FACT, schemas.FACT))


def _response_jobs(spark, sf_dir, label: str, responses: DataFrame) -> RateJobs:
    """Jobs whose landing area was filled from raw responses."""
    jobs = RateJobs(
        spark,
        tables.RateTables(spark, scratch_path(spark, f"{label}-tables")),
        scratch_path(spark, f"{label}-landing"),
        CFG,
        seed=views.fx_dim(spark, sf_dir),
        as_of=AS_OF,
    )
    jobs.land(responses)
    return jobs


def _raw_responses(spark, sf_dir) -> DataFrame:
    return views.fx_responses(spark, sf_dir).select(
        "source", "body", "http_status_code", "extraction_timestamp"
    )


@query("land_responses")
def _q(spark, sf_dir):
    """Landed records per source and day of all raw responses."""
    jobs = _response_jobs(spark, sf_dir, "land-responses", _raw_responses(spark, sf_dir))
    lines = [
        landing.scan_lines(
            spark, landing.LandingScan((f"{jobs.landing_root}/{s.name}/daily",), "*.json*")
        )
        for s in CFG.sources
    ]
    records = silver.records_from_json_lines(reduce(DataFrame.unionByName, lines))
    return staging.unnest_rates(records).groupBy("source", "rate_date", "target_currency").agg(
        F.count(F.lit(1)).alias("records"), r9(F.sum("exchange_rate"), "total_rate")
    )


@query("quarantine_responses")
def _q(spark, sf_dir):
    """Every third response comes twice."""
    raw = _raw_responses(spark, sf_dir)
    again = raw.where(F.pmod(F.second("extraction_timestamp"), F.lit(3)) == 0)
    jobs = _response_jobs(spark, sf_dir, "quarantine", raw.unionByName(again))
    return jobs.tables.read(QUARANTINE).groupBy("source", "outcome", "http_status_code").agg(
        F.sum("responses").alias("responses")
    )


@query("load_report")
def _q(spark, sf_dir):
    """What a daily run says of the lines it read: those outside its dates and with broken dates, too."""
    wide = views.fx_landed_wide(spark, sf_dir).drop("slot")
    jobs = RateJobs(
        spark, tables.RateTables(spark, scratch_path(spark, "report-tables")), scratch_path(spark, "report-landing"), CFG, as_of=AS_OF
    )
    for source in CFG.sources:
        mine = wide.where((F.col("source") == source.name) & (F.col("base_currency") == "USD"))
        # All files lie in the folder of the run's day; records of every fifth day have no date, of every seventh another source.
        day = F.dayofmonth("rate_date")
        mine = mine.withColumns({
            "source": F.when(day % 7 == 0, "elsewhere").otherwise(F.col("source")),
            "rate_date": F.when(day % 5 != 0, F.col("rate_date")),
            "landed_on": F.lit(RUN_DAY).cast("date"),
        })
        landing.land_append(mine, f"{jobs.landing_root}/{source.name}", "daily", "landed_on")
        jobs.load_silver(source, "daily", RUN_DAY, AS_OF.date())
    return jobs.load_report().drop("mode")

@query("pipeline_daily")
def _q(spark, sf_dir):
    """From responses to the hot table in one run, the second source out of quota."""
    responses = _snapshot_responses(spark, sf_dir)
    jobs = _response_jobs(spark, sf_dir, "pipeline-daily", responses)
    # As many calls of the second source as it has quota, taken from the call log.
    calls = views.fx_calls(spark, sf_dir).select(
        F.lit("exchangerate").alias("api_source"),
        (F.lit(AS_OF).cast("timestamp_ntz") - F.expr("make_dt_interval(0, 1)")).alias("called_at"),
    )
    jobs.run_daily(RUN_DAY, calls=calls)
    return _rounded(jobs.tables.read(FACT, schemas.FACT).drop("extraction_id"))


@query("pipeline_backfill")
@query("backfill_run_months")
def _q(spark, sf_dir):
    """The daily series landed day by day over years, backfilled across a turn of the year."""
    series = views.fx_series(spark, sf_dir)
    source = CFG.source("frankfurter")
    records = series.groupBy("rate_date", "base_currency").agg(
        F.map_from_entries(F.collect_list(F.struct("target_currency", "exchange_rate"))).alias("m")
    ).select(
        F.concat(F.lit("fr_"), F.col("rate_date").cast("string")).alias("extraction_id"),
        F.col("rate_date").cast("timestamp_ntz").alias("extraction_timestamp"),
        F.lit(source.name).alias("source"),
        F.lit(source.landed_tier).alias("source_tier"),
        "base_currency",
        "rate_date",
        F.lit(200).alias("http_status_code"),
        F.col("m").alias("rates"),
    )
    jobs = RateJobs(
        spark,
        tables.RateTables(spark, scratch_path(spark, "months-tables")),
        scratch_path(spark, "months-landing"),
        CFG,
        seed=views.fx_dim(spark, sf_dir),
        as_of=AS_OF,
    )
    landing.land_append(
        normalize.flatten_map(records, codes=views.CODES),
        f"{jobs.landing_root}/{source.name}",
        "backfill",
    )
    jobs.run_backfill(date(1996, 11, 10), date(1997, 2, 20))
    return _rounded(jobs.tables.read(FACT, schemas.FACT))


def _silver_streamed(spark, sf_dir) -> tables.RateTables:
    """Landed rates in six files, one a micro-batch: six days each, and the first file twice.

    The last quarter of each day comes as if two days later.  The last file also brings records of
    early days, every eleventh one, under a new id: too late to be loaded.
    """
    wide = views.fx_landed_wide(spark, sf_dir)
    days = F.date_diff("rate_date", F.lit(wide.agg(F.min("rate_date")).first()[0]))
    turn = F.least(F.floor((days + F.when(F.col("slot") == 3, 2).otherwise(0)) / 6), F.lit(4))
    late = wide.where((days % 11 == 0) & (days < 18)).withColumn("extraction_id", F.concat(F.lit("late_"), "extraction_id"))
    wide = wide.withColumn("turn", turn).unionByName(late.withColumn("turn", F.lit(4).cast("long")))
    root = scratch_path(spark, "stream-landing")
    for n in (0, 0, 1, 2, 3, 4):
        landing.write_lines(wide.where(F.col("turn") == n).drop("turn", "slot").coalesce(1), root)
    store = tables.RateTables(spark, scratch_path(spark, "stream-tables"))
    stream = silver_stream.landing_stream(spark, root, files_per_trigger=1)
    silver_stream.stream_land_to_silver(stream, store, "rates", scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return store


@query("stream_land_to_silver")
def _q(spark, sf_dir):
    return _long(_silver_streamed(spark, sf_dir).read("rates"))


@query("stream_late_records")
def _q(spark, sf_dir):
    """The side table of what came too late, beside the count that the stream kept."""
    store = _silver_streamed(spark, sf_dir)
    told = store.read("rates_batches").agg(F.sum("late").alias("late_rows"), F.count(F.lit(1)).alias("batches"))
    late = store.read("rates_late").select("extraction_id", "source", "base_currency", "rate_date")
    return late.withColumns({c: told.select(c).scalar() for c in told.columns})


def _delivered(calls: DataFrame, late: int, batches: int, path: str) -> DataFrame:
    """A stream of ``calls`` in files by time of arrival, each up to ``late`` seconds after its call."""
    arrival = epoch_second(F.col("called_at")) + F.pmod(F.xxhash64("api_source", "called_at"), F.lit(late))
    calls = calls.withColumn("arrival", arrival)
    first, last = calls.agg(F.min("arrival"), F.max("arrival")).first()
    turn = F.floor((F.col("arrival") - F.lit(first)) * batches / F.lit(last - first + 1)) if last is not None else F.lit(0)
    for n in range(batches):
        calls.where(turn == n).drop("arrival").coalesce(1).write.mode("append").parquet(path)
    stream = calls.sparkSession.readStream.schema(calls.drop("arrival").schema)
    return stream.option("maxFilesPerTrigger", 1).parquet(path)


@query("stream_quota_meter")
def _q(spark, sf_dir):
    """Calls delivered in five micro-batches, up to three days late; the running cycles are included."""
    calls = spark.sql(views.FX_CALLS, events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    stream = _delivered(calls, 3 * 86_400, 5, scratch_path(spark, "meter-calls"))
    store = tables.RateTables(spark, scratch_path(spark, "meter-tables"))
    quota_stream.stream_quota_meter(
        stream, store, scratch_path(spark, "meter-checkpoint"), CYCLE, delay="3 days"
    ).awaitTermination()
    return store.read("quota_cycles").select("api_source", "cycle_start", "request_count")
