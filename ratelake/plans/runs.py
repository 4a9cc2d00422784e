"""Daily and backfill runs.

A run composes the operators layer by layer.  Each layer is written before the next one reads it,
which bounds lineage and lets a failed run be repeated from the start with the same result.  The
driver handles only scalars: dates, folder names and the three gating flags.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.config import EngineConfig, SourceSpec
from ratelake.operators import consensus as cons
from ratelake.operators import dq, fact, hot, marts, normalize, quota, silver, staging
from ratelake.sources import landing, seeds
from ratelake.sources.hot_table import HotTable
from ratelake.sources.landing import PARTITIONED, LandingLayout, NoLandingData
from ratelake.sources.tables import RateTables, merge_by_key

CONSENSUS = "consensus_check"
FACT = "fact_rates_validated"
HOT = "currency_rates"
QUARANTINE = "quarantine_responses"
REPORT = "load_report"


class ChecksFailed(RuntimeError):
    """A declared check found offending rows."""


@dataclass(frozen=True)
class Window:
    """Dates a run recomputes, both ends included."""

    mode: str
    since: date
    until: date


class RateJobs:
    """The layers of one deployment: configuration, tables and landing root."""

    def __init__(
        self,
        spark: SparkSession,
        tables: RateTables,
        landing_root: str,
        cfg: EngineConfig | None = None,
        layout: LandingLayout = PARTITIONED,
        seed: DataFrame | None = None,
        as_of: datetime | None = None,
    ):
        self.spark = spark
        self.tables = tables
        self.landing_root = landing_root.rstrip("/")
        self.cfg = cfg or EngineConfig()
        self.layout = layout
        self.seed = seed if seed is not None else seeds.default_seed(spark)
        self.as_of = as_of

    def _together(self, *steps: Callable) -> list:
        """Independent steps submitted from threads of their own, so their jobs share the
        cluster; the first failure is raised."""
        with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
            running = [pool.submit(inheritable_thread_target(self.spark)(s)) for s in steps]
            return [r.result() for r in running]

    # -- layers -----------------------------------------------------------------------------

    def participating(
        self, mode: str, calls: DataFrame | None, include_third: bool
    ) -> list[SourceSpec]:
        """Sources of this run, from the call log's quota state; without a log all have quota."""
        if calls is None:
            status = self.spark.createDataFrame([], "api_source string, available boolean")
        else:
            cycles = quota.assign_cycles(calls, self.cfg.quota_cycle_seconds)
            now = F.lit(self.as_of) if self.as_of else F.current_timestamp()
            usage = quota.quota_usage(
                cycles, now, self.cfg.sources, self.cfg.quota_cycle_seconds
            )
            status = quota.quota_status(usage)
        gates = quota.source_gating(status, mode, include_third, self.cfg.sources)
        taken = {r.api_source for r in gates.where("participates").toLocalIterator()}
        return [s for s in self.cfg.by_priority() if s.name in taken]

    def land(self, responses: DataFrame, mode: str = "daily") -> None:
        """Raw responses to landed files, and what cannot land to the quarantine table.

        Usable responses are normalised (a backfill's one record per date) and appended below their
        source with the rates as they came, so new currencies need no schema.  All others are kept
        whole with their outcome and their number (``responses``), equal ones as one row; a source nobody
        configured is ``UNKNOWN``, a usable backfill response without any date is ``EMPTY``.  Landing and
        quarantine both add up to the responses.
        """
        names = [s.name for s in self.cfg.sources]
        known = F.coalesce(F.col("source").isin(names), F.lit(False))
        ok, bad = normalize.split_responses(responses.where(known), self.cfg.sources)
        if mode != "daily":
            filled = normalize.with_days(self.cfg.sources)
            bad = bad.unionByName(ok.where(~filled).withColumn("outcome", F.lit("EMPTY")))
            ok = ok.where(filled)
        for source in self.cfg.sources:
            mine = ok.where(F.col("source") == source.name)
            if mode == "daily":
                records = normalize.normalize_snapshot(mine, self.cfg.sources)
            else:
                records = normalize.explode_range(mine, self.cfg.sources)
            landing.land_append(records, f"{self.landing_root}/{source.name}", mode)
        unknown = responses.where(~known).withColumn("outcome", F.lit("UNKNOWN"))
        kept = bad.unionByName(unknown)
        counted = kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("responses"))
        counted = counted.withColumns(
            {"rate_date": F.col("extraction_timestamp").cast("date"), "body_key": F.sha2("body", 256)}
        )
        keys = ("rate_date", "source", "extraction_timestamp", "http_status_code", "outcome", "body_key")
        self.tables.upsert(QUARANTINE, counted, keys)

    def landed(self, source: SourceSpec, mode: str, start: date) -> DataFrame:
        """Lines of every landed file that may hold rows of the run."""
        base = f"{self.landing_root}/{source.name}"
        scan = landing.resolve_landing(
            self.spark, base, mode, start, self.layout, self.cfg.lookback_days
        )
        return landing.scan_lines(self.spark, scan)

    def load_silver(self, source: SourceSpec, mode: str, start: date, end: date) -> bool:
        """Landed files of one source into its silver table; False if nothing has landed.

        What becomes of the lines is counted while they are read and told in ``load_report``.
        """
        try:
            lines = self.landed(source, mode, start)
        except NoLandingData:
            return False
        counts = Observation()
        window = (mode, start.isoformat(), end.isoformat(), self.cfg.lookback_days)
        records = silver.records_from_json_lines(silver.counted_lines(lines, counts, source.name, *window))
        batch = silver.build_silver(
            records.where(F.col("source") == source.name), *window, self.cfg.silver_keys
        )
        self.tables.upsert(source.silver_table, batch, self.cfg.silver_keys)
        told = [(start, mode, source.name, what, n) for what, n in counts.get.items()]
        report = self.spark.createDataFrame(told, "rate_date date, mode string, source string, counted string, lines long")
        self.tables.upsert(f"{REPORT}_{source.name}", report, ("rate_date", "mode", "source", "counted"))
        return True

    def load_report(self) -> DataFrame:
        """(rate_date, mode, source, counted, lines): by start of a run, what became of the landed lines."""
        schema = "rate_date date, mode string, source string, counted string, lines long"
        empty = self.spark.createDataFrame([], schema)
        tables = [self.tables.read(f"{REPORT}_{s.name}", empty.schema) for s in self.cfg.sources]
        return reduce(DataFrame.unionByName, tables, empty)

    def rejected(self, source: SourceSpec, mode: str, start: date) -> DataFrame:
        """(reason, rows) of the landed lines that ``load_silver`` leaves out."""
        return silver.rejected_lines(self.landed(source, mode, start), source.name)

    def _slice(self, w: Window) -> dict:
        """Replace the recomputed dates, or only merge by key."""
        if not self.cfg.replace_slices:
            return {}
        return {"replace_from": w.since, "replace_until": w.until}

    def stage(self, source: SourceSpec, w: Window) -> None:
        rows = self.tables.read(source.silver_table, schemas.SILVER, w.since, w.until)
        batch = staging.build_staging(rows, "backfill", w.since, as_of=self.as_of)
        self.tables.upsert(
            source.staging_table, batch, staging.STAGING_KEYS, **self._slice(w)
        )

    def _stagings(self, w: Window) -> list[DataFrame]:
        return [
            self.tables.read(s.staging_table, schemas.STAGING, w.since, w.until)
            for s in self.cfg.sources
        ]

    def validate(self, w: Window) -> None:
        batch = cons.build_consensus(
            self._stagings(w),
            "backfill",
            w.since,
            sources=self.cfg.sources,
            base=self.cfg.base_currency,
            threshold=self.cfg.deviation_threshold,
            as_of=self.as_of,
        )
        self.tables.upsert(
            CONSENSUS, batch, cons.CONSENSUS_KEYS, grain="month", **self._slice(w)
        )

    def publish_fact(self, w: Window) -> None:
        """Fact rows of the window; the contract is enforced inside the write.

        A backfill picks from sources with history only.  Rows that a daily run took from another
        source stay, unless their key is picked now or has been flagged since.
        """
        flagged = self.tables.read(CONSENSUS, since=w.since, until=w.until)
        used = self.cfg.by_priority(w.mode)
        batch = fact.build_fact(
            self._stagings(w),
            flagged,
            w.mode,
            w.since,
            sources=used,
            base=self.cfg.base_currency,
            as_of=self.as_of,
        )
        if w.mode != "daily" and self.tables.exists(FACT):
            stored = self.tables.read(FACT, schemas.FACT, w.since, w.until)
            others = stored.where(~F.col("source").isin([s.name for s in used]))
            batch = merge_by_key(
                fact.exclude_anomalies(others, flagged).select(schemas.FACT.fieldNames()),
                batch,
                fact.FACT_KEYS,
            )
        self.tables.upsert(
            FACT,
            dq.enforce_contract(batch),
            fact.FACT_KEYS,
            grain="month",
            **self._slice(w),
        )

    def build_marts(self, w: Window) -> None:
        """Marts from the written fact, each opening only the months it needs."""
        steps = [lambda: self._refresh_latest(w), lambda: self._refresh_analysis(w)]
        newest = self.tables.newest_date(FACT)
        if newest is not None:
            today = self.as_of.date() if self.as_of else date.today()
            steps += [
                lambda: self._rebuild_conversions(newest),
                lambda: self._rebuild_monthly(today),
                lambda: self._rebuild_volatility(today),
                lambda: self._rebuild_health(newest),
            ]
        self._together(*steps)

    def _refresh_latest(self, w: Window) -> None:
        dim = marts.dim_countries(self.seed)
        self.tables.overwrite("dim_countries", dim)
        rows = self.tables.read(FACT, schemas.FACT, w.since, w.until)
        self.tables.upsert(
            "mart_latest_rates",
            marts.mart_latest_rates(rows, dim),
            fact.FACT_KEYS,
            grain="month",
            **self._slice(w),
        )

    def _refresh_analysis(self, w: Window) -> None:
        """From the window's start to the newest date: later rows average over changed ones."""
        rows = self.tables.read(FACT, schemas.FACT)
        batch = marts.rate_analysis_incremental(rows, "backfill", w.since)
        self.tables.upsert(
            "mart_rate_analysis",
            batch,
            fact.FACT_KEYS,
            replace_from=w.since if self.cfg.replace_slices else None,
            grain="month",
        )

    def _rebuild_conversions(self, newest: date) -> None:
        rows = self.tables.read(FACT, schemas.FACT, newest, newest)
        mart = marts.cross_rates(rows, self.cfg.top_currencies, self.as_of, newest)
        self.tables.overwrite("mart_currency_conversions", mart)

    def _rebuild_monthly(self, today: date) -> None:
        """Opens the reported months only; 31 days a month covers any calendar."""
        months = self.cfg.monthly_history_months
        rows = self.tables.read(FACT, schemas.FACT, today - timedelta(days=31 * (months + 1)))
        mart = marts.monthly_summary(rows, today, months)
        self.tables.overwrite("mart_monthly_summary", mart)

    def _rebuild_volatility(self, today: date) -> None:
        rows = self.tables.read(FACT, schemas.FACT)
        mart = marts.rate_volatility(rows, today, self.cfg.volatility_days)
        self.tables.overwrite("mart_rate_volatility", mart)

    def _rebuild_health(self, newest: date) -> None:
        rows = self.tables.read(FACT, schemas.FACT)
        flagged = self.tables.read(CONSENSUS, since=newest, until=newest)
        now = F.lit(self.as_of) if self.as_of else F.current_timestamp()
        mart = marts.health_metrics(rows, flagged, now)
        self.tables.overwrite("mart_data_quality_metrics", mart)

    def sync_hot(self) -> None:
        """Newest fact date into the hot table, sorted by pair for lookups."""
        newest = self.tables.newest_date(FACT)
        if newest is None:
            return
        latest = self.tables.read(FACT, schemas.FACT, newest, newest)
        items = hot.to_hot_items(
            marts.hot_latest_slice(latest, marts.dim_countries(self.seed), newest),
            self.as_of,
            self.cfg.hot_ttl_days,
        )
        self.hot_table().sync(items)

    def hot_table(self) -> HotTable:
        """Lookups by pair and by target currency over what ``sync_hot`` has stored."""
        return HotTable(self.tables, HOT)

    def checks(self, w: Window | None = None) -> DataFrame:
        """The declared checks, over everything or over the dates of one window."""
        bounds = {} if w is None else {"since": w.since, "until": w.until}
        stagings = {
            s.name: self.tables.read(s.staging_table, schemas.STAGING, **bounds)
            for s in self.cfg.sources
        }
        return dq.declared_suites(
            stagings,
            self.tables.read(CONSENSUS, **bounds),
            self.tables.read(FACT, schemas.FACT, **bounds),
            self.cfg.sources,
        )

    def _require_checks(self, w: Window) -> None:
        failed = self.checks(w).where("failures > 0").toLocalIterator()
        found = [f"{r['table']}.{r['column']} {r['check']}: {r['failures']}" for r in failed]
        if found:
            raise ChecksFailed("; ".join(found))

    def null_rates(self, source: SourceSpec, mode: str, start: date) -> DataFrame:
        """Missing rates per currency in the files a run would load."""
        return silver.null_profile_of_lines(self.landed(source, mode, start))

    # -- runs -------------------------------------------------------------------------------

    def _load_and_stage(
        self, sources: list[SourceSpec], w: Window, start: date
    ) -> list[SourceSpec]:
        """Each source on its own up to staging; those without landed files drop out."""

        def one(source: SourceSpec) -> bool:
            landed = self.load_silver(source, w.mode, start, w.until)
            if landed:
                self.stage(source, w)
            return landed

        landed = self._together(*[lambda s=s: one(s) for s in sources])
        return [s for s, there in zip(sources, landed) if there]

    def run_daily(
        self,
        execution_date: date,
        include_third: bool = False,
        calls: DataFrame | None = None,
        require_checks: bool = False,
    ) -> list[str]:
        """Gate, load, stage, validate, publish, build marts, sync.  Returns the sources used.

        With ``require_checks`` a failing declared check stops the run ahead of marts and sync.
        """
        w = Window(
            "daily", execution_date - timedelta(days=self.cfg.lookback_days), execution_date
        )
        used = self._load_and_stage(
            self.participating("daily", calls, include_third), w, execution_date
        )
        self.validate(w)
        self.publish_fact(w)
        if require_checks:
            self._require_checks(w)
        self._together(lambda: self.build_marts(w), self.sync_hot)
        return [s.name for s in used]

    def run_backfill(
        self,
        start: date,
        end: date,
        calls: DataFrame | None = None,
        require_checks: bool = False,
    ) -> list[str]:
        """Sources with history over an inclusive date range; the hot table is left alone."""
        w = Window("backfill", start, end)
        used = self._load_and_stage(self.participating("backfill", calls, False), w, start)
        self.validate(w)
        self.publish_fact(w)
        if require_checks:
            self._require_checks(w)
        self.build_marts(w)
        return [s.name for s in used]
