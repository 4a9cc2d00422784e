"""Configuration: which sources exist, how they rank, and the thresholds of each layer.

Everything here is small, explicit and passed as an argument; no operator reads the
environment or the wall clock.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# The currency list of the conversion matrix.
TOP_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "AUD", "CAD", "CHF", "CNY", "HKD", "SGD")


@dataclass(frozen=True)
class SourceSpec:
    """One upstream rate source.

    ``priority`` orders the fallback in the fact table and ``fact_tier`` is the label the fact
    carries for it; ``landed_tier`` is the label on landed records.  ``rate_alias`` and
    ``dev_alias`` name the source's columns in the consensus table.  ``gate`` says when a run takes
    the source: ``always``, while it has ``quota``, or on ``request`` (or in place of a source that
    names it in ``failover_to`` and is out).
    """

    name: str
    priority: int
    fact_tier: str
    landed_tier: str
    default_base: str
    rate_alias: str
    dev_alias: str
    range_id_prefix: str
    snapshot_id_has_date: bool = False
    quotes_prefixed: bool = False
    has_success_flag: bool = False
    has_history: bool = True
    quota_limit: int = 100
    gate: str = "quota"
    failover_to: str | None = None
    max_plausible_rate: float = 1_000_000.0

    @property
    def silver_table(self) -> str:
        return f"{self.name}_rates"

    @property
    def staging_table(self) -> str:
        return f"stg_{self.name}"


# Names, tiers, priorities, quotas and failover of the three sources.
DEFAULT_SOURCES = (
    SourceSpec(
        name="frankfurter", priority=1, fact_tier="primary", landed_tier="primary",
        default_base="EUR", rate_alias="frank_rate", dev_alias="frank_dev",
        range_id_prefix="fr", quota_limit=999_999_999, gate="always",
    ),
    SourceSpec(
        name="exchangerate", priority=2, fact_tier="secondary", landed_tier="secondary",
        default_base="USD", rate_alias="exchangerate_rate", dev_alias="er_dev",
        range_id_prefix="er", has_history=False, quota_limit=50,
        failover_to="currencylayer", max_plausible_rate=1_000_000_000.0,
    ),
    SourceSpec(
        name="currencylayer", priority=3, fact_tier="tertiary", landed_tier="secondary",
        default_base="USD", rate_alias="currencylayer_rate", dev_alias="cl_dev",
        range_id_prefix="cl", snapshot_id_has_date=True, quotes_prefixed=True,
        has_success_flag=True, quota_limit=100, gate="request",
    ),
)


@dataclass(frozen=True)
class EngineConfig:
    sources: tuple[SourceSpec, ...] = DEFAULT_SOURCES
    base_currency: str = "USD"
    deviation_threshold: float = 0.005
    lookback_days: int = 3
    volatility_days: int = 90
    monthly_history_months: int = 24
    quota_cycle_seconds: int = 30 * 86_400
    top_currencies: tuple[str, ...] = TOP_CURRENCIES
    silver_keys: tuple[str, ...] = ("rate_date", "source", "base_currency")
    hot_ttl_days: int | None = None
    replace_slices: bool = field(default=True)

    def source(self, name: str) -> SourceSpec:
        return next(s for s in self.sources if s.name == name)

    def by_priority(self, mode: str = "daily") -> list[SourceSpec]:
        """Sources in fallback order; a backfill only uses those that serve history."""
        ranked = sorted(self.sources, key=lambda s: s.priority)
        return [s for s in ranked if mode == "daily" or s.has_history]
