"""Data-quality checks as distributed jobs with one report: (check, column, failures).

Row checks of a suite (not null, accepted values, expressions) are counted together in a single
scan.  Key checks add one aggregation each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake import schemas
from ratelake.config import DEFAULT_SOURCES, SourceSpec

REPORT = "check string, column string, failures bigint"


@dataclass(frozen=True)
class RowCheck:
    """A predicate each row must satisfy; ``failing`` is true for rows that do not."""

    name: str
    column: str
    failing: Column


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: Sequence[str]) -> RowCheck:
    """Values outside the list fail; NULL is left to ``not_null``."""
    return RowCheck("accepted_values", column, ~F.col(column).isin(*values))


def expression_true(column: str, expression: str) -> RowCheck:
    """``expression`` continues the column, as in ``"> 0"``; NULL does not fail."""
    return RowCheck(f"expression_true {expression}", column, ~F.expr(f"{column} {expression}"))


def row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Failures of all checks from one scan."""
    counts = df.agg(*[F.count_if(c.failing).alias(f"f{i}") for i, c in enumerate(checks)])
    lines = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                F.col(f"f{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.explode(lines).alias("r")).select("r.check", "r.column", "r.failures")


def unique_combination(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("unique_combination").alias("check"),
        F.lit(",".join(keys)).alias("column"),
        "failures",
    )


def _single(df: DataFrame, check: str, column: str, failing: Column) -> DataFrame:
    return df.agg(F.coalesce(failing, F.lit(True)).cast("bigint").alias("failures")).select(
        F.lit(check).alias("check"), F.lit(column).alias("column"), "failures"
    )


def recency(df: DataFrame, column: str, as_of: Column | date, days: int) -> DataFrame:
    """Fails when the newest date is more than ``days`` before ``as_of``, or there is none."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    stale = F.max(column) < F.date_sub(now.cast("date"), days)
    return _single(df, "recency", column, stale)


def row_count_equals(df: DataFrame, expected: int = 1) -> DataFrame:
    return _single(df, "row_count", "*", F.count(F.lit(1)) != expected)


def min_distinct(df: DataFrame, column: str, at_least: int) -> DataFrame:
    return _single(df, "min_distinct", column, F.count_distinct(column) < at_least)


def severity(
    metrics: DataFrame, column: str, warn_below: float, error_below: float
) -> DataFrame:
    """Grade a metric: ``error`` below one bound, ``warn`` below the other, else ``pass``."""
    value = F.col(column)
    grade = (
        F.when(value < error_below, "error").when(value < warn_below, "warn").otherwise("pass")
    )
    return metrics.select(
        F.lit(column).alias("metric"), value.cast("double").alias("value"), grade.alias("grade")
    )


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


STAGING_REQUIRED = (
    "extraction_id", "extraction_timestamp", "source", "base_currency", "target_currency",
    "exchange_rate", "rate_date",
)


STAGING_KEYS = ("base_currency", "target_currency", "rate_date")


def staging_checks(source: SourceSpec, base: str = "USD") -> list[RowCheck]:
    """The row checks among the twelve declared ones of one staging table."""
    return [not_null(c) for c in STAGING_REQUIRED] + [
        accepted_values("source", [source.name]),
        accepted_values("base_currency", [base]),
        expression_true("exchange_rate", "> 0"),
        expression_true("exchange_rate", f"< {source.max_plausible_rate:.0f}"),
    ]


def staging_suites(
    tagged: DataFrame, sources: Sequence[SourceSpec], base: str = "USD"
) -> DataFrame:
    """The twelve declared checks of every staging table, from one pass over their union.

    ``tagged`` are staging rows with the name of their table in ``table``.  One aggregation by key
    counts both repeated keys and failing rows; its map side leaves one row per key.
    """
    checks = {s.staging_table: staging_checks(s, base) for s in sources}
    width = max(map(len, checks.values()))

    def failing(i: int) -> Column:
        """The i-th check of the row's own table."""
        out = F.lit(False)
        for name, own in checks.items():
            out = F.when(F.col("table") == name, own[i].failing).otherwise(out)
        return out

    per_key = tagged.groupBy("table", *STAGING_KEYS).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(failing(i)).alias(f"f{i}") for i in range(width)]
    )
    totals = per_key.groupBy("table").agg(
        F.count_if(F.col("n") > 1).alias("repeated"), *[F.sum(f"f{i}").alias(f"f{i}") for i in range(width)]
    )
    lines = [
        (name, "unique_combination", ",".join(STAGING_KEYS), -1) for name in checks
    ] + [(name, c.name, c.column, i) for name, own in checks.items() for i, c in enumerate(own)]
    named = tagged.sparkSession.createDataFrame(
        lines, "table string, check string, column string, at int"
    )
    counts = F.array("repeated", *[f"f{i}" for i in range(width)])
    found = totals.select("table", F.posexplode(counts).alias("at", "failures"))
    found = found.withColumn("at", F.col("at") - 1)
    return named.join(found, ["table", "at"], "left").select(
        "table", "check", "column", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")
    )


def staging_suite(df: DataFrame, source: SourceSpec, base: str = "USD") -> DataFrame:
    """The twelve declared checks of one staging table."""
    tagged = df.withColumn("table", F.lit(source.staging_table))
    return staging_suites(tagged, [source], base).drop("table")


def consensus_suite(df: DataFrame) -> DataFrame:
    """The seven declared checks of the consensus table."""
    return row_checks(
        df,
        [
            not_null("target_currency"),
            not_null("variance_pct"),
            expression_true("variance_pct", "> 0.005"),
            not_null("status"),
            accepted_values("status", ["FLAGGED"]),
            not_null("severity"),
            accepted_values("severity", ["WARNING", "CRITICAL"]),
        ],
    )


FACT_REQUIRED = (
    "extraction_id", "rate_date", "currency_pair", "base_currency", "target_currency",
    "exchange_rate", "validation_status", "severity", "extraction_timestamp", "source",
    "inverse_rate", "consensus_variance",
)
FACT_TESTED = FACT_REQUIRED[:8]
FACT_CONSTRAINTS = (
    ("base_currency", "= 'USD'"),
    ("exchange_rate", "> 0"),
    ("exchange_rate", "< 1e10"),
    ("validation_status", "= 'VALIDATED'"),
    ("severity", "= 'OK'"),
    ("inverse_rate", "> 0"),
    ("consensus_variance", "= 0.0"),
)


def fact_suite(df: DataFrame) -> DataFrame:
    """The thirteen declared checks of the fact."""
    return row_checks(
        df,
        [not_null(c) for c in FACT_TESTED]
        + [
            accepted_values("base_currency", ["USD"]),
            expression_true("exchange_rate", "> 0"),
            expression_true("exchange_rate", "< 1e10"),
            accepted_values("validation_status", ["VALIDATED"]),
            accepted_values("severity", ["OK"]),
        ],
    )


def contract_violations(df: DataFrame) -> DataFrame:
    """Failures of the fact's not-null and check constraints."""
    return row_checks(
        df,
        [not_null(c) for c in FACT_REQUIRED]
        + [expression_true(c, e) for c, e in FACT_CONSTRAINTS],
    )


class ContractError(ValueError):
    """The columns or types of a table differ from its contract."""


def check_schema(df: DataFrame, contract: T.StructType = schemas.FACT) -> None:
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    if have != want:
        raise ContractError(f"columns differ from the contract: {sorted(set(have) ^ set(want))}")


def enforce_contract(df: DataFrame, contract: T.StructType = schemas.FACT) -> DataFrame:
    """Schema equality now, constraints inside the write job: a violating row aborts it.

    The guard is an expression in the same stage, so enforcing costs no extra pass.
    """
    check_schema(df, contract)
    broken = F.lit(False)
    for c in FACT_REQUIRED:
        broken = broken | F.col(c).isNull()
    for c, e in FACT_CONSTRAINTS:
        broken = broken | ~F.coalesce(F.expr(f"{c} {e}"), F.lit(False))
    complaint = F.concat(F.lit("fact contract violated: "), F.to_json(F.struct(*FACT_REQUIRED)))
    return df.where(F.when(broken, F.raise_error(complaint).cast("boolean")).otherwise(True))


def declared_suites(
    stagings: dict[str, DataFrame],
    consensus: DataFrame,
    fact: DataFrame,
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
) -> DataFrame:
    """All declared checks of all tables with the table's name in front; each is read once."""
    there = [s for s in sources if s.name in stagings]
    columns = list(dict.fromkeys([*STAGING_REQUIRED, *STAGING_KEYS]))
    tagged = [
        stagings[s.name].select(F.lit(s.staging_table).alias("table"), *columns) for s in there
    ]
    return tagged_suites(report(*tagged), consensus, fact, there)


def tagged_suites(
    tagged: DataFrame, consensus: DataFrame, fact: DataFrame, sources: Sequence[SourceSpec]
) -> DataFrame:
    """As ``declared_suites`` over staging rows of all sources in one frame, named by ``table``."""
    return report(
        staging_suites(tagged, sources),
        consensus_suite(consensus).select(F.lit("consensus_check").alias("table"), "*"),
        fact_suite(fact).select(F.lit("fact_rates_validated").alias("table"), "*"),
    )
