"""The same results in plain SQL for a second engine.

Written with joins, CASE and correlated subqueries rather than in the shape of the Spark plans, so
that agreement means something.
"""

from __future__ import annotations

from ratelake.plans import views

_CODES = views.CODES
_TOP = ", ".join(f"'{c}'" for c in views.MATRIX_CODES)

_NAMES = dict(
    events="events", lineitem="lineitem", nation="nation", region="region", fx_quotes="fx_quotes"
)

# Common table expressions, each with the ones it reads.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_quotes": ((), views.FX_QUOTES.format(**_NAMES)),
    "fx_wide": (("fx_quotes",), views.FX_LANDED_WIDE.format(**_NAMES)),
    "fx_long": (("fx_quotes",), views.FX_LANDED_LONG.format(**_NAMES)),
    "fx_series": ((), views.FX_SERIES.format(**_NAMES)),
    "fx_dim": ((), views.FX_DIM.format(**_NAMES)),
    "fx_calls": ((), views.FX_CALLS.format(**_NAMES)),
    "newest": (("fx_quotes",), """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (
                   PARTITION BY source, base_currency, target_currency, rate_date
                   ORDER BY extraction_timestamp DESC, extraction_id DESC) AS rn
          FROM fx_quotes) t WHERE rn = 1"""),
    "stg": (("newest",), """
        SELECT extraction_id, extraction_timestamp, source, source_tier, base_currency,
               target_currency, exchange_rate, rate_date,
               base_currency || '/' || target_currency AS currency_pair,
               1.0 / exchange_rate AS inverse_rate
        FROM newest WHERE exchange_rate > 0"""),
    "landed": (("fx_long",), """
        SELECT source || '_' || CAST(rate_date AS VARCHAR) || '_' || base_currency || '_'
                 || CAST(slot AS VARCHAR) AS extraction_id,
               MAX(ts) OVER (PARTITION BY source, base_currency, rate_date, slot)
                 AS extraction_timestamp,
               source,
               CASE source WHEN 'frankfurter' THEN 'primary' ELSE 'secondary' END AS source_tier,
               base_currency, rate_date, slot, target_currency, exchange_rate
        FROM fx_long"""),
    "silver": (("landed",), """
        SELECT * FROM (
          SELECT *, DENSE_RANK() OVER (PARTITION BY rate_date, source, base_currency
                                       ORDER BY extraction_timestamp DESC, extraction_id DESC) AS k
          FROM landed) t WHERE k = 1"""),
    "usd_quotes": (("stg",), """
        SELECT *, exchange_rate AS rate FROM stg WHERE base_currency = 'USD'"""),
    "agreed": (("usd_quotes",), """
        SELECT rate_date, target_currency, MEDIAN(rate) AS consensus_rate, COUNT(*) AS source_count,
               array_to_string(list_sort(list(source || ':' || CAST(ROUND(rate, 4) AS VARCHAR))), ', ')
                 AS source_breakdown,
               MAX(rate) FILTER (source = 'frankfurter') AS frank_rate,
               MAX(rate) FILTER (source = 'exchangerate') AS exchangerate_rate,
               MAX(rate) FILTER (source = 'currencylayer') AS currencylayer_rate
        FROM usd_quotes GROUP BY 1, 2"""),
    "scored": (("agreed",), """
        SELECT *, ABS(frank_rate - consensus_rate) / consensus_rate AS frank_dev,
               ABS(exchangerate_rate - consensus_rate) / consensus_rate AS er_dev,
               ABS(currencylayer_rate - consensus_rate) / consensus_rate AS cl_dev
        FROM agreed"""),
    "judged": (("scored",), """
        SELECT *, GREATEST(COALESCE(frank_dev, 0.0), COALESCE(er_dev, 0.0), COALESCE(cl_dev, 0.0))
                    AS variance_pct,
               CASE WHEN frank_dev > 0.005 OR er_dev > 0.005 OR cl_dev > 0.005
                    THEN 'FLAGGED' ELSE 'OK' END AS status,
               CASE WHEN frank_dev > 0.005 OR er_dev > 0.005 OR cl_dev > 0.005
                    THEN 'WARNING' ELSE 'OK' END AS severity
        FROM scored"""),
    "consensus": (("judged",), """
        SELECT rate_date, target_currency, 'USD/' || target_currency AS currency_pair,
               consensus_rate, source_count, source_breakdown, frank_rate, exchangerate_rate,
               currencylayer_rate, frank_dev, er_dev, cl_dev, variance_pct, status, severity
        FROM judged WHERE status = 'FLAGGED' AND consensus_rate IS NOT NULL"""),
    "per_source": (("stg",), """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY source, target_currency, rate_date
                                       ORDER BY extraction_timestamp DESC, extraction_id DESC) AS rn
          FROM stg) t WHERE rn = 1"""),
    "universe": (("per_source",), """
        SELECT DISTINCT rate_date, target_currency, base_currency FROM per_source"""),
    "picked": (("universe",), """
        SELECT u.rate_date, u.target_currency, u.base_currency,
               COALESCE(f.extraction_id, e.extraction_id, c.extraction_id) AS extraction_id,
               COALESCE(f.extraction_timestamp, e.extraction_timestamp, c.extraction_timestamp)
                 AS extraction_timestamp,
               COALESCE(f.currency_pair, e.currency_pair, c.currency_pair) AS currency_pair,
               CASE WHEN f.exchange_rate IS NOT NULL THEN 'frankfurter'
                    WHEN e.exchange_rate IS NOT NULL THEN 'exchangerate'
                    ELSE 'currencylayer' END AS source,
               CASE WHEN f.exchange_rate IS NOT NULL THEN 'primary'
                    WHEN e.exchange_rate IS NOT NULL THEN 'secondary'
                    ELSE 'tertiary' END AS source_tier,
               COALESCE(f.exchange_rate, e.exchange_rate, c.exchange_rate) AS exchange_rate,
               COALESCE(f.inverse_rate, e.inverse_rate, c.inverse_rate) AS inverse_rate
        FROM universe u
        LEFT JOIN (SELECT * FROM per_source WHERE source = 'frankfurter') f
          USING (rate_date, target_currency, base_currency)
        LEFT JOIN (SELECT * FROM per_source WHERE source = 'exchangerate') e
          USING (rate_date, target_currency, base_currency)
        LEFT JOIN (SELECT * FROM per_source WHERE source = 'currencylayer') c
          USING (rate_date, target_currency, base_currency)"""),
    "best_usd": (("usd_quotes",), """
        SELECT * FROM usd_quotes QUALIFY ROW_NUMBER() OVER (PARTITION BY rate_date, target_currency
          ORDER BY list_position(['frankfurter', 'exchangerate', 'currencylayer'], source)) = 1"""),
    "fact": (("best_usd", "consensus"), """
        SELECT extraction_id, extraction_timestamp, rate_date, 'USD/' || target_currency AS currency_pair,
               'USD' AS base_currency, target_currency, exchange_rate, inverse_rate, source,
               CASE source WHEN 'frankfurter' THEN 'primary' WHEN 'exchangerate' THEN 'secondary'
                    ELSE 'tertiary' END AS source_tier,
               'VALIDATED' AS validation_status, 'OK' AS severity,
               CAST(0.0 AS DOUBLE) AS consensus_variance, 'fact_rates_validated' AS model_name
        FROM best_usd ANTI JOIN consensus USING (rate_date, target_currency)"""),
    # Staging as produced from landed maps: newest record that quotes the currency.
    "landed_stg": (("landed",), """
        SELECT extraction_id, extraction_timestamp, source, source_tier, base_currency,
               target_currency, exchange_rate, rate_date,
               base_currency || '/' || target_currency AS currency_pair,
               1.0 / exchange_rate AS inverse_rate
        FROM (SELECT *, ROW_NUMBER() OVER (
                       PARTITION BY source, base_currency, target_currency, rate_date
                       ORDER BY extraction_timestamp DESC, extraction_id DESC) AS rn
              FROM landed WHERE exchange_rate IS NOT NULL) t
        WHERE rn = 1 AND exchange_rate > 0"""),
    # A run goes through silver: newest record per (date, source, base), then its currencies.
    "run_stg": (("silver",), """
        SELECT *, base_currency || '/' || target_currency AS currency_pair,
               1.0 / exchange_rate AS inverse_rate
        FROM silver WHERE exchange_rate > 0"""),
    "anchors": (("fx_calls",), """
        SELECT api_source, min(date_trunc('second', called_at)) AS cycle_start
        FROM fx_calls GROUP BY 1
        UNION ALL
        SELECT a.api_source,
               (SELECT min(date_trunc('second', f.called_at)) FROM fx_calls f
                WHERE f.api_source = a.api_source
                  AND f.called_at >= a.cycle_start + INTERVAL '7' DAY)
        FROM anchors a WHERE a.cycle_start IS NOT NULL"""),
    "cycles": (("anchors",), """
        SELECT a.api_source, a.cycle_start, a.cycle_start + INTERVAL '7' DAY AS cycle_end,
               count(*) AS request_count
        FROM anchors a JOIN fx_calls f ON f.api_source = a.api_source
         AND f.called_at >= a.cycle_start AND f.called_at < a.cycle_start + INTERVAL '7' DAY
        GROUP BY 1, 2, 3"""),
    "config": ((), """
        SELECT * FROM (VALUES
          ('frankfurter', CAST(999999999 AS BIGINT), CAST(NULL AS VARCHAR), 1),
          ('exchangerate', CAST(50 AS BIGINT), 'currencylayer', 2),
          ('currencylayer', CAST(100 AS BIGINT), CAST(NULL AS VARCHAR), 3))
          v(api_source, quota, failover_to, priority)"""),
    "usage": (("cycles", "config"), """
        SELECT v.api_source, CAST(COALESCE(c.cycle_start, n.now) AS DATE) AS cycle_start,
               COALESCE(c.request_count, 0) AS requests, v.quota,
               ROUND(COALESCE(c.request_count, 0) * 100.0 / CAST(v.quota AS DOUBLE), 1)
                 AS usage_pct,
               GREATEST(v.quota - COALESCE(c.request_count, 0), 0) AS remaining,
               ROUND(COALESCE(epoch(c.cycle_end) - epoch(date_trunc('second', n.now)), 604800)
                     / 86400.0, 1) AS ttl_days_left,
               CASE WHEN COALESCE(c.request_count, 0) >= v.quota THEN 'throttled'
                    ELSE 'active' END AS status,
               COALESCE(c.request_count, 0) * 100.0 / CAST(v.quota AS DOUBLE) >= 90
                 AND v.quota < 1000000 AS quota_warning,
               v.failover_to, v.priority
        FROM config v CROSS JOIN (SELECT max(called_at) AS now FROM fx_calls) n
        LEFT JOIN cycles c ON c.api_source = v.api_source
          AND c.cycle_start <= n.now AND c.cycle_end > n.now"""),
    "available": (("usage",), """
        SELECT api_source, status = 'active' AND remaining > 0 AS available FROM usage"""),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    """The needed expressions in order of use."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _CTES[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _sql(body: str, *names: str) -> str:
    parts = ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in _closure(names))
    return f"WITH RECURSIVE {parts}\n{body}" if parts else body


def _r(*columns: str) -> str:
    return ", ".join(f"ROUND({c}, 9) AS {c.split('.')[-1]}" for c in columns)


_LONG = ("extraction_id, source, base_currency, rate_date, target_currency, "
         + _r("exchange_rate"))
_LANDED_LONG = _sql(f"SELECT {_LONG} FROM landed WHERE exchange_rate IS NOT NULL", "landed")
_SILVER_LONG = _sql(f"SELECT {_LONG} FROM silver WHERE exchange_rate IS NOT NULL", "silver")
_STG_KEY = "source, base_currency, target_currency, rate_date"
_LINEAGE = ("rate_date, target_currency, base_currency, extraction_id, extraction_timestamp, "
            "currency_pair, source, source_tier, " + _r("exchange_rate", "inverse_rate"))
_STG_ROW = ("extraction_id, extraction_timestamp, source, source_tier, base_currency, "
            "target_currency, " + _r("exchange_rate") + ", rate_date, currency_pair, "
            + _r("inverse_rate"))
_FACT_ROW = ("extraction_id, extraction_timestamp, rate_date, currency_pair, base_currency, "
             "target_currency, " + _r("exchange_rate", "inverse_rate")
             + ", source, source_tier, validation_status, severity, consensus_variance, model_name")
def _dec(c: str) -> str:
    """A double's text as a decimal's text."""
    value = f"CAST(CAST(ROUND({c}, 9) AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST({value} AS VARCHAR) AS {c.split('.')[-1]}"


_HOT_ROW = ("CAST(f.rate_date AS VARCHAR) AS rate_date, f.base_currency, f.target_currency, "
            "d.country_name, d.region, " + ", ".join(map(_dec, (
                "f.exchange_rate", "f.inverse_rate", "f.consensus_variance")))
            + ", f.validation_status, f.currency_pair")
_HOT_FROM = "FROM fact f LEFT JOIN fx_dim d ON f.target_currency = d.currency_code"
_PAIR_WINDOW = "(PARTITION BY base_currency, target_currency ORDER BY rate_date"
_SERIES_ROW = "rate_date, base_currency, target_currency, " + _r("exchange_rate")
_LAGS = """
SELECT rate_date, target_currency, exchange_rate,
       LAG(exchange_rate, 1) OVER w AS p1, LAG(exchange_rate, 7) OVER w AS p7,
       LAG(exchange_rate, 30) OVER w AS p30,
       STDDEV(exchange_rate) OVER (PARTITION BY target_currency ORDER BY rate_date
                                   ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS volatility_7d,
       STDDEV(exchange_rate) OVER (PARTITION BY target_currency ORDER BY rate_date
                                   ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS volatility_30d
FROM fx_series WINDOW w AS (PARTITION BY target_currency ORDER BY rate_date)"""
_RETURNS = """
       ROUND((exchange_rate - p1) / NULLIF(p1, 0), 9) AS daily_change_pct,
       ROUND((exchange_rate - p7) / NULLIF(p7, 0), 9) AS change_7d_pct,
       ROUND((exchange_rate - p30) / NULLIF(p30, 0), 9) AS change_30d_pct"""
_MONTHS = """
SELECT *, CAST(date_trunc('month', rate_date) AS DATE) AS month FROM fx_series
WHERE rate_date >= date_trunc('month',
        (SELECT MAX(rate_date) FROM fx_series) - INTERVAL '24' MONTH)"""
_MONTH_KEYS = """m.month, CAST(YEAR(m.month) AS INT) AS year,
       CAST(MONTH(m.month) AS INT) AS month_num, m.target_currency"""
_RUN_DATES = "rate_date BETWEEN DATE '2024-01-17' AND DATE '2024-01-20'"


def _run_fact(sources: tuple[str, ...], where: str) -> str:
    """The fact of a run over landed data, with plain joins, for some sources only."""
    labels = {"frankfurter": "primary", "exchangerate": "secondary", "currencylayer": "tertiary"}
    of = {
        s: f"(SELECT * FROM run_stg WHERE source = '{s}' AND base_currency = 'USD' AND {where})"
        for s in sources
    }
    keys = " UNION ".join(f"SELECT rate_date, target_currency FROM {q}" for q in of.values())
    joins = "\n".join(
        f"LEFT JOIN {q} s{i} USING (rate_date, target_currency)"
        for i, q in enumerate(of.values())
    )

    def first(column: str) -> str:
        return "COALESCE(" + ", ".join(f"s{i}.{column}" for i in range(len(of))) + ")"

    med = f"""
      SELECT rate_date, target_currency, MEDIAN(exchange_rate) AS med FROM run_stg
      WHERE source IN ({', '.join(repr(s) for s in sources)}) AND base_currency = 'USD'
        AND {where} GROUP BY 1, 2"""
    off = " OR ".join(
        f"COALESCE(ABS(s{i}.exchange_rate - m.med) / m.med > 0.005, FALSE)" for i in range(len(of))
    )
    tier = " ".join(
        f"WHEN s{i}.exchange_rate IS NOT NULL THEN '{labels[s]}'" for i, s in enumerate(of)
    )
    body = f"""
    SELECT {_FACT_ROW} FROM (
      SELECT {first('extraction_id')} AS extraction_id,
             {first('extraction_timestamp')} AS extraction_timestamp, k.rate_date,
             'USD/' || k.target_currency AS currency_pair, 'USD' AS base_currency,
             k.target_currency, {first('exchange_rate')} AS exchange_rate,
             {first('inverse_rate')} AS inverse_rate, {first('source')} AS source,
             CASE {tier} END AS source_tier, 'VALIDATED' AS validation_status,
             'OK' AS severity, CAST(0.0 AS DOUBLE) AS consensus_variance,
             'fact_rates_validated' AS model_name
      FROM ({keys}) k {joins}
      JOIN ({med}) m USING (rate_date, target_currency)
      WHERE NOT ({off})) t"""
    return _sql(body, "run_stg")


def _check(name: str, column: str, failures: str, source: str) -> str:
    return (f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", "
            f"CAST({failures} AS BIGINT) AS failures FROM {source}")


def _count(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def _suite(table: str, source: str, rows: list[tuple[str, str, str]]) -> list[str]:
    return [
        f"SELECT '{table}' AS \"table\", t.* FROM ({_check(n, c, f, source)}) t"
        for n, c, f in rows
    ]


def _not_null(*columns: str) -> list[tuple[str, str, str]]:
    return [("not_null", c, _count(f"{c} IS NULL")) for c in columns]


def _values(column: str, *values: str) -> tuple[str, str, str]:
    listed = ", ".join(f"'{v}'" for v in values)
    return ("accepted_values", column, _count(f"{column} NOT IN ({listed})"))


def _expr(column: str, expression: str) -> tuple[str, str, str]:
    return (f"expression_true {expression}".replace("'", "''"), column,
            _count(f"NOT ({column} {expression})"))


def _declared() -> str:
    parts: list[str] = []
    limits = {"frankfurter": 1000000, "exchangerate": 1000000000, "currencylayer": 1000000}
    for s, limit in limits.items():
        mine = f"(SELECT * FROM stg WHERE source = '{s}')"
        rows = _not_null("extraction_id", "extraction_timestamp", "source", "base_currency",
                         "target_currency", "exchange_rate", "rate_date")
        rows += [_values("source", s), _values("base_currency", "USD"),
                 _expr("exchange_rate", "> 0"), _expr("exchange_rate", f"< {limit}")]
        parts += _suite(f"stg_{s}", mine, rows)
        keys = "base_currency,target_currency,rate_date"
        doubles = f"(SELECT 1 FROM {mine} GROUP BY {keys} HAVING COUNT(*) > 1)"
        parts += _suite(f"stg_{s}", doubles, [("unique_combination", keys, "COUNT(*)")])
    parts += _suite("consensus_check", "consensus", [
        *_not_null("target_currency", "variance_pct"), _expr("variance_pct", "> 0.005"),
        *_not_null("status"), _values("status", "FLAGGED"), *_not_null("severity"),
        _values("severity", "WARNING", "CRITICAL")])
    parts += _suite("fact_rates_validated", "fact", [
        *_not_null("extraction_id", "rate_date", "currency_pair", "base_currency",
                   "target_currency", "exchange_rate", "validation_status", "severity"),
        _values("base_currency", "USD"), _expr("exchange_rate", "> 0"),
        _expr("exchange_rate", "< 1e10"), _values("validation_status", "VALIDATED"),
        _values("severity", "OK")])
    return _sql("\nUNION ALL ".join(parts), "stg", "consensus", "fact")


def _union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


_BACKFILL_OVER_MONTHS = _sql(f"""
    SELECT {_FACT_ROW} FROM (
      SELECT 'fr_' || CAST(rate_date AS VARCHAR) AS extraction_id,
             CAST(rate_date AS TIMESTAMP) AS extraction_timestamp, rate_date,
             base_currency || '/' || target_currency AS currency_pair, base_currency,
             target_currency, exchange_rate, inverse_rate, 'frankfurter' AS source,
             'primary' AS source_tier, 'VALIDATED' AS validation_status,
             'OK' AS severity, CAST(0.0 AS DOUBLE) AS consensus_variance,
             'fact_rates_validated' AS model_name
      FROM fx_series
      WHERE rate_date BETWEEN DATE '1996-11-10' AND DATE '1997-02-20'
        AND exchange_rate > 0) t""", "fx_series")


def _without_id(sql: str) -> str:
    """The same rows without the id that landing gives them."""
    return f"SELECT * EXCLUDE (extraction_id) FROM ({sql}) run"


_STATUS = """CASE WHEN event_type <> 'error' THEN 200 WHEN user_id % 3 = 0 THEN 429
                  ELSE 500 END AS http_status_code"""
_OUTCOME = """CASE WHEN event_type = 'error'
                     THEN CASE WHEN user_id % 3 = 0 THEN 'THROTTLED' ELSE 'ERROR' END
                   WHEN source = 'currencylayer'
                     THEN CASE user_id % 7 WHEN 0 THEN 'THROTTLED' WHEN 1 THEN 'ERROR'
                               ELSE 'OK' END
                   WHEN user_id % 11 = 0 THEN 'ERROR' ELSE 'OK' END AS outcome"""


def oracle_sql() -> dict[str, str]:
    quotes = "fx_quotes"
    prefix = "CASE source WHEN 'frankfurter' THEN 'fr' WHEN 'exchangerate' THEN 'er' ELSE 'cl' END"
    epoch = "CAST(CAST(floor(epoch({})) AS BIGINT) AS VARCHAR)"
    landed_row = ("source, source_tier, base_currency, rate_date, 200 AS http_status_code, "
                  "target_currency, " + _r("exchange_rate"))
    day = "CAST(rate_date AS VARCHAR)"
    as_of = "TIMESTAMP '2024-02-01 12:30:00'"
    health = f"""
      SELECT MAX(extraction_timestamp) AS last_extraction, MAX(rate_date) AS last_rate_date,
             DATEDIFF('hour', MAX(extraction_timestamp), {as_of}) AS hours_since_extraction,
             DATEDIFF('day', MAX(rate_date), DATE '2024-02-01') AS days_since_rate,
             COUNT(DISTINCT target_currency) AS currency_count, COUNT(*) AS total_records,
             v.validated_count, v.ok_count, v.warning_count,
             ROUND(CAST(v.ok_count AS DOUBLE) / NULLIF(v.validated_count, 0), 4) AS ok_rate,
             COALESCE(c.flagged_count, 0) AS flagged_count,
             ROUND(c.avg_variance, 9) AS avg_variance, ROUND(c.max_variance, 9) AS max_variance,
             CASE WHEN DATEDIFF('day', MAX(rate_date), DATE '2024-02-01') > 2 THEN 'STALE'
                  WHEN COALESCE(c.flagged_count, 0) > 5 THEN 'DEGRADED'
                  WHEN v.warning_count > 10 THEN 'WARNING' ELSE 'HEALTHY' END AS pipeline_status
      FROM fact CROSS JOIN (
        SELECT COUNT(*) AS validated_count,
               COUNT(*) FILTER (WHERE severity = 'OK') AS ok_count,
               COUNT(*) FILTER (WHERE severity = 'WARNING') AS warning_count
        FROM fact WHERE rate_date = (SELECT MAX(rate_date) FROM fact)) v
      LEFT JOIN (SELECT COUNT(*) AS flagged_count, AVG(frank_dev) AS avg_variance,
                        MAX(frank_dev) AS max_variance
                 FROM consensus WHERE rate_date = (SELECT MAX(rate_date) FROM fact)) c ON 1 = 1
      GROUP BY v.validated_count, v.ok_count, v.warning_count, c.flagged_count, c.avg_variance,
               c.max_variance"""
    contract = [*_not_null("extraction_id", "rate_date", "currency_pair", "base_currency",
                           "target_currency", "exchange_rate", "validation_status", "severity",
                           "extraction_timestamp", "source", "inverse_rate", "consensus_variance"),
                _expr("base_currency", "= 'USD'"), _expr("exchange_rate", "> 0"),
                _expr("exchange_rate", "< 1e10"), _expr("validation_status", "= 'VALIDATED'"),
                _expr("severity", "= 'OK'"), _expr("inverse_rate", "> 0"),
                _expr("consensus_variance", "= 0.0")]
    median_row = ("rate_date, target_currency, source_count, "
                  + _r("frank_rate", "exchangerate_rate", "currencylayer_rate", "consensus_rate"))
    lag_row = "rate_date, target_currency, " + _r("exchange_rate") + "," + _RETURNS
    profile = _union(*[
        f"SELECT '{c}' AS currency, COUNT(*) FILTER (WHERE rates__{c.lower()} IS NULL) "
        f"AS null_rows, COUNT(*) AS total_rows FROM fx_wide" for c in _CODES])
    return {
        # responses
        "norm_snapshot": _sql(f"""
            SELECT CASE WHEN source = 'currencylayer'
                        THEN 'cl_' || {day} || '_' || base_currency || '_'
                             || {epoch.format('extraction_timestamp')}
                        ELSE source || '_' || strftime(extraction_timestamp, '%Y%m%d_%H%M%S')
                   END AS extraction_id, {landed_row}
            FROM landed WHERE exchange_rate IS NOT NULL""", "landed"),
        "norm_range_explode": _sql(f"""
            SELECT {prefix} || '_' || {day} || '_' || base_currency || '_'
                     || {epoch.format(as_of)} AS extraction_id, {landed_row}
            FROM stg""", "stg"),
        "norm_strip_base_prefix": _sql(f"""
            SELECT extraction_id, target_currency AS code, ROUND(exchange_rate, 9) AS rate
            FROM {quotes}
            UNION ALL SELECT extraction_id, '', CAST(1 AS DOUBLE) FROM {quotes}""", quotes),
        "norm_cast_rates": _sql(f"""
            SELECT extraction_id, 'rate' AS code, ROUND(exchange_rate, 9) AS rate FROM {quotes}
            UNION ALL SELECT extraction_id, 'whole', CAST(user_id AS DOUBLE) FROM {quotes}
            UNION ALL SELECT extraction_id, 'broken', NULL FROM {quotes}""", quotes),
        "norm_rate_date": _sql(f"""
            SELECT extraction_id, CASE user_id % 3 WHEN 0 THEN rate_date - 1
                   WHEN 1 THEN rate_date - 2 ELSE rate_date END AS rate_date
            FROM {quotes}""", quotes),
        "norm_extraction_id": _sql(f"""
            SELECT event_id,
                   CASE WHEN source = 'currencylayer'
                        THEN {prefix} || '_' || {day} || '_' || base_currency || '_'
                             || {epoch.format('extraction_timestamp')}
                        ELSE source || '_' || strftime(extraction_timestamp, '%Y%m%d_%H%M%S')
                   END AS snapshot_id,
                   {prefix} || '_' || {day} || '_' || base_currency || '_'
                     || {epoch.format('extraction_timestamp')} AS range_id
            FROM {quotes}""", quotes),
        "norm_classify_response": _sql(
            f"SELECT extraction_id, source, {_STATUS}, {_OUTCOME} FROM fx_quotes", quotes),
        "land_responses": _sql(f"""
            SELECT source, rate_date, 'C01' AS target_currency, COUNT(*) AS records,
                   ROUND(1.5 * CAST(COUNT(*) AS DOUBLE), 9) AS total_rate
            FROM (SELECT source, rate_date, {_OUTCOME} FROM fx_quotes) t
            WHERE outcome = 'OK' GROUP BY 1, 2""", quotes),
        "quarantine_responses": _sql(f"""
            SELECT source, outcome, http_status_code, CAST(COUNT(*) + COUNT_IF(twice) AS BIGINT) AS responses
            FROM (SELECT source, {_STATUS}, {_OUTCOME}, second(extraction_timestamp) % 3 = 0 AS twice FROM fx_quotes) t
            WHERE outcome <> 'OK' GROUP BY 1, 2, 3""", quotes),
        "load_report": _sql("""
            SELECT DATE '2024-01-20' AS rate_date, source, counted, CAST(lines AS BIGINT) AS lines FROM (
              SELECT source, COUNT(*) AS lines, 0 AS bad_line, 0 AS bad_key, COUNT_IF(other) AS other_source,
                COUNT_IF(NOT other AND undated) AS bad_date, COUNT_IF(NOT other AND NOT undated AND NOT inside) AS outside_window,
                COUNT_IF(NOT other AND NOT undated AND inside) AS records
              FROM (SELECT source, day(rate_date) % 7 = 0 AS other, day(rate_date) % 5 = 0 AS undated,
                      rate_date >= DATE '2024-01-17' AS inside FROM fx_wide WHERE base_currency = 'USD')
              GROUP BY source
            ) UNPIVOT (lines FOR counted IN (lines, bad_line, bad_key, other_source, bad_date, outside_window, records))""", "fx_wide"),
        "norm_flatten_map": _sql(
            "SELECT extraction_id, " + _r(*[f"rates__{c.lower()}" for c in _CODES])
            + " FROM fx_wide", "fx_wide"),
        "land_append": _LANDED_LONG,
        # sources and sinks
        "scan_jsonl_union": _LANDED_LONG,
        "scan_or_empty": _sql("""SELECT extraction_id, source, base_currency, rate_date
            FROM fx_wide WHERE source = 'frankfurter'""", "fx_wide"),
        "resolve_landing_paths": _LANDED_LONG,
        "scan_latest_version": _sql(
            f"SELECT {_STG_KEY}, ROUND(exchange_rate * 2, 9) AS exchange_rate FROM stg", "stg"),
        "scan_seed_csv": _sql("SELECT * FROM fx_dim", "fx_dim"),
        "version_registry": _sql("""
            SELECT source AS table_name, base_currency AS slice, extraction_id AS location,
                   event_id AS version, extraction_timestamp AS updated_at
            FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, base_currency
                                               ORDER BY event_id DESC) AS rn FROM fx_quotes) t
            WHERE rn = 1""", quotes),
        "hot_upsert": _sql(f"""SELECT {_HOT_ROW} {_HOT_FROM}
            WHERE f.rate_date = (SELECT MAX(rate_date) FROM fact)""", "fact", "fx_dim"),
        "hot_get": _sql(f"""SELECT {_HOT_ROW} {_HOT_FROM}
            WHERE f.currency_pair = 'USD/C07' AND f.rate_date = DATE '2024-01-15'""",
            "fact", "fx_dim"),
        "hot_lookup": _sql(f"""SELECT {_HOT_ROW} {_HOT_FROM}
            WHERE f.currency_pair = 'USD/C07' ORDER BY f.rate_date DESC LIMIT 10""",
            "fact", "fx_dim"),
        "hot_lookup_by_target": _sql(f"""SELECT {_HOT_ROW} {_HOT_FROM}
            WHERE f.target_currency = 'C03'
              AND f.rate_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
            ORDER BY f.rate_date""", "fact", "fx_dim"),
        "preview_topn": _sql(
            f"SELECT {_FACT_ROW} FROM fact ORDER BY extraction_id DESC LIMIT 10", "fact"),
        # silver
        "silver_discover_rate_cols": _sql(_union(*[
            f"SELECT 'rates__{c.lower()}' AS rate_column, COUNT(rates__{c.lower()}) AS quotes "
            f"FROM fx_wide" for c in _CODES]), "fx_wide"),
        "silver_null_profile": _sql(profile, "fx_wide"),
        "silver_null_profile_lines": _sql(
            f"{profile} UNION ALL SELECT 'ZZZ', COUNT(*), COUNT(*) FROM fx_wide", "fx_wide"),
        "silver_rebuild_map": _LANDED_LONG,
        "silver_date_window": _sql("""SELECT extraction_id, rate_date FROM fx_wide
            WHERE rate_date >= DATE '2024-01-17'""", "fx_wide"),
        "silver_date_window_backfill": _sql("""SELECT extraction_id, rate_date FROM fx_wide
            WHERE rate_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""", "fx_wide"),
        "silver_valid_map_keys": _sql(f"""
            SELECT extraction_id, 'row' AS by, target_currency AS code,
                   CAST(user_id AS DOUBLE) AS rate FROM {quotes} WHERE user_id % 4 <> 0
            UNION ALL
            SELECT extraction_id, 'entry', target_currency, CAST(user_id AS DOUBLE)
            FROM {quotes} WHERE user_id % 4 <> 0""", quotes),
        "silver_dedup_latest": _sql("""
            SELECT DISTINCT rate_date, source, base_currency, extraction_id, extraction_timestamp
            FROM silver""", "silver"),
        "silver_evolve_schema": _sql("""
            SELECT extraction_id, ROUND(exchange_rate, 9) AS exchange_rate,
                   CASE WHEN rate_date >= DATE '2024-01-20' THEN source_tier END AS source_tier
            FROM stg""", "stg"),
        "silver_create_if_missing": _SILVER_LONG,
        "keyed_upsert": _sql(f"""
            SELECT {_STG_KEY}, ROUND(CASE WHEN rate_date >= DATE '2024-01-20'
                     THEN exchange_rate * 3 ELSE exchange_rate END, 9) AS exchange_rate
            FROM stg""", "stg"),
        # staging
        "stg_filter_execution_date": _sql("""SELECT DISTINCT extraction_id, rate_date FROM silver
            WHERE rate_date >= DATE '2024-01-20'""", "silver"),
        "stg_incremental_watermark": _sql("""SELECT DISTINCT extraction_id, rate_date FROM silver
            WHERE rate_date > (SELECT MAX(rate_date) FROM silver
                               WHERE rate_date <= DATE '2024-01-20')""", "silver"),
        "stg_unnest_rates": _SILVER_LONG,
        "stg_dedup_pair": _sql(
            f"SELECT {_STG_KEY}, extraction_id, {_r('exchange_rate')} FROM newest", "newest"),
        "stg_project": _sql("""
            SELECT extraction_id, extraction_timestamp, source, source_tier, base_currency,
                   target_currency, ROUND(exchange_rate, 9) AS exchange_rate, rate_date,
                   concat(base_currency, '/', target_currency) AS currency_pair,
                   ROUND(1.0 / exchange_rate, 9) AS inverse_rate
            FROM fx_quotes WHERE exchange_rate > 0""", quotes),
        "stg_positive_filter": _sql(
            f"SELECT {_STG_KEY}, extraction_id FROM newest WHERE exchange_rate > 0", "newest"),
        "stg_full": _sql(f"""SELECT {_STG_ROW} FROM landed_stg
            WHERE rate_date >= DATE '2024-01-17'""", "landed_stg"),
        # consensus
        "cons_union_sources": _sql(
            f"SELECT rate_date, target_currency, {_r('rate')}, source FROM usd_quotes",
            "usd_quotes"),
        "cons_median": _sql(f"""SELECT rate_date, target_currency, {_r('consensus_rate')},
            source_count FROM agreed""", "agreed"),
        "cons_breakdown": _sql(
            "SELECT rate_date, target_currency, source_breakdown FROM agreed", "agreed"),
        "cons_pivot_rates": _sql(f"SELECT {median_row} FROM scored", "scored"),
        "cons_deviation": _sql(f"""SELECT rate_date, target_currency,
            {_r('frank_dev', 'er_dev', 'cl_dev', 'variance_pct')} FROM judged""", "judged"),
        "cons_flag": _sql(
            "SELECT rate_date, target_currency, status, severity FROM judged", "judged"),
        "cons_incremental": _sql(f"""SELECT {median_row} FROM scored
            WHERE rate_date BETWEEN DATE '2024-01-18' AND DATE '2024-01-20'""", "scored"),
        "cons_full": _sql(f"""SELECT rate_date, target_currency, currency_pair,
            {_r('consensus_rate')}, source_count, source_breakdown,
            {_r('frank_rate', 'exchangerate_rate', 'currencylayer_rate', 'frank_dev', 'er_dev',
                'cl_dev', 'variance_pct')}, status, severity FROM consensus""", "consensus"),
        # fact
        "fact_latest_per_source": _sql(f"SELECT {_STG_ROW} FROM per_source", "per_source"),
        "fact_key_universe": _sql("SELECT * FROM universe", "universe"),
        "fact_priority_coalesce": _sql(f"SELECT {_LINEAGE} FROM picked", "picked"),
        "fact_priority_backfill": _sql(f"""
            SELECT {_LINEAGE} FROM (
              SELECT u.rate_date, u.target_currency, u.base_currency,
                     COALESCE(f.extraction_id, c.extraction_id) AS extraction_id,
                     COALESCE(f.extraction_timestamp, c.extraction_timestamp)
                       AS extraction_timestamp,
                     COALESCE(f.currency_pair, c.currency_pair) AS currency_pair,
                     COALESCE(f.source, c.source) AS source,
                     CASE WHEN f.exchange_rate IS NOT NULL THEN 'primary'
                          ELSE 'tertiary' END AS source_tier,
                     COALESCE(f.exchange_rate, c.exchange_rate) AS exchange_rate,
                     COALESCE(f.inverse_rate, c.inverse_rate) AS inverse_rate
              FROM universe u
              LEFT JOIN (SELECT * FROM per_source WHERE source = 'frankfurter') f
                USING (rate_date, target_currency, base_currency)
              LEFT JOIN (SELECT * FROM per_source WHERE source = 'currencylayer') c
                USING (rate_date, target_currency, base_currency)
              WHERE COALESCE(f.exchange_rate, c.exchange_rate) IS NOT NULL) t""", "universe"),
        "fact_exclude_anomalies": _sql(f"""
            SELECT {_STG_KEY}, extraction_id, {_r('exchange_rate')} FROM stg s
            WHERE NOT EXISTS (SELECT 1 FROM consensus c WHERE c.rate_date = s.rate_date
                              AND c.target_currency = s.target_currency)""", "stg", "consensus"),
        "fact_lookback": _sql(f"""SELECT {_STG_KEY}, extraction_id FROM stg
            WHERE rate_date >= (SELECT MAX(rate_date) FROM stg) - INTERVAL '3' DAY""", "stg"),
        "fact_full": _sql(f"SELECT {_FACT_ROW} FROM fact", "fact"),
        "fact_fused": _sql(f"SELECT {_FACT_ROW} FROM fact", "fact"),
        # marts
        "dim_countries": _sql("SELECT * FROM fx_dim", "fx_dim"),
        "mart_latest_rates": _sql(f"""
            SELECT f.rate_date, f.base_currency, f.target_currency, d.country_name, d.region,
                   {_r('f.exchange_rate', 'f.inverse_rate')}, f.consensus_variance,
                   f.validation_status, f.severity {_HOT_FROM}
            ORDER BY f.rate_date DESC, d.region, f.target_currency""", "fact", "fx_dim"),
        "mart_moving_average": _sql(f"""
            SELECT {_SERIES_ROW}, ROUND(AVG(exchange_rate) OVER {_PAIR_WINDOW}
                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS ma_7_day
            FROM fx_series""", "fx_series"),
        "mart_daily_change": _sql(f"""
            SELECT {_SERIES_ROW}, ROUND(exchange_rate - LAG(exchange_rate) OVER
                     {_PAIR_WINDOW}), 9) AS daily_change FROM fx_series""", "fx_series"),
        "mart_rate_analysis_incremental": _sql(f"""
            SELECT * FROM (
              SELECT {_SERIES_ROW}, ROUND(AVG(exchange_rate) OVER {_PAIR_WINDOW}
                       ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS ma_7_day,
                     ROUND(exchange_rate - LAG(exchange_rate) OVER {_PAIR_WINDOW}), 9)
                       AS daily_change
              FROM fx_series) t
            WHERE rate_date >= (SELECT MAX(rate_date) FROM fx_series) - INTERVAL '30' DAY""",
            "fx_series"),
        "mart_cross_rates": _sql(f"""
            SELECT f.rate_date, f.target_currency AS from_currency,
                   t.target_currency AS to_currency,
                   f.target_currency || '/' || t.target_currency AS currency_pair,
                   ROUND(f.exchange_rate / t.exchange_rate, 9) AS exchange_rate,
                   ROUND(t.exchange_rate / f.exchange_rate, 9) AS inverse_rate,
                   ROUND(t.exchange_rate / f.exchange_rate, 9) AS convert_multiplier
            FROM fx_series f CROSS JOIN fx_series t
            WHERE f.rate_date = (SELECT MAX(rate_date) FROM fx_series)
              AND t.rate_date = (SELECT MAX(rate_date) FROM fx_series)
              AND f.target_currency <> t.target_currency
              AND f.target_currency IN ({_TOP}) AND t.target_currency IN ({_TOP})
            ORDER BY 2, 3""", "fx_series"),
        "mart_monthly_stats": _sql(f"""
            SELECT {_MONTH_KEYS}, COUNT(*) AS sample_count,
                   ROUND(MIN(exchange_rate), 9) AS min_rate,
                   ROUND(MAX(exchange_rate), 9) AS max_rate,
                   ROUND(AVG(exchange_rate), 9) AS avg_rate,
                   ROUND(MEDIAN(exchange_rate), 9) AS median_rate,
                   ROUND(STDDEV(exchange_rate), 9) AS stddev_rate,
                   ROUND((MAX(exchange_rate) - MIN(exchange_rate)) / AVG(exchange_rate), 9)
                     AS volatility_pct
            FROM ({_MONTHS}) m GROUP BY 1, 2, 3, 4 ORDER BY 1 DESC, 4""", "fx_series"),
        "mart_monthly_open_close": _sql(f"""
            SELECT DISTINCT {_MONTH_KEYS},
                   ROUND((SELECT exchange_rate FROM ({_MONTHS}) o WHERE o.month = m.month
                            AND o.target_currency = m.target_currency
                          ORDER BY rate_date ASC LIMIT 1), 9) AS opening_rate,
                   ROUND((SELECT exchange_rate FROM ({_MONTHS}) o WHERE o.month = m.month
                            AND o.target_currency = m.target_currency
                          ORDER BY rate_date DESC LIMIT 1), 9) AS closing_rate
            FROM (SELECT DISTINCT month, target_currency FROM ({_MONTHS}) x) m""", "fx_series"),
        "mart_lag_returns": _sql(f"SELECT {lag_row} FROM ({_LAGS}) t", "fx_series"),
        "mart_rolling_stddev": _sql(f"""SELECT rate_date, target_currency,
            {_r('volatility_7d', 'volatility_30d')} FROM ({_LAGS}) t""", "fx_series"),
        "mart_risk_level": _sql(f"""
            SELECT {lag_row}, {_r('volatility_7d', 'volatility_30d')},
                   CASE WHEN ABS((exchange_rate - p1) / p1) > 0.02
                          OR ABS((exchange_rate - p7) / p7) > 0.05 THEN 'HIGH_RISK'
                        WHEN ABS((exchange_rate - p1) / p1) > 0.01
                          OR ABS((exchange_rate - p7) / p7) > 0.03 THEN 'MEDIUM_RISK'
                        ELSE 'STABLE' END AS risk_level
            FROM ({_LAGS}) t
            WHERE rate_date >= (SELECT MAX(rate_date) FROM fx_series) - INTERVAL '90' DAY
            ORDER BY rate_date DESC, target_currency""", "fx_series"),
        "mart_health": _sql(health, "fact", "consensus"),
        "hot_latest_slice": _sql(f"""
            SELECT f.rate_date, f.base_currency, f.target_currency, d.country_name, d.region,
                   {_r('f.exchange_rate', 'f.inverse_rate')}, f.consensus_variance,
                   f.validation_status, f.currency_pair {_HOT_FROM}
            WHERE f.rate_date = (SELECT MAX(rate_date) FROM fact)""", "fact", "fx_dim"),
        # data quality
        "dq_not_null": _sql(_union(*[_check(*r, quotes) for r in _not_null(
            "extraction_id", "exchange_rate", "rate_date", "target_currency")]), quotes),
        "dq_accepted_values": _sql(_union(
            _check(*_values("base_currency", "USD"), quotes),
            _check(*_values("source", "frankfurter", "exchangerate"), quotes)), quotes),
        "dq_unique_combination": _sql(_union(*[
            _check("unique_combination", "source,base_currency,target_currency,rate_date",
                   "COUNT(*)",
                   f"(SELECT 1 FROM {t} GROUP BY {_STG_KEY} HAVING COUNT(*) > 1)")
            for t in (quotes, "stg")]), "stg"),
        "dq_expression_true": _sql(_union(
            _check(*_expr("exchange_rate", "> 0"), quotes),
            _check(*_expr("exchange_rate", "< 12.5"), quotes)), quotes),
        "dq_contract": _sql(_union(*[_check(*r, "fact") for r in contract]), "fact"),
        "dq_contract_enforced": _sql(f"SELECT {_LINEAGE} FROM fact", "fact"),
        "dq_recency": _sql(_union(*[
            _check("recency", "rate_date",
                   f"MAX(rate_date) < DATE '2024-02-01' - INTERVAL '{n}' DAY", "fact")
            for n in (7, 0)]), "fact"),
        "dq_row_count": _sql(_union(
            _check("row_count", "*", "COUNT(*) <> 1", f"({health})"),
            _check("row_count", "*", "COUNT(*) <> 1", "fx_series")),
            "fact", "consensus", "fx_series"),
        "dq_min_distinct": _sql(_union(*[
            _check("min_distinct", "target_currency",
                   f"COUNT(DISTINCT target_currency) < {n}", "fx_series")
            for n in (10, 100)]), "fx_series"),
        "dq_severity": _sql(f"""
            SELECT metric, value, CASE WHEN value < error_below THEN 'error'
                                       WHEN value < warn_below THEN 'warn' ELSE 'pass' END AS grade
            FROM (SELECT 'ok_rate' AS metric, 0.9 AS warn_below, 0.8 AS error_below,
                         ROUND({_count('exchange_rate IS NOT NULL')} / COUNT(*), 4) AS value
                  FROM {quotes}
                  UNION ALL
                  SELECT 'currency_count', 100, 0,
                         CAST(COUNT(DISTINCT target_currency) AS DOUBLE) FROM {quotes}) t""",
            quotes),
        "dq_declared_suites": _declared(),
        # quota
        "quota_cycles": _sql("SELECT * FROM cycles", "cycles"),
        "quota_usage": _sql("SELECT * FROM usage", "usage"),
        "quota_status": _sql("""
            SELECT n.api_source, COALESCE(a.available, TRUE) AS available
            FROM (SELECT DISTINCT api_source FROM fx_calls
                  UNION SELECT r_name FROM region) n
            LEFT JOIN available a USING (api_source)""", "fx_calls", "available"),
        "quota_failover": _sql("""
            SELECT u.priority, u.api_source, u.failover_to, a.available AS failover_available
            FROM usage u LEFT JOIN available a ON a.api_source = u.failover_to
            WHERE u.status = 'throttled' ORDER BY 1""", "usage", "available"),
        "source_gating": _sql("""
            SELECT r.mode, r.include_third, c.api_source,
                   CASE c.api_source WHEN 'frankfurter' THEN TRUE
                     WHEN 'exchangerate' THEN r.mode = 'daily' AND s.second_ok
                     ELSE CASE r.mode WHEN 'daily' THEN r.include_third OR NOT s.second_ok
                               ELSE s.third_ok END END AS participates
            FROM (VALUES ('daily', FALSE), ('daily', TRUE), ('backfill', FALSE))
                   r(mode, include_third)
            CROSS JOIN config c
            CROSS JOIN (SELECT bool_and(available) FILTER (WHERE api_source = 'exchangerate')
                                 AS second_ok,
                               bool_and(available) FILTER (WHERE api_source = 'currencylayer')
                                 AS third_ok FROM available) s""", "available", "config"),
        # runs and streams
        "daily_run": _run_fact(
            ("frankfurter", "exchangerate", "currencylayer"),
            "rate_date BETWEEN DATE '2024-01-17' AND DATE '2024-01-20'"),
        "backfill_run": _run_fact(("frankfurter", "currencylayer"), "TRUE"),
        "backfill_run_months": _BACKFILL_OVER_MONTHS,
        "pipeline_backfill": _BACKFILL_OVER_MONTHS,
        "pipeline_daily": _without_id(_run_fact(
            ("frankfurter", "currencylayer"),
            "rate_date BETWEEN DATE '2024-01-17' AND DATE '2024-01-20'")),
        "stream_land_to_silver": _SILVER_LONG,
        # The first file comes twice: its second batch has no new record and is not told of.
        "stream_late_records": _sql("""
            SELECT concat('late_', extraction_id) AS extraction_id, source, base_currency, rate_date,
                   count(*) OVER () AS late_rows, CAST(5 AS BIGINT) AS batches
            FROM fx_wide WHERE date_diff('day', (SELECT MIN(rate_date) FROM fx_wide), rate_date) < 18
              AND date_diff('day', (SELECT MIN(rate_date) FROM fx_wide), rate_date) % 11 = 0""", "fx_wide"),
        "stream_quota_meter": _sql(
            "SELECT api_source, cycle_start, request_count FROM cycles", "cycles"),
    }
