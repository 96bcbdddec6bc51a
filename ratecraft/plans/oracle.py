"""Plain SQL (DuckDB dialect) computing the same results as the registered
queries, over the pre-registered test tables. Column names equal the Spark
side's; doubles are rounded to 8 places where the Spark side rounds.
"""

from __future__ import annotations

# -- shared fragments ---------------------------------------------------------

_COMPOUND = (
    "CASE WHEN MIN(1.0 + {c} / 100.0){over} > 0 "
    "THEN (EXP(SUM(LN(1.0 + {c} / 100.0)){over}) - 1.0) * 100.0 END"
)


def _compound(col: str, over: str = "") -> str:
    return _COMPOUND.format(c=col, over=over)


def _real(n: str, p: str) -> str:
    return f"((1.0 + {n} / 100.0) / (1.0 + {p} / 100.0) - 1.0) * 100.0"


def nominal_monthly(keyed: bool = True) -> str:
    key = "l_returnflag, " if keyed else ""
    return f"""
    SELECT {key}CAST(date_trunc('month', l_shipdate) AS DATE) AS reference_month,
           AVG(l_discount) AS nominal_daily_average_pct,
           {_compound('l_discount')} AS nominal_monthly_effective_pct,
           COUNT(*) AS nominal_observation_count
    FROM lineitem
    GROUP BY ALL"""


REFERENCE_MONTHLY = """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month,
           CAST(o_totalprice / 10000.0 AS DOUBLE) AS inflation_monthly_pct
    FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY date_trunc('month', o_orderdate)
        ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


def mart(keyed: bool = True) -> str:
    key = "l_returnflag, " if keyed else ""
    part = "PARTITION BY l_returnflag " if keyed else ""
    win = " OVER win"
    return f"""
    WITH nom AS ({nominal_monthly(keyed)}),
    ref AS ({REFERENCE_MONTHLY}),
    j AS (SELECT * FROM nom JOIN ref USING (reference_month)),
    w AS (
        SELECT *,
               COUNT(*){win} AS rows_in_frame,
               {_compound('nominal_monthly_effective_pct', win)} AS acc_n,
               {_compound('inflation_monthly_pct', win)} AS acc_p
        FROM j
        WINDOW win AS ({part}ORDER BY reference_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
    SELECT {key}reference_month,
           ROUND(nominal_daily_average_pct, 8) AS nominal_daily_average_pct,
           ROUND(nominal_monthly_effective_pct, 8) AS nominal_monthly_effective_pct,
           ROUND(inflation_monthly_pct, 8) AS inflation_monthly_pct,
           ROUND({_real('nominal_monthly_effective_pct', 'inflation_monthly_pct')}, 8)
               AS real_interest_monthly_pct,
           ROUND(CASE WHEN rows_in_frame = 12 THEN acc_n END, 8) AS nominal_accumulated_12m_pct,
           ROUND(CASE WHEN rows_in_frame = 12 THEN acc_p END, 8) AS inflation_accumulated_12m_pct,
           ROUND(CASE WHEN rows_in_frame = 12 THEN {_real('acc_n', 'acc_p')} END, 8)
               AS real_interest_accumulated_12m_pct,
           nominal_observation_count
    FROM w"""


def _rate_text(value: str, comma: str | None = None) -> str:
    text = f"CAST(CAST({value} AS DECIMAL(18,6)) AS VARCHAR)"
    if comma is None:
        return text
    return f"CASE WHEN {comma} THEN replace({text}, '.', ',') ELSE {text} END"


def _parsed_rate(raw: str) -> str:
    return f"TRY_CAST(replace({raw}, ',', '.') AS DECIMAL(18,8))"


def rendered_orders(shift: str = "0.0") -> str:
    """Orders as raw records: status, raw date and raw rate text, plus the order date."""
    rate = f"(o_totalprice + {shift}) / 10000.0"
    return f"""
    SELECT o_orderstatus AS series_name,
           strftime(o_orderdate, '%d/%m/%Y') AS data_raw,
           {_rate_text(rate, 'o_orderkey % 2 = 1')} AS valor_raw,
           o_orderdate
    FROM orders"""


def typed_orders(shift: str = "0.0") -> str:
    return f"""
    SELECT series_name,
           CAST(strptime(data_raw, '%d/%m/%Y') AS DATE) AS reference_date,
           {_parsed_rate('valor_raw')} AS rate_pct,
           o_orderdate
    FROM ({rendered_orders(shift)})"""


CONFORMED_ORDERS = f"""
    SELECT series_name, reference_date, rate_pct
    FROM ({typed_orders()})
    QUALIFY row_number() OVER (
        PARTITION BY series_name, reference_date
        ORDER BY reference_date DESC, rate_pct DESC NULLS LAST) = 1"""


def _rolling_keyed() -> str:
    win = " OVER win"
    return f"""
    WITH nom AS ({nominal_monthly(True)}),
    ref AS ({REFERENCE_MONTHLY}),
    j AS (SELECT * FROM nom JOIN ref USING (reference_month))
    SELECT l_returnflag, reference_month,
           COUNT(*){win} AS months_in_window,
           {_compound('nominal_monthly_effective_pct', win)} AS acc_n,
           {_compound('inflation_monthly_pct', win)} AS acc_p
    FROM j
    WINDOW win AS (PARTITION BY l_returnflag ORDER BY reference_month
                   ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""


def _gold_report(mart_sql: str, key: str) -> str:
    required = [
        "reference_month",
        "nominal_daily_average_pct",
        "nominal_monthly_effective_pct",
        "inflation_monthly_pct",
        "real_interest_monthly_pct",
    ]
    any_null = " OR ".join(f"{c} IS NULL" for c in required)
    return f"""
    SELECT 'gold_monthly' AS dataset, 'not_empty' AS rule, COUNT(*) AS checked,
           CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM ({mart_sql})
    UNION ALL
    SELECT 'gold_monthly', 'not_null({','.join(required)})', COUNT(*),
           COUNT(*) FILTER (WHERE {any_null}) FROM ({mart_sql})
    UNION ALL
    SELECT 'gold_monthly', 'positive(nominal_observation_count)', COUNT(*),
           COUNT(*) FILTER (WHERE nominal_observation_count <= 0) FROM ({mart_sql})
    UNION ALL
    SELECT 'gold_monthly', 'unique_key({key},reference_month)', COUNT(*),
           COUNT(*) FILTER (WHERE n > 1)
    FROM (SELECT {key}, reference_month, COUNT(*) AS n FROM ({mart_sql}) GROUP BY ALL)"""


def _silver_report() -> str:
    s = CONFORMED_ORDERS
    return f"""
    SELECT 'silver_orders' AS dataset, 'not_empty' AS rule, COUNT(*) AS checked,
           CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM ({s})
    UNION ALL
    SELECT 'silver_orders', 'not_null(reference_date,rate_pct)', COUNT(*),
           COUNT(*) FILTER (WHERE reference_date IS NULL OR rate_pct IS NULL) FROM ({s})
    UNION ALL
    SELECT 'silver_orders', 'in_range(rate_pct,0.1,40)', COUNT(*),
           COUNT(*) FILTER (WHERE NOT (rate_pct BETWEEN 0.1 AND 40)) FROM ({s})
    UNION ALL
    SELECT 'silver_orders', 'unique_key(series_name,reference_date)', COUNT(*),
           COUNT(*) FILTER (WHERE n > 1)
    FROM (SELECT series_name, reference_date, COUNT(*) AS n FROM ({s}) GROUP BY ALL)"""


def _upserted() -> str:
    return """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS reference_date,
           o_totalprice / 10000.0 AS rate_pct,
           CAST(year(o_orderdate) AS INTEGER) AS reference_year
    FROM orders WHERE o_orderdate < DATE '1998-01-01'
    UNION ALL
    SELECT o_orderkey, CAST(o_orderdate AS DATE), (o_totalprice + 100.0) / 10000.0,
           CAST(year(o_orderdate) AS INTEGER)
    FROM orders WHERE o_orderdate >= DATE '1998-01-01'"""


def _events_raw() -> str:
    return f"""
    SELECT strftime(ts, '%d/%m/%Y') AS data_raw,
           {_rate_text('value')} AS valor_raw
    FROM events"""


def _landed_rates(shift: str = "0.0", drop: int = 1, where: str = "TRUE") -> str:
    return f"""
    SELECT l_returnflag AS series_name, CAST(l_shipdate AS DATE) AS reference_date,
           {_parsed_rate(_rate_text(f'l_discount + {shift}'))} AS nominal_daily_pct, {drop} AS batch
    FROM lineitem WHERE {where}"""


def _landed_reference(shift: str = "0.0", drop: int = 1, where: str = "TRUE") -> str:
    return f"""
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month, CAST(o_orderdate AS DATE) AS day,
           {_parsed_rate(_rate_text(f'o_totalprice / 100000.0 + {shift}'))} AS inflation_monthly_pct, {drop} AS batch
    FROM orders WHERE {where}"""


RATES = [_landed_rates()]
REFERENCE = [_landed_reference()]
_EARLY = "l_shipdate < DATE '1996-01-01'"
RATES_TWICE = [
    _landed_rates(where=_EARLY),
    _landed_rates(drop=2, where=f"NOT ({_EARLY})"),
    _landed_rates("0.5", 2, f"{_EARLY} AND day(l_shipdate) = 15"),
]
REFERENCE_TWICE = [*REFERENCE, _landed_reference("0.25", 2, "year(o_orderdate) = 1995")]


def silver_rates(drops: list[str] = RATES) -> str:
    return f"""
    SELECT series_name, reference_date, nominal_daily_pct FROM ({' UNION ALL '.join(drops)})
    QUALIFY row_number() OVER (PARTITION BY series_name, reference_date
                               ORDER BY batch DESC, nominal_daily_pct DESC NULLS LAST) = 1"""


def silver_reference(drops: list[str] = REFERENCE) -> str:
    return f"""
    SELECT reference_month, inflation_monthly_pct FROM ({' UNION ALL '.join(drops)})
    QUALIFY row_number() OVER (PARTITION BY reference_month
                               ORDER BY batch DESC, day DESC, inflation_monthly_pct DESC NULLS LAST) = 1"""


def _layered_gold(rates: list[str] = RATES, reference: list[str] = REFERENCE, half: bool = False) -> str:
    win = " OVER win"
    key, second = ("series_name, half", "CASE WHEN day(reference_date) <= 15 THEN 1 ELSE 2 END AS half,") if half else ("series_name", "")
    daily, monthly = silver_rates(rates), silver_reference(reference)
    return f"""
    WITH daily AS ({daily}),
    nom AS (
        SELECT series_name, {second} CAST(date_trunc('month', reference_date) AS DATE) AS reference_month,
               CAST(AVG(nominal_daily_pct) AS DOUBLE) AS nominal_daily_average_pct,
               {_compound('CAST(nominal_daily_pct AS DOUBLE)')} AS nominal_monthly_effective_pct,
               COUNT(*) AS nominal_observation_count
        FROM daily GROUP BY ALL),
    ref AS (SELECT reference_month, CAST(inflation_monthly_pct AS DOUBLE) AS inflation_monthly_pct
            FROM ({monthly})),
    j AS (SELECT * FROM nom JOIN ref USING (reference_month)),
    w AS (
        SELECT *,
               COUNT(*){win} AS rows_in_frame,
               {_compound('nominal_monthly_effective_pct', win)} AS acc_n,
               {_compound('inflation_monthly_pct', win)} AS acc_p
        FROM j
        WINDOW win AS (PARTITION BY {key} ORDER BY reference_month
                       ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
    SELECT {key}, reference_month,
           ROUND(nominal_daily_average_pct, 8) AS nominal_daily_average_pct,
           ROUND(nominal_monthly_effective_pct, 8) AS nominal_monthly_effective_pct,
           ROUND(inflation_monthly_pct, 8) AS inflation_monthly_pct,
           ROUND({_real('nominal_monthly_effective_pct', 'inflation_monthly_pct')}, 8)
               AS real_interest_monthly_pct,
           ROUND(CASE WHEN rows_in_frame = 12 THEN acc_n END, 8) AS nominal_accumulated_12m_pct,
           ROUND(CASE WHEN rows_in_frame = 12 THEN acc_p END, 8) AS inflation_accumulated_12m_pct,
           ROUND(CASE WHEN rows_in_frame = 12 THEN {_real('acc_n', 'acc_p')} END, 8)
               AS real_interest_accumulated_12m_pct,
           nominal_observation_count
    FROM w"""


_DIRTY_DROPS = f"""
    SELECT *, 0 AS batch, l_discount AS rate FROM lineitem WHERE {_EARLY}
    UNION ALL SELECT *, 1, l_discount FROM lineitem WHERE NOT ({_EARLY})
    UNION ALL SELECT *, 1, l_discount + 0.01 FROM lineitem WHERE {_EARLY} AND day(l_shipdate) = 15"""

#: Landed line items with the rule each one breaks (null: none).
_DIRTY = f"""
    SELECT l_returnflag AS series_name, CAST(l_shipdate AS DATE) AS reference_date, batch,
           {_parsed_rate(_rate_text('rate'))} AS nominal_daily_pct,
           CASE WHEN l_linenumber = 7 THEN 'no valid date' WHEN l_linenumber = 6 THEN 'no valid rate'
                WHEN {_parsed_rate(_rate_text('rate'))} > 0.08 THEN 'rate out of range' END AS refused
    FROM ({_DIRTY_DROPS})"""

MART_MEASURES = [
    "nominal_monthly_effective_pct",
    "inflation_monthly_pct",
    "real_interest_monthly_pct",
    "nominal_accumulated_12m_pct",
    "inflation_accumulated_12m_pct",
    "real_interest_accumulated_12m_pct",
]


def _sums(measures: list[str]) -> str:
    return ", ".join(f"SUM({m}) AS sum_{m}" for m in measures)


ORACLE_SQL: dict[str, str] = {
    "monthly_mart": mart(True),
    "national_mart": mart(False),
    "monthly_rates": f"""
        SELECT l_returnflag, reference_month,
               ROUND(nominal_daily_average_pct, 8) AS nominal_daily_average_pct,
               ROUND(nominal_monthly_effective_pct, 8) AS nominal_monthly_effective_pct,
               nominal_observation_count
        FROM ({nominal_monthly(True)})""",
    "monthly_reference": REFERENCE_MONTHLY,
    "join_monthly": f"""
        SELECT reference_month,
               ROUND(nominal_daily_average_pct, 8) AS nominal_daily_average_pct,
               ROUND(nominal_monthly_effective_pct, 8) AS nominal_monthly_effective_pct,
               nominal_observation_count, inflation_monthly_pct
        FROM ({nominal_monthly(False)}) JOIN ({REFERENCE_MONTHLY}) USING (reference_month)""",
    "real_rate": f"""
        SELECT l_returnflag, reference_month,
               ROUND(nominal_monthly_effective_pct, 8) AS nominal_monthly_effective_pct,
               inflation_monthly_pct,
               ROUND({_real('nominal_monthly_effective_pct', 'inflation_monthly_pct')}, 8)
                   AS real_interest_monthly_pct
        FROM ({nominal_monthly(True)}) JOIN ({REFERENCE_MONTHLY}) USING (reference_month)""",
    "rolling_12m": f"""
        SELECT l_returnflag, reference_month, months_in_window,
               ROUND(acc_n, 8) AS nominal_monthly_effective_pct_accumulated_12m_raw,
               ROUND(acc_p, 8) AS inflation_monthly_pct_accumulated_12m_raw
        FROM ({_rolling_keyed()})""",
    "full_window_only": f"""
        SELECT l_returnflag, reference_month, months_in_window,
               ROUND(CASE WHEN months_in_window = 12 THEN acc_n END, 8) AS nominal_accumulated_12m_pct,
               ROUND(CASE WHEN months_in_window = 12 THEN acc_p END, 8) AS inflation_accumulated_12m_pct
        FROM ({_rolling_keyed()})""",
    "window_coverage": f"""
        SELECT COUNT(*) AS total_months,
               COUNT(*) FILTER (WHERE nominal_accumulated_12m_pct IS NULL) AS months_without_full_window,
               COUNT(*) FILTER (WHERE nominal_accumulated_12m_pct IS NOT NULL) AS months_with_full_window
        FROM ({mart(True)})""",
    "conform_typed": f"SELECT series_name, reference_date, rate_pct FROM ({typed_orders()})",
    "conform_daily": CONFORMED_ORDERS,
    "series_range": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS reference_date,
               o_totalprice / 10000.0 AS rate_pct
        FROM orders
        WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01'""",
    "dedup_latest": """
        SELECT * FROM events
        QUALIFY row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "backfill_latest": f"""
        WITH a AS (
            SELECT series_name, reference_date, rate_pct, 'orders_a.json' AS source_file, 1 AS batch
            FROM ({typed_orders()}) WHERE o_orderdate < DATE '1999-01-01'),
        b AS (
            SELECT series_name, reference_date, rate_pct, 'orders_b.json' AS source_file, 2 AS batch
            FROM ({typed_orders('100.0')}) WHERE o_orderdate >= DATE '1998-01-01')
        SELECT series_name, reference_date, rate_pct, source_file
        FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
        QUALIFY row_number() OVER (
            PARTITION BY series_name, reference_date
            ORDER BY batch DESC, rate_pct DESC NULLS LAST) = 1""",
    "dq_report": f"{_gold_report(mart(True), 'l_returnflag')}\n UNION ALL {_silver_report()}",
    "dq_duplicate_keys": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "dq_range_rows": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS reference_date,
               o_totalprice / 10000.0 AS rate_pct
        FROM orders WHERE NOT (o_totalprice / 10000.0 BETWEEN 0.1 AND 40)""",
    "raw_contract": """
        SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE hour(ts) = 0) AS missing_data,
               COUNT(*) FILTER (WHERE value IS NULL OR value < 1) AS missing_valor, 1 AS empty_files,
               FALSE AS contract_ok
        FROM events""",
    "raw_records": """
        SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE hour(ts) = 0) AS missing_data,
               COUNT(*) FILTER (WHERE value IS NULL OR value < 1) AS missing_valor,
               COUNT(*) FILTER (WHERE hour(ts) = 0 OR value IS NULL OR value < 1) AS invalid_records,
               COUNT(*) > 0 AND COUNT(*) FILTER (WHERE hour(ts) = 0 OR value IS NULL OR value < 1) = 0 AS contract_ok
        FROM events""",
    "contract_log": """
        SELECT CASE WHEN hour(ts) >= 12 THEN 1 ELSE 0 END::BIGINT AS drop, COUNT(*) AS records,
               COUNT(*) FILTER (WHERE hour(ts) = 0) AS missing_data,
               COUNT(*) FILTER (WHERE value IS NULL OR value < 1) AS missing_valor,
               1::BIGINT AS empty_files, 2::BIGINT AS stopped_runs
        FROM events GROUP BY 1""",
    "ingest_lineage": """
        SELECT COUNT(*) AS records, COUNT(*) AS with_lineage, COUNT(*) AS stamped_after_landing,
               CAST(1 AS BIGINT) AS ingestion_times, CAST(1 AS BIGINT) AS series
        FROM events""",
    "ingest_arrays": f"SELECT data_raw, valor_raw, 'events' AS series_name FROM ({_events_raw()})",
    "ingest_append": f"SELECT data_raw, valor_raw, 'events' AS series_name FROM ({_events_raw()})",
    "upsert_merge": _upserted(),
    "upsert_rerun": _upserted(),
    "audit_counts": f"""
        WITH gold AS ({_layered_gold()})
        SELECT 'bronze_rates' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT l_shipdate) AS distinct_keys,
               COUNT(DISTINCT l_shipdate) AS distinct_known_keys FROM lineitem
        UNION ALL
        SELECT 'bronze_reference', COUNT(*), COUNT(DISTINCT o_orderdate), COUNT(DISTINCT o_orderdate) FROM orders
        UNION ALL
        SELECT 'silver_rates', COUNT(*), COUNT(*), COUNT(*) FROM ({silver_rates()})
        UNION ALL
        SELECT 'silver_reference', COUNT(*), COUNT(*), COUNT(*) FROM ({silver_reference()})
        UNION ALL
        SELECT 'gold', COUNT(*), COUNT(*), COUNT(*) FROM gold
        UNION ALL
        SELECT 'orders_days', SUM(n)::BIGINT, COUNT(*), COUNT(day)
        FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day, COUNT(*) AS n
              FROM orders GROUP BY 1)""",
    "grain_check": f"""
        SELECT COUNT(*) AS total_rows, COUNT(DISTINCT reference_month) AS distinct_months,
               MIN(reference_month) AS first_month, MAX(reference_month) AS last_month
        FROM ({mart(False)})""",
    "latest_month": f"""
        SELECT reference_month, nominal_monthly_effective_pct, inflation_monthly_pct,
               real_interest_monthly_pct
        FROM ({mart(False)}) ORDER BY reference_month DESC LIMIT 1""",
    "latest_12": f"SELECT * FROM ({mart(False)}) ORDER BY reference_month DESC LIMIT 12",
    "dash_monthly": f"""
        SELECT CAST(date_trunc('month', reference_month) AS DATE) AS month, {_sums(MART_MEASURES)}
        FROM ({mart(False)}) GROUP BY 1""",
    "dash_latest": f"""
        SELECT {_sums(MART_MEASURES[:3])}
        FROM (SELECT * FROM ({mart(False)}) ORDER BY reference_month DESC LIMIT 1)""",
    "metric_count": f"SELECT COUNT(*) AS count FROM ({mart(False)})",
    "latest_keyed": f"""
        SELECT * FROM ({mart(True)})
        QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY reference_month DESC) <= 3""",
    "dash_latest_keyed": f"""
        SELECT l_returnflag, {_sums(MART_MEASURES[:3])}
        FROM (SELECT * FROM ({mart(True)})
              QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY reference_month DESC) = 1)
        GROUP BY l_returnflag""",
    "ordered_mart": f"""
        SELECT l_returnflag, reference_month,
               row_number() OVER (PARTITION BY l_returnflag ORDER BY reference_month) AS row_in_series
        FROM ({mart(True)})""",
    "dropped_months": f"""
        WITH nom AS (SELECT DISTINCT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS reference_month FROM lineitem),
        ref AS ({REFERENCE_MONTHLY})
        SELECT l_suppkey, reference_month, 'nominal_only' AS side
        FROM nom WHERE reference_month NOT IN (SELECT reference_month FROM ref)
        UNION ALL
        SELECT s.l_suppkey, ref.reference_month, 'reference_only'
        FROM (SELECT DISTINCT l_suppkey FROM nom) s, ref
        WHERE NOT EXISTS (FROM nom n WHERE n.l_suppkey = s.l_suppkey AND n.reference_month = ref.reference_month)""",
    "frame_gaps": """
        WITH m AS (
            SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month
            FROM orders GROUP BY ALL),
        f AS (
            SELECT o_custkey, reference_month,
                   COUNT(*) OVER win AS months_in_window,
                   MIN(reference_month) OVER win AS first_month_in_window
            FROM m
            WINDOW win AS (PARTITION BY o_custkey ORDER BY reference_month
                           ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
        SELECT *, CAST(date_diff('month', first_month_in_window, reference_month) + 1 AS BIGINT)
                  AS months_spanned
        FROM f
        WHERE date_diff('month', first_month_in_window, reference_month) + 1 <> months_in_window""",
    "layered_gold": _layered_gold(),
    "layered_gold_rerun": f"SELECT COUNT(*) AS rows, COUNT(*) AS rows_again FROM ({_layered_gold()})",
    "rerun_differences": f"""
        WITH a AS ({_layered_gold()}), b AS ({_layered_gold(RATES, REFERENCE_TWICE)}),
        d AS (SELECT * FROM (FROM a EXCEPT FROM b) UNION ALL (FROM b EXCEPT FROM a))
        SELECT y AS reference_year, (SELECT COUNT(*) FROM a WHERE year(reference_month) = y) AS rows_before,
               (SELECT COUNT(*) FROM b WHERE year(reference_month) = y) AS rows_after
        FROM (SELECT DISTINCT year(reference_month)::INTEGER AS y FROM d)""",
    "layered_gold_by_half": _layered_gold(RATES_TWICE, REFERENCE_TWICE, half=True),
    "silver_quarantine": f"""
        SELECT series_name, CAST(batch AS BIGINT) AS batch_id, refused, COUNT(*) AS records,
               COUNT(DISTINCT reference_date) AS days
        FROM ({_DIRTY}) WHERE refused IS NOT NULL GROUP BY ALL""",
    "silver_valid": f"""
        SELECT series_name, reference_date, CAST(nominal_daily_pct AS DOUBLE) AS nominal_daily_pct
        FROM ({_DIRTY}) WHERE refused IS NULL
        QUALIFY row_number() OVER (PARTITION BY series_name, reference_date
                                   ORDER BY batch DESC, nominal_daily_pct DESC) = 1""",
    # two drops of files; the newer record of a key wins
    "layered_gold_incremental": _layered_gold(RATES_TWICE, REFERENCE_TWICE),
}
