"""DuckDB SQL that each registered query must agree with.

The SQL joins separate aggregates and counts distinct values directly, where
the Spark side fuses them, so agreement also shows that the fusion is right.
"""

from __future__ import annotations

# ---------------------------------------------------------------- input views

_BASE = """
base AS (
  SELECT r_name AS mkt, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS qtr,
         l_partkey AS item, l_returnflag AS cond, l_orderkey, p_size,
         CAST(l_quantity AS DECIMAL(18,2)) AS q,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS v,
         CAST(p_size % 4 AS DECIMAL(18,2)) AS cf,
         CAST(l_quantity * p_retailprice AS DECIMAL(18,2)) AS w
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""

_RAW = """
raw_pricing AS (
  SELECT mkt AS market_name, 'QTR ' || CAST(qtr AS VARCHAR) AS time_period,
         CAST(item AS VARCHAR) AS upc, q AS units,
         CAST(q * cf AS DECIMAL(18,2)) AS comp_units, v AS dollars,
         CAST(v * cf AS DECIMAL(18,2)) AS comp_dollars
  FROM base)"""


def _pricing(name: str, keep: str) -> str:
    return f"""
{name} AS (
  SELECT mkt AS market_name, CAST(qtr AS VARCHAR) || ' QTR' AS time_period,
         CAST(item AS VARCHAR) AS upc, cond AS condition,
         CAST(SUM(q) AS DECIMAL(18,2)) AS units, CAST(SUM(v) AS DECIMAL(18,2)) AS dollars,
         CAST(SUM(CAST(q * cf AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS market_units,
         CAST(SUM(CAST(v * cf AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS market_dollars,
         CAST(SUM(w) AS DECIMAL(18,2)) AS price_weighted_volume,
         CASE WHEN MAX(p_size) <= 10 AND qtr <> DATE '1999-01-01'
              THEN 'KVI' ELSE 'Non-KVI' END AS kvi_quad,
         CASE WHEN item % 50 = 0 THEN NULL
              WHEN CAST(SUM(v) AS DOUBLE) / CAST(SUM(w) AS DOUBLE) > 4 THEN 'Outlier'
              ELSE 'Normal' END AS outlier_flag
  FROM base WHERE {keep}
  GROUP BY mkt, qtr, item, cond)"""


_CURRENT = _pricing(
    "pricing_current",
    """NOT (year(qtr) = 1996 AND l_orderkey % 50 = 0)
    AND NOT (year(qtr) = 1997 AND l_orderkey % 5 = 0)
    AND NOT (qtr = DATE '1998-01-01' AND mkt = 'AFRICA')""",
)
_PRIOR = _pricing("pricing_prior", "qtr < DATE '2001-07-01'")
_DIRTY = """
pricing_dirty AS (
  SELECT * FROM pricing_current
  UNION ALL
  SELECT * FROM pricing_current WHERE CAST(upc AS BIGINT) % 97 = 0)"""
_CODES = """
codes AS (
  SELECT CASE WHEN p_partkey % 25 <> 0 THEN p_name || stray END AS original_upc,
         CASE WHEN p_partkey % 25 <> 0 THEN CAST(p_partkey AS VARCHAR) || stray END AS upc
  FROM (SELECT p_partkey, p_name,
               CASE p_partkey % 9 WHEN 0 THEN chr(9) WHEN 1 THEN chr(11) WHEN 2 THEN chr(8)
                 WHEN 3 THEN chr(13) WHEN 4 THEN chr(10) WHEN 5 THEN chr(12)
                 WHEN 6 THEN chr(255) WHEN 7 THEN chr(160) ELSE '' END AS stray
        FROM part) AS p)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# ------------------------------------------------------------- shared pieces


def _pct(new: str, old: str) -> str:
    return f"round(CAST({new} - {old} AS DOUBLE) / CAST({old} AS DOUBLE), 4)"


def _loss(name: str, threshold: str, word: str = "FAIL") -> str:
    return f"CASE WHEN {name} < {threshold} THEN '{word}' ELSE 'PASS' END"


_INDEX = (
    "SUM(100 * (CAST(dollars AS DOUBLE) / CAST(price_weighted_volume AS DOUBLE))"
    " * CAST(units AS DOUBLE)) / CAST(SUM(units) AS DOUBLE)"
)

_RAW_VOLUME = """
raw_volume AS (
  SELECT market_name, CAST(right(time_period, 10) AS DATE) AS period_date,
         COUNT(upc) AS raw_item_count, SUM(units) AS raw_client_units,
         SUM(comp_units) AS raw_rom_units, SUM(dollars) AS raw_client_dollars,
         SUM(comp_dollars) AS raw_rom_dollars
  FROM raw_pricing WHERE units > 10 AND comp_units > 0
  GROUP BY market_name, time_period)"""
_TEMPLATE_VOLUME = """
template_volume AS (
  SELECT market_name, CAST(left(time_period, 10) AS DATE) AS period_date,
         CAST(COUNT(upc) AS DOUBLE) AS template_item_count,
         SUM(units) AS template_client_units, SUM(market_units) AS template_rom_units,
         SUM(dollars) AS template_client_dollars, SUM(market_dollars) AS template_rom_dollars
  FROM pricing_current WHERE units > 10 AND market_units > 0
  GROUP BY market_name, time_period)"""

_COVERAGE_MEASURES = ["item_count", "client_units", "rom_units", "client_dollars", "rom_dollars"]
_COVERAGE = (
    """
coverage AS (
  SELECT r.market_name, r.period_date, """
    + ", ".join(f"r.raw_{m}, t.template_{m}" for m in _COVERAGE_MEASURES)
    + ", "
    + ", ".join(f"{_pct(f't.template_{m}', f'r.raw_{m}')} AS {m}_pct_diff" for m in _COVERAGE_MEASURES)
    + """
  FROM raw_volume r JOIN template_volume t
    ON r.market_name = t.market_name AND r.period_date = t.period_date
  WHERE r.market_name = 'ASIA' OR r.market_name = 'EUROPE')"""
)
_COVERAGE_CTES = (_BASE, _RAW, _CURRENT, _RAW_VOLUME, _TEMPLATE_VOLUME, _COVERAGE)


def _coverage_report(item_count_word: str = "FAIL") -> str:
    return (
        _with(*_COVERAGE_CTES)
        + f"""
SELECT market_name AS "Market Name", period_date AS "Time Period",
  {_loss("item_count_pct_diff", "-0.15", item_count_word)} AS "ITEM COUNT FLAG",
  {_loss("client_units_pct_diff", "-0.25")} AS "Client UNITS FLAG",
  {_loss("rom_units_pct_diff", "-0.25")} AS "ROM UNITS FLAG",
  {_loss("client_dollars_pct_diff", "-0.25")} AS "Client DOLLARS FLAG",
  {_loss("rom_dollars_pct_diff", "-0.25")} AS "ROM DOLLARS FLAG",
  raw_item_count AS "Raw UPC Count",
  CAST(raw_client_units AS DOUBLE) AS "Raw Client Units",
  CAST(raw_rom_units AS DOUBLE) AS "Raw ROM Units",
  CAST(raw_client_dollars AS DOUBLE) AS "Raw Client Dollars",
  CAST(raw_rom_dollars AS DOUBLE) AS "Raw ROM Dollars",
  template_item_count AS "Template UPC Count",
  CAST(template_client_units AS DOUBLE) AS "Template Client Units",
  CAST(template_rom_units AS DOUBLE) AS "Template ROM Units",
  CAST(template_client_dollars AS DOUBLE) AS "Template Client Dollars",
  CAST(template_rom_dollars AS DOUBLE) AS "Template ROM Dollars",
  item_count_pct_diff AS "Item Count % Difference",
  client_units_pct_diff AS "Client Units % Difference",
  rom_units_pct_diff AS "ROM Units % Difference",
  client_dollars_pct_diff AS "Client Dollars % Difference",
  rom_dollars_pct_diff AS "ROM Dollars % Difference"
FROM coverage ORDER BY period_date, market_name"""
    )


def _metrics(side: str) -> str:
    table = f"pricing_{side}"
    return f"""
{side}_metrics AS (
  SELECT time_period, condition, {_INDEX} AS {side}_index,
         CAST(COUNT(DISTINCT upc) AS DOUBLE) AS {side}_item_count,
         CAST(SUM(dollars) AS DOUBLE) AS {side}_focus_dollars,
         CAST(SUM(units) AS DOUBLE) AS {side}_focus_units,
         CAST(SUM(market_dollars) AS DOUBLE) AS {side}_rom_dollars,
         CAST(SUM(market_units) AS DOUBLE) AS {side}_rom_units,
         CAST(COUNT(DISTINCT market_name) AS DOUBLE) AS {side}_markets
  FROM {table} GROUP BY time_period, condition)"""


_BACK_MEASURES = [
    "item_count", "index", "focus_dollars", "focus_units", "rom_dollars", "rom_units", "markets",
]
_BACK_TITLES = {
    "item_count": ("Item Count Flag", "Item Count % Difference", "Item Count"),
    "index": ("Index Flag", "Index % Difference", "Index"),
    "focus_dollars": ("Focus Dollars Flag", "Focus Dollar % Difference", "Focus Dollars"),
    "focus_units": ("Focus Units Flag", "Focus Unit % Difference", "Focus Units"),
    "rom_dollars": ("ROM Dollars Flag", "ROM Dollar % Difference", "ROM Dollars"),
    "rom_units": ("ROM Units Flag", "ROM Unit % Difference", "ROM Units"),
    "markets": ("Markets Flag", "Market % Difference", "Markets"),
}
_BACK = (
    """
paired AS (
  SELECT p.time_period, p.condition, """
    + ", ".join(
        f"round({s[0]}.{s}_{m}, 4) AS {s}_{m}" if m == "index" else f"{s[0]}.{s}_{m}"
        for m in _BACK_MEASURES
        for s in ("prior", "current")
    )
    + """
  FROM prior_metrics p JOIN current_metrics c
    ON p.time_period = c.time_period AND p.condition = c.condition),
back_data AS (
  SELECT *, """
    + ", ".join(f"{_pct(f'current_{m}', f'prior_{m}')} AS {m}_pct_diff" for m in _BACK_MEASURES)
    + """
  FROM paired)"""
)
_BACK_CTES = (_BASE, _CURRENT, _PRIOR, _metrics("prior"), _metrics("current"), _BACK)


def _back_columns() -> str:
    out = []
    for m, (flag, diff, value) in _BACK_TITLES.items():
        out.append(
            f"CASE WHEN prior_{m} = current_{m} THEN 'PASS'"
            f" WHEN {m}_pct_diff BETWEEN -0.03 AND 0.03 THEN 'INVESTIGATE'"
            f" ELSE 'FAIL' END AS \"{flag}\""
        )
        out.append(f'{m}_pct_diff AS "{diff}"')
        out.append(f'prior_{m} AS "Prior {value}"')
        out.append(f'current_{m} AS "Current {value}"')
    return ",\n  ".join(out)


_COUNTS = """
all_items AS (
  SELECT time_period, COUNT(DISTINCT market_name) AS market_count,
         COUNT(DISTINCT condition) AS condition_count, COUNT(*) AS row_count,
         COUNT(DISTINCT upc) AS item_count, SUM(dollars) AS dollars, SUM(units) AS units,
         SUM(market_dollars) AS market_dollars, SUM(market_units) AS market_units
  FROM pricing_current GROUP BY time_period),
kvi_items AS (
  SELECT time_period, COUNT(DISTINCT upc) AS kvi_item_count
  FROM pricing_current WHERE kvi_quad = 'KVI' GROUP BY time_period),
counts AS (
  SELECT a.*, k.kvi_item_count
  FROM all_items a LEFT JOIN kvi_items k ON a.time_period = k.time_period)"""


def _index_side(name: str, prefix: str, keep: str) -> str:
    return f"""
{name} AS (
  SELECT time_period, condition, round({_INDEX}, 4) AS {name},
         CAST(SUM(dollars) AS DOUBLE) AS {prefix}dollars,
         CAST(SUM(units) AS DOUBLE) AS {prefix}units,
         CAST(SUM(market_dollars) AS DOUBLE) AS {prefix}market_dollars,
         CAST(SUM(market_units) AS DOUBLE) AS {prefix}market_units
  FROM pricing_current WHERE {keep} GROUP BY time_period, condition)"""


_STORE = _index_side("store_index", "", "outlier_flag <> 'Outlier'")
_KVI = _index_side("kvi_index", "kvi_", "kvi_quad = 'KVI' AND outlier_flag <> 'Outlier'")
_REPORT = """
report AS (
  SELECT s.*, k.kvi_index, k.kvi_dollars, k.kvi_units, k.kvi_market_dollars,
         k.kvi_market_units, CAST(c.market_count AS DOUBLE) AS market_count,
         CAST(c.condition_count AS DOUBLE) AS condition_count,
         CAST(c.item_count AS DOUBLE) AS item_count,
         CAST(c.kvi_item_count AS DOUBLE) AS kvi_item_count
  FROM store_index s
  LEFT JOIN kvi_index k ON s.time_period = k.time_period AND s.condition = k.condition
  LEFT JOIN counts c ON s.time_period = c.time_period)"""
_REPORT_CTES = (_BASE, _CURRENT, _COUNTS, _STORE, _KVI, _REPORT)

_INDEX_REPORT = (
    _with(*_REPORT_CTES)
    + """
SELECT time_period AS "Time_Period", condition AS "Condition",
  store_index AS "Total Store Index", dollars AS "Dollars", units AS "Units",
  market_dollars AS "Market Dollars", market_units AS "Market Units",
  kvi_index AS "KVI Store Index", kvi_dollars AS "KVI Dollars", kvi_units AS "KVI Units",
  kvi_market_dollars AS "Market KVI Dollars", kvi_market_units AS "Market KVI Units",
  market_count AS "Count of Markets", condition_count AS "Count of Retail Conditions",
  item_count AS "Distinct Item Count - Total Store",
  kvi_item_count AS "Distinct Item Count - KVI"
FROM report ORDER BY time_period, condition"""
)

_CHARACTERS = {
    "space": 32, "horizontal_tab": 9, "vertical_tab": 11, "backspace": 8,
    "carriage_return": 13, "newline": 10, "formfeed": 12, "nonbreakingspace": 255,
}
_WITH_NBSP = {**_CHARACTERS, "nbsp_160": 160}


def _profile(column: str, characters: dict[str, int]) -> str:
    flags = ", ".join(
        f"CASE WHEN strpos({column}, chr({c})) > 0 THEN 1 ELSE 0 END AS {n}"
        for n, c in characters.items()
    )
    return f"SELECT DISTINCT {column}, {flags} FROM codes"


def _profile_summary(table: str, column: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"character\", {c} AS code, COUNT(*) AS value_count"
        f" FROM {table} WHERE strpos({column}, chr({c})) > 0"
        for n, c in _WITH_NBSP.items()
    )


def _strip(column: str, codes) -> str:
    for code in codes:
        column = f"replace({column}, chr({code}), '')"
    return column


def _key_status(old: str, new: str, keys: list[str]) -> str:
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    columns = ", ".join(f"COALESCE(o.{k}, n.{k}) AS {k}" for k in keys)
    return f"""
SELECT {columns},
  CASE WHEN n.{keys[0]} IS NULL THEN 'missing'
       WHEN o.{keys[0]} IS NULL THEN 'new' ELSE 'both' END AS key_status
FROM {old} o FULL OUTER JOIN {new} n ON {on}"""


def _duplication(table: str) -> str:
    return f"""
SELECT combinations AS "Duplication Check 1 - Distinct Combinations",
       total AS "Duplication Check 2 - All Rows",
       CASE WHEN combinations = total THEN 'PASS' ELSE 'FAIL' END AS "Duplication Flag"
FROM (SELECT (SELECT COUNT(*) FROM (
                SELECT DISTINCT market_name, time_period, upc, condition
                FROM {table}) AS k) AS combinations,
             (SELECT COUNT(*) FROM {table}) AS total) AS c"""


def _volume(name: str, prefix: str) -> str:
    sums = ", ".join(
        f"CAST({prefix}_{m} AS DOUBLE) AS {prefix}_{m}" for m in _COVERAGE_MEASURES[1:]
    )
    return f"SELECT market_name, period_date, {prefix}_item_count, {sums} FROM {name}"


def _diff_columns(measures: list[str], old: str, new: str) -> str:
    absolute = ", ".join(
        f"round(CAST({new}_{m} - {old}_{m} AS DOUBLE), 4) AS {m}_diff" for m in measures
    )
    relative = ", ".join(f"{m}_pct_diff" for m in measures)
    unknown = " + ".join(f"CAST({m}_pct_diff IS NULL AS INTEGER)" for m in measures)
    return f"{absolute}, {relative}, {unknown} AS null_diffs"


def _metric_rows(side: str) -> str:
    rest = ", ".join(f"{side}_{m}" for m in _BACK_MEASURES if m != "index")
    return (
        _with(_BASE, _CURRENT if side == "current" else _PRIOR, _metrics(side))
        + f"SELECT time_period, condition, round({side}_index, 4) AS {side}_index, {rest}"
        + f" FROM {side}_metrics"
    )


def _trend(metrics: list[str], tolerance: float, *pricing: str) -> str:
    frame = (
        "OVER (PARTITION BY condition ORDER BY period_date"
        " ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
    )
    means = ", ".join(
        f"CASE WHEN COUNT({m}) {frame} = 5 THEN AVG({m}) {frame} END AS {m}_mean"
        for m in metrics
    )
    diffs = ", ".join(f"round(({m} - {m}_mean) / {m}_mean, 4) AS {m}_pct_diff" for m in metrics)
    columns = ", ".join(
        f"round({m}, 4) AS {m}, round({m}_mean, 4) AS {m}_mean, {m}_pct_diff,"
        f" CASE WHEN abs({m}_pct_diff) > {tolerance} THEN 'FAIL'"
        f" WHEN abs({m}_pct_diff) <= {tolerance} THEN 'PASS' END AS {m}_flag"
        for m in metrics
    )
    report = _REPORT.replace("report AS", "unrounded AS", 1)
    store = _STORE.replace(f"round({_INDEX}, 4)", _INDEX)
    return (
        _with(_BASE, *(pricing or (_CURRENT,)), _COUNTS, store, _KVI, report)
        + f""",
dated AS (SELECT *, CAST(left(time_period, 10) AS DATE) AS period_date FROM unrounded),
means AS (SELECT *, {means},
            period_date = MAX(period_date) OVER () AS is_latest,
            MAX(period_date) OVER (PARTITION BY condition) < MAX(period_date) OVER ()
              AS condition_ended
          FROM dated),
diffs AS (SELECT *, {diffs} FROM means)
SELECT period_date, time_period, condition, is_latest, condition_ended, {columns} FROM diffs"""
    )


# ------------------------------------------------------------------ catalogue


def _renamed(table: str, cte: str, columns: str, where: str = "TRUE") -> tuple[str, str]:
    """A pricing table, and one of its old name derived from it."""
    return cte.replace(f"{table} AS", f"{table}_all AS", 1), f"""
{table} AS (SELECT * REPLACE ({columns}) FROM {table}_all WHERE {where})"""


_ENDED = _renamed(
    "pricing_current",
    _CURRENT,
    "NULLIF(condition, 'A') AS condition",
    "NOT (condition = 'R' AND time_period >= '1998')",
)
_FINE = (
    "CAST(units * 1.01 AS DECIMAL(22,4)) AS units,"
    " CAST(market_units * 1.01 AS DECIMAL(22,4)) AS market_units"
)


def _fine_back_data() -> str:
    ctes = []
    for cte in _BACK_CTES:
        for table in ("pricing_prior", "pricing_current"):
            if cte.strip().startswith(f"{table} AS"):
                ctes += _renamed(table, cte, _FINE)
                break
        else:
            ctes.append(cte)
    return _with(*ctes)


_SWAPPED = """
pricing_swapped AS (
  SELECT * REPLACE (CASE WHEN NOT starts_with(time_period, '1996') THEN upc
           WHEN upc = MIN(upc) OVER g THEN MAX(upc) OVER g
           WHEN upc = MAX(upc) OVER g THEN MIN(upc) OVER g ELSE upc END AS upc)
  FROM pricing_prior WINDOW g AS (PARTITION BY market_name, time_period, condition))"""
_HISTORY_SUMS = ["units", "dollars", "market_units", "market_dollars"]


def _history(new: str) -> str:
    """Rows of two tables compared one by one, copies counted; no hash, no sum."""
    group = "time_period, condition, market_name"
    sums = " AND ".join(f"SUM(sign * {c}) = 0" for c in _HISTORY_SUMS)
    return f"""
, p AS (SELECT *, COUNT(*) AS copies FROM pricing_prior GROUP BY ALL),
c AS (SELECT *, COUNT(*) AS copies FROM {new} GROUP BY ALL),
odd AS (
  (SELECT * FROM p EXCEPT SELECT * FROM c) UNION ALL (SELECT * FROM c EXCEPT SELECT * FROM p)),
two AS (SELECT *, -1 AS sign FROM pricing_prior UNION ALL SELECT *, 1 AS sign FROM {new}),
checked AS (
  SELECT {group},
         CASE WHEN COUNT(*) FILTER (sign < 0) = 0 THEN 'new'
              WHEN COUNT(*) FILTER (sign > 0) = 0 THEN 'missing'
              WHEN ({group}) IN (SELECT ({group}) FROM odd) THEN 'changed' ELSE 'same' END AS status,
         SUM(sign) = 0 AND {sums} AS sums_equal,
         COUNT(*) FILTER (sign < 0) AS prior_rows, COUNT(*) FILTER (sign > 0) AS current_rows
  FROM two GROUP BY {group})
"""


def _history_check(new: str) -> str:
    return _history(new) + """
SELECT *, CASE WHEN status IN ('same', 'new') THEN 'PASS' ELSE 'FAIL' END AS history_flag
FROM checked"""


def _history_changes(new: str) -> str:
    item = "time_period, condition, market_name, upc"
    group = "time_period, condition, market_name"
    changes = ", ".join(
        f"round(CAST(SUM(sign * {c}) AS DOUBLE), 4) AS {c}_diff" for c in _HISTORY_SUMS
    )
    return _history(new) + f"""
SELECT {item},
       CASE WHEN COUNT(*) FILTER (sign < 0) = 0 THEN 'new'
            WHEN COUNT(*) FILTER (sign > 0) = 0 THEN 'missing' ELSE 'changed' END AS status,
       COUNT(*) FILTER (sign < 0) AS prior_rows, COUNT(*) FILTER (sign > 0) AS current_rows, {changes}
FROM two
WHERE ({group}) IN (SELECT ({group}) FROM checked WHERE status = 'changed')
  AND ({item}) IN (SELECT ({item}) FROM odd)
GROUP BY {item}"""


def oracle_sql() -> dict[str, str]:
    found = _library_sql()
    suite = ("duplication", "coverage", "back_data")
    found |= {f"qc_suite_{n}": found[f"{n}_check"] for n in suite}
    found["qc_suite_coverage_differences"] = found["coverage_differences"]
    found["qc_suite_back_data_keys"] = found["back_data_missing_keys"]
    found["qc_suite_coverage_keys"] = (
        "SELECT * FROM (" + found["coverage_missing_keys"]
        + ") WHERE market_name IN ('ASIA', 'EUROPE')"
    )
    found["qc_suite_counts"] = found["period_counts"]
    found["load_path_back_data"] = found["back_data_check"].replace(
        _with(*_BACK_CTES), _fine_back_data(), 1
    )
    found |= {f"qc_suite_{n}": found[n] for n in ("back_data_differences",)}
    found["qc_suite_history"] = found["history_check"]
    found["qc_suite_trend"] = found["trend_check"]
    found["trend_steps"] = (
        "SELECT * EXCLUDE (is_latest, condition_ended) FROM (" + found["trend_check"]
        + ") WHERE period_date >= DATE '2000-01-01'"
    )
    found["published_files"] = found["incremental_index"] = found["published_index"]
    found["item_bits_counts"] = found["period_counts"]
    found["item_bits_metrics"] = found["prior_metrics"]
    found["duplicate_keys_by_hash"] = found["duplicate_keys"]
    found["trend_check_ended"] = _trend(["store_index", "dollars", "units"], 0.05, *_ENDED)
    return found


_RAW_MIXED = """
raw_mixed AS (
  SELECT * REPLACE (CASE WHEN CAST(upc AS BIGINT) % 7 = 0 THEN 'QTR unknown'
           WHEN CAST(upc AS BIGINT) % 3 = 0
             THEN 'QTR ' || strftime(CAST(right(time_period, 10) AS DATE), '%m/%d/%Y')
           ELSE time_period END AS time_period)
  FROM raw_pricing)"""
_ODD = """
pricing_odd AS (
  SELECT * REPLACE (CASE WHEN CAST(upc AS BIGINT) % 89 = 0 THEN 'unknown QTR'
           ELSE time_period END AS time_period)
  FROM pricing_dirty)"""
_MIXED_VOLUME = """
SELECT market_name,
       coalesce(TRY_CAST(right(time_period, 10) AS DATE),
                CAST(try_strptime(right(time_period, 10), '%m/%d/%Y') AS DATE)) AS period_date,
       COUNT(upc) AS raw_item_count,
       CAST(SUM(units) AS DOUBLE) AS raw_client_units, CAST(SUM(comp_units) AS DOUBLE) AS raw_rom_units,
       CAST(SUM(dollars) AS DOUBLE) AS raw_client_dollars,
       CAST(SUM(comp_dollars) AS DOUBLE) AS raw_rom_dollars
FROM raw_mixed WHERE units > 10 AND comp_units > 0 GROUP BY ALL"""
_ZERO_INDEX = """
SELECT time_period, condition,
       round(SUM(CASE WHEN w <> 0 THEN 100 * (CAST(dollars AS DOUBLE) / w) * CAST(units AS DOUBLE) END)
             / CAST(SUM(CASE WHEN w <> 0 THEN units END) AS DOUBLE), 4) AS store_index,
       CAST(SUM(dollars) AS DOUBLE) AS dollars, CAST(SUM(units) AS DOUBLE) AS units,
       CAST(SUM(market_dollars) AS DOUBLE) AS market_dollars,
       CAST(SUM(market_units) AS DOUBLE) AS market_units
FROM (SELECT *, CASE WHEN CAST(upc AS BIGINT) % 71 = 0 THEN 0
             ELSE CAST(price_weighted_volume AS DOUBLE) END AS w FROM pricing_current)
WHERE outlier_flag <> 'Outlier' GROUP BY time_period, condition"""


def _code_points(column: str, table: str) -> str:
    return f"""
SELECT unicode(ch) AS code, COUNT(*) AS value_count,
       regexp_matches(ch, '\\p{{Cc}}') AS is_control,
       regexp_matches(ch, '[\\p{{Z}}\\x09-\\x0D]') AS is_space
FROM (SELECT unnest(list_distinct(regexp_extract_all({column}, '(?s).'))) AS ch FROM {table})
GROUP BY ch"""


def _unread(table: str, end: str) -> str:
    return f"""
SELECT time_period, COUNT(*) AS row_count FROM {table}
WHERE TRY_CAST({end}(time_period, 10) AS DATE) IS NULL
  AND try_strptime({end}(time_period, 10), '%m/%d/%Y') IS NULL
GROUP BY time_period"""


def _library_sql() -> dict[str, str]:
    codes = _with(_CODES)
    current = _with(_BASE, _CURRENT)
    dirty = _with(_BASE, _CURRENT, _DIRTY)
    rewritten = codes + f"SELECT {_strip('upc', [10, 13])} AS original_upc, upc FROM codes"
    return {
        "duplication_check": current + _duplication("pricing_current"),
        "duplication_check_dirty": dirty + _duplication("pricing_dirty"),
        "duplicate_keys": dirty
        + """
SELECT market_name, time_period, upc, condition, COUNT(*) AS copies
FROM pricing_dirty GROUP BY market_name, time_period, upc, condition HAVING COUNT(*) > 1""",
        "qc_suite_duplicate_keys": _with(_BASE, _CURRENT, _DIRTY, _ODD)
        + """
SELECT market_name, time_period, upc, condition, COUNT(*) AS copies
FROM pricing_odd GROUP BY ALL HAVING COUNT(*) > 1""",
        "qc_suite_unparsed_raw": _with(_BASE, _RAW, _RAW_MIXED) + _unread("raw_mixed", "right"),
        "qc_suite_unparsed_template": _with(_BASE, _CURRENT, _DIRTY, _ODD)
        + _unread("pricing_odd", "left"),
        "raw_volume_mixed": _with(_BASE, _RAW, _RAW_MIXED) + _MIXED_VOLUME,
        "store_index_zero": current + _ZERO_INDEX,
        "item_bits_kvi": current
        + """
SELECT time_period, condition, market_name, COUNT(DISTINCT upc) AS item_count,
       COUNT(DISTINCT CASE WHEN kvi_quad = 'KVI' THEN upc END) AS kvi_item_count
FROM pricing_current GROUP BY ALL""",
        "code_points": codes + _code_points("upc", "codes"),
        "code_points_documents": _code_points("text", "documents"),
        "strip_controls": codes
        + f"SELECT original_upc, {_strip('upc', [8, 10, 11, 12, 13])} AS upc FROM codes",
        "raw_volume": _with(_BASE, _RAW, _RAW_VOLUME) + _volume("raw_volume", "raw"),
        "template_volume": _with(_BASE, _CURRENT, _TEMPLATE_VOLUME)
        + _volume("template_volume", "template"),
        "coverage_check": _coverage_report(),
        "coverage_waived": _coverage_report("WAIVED"),
        "coverage_differences": _with(*_COVERAGE_CTES)
        + "SELECT market_name, period_date, "
        + _diff_columns(_COVERAGE_MEASURES, "raw", "template")
        + " FROM coverage",
        "coverage_missing_keys": _with(_BASE, _RAW, _CURRENT, _RAW_VOLUME, _TEMPLATE_VOLUME)
        + _key_status("raw_volume", "template_volume", ["market_name", "period_date"]),
        "unparsed_periods": _with(_BASE, _RAW)
        + """
SELECT time_period, COUNT(*) AS row_count FROM raw_pricing
WHERE TRY_CAST(left(time_period, 10) AS DATE) IS NULL GROUP BY time_period""",
        "prior_metrics": _metric_rows("prior"),
        "current_metrics": _metric_rows("current"),
        "back_data_check": _with(*_BACK_CTES)
        + 'SELECT time_period AS "Time Period", condition AS "Condition",\n  '
        + _back_columns()
        + "\nFROM back_data ORDER BY time_period, condition",
        "back_data_differences": _with(*_BACK_CTES)
        + "SELECT time_period, condition, "
        + _diff_columns(_BACK_MEASURES, "prior", "current")
        + " FROM back_data",
        "back_data_missing_keys": _with(
            _BASE, _CURRENT, _PRIOR, _metrics("prior"), _metrics("current")
        )
        + _key_status("prior_metrics", "current_metrics", ["time_period", "condition"]),
        "history_check": _with(_BASE, _CURRENT, _PRIOR) + _history_check("pricing_current"),
        "history_changes": _with(_BASE, _CURRENT, _PRIOR) + _history_changes("pricing_current"),
        "history_check_swapped": _with(_BASE, _PRIOR, _SWAPPED) + _history_check("pricing_swapped"),
        "history_changes_swapped": _with(_BASE, _PRIOR, _SWAPPED)
        + _history_changes("pricing_swapped"),
        "period_counts": _with(_BASE, _CURRENT, _COUNTS)
        + """
SELECT time_period AS "Time_Period", market_count AS "Count of Markets",
  condition_count AS "Count of Retail Conditions", row_count AS "Total Row Count",
  item_count AS "Distinct Item Count - Total Store",
  kvi_item_count AS "Distinct Item Count - KVI",
  CAST(dollars AS DOUBLE) AS "Client Dollars", CAST(units AS DOUBLE) AS "Client Units",
  CAST(market_dollars AS DOUBLE) AS "Market Dollars",
  CAST(market_units AS DOUBLE) AS "Market Units"
FROM counts""",
        "store_index": _with(_BASE, _CURRENT, _STORE) + "SELECT * FROM store_index",
        "kvi_index": _with(_BASE, _CURRENT, _KVI) + "SELECT * FROM kvi_index",
        "index_report": _INDEX_REPORT,
        "published_index": _INDEX_REPORT,
        "qc_suite": _INDEX_REPORT,
        "trend_check": _trend(["store_index", "dollars", "units"], 0.05),
        "snapshot": current
        + """
SELECT market_name, time_period, upc, condition, CAST(units AS DOUBLE) AS units,
  CAST(dollars AS DOUBLE) AS dollars, CAST(market_units AS DOUBLE) AS market_units,
  CAST(market_dollars AS DOUBLE) AS market_dollars,
  CAST(price_weighted_volume AS DOUBLE) AS price_weighted_volume, kvi_quad, outlier_flag
FROM pricing_current""",
        "char_profile": codes + _profile("original_upc", _CHARACTERS),
        "char_profile_nbsp": codes + _profile("upc", _WITH_NBSP),
        "char_profile_summary": codes + _profile_summary("codes", "upc"),
        "char_profile_documents": _profile_summary("documents", "text"),
        "strip_chars": codes
        + f"SELECT original_upc, {_strip('upc', _WITH_NBSP.values())} AS upc FROM codes",
        "strip_chars_rewrite": rewritten,
        "strip_chars_in_place": rewritten,
    }
