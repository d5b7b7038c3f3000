"""Oracle SQL: the same queries written independently as plain SQL over the
given tables (run by another engine for cross-checking).

Building blocks are common table expressions; ``sql(body, *ctes)`` prefixes a
query body with the CTEs it needs (dependencies first)."""

from __future__ import annotations

CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, text: str, *deps: str) -> None:
    CTE[name] = (text, deps)


def _order(names, out, seen):
    for n in names:
        if n in seen:
            continue
        seen.add(n)
        _order(CTE[n][1], out, seen)
        out.append(n)


def sql(body: str, *names: str) -> str:
    order: list[str] = []
    _order(names, order, set())
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS (\n{CTE[n][0].strip()}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"


# --- landing rows ------------------------------------------------------------
cte("obs", """
SELECT rpad('PR' || CASE WHEN l_suppkey % 2 = 0 THEN 'S' ELSE 'U' END
         || lpad(CAST(l_suppkey % 20 * 100 AS VARCHAR), 4, '0')
         || CASE WHEN l_returnflag = 'A' THEN '3' ELSE '6' END
         || lpad(CAST(l_partkey % 5 AS VARCHAR), 2, '0')
         || CAST(l_partkey % 3 + 1 AS VARCHAR), 17, ' ') AS series_id,
       CAST(year(l_shipdate) AS INTEGER) AS year,
       CASE WHEN l_linenumber <= 4 THEN 'Q0' || CAST(quarter(l_shipdate) AS VARCHAR)
            WHEN l_linenumber = 5 THEN 'M' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0')
            WHEN l_linenumber = 6 THEN 'S0' || CASE WHEN month(l_shipdate) <= 6 THEN '1' ELSE '2' END
            WHEN l_suppkey % 3 = 0 THEN 'Q05' WHEN l_suppkey % 3 = 1 THEN 'M13' ELSE 'S03' END AS period,
       l_quantity AS value,
       CASE WHEN l_returnflag = 'R' THEN 'R' END AS footnote_codes
FROM lineitem""")

cte("cur", "SELECT series_id, year, period, value + 1 AS value, footnote_codes FROM obs WHERE year >= 2000", "obs")

cte("dedup", """
SELECT series_id, year, period, value, footnote_codes FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, year, period
                               ORDER BY src, value DESC NULLS LAST, footnote_codes ASC NULLS FIRST) AS rn
  FROM (SELECT *, 0 AS src FROM cur UNION ALL SELECT *, 1 AS src FROM obs) u) t
WHERE rn = 1""", "cur", "obs")

_PNUM = "TRY_CAST(substring(period, 2, 2) AS INTEGER)"
_OBS_DATE = f"""CASE WHEN period LIKE 'Q%' THEN CASE WHEN {_PNUM} = 1 THEN make_date(year, 3, 31)
                                    WHEN {_PNUM} = 2 THEN make_date(year, 6, 30)
                                    WHEN {_PNUM} = 3 THEN make_date(year, 9, 30)
                                    WHEN {_PNUM} IS NOT NULL THEN make_date(year, 12, 31) END
          WHEN period LIKE 'M%' THEN CASE WHEN {_PNUM} = 13 THEN make_date(year, 12, 31)
                                    WHEN {_PNUM} BETWEEN 1 AND 12 THEN last_day(make_date(year, {_PNUM}, 1)) END
          WHEN period LIKE 'S%' THEN CASE WHEN {_PNUM} = 1 THEN make_date(year, 6, 30)
                                    WHEN {_PNUM} IS NOT NULL THEN make_date(year, 12, 31) END END"""
_PTYPE = """CASE WHEN period LIKE 'Q%' THEN 'Quarterly' WHEN period LIKE 'M%' THEN 'Monthly'
     WHEN period LIKE 'S%' THEN 'Semi-Annual' ELSE 'Unknown' END"""

cte("slv_prod", f"""
SELECT trim(series_id) AS series_id, year, period, value, footnote_codes,
       substring(series_id, 1, 2) AS survey_code, substring(series_id, 3, 1) AS seasonal_code,
       substring(series_id, 4, 4) AS sector_code, substring(series_id, 8, 1) AS class_code,
       substring(series_id, 9, 2) AS measure_code, substring(series_id, 11, 1) AS duration_code,
       observation_date, CAST(year(observation_date) AS INTEGER) AS observation_year,
       CAST(quarter(observation_date) AS INTEGER) AS observation_quarter,
       CAST(month(observation_date) AS INTEGER) AS observation_month,
       {_PTYPE} AS period_type,
       period IN ('Q05', 'M13', 'S03') AS is_annual_average
FROM (SELECT *, {_OBS_DATE} AS observation_date FROM dedup) d""", "dedup")

cte("brz_series", """
SELECT series_id, substring(series_id, 4, 4) AS sector_code, substring(series_id, 8, 1) AS class_code,
       substring(series_id, 9, 2) AS measure_code, substring(series_id, 11, 1) AS duration_code,
       substring(series_id, 3, 1) AS seasonal, '2017' AS base_year,
       CASE WHEN fn = 1 THEN 'R' END AS footnote_codes,
       CAST(y0 AS VARCHAR) AS begin_year, 'M' || lpad(CAST(m0 AS VARCHAR), 2, '0') AS begin_period,
       CAST(y1 AS VARCHAR) AS end_year, 'M' || lpad(CAST(m1 AS VARCHAR), 2, '0') AS end_period
FROM (SELECT series_id, max(CAST(footnote_codes = 'R' AS INTEGER)) AS fn, min(year) AS y0, max(year) AS y1,
             min(CASE WHEN period LIKE 'M%' THEN CAST(substring(period, 2, 2) AS INTEGER) END) AS m0,
             max(CASE WHEN period LIKE 'M%' THEN CAST(substring(period, 2, 2) AS INTEGER) END) AS m1
      FROM obs GROUP BY series_id) g""", "obs")

cte("brz_sector", """
SELECT DISTINCT lpad(CAST(s_suppkey % 20 * 100 AS VARCHAR), 4, '0') AS sector_code,
       '  Sector ' || lpad(CAST(s_suppkey % 20 * 100 AS VARCHAR), 4, '0') || '  ' AS sector_name,
       CAST(s_suppkey % 20 % 3 AS INTEGER) AS display_level,
       CASE WHEN s_suppkey % 20 = 7 THEN 'X' WHEN s_suppkey % 20 % 2 = 0 THEN 'T' ELSE 'F' END AS selectable,
       CAST(s_suppkey % 20 AS INTEGER) AS sort_sequence
FROM supplier WHERE s_suppkey % 20 <> 19""")

cte("brz_class", """
SELECT DISTINCT CAST(r_regionkey + 2 AS VARCHAR) AS class_code, ' ' || r_name || ' workers ' AS class_text,
       CAST(r_regionkey % 2 AS INTEGER) AS display_level, 'T' AS selectable,
       CAST(r_regionkey AS INTEGER) AS sort_sequence
FROM region""")

cte("brz_measure", """
SELECT DISTINCT lpad(CAST(p_partkey % 5 AS VARCHAR), 2, '0') AS measure_code,
       'Measure ' || lpad(CAST(p_partkey % 5 AS VARCHAR), 2, '0') || ' ' AS measure_text,
       1 AS display_level, 'T' AS selectable, CAST(p_partkey % 5 AS INTEGER) AS sort_sequence
FROM part WHERE p_partkey % 5 <> 4""")

cte("brz_duration", """
SELECT DISTINCT CAST(p_partkey % 3 + 1 AS VARCHAR) AS duration_code,
       ' Duration ' || CAST(p_partkey % 3 + 1 AS VARCHAR) AS duration_text,
       0 AS display_level, CASE WHEN p_partkey % 3 + 1 = 3 THEN 'F' ELSE 'T' END AS selectable,
       CAST(p_partkey % 3 + 1 AS INTEGER) AS sort_sequence
FROM part""")

cte("brz_seasonal", """
SELECT DISTINCT CASE WHEN r_regionkey % 2 = 0 THEN 'S' ELSE 'U' END AS seasonal_code,
       CASE WHEN r_regionkey % 2 = 0 THEN ' Seasonally Adjusted ' ELSE ' Not Seasonally Adjusted ' END AS seasonal_text
FROM region""")

cte("brz_footnote", """
SELECT substring('ANRPC', CAST(r_regionkey AS INTEGER) + 1, 1) AS footnote_code,
       ' Footnote ' || substring('ANRPC', CAST(r_regionkey AS INTEGER) + 1, 1) || ' ' AS footnote_text
FROM region""")

cte("brz_period", """
SELECT period, period || ' ' AS period_abbr,
       '  ' || CASE WHEN period LIKE 'Q%' THEN 'Quarter ' WHEN period LIKE 'M%' THEN 'Month ' ELSE 'Half ' END
            || substring(period, 2, 2) || ' ' AS period_name
FROM (SELECT CASE WHEN n_nationkey < 5 THEN 'Q0' || CAST(n_nationkey + 1 AS VARCHAR)
                  WHEN n_nationkey < 18 THEN 'M' || lpad(CAST(n_nationkey - 4 AS VARCHAR), 2, '0')
                  WHEN n_nationkey < 21 THEN 'S0' || CAST(n_nationkey - 17 AS VARCHAR) END AS period
      FROM nation) p
WHERE period IS NOT NULL AND period <> 'S02'""")

# silver code dimensions: trimmed texts
cte("slv_sector", "SELECT sector_code, trim(sector_name) AS sector_name, display_level, selectable, sort_sequence FROM brz_sector", "brz_sector")
cte("slv_class", "SELECT class_code, trim(class_text) AS class_text, display_level, selectable, sort_sequence FROM brz_class", "brz_class")
cte("slv_measure", "SELECT measure_code, trim(measure_text) AS measure_text, display_level, selectable, sort_sequence FROM brz_measure", "brz_measure")
cte("slv_duration", "SELECT duration_code, trim(duration_text) AS duration_text, display_level, selectable, sort_sequence FROM brz_duration", "brz_duration")
cte("slv_seasonal", "SELECT seasonal_code, trim(seasonal_text) AS seasonal_text FROM brz_seasonal", "brz_seasonal")
cte("slv_footnote", "SELECT footnote_code, trim(footnote_text) AS footnote_text FROM brz_footnote", "brz_footnote")
cte("slv_period", f"""
SELECT period, period_abbr, trim(period_name) AS period_name, {_PTYPE} AS period_type,
       period IN ('Q05', 'M13', 'S03') AS is_annual_average
FROM brz_period""", "brz_period")

# gold code dimensions: dense keys in business-key order (then the other columns)
_DIMS = {
    "class": ["class_code", "class_text", "display_level", "selectable", "sort_sequence"],
    "duration": ["duration_code", "duration_text", "display_level", "selectable", "sort_sequence"],
    "measure": ["measure_code", "measure_text", "display_level", "selectable", "sort_sequence"],
    "sector": ["sector_code", "sector_name", "display_level", "selectable", "sort_sequence"],
    "footnote": ["footnote_code", "footnote_text"],
    "seasonal": ["seasonal_code", "seasonal_text"],
    "period": ["period", "period_abbr", "period_name", "period_type", "is_annual_average"],
}
for _n, _cols in _DIMS.items():
    _ob = ", ".join(f"{c} ASC NULLS FIRST" for c in _cols)
    cte(f"gold_{_n}", f"SELECT CAST(row_number() OVER (ORDER BY {_ob}) AS BIGINT) AS {_n}_sk, {', '.join(_cols)} FROM slv_{_n}", f"slv_{_n}")

cte("slv_series", """
SELECT s.series_id, s.base_year, s.footnote_codes, s.begin_year, s.begin_period, s.end_year, s.end_period,
       substring(s.series_id, 1, 2) AS survey_code,
       substring(s.series_id, 3, 1) AS seasonal_code_parsed, substring(s.series_id, 4, 4) AS sector_code_parsed,
       substring(s.series_id, 8, 1) AS class_code_parsed, substring(s.series_id, 9, 2) AS measure_code_parsed,
       substring(s.series_id, 11, 1) AS duration_code_parsed,
       TRY_CAST(s.begin_year AS INTEGER) AS begin_year_int, TRY_CAST(s.end_year AS INTEGER) AS end_year_int,
       sec.sector_name AS sector_name_desc, c.class_text AS class_desc, m.measure_text AS measure_desc,
       d.duration_text AS duration_desc, se.seasonal_text AS seasonal_desc
FROM brz_series s
LEFT JOIN slv_sector sec ON substring(s.series_id, 4, 4) = sec.sector_code
LEFT JOIN slv_class c ON substring(s.series_id, 8, 1) = c.class_code
LEFT JOIN slv_measure m ON substring(s.series_id, 9, 2) = m.measure_code
LEFT JOIN slv_duration d ON substring(s.series_id, 11, 1) = d.duration_code
LEFT JOIN slv_seasonal se ON substring(s.series_id, 3, 1) = se.seasonal_code""",
    "brz_series", "slv_sector", "slv_class", "slv_measure", "slv_duration", "slv_seasonal")

_SERIES_COLS = ["series_id", "base_year", "footnote_codes", "begin_year", "begin_period", "end_year",
                "end_period", "survey_code", "seasonal_code", "class_code", "sector_code",
                "measure_code", "duration_code"]
cte("gold_series_src", """
SELECT trim(series_id) AS series_id, base_year, footnote_codes, begin_year, begin_period, end_year, end_period,
       survey_code, seasonal_code_parsed AS seasonal_code, class_code_parsed AS class_code,
       sector_code_parsed AS sector_code, measure_code_parsed AS measure_code,
       duration_code_parsed AS duration_code
FROM slv_series""", "slv_series")
cte("gold_series", "SELECT CAST(row_number() OVER (ORDER BY {}) AS BIGINT) AS series_sk, {} FROM gold_series_src".format(
    ", ".join(f"{c} ASC NULLS FIRST" for c in _SERIES_COLS), ", ".join(_SERIES_COLS)), "gold_series_src")

cte("fact_prod", """
SELECT f.seasonal_code, trim(f.series_id) AS series_id, c.class_sk, d.duration_sk, fn.footnote_sk,
       m.measure_sk, p.period_sk, s.sector_sk, f.year, f.value, f.observation_date, f.observation_year,
       f.observation_quarter, f.observation_month, f.is_annual_average
FROM slv_prod f
LEFT JOIN gold_class c ON f.class_code = c.class_code
LEFT JOIN gold_duration d ON f.duration_code = d.duration_code
LEFT JOIN gold_measure m ON f.measure_code = m.measure_code
LEFT JOIN gold_period p ON f.period = p.period
LEFT JOIN gold_sector s ON f.sector_code = s.sector_code
LEFT JOIN gold_seasonal se ON f.seasonal_code = se.seasonal_code
LEFT JOIN gold_footnote fn ON f.footnote_codes = fn.footnote_code""",
    "slv_prod", "gold_seasonal", "gold_class", "gold_duration", "gold_measure", "gold_period", "gold_sector", "gold_footnote")

# population
cte("pop", """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') || 'US' AS nation_id, n_name AS nation,
       CAST(year(o_orderdate) AS INTEGER) AS year, n_nationkey AS nation_key,
       CAST(count(*) * 1000 AS BIGINT) AS population
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_nationkey, n_name, CAST(year(o_orderdate) AS INTEGER)""")

cte("loads", """
SELECT 1 AS load_no, nation_id, nation, year, population FROM pop
UNION ALL
SELECT 2 AS load_no, nation_id, CASE WHEN nation_key % 5 <> 0 THEN nation END AS nation, year,
       population + 500 AS population FROM pop WHERE year >= 2000
UNION ALL
SELECT 3 AS load_no, nation_id, nation || ' (revised)' AS nation, year, CAST(NULL AS BIGINT) AS population
FROM pop WHERE year = 2001 AND nation_key % 2 = 0""", "pop")

cte("slv_pop", """
SELECT arg_max(nation, load_no) FILTER (WHERE nation IS NOT NULL) AS nation, nation_id,
       arg_max(population, load_no) FILTER (WHERE population IS NOT NULL) AS population, year
FROM loads GROUP BY nation_id, year""", "loads")

cte("slv_nation", """
SELECT nation_id, nation FROM (
  SELECT nation_id, nation, row_number() OVER (PARTITION BY nation_id ORDER BY load_no, nation ASC NULLS FIRST) AS rn
  FROM loads) t WHERE rn = 1""", "loads")

cte("gold_nation", """
SELECT CAST(row_number() OVER (ORDER BY nation_id ASC NULLS FIRST, nation ASC NULLS FIRST) AS BIGINT) AS nation_sk,
       nation_id, nation AS name FROM slv_nation""", "slv_nation")

cte("fact_pop", """
SELECT nation_sk, year, population, previous_population,
       population - previous_population AS population_change,
       CASE WHEN previous_population <> 0
            THEN (population - previous_population) / previous_population * 100 END AS population_pct_change
FROM (SELECT n.nation_sk, p.year, p.population,
             lag(p.population, 1) OVER (PARTITION BY n.nation_sk ORDER BY p.year) AS previous_population
      FROM slv_pop p LEFT JOIN gold_nation n ON p.nation_id = n.nation_id) t""", "slv_pop", "gold_nation")

cte("year_sum", """
SELECT f.series_id, f.year, sum(f.value) AS value_sum
FROM fact_prod f JOIN gold_period p ON f.period_sk = p.period_sk AND p.period <> 'Q05'
GROUP BY f.series_id, f.year""", "fact_prod", "gold_period")

cte("old_ids", "SELECT DISTINCT trim(series_id) AS series_id FROM obs WHERE year <= 1999", "obs")

cte("events_chg", """
SELECT user_id, ts, event_id, event_type,
       CASE WHEN event_type <> 'error' THEN value END AS value,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""")

_R6 = "round({}, 6)"

QUERIES: dict[str, str] = {
    "tsv_scan": sql("SELECT * FROM obs", "obs"),
    "json_stream_ingest": sql("SELECT load_no, nation_id, nation, year, population, TRUE AS audited FROM loads", "loads"),
    "json_explode": sql("SELECT load_no, nation, nation_id, population, year FROM loads", "loads"),
    "page_links": r"""
SELECT page_id, href, regexp_extract(href, '([^/]*)$', 1) AS file_name
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages) t
WHERE href <> '' AND href <> '../' AND NOT suffix(href, '/')""",
    "clean_names_flat": """
SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS nation__key,
       c_acctbal AS accountbalance, c_mktsegment AS market_segment FROM customer""",
    "clean_names_nested": """
SELECT o_orderkey AS order_key, o_custkey AS order_info_customer_key, o_orderstatus AS order_info_orderstatus,
       o_totalprice AS line_items_total_price, o_orderpriority AS line_items_priority,
       o_totalprice AS by_status_map_price FROM orders""",
    "silver_dim_trim": sql("SELECT * FROM slv_sector", "slv_sector"),
    "period_dim": sql("SELECT * FROM slv_period", "slv_period"),
    "silver_observations": sql("SELECT * FROM slv_prod", "slv_prod"),
    "period_end_date": sql(f"""
SELECT year, period, {_PNUM} AS period_num, observation_date,
       CAST(year(observation_date) AS INTEGER) AS observation_year,
       CAST(quarter(observation_date) AS INTEGER) AS observation_quarter,
       CAST(month(observation_date) AS INTEGER) AS observation_month
FROM (SELECT year, period, {_OBS_DATE} AS observation_date FROM (SELECT DISTINCT year, period FROM obs) o) d""", "obs"),
    "union_by_name": sql("""
SELECT value, period, footnote_codes, year, series_id, 1 AS revision FROM cur
UNION ALL BY NAME
SELECT series_id, year, period, value FROM obs""", "cur", "obs"),
    "dedup_latest": sql("SELECT * FROM dedup", "dedup"),
    "dedup_stream": sql("SELECT nation_id, nation FROM slv_nation", "slv_nation"),
    "scd1_ignore_null": sql("""
SELECT user_id,
       arg_max(event_type, ts) FILTER (WHERE event_type IS NOT NULL) AS event_type,
       arg_max(value, ts) FILTER (WHERE value IS NOT NULL) AS value,
       arg_max(k, ts) FILTER (WHERE k IS NOT NULL) AS k
FROM events_chg GROUP BY user_id""", "events_chg"),
    "scd1_overwrite": sql("""
SELECT user_id, event_type, value, k FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events_chg) e
WHERE rn = 1""", "events_chg"),
    "silver_population": sql("SELECT * FROM slv_pop", "slv_pop"),
    "silver_population_nation": sql("SELECT * FROM slv_nation", "slv_nation"),
    "scd1_stream": sql("SELECT * FROM slv_pop", "slv_pop"),
    "surrogate_key": sql("""
SELECT CAST(row_number() OVER (ORDER BY series_id) AS BIGINT) AS series_sk, series_id
FROM (SELECT trim(series_id) AS series_id FROM slv_series) s""", "slv_series"),
    "surrogate_key_incremental": sql("""
SELECT CAST(row_number() OVER (ORDER BY series_id) AS BIGINT) AS series_sk, series_id FROM old_ids
UNION ALL
SELECT CAST((SELECT count(*) FROM old_ids) + row_number() OVER (ORDER BY series_id) AS BIGINT) AS series_sk,
       series_id
FROM (SELECT DISTINCT trim(series_id) AS series_id FROM obs) a
WHERE series_id NOT IN (SELECT series_id FROM old_ids)""", "old_ids"),
    "gold_dim_series": sql("SELECT * FROM gold_series", "gold_series"),
    "gold_dim_nation": sql("SELECT * FROM gold_nation", "gold_nation"),
    "silver_series": sql("SELECT * FROM slv_series", "slv_series"),
    "fact_star_left": sql("SELECT * FROM fact_prod", "fact_prod"),
    "fact_population": sql(f"""
SELECT nation_sk, year, population, previous_population, population_change,
       {_R6.format('population_pct_change')} AS population_pct_change FROM fact_pop""", "fact_pop"),
    "q1_mean_stddev": sql(f"""
SELECT {_R6.format('avg(population)')} AS mean_population, {_R6.format('stddev_samp(population)')} AS stddev_population
FROM fact_pop WHERE year BETWEEN 1996 AND 1999""", "fact_pop"),
    "year_sum": sql("SELECT * FROM year_sum", "year_sum"),
    "q3_series_population": sql("""
SELECT f.series_id, f.year, f.value, pop.population
FROM fact_prod f
JOIN gold_period p ON f.period_sk = p.period_sk AND p.period = 'Q01'
LEFT JOIN fact_pop pop ON f.year = pop.year
WHERE trim(f.series_id) = 'PRS00006032'
ORDER BY f.year DESC""", "fact_prod", "gold_period", "fact_pop"),
    "point_lookup": sql("""
SELECT * FROM slv_prod WHERE series_id = 'PRS00006011' AND year = 1995 AND period = 'Q01'""", "slv_prod"),
    "table_preview": sql("SELECT * FROM brz_series", "brz_series"),
    "first_row": sql(f"""
SELECT nation_sk, year, population, previous_population, population_change,
       {_R6.format('population_pct_change')} AS population_pct_change
FROM fact_pop ORDER BY year DESC, nation_sk ASC LIMIT 1""", "fact_pop"),
}

for _n in _DIMS:
    QUERIES[f"gold_dim_{_n}"] = sql(f"SELECT * FROM gold_{_n}", f"gold_{_n}")

_Q2_BODY = """
SELECT y.series_id, class_text, sector_name, measure_text, duration_text, y.year, y.value_sum
FROM year_sum y, gold_series s, gold_sector, gold_measure, gold_duration, gold_class
WHERE y.series_id = s.series_id AND s.sector_code = gold_sector.sector_code AND s.measure_code = gold_measure.measure_code
  AND s.duration_code = gold_duration.duration_code AND s.class_code = gold_class.class_code
  AND NOT EXISTS (SELECT 1 FROM year_sum b WHERE b.series_id = y.series_id
                  AND (b.value_sum > y.value_sum OR (y.value_sum IS NULL AND b.value_sum IS NOT NULL)))"""
QUERIES["q2_best_year"] = sql(_Q2_BODY, "gold_series", "gold_class", "gold_sector", "gold_duration",
                              "gold_measure", "year_sum")
QUERIES["q2_best_year_sql"] = QUERIES["q2_best_year"]


def _rule_rows(table: str, src: str, rules: list[tuple[str, str, str]]) -> str:
    sel = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS rule, '{action}' AS action, "
        f"CAST(sum(CASE WHEN coalesce({pred}, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS failed_rows, "
        f"CAST(count(*) AS BIGINT) AS total_rows FROM {src}"
        for name, pred, action in rules)
    return sel


# Table name -> its rows as built above.
_SOURCE = {
    **{f"{layer}_pr_{n}": f"{layer}_{n}" for layer in ("brz", "slv") for n in (*_DIMS, "series")},
    **{f"gold_dim_{n}": f"gold_{n}" for n in (*_DIMS, "series", "nation")},
    "brz_pr_data_0_current": "cur", "brz_pr_data_1_alldata": "obs", "slv_pr_productivity": "slv_prod",
    "gold_fact_productivity": "fact_prod", "gold_fact_population": "fact_pop",
}


def _rule_list(text: str) -> dict[str, list[tuple[str, str, str]]]:
    """table | rule | action | predicate, a line each."""
    out: dict[str, list[tuple[str, str, str]]] = {}
    for line in filter(None, map(str.strip, text.splitlines())):
        table, name, action, predicate = (x.strip() for x in line.split("|"))
        out.setdefault(table, []).append((name, predicate, action))
    return out


# The rules of every table, stated here on their own.
_RULES = _rule_list("""
brz_pr_class | valid_class_code | fail | class_code IS NOT NULL
brz_pr_class | valid_selectable | warn | selectable = 'T' OR selectable = 'F'
brz_pr_duration | valid_duration_code | fail | duration_code IS NOT NULL
brz_pr_duration | valid_selectable | warn | selectable = 'T' OR selectable = 'F'
brz_pr_measure | valid_measure_code | fail | measure_code IS NOT NULL
brz_pr_measure | valid_selectable | warn | selectable = 'T' OR selectable = 'F'
brz_pr_sector | valid_sector_code | fail | sector_code IS NOT NULL
brz_pr_sector | valid_selectable | warn | selectable = 'T' OR selectable = 'F'
brz_pr_footnote | valid_footnote_code | fail | footnote_code IS NOT NULL
brz_pr_period | valid_period | fail | period IS NOT NULL
brz_pr_seasonal | valid_seasonal_code | fail | seasonal_code IS NOT NULL
brz_pr_series | valid_series_id | fail | series_id IS NOT NULL
brz_pr_series | valid_begin_year | warn | begin_year IS NOT NULL
brz_pr_data_0_current | valid_series_id | fail | series_id IS NOT NULL
brz_pr_data_0_current | valid_year | fail | year BETWEEN 1900 AND 2100
brz_pr_data_0_current | valid_period | fail | period IS NOT NULL
brz_pr_data_1_alldata | valid_series_id | fail | series_id IS NOT NULL
brz_pr_data_1_alldata | valid_year | fail | year BETWEEN 1900 AND 2100
brz_pr_data_1_alldata | valid_period | fail | period IS NOT NULL
slv_pr_class | no_nulls_in_key | fail | class_code IS NOT NULL
slv_pr_duration | no_nulls_in_key | fail | duration_code IS NOT NULL
slv_pr_footnote | no_nulls_in_key | fail | footnote_code IS NOT NULL
slv_pr_measure | no_nulls_in_key | fail | measure_code IS NOT NULL
slv_pr_period | no_nulls_in_key | fail | period IS NOT NULL
slv_pr_seasonal | no_nulls_in_key | fail | seasonal_code IS NOT NULL
slv_pr_sector | no_nulls_in_key | fail | sector_code IS NOT NULL
slv_pr_series | valid_series_id | fail | length(series_id) = 17
slv_pr_productivity | non_null_critical_fields | fail | series_id IS NOT NULL AND year IS NOT NULL AND period IS NOT NULL
slv_pr_productivity | valid_value | warn | value IS NOT NULL
gold_dim_class | class_code is not null | warn | class_code IS NOT NULL
gold_dim_duration | duration_code is not null | warn | duration_code IS NOT NULL
gold_dim_footnote | footnote_code is not null | warn | footnote_code IS NOT NULL
gold_dim_measure | measure_code is not null | warn | measure_code IS NOT NULL
gold_dim_period | period is not null | warn | period IS NOT NULL
gold_dim_seasonal | seasonal_code is not null | warn | seasonal_code IS NOT NULL
gold_dim_sector | sector_code is not null | warn | sector_code IS NOT NULL
gold_dim_series | series_id is not null | warn | series_id IS NOT NULL
gold_dim_nation | nation_id_populated | warn | nation_id IS NOT NULL
gold_fact_productivity | all_dimension_keys_resolved | warn | NOT (series_id IS NULL OR class_sk IS NULL OR duration_sk IS NULL OR footnote_sk IS NULL OR measure_sk IS NULL OR period_sk IS NULL OR sector_sk IS NULL)
gold_fact_population | gold_population_nation_fk | fail | nation_sk IS NOT NULL
gold_fact_population | valid_year_range | warn | year BETWEEN 2000 AND 2030
gold_fact_population | positive_population | warn | population > 0
gold_fact_population | measures_populated | warn | population IS NOT NULL AND year IS NOT NULL
""")


def _rules(table: str, src: str) -> str:
    return _rule_rows(table, src, _RULES[table])


QUERIES["dq_report"] = sql(" UNION ALL ".join(_rules(t, src) for t, src in _SOURCE.items() if t in _RULES),
                           *[src for t, src in _SOURCE.items() if t in _RULES])

# At these sizes a load's pages are one per year, and a run has one micro-batch a load.
_STREAM_RULES = """
SELECT CAST(load_no - 1 AS BIGINT) AS batch_id, 'brz_population_data' AS table_name, 'data_element_populated' AS rule,
       'warn' AS action, CAST(0 AS BIGINT) AS failed_rows, CAST(count(DISTINCT year) AS BIGINT) AS total_rows
FROM loads GROUP BY load_no
UNION ALL
SELECT CAST(load_no - 1 AS BIGINT), 'population_data_transformed', 'year_populated', 'warn',
       CAST(count(*) - count(year) AS BIGINT), CAST(count(*) AS BIGINT) FROM loads GROUP BY load_no
UNION ALL
SELECT CAST(load_no - 1 AS BIGINT), 'population_nation_data_transformed', 'nation_id_populated', 'warn',
       CAST(count(*) - count(nation_id) AS BIGINT), CAST(count(*) AS BIGINT) FROM loads GROUP BY load_no"""
QUERIES["stream_rule_counts"] = sql(_STREAM_RULES, "loads")
QUERIES["population_rules"] = sql(f"""
SELECT table_name, rule, action, CAST(sum(failed_rows) AS BIGINT) AS failed_rows, CAST(sum(total_rows) AS BIGINT) AS total_rows
FROM ({_STREAM_RULES}) s GROUP BY table_name, rule, action""", "loads")
QUERIES["population_refresh"] = QUERIES["fact_population"]

QUERIES["key_uniqueness"] = sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_columns, count(*) AS total_rows, count(DISTINCT {k}) AS distinct_keys "
    f"FROM {_SOURCE[t]}"
    for t, k in [*((f"gold_dim_{n}", f"{n}_sk") for n in (*_DIMS, "series", "nation")),
                 *((f"gold_dim_{n}", cols[0]) for n, cols in _DIMS.items()),
                 ("gold_dim_series", "series_id"), ("gold_dim_nation", "nation_id")])
    + " UNION ALL SELECT 'gold_fact_population', 'nation_sk,year', count(*), count(DISTINCT (nation_sk, year)) "
      "FROM fact_pop", *[f"gold_{n}" for n in (*_DIMS, "series", "nation")], "fact_pop")

QUERIES["orphan_keys"] = sql(" UNION ALL ".join(
    f"SELECT '{n}_sk' AS foreign_key, {n}_sk AS orphan_value FROM (SELECT DISTINCT {n}_sk FROM {fact}) f "
    f"WHERE NOT EXISTS (SELECT 1 FROM gold_{n} d WHERE d.{n}_sk = f.{n}_sk)"
    for n, fact in [*((n, "fact_prod") for n in ("class", "duration", "footnote", "measure", "period", "sector")),
                    ("nation", "fact_pop")]),
    "fact_prod", "fact_pop",
    *[f"gold_{n}" for n in ("class", "duration", "footnote", "measure", "period", "sector", "nation")])

for _t in [f"brz_pr_{n}" for n in (*_DIMS, "data_0_current", "data_1_alldata")] + [
        f"slv_pr_{n}" for n in ("class", "duration", "footnote", "measure", "seasonal")]:
    QUERIES[f"preview_{_t}"] = sql(f"SELECT * FROM {_SOURCE[_t]}", _SOURCE[_t])

QUERIES["q1_mean_stddev_sql"] = QUERIES["q1_mean_stddev"]
QUERIES["q3_series_population_sql"] = QUERIES["q3_series_population"]
QUERIES["tsv_pipeline_best_year"] = QUERIES["q2_best_year"]
QUERIES["materialized_dim_sector"] = QUERIES["gold_dim_sector"]
QUERIES["materialized_fact_population"] = QUERIES["fact_population"]
for _n in ("class", "duration", "measure", "footnote", "seasonal", "period", "series", "nation"):
    QUERIES[f"materialized_dim_{_n}"] = QUERIES[f"gold_dim_{_n}"]
QUERIES["materialized_fact_productivity"] = QUERIES["fact_star_left"]
QUERIES["pipeline_run_best_year"] = QUERIES["q2_best_year"]
QUERIES["population_pipeline_q1"] = QUERIES["q1_mean_stddev"]
QUERIES["population_pipeline_q3"] = QUERIES["q3_series_population"]

# Damaged landing: by the class of the order, short, long and unparsable lines.
cte("damaged", f"""
SELECT series_id, CASE WHEN c <> 29 THEN year END AS year, period, CASE WHEN c <> 5 THEN value END AS value,
       CASE WHEN c <> 5 THEN footnote_codes END AS footnote_codes, c IN (5, 17, 29) AS damaged
FROM (SELECT obs.*, c FROM ({CTE["obs"][0].replace("SELECT rpad", "SELECT l_orderkey % 101 AS c, rpad", 1)}) obs) o""")
QUERIES["tsv_damaged"] = sql("SELECT * FROM damaged", "damaged")
QUERIES["tsv_damage_rules"] = sql("""
SELECT 'lines' AS table_name, r.rule, CAST(CASE r.rule WHEN 'well_formed_line' THEN count_if(damaged)
         WHEN 'valid_year' THEN count_if(year IS NULL) ELSE 0 END AS BIGINT) AS failed_rows, CAST(count(*) AS BIGINT) AS total_rows
FROM damaged, (VALUES ('well_formed_line'), ('valid_series_id'), ('valid_year'), ('valid_period')) r(rule) GROUP BY r.rule
UNION ALL SELECT 'headers', 'header_as_declared', CAST(0 AS BIGINT), NULL""", "damaged")
QUERIES["json_rescued"] = sql("""
SELECT CASE WHEN load_no <> 3 THEN load_no END AS load_no, CAST(CASE WHEN load_no <> 3 THEN count(*) ELSE 0 END AS INTEGER) AS records,
       CASE WHEN load_no = 2 THEN '{"note":"{\\"id\\":\\"' || nation_id || '\\",\\"rev\\":2}"}' END AS _rescued_data, load_no = 3 AS damaged
FROM loads GROUP BY load_no, nation_id""", "loads")
