"""Quality rules of every table (fixed values: names and predicates as the
pipelines declare them)."""

from __future__ import annotations

from ..operators.quality import expect, expect_or_fail

_DIM_BRONZE = {
    "class": "class_code", "duration": "duration_code", "measure": "measure_code",
    "sector": "sector_code",
}

BRONZE = {
    **{f"brz_pr_{t}": [expect_or_fail(f"valid_{k}", f"{k} IS NOT NULL"),
                       expect("valid_selectable", "selectable IN ('T', 'F')")]
       for t, k in _DIM_BRONZE.items()},
    "brz_pr_footnote": [expect_or_fail("valid_footnote_code", "footnote_code IS NOT NULL")],
    "brz_pr_period": [expect_or_fail("valid_period", "period IS NOT NULL")],
    "brz_pr_seasonal": [expect_or_fail("valid_seasonal_code", "seasonal_code IS NOT NULL")],
    "brz_pr_series": [expect_or_fail("valid_series_id", "series_id IS NOT NULL"),
                      expect("valid_begin_year", "begin_year IS NOT NULL")],
    **{f"brz_pr_{t}": [expect_or_fail("valid_series_id", "series_id IS NOT NULL"),
                       expect_or_fail("valid_year", "year >= 1900 AND year <= 2100"),
                       expect_or_fail("valid_period", "period IS NOT NULL")]
       for t in ("data_0_current", "data_1_alldata")},
    "brz_population_data": [expect("data_element_populated", "data IS NOT NULL")],
}

SILVER = {
    **{f"slv_pr_{t}": [expect_or_fail("no_nulls_in_key", f"{k} IS NOT NULL")]
       for t, k in {"class": "class_code", "duration": "duration_code",
                    "footnote": "footnote_code", "measure": "measure_code",
                    "period": "period", "seasonal": "seasonal_code",
                    "sector": "sector_code"}.items()},
    "slv_pr_series": [expect_or_fail("valid_series_id", "series_id IS NOT NULL AND LENGTH(series_id) = 17")],
    "slv_pr_productivity": [
        expect_or_fail("non_null_critical_fields",
                       "series_id IS NOT NULL AND year IS NOT NULL AND period IS NOT NULL"),
        expect("valid_value", "value IS NOT NULL")],
    "population_data_transformed": [expect("year_populated", "year IS NOT NULL")],
    "population_nation_data_transformed": [expect("nation_id_populated", "nation_id IS NOT NULL")],
}

GOLD = {
    **{f"gold_dim_{t}": [expect(f"{k} is not null", f"{k} IS NOT NULL")]
       for t, k in {"class": "class_code", "duration": "duration_code",
                    "footnote": "footnote_code", "measure": "measure_code",
                    "period": "period", "seasonal": "seasonal_code",
                    "sector": "sector_code", "series": "series_id"}.items()},
    "gold_dim_nation": [expect("nation_id_populated", "nation_id IS NOT NULL")],
    "gold_fact_productivity": [expect(
        "all_dimension_keys_resolved",
        "series_id IS NOT NULL AND class_sk IS NOT NULL AND duration_sk IS NOT NULL AND "
        "footnote_sk IS NOT NULL AND measure_sk IS NOT NULL AND period_sk IS NOT NULL AND "
        "sector_sk IS NOT NULL")],
    "gold_fact_population": [expect_or_fail("gold_population_nation_fk", "nation_sk IS NOT NULL")],
}

# Value rules on the population fact (warn): plausible years, positive and
# present measures.
POPULATION_VALUE_RULES = [
    expect("valid_year_range", "year >= 2000 AND year <= 2030"),
    expect("positive_population", "population > 0"),
    expect("measures_populated", "population IS NOT NULL AND year IS NOT NULL"),
]

# Declared primary keys (checked as uniqueness rules).
PRIMARY_KEYS = {
    **{f"gold_dim_{t}": [f"{t}_sk"] for t in
       ("class", "duration", "footnote", "measure", "period", "seasonal", "sector", "series", "nation")},
    "gold_fact_population": ["nation_sk", "year"],
}

# Business key of each dimension: one row per value.
BUSINESS_KEYS = {
    **{f"gold_dim_{t}": [f"{t}_code"] for t in ("class", "duration", "footnote", "measure", "seasonal", "sector")},
    "gold_dim_period": ["period"], "gold_dim_series": ["series_id"], "gold_dim_nation": ["nation_id"],
}
