"""Plan shapes the design relies on (checked on the executed plans)."""

import __spark_entry__ as E

from given_tables import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_q2_plan(spark):
    plan = _plan(spark, "q2_best_year")
    assert "BroadcastHashJoin" in plan                 # dimension lookups are broadcast
    assert "SortMergeJoin" not in plan                 # ... so the fact is never shuffled for one
    assert "partial_sum" in plan                       # per-(series, year) sums combine map-side
    assert "partial_min" in plan                       # de-duplication combines map-side
    assert "WindowGroupLimit" in plan                  # rank = 1 limited before the final window
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # only the columns the question needs are read from lineitem
    scans = [l for l in plan.splitlines() if "lineitem.parquet" in l]
    assert scans and all("l_extendedprice" not in l.split("ReadSchema")[-1] for l in scans)


def test_fact_lookups_do_not_shuffle_the_fact(spark):
    plan = _plan(spark, "fact_star_left")
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 6


def test_q3_filter_reaches_the_scan(spark):
    plan = _plan(spark, "q3_series_population")
    scans = [l for l in plan.splitlines() if "lineitem.parquet" in l]
    assert scans and all("DataFilters: [" in l and "trim(" in l for l in scans)
