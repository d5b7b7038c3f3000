"""Declared-schema sink with rule enforcement; TSV landing round trip."""

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans import tables as T
from strata.session import scratch_path
from strata.sources.tsv import LANDING_DDL, read_tsv, write_tsv


def test_materialize_publishes_with_comments(spark):
    root = scratch_path(spark, "dim")
    df = spark.createDataFrame([(1, "0100", "Sector A", 0, "T", 1)],
                               "sector_sk INT, sector_code STRING, sector_name STRING, "
                               "display_level INT, selectable STRING, sort_sequence INT")
    counts = T.materialize(spark, df, root, T.GOLD_SPECS["gold_dim_sector"])
    assert counts == {"sector_code is not null": 0}
    back = T.read_published(spark, root)
    assert dict(back.dtypes)["sector_sk"] == "bigint"
    assert back.schema["sector_code"].metadata.get("comment", "").startswith("Four-character")


def test_failed_fail_rule_keeps_previous_version(spark):
    root = scratch_path(spark, "fact")
    spec = T.GOLD_SPECS["gold_fact_population"]
    good = spark.createDataFrame([(1, 2020, 10, None, None, None)],
                                 "nation_sk BIGINT, year INT, population BIGINT, previous_population BIGINT, "
                                 "population_change BIGINT, population_pct_change DOUBLE")
    T.materialize(spark, good, root, spec)
    bad = good.withColumn("nation_sk", F.lit(None).cast("bigint"))
    with pytest.raises(quality.ExpectationFailed):
        T.materialize(spark, bad, root, spec)
    assert [tuple(r) for r in T.read_published(spark, root).collect()] == [(1, 2020, 10, None, None, None)]


def test_tsv_round_trip_keeps_padding_and_nulls(spark):
    root = scratch_path(spark, "tsv")
    rows = [("PRS30006011      ", 2020, "Q01", 1.5, None), ("PRS30006012      ", 2021, "M13", None, "A,B")]
    df = spark.createDataFrame(rows, LANDING_DDL["data_0_current"])
    write_tsv(df, root)
    back = read_tsv(spark, root, LANDING_DDL["data_0_current"])
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_tsv_unparsable_numbers_are_null(spark, tmp_path):
    p = tmp_path / "data.tsv"
    p.write_text("series_id\tyear\tperiod\tvalue\tfootnote_codes\nPRS1\t199X\tQ01\t-\t\n")
    got = read_tsv(spark, str(p), LANDING_DDL["data_0_current"]).collect()
    assert [tuple(r) for r in got] == [("PRS1", None, "Q01", None, None)]


def test_json_pages_are_bounded_and_complete(spark):
    import math
    from strata.plans import silver as S
    from strata.sources import json_pages
    from strata.sources import landing as L
    from given_tables import SF_SMALL
    loads = L.landing_population_loads(spark, SF_SMALL).filter("load_no = 1")
    root = scratch_path(spark, "pages")
    json_pages.write_population_pages(loads, root, 1, "2024-01-01", page_size=4)
    pages = json_pages.read_pages(spark, root)
    per_year = {r["year"]: r["n"] for r in loads.groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert pages.count() <= sum(math.ceil(n / 4) for n in per_year.values())
    assert pages.count() > len(per_year)
    assert S.population_records(pages, keep=[]).count() == loads.count()


def test_failed_rerun_keeps_the_rows_of_the_run_before(spark):
    import pytest
    from strata.operators import quality
    from strata.plans import tables as T
    from strata.session import scratch_path
    path = scratch_path(spark, "checked")
    rules = [quality.expect_or_fail("small", "id < 10")]
    T.write_checked(spark, spark.range(5), path, "t", rules)
    with pytest.raises(quality.ExpectationFailed):
        T.write_checked(spark, spark.range(50), path, "t", rules)
    assert spark.read.parquet(path).count() == 5
    T.write_checked(spark, spark.range(7), path, "t", rules)
    assert spark.read.parquet(path).count() == 7
