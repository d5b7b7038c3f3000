"""De-duplication, keyed upserts, surrogate keys, lookups and quality rules."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import lookup as LK
from strata.operators import quality
from strata.operators.cdc import scd1
from strata.operators.dedup import keep_first
from strata.operators.keys import assign_surrogate_keys, extend_surrogate_keys
from strata.operators.lookup import Dim, lookup, measured, measured_all
from strata.operators.ordering import By

OBS_SCHEMA = "series_id STRING, year INT, period STRING, value DOUBLE, footnote_codes STRING, _src INT"
OBS = [
    ("PRS1", 2020, "Q01", 1.0, None, 1),
    ("PRS1", 2020, "Q01", 2.0, None, 0),   # current file wins
    ("PRS1", 2020, "Q02", 5.0, "B", 1),
    ("PRS1", 2020, "Q02", 5.0, "A", 1),    # same value: smaller footnote wins
    ("PRS1", 2020, "Q02", 5.0, None, 1),   # ... and NULL first
    ("PRS1", 2020, "Q03", None, None, 1),
    ("PRS1", 2020, "Q03", 3.0, None, 1),   # larger value wins, NULL value last
    ("PRS1 ", 2020, "Q01", 9.0, None, 1),  # differently padded id is another key
]
ORDER = [By("_src"), By("value", descending=True), By("footnote_codes")]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keep_first_rules(spark):
    df = spark.createDataFrame(OBS, OBS_SCHEMA)
    got = _rows(keep_first(df, ["series_id", "year", "period"], ORDER))
    assert got == [("PRS1", 2020, "Q01", 2.0, None, 0), ("PRS1", 2020, "Q02", 5.0, None, 1),
                   ("PRS1", 2020, "Q03", 3.0, None, 1), ("PRS1 ", 2020, "Q01", 9.0, None, 1)]


def test_keep_first_is_order_independent(spark):
    base = _rows(keep_first(spark.createDataFrame(OBS, OBS_SCHEMA), ["series_id", "year", "period"], ORDER))
    for seed in range(3):
        rows = OBS[:]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, OBS_SCHEMA).repartition(3)
        assert _rows(keep_first(df, ["series_id", "year", "period"], ORDER)) == base


def test_keep_first_hot_key_is_partially_aggregated(spark):
    df = spark.range(0, 3000).select((F.col("id") % 1).alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], [By("v", descending=True)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert _rows(out) == [(0, 2999)]


CHG_SCHEMA = "k STRING, seq INT, a STRING, b INT"
CHANGES = [("x", 1, "a1", 10), ("x", 2, None, 20), ("x", 3, "a3", None),
           ("y", 1, None, None), ("z", 5, "z5", 1), ("z", 4, "z4", 2)]


def test_scd1_ignore_nulls(spark):
    df = spark.createDataFrame(CHANGES, CHG_SCHEMA)
    got = _rows(scd1(df, ["k"], "seq", ignore_null_updates=True, columns=["a", "b"]))
    # y has only NULLs so far and is still kept
    assert got == [("x", "a3", 20), ("y", None, None), ("z", "z5", 1)]


def test_scd1_overwrite(spark):
    df = spark.createDataFrame(CHANGES, CHG_SCHEMA)
    got = _rows(scd1(df, ["k"], "seq", ignore_null_updates=False, columns=["a", "b"]))
    assert got == [("x", "a3", None), ("y", None, None), ("z", "z5", 1)]


def test_scd1_same_result_for_any_split(spark):
    df = spark.createDataFrame(CHANGES, CHG_SCHEMA)
    whole = _rows(scd1(df, ["k"], "seq", columns=["a", "b"]))
    # fold in two parts: state after part 1 carries per-column (seq, value)
    rows = CHANGES[:]
    random.Random(7).shuffle(rows)
    shuffled = spark.createDataFrame(rows, CHG_SCHEMA).repartition(4)
    assert _rows(scd1(shuffled, ["k"], "seq", columns=["a", "b"])) == whole


def test_surrogate_keys_window_and_range_agree(spark):
    codes = spark.range(0, 500).select(F.format_string("C%04d", (F.col("id") * 7919) % 500).alias("code"))
    dim = measured(codes)
    small = assign_surrogate_keys(dim, ["code"], "code_sk").df
    large = assign_surrogate_keys(dim, ["code"], "code_sk", rows_per_range=7).df
    a, b = _rows(small), _rows(large)
    assert a == b
    assert [r[0] for r in a] == list(range(1, 501))
    assert [r[1] for r in sorted(a)] == sorted(r[1] for r in a)


def test_extend_keys_is_stable(spark):
    old = assign_surrogate_keys(measured(spark.createDataFrame([("b",), ("d",)], "code STRING")),
                                ["code"], "sk").df
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "code STRING")
    got = _rows(extend_surrogate_keys(old, new, ["code"], "sk"))
    assert got == [(1, "b"), (2, "d"), (3, "a"), (4, "c")]


def test_lookup_broadcasts_only_checked_small_dims(spark):
    fact = spark.range(100).select((F.col("id") % 3).alias("k"))
    dim = measured(spark.createDataFrame([(0, "a"), (1, "b")], "k LONG, t STRING"))
    plan = lookup(fact, dim, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    big = Dim(dim.df, rows=10 ** 9, bytes=10 ** 12)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = lookup(fact, big, "k", "left")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_measured_all_counts(spark):
    got = measured_all({"a": spark.range(3), "b": spark.range(7)})
    assert got["a"].rows == 3 and got["b"].rows == 7


def test_quality_report_counts_nulls_as_violations(spark):
    df = spark.createDataFrame([(1, "T"), (None, "F"), (3, "X"), (4, None)], "code INT, selectable STRING")
    rules = [quality.expect_or_fail("valid_code", "code IS NOT NULL"),
             quality.expect("valid_selectable", "selectable IN ('T', 'F')")]
    got = _rows(quality.quality_report({"t": (df, rules)}))
    assert got == [("t", "valid_code", "fail", 1, 4), ("t", "valid_selectable", "warn", 2, 4)]


def test_observed_rules_fail_after_write(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "code INT")
    rules = [quality.expect_or_fail("valid_code", "code IS NOT NULL")]
    obs_df, obs = quality.observed(df, "t", rules)
    obs_df.write.mode("overwrite").parquet(str(tmp_path / "t"))
    with pytest.raises(quality.ExpectationFailed):
        quality.check(obs, "t", rules)
    ok_df, ok = quality.observed(df.filter("code IS NOT NULL"), "t2", rules)
    ok_df.write.mode("overwrite").parquet(str(tmp_path / "t2"))
    assert quality.check(ok, "t2", rules) == {"valid_code": 0}


def test_uniqueness_and_orphans(spark):
    dim = spark.createDataFrame([(1, "01000US"), (2, "CA"), (3, "MX")], "nation_sk LONG, nation_id STRING")
    assert tuple(quality.key_uniqueness(dim, ["nation_sk"]).first()) == (3, 3)
    fact = spark.createDataFrame([(1, 2020), (1, 2021), (2, 2020), (1, 2020)], "nation_sk LONG, year INT")
    assert tuple(quality.key_uniqueness(fact, ["nation_sk", "year"]).first()) == (4, 3)
    assert _rows(quality.duplicate_keys(fact, ["nation_sk", "year"])) == [(1, 2020, 2)]
    assert quality.orphan_keys(fact, dim, "nation_sk").count() == 0
    bad = spark.createDataFrame([(9, 2020), (None, 2020)], "nation_sk LONG, year INT")
    assert _rows(quality.orphan_keys(bad, dim, "nation_sk").fillna(-1)) == [(-1,), (9,)]


def test_quality_report_shares_one_pass_for_one_frame(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "a INT, b INT")
    r1 = [quality.expect("a_set", "a IS NOT NULL")]
    r2 = [quality.expect_or_fail("b_set", "b IS NOT NULL")]
    report = quality.quality_report({"t1": (df, r1), "t2": (df, r2)})
    assert _rows(report) == [("t1", "a_set", "warn", 1, 2), ("t2", "b_set", "fail", 1, 2)]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_extended_keys_with_null_business_key(spark):
    from strata.operators.keys import extend_surrogate_keys
    old = spark.createDataFrame([(1, "a", "x"), (2, None, "n")], "sk BIGINT, code STRING, name STRING")
    load = spark.createDataFrame([(None, "N"), ("b", "y")], "code STRING, name STRING")
    once = extend_surrogate_keys(old, load, ["code"], "sk")
    assert {tuple(r) for r in once.collect()} == {(1, "a", "x"), (2, None, "N"), (3, "b", "y")}
    assert extend_surrogate_keys(once, load, ["code"], "sk").count() == 3


def _skewed(spark):
    """A third of the rows without a key, a third with one key, the rest mixed."""
    rows = spark.range(0, 30000, 1, 7).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("code"))
    dim = spark.createDataFrame([("hot", 1), ("k7", 2), ("k11", 3), ("k11", 4), ("unused", 5), (None, 6)], "_code string, sk int")
    return rows, dim


def test_dealt_lookup_equals_the_plain_join(spark):
    rows, dim = _skewed(spark)
    plain = rows.join(dim, rows["code"] == dim["_code"], "left").drop("_code")
    got = LK.lookup_key(rows, LK.Dim(dim, 6, 1 << 40), "code", "_code")
    assert got.columns == plain.columns
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    for part in (rows.where("code IS NULL"), rows.limit(0), rows.where("code = 'k7'")):
        assert LK.dealt_lookup(part, dim, "code", "_code").count() == part.count()
    numbers = spark.range(100).select((F.col("id") % 5).alias("n"))
    keys = spark.range(3).select(F.col("id").alias("_n"), (F.col("id") * 10).alias("v"))
    assert LK.dealt_lookup(numbers, keys, "n", "_n").where("v IS NOT NULL").count() == 60


def test_no_task_of_a_dealt_lookup_is_much_larger(spark):
    rows, dim = _skewed(spark)
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = lambda df: sorted(r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect())
        plain = sizes(rows.join(dim, rows["code"] == dim["_code"], "left"))
        dealt = sizes(LK.dealt_lookup(rows, dim, "code", "_code"))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert dealt[-1] <= 1.3 * dealt[len(dealt) // 2] and plain[-1] > 1.3 * dealt[-1]


def test_distinct_counts_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, "b", "x"), (None, "b", "y"), (2, "b", "x")], "k int, c string, d string")
    got = quality.keys_uniqueness(df, "t", [["k"], ["c"], ["k", "c"], ["d", "c"]])
    assert sorted(map(tuple, got.collect())) == [("t", "c", 5, 2), ("t", "d,c", 5, 3), ("t", "k", 5, 2), ("t", "k,c", 5, 3)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    none = quality.keys_uniqueness(df.limit(0), "t", [["k"], ["c"]])
    assert sorted(map(tuple, none.collect())) == [("t", "c", 0, 0), ("t", "k", 0, 0)]
