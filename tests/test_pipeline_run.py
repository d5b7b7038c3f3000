"""Full pipeline run: tables written layer by layer with rules enforced."""

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import ExpectationFailed
from strata.plans import tables as T
from strata.plans.pipeline import Pipeline
from strata.session import scratch_path
from strata.sources import landing as L

from given_tables import SF_SMALL


def test_run_writes_every_table_and_reports_rules(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    root = scratch_path(spark, "run")
    report = p.materialize(root)
    # every gold table is stored with its declared types and comments
    assert set(T.GOLD_SPECS) == {n for n in p.tables() if n.startswith("gold_")}
    for name, spec in T.GOLD_SPECS.items():
        stored = spark.read.parquet(f"{root}/{name}").schema
        assert [(f.name, f.dataType, f.metadata["comment"]) for f in stored] == \
            [(f.name, f.dataType, f.metadata["comment"]) for f in spec.schema]
    assert {"brz_pr_data_0_current", "slv_pr_productivity", "gold_fact_productivity",
            "gold_fact_population", "gold_dim_series"} <= set(report)
    # the sector landing carries one selectable code outside T/F: a warning, not a failure
    assert report["brz_pr_sector"]["valid_selectable"] == 1
    assert report["gold_fact_population"]["gold_population_nation_fk"] == 0
    # later layers read the stored tables: the fact's plan starts from files
    plan = p.gold_fact_productivity._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Relation") and "l_shipdate" not in plan
    assert p.gold_fact_productivity.count() == p.silver_productivity.count()


class _BadLanding(L.TableLanding):
    @property
    def data_current(self):
        base = super().data_current
        bad = base.limit(1).withColumn("series_id", F.lit(None).cast("string"))
        return base.unionByName(bad)


def test_fail_rule_stops_the_run(spark):
    p = Pipeline(spark, _BadLanding(spark, SF_SMALL))
    with pytest.raises(ExpectationFailed, match="valid_series_id"):
        p.materialize(scratch_path(spark, "bad-run"))


def test_population_arrives_through_the_streams(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    batch = p.gold_fact_population.select("nation_sk", "year", "population", "population_change").collect()
    report = p.run_population(scratch_path(spark, "population"))
    assert report["population_data_transformed"] == {"year_populated": 0}
    assert set(report["brz_population_data"]) == {"data_element_populated"}
    assert "load_timestamp" in p.silver_population.columns and "load_timestamp" in p.silver_population_nation.columns
    assert p.silver_population.where("load_timestamp IS NULL").isEmpty()
    q = Pipeline.from_tables(spark, SF_SMALL)
    q.__dict__.update({n: p.__dict__[n] for n in ("silver_population", "silver_population_nation")})
    streamed = q.gold_fact_population.select("nation_sk", "year", "population", "population_change").collect()
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, batch))


class _DoubleCode(L.TableLanding):
    """The sector with the most observations stands twice in its dimension."""
    @property
    def sector(self):
        base = super().sector
        return base.unionByName(base.withColumn("sector_name", F.lit("Again")))


def test_a_code_twice_doubles_its_facts_whatever_columns_are_asked(spark):
    p = Pipeline(spark, _DoubleCode(spark, SF_SMALL))
    rows = p.gold_fact_productivity.count()
    assert rows > p.silver_productivity.count()
    assert p.fact_productivity(["series_id", "year", "value"]).count() == rows
    assert p.fact_productivity(["class_sk"]).count() == rows


class _MoreSectors(L.TableLanding):
    """A code before all others and one in the middle."""
    @property
    def sector(self):
        base = super().sector
        more = [(c, f"New {c}", 0, "T", 0) for c in ("0000a", "0550")]
        return base.unionByName(base.sparkSession.createDataFrame(more, base.schema))


def test_a_second_run_keeps_all_keys(spark):
    root = scratch_path(spark, "two-runs")
    first = Pipeline.from_tables(spark, SF_SMALL)
    first.materialize(root)
    old = {r["sector_code"]: r["sector_sk"] for r in first.gold_dims["sector"].df.collect()}
    facts = sorted(map(str, first.gold_fact_productivity.collect()))
    assert sorted(old.values()) == list(range(1, len(old) + 1)) and sorted(old, key=old.get) == sorted(old)
    second = Pipeline(spark, _MoreSectors(spark, SF_SMALL))
    second.materialize(root)
    new = {r["sector_code"]: r["sector_sk"] for r in second.gold_dims["sector"].df.collect()}
    assert {c: new[c] for c in old} == old and {c: new[c] - len(old) for c in set(new) - set(old)} == {"0000a": 1, "0550": 2}
    assert sorted(map(str, second.gold_fact_productivity.collect())) == facts


def test_interrupted_swaps_recover(spark):
    path = scratch_path(spark, "swap")
    fs = T.snapshots._fs(spark, path)[0]
    at = lambda end: T.snapshots._fs(spark, path + end)[1]
    T.write_checked(spark, spark.range(3), path, "t", [])
    assert spark.read.parquet(path).count() == 3
    fs.rename(at(""), at("__before"))                             # moved aside, nothing moved in
    T.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    spark.range(5).write.parquet(path + "__checked")
    T._touch(spark, f"{path}__checked/{T.PUBLISHED}")
    fs.rename(at(""), at("__before"))                             # stopped between the two moves
    T.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    spark.range(7).write.parquet(path + "__checked")              # never checked to the end
    T.recover(spark, path)
    assert spark.read.parquet(path).count() == 5 and not fs.exists(at("__checked")) and not fs.exists(at("__before"))
