"""Population records, year-over-year fact and the nation dimension."""

import datetime as dt
import json

import pytest

from strata.operators.lookup import measured
from strata.plans import gold as G
from strata.plans import silver as S

BRONZE = "data STRING, load_timestamp TIMESTAMP"
SILVER = "nation STRING, nation_id STRING, population BIGINT, year INT"


def _page(*rows):
    return json.dumps([dict(zip(("Nation ID", "Nation", "Year", "Population"), r)) for r in rows])


def test_records_are_typed(spark):
    page = _page(("P7", "Norland", "1987", 1.25e6), ("P7", "Norland", "1988", 1300007), ("Q2", "Isle", "x", 12))
    rec = S.population_records(spark.createDataFrame([(page, dt.datetime(2024, 1, 5))], BRONZE))
    assert {"population": "bigint", "year": "int"}.items() <= dict(rec.dtypes).items()
    got = {(r["nation_id"], r["year"]): r["population"] for r in rec.collect()}
    assert got == {("P7", 1987): 1_250_000, ("P7", 1988): 1_300_007, ("Q2", None): 12}


@pytest.mark.parametrize("data", ["[]", None])
def test_no_records(spark, data):
    assert S.population_records(spark.createDataFrame([(data, None)], BRONZE)).isEmpty()


def test_the_first_name_of_a_nation_stays(spark):
    loads = [(5, "Q2", "Isle"), (3, "P7", "Norland"), (4, "P7", "North Land"), (6, "Q2", "The Isle")]
    seen = S.silver_population_nation(spark.createDataFrame(loads, "load_no INT, nation_id STRING, nation STRING"),
                                      ["load_no", "nation"])
    assert {tuple(r) for r in seen.collect()} == {("P7", "Norland"), ("Q2", "Isle")}


def _fact(spark, rows, known):
    silver = spark.createDataFrame(rows, SILVER)
    dim = G.gold_dim_nation(spark.createDataFrame(known, "nation_id STRING, nation STRING"))
    keys = {r["nation_id"]: r["nation_sk"] for r in dim.df.collect()}
    return keys, [r.asDict() for r in G.gold_fact_population(silver, dim).collect()]


def test_change_against_the_row_before(spark):
    rows = [("N", "P7", 480, 2003), ("N", "P7", 400, 2001), ("N", "P7", 360, 2006), ("I", "Q2", 0, 2001), ("I", "Q2", 9, 2002)]
    keys, fact = _fact(spark, rows, [("P7", "N"), ("Q2", "I")])
    got = {(r["nation_sk"], r["year"]): (r["previous_population"], r["population_change"], r["population_pct_change"])
           for r in fact}
    p, q = keys["P7"], keys["Q2"]
    assert got == {(p, 2001): (None, None, None), (p, 2003): (400, 80, 20.0), (p, 2006): (480, -120, -25.0),
                   (q, 2001): (None, None, None), (q, 2002): (0, 9, None)}


def test_unknown_nations_stay_in_a_fixed_order(spark):
    rows = [("?", "Z9", 7, 2001), ("?", "Y8", 4, 2001), ("N", "P7", 1, 2001)]
    for order in (rows, rows[::-1]):
        _, fact = _fact(spark, order, [("P7", "N")])
        lost = {r["population"]: r["previous_population"] for r in fact if r["nation_sk"] is None}
        assert len(fact) == 3 and lost == {4: None, 7: 4}


def test_nation_keys_follow_the_ids(spark):
    dim = G.gold_dim_nation(spark.createDataFrame([("Q2", "Isle"), ("A1", "Moor"), ("P7", "Norland")],
                                                  "nation_id STRING, nation STRING")).df
    assert sorted(map(tuple, dim.collect())) == [(1, "A1", "Moor"), (2, "P7", "Norland"), (3, "Q2", "Isle")]
    assert measured(dim).rows == 3


def test_records_non_finite_population_is_null(spark):
    data = '[{"Nation ID": "X", "Nation": "X", "Year": "2020", "Population": NaN}]'
    bronze = spark.createDataFrame([(data, None)], "data STRING, load_timestamp TIMESTAMP")
    assert S.population_records(bronze).first()["population"] is None
