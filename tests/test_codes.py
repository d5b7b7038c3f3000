"""Series-id parsing and period rules."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import codes


def _eval(spark, rows, *exprs):
    df = spark.createDataFrame(rows, "year INT, period STRING")
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_series_id_parts(spark):
    df = spark.createDataFrame([("PRS30006011      ",), ("  PRS30006011    ",)], "series_id STRING")
    out = df.select(*[c.alias(n) for n, c in codes.series_id_parts("series_id").items()]).collect()
    assert tuple(out[0]) == ("PR", "S", "3000", "6", "01", "1")
    # the raw id is sliced: leading blanks shift every part
    assert tuple(out[1]) != ("PR", "S", "3000", "6", "01", "1")


def test_period_end_date(spark):
    rows = [(2020, "Q01"), (2020, "Q02"), (2020, "Q03"), (2020, "Q04"), (2020, "Q05"),
            (2020, "M02"), (2021, "M02"), (2020, "M13"), (2020, "M14"), (2020, "S01"),
            (2020, "S02"), (2020, "S03"), (2020, "A01"), (2020, "QXX"), (2020, "SX"), (2020, "Q"), (None, "Q01")]
    got = [r[0] for r in _eval(spark, rows, codes.period_end_date("year", "period"))]
    d = dt.date
    assert got == [d(2020, 3, 31), d(2020, 6, 30), d(2020, 9, 30), d(2020, 12, 31), d(2020, 12, 31),
                   d(2020, 2, 29), d(2021, 2, 28), d(2020, 12, 31), None, d(2020, 6, 30),
                   d(2020, 12, 31), d(2020, 12, 31), None, None, None, None, None]


def test_period_type_and_annual_flag(spark):
    rows = [(2020, "Q01"), (2020, "M13"), (2020, "S03"), (2020, "A01"), (2020, "Q05"), (2020, "M12")]
    got = _eval(spark, rows, codes.period_type("period"), codes.is_annual_average("period"))
    assert got == [("Quarterly", False), ("Monthly", True), ("Semi-Annual", True),
                   ("Unknown", False), ("Quarterly", True), ("Monthly", False)]


def test_observation_parts(spark):
    cols = codes.observation_columns("year", "period")
    got = _eval(spark, [(2019, "M07")], *[c.alias(n) for n, c in cols.items()])
    assert got == [(dt.date(2019, 7, 31), 2019, 3, 7)]


def test_period_num(spark):
    got = _eval(spark, [(1, "Q01"), (1, "M12"), (1, "QXX")], codes.period_num("period"))
    assert [r[0] for r in got] == [1, 12, None]
    assert F  # keep import used
