"""Operators against brute-force Python on random small inputs."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions import codes
from strata.operators.cdc import scd1
from strata.operators.dedup import keep_first
from strata.operators.ordering import By

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

obs_rows = st.lists(st.tuples(
    st.integers(0, 3),                                   # key
    st.integers(0, 1),                                   # source rank
    st.one_of(st.none(), st.integers(1, 3).map(float)),  # value
    st.one_of(st.none(), st.sampled_from(["A", "B"])),   # footnote
), min_size=1, max_size=25)


def _first_brute(rows):
    def order(r):
        _, src, v, f = r
        return (src, v is None, -(v or 0.0), f is not None, f or "")
    best = {}
    for r in rows:
        if r[0] not in best or order(r) < order(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=lambda r: r[0])


@SETTINGS
@given(obs_rows)
def test_keep_first_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k INT, src INT, v DOUBLE, f STRING")
    got = keep_first(df, ["k"], [By("src"), By("v", descending=True), By("f")])
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == _first_brute(rows)


changes = st.lists(st.tuples(
    st.integers(0, 3),                                    # key
    st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
    st.one_of(st.none(), st.integers(0, 9)),
), min_size=1, max_size=25)


@SETTINGS
@given(changes, st.booleans())
def test_scd1_matches_brute_force(spark, rows, ignore_nulls):
    seq_rows = [(k, i, a, b) for i, (k, a, b) in enumerate(rows)]   # sequence = arrival index
    df = spark.createDataFrame(seq_rows, "k INT, seq INT, a STRING, b INT")
    got = {r["k"]: (r["a"], r["b"]) for r in
           scd1(df, ["k"], "seq", ignore_null_updates=ignore_nulls, columns=["a", "b"]).collect()}
    want = {}
    for k, _, a, b in seq_rows:                                      # fold in sequence order
        old = want.get(k, (None, None))
        want[k] = ((a if a is not None else old[0], b if b is not None else old[1])
                   if ignore_nulls else (a, b))
    assert got == want


periods = st.one_of(
    st.builds(lambda p, n: f"{p}{n:02d}", st.sampled_from("QMSA"), st.integers(0, 15)),
    st.sampled_from(["QXX", "M1", "", "S"]))


def _end_brute(year, period):
    if year is None or not period:
        return None
    try:
        n = int(period[1:3])
    except ValueError:
        return None                      # an unparsable number is no period
    if period[0] == "Q":
        return {1: dt.date(year, 3, 31), 2: dt.date(year, 6, 30), 3: dt.date(year, 9, 30)}.get(
            n, dt.date(year, 12, 31))
    if period[0] == "M":
        if n == 13:
            return dt.date(year, 12, 31)
        if 1 <= n <= 12:
            return dt.date(year, n, calendar.monthrange(year, n)[1])
        return None
    if period[0] == "S":
        return dt.date(year, 6, 30) if n == 1 else dt.date(year, 12, 31)
    return None


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(1900, 2100)), periods), min_size=1, max_size=20))
def test_period_end_date_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "year INT, period STRING")
    got = [r[0] for r in df.select(codes.period_end_date("year", "period")).collect()]
    assert got == [_end_brute(y, p) for y, p in rows]
