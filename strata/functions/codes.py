"""The coded identifiers of the productivity series and their periods.

All rules are plain Spark expressions, so they stay inside whole-stage
codegen and are pushed/pruned by Catalyst like any other projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must match the source data's published layout).
# series_id is a fixed-width, blank-padded 17-character code; the parts are
# 1-based (position, length) slices of the raw, untrimmed identifier:
SERIES_ID_PARTS = {
    "survey_code": (1, 2),
    "seasonal_code": (3, 1),
    "sector_code": (4, 4),
    "class_code": (8, 1),
    "measure_code": (9, 2),
    "duration_code": (11, 1),
}
SERIES_ID_LENGTH = 17
# Period codes whose observation is an annual average.
ANNUAL_AVERAGE_PERIODS = ("Q05", "M13", "S03")
# Period type by the first letter of the period code; anything else is Unknown.
PERIOD_TYPES = (("Q", "Quarterly"), ("M", "Monthly"), ("S", "Semi-Annual"))
UNKNOWN_PERIOD_TYPE = "Unknown"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def series_id_parts(series_id="series_id", suffix: str = "") -> dict[str, Column]:
    sid = _c(series_id)
    return {name + suffix: F.substring(sid, pos, length)
            for name, (pos, length) in SERIES_ID_PARTS.items()}


def period_num(period="period") -> Column:
    """Number after the period letter (``Q01`` -> 1); NULL when not numeric."""
    return _c(period).substr(2, 2).try_cast("int")


def period_type(period="period") -> Column:
    p = _c(period)
    out = None
    for prefix, label in PERIOD_TYPES:
        out = (F.when(p.startswith(prefix), label) if out is None
               else out.when(p.startswith(prefix), label))
    return out.otherwise(UNKNOWN_PERIOD_TYPE)


def is_annual_average(period="period") -> Column:
    return _c(period).isin(*ANNUAL_AVERAGE_PERIODS)


def period_end_date(year="year", period="period") -> Column:
    """Last day of the period an observation refers to.

    Quarters 1-3 end Mar 31 / Jun 30 / Sep 30, any other quarter number Dec 31;
    month 13 (annual average) ends Dec 31, months 1-12 end on their last day;
    half 1 ends Jun 30, any other half Dec 31; other letters give NULL.
    An unparsable number gives NULL instead of failing the job.
    """
    y, p = _c(year), _c(period)
    n = period_num(p)

    def md(m: int, d: int) -> Column:
        return F.make_date(y, F.lit(m), F.lit(d))

    quarter_end = (F.when(n == 1, md(3, 31)).when(n == 2, md(6, 30))
                   .when(n == 3, md(9, 30)).when(n.isNotNull(), md(12, 31)))
    month_end = (F.when(n == 13, md(12, 31))
                 .when(n.between(1, 12), F.last_day(F.make_date(y, n, F.lit(1)))))
    half_end = F.when(n == 1, md(6, 30)).when(n.isNotNull(), md(12, 31))
    return (F.when(p.startswith("Q"), quarter_end)
            .when(p.startswith("M"), month_end)
            .when(p.startswith("S"), half_end))


def observation_columns(year="year", period="period", date_name: str = "observation_date",
                        prefix: str = "observation_") -> dict[str, Column]:
    """observation_date plus its year / quarter / month, in one projection."""
    d = period_end_date(year, period)
    return {
        date_name: d,
        prefix + "year": F.year(d),
        prefix + "quarter": F.quarter(d),
        prefix + "month": F.month(d),
    }
