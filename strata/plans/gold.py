"""Gold: dimensions with surrogate keys and the two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import assign_surrogate_keys
from ..operators.lookup import BROADCAST_MAX_BYTES, Dim, lookup_key, measured

# Business key and column list of each code dimension.
DIMENSIONS = {
    "class": ("class_code", ["class_code", "class_text", "display_level", "selectable", "sort_sequence"]),
    "duration": ("duration_code", ["duration_code", "duration_text", "display_level", "selectable", "sort_sequence"]),
    "measure": ("measure_code", ["measure_code", "measure_text", "display_level", "selectable", "sort_sequence"]),
    "sector": ("sector_code", ["sector_code", "sector_name", "display_level", "selectable", "sort_sequence"]),
    "footnote": ("footnote_code", ["footnote_code", "footnote_text"]),
    "seasonal": ("seasonal_code", ["seasonal_code", "seasonal_text"]),
    "period": ("period", ["period", "period_abbr", "period_name", "period_type", "is_annual_average"]),
}


def gold_dim(name: str, silver: Dim | DataFrame) -> Dim:
    key, cols = DIMENSIONS[name]
    dim = silver if isinstance(silver, Dim) else measured(silver)
    return assign_surrogate_keys(dim.select(*cols), [key] + [c for c in cols if c != key], f"{name}_sk")


# Columns of the gold series dimension, in order.
SERIES_COLUMNS = ["series_id", "base_year", "footnote_codes", "begin_year", "begin_period",
                  "end_year", "end_period", "survey_code", "seasonal_code", "class_code",
                  "sector_code", "measure_code", "duration_code"]


def gold_dim_series_frame(silver_series: DataFrame) -> DataFrame:
    """Gold series columns (descriptions are not part of the gold dimension,
    so ``silver.series_codes`` is enough as input)."""
    return silver_series.select(
        F.trim("series_id").alias("series_id"), "base_year", "footnote_codes", "begin_year",
        "begin_period", "end_year", "end_period", "survey_code",
        F.col("seasonal_code_parsed").alias("seasonal_code"),
        F.col("class_code_parsed").alias("class_code"),
        F.col("sector_code_parsed").alias("sector_code"),
        F.col("measure_code_parsed").alias("measure_code"),
        F.col("duration_code_parsed").alias("duration_code"))


def gold_dim_series(silver_series: DataFrame | Dim) -> Dim:
    """Dense series keys; accepts the gold series frame already measured."""
    dim = silver_series if isinstance(silver_series, Dim) else measured(gold_dim_series_frame(silver_series))
    return assign_surrogate_keys(dim, SERIES_COLUMNS, "series_sk")


def gold_dim_nation_frame(silver_nation: DataFrame) -> DataFrame:
    return silver_nation.withColumnRenamed("nation", "name").select("nation_id", "name")


def gold_dim_nation(silver_nation: DataFrame | Dim) -> Dim:
    """Dense nation keys; accepts the gold nation frame already measured."""
    dim = silver_nation if isinstance(silver_nation, Dim) else measured(gold_dim_nation_frame(silver_nation))
    return assign_surrogate_keys(dim, ["nation_id", "name"], "nation_sk")


# Columns of the productivity fact, in order.
FACT_PRODUCTIVITY_COLUMNS = [
    "seasonal_code", "series_id", "class_sk", "duration_sk", "footnote_sk", "measure_sk",
    "period_sk", "sector_sk", "year", "value", "observation_date", "observation_year",
    "observation_quarter", "observation_month", "is_annual_average"]


# Fact column holding the business code looked up in each dimension.
FACT_LOOKUPS = {"class": "class_code", "duration": "duration_code", "footnote": "footnote_codes",
                "measure": "measure_code", "period": "period", "seasonal": "seasonal_code", "sector": "sector_code"}


def gold_fact_productivity(silver: DataFrame, dims, columns: list[str] | None = None,
                           max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Surrogate-key lookups (left joins: an unknown code gives a NULL key).
    The footnote list is matched as one whole string against single codes.
    Dimensions are broadcast behind their size check, so the fact keeps its
    partitioning and is not shuffled for a lookup; a dimension beyond it is
    joined with hot and NULL codes dealt over all tasks.

    ``columns`` restricts the result to those fact columns.  Every lookup is
    made whatever the columns: a business key that a dimension holds twice
    doubles its fact rows in each of them."""
    wanted = list(columns or FACT_PRODUCTIVITY_COLUMNS)
    df = silver
    for name, code in FACT_LOOKUPS.items():
        key = "footnote_code" if name == "footnote" else code
        df = lookup_key(df, dims[name].select(F.col(key).alias(f"_{name}_k"), f"{name}_sk"), code, f"_{name}_k", max_bytes)
    out = {"series_id": F.trim("series_id").alias("series_id")}
    return df.select(*[out.get(c, F.col(c)) for c in wanted])


def year_over_year(rows: DataFrame, keep: list[str] | None = None, with_id: bool = False) -> DataFrame:
    """Change of ``population`` against the row before, in the order of year, of
    the same nation_sk (gaps are not detected); change and percent change; a
    zero previous value gives a NULL percentage instead of an error.

    Rows without a nation_sk follow each other as if they were one nation, in
    the order of year and nation_id.  Their window is cut by year; the value
    before a year's first row, the last one of the latest year before it, comes
    as a row of its own (one a year) put in front: no task holds all of them."""
    keep = [c for c in keep or [] if c != "nation_id"]
    lost = F.col("nation_sk").isNull()
    columns = ["nation_sk", "year", "population", "nation_id", *keep]
    # A struct in a struct: the last row's value counts even where it is NULL.
    last = rows.where(lost).groupBy("year").agg(F.max(F.struct("nation_id", F.struct("population").alias("row"))).alias("_l"))
    before = last.select("year", F.lag("_l.row.population").over(Window.orderBy("year")).alias("population"), F.lit(0).alias("_own"))
    both = rows.select(*columns, F.lit(1).alias("_own")).unionByName(before, allowMissingColumns=True)
    w = Window.partitionBy("nation_sk", F.when(lost, F.col("year"))).orderBy("year", "_own", "nation_id")
    keep = (["nation_id"] if with_id else []) + keep
    df = (both.select("nation_sk", "year", "population", F.lag("population", 1).over(w).alias("previous_population"), "_own", *keep)
          .where("_own = 1"))
    change = F.col("population") - F.col("previous_population")
    return df.select("nation_sk", "year", "population", "previous_population", change.alias("population_change"),
                     (F.try_divide(change, F.col("previous_population")) * 100).alias("population_pct_change"), *keep)


def gold_fact_population(silver_population: DataFrame, dim_nation: Dim, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``year_over_year`` of every nation."""
    return year_over_year(with_nation_key(silver_population, dim_nation, max_bytes))


def with_nation_key(rows: DataFrame, dim_nation: Dim, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``rows`` with the nation_sk of their nation_id, NULL if it is unknown."""
    return lookup_key(rows, dim_nation.select("nation_sk", F.col("nation_id").alias("_nation_k")), "nation_id", "_nation_k",
                      max_bytes)
