"""Silver: trimmed code dimensions, the enriched series dimension, the
de-duplicated observations with standard dates, and population rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ..functions import codes
from ..functions.names import clean_column_names_nested
from ..operators.cdc import scd1
from ..operators.dedup import keep_first
from ..operators.lookup import Dim, lookup
from ..operators.ordering import By

TEXT_SUFFIXES = ("_text", "_name")


def silver_dim(bronze: DataFrame) -> DataFrame:
    """Trim every *_text / *_name column (codes and abbreviations untouched)."""
    return bronze.select(*[F.trim(F.col(c)).alias(c) if c.endswith(TEXT_SUFFIXES) else F.col(c)
                           for c in bronze.columns if c != "load_timestamp"])


def silver_period(bronze: DataFrame) -> DataFrame:
    return silver_dim(bronze).withColumns({
        "period_type": codes.period_type("period"),
        "is_annual_average": codes.is_annual_average("period"),
    })


SERIES_CODE_COLUMNS = [
    "series_id", "base_year", "footnote_codes", "begin_year", "begin_period", "end_year",
    "end_period", "survey_code", "seasonal_code_parsed", "sector_code_parsed",
    "class_code_parsed", "measure_code_parsed", "duration_code_parsed", "begin_year_int",
    "end_year_int"]


def series_codes(bronze: DataFrame) -> DataFrame:
    """Series metadata with the parts of the raw id and integer years (no
    descriptions)."""
    parts = codes.series_id_parts("series_id", suffix="_parsed")
    parts["survey_code"] = parts.pop("survey_code_parsed")
    return bronze.withColumns({
        **parts,
        "begin_year_int": F.col("begin_year").try_cast("int"),
        "end_year_int": F.col("end_year").try_cast("int"),
    }).select(*SERIES_CODE_COLUMNS)


def silver_series(bronze: DataFrame, sector: Dim, class_: Dim, measure: Dim,
                  duration: Dim, seasonal: Dim) -> DataFrame:
    """Parse the raw id, add integer years, look up five descriptions."""
    df = series_codes(bronze)
    lookups = [(sector, "sector_code", "sector_name", "sector_name_desc"),
               (class_, "class_code", "class_text", "class_desc"),
               (measure, "measure_code", "measure_text", "measure_desc"),
               (duration, "duration_code", "duration_text", "duration_desc"),
               (seasonal, "seasonal_code", "seasonal_text", "seasonal_desc")]
    for dim, code, text, alias in lookups:
        right = dim.select(F.col(code).alias("_k"), F.col(text).alias(alias))
        df = lookup(df, right, F.col(f"{code}_parsed") == F.col("_k"), "left").drop("_k")
    return df.select(*SERIES_CODE_COLUMNS, "sector_name_desc", "class_desc", "measure_desc",
                     "duration_desc", "seasonal_desc")


OBSERVATION_KEY = ["series_id", "year", "period"]
# Survivor of duplicate keys: the "current" file first, then the larger value,
# then the smaller footnote list (NULL first); the rest of the row breaks ties.
OBSERVATION_ORDER = [By("_src"), By("value", descending=True), By("footnote_codes")]

PRODUCTIVITY_COLUMNS = [
    "series_id", "year", "period", "value", "footnote_codes", "survey_code", "seasonal_code",
    "sector_code", "class_code", "measure_code", "duration_code", "observation_date",
    "observation_year", "observation_quarter", "observation_month", "period_type",
    "is_annual_average", "load_timestamp"]


def combined_observations(current: DataFrame, alldata: DataFrame) -> DataFrame:
    """Union by name (missing columns -> NULL), then one row per raw key."""
    both = (current.withColumn("_src", F.lit(0))
            .unionByName(alldata.withColumn("_src", F.lit(1)), allowMissingColumns=True))
    return keep_first(both, OBSERVATION_KEY, OBSERVATION_ORDER).drop("_src")


def parse_observations(df: DataFrame) -> DataFrame:
    """Parts of the raw id, period end date and its parts, type and flag.
    The id is trimmed only after it has been sliced."""
    parts = codes.series_id_parts("series_id")
    out = df.withColumns({
        **parts,
        **codes.observation_columns("year", "period"),
        "period_type": codes.period_type("period"),
        "is_annual_average": codes.is_annual_average("period"),
    }).withColumn("series_id", F.trim("series_id"))
    cols = [c for c in PRODUCTIVITY_COLUMNS if c in out.columns]
    return out.select(*cols)


def silver_productivity(current: DataFrame, alldata: DataFrame) -> DataFrame:
    return parse_observations(combined_observations(current, alldata))


# Schema of one population record in the API payload.
POPULATION_RECORD = ArrayType(StructType([
    StructField("Nation ID", StringType(), True),
    StructField("Nation", StringType(), True),
    StructField("Year", StringType(), True),
    StructField("Population", DoubleType(), True),
]))


def population_records(bronze: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """JSON text of ``data`` -> one row per record, clean names, typed columns
    (an empty or NULL array yields no row)."""
    keep = keep if keep is not None else ["load_timestamp"]
    rec = bronze.select(F.posexplode(F.from_json(F.col("data"), POPULATION_RECORD)).alias("record_pos", "_r"), *keep)
    flat = clean_column_names_nested(rec.select("_r.*", "record_pos", *keep))
    return flat.withColumns({
        "year": F.col("year").try_cast("int"),
        "population": F.col("population").try_cast("long"),
    })


def silver_population(changes: DataFrame, sequence_by: list[str]) -> DataFrame:
    """Keyed upsert on (year, nation_id), latest change wins, NULLs ignored."""
    latest = scd1(changes, ["year", "nation_id"], sequence_by, ignore_null_updates=True,
                  columns=["nation", "population"])
    return latest.select("nation", "nation_id", "population", "year")


def silver_population_nation(changes: DataFrame, first_seen_by: list[str]) -> DataFrame:
    """First-seen row per nation_id (later renames never replace it)."""
    cols = ["nation_id", "nation"] + [c for c in first_seen_by if c not in ("nation_id", "nation")]
    first = keep_first(changes.select(*cols), ["nation_id"], [By(c) for c in first_seen_by])
    return first.select("nation_id", "nation")
