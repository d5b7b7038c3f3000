"""Declared table schemas (with column comments), primary keys, and the
write path that enforces quality rules.

``materialize`` casts a DataFrame to its declared schema (column comments
travel in the schema metadata), counts every rule while the table is being
written (``observe``: no extra pass), and publishes the version only if no
``fail`` rule was violated.  Readers see published versions only, so a
failed update leaves the previous version in place ("fail closed")."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import quality
from ..streaming import snapshots
from . import expectations as EX
from . import gold as G
from . import silver as S

PUBLISHED = "_PUBLISHED"


def version_path(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/v={v:012d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Version numbers present under ``root`` (written, maybe unpublished)."""
    fs, p = snapshots._fs(spark, root)
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName()[2:]) for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith("v="))


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    comment: str = ""
    primary_key: tuple[str, ...] = ()
    rules: list = field(default_factory=list)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


# Types of the silver and gold columns that are not STRING.
TYPES = {"BIGINT": ("population", "previous_population", "population_change"),
         "INT": ("begin_year_int", "end_year_int", "display_level", "sort_sequence", "year", "observation_year", "observation_quarter",
                 "observation_month"),
         "DOUBLE": ("value", "population_pct_change"), "DATE": ("observation_date",),
         "BOOLEAN": ("is_annual_average",), "TIMESTAMP": ("load_timestamp",)}

# What each column of the silver and gold tables holds.
COMMENTS = {
    "display_level": "Depth of the entry in the display hierarchy",
    "selectable": "T when the entry can be selected, F for headings",
    "sort_sequence": "Position of the entry in the published listing",
    "class_code": "Class code", "class_text": "Class description, blanks trimmed",
    "duration_code": "Duration code", "duration_text": "Duration description, blanks trimmed",
    "measure_code": "Measure code", "measure_text": "Measure description, blanks trimmed",
    "sector_code": "Four-character sector code", "sector_name": "Sector description, blanks trimmed",
    "footnote_code": "Footnote code", "footnote_text": "Footnote, blanks trimmed",
    "footnote_codes": "Footnote codes as delivered, a list in one text",
    "seasonal_code": "Code of seasonal adjustment", "seasonal_text": "Seasonal adjustment, blanks trimmed",
    "period": "Period code", "period_abbr": "Short name of the period", "period_name": "Name of the period, blanks trimmed",
    "period_type": "Kind of period", "is_annual_average": "True for the average of a whole year",
    "series_id": "Series identifier, blanks trimmed", "survey_code": "Survey part of the series identifier",
    "base_year": "Year to which index values refer", "begin_year": "Year of the first observation",
    "begin_period": "Period of the first observation", "end_year": "Year of the last observation",
    "end_period": "Period of the last observation",
    "year": "Calendar year", "value": "Observed value", "observation_date": "Last day of the period",
    "observation_year": "Year of observation_date", "observation_quarter": "Quarter of observation_date",
    "observation_month": "Month of observation_date",
    **{f"{c}_parsed": f"{c[:-5].capitalize()} part of the series identifier"
       for c in ("seasonal_code", "sector_code", "class_code", "measure_code", "duration_code")},
    "begin_year_int": "begin_year as a number", "end_year_int": "end_year as a number",
    "sector_name_desc": "Sector description of the sector part", "class_desc": "Class description",
    "measure_desc": "Measure description", "duration_desc": "Duration description",
    "seasonal_desc": "Description of the seasonal adjustment", "load_timestamp": "When the row was loaded",
    "nation": "Nation name as delivered", "nation_id": "Nation identifier as delivered", "name": "Nation name as first delivered",
    "population": "Population in that year", "previous_population": "Population of the previous row in year order",
    "population_change": "population - previous_population",
    "population_pct_change": "Change in percent of previous_population",
}


def _ddl(columns: list[str]) -> str:
    kinds = {c: kind for kind, names in TYPES.items() for c in names}
    return ", ".join(f"{c} BIGINT COMMENT 'Surrogate key: {c[:-3]}'" if c.endswith("_sk")
                     else f"{c} {kinds.get(c, 'STRING')} COMMENT '{COMMENTS[c]}'" for c in columns)


def _gold_spec(name: str, columns: list[str], comment: str) -> TableSpec:
    return TableSpec(name, _ddl(columns), comment, tuple(EX.PRIMARY_KEYS.get(name, ())), EX.GOLD.get(name, []))


# Declared schemas of all gold tables.
GOLD_SPECS = {s.name: s for s in [
    *[_gold_spec(f"gold_dim_{n}", [f"{n}_sk", *cols], f"{n.capitalize()} dimension")
      for n, (_, cols) in G.DIMENSIONS.items()],
    _gold_spec("gold_dim_series", ["series_sk", *G.SERIES_COLUMNS], "Series dimension"),
    _gold_spec("gold_dim_nation", ["nation_sk", "nation_id", "name"], "Nation dimension"),
    _gold_spec("gold_fact_productivity", G.FACT_PRODUCTIVITY_COLUMNS, "Observations with their surrogate keys"),
    _gold_spec("gold_fact_population",
               ["nation_sk", "year", "population", "previous_population", "population_change", "population_pct_change"],
               "Population per nation and year with year-over-year change"),
]}


def _silver_spec(name: str, columns: list[str], comment: str) -> TableSpec:
    return TableSpec(name, _ddl(columns), comment, (), EX.SILVER.get(name, []))


# Declared schemas of all silver tables.
SILVER_SPECS = {s.name: s for s in [
    *[_silver_spec(f"slv_pr_{n}", cols, f"{n.capitalize()} codes, texts trimmed") for n, (_, cols) in G.DIMENSIONS.items()],
    _silver_spec("slv_pr_series", [*S.SERIES_CODE_COLUMNS, "sector_name_desc", "class_desc", "measure_desc", "duration_desc",
                                   "seasonal_desc"], "Series with the parts of their identifier and descriptions"),
    _silver_spec("slv_pr_productivity", S.PRODUCTIVITY_COLUMNS, "Observations, one per series, year and period"),
    _silver_spec("slv_population", ["year", "nation_id", "nation", "population", "load_timestamp"],
                 "Latest population of each nation and year"),
    _silver_spec("slv_population_nation", ["nation_id", "nation", "load_timestamp"], "First name of each nation"),
]}
SPECS = {**SILVER_SPECS, **GOLD_SPECS}


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select the declared columns in declared order, cast to declared types,
    attach the column comments as metadata."""
    cols = []
    for f in spec.schema.fields:
        cols.append(F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*cols)


def _write_watched(df: DataFrame, path: str, name: str, rules: list, mode: str) -> dict[str, int]:
    """One pass: fail rules abort the write in the task that meets a violation,
    all rules are counted.  Raises ``ExpectationFailed``."""
    if not rules:
        df.write.mode(mode).parquet(path)
        return {}
    out, obs = quality.observed(quality.guarded(df, name, rules), name, rules)
    try:
        out.write.mode(mode).parquet(path)
    except Exception as e:
        raise quality.as_expectation_failed(e) from e
    return quality.check(obs, name, rules)


def materialize(spark: SparkSession, df: DataFrame, root: str, spec: TableSpec,
                version: int | None = None) -> dict[str, int]:
    """Write one version of the table; publish it only if every fail rule
    holds.  Returns the rule counts."""
    v = version if version is not None else (max(versions(spark, root), default=0) + 1)
    path = version_path(root, v)
    counts = _write_watched(conform(df, spec), path, spec.name, spec.rules, "overwrite")  # raises: stays unpublished
    _touch(spark, f"{path}/{PUBLISHED}")
    return counts


def write_checked(spark: SparkSession, df: DataFrame, path: str, name: str, rules: list,
                  mode: str = "overwrite") -> dict[str, int]:
    """Write ``df`` beside ``path`` with its rules in the plan; it takes the
    place of what is at ``path`` only if no fail rule was violated (raises
    otherwise, and the earlier rows stay readable).  The earlier rows are moved
    aside, not deleted, until the new ones are in place: ``recover`` finishes a
    swap that was interrupted."""
    recover(spark, path)
    base = path.rstrip("/")
    fs, target = snapshots._fs(spark, base)
    fresh, old = (snapshots._fs(spark, base + end)[1] for end in ("__checked", "__before"))
    counts = _write_watched(df, fresh.toString(), name, rules, mode)
    _touch(spark, f"{base}__checked/{PUBLISHED}")
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"{name}: could not move {path} aside")
    if not fs.rename(fresh, target):
        raise OSError(f"{name}: could not move the checked rows to {path}")
    fs.delete(old, True)
    # What the session has cached of the earlier rows is stale.
    spark.catalog.refreshByPath(base)
    return counts


def recover(spark: SparkSession, path: str) -> None:
    """Finish a swap of ``write_checked`` that was cut off: checked rows that are
    complete move in, else the rows moved aside move back."""
    base = path.rstrip("/")
    fs, target = snapshots._fs(spark, base)
    fresh, old = (snapshots._fs(spark, base + end)[1] for end in ("__checked", "__before"))
    if fs.exists(old):
        if not fs.exists(target):
            fs.rename(fresh if _exists(spark, f"{base}__checked/{PUBLISHED}") else old, target)
        fs.delete(old, True)
    fs.delete(fresh, True)


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """Newest published version."""
    good = [v for v in versions(spark, root)
            if _exists(spark, f"{version_path(root, v)}/{PUBLISHED}")]
    if not good:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(version_path(root, good[-1]))


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = snapshots._fs(spark, path)
    return bool(fs.exists(p))


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = snapshots._fs(spark, path)
    fs.create(p, True).close()
