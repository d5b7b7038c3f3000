"""Reference-shaped landing data derived from the given tables.

The given tables carry no productivity or population files, so the landing
rows are derived from them by fixed rules; every rule is a plain Spark
expression and the work grows with the tables:

* observations <- lineitem (one row per line item; duplicate keys occur),
  "alldata" holds all of them, "current" the years from 2000 on with a
  revised value (so the source order of de-duplication matters);
* series metadata <- the observations, one row per series id;
* code dimensions <- small tables (supplier, region, part, nation) by fixed
  rules; a few codes are left out on purpose so that lookups meet unknown
  codes;
* population <- orders x customer x nation, counted per nation and year, and
  delivered in three loads: the full table, a revision of the recent years
  with some nation names missing, and a late revision with NULL populations.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

CURRENT_FROM_YEAR = 2000


def _s(c: Column) -> Column:
    return c.cast("string")


# Fixed rules: one observation per line item.  series_id is the 17-character,
# blank-padded code PR + seasonal (S/U) + sector (4) + class (1) + measure (2)
# + duration (1).  Written as SQL expressions: one parsed projection instead
# of dozens of separately built column objects.
OBSERVATION_EXPRS = {
    "series_id": ("rpad('PR' || CASE WHEN l_suppkey % 2 = 0 THEN 'S' ELSE 'U' END"
                  " || lpad(CAST(l_suppkey % 20 * 100 AS STRING), 4, '0')"
                  " || CASE WHEN l_returnflag = 'A' THEN '3' ELSE '6' END"
                  " || lpad(CAST(l_partkey % 5 AS STRING), 2, '0')"
                  " || CAST(l_partkey % 3 + 1 AS STRING), 17, ' ')"),
    "year": "CAST(year(l_shipdate) AS INT)",
    "period": ("CASE WHEN l_linenumber <= 4 THEN 'Q0' || CAST(quarter(l_shipdate) AS STRING)"
               " WHEN l_linenumber = 5 THEN 'M' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0')"
               " WHEN l_linenumber = 6 THEN 'S0' || CASE WHEN month(l_shipdate) <= 6 THEN '1' ELSE '2' END"
               " WHEN l_suppkey % 3 = 0 THEN 'Q05' WHEN l_suppkey % 3 = 1 THEN 'M13' ELSE 'S03' END"),
    "value": "l_quantity",
    "footnote_codes": "CASE WHEN l_returnflag = 'R' THEN 'R' END",
}


def observations(lineitem: DataFrame) -> DataFrame:
    """series_id (17 chars, blank padded), year, period, value, footnote_codes."""
    return lineitem.selectExpr(*[f"{e} AS {name}" for name, e in OBSERVATION_EXPRS.items()])


def data_alldata(lineitem: DataFrame) -> DataFrame:
    return observations(lineitem)


def data_current(lineitem: DataFrame) -> DataFrame:
    obs = observations(lineitem).filter(F.col("year") >= CURRENT_FROM_YEAR)
    return obs.withColumn("value", F.col("value") + 1)


def series(observed: DataFrame) -> DataFrame:
    """One row per series id: first/last year, first/last month observed as
    ``Mnn`` periods, and the footnote if any observation carries one.  Only
    integer aggregates, so the grouping is a hash aggregate."""
    sid = F.col("series_id")
    month = F.when(F.col("period").like("M%"), F.substring("period", 2, 2).cast("int"))
    g = observed.groupBy("series_id").agg(
        F.max((F.col("footnote_codes") == "R").cast("int")).alias("_fn"),
        F.min("year").alias("_y0"), F.max("year").alias("_y1"),
        F.min(month).alias("_m0"), F.max(month).alias("_m1"))
    mm = lambda c: F.concat(F.lit("M"), F.lpad(_s(F.col(c)), 2, "0"))
    return g.select(
        "series_id",
        F.substring(sid, 4, 4).alias("sector_code"),
        F.substring(sid, 8, 1).alias("class_code"),
        F.substring(sid, 9, 2).alias("measure_code"),
        F.substring(sid, 11, 1).alias("duration_code"),
        F.substring(sid, 3, 1).alias("seasonal"),
        F.lit("2017").alias("base_year"),
        F.when(F.col("_fn") == 1, "R").alias("footnote_codes"),
        _s(F.col("_y0")).alias("begin_year"), mm("_m0").alias("begin_period"),
        _s(F.col("_y1")).alias("end_year"), mm("_m1").alias("end_period"))


def sector(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey") % 20
    code = F.lpad(_s(k * 100), 4, "0")
    return supplier.filter(k != 19).select(
        code.alias("sector_code"),
        F.concat(F.lit("  Sector "), code, F.lit("  ")).alias("sector_name"),
        (k % 3).cast("int").alias("display_level"),
        F.when(k == 7, "X").when(k % 2 == 0, "T").otherwise("F").alias("selectable"),
        k.cast("int").alias("sort_sequence")).distinct()


def class_(region: DataFrame) -> DataFrame:
    r = F.col("r_regionkey")
    return region.select(
        _s(r + 2).alias("class_code"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" workers ")).alias("class_text"),
        (r % 2).cast("int").alias("display_level"),
        F.lit("T").alias("selectable"),
        r.cast("int").alias("sort_sequence")).distinct()


def measure(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey") % 5
    code = F.lpad(_s(k), 2, "0")
    return part.filter(k != 4).select(
        code.alias("measure_code"),
        F.concat(F.lit("Measure "), code, F.lit(" ")).alias("measure_text"),
        F.lit(1).cast("int").alias("display_level"),
        F.lit("T").alias("selectable"),
        k.cast("int").alias("sort_sequence")).distinct()


def duration(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey") % 3 + 1
    return part.select(
        _s(k).alias("duration_code"),
        F.concat(F.lit(" Duration "), _s(k)).alias("duration_text"),
        F.lit(0).cast("int").alias("display_level"),
        F.when(k == 3, "F").otherwise("T").alias("selectable"),
        k.cast("int").alias("sort_sequence")).distinct()


def seasonal(region: DataFrame) -> DataFrame:
    even = F.col("r_regionkey") % 2 == 0
    return region.select(
        F.when(even, "S").otherwise("U").alias("seasonal_code"),
        F.when(even, " Seasonally Adjusted ").otherwise(" Not Seasonally Adjusted ").alias("seasonal_text"),
    ).distinct()


# Footnote letters by region key (0..4).
FOOTNOTE_LETTERS = "ANRPC"


def footnote(region: DataFrame) -> DataFrame:
    code = F.substring(F.lit(FOOTNOTE_LETTERS), F.col("r_regionkey").cast("int") + 1, 1)
    return region.select(code.alias("footnote_code"),
                         F.concat(F.lit(" Footnote "), code, F.lit(" ")).alias("footnote_text"))


def period(nation: DataFrame) -> DataFrame:
    """Period codes by rule from the nation keys 0..20: Q01-Q05, M01-M13,
    S01-S03 (S02 left out)."""
    n = F.col("n_nationkey").cast("int")
    p = (F.when(n < 5, F.concat(F.lit("Q0"), _s(n + 1)))
         .when(n < 18, F.concat(F.lit("M"), F.lpad(_s(n - 4), 2, "0")))
         .when(n < 21, F.concat(F.lit("S0"), _s(n - 17))))
    kind = (F.when(p.like("Q%"), "Quarter ").when(p.like("M%"), "Month ").otherwise("Half "))
    return nation.select(p.alias("period"), kind.alias("_kind")).filter(
        F.col("period").isNotNull() & (F.col("period") != "S02")).select(
        "period",
        F.concat(F.col("period"), F.lit(" ")).alias("period_abbr"),
        F.concat(F.lit("  "), F.col("_kind"), F.substring("period", 2, 2), F.lit(" ")).alias("period_name"))


def population(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """nation_id, nation, year, population (one row per nation and year)."""
    j = (orders.select("o_custkey", "o_orderdate")
         .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")))
    return j.groupBy(
        F.concat(F.lpad(_s(F.col("n_nationkey")), 5, "0"), F.lit("US")).alias("nation_id"),
        F.col("n_name").alias("nation"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("n_nationkey").alias("nation_key"),
    ).agg((F.count(F.lit(1)) * 1000).cast("bigint").alias("population"))


# Days on which the three loads arrive.
LOAD_DATES = ("2024-01-01", "2024-01-02", "2024-01-03")


def population_loads(pop: DataFrame) -> DataFrame:
    """Change feed of three loads: load_no, nation_id, nation, year, population."""
    k, y = F.col("nation_key"), F.col("year")
    first = pop.select(F.lit(1).alias("load_no"), "nation_id", "nation", "year", "population")
    second = pop.filter(y >= 2000).select(
        F.lit(2).alias("load_no"), "nation_id",
        F.when(k % 5 != 0, F.col("nation")).alias("nation"), "year",
        (F.col("population") + 500).alias("population"))
    third = pop.filter((y == 2001) & (k % 2 == 0)).select(
        F.lit(3).alias("load_no"), "nation_id",
        F.concat(F.col("nation"), F.lit(" (revised)")).alias("nation"), "year",
        F.lit(None).cast("bigint").alias("population"))
    return first.unionByName(second).unionByName(third)


def landing_population_loads(spark: SparkSession, src_dir: str) -> DataFrame:
    t = lambda name: read_table(spark, src_dir, name)
    return population_loads(population(t("orders"), t("customer"), t("nation")))


class Landing:
    """The raw landing tables of both sources, before any audit column.

    Each table is built on first access, so a question plans (and reads)
    only the sources it needs."""

    NAMES = ("data_current", "data_alldata", "series", "sector", "class_", "measure",
             "duration", "footnote", "period", "seasonal", "population_loads")

    def tsv_tables(self) -> dict[str, DataFrame]:
        return {"class": self.class_, "duration": self.duration, "measure": self.measure,
                "sector": self.sector, "footnote": self.footnote, "period": self.period,
                "seasonal": self.seasonal, "series": self.series,
                "data_0_current": self.data_current, "data_1_alldata": self.data_alldata}


class TableLanding(Landing):
    """Landing rows derived from the given tables (see the module docstring)."""

    def __init__(self, spark: SparkSession, src_dir: str):
        self.spark, self.src_dir = spark, src_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.src_dir, name)
        return self._tables[name]

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def data_alldata(self) -> DataFrame:
        return data_alldata(self.lineitem)

    @cached_property
    def data_current(self) -> DataFrame:
        return data_current(self.lineitem)

    @cached_property
    def series(self) -> DataFrame:
        return series(self.data_alldata)

    @cached_property
    def sector(self) -> DataFrame:
        return sector(self.table("supplier"))

    @cached_property
    def class_(self) -> DataFrame:
        return class_(self.table("region"))

    @cached_property
    def measure(self) -> DataFrame:
        return measure(self.table("part"))

    @cached_property
    def duration(self) -> DataFrame:
        return duration(self.table("part"))

    @cached_property
    def footnote(self) -> DataFrame:
        return footnote(self.table("region"))

    @cached_property
    def period(self) -> DataFrame:
        return period(self.table("nation"))

    @cached_property
    def seasonal(self) -> DataFrame:
        return seasonal(self.table("region"))

    @cached_property
    def population_loads(self) -> DataFrame:
        return population_loads(population(self.table("orders"), self.table("customer"),
                                           self.table("nation")))


def from_tables(spark: SparkSession, src_dir: str) -> Landing:
    return TableLanding(spark, src_dir)


class TsvLanding(Landing):
    """Landing rows read back from tab-separated files (one directory per
    file name, as ``land_tsv`` writes them); population loads, which arrive
    as JSON pages, come from ``population`` when given."""

    def __init__(self, spark: SparkSession, root: str, population: Landing | None = None):
        from .tsv import LANDING_DDL, read_tsv
        self.spark, self.root, self._population = spark, root.rstrip("/"), population
        self._ddl, self._read = LANDING_DDL, read_tsv
        self._cache: dict[str, DataFrame] = {}

    def _file(self, key: str) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = self._read(self.spark, f"{self.root}/{key}", self._ddl[key])
        return self._cache[key]

    data_current = property(lambda self: self._file("data_0_current"))
    data_alldata = property(lambda self: self._file("data_1_alldata"))
    series = property(lambda self: self._file("series"))
    sector = property(lambda self: self._file("sector"))
    class_ = property(lambda self: self._file("class"))
    measure = property(lambda self: self._file("measure"))
    duration = property(lambda self: self._file("duration"))
    footnote = property(lambda self: self._file("footnote"))
    period = property(lambda self: self._file("period"))
    seasonal = property(lambda self: self._file("seasonal"))

    @property
    def population_loads(self) -> DataFrame:
        if self._population is None:
            raise AttributeError("population loads are not part of the TSV landing")
        return self._population.population_loads


def land_tsv(landing: Landing, root: str) -> None:
    """Write every landing table as a padded TSV directory under ``root``."""
    from .tsv import write_tsv
    for key, df in landing.tsv_tables().items():
        write_tsv(df, f"{root.rstrip('/')}/{key}")


# --- damaged files ---------------------------------------------------------------
# Fixed rules: a line of an order in one class of 101 breaks off after the period, one
# of another class carries a field more, and the year of a third holds a letter.
BREAKS = {"short": 5, "long": 17, "unparsable": 29}


def land_damaged_tsv(lineitem: DataFrame, path: str) -> None:
    """The observations as lines of text with a header, some of them damaged."""
    names = ["series_id", "year", "period", "value", "footnote_codes"]
    rows = lineitem.selectExpr("l_orderkey % 101 AS _class", *[f"{OBSERVATION_EXPRS[n]} AS {n}" for n in names])
    year = F.when(F.col("_class") == BREAKS["unparsable"], F.concat(F.substring(_s(F.col("year")), 1, 3), F.lit("X"))) \
            .otherwise(_s(F.col("year")))
    head = F.concat_ws("\t", "series_id", year, "period")
    rest = F.concat_ws("\t", F.coalesce(_s(F.col("value")), F.lit("")), F.coalesce("footnote_codes", F.lit("")))
    line = (F.when(F.col("_class") == BREAKS["short"], head)
            .when(F.col("_class") == BREAKS["long"], F.concat_ws("\t", head, rest, F.lit("more")))
            .otherwise(F.concat_ws("\t", head, rest)))
    # The one column's name is the header of every file; nothing is quoted or trimmed.
    (rows.select(line.alias("\t".join(names))).write.option("header", "true").option("sep", "\x01").option("quote", "")
     .option("escapeQuotes", "false").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def land_damaged_pages(loads: DataFrame, root: str) -> None:
    """One JSON document per load and nation: those of the second load hold a
    field that no schema knows, those of the third are cut off."""
    rec = F.struct(F.col("nation_id").alias("Nation ID"), F.col("nation").alias("Nation"),
                   _s(F.col("year")).alias("Year"), F.col("population").cast("double").alias("Population"))
    pages = loads.groupBy("load_no", "nation_id").agg(F.sort_array(F.collect_list(rec)).alias("data"))    # a record a year
    note = F.when(F.col("load_no") == 2, F.struct(F.col("nation_id").alias("id"), F.lit(2).alias("rev")))
    doc = F.when(F.col("load_no") == 3, F.expr("substring(doc, 1, length(doc) - 4)")).otherwise(F.col("doc"))
    (pages.select("load_no", "nation_id", F.to_json(F.struct("data", "load_no", note.alias("note"))).alias("doc"))
     .select("load_no", "nation_id", doc.alias("value")).repartition("load_no", "nation_id")
     .write.partitionBy("load_no", "nation_id").text(root))
