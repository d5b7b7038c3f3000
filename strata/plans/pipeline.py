"""Wiring: landing -> bronze -> silver -> gold, built lazily.

Every attribute is a DataFrame (or a Dim: DataFrame + checked row count)
built on first use, so a question only plans -- and Catalyst only prunes --
the part of the pipeline it reads.  ``materialize`` writes the tables with
their quality rules enforced.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.keys import kept_keys
from ..operators.lookup import Dim, measured_all
from ..sources.landing import LOAD_DATES, Landing, from_tables
from . import bronze as B
from . import gold as G
from . import population as POP
from . import silver as S


class Pipeline:
    def __init__(self, spark: SparkSession, landing: Landing, load_ts: Column | None = None):
        self.spark = spark
        self.landing = landing
        self.load_ts = load_ts

    @classmethod
    def from_tables(cls, spark: SparkSession, src_dir: str, **kw) -> "Pipeline":
        return cls(spark, from_tables(spark, src_dir), **kw)

    # bronze -----------------------------------------------------------
    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return B.bronze_tables(self.landing, self.load_ts)

    # silver -----------------------------------------------------------
    def silver_dim(self, name: str) -> DataFrame:
        b = self.bronze[f"brz_pr_{name}"]
        return S.silver_period(b) if name == "period" else S.silver_dim(b)

    @cached_property
    def silver_dims(self) -> dict[str, Dim]:
        """All code dimensions, cached and counted together in one job."""
        self.prepare(series=False)
        return self.__dict__["silver_dims"]

    def prepare(self, series: bool = True, nation: bool = False, codes: bool = True) -> None:
        """Size-check (count) the dimensions a question needs in one job:
        the code dimensions, and when asked the gold series and nation
        dimensions (neither depends on the code dimensions)."""
        todo: dict[str, DataFrame] = {}
        if codes and "silver_dims" not in self.__dict__:
            todo.update({n: self.silver_dim(n) for n in G.DIMENSIONS})
        if series and "_series_frame" not in self.__dict__:
            todo["_series"] = G.gold_dim_series_frame(S.series_codes(self.bronze["brz_pr_series"]))
        if nation and "_nation_frame" not in self.__dict__:
            todo["_nation"] = G.gold_dim_nation_frame(self.silver_population_nation)
        if not todo:
            return
        got = measured_all(todo, cache={"_series", "_nation"})
        for key in ("_series", "_nation"):
            if key in got:
                self.__dict__[key + "_frame"] = got.pop(key)
        if got:
            self.__dict__["silver_dims"] = got

    @cached_property
    def silver_series(self) -> DataFrame:
        d = self.silver_dims
        return S.silver_series(self.bronze["brz_pr_series"], d["sector"], d["class"],
                               d["measure"], d["duration"], d["seasonal"])

    @cached_property
    def silver_productivity(self) -> DataFrame:
        return S.silver_productivity(self.bronze["brz_pr_data_0_current"],
                                     self.bronze["brz_pr_data_1_alldata"])

    @cached_property
    def population_changes(self) -> DataFrame:
        return self.landing.population_loads

    @cached_property
    def silver_population(self) -> DataFrame:
        return S.silver_population(self.population_changes, ["load_no"])

    @cached_property
    def silver_population_nation(self) -> DataFrame:
        return S.silver_population_nation(self.population_changes, ["load_no", "nation"])

    # gold -------------------------------------------------------------
    @cached_property
    def gold_dims(self) -> dict[str, Dim]:
        return _LazyDims(lambda n: G.gold_dim(n, self.silver_dims[n]))

    @cached_property
    def gold_dim_series(self) -> Dim:
        self.prepare(series=True)
        return G.gold_dim_series(self.__dict__["_series_frame"])

    @cached_property
    def gold_dim_nation(self) -> Dim:
        self.prepare(series=False, nation=True, codes=False)
        return G.gold_dim_nation(self.__dict__["_nation_frame"])

    @cached_property
    def gold_fact_productivity(self) -> DataFrame:
        return G.gold_fact_productivity(self.silver_productivity, self.gold_dims)

    def fact_productivity(self, columns: list[str]) -> DataFrame:
        """The productivity fact restricted to ``columns`` (all lookups are made)."""
        return G.gold_fact_productivity(self.silver_productivity, self.gold_dims, columns)

    @cached_property
    def gold_fact_population(self) -> DataFrame:
        return G.gold_fact_population(self.silver_population, self.gold_dim_nation)

    # full run -----------------------------------------------------------
    def materialize(self, root: str) -> dict[str, dict[str, int]]:
        """Write every table under ``root/<table>`` layer by layer, counting
        each table's rules during its write (a violated fail rule stops the
        run).  Each layer is then read back from the written files, so later
        layers start from stored tables (lineage cut at every table) and
        surrogate keys are fixed once written.  A later run into the same root
        keeps the keys of all codes it has seen and numbers only new ones."""
        from . import expectations as EX
        from .tables import SPECS, conform, write_checked

        spark = self.spark
        rules = {**EX.BRONZE, **EX.SILVER, **EX.GOLD}
        report: dict[str, dict[str, int]] = {}

        def put(name: str, df: DataFrame) -> DataFrame:
            path = f"{root.rstrip('/')}/{name}"
            if name in SPECS:
                df = conform(df, SPECS[name])
            report[name] = write_checked(spark, df, path, name, rules.get(name, []))
            return spark.read.parquet(path)

        for name in self.bronze.names():
            self.bronze[name] = put(name, self.bronze[name])
        silver_dims = {n: put(f"slv_pr_{n}", self.silver_dim(n)) for n in G.DIMENSIONS}
        self.__dict__["silver_dims"] = measured_all(silver_dims)
        self.__dict__["silver_series"] = put("slv_pr_series", self.silver_series)
        self.__dict__["silver_productivity"] = put("slv_pr_productivity", self.silver_productivity)
        report.update(self.run_population(root))

        def keyed(name: str, dim: Dim, business_key: str) -> Dim:
            kept = kept_keys(spark, dim, [business_key], f"{name}_sk", f"{root.rstrip('/')}/_keys/gold_dim_{name}")
            return kept.part(put(f"gold_dim_{name}", kept.df))

        self.__dict__["gold_dims"] = {n: keyed(n, self.silver_dims[n].select(*cols), key)
                                      for n, (key, cols) in G.DIMENSIONS.items()}
        self.prepare(series=True, nation=True, codes=False)
        self.__dict__["gold_dim_series"] = keyed("series", self.__dict__["_series_frame"], "series_id")
        self.__dict__["gold_dim_nation"] = keyed("nation", self.__dict__["_nation_frame"], "nation_id")
        self.__dict__["gold_fact_productivity"] = put("gold_fact_productivity", self.gold_fact_productivity)
        self.__dict__["gold_fact_population"] = put("gold_fact_population", self.gold_fact_population)
        return report

    def run_population(self, root: str) -> dict[str, dict[str, int]]:
        """Population from its source files: the loads arrive as JSON pages, the
        streams keep the bronze and silver tables under ``root``, and this
        pipeline's gold tables and questions read those.  Returns the counts of
        the rules on the way."""
        POP.land_and_run(self.spark, self.population_changes, LOAD_DATES, f"{root}/_landing/population", root)
        stored = POP.stored_tables(self.spark, root)
        self.__dict__["bronze_population"] = stored[POP.BRONZE]
        self.__dict__["silver_population"] = stored["slv_population"]
        self.__dict__["silver_population_nation"] = stored["slv_population_nation"]
        report: dict[str, dict[str, int]] = {"slv_population": {}, "slv_population_nation": {}}
        for r in POP.rule_report(self.spark, root).collect():       # one row per rule
            report.setdefault(r["table_name"], {})[r["rule"]] = int(r["failed_rows"])
        return report

    def preview(self, name: str) -> DataFrame:
        """A bronze table or a trimmed code dimension, by name."""
        kind, _, dim = name.partition("_pr_")
        return self.bronze[name] if kind == "brz" else self.silver_dim(dim)

    def tables(self) -> dict[str, DataFrame]:
        """Every table by name (building each one on access)."""
        out = {n: self.bronze[n] for n in self.bronze.names()}
        for n in G.DIMENSIONS:
            out[f"slv_pr_{n}"] = self.silver_dims[n].df
        out["slv_pr_series"] = self.silver_series
        out["slv_pr_productivity"] = self.silver_productivity
        out["slv_population"] = self.silver_population
        out["slv_population_nation"] = self.silver_population_nation
        for n in G.DIMENSIONS:
            out[f"gold_dim_{n}"] = self.gold_dims[n].df
        out["gold_dim_series"] = self.gold_dim_series.df
        out["gold_dim_nation"] = self.gold_dim_nation.df
        out["gold_fact_productivity"] = self.gold_fact_productivity
        out["gold_fact_population"] = self.gold_fact_population
        return out


class _LazyDims(dict):
    """dict that builds (and memoises) a dimension on first lookup."""

    def __init__(self, build):
        super().__init__()
        self._build = build

    def __missing__(self, name):
        value = self[name] = self._build(name)
        return value
