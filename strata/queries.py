"""Named queries over the given tables: one per operator family.

Each query takes ``(spark, src_dir)``, derives the reference-shaped landing
data from the given tables, runs the pipeline stage it exercises, and returns
a DataFrame.  Computed doubles are rounded to 6 decimals where another engine
is compared against them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codes
from .functions.names import clean_column_names, clean_column_names_nested
from .operators import quality
from .operators.cdc import scd1
from .operators.keys import assign_surrogate_keys, extend_surrogate_keys
from .operators.lookup import measured
from .plans import expectations as EX
from .plans import population as POP
from .plans import questions as Q
from .plans import silver as S
from .plans import tables as T
from .plans.gold import DIMENSIONS
from .plans.pipeline import Pipeline
from .session import scratch_path
from .sources import json_pages, landing as L, tsv
from .sources.links import page_links as extract_page_links
from .sources.tables import read_table
from .sources.tsv import LANDING_DDL, header_report, read_tsv, write_tsv
from .streaming import jobs, snapshots

# Fixed parameters of the questions on the derived data.
Q1_YEARS = (1996, 1999)
Q3_SERIES = "PRS00006032"
Q3_PERIOD = "Q01"
POINT = ("PRS00006011", 1995, "Q01")

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


def _p(spark, src) -> Pipeline:
    return Pipeline.from_tables(spark, src)


def _r6(c):
    return F.round(c, 6)


# --- sources -------------------------------------------------------------

@query
def tsv_scan(spark, src):
    """Land the all-data file as padded TSV, read it back with its DDL."""
    root = scratch_path(spark, "tsv")
    write_tsv(L.data_alldata(read_table(spark, src, "lineitem")), root)
    return read_tsv(spark, root, LANDING_DDL["data_1_alldata"])


def _land_and_stream(spark, src, job, name):
    """Land the three population loads one by one, running ``job`` (an
    available-now streaming run over everything landed so far) after each."""
    root = scratch_path(spark, f"{name}-pages")
    loads = L.landing_population_loads(spark, src).cache()
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    for i, day in enumerate(L.LOAD_DATES, start=1):
        json_pages.write_population_pages(loads, root, i, day)
        job(json_pages.with_file_audit(json_pages.stream_pages(spark, root)), out, ckpt)
    loads.unpersist()
    return out


@query
def json_stream_ingest(spark, src):
    out = _land_and_stream(spark, src, jobs.ingest_bronze, "ingest")
    bronze = spark.read.parquet(out)
    rec = S.population_records(bronze, keep=["load_no", "load_timestamp", "file_arrival_timestamp"])
    return rec.select("load_no", "nation_id", "nation", "year", "population",
                      (F.col("load_timestamp").isNotNull()
                       & F.col("file_arrival_timestamp").isNotNull()).alias("audited"))


@query
def json_explode(spark, src):
    root = scratch_path(spark, "pages")
    loads = L.landing_population_loads(spark, src).cache()
    for i, day in enumerate(L.LOAD_DATES, start=1):
        json_pages.write_population_pages(loads, root, i, day)
    loads.unpersist()
    rec = S.population_records(json_pages.read_pages(spark, root), keep=["load_no"])
    return rec.select("load_no", "nation", "nation_id", "population", "year")


@query
def page_links(spark, src):
    return extract_page_links(read_table(spark, src, "pages"), keep=["page_id"])


@query
def tsv_damaged(spark, src):
    """All observations from files with short, long and unparsable lines (by
    fixed rules over the given rows): every readable field, and the damage."""
    root = scratch_path(spark, "tsv-damaged")
    L.land_damaged_tsv(read_table(spark, src, "lineitem"), root)
    rows = read_tsv(spark, root, LANDING_DDL["data_1_alldata"], corrupt=True, strict_header=True)
    return rows.select("series_id", "year", "period", "value", "footnote_codes",
                       F.col(tsv.CORRUPT).isNotNull().alias("damaged"))


@query
def tsv_damage_rules(spark, src):
    """The rules of damaged files counted over the same landing: lines and headers."""
    root, ddl = scratch_path(spark, "tsv-damage-rules"), LANDING_DDL["data_1_alldata"]
    L.land_damaged_tsv(read_table(spark, src, "lineitem"), root)
    found = quality.quality_report({"lines": (read_tsv(spark, root, ddl, corrupt=True), tsv.DAMAGE_RULES + EX.BRONZE["brz_pr_data_1_alldata"]),
                                    "headers": (header_report(spark, root, ddl), tsv.HEADER_RULES)})
    # The number of files follows the cluster; whether all are as declared does not.
    return found.select("table_name", "rule", "failed_rows", F.when(F.col("table_name") == "lines", F.col("total_rows")).alias("total_rows"))


@query
def json_rescued(spark, src):
    """Population pages with an unknown field and cut-off documents, nothing of
    them lost."""
    root = scratch_path(spark, "pages-damaged")
    L.land_damaged_pages(L.landing_population_loads(spark, src), root)
    pages = json_pages.read_rescued(spark, root)
    records = F.from_json("data", S.POPULATION_RECORD)
    return pages.select("load_no", F.size(F.coalesce(records, F.array())).alias("records"), json_pages.RESCUED,
                        F.col(json_pages.CORRUPT).isNotNull().alias("damaged"))


# --- projections -----------------------------------------------------------

@query
def clean_names_flat(spark, src):
    c = read_table(spark, src, "customer")
    messy = c.select(F.col("c_custkey").alias("Customer Key"),
                     F.col("c_name").alias(" Customer Name"),
                     F.col("c_nationkey").alias(" Nation  Key"),
                     F.col("c_acctbal").alias("\tAccount\tBalance "),
                     F.col("c_mktsegment").alias("Market Segment_"))
    return clean_column_names(messy)


@query
def clean_names_nested(spark, src):
    o = read_table(spark, src, "orders")
    messy = o.select(
        F.col("o_orderkey").alias("Order Key"),
        F.struct(F.col("o_custkey").alias("Customer Key"),
                 F.col("o_orderstatus").alias("Order\tStatus")).alias("Order Info"),
        F.array(F.struct(F.col("o_totalprice").alias("Total Price"),
                         F.col("o_orderpriority").alias(" Priority "))).alias("Line Items"),
        F.create_map(F.col("o_orderstatus"),
                     F.struct(F.col("o_totalprice").alias("Map Price"))).alias("By Status"))
    clean = clean_column_names_nested(messy)
    first = F.element_at("line_items", 1)
    return clean.select(
        "order_key",
        F.col("order_info.customer_key").alias("order_info_customer_key"),
        F.col("order_info.orderstatus").alias("order_info_orderstatus"),
        first["total_price"].alias("line_items_total_price"),
        first["priority"].alias("line_items_priority"),
        F.map_values("by_status")[0]["map_price"].alias("by_status_map_price"))


@query
def silver_dim_trim(spark, src):
    return _p(spark, src).silver_dim("sector")


@query
def period_dim(spark, src):
    return _p(spark, src).silver_dim("period")


@query
def silver_observations(spark, src):
    return _p(spark, src).silver_productivity.drop("load_timestamp")


@query
def period_end_date(spark, src):
    obs = L.data_alldata(read_table(spark, src, "lineitem")).select("year", "period").distinct()
    return obs.select("year", "period", codes.period_num("period").alias("period_num"),
                      *[c.alias(n) for n, c in codes.observation_columns("year", "period").items()])


# --- set operations / de-duplication -----------------------------------

@query
def union_by_name(spark, src):
    li = read_table(spark, src, "lineitem")
    cur = L.data_current(li).select("value", "period", "footnote_codes", "year", "series_id",
                                    F.lit(1).alias("revision"))
    alld = L.data_alldata(li).drop("footnote_codes")
    return cur.unionByName(alld, allowMissingColumns=True)


@query
def dedup_latest(spark, src):
    li = read_table(spark, src, "lineitem")
    return S.combined_observations(L.data_current(li), L.data_alldata(li))


@query
def dedup_stream(spark, src):
    """First row of each nation by load, file and position in it."""
    def job(stream, out, ckpt):
        rec = S.population_records(stream, keep=["load_timestamp", "file_arrival_timestamp", "file_path"])
        jobs.upsert_first_seen(rec, ["nation_id"], POP.SEQUENCE, ["nation"], out, ckpt)
    out = _land_and_stream(spark, src, job, "dedup")
    return snapshots.read_table(spark, out).select("nation_id", "nation")


# --- keyed upserts -----------------------------------------------------------

def _event_changes(spark, src):
    e = read_table(spark, src, "events")
    return e.select("user_id", "ts", "event_id", "event_type",
                    F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
                    F.from_json("props", "k INT")["k"].alias("k"))


@query
def scd1_ignore_null(spark, src):
    return scd1(_event_changes(spark, src), ["user_id"], ["ts", "event_id"],
                ignore_null_updates=True, columns=["event_type", "value", "k"])


@query
def scd1_overwrite(spark, src):
    return scd1(_event_changes(spark, src), ["user_id"], ["ts", "event_id"],
                ignore_null_updates=False, columns=["event_type", "value", "k"])


@query
def silver_population(spark, src):
    return _p(spark, src).silver_population


@query
def silver_population_nation(spark, src):
    return _p(spark, src).silver_population_nation


@query
def scd1_stream(spark, src):
    """JSON pages -> bronze table (stream 1); bronze table -> keyed upsert
    into the bucketed silver table (stream 2, reading the bronze table as a
    stream).  Three loads, each picked up by an available-now run."""
    def job(stream, out, ckpt):
        bronze = f"{ckpt}/bronze-table"
        jobs.ingest_bronze(stream, bronze, f"{ckpt}/bronze")
        from_bronze = spark.readStream.schema(POP.BRONZE_SCHEMA).parquet(bronze)
        rec = S.population_records(from_bronze, keep=["load_timestamp", "file_arrival_timestamp", "file_path"])
        jobs.upsert_scd1(rec, ["year", "nation_id"],
                         ["load_timestamp", "file_arrival_timestamp", "file_path", "record_pos"],
                         ["nation", "population"], out, f"{ckpt}/silver", ignore_null_updates=True)
    out = _land_and_stream(spark, src, job, "scd1")
    return snapshots.read_table(spark, out).select("nation", "nation_id", "population", "year")


# --- dimensional model -------------------------------------------------------

@query
def surrogate_key(spark, src):
    """Series keys through the range-partitioned (multi-task) numbering."""
    p = _p(spark, src)
    ids = S.series_codes(p.bronze["brz_pr_series"]).select(F.trim("series_id").alias("series_id"))
    return assign_surrogate_keys(measured(ids), ["series_id"], "series_sk", rows_per_range=1000).df


@query
def surrogate_key_incremental(spark, src):
    li = read_table(spark, src, "lineitem")
    obs = L.data_alldata(li)
    old = obs.filter(F.col("year") <= 1999).select(F.trim("series_id").alias("series_id")).distinct()
    existing = assign_surrogate_keys(measured(old), ["series_id"], "series_sk").df
    incoming = obs.select(F.trim("series_id").alias("series_id")).distinct()
    return extend_surrogate_keys(existing, incoming, ["series_id"], "series_sk")


def _gold_dim_query(name):
    def fn(spark, src):
        return _p(spark, src).gold_dims[name].df
    fn.__name__ = f"gold_dim_{name}"
    return query(fn)


for _n in ("class", "duration", "footnote", "measure", "period", "seasonal", "sector"):
    _gold_dim_query(_n)


@query
def gold_dim_series(spark, src):
    return _p(spark, src).gold_dim_series.df


@query
def gold_dim_nation(spark, src):
    return _p(spark, src).gold_dim_nation.df


@query
def silver_series(spark, src):
    return _p(spark, src).silver_series


@query
def fact_star_left(spark, src):
    return _p(spark, src).gold_fact_productivity


@query
def fact_population(spark, src):
    f = _p(spark, src).gold_fact_population
    return f.withColumn("population_pct_change", _r6(F.col("population_pct_change")))


# --- questions ---------------------------------------------------------------

@query
def q1_mean_stddev(spark, src):
    r = Q.q1_mean_stddev(_p(spark, src).gold_fact_population, *Q1_YEARS)
    return r.select(_r6(F.col("mean_population")).alias("mean_population"),
                    _r6(F.col("stddev_population")).alias("stddev_population"))


@query
def year_sum(spark, src):
    p = _p(spark, src)
    return Q.year_sums(p.fact_productivity(Q.FACT_COLUMNS), p.gold_dims["period"])


@query
def q2_best_year(spark, src):
    p = _p(spark, src)
    p.prepare(series=True)
    d = p.gold_dims
    return Q.q2_best_year(p.fact_productivity(Q.FACT_COLUMNS), d["period"], p.gold_dim_series, d["class"],
                          d["measure"], d["duration"], d["sector"])


@query
def q2_best_year_sql(spark, src):
    p = _p(spark, src)
    p.prepare(series=True)
    views = {n: p.gold_dims[n].df for n in ("period", "class", "sector", "duration", "measure")}
    views = {f"gold_dim_{n}": v for n, v in views.items()}
    views["gold_dim_series"] = p.gold_dim_series.df
    views["gold_fact_productivity"] = p.fact_productivity(Q.FACT_COLUMNS)
    return Q.run_sql(spark, views, Q.Q2_SQL)


@query
def q1_mean_stddev_sql(spark, src):
    p = _p(spark, src)
    r = Q.run_sql(spark, {"gold_fact_population": p.gold_fact_population},
                  Q.Q1_SQL.format(first_year=Q1_YEARS[0], last_year=Q1_YEARS[1]))
    return r.select(_r6(F.col("mean_population")).alias("mean_population"),
                    _r6(F.col("stddev_population")).alias("stddev_population"))


@query
def q3_series_population_sql(spark, src):
    p = _p(spark, src)
    p.prepare(series=False, nation=True)
    views = {"gold_fact_productivity": p.fact_productivity(Q.FACT_COLUMNS),
             "gold_dim_period": p.gold_dims["period"].df,
             "gold_fact_population": p.gold_fact_population}
    return Q.run_sql(spark, views, Q.Q3_SQL.format(series_id=Q3_SERIES, period=Q3_PERIOD))


@query
def tsv_pipeline_best_year(spark, src):
    """The whole productivity lifecycle from files: all ten landing files are
    written as padded TSV, read back with their DDL, and refined to the
    best-year question."""
    root = scratch_path(spark, "tsv-landing")
    L.land_tsv(L.from_tables(spark, src), root)
    p = Pipeline(spark, L.TsvLanding(spark, root))
    p.prepare(series=True)
    d = p.gold_dims
    return Q.q2_best_year(p.fact_productivity(Q.FACT_COLUMNS), d["period"], p.gold_dim_series,
                          d["class"], d["measure"], d["duration"], d["sector"])


@query
def materialized_dim_sector(spark, src):
    """Gold sector dimension written through its declared schema (column
    comments) with its rules enforced, then read back."""
    root = scratch_path(spark, "gold_dim_sector")
    spec = T.GOLD_SPECS["gold_dim_sector"]
    T.materialize(spark, _p(spark, src).gold_dims["sector"].df, root, spec)
    return T.read_published(spark, root)


@query
def materialized_fact_population(spark, src):
    root = scratch_path(spark, "gold_fact_population")
    spec = T.GOLD_SPECS["gold_fact_population"]
    T.materialize(spark, _p(spark, src).gold_fact_population, root, spec)
    f = T.read_published(spark, root)
    return f.withColumn("population_pct_change", _r6(F.col("population_pct_change")))


def _materialized(name: str, frame) -> None:
    """Register ``materialized_<table>``: a gold table written through its
    declared schema with its rules enforced, then read back."""
    def run(spark, src):
        root = scratch_path(spark, f"gold_{name}")
        T.materialize(spark, frame(_p(spark, src)), root, T.GOLD_SPECS[f"gold_{name}"])
        return T.read_published(spark, root)
    REGISTRY[f"materialized_{name}"] = run


for _n in ("class", "duration", "measure", "footnote", "seasonal", "period"):
    _materialized(f"dim_{_n}", lambda p, n=_n: p.gold_dims[n].df)
_materialized("dim_series", lambda p: p.gold_dim_series.df)
_materialized("dim_nation", lambda p: p.gold_dim_nation.df)
_materialized("fact_productivity", lambda p: p.gold_fact_productivity)


@query
def pipeline_run_best_year(spark, src):
    """Full pipeline run: every bronze, silver and gold table written with
    its rules enforced, then the best-year question over the stored tables."""
    p = _p(spark, src)
    p.materialize(scratch_path(spark, "pipeline"))
    d = p.gold_dims
    return Q.q2_best_year(p.gold_fact_productivity, d["period"], p.gold_dim_series, d["class"],
                          d["measure"], d["duration"], d["sector"])


def _population_from_pages(spark, src, name) -> Pipeline:
    """Population all the way from JSON pages: bronze stream, silver upserts."""
    p = _p(spark, src)
    p.run_population(scratch_path(spark, f"population-{name}"))
    return p


@query
def population_pipeline_q1(spark, src):
    """Q1 on the fact and dimension built over the streams' tables."""
    r = Q.q1_mean_stddev(_population_from_pages(spark, src, "q1").gold_fact_population, *Q1_YEARS)
    return r.select(_r6(F.col("mean_population")).alias("mean_population"),
                    _r6(F.col("stddev_population")).alias("stddev_population"))


@query
def population_pipeline_q3(spark, src):
    p = _population_from_pages(spark, src, "q3")
    return Q.q3_series_population(p.fact_productivity(Q.FACT_COLUMNS), p.gold_dims["period"],
                                  p.gold_fact_population, Q3_SERIES, Q3_PERIOD)


@query
def population_rules(spark, src):
    """Rules of the bronze population table and of the views behind it."""
    root = scratch_path(spark, "population-rules")
    _p(spark, src).run_population(root)
    return POP.rule_report(spark, root)


@query
def stream_rule_counts(spark, src):
    """What the rules inside the streams have counted, micro-batch by
    micro-batch (one batch a load and stream)."""
    root = scratch_path(spark, "stream-rules")
    _p(spark, src).run_population(root)
    return jobs.rule_counts(spark, f"{root}/_rules")


@query
def population_refresh(spark, src):
    """The population fact brought up to date after each load: only the nations
    that the load has changed are recomputed."""
    root, pages = scratch_path(spark, "refresh"), scratch_path(spark, "refresh-pages")
    loads = L.landing_population_loads(spark, src).cache()
    for i, day in enumerate(L.LOAD_DATES, start=1):
        json_pages.write_population_pages(loads, pages, i, day)
        POP.run_streams(spark, pages, root)
        POP.refresh_fact(spark, root)
    loads.unpersist()
    return POP.stored_fact(spark, root).withColumn("population_pct_change", _r6(F.col("population_pct_change")))


@query
def q3_series_population(spark, src):
    p = _p(spark, src)
    p.prepare(series=False, nation=True)
    return Q.q3_series_population(p.fact_productivity(Q.FACT_COLUMNS), p.gold_dims["period"],
                                  p.gold_fact_population, Q3_SERIES, Q3_PERIOD)


@query
def point_lookup(spark, src):
    sid, year, period = POINT
    return (_p(spark, src).silver_productivity.drop("load_timestamp")
            .filter((F.col("series_id") == sid) & (F.col("year") == year) & (F.col("period") == period)))


@query
def table_preview(spark, src):
    return _p(spark, src).bronze["brz_pr_series"].drop("load_timestamp")


def _preview_query(table):
    def fn(spark, src):
        df = _p(spark, src).preview(table)
        return df.drop("load_timestamp")
    fn.__name__ = f"preview_{table}"
    return query(fn)


# Tables that no other query returns whole.
PREVIEWS = ([f"brz_pr_{n}" for n in (*DIMENSIONS, "data_0_current", "data_1_alldata")]
            + [f"slv_pr_{n}" for n in ("class", "duration", "footnote", "measure", "seasonal")])
for _n in PREVIEWS:
    _preview_query(_n)


@query
def first_row(spark, src):
    f = _p(spark, src).gold_fact_population
    return (f.orderBy(F.col("year").desc(), F.col("nation_sk").asc()).limit(1)
            .withColumn("population_pct_change", _r6(F.col("population_pct_change"))))


# --- quality -----------------------------------------------------------------

@query
def dq_report(spark, src):
    """Every declared rule of every table (those of the population streams:
    ``population_rules``)."""
    p = _p(spark, src)
    p.prepare(series=True, nation=True)
    rules = {**EX.BRONZE, **EX.SILVER, **EX.GOLD}
    rules["gold_fact_population"] = rules["gold_fact_population"] + EX.POPULATION_VALUE_RULES
    return quality.quality_report({n: (df, rules[n]) for n, df in p.tables().items() if n in rules})


@query
def key_uniqueness(spark, src):
    """Declared primary keys and the dimensions' business keys."""
    p = _p(spark, src)
    p.prepare(series=True, nation=True)
    tables = {**{f"gold_dim_{n}": p.gold_dims[n].df for n in DIMENSIONS}, "gold_dim_series": p.gold_dim_series.df,
              "gold_dim_nation": p.gold_dim_nation.df, "gold_fact_population": p.gold_fact_population}
    return reduce(DataFrame.unionByName, [
        quality.keys_uniqueness(df, name, [k[name] for k in (EX.PRIMARY_KEYS, EX.BUSINESS_KEYS) if name in k])
        for name, df in tables.items()])


@query
def orphan_keys(spark, src):
    p = _p(spark, src)
    p.prepare(series=False, nation=True)
    names = ("class", "duration", "footnote", "measure", "period", "sector")
    fact = p.fact_productivity([f"{n}_sk" for n in names])
    found = quality.orphan_keys_all(fact, {f"{n}_sk": p.gold_dims[n].df.select(f"{n}_sk") for n in names})
    return found.unionByName(quality.orphan_keys_all(
        p.gold_fact_population, {"nation_sk": p.gold_dim_nation.df.select("nation_sk")}))
