"""Population from its source files: dated JSON pages -> bronze stream ->
keyed upserts, the way a scheduled run does it.

``land_and_run`` lands the loads one after another and runs the streams after
each, so that a later load meets the stored state of the earlier ones.
``run_streams`` is one such run over whatever pages have arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.keys import kept_keys
from ..operators.lookup import Dim, measured
from ..sources import json_pages
from ..streaming import jobs, snapshots
from . import expectations as EX
from . import gold as G
from . import silver as S

BRONZE, NATION_VIEW, POPULATION_VIEW = ("brz_population_data", "population_nation_data_transformed",
                                        "population_data_transformed")
# Bronze population table as written by the ingest stream.
BRONZE_SCHEMA = ("data STRING, load_no INT, load_timestamp TIMESTAMP, "
                 "file_arrival_timestamp TIMESTAMP, file_path STRING")
# Order of two changes of one key.
SEQUENCE = ["load_timestamp", "file_arrival_timestamp", "file_path", "record_pos"]


def _records(bronze: DataFrame) -> DataFrame:
    return S.population_records(bronze, keep=["load_timestamp", "file_arrival_timestamp", "file_path"])


def run_streams(spark: SparkSession, pages: str, root: str, rules: dict[str, list] | None = None,
                max_files: int | None = None, archive: str | None = None) -> None:
    """Ingest the pages that are new, then bring both silver tables up to date
    from the bronze table, read as a stream.  The rules of the bronze table and
    of the views between it and silver are part of the micro-batches; counts by
    batch are kept under ``root``.  ``max_files`` bounds a micro-batch, and
    ``archive`` is where ingested pages go (see ``json_pages.stream_pages``)."""
    rules = {**EX.BRONZE, **EX.SILVER, **(rules or {})}
    checkpoints = f"{root}/_checkpoints"

    def of(table: str) -> jobs.BatchRules:
        return jobs.BatchRules(table, rules[table], f"{root}/_rules")

    source = json_pages.stream_pages(spark, pages, max_files_per_trigger=max_files, archive=archive)
    jobs.ingest_bronze(json_pages.with_file_audit(source), f"{root}/{BRONZE}", f"{checkpoints}/{BRONZE}", of(BRONZE))
    stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{root}/{BRONZE}")
    jobs.upsert_scd1(_records(stream), ["year", "nation_id"], SEQUENCE, ["nation", "population", "load_timestamp"],
                     f"{root}/slv_population", f"{checkpoints}/slv_population", bucket_by=["nation_id"],
                     rules=of(POPULATION_VIEW), touched=lambda s, buckets, batch: _note(s, root, buckets, batch))
    jobs.upsert_first_seen(_records(stream), ["nation_id"], SEQUENCE, ["nation", "load_timestamp"],
                           f"{root}/slv_population_nation", f"{checkpoints}/slv_population_nation", rules=of(NATION_VIEW))


def land_and_run(spark: SparkSession, loads: DataFrame, dates: list[str], pages: str, root: str) -> None:
    """One run per load: load number i arrives on ``dates[i - 1]``."""
    loads = loads.cache()
    for i, day in enumerate(dates, start=1):
        json_pages.write_population_pages(loads, pages, i, day)
        run_streams(spark, pages, root)
    loads.unpersist()


def stored_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The bronze and silver tables that the streams keep under ``root``, the
    silver ones in their declared schemas."""
    from .tables import SILVER_SPECS, conform
    return {BRONZE: spark.read.schema(BRONZE_SCHEMA).parquet(f"{root}/{BRONZE}"),
            **{n: conform(snapshots.read_table(spark, f"{root}/{n}"), SILVER_SPECS[n])
               for n in ("slv_population", "slv_population_nation")}}


# --- the fact, refreshed by change -------------------------------------------------

FACT = "gold_fact_population_by_nation"
LOST = -1                  # bucket of the rows whose nation is in no dimension row


def _note(spark: SparkSession, root: str, buckets: list[int], batch_id: int) -> None:
    """Remember the silver buckets that a batch has rewritten until the fact has
    been refreshed from them."""
    if buckets:
        spark.createDataFrame([(b,) for b in buckets], "bucket INT").coalesce(1).write.mode("overwrite") \
            .parquet(f"{root}/_changed/slv_population/batch={batch_id}")


def refresh_nations(spark: SparkSession, root: str) -> Dim:
    """Nation dimension over the stored names, its keys kept between runs."""
    names = G.gold_dim_nation_frame(snapshots.read_table(spark, f"{root}/slv_population_nation"))
    return kept_keys(spark, measured(names, cache=False), ["nation_id"], "nation_sk", f"{root}/_keys/gold_dim_nation")


def refresh_fact(spark: SparkSession, root: str) -> list[int]:
    """Bring the stored fact up to date: only nations in the buckets that silver
    batches have rewritten since the last refresh are read and recomputed, and
    their buckets replaced.  Rows of nations that the dimension does not know
    are one bucket of their own, recomputed when one of them changes; those
    whose nation has become known move to its bucket.  Returns the buckets read.
    An interrupted refresh is made again from its notes."""
    changed, path, silver = f"{root}/_changed/slv_population", f"{root}/{FACT}", f"{root}/slv_population"
    nations = refresh_nations(spark, root).select("nation_sk", "nation_id")
    if not snapshots.exists(spark, changed):
        return []
    notes = spark.read.schema("bucket INT").option("recursiveFileLookup", "true").parquet(changed)
    touched = {r[0] for r in notes.distinct().collect()}             # at most as many as silver has buckets
    count = snapshots.bucket_count(spark, silver)
    own = snapshots.bucket_of(["nation_id"], count)
    lost = snapshots.read_stored(spark, path, [LOST])
    if lost is not None:
        lost = lost.select("nation_id", "year", "population", own.alias(snapshots.BUCKET))
        touched |= set(snapshots.touched_buckets(lost.join(nations.df, "nation_id", "left_semi")))
    if not touched:
        return []
    buckets = sorted(touched)
    rows = cdc.values(snapshots.read_stored(spark, silver, buckets)).select("nation_id", "year", "population", snapshots.BUCKET)
    rows = G.with_nation_key(rows, nations)
    if lost is not None:
        others = lost.where(~F.col(snapshots.BUCKET).isin(buckets)).withColumn("nation_sk", F.lit(None).cast("bigint"))
        rows = rows.unionByName(others)
    rows = rows.withColumn(snapshots.BUCKET, F.when(F.col("nation_sk").isNull(), F.lit(LOST)).otherwise(F.col(snapshots.BUCKET)))
    fact = G.year_over_year(rows, [snapshots.BUCKET], with_id=True)
    snapshots.swap_buckets(fact, path, f"{root}/_checkpoints/{FACT}", replaced=[*buckets, LOST])
    fs, p = snapshots._fs(spark, changed)
    fs.delete(p, True)
    return buckets


def stored_fact(spark: SparkSession, root: str) -> DataFrame:
    return snapshots.read_table(spark, f"{root}/{FACT}").drop("nation_id")


def rule_report(spark: SparkSession, root: str) -> DataFrame:
    """Rules of the bronze table and of the two views between bronze and
    silver, over every row that has arrived: the sums of what the micro-batches
    have counted."""
    counts = jobs.rule_counts(spark, f"{root}/_rules")
    return counts.groupBy("table_name", "rule", "action").agg(F.sum("failed_rows").alias("failed_rows"),
                                                              F.sum("total_rows").alias("total_rows"))
