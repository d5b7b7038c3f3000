"""Incremental ingest, streaming de-duplication and streaming upserts."""

import pytest
from pyspark.sql import functions as F

from strata.plans import silver as S
from strata.session import scratch_path
from strata.sources import json_pages
from strata.sources import landing as L
from strata.streaming import jobs, snapshots

from given_tables import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _upsert_job(stream, out, ckpt):
    rec = S.population_records(stream, keep=["load_timestamp", "file_arrival_timestamp", "file_path"])
    jobs.upsert_scd1(rec, ["year", "nation_id"],
                     ["load_timestamp", "file_arrival_timestamp", "file_path", "record_pos"],
                     ["nation", "population"], out, ckpt)


def test_incremental_upsert_equals_batch_and_reruns_are_idempotent(spark):
    loads = L.landing_population_loads(spark, SF_SMALL).cache()
    root, out, ckpt = (scratch_path(spark, n) for n in ("pages", "snap", "ckpt"))
    for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-03"), start=1):
        json_pages.write_population_pages(loads, root, i, day)
        _upsert_job(json_pages.with_file_audit(json_pages.stream_pages(spark, root)), out, ckpt)
    got = _rows(snapshots.read_table(spark, out).select("nation", "nation_id", "population", "year"))
    want = _rows(S.silver_population(loads, ["load_no"]))
    assert got == want
    # a rerun with no new files changes nothing
    _upsert_job(json_pages.with_file_audit(json_pages.stream_pages(spark, root)), out, ckpt)
    assert _rows(snapshots.read_table(spark, out).select("nation", "nation_id", "population", "year")) == want
    loads.unpersist()


def test_bucket_upsert_rewrites_only_touched_buckets_and_replays(spark):
    target, staging = scratch_path(spark, "t"), scratch_path(spark, "s")
    first = spark.range(0, 200).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    snapshots.upsert_buckets(first, 0, target, ["k"], staging, buckets=16)
    change = spark.createDataFrame([(3, "b"), (500, "c")], "k BIGINT, v STRING")
    files = lambda: set(spark.read.parquet(target).inputFiles())
    before = files()
    snapshots.upsert_buckets(change, 1, target, ["k"], staging, buckets=16)
    rewritten = {f.split("_bucket=")[1].split("/")[0] for f in files() - before}
    snapshots.upsert_buckets(change, 1, target, ["k"], staging, buckets=16)  # replay
    got = {r["k"]: r["v"] for r in snapshots.read_table(spark, target).collect()}
    assert len(got) == 201 and got[3] == "b" and got[500] == "c" and got[4] == "a"
    assert 1 <= len(rewritten) <= 2
    assert not snapshots.exists(spark, f"{staging}/batch=1")


def test_bucket_upsert_null_keys_and_kept_bucket_count(spark):
    target, staging = scratch_path(spark, "t"), scratch_path(spark, "s")
    schema = "k BIGINT, y INT, v STRING"
    snapshots.upsert_buckets(spark.createDataFrame([(1, None, "a"), (3, 5, "a")], schema), 0, target, ["k", "y"],
                             staging, buckets=7)
    change = spark.createDataFrame([(1, None, "b"), (3, 5, "b"), (None, None, "n")], schema)
    for batch in (1, 1, 2):
        snapshots.upsert_buckets(change, batch, target, ["k", "y"], staging)      # the session asks for another count
    got = sorted(map(str, snapshots.read_table(spark, target).select("k", "y", "v").collect()))
    assert got == sorted(map(str, change.collect()))
    with pytest.raises(ValueError):
        snapshots.upsert_buckets(change, 3, target, ["k", "y"], staging, buckets=8)


def test_ingest_delivers_each_file_once(spark):
    loads = L.landing_population_loads(spark, SF_SMALL).cache()
    root, out, ckpt = (scratch_path(spark, n) for n in ("pages", "bronze", "ckpt"))
    json_pages.write_population_pages(loads, root, 1, "2024-01-01")
    jobs.ingest_bronze(json_pages.with_file_audit(json_pages.stream_pages(spark, root)), out, ckpt)
    n1 = spark.read.parquet(out).count()
    jobs.ingest_bronze(json_pages.with_file_audit(json_pages.stream_pages(spark, root)), out, ckpt)
    assert spark.read.parquet(out).count() == n1
    json_pages.write_population_pages(loads, root, 2, "2024-01-02")
    jobs.ingest_bronze(json_pages.with_file_audit(json_pages.stream_pages(spark, root)), out, ckpt)
    bronze = spark.read.parquet(out)
    assert bronze.select("load_no").distinct().count() == 2
    assert bronze.filter(F.col("file_arrival_timestamp").isNull() | F.col("load_timestamp").isNull()).count() == 0
    rec = S.population_records(bronze, keep=["load_no"])
    assert rec.count() == loads.filter("load_no <= 2").count()
    loads.unpersist()


def test_stream_dedup_first_seen_wins(spark):
    loads = L.landing_population_loads(spark, SF_SMALL).cache()
    root, out, ckpt = (scratch_path(spark, n) for n in ("pages", "nations", "ckpt"))
    for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-03"), start=1):
        json_pages.write_population_pages(loads, root, i, day)
        rec = S.population_records(json_pages.with_file_audit(json_pages.stream_pages(spark, root)))
        jobs.dedup_first_seen(rec.select("nation_id", "nation", "load_timestamp"), ["nation_id"], out, ckpt)
    got = _rows(spark.read.parquet(out).select("nation_id", "nation"))
    assert got == _rows(loads.filter("load_no = 1").select("nation_id", "nation").distinct())
    loads.unpersist()


def test_watermarked_dedup_bounds_state(spark):
    root = scratch_path(spark, "events-in")
    spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:00:01")],
        "k INT, t STRING").withColumn("t", F.to_timestamp("t")).write.parquet(root)
    out, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")
    stream = spark.readStream.schema("k INT, t TIMESTAMP").parquet(root)
    jobs.dedup_first_seen(stream, ["k"], out, ckpt, watermark=("t", "1 hour"))
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2]
