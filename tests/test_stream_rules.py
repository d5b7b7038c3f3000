"""Rules inside streams, aborts, states kept in the target, first rows by a
total order, keys kept between runs, and the fact refreshed by change."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import cdc, quality
from strata.operators.keys import kept_keys
from strata.operators.lookup import measured
from strata.operators.quality import ExpectationFailed, expect, expect_or_fail
from strata.plans import gold as G
from strata.plans import population as POP
from strata.session import scratch_path
from strata.streaming import jobs, snapshots


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _land(spark, root, name, records):
    """A page of (nation id, nation, year, population)."""
    doc = json.dumps({"data": [dict(zip(("Nation ID", "Nation", "Year", "Population"), r)) for r in records], "load_no": 1})
    fs, p = snapshots._fs(spark, f"{root}/yyyy=2024/mm=01/dd=01/{name}.json")
    out = fs.create(p, True)
    out.write(bytearray(doc.encode()))
    out.close()


PAGES = [[("A", "Aland", "2001", 10.0), ("B", "Bland", "2001", 20.0), ("C", None, "20x1", 5.0)],
         [("A", "Aland", "2002", 12.0), ("C", "Cland", "2001", 7.0)],
         [("B", "B-Land", "2001", None), (None, "Nowhere", "2001", 1.0)]]


def test_counts_of_each_batch_add_up_and_replays_replace_them(spark):
    root, pages = scratch_path(spark, "rules"), scratch_path(spark, "rules-pages")
    rules = {POP.POPULATION_VIEW: [expect("year_populated", "year IS NOT NULL"), expect("plenty", "population > 6")]}
    for i, page in enumerate(PAGES):
        _land(spark, pages, f"p{i}", page)
        POP.run_streams(spark, pages, root, rules)
    counts = jobs.rule_counts(spark, f"{root}/_rules")
    kept = _rows(counts)
    per_batch = {(r["batch_id"], r["rule"]): (r["failed_rows"], r["total_rows"])
                 for r in counts.where(F.col("table_name") == POP.POPULATION_VIEW).collect()}
    assert per_batch == {(0, "year_populated"): (1, 3), (1, "year_populated"): (0, 2), (2, "year_populated"): (0, 2),
                         (0, "plenty"): (1, 3), (1, "plenty"): (0, 2), (2, "plenty"): (2, 2)}
    records = POP._records(POP.stored_tables(spark, root)[POP.BRONZE])
    whole = quality.quality_report({POP.POPULATION_VIEW: (records, rules[POP.POPULATION_VIEW])})
    assert _rows(POP.rule_report(spark, root).where(F.col("table_name") == POP.POPULATION_VIEW)
                 .select(*whole.columns)) == _rows(whole)
    # the last batch again, as after a failure between its write and its commit
    fs, p = snapshots._fs(spark, f"{root}/_checkpoints/slv_population/commits/2")
    assert fs.delete(p, False)
    before = _rows(snapshots.read_table(spark, f"{root}/slv_population"))
    POP.run_streams(spark, pages, root, rules)
    assert _rows(jobs.rule_counts(spark, f"{root}/_rules")) == kept
    assert _rows(snapshots.read_table(spark, f"{root}/slv_population")) == before


@pytest.mark.parametrize("table", [POP.BRONZE, POP.POPULATION_VIEW])
def test_a_bad_batch_stops_the_stream_and_leaves_the_tables(spark, table):
    root, pages = scratch_path(spark, "abort"), scratch_path(spark, "abort-pages")
    bad = {POP.BRONZE: "data LIKE '%Nowhere%'", POP.POPULATION_VIEW: "nation = 'Nowhere'"}[table]
    rules = {table: [expect_or_fail("nobody_is_nowhere", f"NOT coalesce({bad}, FALSE)")]}
    _land(spark, pages, "p0", PAGES[0])
    POP.run_streams(spark, pages, root, rules)
    tables = lambda: {n: _rows(t) for n, t in POP.stored_tables(spark, root).items()}
    before = tables()
    _land(spark, pages, "p1", PAGES[2])
    with pytest.raises(ExpectationFailed, match="nobody_is_nowhere"):
        POP.run_streams(spark, pages, root, rules)
    after = tables()
    if table == POP.BRONZE:
        assert after == before
    else:
        assert after["slv_population"] == before["slv_population"]
    with pytest.raises(ExpectationFailed):                       # still there at the next run
        POP.run_streams(spark, pages, root, rules)
    assert tables()["slv_population"] == before["slv_population"]
    if table == POP.BRONZE:                                      # the page is repaired in place
        _land(spark, pages, "p1", [("B", "B-Land", "2001", None)])
    else:                                                        # or the rule is
        rules = {table: [expect("nobody_is_nowhere", "nation <> 'Nowhere'")]}
    POP.run_streams(spark, pages, root, rules)
    got = {(r["year"], r["nation_id"]): (r["nation"], r["population"])
           for r in snapshots.read_table(spark, f"{root}/slv_population").collect()}
    assert got[2001, "B"] == ("B-Land", 20) and got[2001, "A"] == ("Aland", 10)


def test_guard_aborts_a_batch_write(spark):
    rules = [expect_or_fail("positive", "v > 0"), expect("small", "v < 3")]
    good = spark.range(1, 5).select(F.col("id").alias("v"))
    assert _rows(quality.guarded(good, "t", rules)) == _rows(good)
    path = scratch_path(spark, "guard")
    with pytest.raises(Exception) as e:
        quality.guarded(good.unionByName(spark.range(1).select(F.col("id").alias("v"))), "t", rules).write.parquet(path)
    assert isinstance(quality.as_expectation_failed(e.value), ExpectationFailed)
    assert not snapshots.exists(spark, f"{path}/_SUCCESS")
    # nothing is added where nothing can fail
    plan = quality.guarded(good, "t", rules[1:])._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" not in plan


CHANGES = [(k, s, f"n{s}" if s % 3 else None, s * 10 if s % 2 else None) for k in ("a", "b", None) for s in range(1, 7)]


@pytest.mark.parametrize("ignore", [True, False])
def test_any_order_and_split_of_batches_gives_the_batch_result(spark, ignore):
    schema = "k STRING, s INT, name STRING, v INT"
    want = {r["k"]: (r["name"], r["v"]) for r in cdc.scd1(spark.createDataFrame(CHANGES, schema), ["k"], "s", ignore).drop("s").collect()}
    for seed in range(3):
        rng = random.Random(seed)
        rows = CHANGES * 2
        rng.shuffle(rows)
        target, staging = scratch_path(spark, "merge"), scratch_path(spark, "merge-staging")
        cuts = sorted(rng.sample(range(1, len(rows)), 3))
        for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            state = cdc.latest_state(spark.createDataFrame(rows[a:b], schema), ["k"], "s", ["name", "v"], ignore)
            for _ in range(1 + i % 2):                                        # some batches twice
                snapshots.merge_buckets(state, i, target, ["k"], staging, buckets=3)
        assert {r["k"]: (r["name"], r["v"]) for r in snapshots.read_table(spark, target).collect()} == want


def test_no_state_store_in_the_upserts(spark):
    """The streams' plans hold no stateful operator."""
    source = scratch_path(spark, "plain")
    spark.createDataFrame(CHANGES, "k STRING, s INT, name STRING, v INT").write.parquet(source)
    for i, job in enumerate((jobs.upsert_scd1, jobs.upsert_first_seen)):
        ckpt = scratch_path(spark, "plain-ckpt")
        stream = spark.readStream.schema("k STRING, s INT, name STRING, v INT").parquet(source)
        job(stream, ["k"], ["s"], ["name", "v"], scratch_path(spark, "plain-out"), ckpt)
        assert not snapshots.exists(spark, f"{ckpt}/state")


def test_swap_is_taken_up_from_a_complete_stage(spark):
    """A batch that failed while its buckets were swapped in."""
    schema = "k STRING, s INT, name STRING, v INT"
    target, staging = scratch_path(spark, "torn"), scratch_path(spark, "torn-staging")
    state = lambda rows: cdc.latest_state(spark.createDataFrame(rows, schema), ["k"], "s", ["name", "v"])
    snapshots.merge_buckets(state([("a", 1, "x", 1), ("b", 1, "y", 2)]), 0, target, ["k"], staging, buckets=1)
    new = state([("a", 2, "z", None)])
    whole = cdc.fold(snapshots.read_stored(spark, target).unionByName(new.withColumn("_bucket", F.lit(0))), ["k", "_bucket"])
    whole.write.partitionBy("_bucket").parquet(f"{staging}/batch=1-merged")
    new.withColumn("_bucket", F.lit(0)).write.parquet(f"{staging}/batch=1")
    fs, p = snapshots._fs(spark, f"{target}/_bucket=0")
    fs.delete(p, True)                                                        # torn: the old bucket is gone
    snapshots.merge_buckets(new, 1, target, ["k"], staging, buckets=1)
    assert _rows(snapshots.read_table(spark, target)) == [("a", "z", 1), ("b", "y", 2)]


def test_first_row_of_a_key_by_a_total_order(spark):
    """Two names of one nation in one micro-batch, in any order of rows and batches."""
    schema = "k STRING, t INT, file STRING, pos INT, name STRING"
    rows = [("a", 1, "f2", 0, "late file"), ("a", 1, "f1", 3, "third"), ("a", 1, "f1", 1, "first"), ("a", 2, "f0", 0, "later"),
            ("b", 5, "f9", 9, None), ("b", 6, "f9", 0, "named"), (None, 1, "f1", 0, "none")]
    want = [("a", "first"), ("b", None), (None, "none")]
    for seed, parts in itertools.product(range(3), (1, 4)):
        mixed = list(rows)
        random.Random(seed).shuffle(mixed)
        source, target, ckpt = (scratch_path(spark, n) for n in ("first-in", "first", "first-ckpt"))
        for cut in (mixed[:4], mixed[4:]):
            spark.createDataFrame(cut, schema).repartition(parts).write.mode("append").parquet(source)
            stream = spark.readStream.schema(schema).parquet(source)
            jobs.upsert_first_seen(stream, ["k"], ["t", "file", "pos"], ["name"], target, ckpt)
        assert _rows(snapshots.read_table(spark, target)) == sorted(want, key=str)


def test_keys_outlive_runs(spark):
    path = scratch_path(spark, "keys")
    schema = "code STRING, text STRING"

    def run(rows):
        dim = kept_keys(spark, measured(spark.createDataFrame(rows, schema)), ["code"], "sk", path)
        assert dim.df.columns == ["sk", "code", "text"]
        return {(r["code"], r["text"]): r["sk"] for r in dim.df.collect()}
    assert run([("b", "B"), ("d", "D")]) == {("b", "B"): 1, ("d", "D"): 2}
    assert run([("c", "C"), ("d", "D2"), ("b", "B"), ("a", "A")]) == {("a", "A"): 3, ("b", "B"): 1, ("c", "C"): 4, ("d", "D2"): 2}
    assert run([("d", "D")]) == {("d", "D"): 2}                                # a code that is gone keeps its key
    assert run([(None, "N"), ("d", "D"), ("d", "E"), ("a", "A")]) == {(None, "N"): 5, ("d", "D"): 2, ("d", "E"): 6, ("a", "A"): 3}
    assert run([(None, "N")]) == {(None, "N"): 5}
    assert run([]) == {}


def _full(spark, root):
    dim = POP.refresh_nations(spark, root)
    return G.gold_fact_population(snapshots.read_table(spark, f"{root}/slv_population"), dim)


def test_refresh_equals_a_full_rebuild_and_reads_touched_buckets(spark):
    root, pages = scratch_path(spark, "fact"), scratch_path(spark, "fact-pages")
    nations = [f"N{i:02}" for i in range(30)]
    loads = [[(n, n.lower(), str(y), float(100 * i + y)) for i, n in enumerate(nations) for y in range(2000, 2005)]
             + [(None, "nobody", "2001", 3.0), (None, "nobody", "2003", 8.0)],
             [("N07", "seven", "2002", 1.0), ("N07", "seven", "2009", 5.0)],
             [(None, "nobody", "2002", 4.0)], [("N31", "new", "2002", 4.0)]]
    seen = []
    for i, page in enumerate(loads):
        _land(spark, pages, f"p{i}", page)
        POP.run_streams(spark, pages, root)
        seen.append(POP.refresh_fact(spark, root))
        assert _rows(POP.stored_fact(spark, root)) == _rows(_full(spark, root)), i
    assert len(seen[0]) > 1 and [len(s) for s in seen[1:]] == [1, 1, 1]
    assert POP.refresh_fact(spark, root) == []                                # nothing has changed
    stored = snapshots.read_stored(spark, f"{root}/slv_population", seen[1])
    filters = stored._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
    assert filters.startswith("[") and "_bucket" in filters.split("]")[0]
    files = stored.select("_metadata.file_path").distinct().collect()
    assert {r[0].split("_bucket=")[1].split("/")[0] for r in files} == {str(b) for b in seen[1]}


def test_lost_nations_move_when_they_become_known(spark):
    """Facts whose nation the dimension learns later."""
    root = scratch_path(spark, "known")
    schema = "year INT, nation_id STRING, nation STRING, population BIGINT, at INT"
    rows = [(y, n, n, 10 * y + i, 1) for i, n in enumerate("ABC") for y in (2001, 2002)]
    state = cdc.latest_state(spark.createDataFrame(rows, schema), ["year", "nation_id"], "at", ["nation", "population"])
    touched = snapshots.merge_buckets(state, 0, f"{root}/slv_population", ["year", "nation_id"], f"{root}/_s", bucket_by=["nation_id"])
    names = lambda ns, b: snapshots.merge_buckets(cdc.first_state(
        spark.createDataFrame([(n, n, 1) for n in ns], "nation_id STRING, nation STRING, at INT"), ["nation_id"], ["at"], ["nation"]),
        b, f"{root}/slv_population_nation", ["nation_id"], f"{root}/_n", F.min)
    names("B", 0)
    POP._note(spark, root, touched, 0)
    POP.refresh_fact(spark, root)
    assert _rows(POP.stored_fact(spark, root)) == _rows(_full(spark, root))
    assert POP.stored_fact(spark, root).where("nation_sk IS NULL").count() == 4
    for batch, more in ((1, "A"), (2, "C")):
        names(more, batch)
        POP._note(spark, root, [], batch)
        snapshots._fs(spark, f"{root}/_changed/slv_population")[0].mkdirs(snapshots._fs(spark, f"{root}/_changed/slv_population")[1])
        POP.refresh_fact(spark, root)
        assert _rows(POP.stored_fact(spark, root)) == _rows(_full(spark, root))
    assert POP.stored_fact(spark, root).where("nation_sk IS NULL").isEmpty()


def test_many_files_in_bounded_batches_and_a_drained_source(spark):
    root, pages, archive = (scratch_path(spark, n) for n in ("bounded", "bounded-pages", "bounded-archive"))
    whole, plain = scratch_path(spark, "whole"), scratch_path(spark, "plain-pages")
    for i in range(7):
        for where in (pages, plain):
            _land(spark, where, f"p{i}", [(f"N{i % 3}", f"name{i}", str(2000 + i), float(i))])
    POP.run_streams(spark, pages, root, max_files=2, archive=archive)
    POP.run_streams(spark, plain, whole)
    keep = ["year", "nation_id", "nation", "population"]
    assert _rows(snapshots.read_table(spark, f"{root}/slv_population").select(*keep)) == \
        _rows(snapshots.read_table(spark, f"{whole}/slv_population").select(*keep))
    counts = jobs.rule_counts(spark, f"{root}/_rules").where(F.col("table_name") == POP.BRONZE)
    assert [r["total_rows"] for r in counts.orderBy("batch_id").collect()] == [2, 2, 2, 1]
    _land(spark, pages, "p7", [("N9", "nine", "2009", 9.0)])
    POP.run_streams(spark, pages, root, max_files=2, archive=archive)
    left = spark.read.option("recursiveFileLookup", "true").text(pages).inputFiles()
    moved = spark.read.option("recursiveFileLookup", "true").text(archive).inputFiles()
    assert len(left) <= 2 and len(left) + len(moved) == 8
