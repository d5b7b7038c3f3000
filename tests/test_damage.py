"""Damaged landing files: nothing is lost, and rules count it."""

import pytest

from strata.operators import quality
from strata.plans import expectations as EX
from strata.session import scratch_path
from strata.sources import json_pages, tsv
from strata.streaming import jobs, snapshots

DDL = tsv.LANDING_DDL["data_1_alldata"]
HEADER = "series_id\tyear\tperiod\tvalue\tfootnote_codes\n"


def _put(spark, path, text):
    fs, p = snapshots._fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def test_damaged_lines_keep_their_readable_fields(spark):
    root = scratch_path(spark, "tsv")
    _put(spark, f"{root}/a.tsv", HEADER + "A  \t1999\tQ01\t1.5\tR\nB\t1998\nC\t1997\tQ02\t2\tR\textra\nD\t19x9\tQ01\t3\t\n\n")
    got = {r["series_id"]: r for r in tsv.read_tsv(spark, root, DDL, corrupt=True).collect()}
    assert {k: r["_corrupt_record"] for k, r in got.items()} == {
        "A  ": None, "B": "B\t1998", "C": "C\t1997\tQ02\t2\tR\textra", "D": "D\t19x9\tQ01\t3\t"}
    assert tuple(got["B"])[:5] == ("B", 1998, None, None, None) and tuple(got["C"])[:5] == ("C", 1997, "Q02", 2.0, "R")
    assert got["D"]["year"] is None and got["D"]["value"] == 3.0
    plain = tsv.read_tsv(spark, root, DDL)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted((tuple(r)[:5] for r in got.values()), key=str)
    report = quality.quality_report({"t": (tsv.read_tsv(spark, root, DDL, corrupt=True), tsv.DAMAGE_RULES)})
    assert [(r["rule"], r["failed_rows"], r["total_rows"]) for r in report.collect()] == [("well_formed_line", 3, 4)]


def test_headers(spark):
    root = scratch_path(spark, "headers")
    _put(spark, f"{root}/a.tsv", HEADER + "A\t1999\tQ01\t1.5\tR\n" * 20)
    _put(spark, f"{root}/b.tsv", "series_id\tperiod\tyear\tvalue\tfootnote_codes\nA\tQ01\t1999\t1.5\tR\n")
    got = {r["file_path"][-5:]: r["as_declared"] for r in tsv.header_report(spark, root, DDL).collect()}
    assert got == {"a.tsv": True, "b.tsv": False}
    report = quality.quality_report({"h": (tsv.header_report(spark, root, DDL), tsv.HEADER_RULES)}).first()
    assert (report["failed_rows"], report["total_rows"]) == (1, 2)
    assert tsv.read_tsv(spark, f"{root}/a.tsv", DDL, strict_header=True).count() == 20
    with pytest.raises(Exception, match="header does not conform|Encountered error while reading"):
        tsv.read_tsv(spark, root, DDL, strict_header=True).collect()


def test_header_report_sorts_no_lines(spark):
    """Only lines equal to their file's first one are grouped with their text."""
    root = scratch_path(spark, "first-lines")
    _put(spark, f"{root}/a.tsv", HEADER + "A\t1999\tQ01\t1.5\tR\n" * 50 + HEADER)
    _put(spark, f"{root}/b.tsv", "B\t1999\n" * 2 + HEADER + "B\t1999\n")
    _put(spark, f"{root}/c.tsv", "\n" + HEADER)
    _put(spark, f"{root}/d.tsv", "")
    report = tsv.header_report(spark, root, DDL)
    got = {r["file_path"][-5:]: (r["header"], r["as_declared"]) for r in report.collect()}
    assert got == {"a.tsv": (HEADER[:-1], True), "b.tsv": ("B\t1999", False), "c.tsv": ("", False)}
    nodes = report._jdf.queryExecution().sparkPlan().toString().splitlines()
    join = next((i for i, n in enumerate(nodes) if "BroadcastHashJoin" in n), 0)
    assert not [n for n in nodes[join:] if "SortAggregate" in n or "ObjectHashAggregate" in n]


def test_pages_with_unknown_fields_and_broken_documents(spark):
    root = scratch_path(spark, "rescued")
    docs = {"good": '{"data": [{"Year": "2001"}], "load_no": 1}', "more": '{"load_no": 2, "data": [],\n "x": {"y": [1]}, "z": null}',
            "typed": '{"data": [], "load_no": "many"}', "cut": '{"data": [{"Year"', "array": '[1, 2]', "empty": ""}
    for name, text in docs.items():
        _put(spark, f"{root}/yyyy=2024/{name}.json", text)
    out, ckpt = scratch_path(spark, "rescued-out"), scratch_path(spark, "rescued-ckpt")
    rules = scratch_path(spark, "rescued-rules")
    jobs.ingest_bronze(json_pages.stream_rescued(spark, root), out, ckpt, jobs.BatchRules("pages", json_pages.RESCUE_RULES, rules))
    want = [("[]", 2, '{"x":"{\\"y\\":[1]}"}', None), ("[]", None, None, None), ('[{"Year":"2001"}]', 1, None, None),
            (None, None, None, "[1, 2]"), (None, None, None, '{"data": [{"Year"')]
    for pages in (json_pages.read_rescued(spark, root), spark.read.parquet(out).drop("batch_id")):
        rows = [tuple(r) for r in pages.collect()]
        unknown = [r for r in rows if r[2] is not None]
        assert len(unknown) == 1 and unknown[0][1] == 2 and '"x"' in unknown[0][2]
        assert sorted(r[3] for r in rows if r[3]) == sorted(w[3] for w in want if w[3])
        assert sorted((str(r[0]), str(r[1])) for r in rows if r[0]) == sorted((str(w[0]), str(w[1])) for w in want if w[0])
    counts = {r["rule"]: (r["failed_rows"], r["total_rows"]) for r in jobs.rule_counts(spark, rules).collect()}
    assert counts["known_fields_only"][0] == 1 and counts["readable_page"][0] >= 2


def test_rules_of_the_oracle_are_the_declared_ones():
    """The oracle states names and predicates on its own; they must be all there are."""
    from strata import oracle
    declared = {**EX.BRONZE, **EX.SILVER, **EX.GOLD}
    declared["gold_fact_population"] = declared["gold_fact_population"] + EX.POPULATION_VALUE_RULES
    for table, source in oracle._SOURCE.items():
        for r in declared.get(table, []):
            assert f"'{table}' AS table_name, '{r.name}' AS rule, '{r.action}' AS action" in oracle.QUERIES["dq_report"], (table, r.name, source)
