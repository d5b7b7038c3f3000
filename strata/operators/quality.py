"""Data-quality rules ("expectations") on tables.

* ``warn`` rules record how many rows violate the predicate and keep them.
* ``fail`` rules make the table update fail when any row violates them.
A predicate that evaluates to NULL counts as a violation.

Counting is attached to the action that materialises the table
(``DataFrame.observe``), so checking costs no extra pass over the data.  Fail
rules are also a condition of the plan itself (``guarded``): the task that
meets a violating row raises, so the write is aborted before a row is kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, FAIL = "warn", "fail"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, WARN)


def expect_or_fail(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, FAIL)


class ExpectationFailed(RuntimeError):
    pass


_ABORT = "expectation violated"
_ABORTED = re.compile(_ABORT + r" \[(.*?)\] \[(.*?)\]")


def guarded(df: DataFrame, table: str, rules: list[Expectation]) -> DataFrame:
    """``df`` with its fail rules in the plan: a row that violates one raises in
    its task.  No pass, no shuffle, no driver step; a plan without fail rules
    stays as it is."""
    keep = None
    for r in rules:
        if r.action == FAIL:
            error = F.raise_error(F.lit(f"{_ABORT} [{table}] [{r.name}]")).cast("boolean")
            own = F.when(r.violated(), error).otherwise(F.lit(True))
            keep = own if keep is None else keep & own
    return df if keep is None else df.filter(keep)


def as_expectation_failed(error: Exception) -> Exception:
    """The ``ExpectationFailed`` that a guard in a plan has raised, or ``error``."""
    found = _ABORTED.search(str(error))
    return ExpectationFailed(f"{found[1]}: expectation {found[2]} violated") if found else error


def violation_counts(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One aggregate pass: total rows and failed rows per rule (wide, one row)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(r.violated()).alias(f"_r{i}") for i, r in enumerate(rules)]
    return df.agg(*aggs)


def quality_report(tables: dict[str, tuple[DataFrame, list[Expectation]]]) -> DataFrame:
    """Long report: table, rule, action, failed_rows, total_rows.

    Tables given as the *same* DataFrame object (e.g. two layers that share
    their rows) are counted together in one aggregation pass."""
    groups: dict[int, tuple[DataFrame, list[tuple[str, Expectation]]]] = {}
    for table, (df, rules) in tables.items():
        groups.setdefault(id(df), (df, []))[1].extend((table, r) for r in rules)
    parts = []
    for df, tagged in groups.values():
        if not tagged:
            continue
        wide = violation_counts(df, [r for _, r in tagged])
        rows = F.array(*[
            F.struct(F.lit(t).alias("table_name"), F.lit(r.name).alias("rule"),
                     F.lit(r.action).alias("action"),
                     F.col(f"_r{i}").cast("bigint").alias("failed_rows"))
            for i, (t, r) in enumerate(tagged)])
        parts.append(wide.select(F.col("_rows").cast("bigint").alias("total_rows"), F.inline(rows))
                         .select("table_name", "rule", "action", "failed_rows", "total_rows"))
    return reduce(DataFrame.unionByName, parts)


def observed(df: DataFrame, table: str, rules: list[Expectation]) -> tuple[DataFrame, Observation]:
    """Attach rule counters to ``df``; read them after the writing action."""
    obs = Observation(f"quality:{table}")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(r.violated()).alias(f"_r{i}") for i, r in enumerate(rules)]
    return df.observe(obs, *aggs), obs


def check(obs: Observation, table: str, rules: list[Expectation]) -> dict[str, int]:
    got = obs.get
    counts = {r.name: int(got.get(f"_r{i}", 0) or 0) for i, r in enumerate(rules)}
    failed = [r.name for r in rules if r.action == FAIL and counts[r.name] > 0]
    if failed:
        raise ExpectationFailed(
            f"{table}: expectation(s) {failed} violated by {[counts[n] for n in failed]} row(s)")
    return counts


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """rows vs distinct keys (rows with a NULL in any key column are not
    counted as distinct keys, as with COUNT(DISTINCT a, b)).  Rows are counted
    per key, combined before the shuffle, and the counts folded: no row is
    multiplied and no task holds the keys of another."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
                       F.count_if(whole).alias("distinct_keys"))


def keys_uniqueness(df: DataFrame, table: str, keys: list[list[str]]) -> DataFrame:
    """``key_uniqueness`` of several keys of one table: table_name, key_columns,
    total_rows, distinct_keys.  Each key is a grouping of its own columns alone
    (a scan of those), where distinct counts of several keys at once would
    expand every row to one a key."""
    return reduce(DataFrame.unionByName, [
        key_uniqueness(df, k).select(F.lit(table).alias("table_name"), F.lit(",".join(k)).alias("key_columns"),
                                     "total_rows", "distinct_keys") for k in keys])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def orphan_keys_all(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Orphans of several foreign keys in one pass over the fact: every row
    yields (foreign_key, value) pairs, distinct pairs are anti-joined with the
    union of the dimensions' keys.  ``dims`` maps a foreign-key column to a
    one-column DataFrame of the dimension's key values."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).cast("bigint").alias("orphan_value"))
        for fk in dims]))
    seen = fact.select(pairs.alias("_p")).select("_p.*").distinct()
    keys = reduce(DataFrame.unionByName, [
        d.select(F.lit(fk).alias("foreign_key"), F.col(d.columns[0]).cast("bigint").alias("_v"))
        for fk, d in dims.items()])
    cond = (F.col("foreign_key") == F.col("_fk")) & (F.col("orphan_value") == F.col("_v"))
    return seen.join(keys.withColumnRenamed("foreign_key", "_fk"), cond, "left_anti")


def orphan_keys(fact: DataFrame, dim: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Distinct foreign-key values of ``fact`` with no dimension row (a NULL
    foreign key never matches, so it is reported too)."""
    pk = pk or fk
    keys = fact.select(F.col(fk)).distinct()
    return keys.join(dim.select(F.col(pk).alias("_pk")).distinct(),
                     F.col(fk) == F.col("_pk"), "left_anti")
