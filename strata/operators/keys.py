"""Surrogate keys for dimensions.

``assign_surrogate_keys`` numbers rows 1..n in business-key order: rows are
partitioned into ranges of about ``ROWS_PER_RANGE``, numbered inside each range,
and shifted by the row counts of the ranges before them -- at every size in the
same way, and no task ever sees more than a range.
``extend_surrogate_keys`` keeps existing keys stable across loads and numbers
only new business keys after the current maximum.  ``kept_keys`` does so with a
key map stored between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lookup import Dim, measured

ROWS_PER_RANGE = 100_000


def _range_keys(df: DataFrame, order_by: list[str], sk: str, start: int, n: int) -> DataFrame:
    spark = df.sparkSession
    sort_cols = order_by + [c for c in df.columns if c not in order_by]
    ranged = (df.repartitionByRange(n, *order_by)
                .sortWithinPartitions(*sort_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    # Ids must not be recomputed differently: cut lineage on shared storage.
    from ..session import shared_dir
    shared_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    per_part = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    # One row per partition (bounded by ``n``), safe to order in one task and broadcast.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    key = (F.col("_off") + (F.col("_mid") - F.col("_m0")) + start).cast("bigint")
    return out.select(key.alias(sk), *df.columns)


def assign_surrogate_keys(dim: Dim, order_by: list[str], sk: str, start: int = 1,
                          rows_per_range: int = ROWS_PER_RANGE) -> Dim:
    """``dim`` with ``sk`` numbering its rows from ``start`` in the order of
    ``order_by`` (NULLs first; equal ones by their other columns).  The number of
    ranges follows the counted rows."""
    ranges = max(1, -(-dim.rows // rows_per_range))
    return dim.numbered(_range_keys(dim.df, order_by, sk, start, ranges))


def extend_surrogate_keys(existing: DataFrame, incoming: DataFrame, business_key: list[str],
                          sk: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Existing rows keep their keys; unseen business keys get max(sk)+1.. in
    business-key order.  Attributes of existing keys are taken from
    ``incoming`` when present there (type-1 refresh)."""
    e, i = existing.alias("e"), incoming.alias("i")
    # A NULL in a business key is a value like any other.
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"i.{c}")) for c in business_key]
    refreshed = i.join(e, same, "inner").select(f"e.{sk}", *[F.col(f"i.{c}") for c in incoming.columns])
    gone = e.join(i, same, "left_anti").select(sk, *incoming.columns)
    new = i.join(e, same, "left_anti").select(*incoming.columns)
    # current maximum key and the number of new keys, in one job (two scalars)
    stats = (existing.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint").alias("_v"))
             .select(F.lit("top").alias("_k"), "_v")
             .unionByName(new.agg(F.count(F.lit(1)).cast("bigint").alias("_v"))
                          .select(F.lit("new").alias("_k"), "_v")))
    got = {r["_k"]: int(r["_v"]) for r in stats.collect()}
    top = got["top"]
    new_dim = Dim(new, got["new"])
    numbered = assign_surrogate_keys(new_dim, business_key, sk, start=int(top) + 1,
                                     rows_per_range=rows_per_range).df
    return refreshed.unionByName(gone).unionByName(numbered)


def _null_safe(left: str, right: str, columns: list[str]):
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def kept_keys(spark: SparkSession, dim: Dim, business_key: list[str], sk: str, map_path: str,
              rows_per_range: int = ROWS_PER_RANGE) -> Dim:
    """``dim`` with surrogate keys that outlive the run: the key map at
    ``map_path`` (business key, its number among equal ones, key) is read, new
    business keys are appended to it after its greatest key in business-key
    order, and none is ever renumbered or reused, whatever else a run holds.
    The first run numbers like ``assign_surrogate_keys``."""
    from ..streaming.snapshots import exists
    order = [F.col(c).asc_nulls_first() for c in dim.df.columns]
    rows = dim.df.withColumn("_nth", F.row_number().over(Window.partitionBy(*business_key).orderBy(*order)))
    found = rows.select(*business_key, "_nth")
    start = 1
    if exists(spark, f"{map_path}/_SUCCESS"):
        known = spark.read.parquet(map_path)
        found = found.alias("f").join(known.alias("k"), _null_safe("f", "k", [*business_key, "_nth"]), "left_anti")
        start = int(known.agg(F.max(sk)).first()[0] or 0) + 1
    new = measured(found)
    if new.rows or start == 1:
        assign_surrogate_keys(new, [*business_key, "_nth"], sk, start, rows_per_range).df.write.mode("append").parquet(map_path)
    new.df.unpersist()
    known = spark.read.parquet(map_path)
    keyed = rows.alias("r").join(known.alias("k"), _null_safe("r", "k", [*business_key, "_nth"]))
    return dim.numbered(keyed.select(f"k.{sk}", *[f"r.{c}" for c in dim.df.columns]))
