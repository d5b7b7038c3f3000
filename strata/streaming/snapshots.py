"""Upsert targets written from ``foreachBatch``.

The target is a parquet table partitioned by a hash bucket of its key
(``_bucket = pmod(xxhash64(keys), buckets)``).  A micro-batch rewrites only
the buckets its keys fall in: it reads those buckets (partition pruning),
merges the batch's rows into them, stages the merged buckets under the batch
id, and swaps them in with a dynamic partition overwrite.  Untouched buckets
are never read or written, so the cost of a micro-batch follows the batch, not
the table.

``merge_buckets`` keeps states (see ``operators.cdc``) in the target and
combines the batch's with them, so no other copy of the table exists, in a
state store or elsewhere, and batches may come in any order and more than once.
``upsert_buckets`` replaces whole rows.  A batch whose merged buckets were
staged in full before a failure is swapped in from there: the swap, unlike the
merge, may then meet a target that is half overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc

BUCKET = "_bucket"
# None: as many buckets as the session's shuffle partitions.
DEFAULT_BUCKETS = None


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _has_buckets(spark: SparkSession, target: str) -> bool:
    fs, p = _fs(spark, target)
    return bool(fs.exists(p)) and any(
        st.isDirectory() and st.getPath().getName().startswith(BUCKET + "=") for st in fs.listStatus(p))


def read_stored(spark: SparkSession, target: str, buckets: list[int] | None = None) -> DataFrame | None:
    """The target as it is stored (with ``_bucket``), or some of its buckets:
    numbers in a literal list, which prune its partitions."""
    if not _has_buckets(spark, target):
        return None
    df = spark.read.parquet(target)
    return df if buckets is None else df.where(F.col(BUCKET).isin(buckets))


def read_table(spark: SparkSession, target: str) -> DataFrame | None:
    stored = read_stored(spark, target)
    if stored is None:
        return None
    rows = stored.drop(BUCKET)
    return cdc.values(rows) if cdc.STATE in rows.columns else rows


def touched_buckets(rows: DataFrame) -> list[int]:
    """The buckets of some rows: at most as many numbers as the target has."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def swap_buckets(merged: DataFrame, target: str, stage: str, replaced: list[int] | None = None) -> None:
    """Put ``merged`` in place of the buckets that it holds, by way of ``stage``
    (``merged`` may read the target).  Those of ``replaced`` that it does not
    hold are emptied."""
    spark = merged.sparkSession
    schema = merged.schema
    if not exists(spark, f"{stage}/_SUCCESS"):
        merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(stage)
    # A batch without a change stages no file.
    (spark.read.schema(schema).parquet(stage).repartition(BUCKET)
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(BUCKET).parquet(target))
    for b in replaced or []:
        if not exists(spark, f"{stage}/{BUCKET}={b}"):
            fs, p = _fs(spark, f"{target}/{BUCKET}={b}")
            fs.delete(p, True)
    fs, p = _fs(spark, stage)
    fs.delete(p, True)


def upsert_buckets(batch: DataFrame, batch_id: int, target: str, keys: list[str],
                   staging: str, buckets: int | None = DEFAULT_BUCKETS) -> None:
    """Replace the batch's keys in ``target``, rewriting touched buckets only.
    The bucket count is kept with the target."""
    spark = batch.sparkSession
    buckets = bucket_count(spark, target, buckets)
    merged = upd = batch.withColumn(BUCKET, bucket_of(keys, buckets))
    if _has_buckets(spark, target):
        o, u = read_stored(spark, target, touched_buckets(upd)).alias("o"), upd.alias("u")
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys]
        merged = o.join(u, same, "left_anti").unionByName(upd)
    swap_buckets(merged, target, f"{staging.rstrip('/')}/batch={batch_id}")


def merge_buckets(states: DataFrame, batch_id: int, target: str, keys: list[str], staging: str, pick=F.max,
                  buckets: int | None = DEFAULT_BUCKETS, bucket_by: list[str] | None = None) -> list[int]:
    """Combine the batch's states with those of ``target``, bucketed by
    ``bucket_by`` (some of the keys; all of them, if not given).  Returns the
    buckets touched.  The batch is computed once, into the staging folder."""
    spark = states.sparkSession
    buckets = bucket_count(spark, target, buckets)
    stage = f"{staging.rstrip('/')}/batch={batch_id}"
    new = states.withColumn(BUCKET, bucket_of(bucket_by or keys, buckets))
    schema = new.schema
    if not exists(spark, f"{stage}-merged/_SUCCESS"):
        new.write.mode("overwrite").parquet(stage)
    new = spark.read.schema(schema).parquet(stage)
    touched = touched_buckets(new)
    old = read_stored(spark, target, touched)
    merged = new if old is None else cdc.fold(old.select(*new.columns).unionByName(new), [*keys, BUCKET], pick)
    swap_buckets(merged, target, f"{stage}-merged")
    fs, p = _fs(spark, stage)
    fs.delete(p, True)
    return touched


def bucket_count(spark: SparkSession, target: str, asked: int | None = None) -> int:
    """The target's bucket count, kept beside it as the name of a marker file:
    a key must not move to another bucket when a setting changes."""
    fs, p = _fs(spark, f"{target.rstrip('/')}/_buckets")
    if fs.exists(p):
        kept = int(next(iter(fs.listStatus(p))).getPath().getName()[2:])
        if asked not in (None, kept):
            raise ValueError(f"{target} has {kept} buckets, not {asked}")
        return kept
    n = asked or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fs.create(_fs(spark, f"{target.rstrip('/')}/_buckets/n={n}")[1], True).close()
    return n
