"""Streaming jobs over landed JSON pages.

* ``ingest_bronze``   incremental file ingest into an append-only bronze table,
  a folder per micro-batch.
* ``dedup_first_seen`` streaming drop-duplicates on a key; of the rows of one
  micro-batch the one that arrives first passes.  Its state grows with the
  number of distinct keys, unless there is a watermark.
* ``upsert_first_seen`` the first row of each key by a total order, kept in a
  keyed upsert target: the same whatever order rows and batches arrive in.
* ``upsert_scd1``     keyed upsert, latest sequence wins, NULLs optionally
  ignored.  The (sequence, value) pairs live in the target itself, so the
  stream has no state store and results do not depend on how changes are split
  into micro-batches or in which order these come.

Rules given with a job are part of each micro-batch: fail rules abort its tasks
before a row is kept, and the counts of all rules, observed while the batch is
written, are kept under its batch id (``rule_counts``), so that a replayed
batch replaces its counts.

Every job runs with ``Trigger.AvailableNow`` and a checkpoint on shared
storage, so a rerun picks up only new files and a failed run resumes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc, quality
from . import snapshots

RULE_COUNTS = "batch_id BIGINT, table_name STRING, rule STRING, action STRING, failed_rows BIGINT, total_rows BIGINT"


def run_available_now(stream_writer, checkpoint: str, processing_time: str | None = None):
    """Run a streaming write.  Default: process everything available now and
    stop (scheduled runs).  With ``processing_time`` (e.g. ``"1 minute"``)
    the query keeps running with that trigger and is returned to the caller
    (who stops it)."""
    w = stream_writer.option("checkpointLocation", checkpoint)
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    except StreamingQueryException as e:
        raise quality.as_expectation_failed(e) from e
    return q


class BatchRules:
    """The rules of one table inside a stream: put into every micro-batch, whose
    counts are stored under ``path`` by batch id."""

    def __init__(self, table: str, rules: list[quality.Expectation], path: str):
        self.table, self.rules, self.path = table, rules, path

    def watch(self, batch: DataFrame):
        return quality.observed(quality.guarded(batch, self.table, self.rules), self.table, self.rules)

    def keep(self, spark: SparkSession, batch_id: int, observation) -> None:
        got = observation.get
        rows = [(batch_id, self.table, r.name, r.action, int(got.get(f"_r{i}") or 0), int(got.get("_rows") or 0))
                for i, r in enumerate(self.rules)]
        spark.createDataFrame(rows, RULE_COUNTS).coalesce(1).write.mode("overwrite") \
            .parquet(f"{self.path.rstrip('/')}/{self.table}-{batch_id}")


def rule_counts(spark: SparkSession, path: str) -> DataFrame:
    """What every micro-batch's rules have counted: batch_id, table_name, rule,
    action, failed_rows, total_rows."""
    if not snapshots.exists(spark, path):
        return spark.createDataFrame([], RULE_COUNTS)
    return spark.read.schema(RULE_COUNTS).option("recursiveFileLookup", "true").parquet(path)


def _run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                 rules: BatchRules | None = None) -> None:
    """``write`` every micro-batch, its rules in it.  ``write`` must compute the
    batch once: the first action over it gives the counts."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if rules and rules.rules:
            watched, observation = rules.watch(batch)
            write(watched, batch_id)
            rules.keep(batch.sparkSession, batch_id, observation)
        else:
            write(batch, batch_id)

    run_available_now(stream.writeStream.outputMode("append").foreachBatch(run), checkpoint)


def ingest_bronze(stream: DataFrame, table_path: str, checkpoint: str, rules: BatchRules | None = None) -> None:
    """Append every micro-batch as a folder of its own.  A batch that fails
    leaves no complete folder, and its replay starts it anew."""
    _run_batches(stream, lambda batch, batch_id: batch.write.mode("overwrite")
                 .parquet(f"{table_path.rstrip('/')}/batch_id={batch_id}"), checkpoint, rules)


def dedup_first_seen(stream: DataFrame, keys: list[str], table_path: str, checkpoint: str,
                     watermark: tuple[str, str] | None = None) -> None:
    """First-seen row per key.  Without ``watermark`` every key is remembered
    forever (state grows with the number of distinct keys).  With
    ``watermark=(event_time_column, delay)`` a key is remembered only until
    the watermark passes it, which bounds the state at the cost of letting a
    key re-appear after the delay."""
    if watermark:
        col, delay = watermark
        deduped = stream.withWatermark(col, delay).dropDuplicatesWithinWatermark(keys)
    else:
        deduped = stream.dropDuplicates(keys)
    run_available_now(deduped.writeStream.format("parquet")
                      .option("path", table_path).outputMode("append"), checkpoint)


def upsert_first_seen(stream: DataFrame, keys: list[str], order_by: list[str], columns: list[str], target: str,
                      checkpoint: str, buckets: int | None = snapshots.DEFAULT_BUCKETS,
                      rules: BatchRules | None = None) -> None:
    """Keyed upsert of the first row of each key by ``order_by`` (a total order,
    e.g. load time, file, position): a stateful minimum kept in the target."""
    def write(batch: DataFrame, batch_id: int) -> None:
        snapshots.merge_buckets(cdc.first_state(batch, keys, order_by, columns), batch_id, target, keys,
                                f"{checkpoint.rstrip('/')}/_staging", F.min, buckets)

    _run_batches(stream, write, checkpoint, rules)


def upsert_scd1(stream: DataFrame, keys: list[str], sequence_by: list[str], columns: list[str],
                target: str, checkpoint: str, ignore_null_updates: bool = True,
                buckets: int | None = snapshots.DEFAULT_BUCKETS, bucket_by: list[str] | None = None,
                rules: BatchRules | None = None, touched: Callable[[SparkSession, list[int], int], None] | None = None) -> None:
    """Keyed upsert into ``target``.  ``touched(spark, buckets, batch_id)`` is
    told what each batch has rewritten, once it is in the target."""
    def write(batch: DataFrame, batch_id: int) -> None:
        found = snapshots.merge_buckets(cdc.latest_state(batch, keys, sequence_by, columns, ignore_null_updates),
                                        batch_id, target, keys, f"{checkpoint.rstrip('/')}/_staging", F.max,
                                        buckets, bucket_by)
        if touched:
            touched(batch.sparkSession, found, batch_id)

    _run_batches(stream, write, checkpoint, rules)
