"""Keyed upserts (slowly changing dimension, type 1) as batch aggregates.

A change feed with a sequence column is folded to its latest state per key.
With ``ignore_null_updates`` every column keeps the value of the latest change
in which it was not NULL; otherwise the whole latest row wins.  Both are
``max_by`` aggregates, which combine map-side, so hot keys do not pile up in
one task, and the result does not depend on batch boundaries or arrival order.

For targets that are merged batch by batch the same folds exist as *states*:
a value next to the sequence it was set at.  States of one key combine by a
maximum (``latest``) or minimum (``first``) of structs, which is associative,
commutative and idempotent: any split of the changes into batches, any order
of the batches and any replay give the state of all changes at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sequence_struct(sequence_by: list[str] | str) -> Column:
    cols = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    return F.struct(*[F.col(c) for c in cols])


def scd1(changes: DataFrame, keys: list[str], sequence_by: list[str] | str,
         ignore_null_updates: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Latest state per key.  ``sequence_by`` must be a total order within a
    key (add tie-breakers such as file name / position)."""
    seq = sequence_struct(sequence_by)
    cols = columns or [c for c in changes.columns if c not in keys]
    if ignore_null_updates:
        # max_by skips rows whose ordering is NULL: a NULL value never wins.
        aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), seq)).alias(c) for c in cols]
        return changes.groupBy(*keys).agg(*aggs).select(*keys, *cols)
    row = F.struct(*[F.col(c) for c in cols])
    latest = changes.groupBy(*keys).agg(F.max_by(row, seq).alias("_latest"))
    return latest.select(*keys, *[F.col("_latest")[c].alias(c) for c in cols])


STATE = "_state"


def latest_state(changes: DataFrame, keys: list[str], sequence_by: list[str] | str, columns: list[str],
                 ignore_null_updates: bool = True) -> DataFrame:
    """One row per key of ``changes``: the keys and ``_state``, for every column
    the sequence and value of its latest change (not NULL, if those are
    ignored), or sequence and values of the latest row.  Changes of one sequence
    are settled by the greater value."""
    seq = sequence_struct(sequence_by).alias("at")
    if ignore_null_updates:
        state = F.struct(*[F.when(F.col(c).isNotNull(), F.struct(seq, F.col(c).alias("value"))).alias(c) for c in columns])
    else:
        state = F.struct(seq, F.struct(*columns).alias("value"))
    return fold(changes.select(*keys, state.alias(STATE)), keys)


def first_state(changes: DataFrame, keys: list[str], order_by: list[str], columns: list[str]) -> DataFrame:
    """One row per key: the keys and ``_state``, order terms and values of its
    first row.  Rows of one order are settled by the lesser values."""
    state = F.struct(sequence_struct(order_by).alias("at"), F.struct(*columns).alias("value"))
    return fold(changes.select(*keys, state.alias(STATE)), keys, F.min)


def _per_column(states: DataFrame) -> bool:
    return states.schema[STATE].dataType.names != ["at", "value"]


def fold(states: DataFrame, keys: list[str], pick=F.max) -> DataFrame:
    """States of equal keys combined into one (partial aggregation first)."""
    if not _per_column(states):
        return states.groupBy(*keys).agg(pick(STATE).alias(STATE))
    names = states.schema[STATE].dataType.names
    folded = states.groupBy(*keys).agg(*[pick(F.col(STATE)[c]).alias(f"{STATE}_{c}") for c in names])
    return folded.select(*keys, F.struct(*[F.col(f"{STATE}_{c}").alias(c) for c in names]).alias(STATE))


def values(states: DataFrame) -> DataFrame:
    """The current rows that the states stand for."""
    others = [c for c in states.columns if c != STATE]
    if not _per_column(states):
        return states.select(*others, f"{STATE}.value.*")
    names = states.schema[STATE].dataType.names
    return states.select(*others, *[F.col(STATE)[c]["value"].alias(c) for c in names])
