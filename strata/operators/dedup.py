"""Deterministic drop-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import By, order_struct


def keep_first(df: DataFrame, keys: list[str], order: list[By]) -> DataFrame:
    """One row per ``keys``: the first by ``order``, remaining ties broken by
    every other column (so the survivor never depends on input order).

    Plan: SortAggregate(partial) -> Exchange(keys) -> SortAggregate(final): the
    buffer is a struct, so each side sorts by key first, but rows collapse before
    the shuffle; the struct carries the whole row, so no join back is needed.
    """
    payload = [c for c in df.columns if c not in keys]
    winner = order_struct(df.schema, order, payload)
    out = df.groupBy(*keys).agg(F.min(winner).alias("_first"))
    return out.select(*keys, *[F.col("_first")[c].alias(c) for c in payload]).select(*df.columns)
