"""Dimension lookups with a size-checked broadcast.

A dimension is broadcast only when its size in bytes has been measured and is
under a bound.  Beyond it ``lookup_key`` joins by a shuffle that no key can
overload: rows with a NULL key, which match nothing, are spread over all tasks,
and a key that holds more than one in ``HOT_KEYS`` rows is dealt over as many
parts as it holds such shares.  ``lookup`` leaves the join to the planner
(sort-merge, or AQE's runtime switch once the real shuffle size is known).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

# A dimension up to this many bytes is shipped to every executor.
BROADCAST_MAX_BYTES = 64 << 20
# A key with more than one in HOT_KEYS of all rows is dealt over several tasks.
HOT_KEYS = 1000


@dataclass
class Dim:
    """A dimension DataFrame with its measured rows and bytes (None: unknown)."""
    df: DataFrame
    rows: int
    bytes: int | None = None

    def for_join(self, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
        small = self.bytes is not None and self.bytes <= max_bytes
        return F.broadcast(self.df) if small else self.df

    def part(self, df: DataFrame) -> "Dim":
        """``df``, made of some rows and columns of this dimension."""
        return Dim(df, self.rows, self.bytes)

    def select(self, *cols) -> "Dim":
        return self.part(self.df.select(*cols))

    def numbered(self, df: DataFrame) -> "Dim":
        """``df``, this dimension with one more number a row."""
        return Dim(df, self.rows, None if self.bytes is None else self.bytes + 8 * self.rows)


def _size(df: DataFrame) -> list[Column]:
    """Aggregates: rows and bytes (texts by their length, other values at 16)."""
    one = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            one = one + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        else:
            one = one + (F.lit(16) if isinstance(f.dataType, AtomicType)
                         else F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(one), F.lit(0)).alias("bytes")]


def measured(df: DataFrame, cache: bool = True) -> Dim:
    """Measure a (small, derived) dimension once; cache it so the count and the
    later join read the same rows without recomputing its lineage."""
    if cache:
        df = df.cache()
    got = df.agg(*_size(df)).first()
    return Dim(df, int(got["rows"]), int(got["bytes"]))


def measured_all(dfs: dict[str, DataFrame], cache: bool | set[str] = True) -> dict[str, Dim]:
    """Measure several dimensions in one job (one small row per dimension comes
    back to the driver).  ``cache`` (all, or a set of names) keeps the rows
    of costly dimensions so later joins reuse them; cheap ones derived from
    small tables are simply recomputed inside the plans that use them."""
    keep = set(dfs) if cache is True else (set() if cache is False else set(cache))
    frames = {n: (df.cache() if n in keep else df) for n, df in dfs.items()}
    sizes = reduce(DataFrame.unionByName, [
        df.agg(*_size(df)).select(F.lit(n).alias("name"), "rows", "bytes") for n, df in frames.items()])
    return {r["name"]: Dim(frames[r["name"]], int(r["rows"]), int(r["bytes"])) for r in sizes.collect()}


def lookup(fact: DataFrame, dim: Dim | DataFrame, on: str | list[str] | Column,
           how: str = "left", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    right = dim.for_join(max_bytes) if isinstance(dim, Dim) else dim
    return fact.join(right, on, how)


def hot_parts(rows: DataFrame, key: str) -> dict:
    """The keys with more than one in HOT_KEYS of the rows, fewer than HOT_KEYS
    of them, and the number of parts each is dealt over.  Two aggregations of
    the key column alone, combined before their shuffle."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = int(rows.agg(F.count(F.lit(1))).first()[0])
    hot = counts.where(F.col("_n") * HOT_KEYS > total).collect()
    return {r[0]: -(-int(r["_n"]) * HOT_KEYS // total) for r in hot}


def dealt_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Left join of ``fact`` with ``dim`` on fact_key = dim_key (the key of
    ``dim`` is dropped) by a shuffle over (key, part).  The rows of a hot key go
    to its parts by their hash, and its rows of ``dim`` to each of them; rows
    with a NULL key go anywhere.  Same rows as the plain left join: unmatched
    keys give NULLs, a key that stands twice in ``dim`` doubles its rows."""
    parts = hot_parts(fact, fact_key)
    spread = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here = F.xxhash64(*[F.col(f"`{c}`") for c, t in fact.dtypes if not t.startswith("map")], F.spark_partition_id())
    many = _map_of(parts, dict(fact.dtypes)[fact_key])
    share = lambda key: F.coalesce(F.element_at(many, key), F.lit(1)) if parts else F.lit(1)
    dealt = fact.withColumn("_part", F.when(F.col(fact_key).isNull(), F.pmod(here, F.lit(spread * 8)))
                            .otherwise(F.pmod(here, share(F.col(fact_key)))).cast("int"))
    placed = (dim.where(F.col(dim_key).isNotNull())
              .withColumn("_place", F.explode(F.sequence(F.lit(0), share(F.col(dim_key)) - 1))))
    # A NULL key never equals one of the dimension's, wherever its row went.
    joined = dealt.join(placed, (F.coalesce(F.col(fact_key).cast("string"), F.lit("")) == F.col(dim_key).cast("string"))
                        & F.col(fact_key).isNotNull() & (F.col("_part") == F.col("_place")), "left")
    return joined.drop("_part", "_place", dim_key)


def _map_of(parts: dict, key_type: str) -> Column:
    entries = [x for k, n in parts.items() for x in (F.lit(k).cast(key_type), F.lit(n))]
    return F.create_map(*entries) if entries else F.lit(None)


def lookup_key(fact: DataFrame, dim: Dim, fact_key: str, dim_key: str, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left lookup on one key (``dim_key`` must be no column of ``fact``; it is
    dropped): broadcast behind the size check, else dealt over all tasks."""
    if dim.bytes is not None and dim.bytes <= max_bytes:
        return fact.join(F.broadcast(dim.df), F.col(fact_key) == F.col(dim_key), "left").drop(dim_key)
    return dealt_lookup(fact, dim.df, fact_key, dim_key)
