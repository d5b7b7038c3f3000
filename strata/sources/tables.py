"""The given parquet tables (one file or directory per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Declared schemas of the given tables.  Declaring them spares
# the footer-reading job that schema inference runs on every read.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
}

# A table smaller than this is never worth an extra exchange.
SPREAD_MIN_BYTES = 4 << 20


def _bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def read_table(spark: SparkSession, src_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read one table.  A parquet file is split by row group; a sizeable table
    stored as a few large row groups would be scanned -- and everything up to
    the first shuffle computed -- by a few tasks.  When such a scan yields
    fewer splits than the cluster has cores, spread the rows over all cores
    by a hash of the leading key columns (deterministic on retry, no sort
    needed; column pruning and filters still reach the scan, below the
    exchange).  Small tables, and large tables (which have many splits), are
    read as is."""
    path = f"{src_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(path)
    if spread:
        # Split count first (planned from the scan's own file index, which the
        # query reuses); the size listing only runs for tables with few splits.
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores and _bytes(spark, path) >= SPREAD_MIN_BYTES:
            df = df.repartition(cores, *df.columns[:2])
    return df
