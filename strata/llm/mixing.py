"""Mixing sources to target weights: weighted fair queueing (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stage, text_key

WEIGHTS = (5, 2, 1)        # cycled over the sources in code-point order, null last
MAX_COPIES = 3             # a document is taken at most so often
HASH_DIGITS = 2            # a source is ordered within 16 ** HASH_DIGITS ranges of the hash
TIME_RANGES = 4096         # ranges of one unit of virtual time


def _sizes(docs: DataFrame) -> DataFrame:
    """(id, ord, source, size): size in words; ord shuffles the documents."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"), order.alias("ord"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target): one row per source.

    The total of all sizes is shared by weight; a target stops at
    ``max_copies`` times its source and the excess is shared again, until none
    is above.  That fixed point is a water level: sources sorted by cap over
    weight are full up to some place and the others get ``weight * level``."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * max_copies)
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    level = ((F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / (F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"))
    per = per.withColumn("level", level)
    # The first source (in that order) whose cap reaches its level sets the water level.
    open_ = F.min(F.when(F.col("cap") >= F.col("weight") * F.col("level"),
                         F.struct((F.col("cap") / F.col("weight")).alias("r"),
                                  F.col("source").isNull().alias("nul"), F.col("source").alias("s"),
                                  F.col("level").alias("level")))).over(everywhere)
    return per.select("source", "source_size",
                      F.least(F.col("cap").cast("double"),
                              F.coalesce(F.col("weight") * open_["level"], F.col("cap").cast("double"))).alias("target"))


def fair_mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES,
             hash_digits: int = HASH_DIGITS, time_ranges: int = TIME_RANGES) -> DataFrame:
    """How often each document of a weighted mix is taken.

    Every source's documents are shuffled (ordered by the md5 of doc_id) and
    read up to ``max_copies`` times over.  Copy e of a document finishes at
    virtual time ``(e * source_size + running size) / target``; the copies of
    all sources, sorted by it, are taken while their running total stays within
    the budget, the size of all documents.  Neither sort needs one task: a
    source's documents are ordered within ranges of the (uniform) hash whose
    totals are added up first, so a source with a third of all rows is spread
    over its ranges; and the global order is cut by ranges of virtual time, each
    of which serves about the same total, so that only the range that holds the
    cut is sorted.  Only the budget and the cut itself reach the driver.

    Returns (doc_id, source, key, size, source_size, target, copies, taken), one
    row per input row; key is the md5 of the text.  A null text has size 0; a null source is a source of its own;
    an empty document is never taken.  Rows with the same doc_id, size and
    source may swap places, which leaves the result as a whole the same.
    An empty table gives an empty result.  Other columns are not read."""
    sizes = stage(_sizes(docs.select("doc_id", "text", "source")), "mix-sizes")
    goal = stage(targets(sizes, weights, max_copies), "mix-targets")

    d = sizes.withColumn("range", F.substring("ord", 1, hash_digits))
    ranges = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (d.groupBy("source", "range").agg(F.sum("size").alias("n"))
               .select("source", "range", F.coalesce(F.sum("n").over(ranges), F.lit(0)).alias("offset")))
    inside = (Window.partitionBy("source", "range").orderBy("ord", F.col("id").asc_nulls_first(), "size", "key")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d, o, g = d.withColumn("upto", F.sum("size").over(inside)).alias("d"), offsets.alias("o"), goal.alias("g")
    d = stage(
        d.join(o, F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.range") == F.col("o.range")))
        .join(g, F.col("d.source").eqNullSafe(F.col("g.source")))
        .select("d.id", "d.key", "d.source", "d.size", "g.source_size", "g.target",
                (F.col("o.offset") + F.col("d.upto")).alias("upto")), "mix-order")

    def finish(e):
        """Where copy e stands in the global order (a total order: documents of
        one source never finish together)."""
        return F.struct(((e * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")).alias("time"),
                        F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("name"))

    live = d.where("size > 0 and target > 0")
    copies = (live.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))))
              .select("size", finish(F.col("copy")).alias("at"))
              .withColumn("bin", F.least(F.floor(F.col("at.time") * time_ranges), F.lit(4 * time_ranges)).cast("long")))
    bins = copies.groupBy("bin").agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.orderBy("bin"))
    budget = goal.agg(F.sum("source_size")).first()[0] or 0
    full = (bins.select("bin", "n", upto.alias("upto")).where(F.col("upto") > budget)
            .orderBy("bin").select("bin", (F.col("upto") - F.col("n")).alias("before")).first())
    if full is None:
        taken = F.lit(max_copies)
    else:
        last = (copies.where(F.col("bin") == full["bin"])
                .select("at", F.sum("size").over(Window.orderBy("at").rowsBetween(
                    Window.unboundedPreceding, Window.currentRow)).alias("upto"))
                .where(F.col("upto") + full["before"] <= budget).agg(F.max("at").alias("at")).first()["at"])
        if last is None:
            in_time = lambda e: F.floor(finish(e)["time"] * time_ranges) < full["bin"]
        else:
            cut = F.struct(F.lit(float(last["time"])), F.lit(last["last"]), F.lit(last["name"]))
            in_time = lambda e: finish(e) <= cut
        taken = F.size(F.filter(F.sequence(F.lit(0), F.lit(max_copies - 1)), in_time))
    n = F.when(F.expr("size > 0 and target > 0"), taken).otherwise(0)
    return d.select(F.col("id").alias("doc_id"), "source", "key", "size", "source_size", "target",
                    n.cast("int").alias("copies"), (n * F.col("size")).cast("long").alias("taken"))


def oracle_sql(weights=WEIGHTS, max_copies: int = MAX_COPIES) -> str:
    """The same mix in DuckDB SQL: both sorts as plain global windows."""
    cases = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH d AS (
  SELECT doc_id, source, text, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(weights)} {cases} END AS weight,
             {max_copies} * source_size AS cap FROM s),
l AS (SELECT *, cap / weight AS r,
             CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS DOUBLE)
             / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS DOUBLE) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT level AS water FROM l WHERE cap >= weight * level ORDER BY r, source ASC NULLS LAST LIMIT 1),
g AS (SELECT source, source_size,
             least(CAST(cap AS DOUBLE), coalesce(weight * (SELECT water FROM v), CAST(cap AS DOUBLE))) AS target FROM l),
u AS (SELECT d.*, source_size, target,
             sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id ASC NULLS FIRST, size, unhex(md5(coalesce(text, '')))
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             row_number() OVER () AS rid
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT rid, size, sum(size) OVER (ORDER BY CAST(copy * source_size + upto AS DOUBLE) / target, source IS NULL,
                                        coalesce(source, '')
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM u, (SELECT unnest(range({max_copies})) AS copy) WHERE size > 0 AND target > 0),
n AS (SELECT rid, count(*) AS copies FROM c WHERE run <= (SELECT sum(size) FROM d) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(coalesce(copies, 0) AS INTEGER) AS copies,
       CAST(coalesce(copies, 0) * size AS BIGINT) AS taken
FROM u LEFT JOIN n USING (rid)"""


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row as often as the mix takes it, with the
    columns of ``docs``.  Rows that agree in doc_id, source and text count as
    one document that is taken as often as they are together."""
    key, copies, i, s, k = fresh(docs, "mix_key", "mix_copies", "mix_id", "mix_source", "mix_text")
    plan = (fair_mix(docs, **options).groupBy("doc_id", "source", "key").agg(F.sum("copies").alias(copies))
            .where(F.col(copies) > 0)
            .select(F.col("doc_id").alias(i), F.col("source").alias(s), F.col("key").alias(k), copies))
    rows = docs.withColumn(key, text_key(docs["text"]))
    return (rows.join(plan, rows["doc_id"].eqNullSafe(plan[i]) & rows["source"].cast("string").eqNullSafe(plan[s])
                      & (rows[key] == plan[k]))
            .dropDuplicates([i, s, k])
            .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
            .select(*docs.columns))
