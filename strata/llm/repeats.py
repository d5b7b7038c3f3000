"""Suffix-array dedup: repeated byte strings by prefix-free parsing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pfp
from .common import deal_join, map_arrow, release, stage, whole_groups

SIZE = 200                 # bytes of a repeated string
HOT = 20_000               # different phrases round one anchor from which its windows are dealt out singly
U = np.uint64


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, dk, d2, raw): a text's bytes and 96 bits that stand for it."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", raw.alias("raw")).select("doc_id", F.xxhash64("raw").alias("dk"),
                                                           F.hash("raw").alias("d2"), "raw")


def _parse(size: int):
    """Phrases: (dk, d2, anchor, phrase, first, last, at) per trigger."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dk, d2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            # Copies in a batch give the same rows: one will do.
            _, one = np.unique(np.stack([dk, d2.astype(np.int64)]), axis=1, return_index=True)
            once = np.zeros(len(dk), bool)
            once[one] = True
            raws = (x.as_py() if ok else None for x, ok in zip(b.column(2), once))
            for buf, doc, origin, ends, valid in pfp.chunks(raws, size):
                t, first, last, anchor, full = pfp.triggers(buf, valid, size)
                if not len(t):
                    continue
                part = np.searchsorted(ends, first, "right")
                at = doc[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(dk[at]), pa.array(d2[at]), pa.array(anchor.view(np.int64)), pa.array(full.view(np.int64)),
                     pa.array((first + origin[part]).astype(np.int32)), pa.array((last - first).astype(np.int16)),
                     pa.array((t - first).astype(np.int16))], ["dk", "d2", "anchor", "phrase", "first", "more", "turn"])
    return run


_PHRASE_DDL = "dk bigint, d2 int, anchor bigint, phrase bigint, first int, more smallint, turn smallint"


def _contexts(size: int):
    """Bytes of the wanted phrases of every text; those of a hot anchor as their
    single windows.  A task does so once for all copies of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cell", "hot", "dk", "d2", "first", "more", "turn", "single", "body"]
        done = set()
        for b in batches:
            out = {k: [] for k in names}
            texts = zip(b.column("dk").to_pylist(), b.column("d2").to_pylist(), b.column("raw"), b.column("want"))
            for dk, d2, raw, want in texts:
                if (dk, d2) in done:
                    continue
                done.add((dk, d2))
                raw = raw.as_py()
                for w in want.as_py():
                    body = raw[w["first"]:w["first"] + w["more"] + size]
                    if not w["hot"]:
                        rows = [(w["anchor"], w["first"], w["more"], w["turn"], body)]
                    else:
                        buf = np.frombuffer(body, np.uint8)
                        p = np.arange(w["more"] + 1)
                        h = pfp.mix(pfp.Hashes(buf, pfp.BASE_1).at(p, size) + U(w["anchor"] & pfp.MASK)).view(np.int64).tolist()
                        rows = [(h[i], w["first"] + i, 0, 0, None) for i in range(len(h))]
                    for cell, first, more, turn, x in rows:
                        for k, v in zip(names, (cell, w["hot"], dk, d2, first, more, turn, w["single"], x)):
                            out[k].append(v)
            if out["cell"]:
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                    [("cell", pa.int64()), ("hot", pa.bool_()), ("dk", pa.int64()), ("d2", pa.int32()),
                     ("first", pa.int32()), ("more", pa.int32()), ("turn", pa.int32()), ("single", pa.bool_()),
                     ("body", pa.binary())]))
    return run


_CONTEXT_DDL = ("cell bigint, hot boolean, dk bigint, d2 int, first int, more int, turn int, single boolean, "
                "body binary")
_RANGE_DDL = "dk bigint, d2 int, start int, stop int"


def _compare(size: int):
    """Windows that stand in two phrases of an anchor, as byte ranges of the
    phrases that occur only once as a whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, "cell"):
            dk, d2 = rows.column("dk").to_numpy(), rows.column("d2").to_numpy()
            first, more = rows.column("first").to_numpy(), rows.column("more").to_numpy()
            turn = rows.column("turn").to_numpy()
            single = rows.column("single").to_numpy()
            group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            # The same place twice (a row repeated in the table) is one.
            place = np.stack([group, dk, d2.astype(np.int64), first.astype(np.int64)])
            one = np.sort(np.unique(place, axis=1, return_index=True)[1])
            bodies = rows.column("body").take(pa.array(one)).combine_chunks()
            buf = np.frombuffer(b"".join(bodies.to_pylist()), np.uint8)
            n = more[one].astype(np.int64) + 1
            begin = np.concatenate([[0], np.cumsum(n + size - 1)])[:-1]
            row = np.repeat(np.arange(len(one)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            rank = pfp.suffix_ranks(buf, size)[begin[row] + nth]
            turns = turn[one][row] - nth
            # Equal strings of a group, equally far from the trigger, are neighbours in this order.
            order = np.lexsort((rank, turns, group[one][row]))
            same = np.ones(len(order) - 1, bool)
            for x in (rank, turns, group[one][row]):
                same &= x[order[1:]] == x[order[:-1]]
            again = np.zeros(len(order), bool)
            again[order[1:]] |= same
            again[order[:-1]] |= same
            hit = again & single[one][row]
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (row[at[1:]] != row[at[:-1]]) | (at[1:] != at[:-1] + 1)
            i = np.flatnonzero(new)
            a, z = at[i], at[np.append(i[1:], len(at)) - 1]
            src = one[row[a]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(dk[src]), pa.array(d2[src]), pa.array((first[src] + nth[a]).astype(np.int32)),
                 pa.array((first[src] + nth[z] + size).astype(np.int32))], ["dk", "d2", "start", "stop"])
    return run


def repeated_ranges(docs: DataFrame, size: int = SIZE, hot: int = HOT) -> DataFrame:
    """(dk, d2, start, stop): byte ranges of texts that strings of ``size``
    bytes cover which start at another place too.

    Prefix-free parsing: rolling-hash triggers cut every text into overlapping
    phrases, such that each string of ``size`` bytes lies in the one phrase of
    its trigger, and equal strings lie at the same place of phrases with the
    same anchor (the bytes right of the trigger that all its strings share).

    1. Anchors that stand in one place only drop out, with their phrases.
    2. A phrase that stands in two places is the dictionary entry of both:
       everything in it is repeated.
    3. What is left are phrases that differ at an end.  Within an anchor they,
       and one representative of each repeated phrase, are put in suffix order;
       strings that are neighbours in it, equal in all bytes and equally far
       from the trigger, are repeated.  As a string never leaves its phrase, the
       dictionary's suffix order alone settles it, and the parse need only say
       where each phrase stands.

    Steps 1 and 2 are aggregations of hashes; only step 3 reads bytes, of few
    phrases.  Anchors and phrases that stand in very many places are dealt over
    several tasks.  An anchor with more than ``hot`` different phrases is not
    sorted in one task: its strings are counted one by one, by their hash."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    phrases = stage(map_arrow(keyed.select("dk", "d2", "raw"), _parse(size), _PHRASE_DDL), "pfp-parse")
    place = F.xxhash64("dk", "d2", "first")
    anchors = (phrases.groupBy("anchor").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n"))
               .where("lo <> hi").select("anchor", "n"))
    common = stage(deal_join(phrases, stage(anchors, "pfp-anchors"), ["anchor"]), "pfp-phrases")

    entries = (common.groupBy("anchor", "phrase")
               .agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n")))
    entries = stage(entries, "pfp-dictionary")
    per = (entries.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if(F.col("lo") == F.col("hi")).alias("singles"))
           .where("n > 1 and singles > 0").select("anchor", "n", (F.col("n") > hot).alias("hot")))
    per = stage(per, "pfp-open")
    whole = (deal_join(common, entries.where("lo <> hi").select("anchor", "phrase", "n"), ["anchor", "phrase"])
             .select("dk", "d2", F.col("first").alias("start"), (F.col("first") + F.col("more") + size).alias("stop"))
             .distinct())
    open_ = deal_join(entries.withColumnRenamed("n", "rows"), per, ["anchor"]).select(
        "anchor", "phrase", "lo", (F.col("lo") == F.col("hi")).alias("single"), "hot", F.col("rows").alias("n"))
    wanted = (deal_join(common, stage(open_, "pfp-open-phrases"), ["anchor", "phrase"]).where(place == F.col("lo"))
              .dropDuplicates(["anchor", "dk", "d2", "first"])
              .groupBy("dk", "d2").agg(F.collect_list(F.struct("anchor", "first", "more", "turn", "single", "hot"))
                                       .alias("want")))
    wanted = stage(wanted, "pfp-wanted")
    bodies = map_arrow(keyed.select("dk", "d2", "raw").join(wanted, ["dk", "d2"]), _contexts(size), _CONTEXT_DDL)
    any_hot = not per.where("hot").isEmpty()
    if any_hot:
        bodies = stage(bodies, "pfp-bodies")
    cells = bodies.where("not hot").drop("hot").repartition("cell").sortWithinPartitions("cell")
    ranges = map_arrow(cells, _compare(size), _RANGE_DDL)
    if any_hot:
        windows = bodies.where("hot")
        twice = (windows.groupBy("cell").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n"))
                 .where("lo <> hi").select("cell", "n"))
        ranges = ranges.unionByName(deal_join(windows.where("single"), stage(twice, "pfp-twice"), ["cell"]).select(
            "dk", "d2", F.col("first").alias("start"), (F.col("first") + size).alias("stop")))
    ranges = stage(ranges, "pfp-ranges").unionByName(whole)
    release(spark)
    return ranges


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges (dk, d2, start, stop) that overlap or touch within a text, joined:
    a long periodic text, covered by as many ranges as it has triggers, comes
    down to a few before they are gathered in one row."""
    text = Window.partitionBy("dk", "d2").orderBy("start", "stop")
    so_far = F.max("stop").over(text.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.withColumn("opens", F.when(F.col("start") <= so_far, 0).otherwise(1))
    run = opened.withColumn("run", F.sum("opens").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("dk", "d2", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def _cut():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw, spans, copies in zip(*(b.column(k).to_pylist() for k in ("raw", "spans", "whole"))):
                runs: list[list[int]] = []
                for s in sorted((s["start"], s["stop"]) for s in ([{"start": 0, "stop": len(raw)}] if copies else spans or [])):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                kept, at = hashlib.sha256(), 0
                for start, stop in runs:
                    kept.update(raw[at:start])
                    at = stop
                kept.update(raw[at:])
                out.append((len(raw), sum(z - a for a, z in runs), len(runs), kept.hexdigest(), [x for r in runs for x in r]))
            n, gone, count, sha, flat = zip(*out) if out else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(flat, pa.list_(pa.int64()))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
    return run


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Remove every byte covered by a string of ``size`` bytes that also starts
    anywhere else in the table, the same text included.

    (doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans): one row per input
    row; spans holds start and end of every maximal removed run.  Texts are
    UTF-8 bytes; null and empty texts, and those shorter than ``size``, lose
    nothing, and strings never cross texts.  A text of ``size`` bytes or more
    that another row repeats goes whole, also when doc_id is repeated or null.
    An empty table gives an empty result."""
    keyed = _keyed(docs)
    copies = (keyed.groupBy("dk", "d2").agg(F.count("*").alias("n"), F.max(F.octet_length("raw")).alias("bytes"))
              .where((F.col("n") > 1) & (F.col("bytes") >= size)).select("dk", "d2", F.lit(True).alias("whole")))
    spans = (merged_ranges(repeated_ranges(docs, size)).groupBy("dk", "d2")
             .agg(F.collect_list(F.struct("start", "stop")).alias("spans")))
    found = stage(spans.join(copies, ["dk", "d2"], "full")
                  .select("dk", "d2", "spans", F.coalesce("whole", F.lit(False)).alias("whole")), "pfp-found")
    rows = keyed.join(found, ["dk", "d2"], "left").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "raw", F.when(~F.col("whole"), F.col("spans")).alias("spans"),
        F.coalesce("whole", F.lit(False)).alias("whole"))
    return map_arrow(rows, _cut(), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                             "kept_sha256 string, spans array<bigint>")
