"""Ranked lexical search: dense blocked matrix products in exact integers.

Document impacts of a tile of the items' vocabulary, as float64 rows, times the
items' weights of the same tile: every partial sum is an integer below 2^53, so
float64 holds it exactly.  Tiles add up in 64-bit integers; every task keeps a
tie-safe top k of each item."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, release, text_key
from ..session import scratch_path

TOP = 10
ITEM_TERMS = 200_000       # terms of items, repeats included, in one pass over the documents
TILE_DOCS = 1024           # documents of a tile ...
TILE_TERMS = 1024          # ... and terms of the vocabulary
_EXACT = 1 << 53
_IMPACT = 1_000_000        # an impact is below this
# Bytes of terms as themselves, in lower case; all others end a term.
_TERM = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The maximal runs of ASCII letters and digits and non-ASCII characters,
    A-Z lower-cased."""
    return raw.translate(_TERM).lower().split(b" ") if raw else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """Items as rows of counts over their own vocabulary."""

    def __init__(self, texts: list[str]):
        self.vocab: dict[bytes, int] = {}
        self.rows = []
        for text in texts:
            row: dict[int, int] = {}
            for t in filter(None, terms(text.encode("utf-8", "surrogatepass"))):
                at = self.vocab.setdefault(t, len(self.vocab))
                row[at] = row.get(at, 0) + 1
            self.rows.append(row)


_COUNTED = "doc_id bigint, n bigint, terms binary, tfs binary, df binary, docs bigint, all_terms bigint"


def _count_terms(vocab):
    """Per document its number of terms and the counts of those of the vocabulary
    (documents with none of them are counted only); per task, in its last row,
    document frequencies and totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = vocab.value, [c.split()[0] for c in _COUNTED.split(", ")]
        df, docs, total = np.zeros(len(known), np.int64), 0, 0

        def rows(ids, n, t, f, d, *sums):
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(t, pa.binary()), pa.array(f, pa.binary()),
                 pa.array(d, pa.binary()), *(pa.array(s, pa.int64()) for s in sums)], names)
        for b in batches:
            ids, n, t, f = [], [], [], []
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if not raw:
                    continue
                words = terms(raw)
                count = len(words) - words.count(b"")
                if not count:
                    continue
                docs, total = docs + 1, total + count
                at = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
                at, tf = np.unique(at[at >= 0], return_counts=True)
                if len(at):
                    df[at] += 1
                    ids.append(doc_id)
                    n.append(count)
                    t.append(at.astype("<u4").tobytes())
                    f.append(tf.astype("<u4").tobytes())
            none = [None] * len(ids)
            yield rows(ids, n, t, f, none, none, none)
        if docs:
            yield rows([None], [None], [None], [None], [df.tobytes()], [docs], [total])
    return run


def _sum_df(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for raw in b.column(0).to_pylist():
            n = np.frombuffer(raw, np.int64)
            total = n if total is None else total + n
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["term", "df"])


class Tiles:
    """The items' weights (count times weight of the term), cut into tiles of
    the vocabulary in which no item's partial sum can reach 2^53."""

    def __init__(self, items: Items, df: np.ndarray, n_docs: int, all_terms: int, tile: int = TILE_TERMS):
        self.n_docs, self.all_terms, self.items = n_docs, all_terms, len(items.rows)
        w = np.array([weight(n_docs, int(x)) for x in df], np.int64)
        item = np.array([i for i, r in enumerate(items.rows) for _ in r], np.int64)
        term = np.array([t for r in items.rows for t in r], np.int64)
        q = np.array([c for r in items.rows for c in r.values()], np.int64)
        # Terms of many items first: the tiles of the rest meet few documents.
        self.place = np.empty(len(df), np.int64)
        self.place[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
        most = np.zeros(len(df), np.int64)                          # of a term's share in any item's sum
        np.maximum.at(most, self.place[term], q * w[term] * _IMPACT)
        self.cuts, held = [0], 0
        for at, m in enumerate(most.tolist()):
            if at - self.cuts[-1] >= tile or held + m >= _EXACT:
                self.cuts.append(at)
                held = 0
            held += m
        self.cuts.append(len(df))
        order = np.argsort(self.place[term], kind="stable")
        self.term, self.item, self.value = self.place[term][order], item[order], (q * w[term])[order]
        # Two numbers whose product alone passes 2^53 would need more than 9 million repeats in one item.
        if len(most) and most.max() >= _EXACT:
            raise ValueError("an item repeats one term millions of times")

    def weights(self, k: int) -> np.ndarray:
        """Weights of tile k: terms x items."""
        a, b = self.cuts[k], self.cuts[k + 1]
        lo, hi = np.searchsorted(self.term, [a, b])
        out = np.zeros((b - a, self.items))
        out[self.term[lo:hi] - a, self.item[lo:hi]] = self.value[lo:hi]
        return out

    def impacts(self, n: np.ndarray, doc: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Impact of each occurrence list, in 64-bit integers."""
        # n N may pass 64 bits on very large corpora: Python integers there.
        if self.n_docs and int(n.max(initial=0)) < (1 << 62) // (75 * self.n_docs):
            long = (75 * n * self.n_docs) // self.all_terms
        else:
            long = np.array([75 * int(x) * self.n_docs // self.all_terms for x in n], np.int64)
        m = 25 + long
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])

    def scores(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Scores (documents x items) of a tile of documents: occurrences
        (doc, term, tf) with documents numbered from 0."""
        out = np.zeros((len(n), self.items), np.int64)
        place, impact = self.place[term], self.impacts(n, doc, tf)
        order = np.argsort(place, kind="stable")
        place, doc, impact = place[order], doc[order], impact[order]
        at = np.searchsorted(place, self.cuts)
        for k, (lo, hi) in enumerate(zip(at[:-1], at[1:])):
            if lo == hi:
                continue
            here, col = np.unique(place[lo:hi] - self.cuts[k], return_inverse=True)     # only terms that occur
            who, row = np.unique(doc[lo:hi], return_inverse=True)
            dense = np.zeros((len(who), len(here)))
            dense[row, col] = impact[lo:hi]
            out[who] += (dense @ self.weights(k)[here]).astype(np.int64)
        return out


_FOUND = "item int, doc_id bigint, score bigint"


def _best(tiles, top: int):
    """The ``top`` best documents of each item in a task: higher scores, then
    lower ids (null last), ties at the border kept by id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Tiles = tiles.value
        best = [np.empty((0, 3), np.int64) for _ in range(t.items)]      # -score, id is null, id
        floor = np.zeros(t.items, np.int64)                              # least score that can still enter
        for b in batches:
            for first in range(0, b.num_rows, TILE_DOCS):
                part = b.slice(first, TILE_DOCS)
                null = ~part.column(0).is_valid().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy()
                n = part.column(1).to_numpy()
                raw, freq = part.column(2).to_pylist(), part.column(3).to_pylist()
                doc = np.repeat(np.arange(len(n)), [len(r) // 4 for r in raw])
                term = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
                tf = np.frombuffer(b"".join(freq), "<u4").astype(np.int64)
                scores = t.scores(n, doc, term, tf)
                enter = (scores >= np.maximum(floor, 1)).T
                for i in np.flatnonzero(enter.any(1)):
                    at = np.flatnonzero(enter[i])
                    if len(at) > 4 * top:                                # only ties of the border and better
                        edge = np.partition(scores[at, i], len(at) - top)[len(at) - top]
                        at = at[scores[at, i] >= edge]
                    rows = np.concatenate([best[i], np.stack([-scores[at, i], null[at].astype(np.int64), ids[at]], 1)])
                    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))[:top]]
                    best[i] = rows
                    if len(rows) == top:
                        floor[i] = -rows[-1, 0]
        rows = np.concatenate([best[i] for i in range(t.items)]) if t.items else np.empty((0, 3), np.int64)
        who = np.repeat(np.arange(t.items, dtype=np.int32), [len(x) for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(rows[:, 2], mask=rows[:, 1] == 1), pa.array(-rows[:, 0])],
                                         ["item", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_terms: int = ITEM_TERMS) -> DataFrame:
    """The ``top`` best documents (doc_id, text) of every item (item_id, text):
    item_id, rank, doc_id, score, by falling score and then rising doc_id (null
    ids last); only scores above 0.

    Texts are read once: counts of the items' terms wait in shared storage until
    document frequencies and lengths, summed per task, have given the weights.
    Nothing is shuffled but each task's best.  The items' vocabulary is sent to
    all tasks; ``item_terms`` bounds it: a larger set of items is cut into parts
    of at most about that many terms, each a pass over the documents.

    Null and empty texts and texts without a term are no documents; such items
    have no rows.  Rows of one item_id are items of their own; rows of one
    doc_id are documents of their own, and equal rows of a result are ties in
    any order.  A null id is an id like any other.  Empty tables give no rows."""
    spark = docs.sparkSession
    rows = (items.where("text is not null")
            .select(F.col("item_id").cast("bigint").alias("item_id"), "text", F.octet_length("text").alias("size")))
    total = rows.agg(F.sum(F.col("size"))).first()[0] or 0
    passes = max(1, -(-int(total) // (2 * item_terms)))            # a term takes two bytes at least, with its end
    out = None
    for p in range(passes):
        mine = rows.where(F.pmod(F.conv(F.substring(F.hex(text_key(F.col("text"))), 1, 8), 16, 10).cast("bigint"),
                                 F.lit(passes)) == p).collect()    # bounded by item_terms
        found = _search_part(docs, [r["item_id"] for r in mine], Items([r["text"] for r in mine]), top)
        out = found if out is None else out.unionByName(found)
    return out


def _search_part(docs: DataFrame, ids: list, items: Items, top: int) -> DataFrame:
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    if not items.vocab:
        return empty
    path = scratch_path(spark, "lexical-counts")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    (map_arrow(texts, _count_terms(spark.sparkContext.broadcast(items.vocab)), _COUNTED)
     .write.option("compression", "zstd").parquet(path))
    release(spark)
    counted = spark.read.schema(_COUNTED).parquet(path)
    sums = counted.where("docs is not null")
    n_docs, all_terms = sums.agg(F.sum("docs"), F.sum("all_terms")).first()
    if not n_docs:
        return empty
    seen = (map_arrow(sums.select("df"), _sum_df, "term bigint, df bigint")
            .groupBy("term").agg(F.sum("df").alias("df")).toPandas())                    # a row per term of the items
    df = np.zeros(len(items.vocab), np.int64)
    df[seen["term"].to_numpy(np.int64)] = seen["df"].to_numpy(np.int64)
    tiles = spark.sparkContext.broadcast(Tiles(items, df, int(n_docs), int(all_terms)))
    best = map_arrow(counted.where("n is not null").select("doc_id", "n", "terms", "tfs"), _best(tiles, top), _FOUND)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id bigint")      # bounded by item_terms
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


# Every document's score for every item, term by term.
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY doc_id),
g AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS l FROM n),
f AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, g GROUP BY term),
s AS (SELECT i.item_id, f.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l)))) AS BIGINT) AS score
      FROM i JOIN f USING (term) JOIN w USING (term) JOIN n USING (doc_id), g GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
