"""N-gram Jaccard join: MinHash LSH forest with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (Forest, block_cells, components, fresh, map_arrow, mix, shingles, stage, text_key, whole_groups,
                     word_hashes)

SHINGLE = 5                # words
JACCARD = 0.8
TREES, DEPTH = 16, 8       # tries of the forest, hash values in a label
RECALL = 0.9995            # of pairs at the least similarity
SLACK = 0.2                # how far below the least similarity an estimate may lie
BLOCK = 512                # texts compared at once
U = np.uint64


def prefix_length(least: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Labels are matched in full first, then by ever shorter prefixes, until a
    pair of similarity ``least`` shares a prefix in some trie with probability
    ``recall``: 1 - (1 - least ** length) ** trees."""
    length = depth
    while length > 1 and 1 - (1 - least ** length) ** trees < recall:
        length -= 1
    return length


def _sign(k: int, trees: int, depth: int, length: int):
    """MinHash signatures: (key, labels: the prefix of each trie, sig: one byte
    of every hash value, in label order)."""
    rng = np.random.default_rng(20_240_229)
    a = rng.integers(1, 1 << 63, trees * depth, dtype=np.int64).astype(U) * U(2) + U(1)
    b = rng.integers(0, 1 << 63, trees * depth, dtype=np.int64).astype(U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, text = batch.column(0), batch.column(1)
            for first, n, h, offsets in word_hashes(text.to_pylist()):
                s, at = shingles(h, offsets, k)
                has = np.flatnonzero(np.diff(at))
                if not len(has):
                    continue
                low = np.empty((len(has), trees * depth), U)
                step = 1 << 16                       # shingles hashed at once, in whole texts
                lo = 0
                while lo < len(has):
                    hi = max(lo + 1, int(np.searchsorted(at[has], at[has[lo]] + step)))
                    part = s[at[has[lo]]:at[has[hi - 1] + 1]]
                    starts = at[has[lo:hi]] - at[has[lo]]
                    for i in range(trees * depth):
                        low[lo:hi, i] = np.minimum.reduceat(part * a[i] + b[i], starts)
                    lo = hi
                low = mix(low)
                labels = low.reshape(len(has), trees, depth)[:, :, :length]
                prefix = np.zeros((len(has), trees), U)
                for i in range(length):
                    prefix = mix(prefix * U(31) + labels[:, :, i] + U(i + 1))
                prefix += np.arange(trees, dtype=U) * U(0x9E3779B97F4A7C15)
                sig = (low >> U(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(first + has)),
                     pa.ListArray.from_arrays(np.arange(len(has) + 1, dtype=np.int32) * trees,
                                              prefix.view(np.int64).ravel()),
                     pa.array([x.tobytes() for x in sig], pa.binary())], ["key", "labels", "sig"])
    return run


def _candidates(least: float):
    """A spanning forest of the pairs of a trie node whose signatures agree
    enough.  Nodes are walked as in a sorted trie: the texts in order of their
    signatures, each compared with those not reached yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, "cell"):
            keys = rows.column("key").to_pylist()
            sigs = rows.column("sig").to_pylist()
            out_a, out_b = [], []
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                x = np.frombuffer(b"".join(sigs[s:e]), np.uint8).reshape(e - s, -1)
                order = np.lexsort(x.T[::-1]) if e - s > 2 else np.arange(e - s)
                x = x[order]
                need = least * x.shape[1]
                left = np.arange(e - s)
                while len(left) > 1:
                    queue, left = [left[0]], left[1:]
                    while queue and len(left):
                        i = queue.pop()
                        near = (x[left] == x[i]).sum(1) >= need
                        for j in left[near].tolist():
                            out_a.append(keys[s + order[i]])
                            out_b.append(keys[s + order[j]])
                            queue.append(j)
                        left = left[~near]
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])
    return run


def _pairs(sets: list[np.ndarray], cross: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of sets with Jaccard similarity >= least, exactly.  cross:
    each set's side; pairs of one side are left out."""
    m = len(sets)
    size = np.array([len(x) for x in sets])
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True)) \
            if size.min() >= least * size.max() and (cross is None or cross[0] != cross[1]) else 0
        hit = both > 0 and both / (size[0] + size[1] - both) >= least
        return (np.array([0]), np.array([1])) if hit else (np.empty(0, int), np.empty(0, int))
    flat = np.concatenate(sets)
    _, col = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(m), size)
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    inter = np.zeros((m, m), np.float32)
    width = 4096                                     # distinct shingles multiplied at once
    for lo in range(0, int(col[-1]) + 1, width):
        p, q = np.searchsorted(col, [lo, lo + width])
        dense = np.zeros((m, width), np.float32)
        dense[row[p:q], col[p:q] - lo] = 1
        inter += dense @ dense.T
    similar = inter >= least * (size[:, None] + size[None, :] - inter) - 1e-4
    similar = np.triu(similar, 1)
    if cross is not None:
        similar &= cross[:, None] != cross[None, :]
    i, j = np.nonzero(similar)
    both = inter[i, j].astype(np.float64)
    good = both / (size[i] + size[j] - both) >= least
    return i[good], j[good]


_FOUND = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])


def _verify(k: int, least: float):
    """Exact links within cells of candidate groups: for every text the number
    of rows it links with (b null), and a spanning forest of the links (n 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, "cell"):
            keys = rows.column("key").to_pylist()
            copies = rows.column("copies").to_numpy()
            block, other = rows.column("block").to_numpy(), rows.column("other").to_numpy()
            texts = rows.column("text")
            out_a, out_b, out_n = [], [], []
            for s, e in zip(starts[:-1], starts[1:]):
                # A row that is repeated in the table with its id comes twice.
                at = list({keys[i]: i for i in range(s, e)}.values())
                if len(at) < 2:
                    continue
                sets = []
                for _, n, h, offsets in word_hashes(texts[i].as_py() for i in at):
                    g, cut = shingles(h, offsets, k)
                    sets += [np.unique(g[cut[i]:cut[i + 1]]) for i in range(n)]
                cross = block[at] if (block[at] != other[at]).any() else None
                i, j = _pairs(sets, cross, least)
                links, forest = np.zeros(len(at), np.int64), Forest(len(at))
                np.add.at(links, i, copies[at][j])
                np.add.at(links, j, copies[at][i])
                for x, y in zip(i.tolist(), j.tolist()):
                    if forest.join(x, y):
                        out_a.append(keys[at[x]])
                        out_b.append(keys[at[y]])
                        out_n.append(0)
                for x in np.flatnonzero(links).tolist():
                    out_a.append(keys[at[x]])
                    out_b.append(None)
                    out_n.append(int(links[x]))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary()),
                                                  pa.array(out_n, pa.int64())], schema=_FOUND)
    return run


def near_texts(docs: DataFrame, least: float = JACCARD, k: int = SHINGLE, trees: int = TREES, depth: int = DEPTH,
               recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Documents whose sets of ``k``-word shingles have Jaccard similarity >=
    ``least``: (doc_id, key, class_id, n_links, kept), one row per input
    row; kept marks the row of each class with the smallest doc_id.

    * Equal texts are one node (a copy costs a counter).
    * Every text has a label of ``depth`` MinHash values in each of ``trees``
      tries; texts meet in a trie node at the prefix length that gives the target
      recall (``prefix_length``).  In a node, signatures are compared; pairs that
      agree enough (0.2 below the threshold, over five standard deviations)
      connect texts into candidate groups.
    * Within each candidate group, all pairs are verified on the whole shingle
      sets, by blocks: a large group is dealt over cells of bounded size, and
      tasks return link counts and a spanning forest, never all pairs.

    Words are runs of letters and digits, lower-cased; a text of fewer words
    than ``k`` has one shingle, all its words.  Null and empty texts, and texts
    without words, link with nothing and are their own class.  n_links counts
    the other rows linked directly, copies included; class_id is the smallest
    doc_id that is not null of the rows connected by links (null if there is
    none).  Rows with repeated doc_id are told apart by their text.  An empty
    table gives an empty result.  Other columns are not read."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key(F.col("text")).alias("key"))
    signed = stage(map_arrow(rows.select("key", "text", "doc_id"), _signed(k, trees, depth, prefix_length(
        least, trees, depth, recall)), "key binary, doc_id bigint, labels array<bigint>, sig binary"), "near-signed")
    # The rows of one text agree in labels and signature, so any of them stands for all.
    nodes = stage(signed.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"),
                                            F.first("labels").alias("labels"), F.first("sig").alias("sig")), "near-nodes")

    entries = nodes.select("key", F.explode("labels").alias("label"))
    full = entries.groupBy("label").agg(F.count("*").alias("n")).where("n > 1")
    cells = block_cells(entries, full, ["label"], F.xxhash64("key"), 2 * block).select("cell", "key")
    cells = (cells.join(nodes.select("key", "sig"), "key").repartition("cell").sortWithinPartitions("cell"))
    near = stage(map_arrow(cells, _candidates(max(0.0, least - SLACK)), "a binary, b binary"), "near-candidates")
    groups = components(near, "near-groups").withColumnRenamed("node", "key")

    members = stage(groups.join(nodes.select("key", "first_id", "copies"), "key"), "near-members")
    counts = members.groupBy("root").agg(F.count("*").alias("n"))
    dealt = block_cells(members, counts, ["root"], F.xxhash64("key"), block)
    # Members grow with the corpus: always a merge join, whatever size they have by chance.
    texts = rows.alias("t").join(members.select("key", "first_id").alias("m").hint("merge"),
                                 (F.col("t.key") == F.col("m.key")) & F.col("t.doc_id").eqNullSafe(F.col("m.first_id"))) \
                .select("t.key", "t.text")
    cells = (dealt.select("cell", "key", "copies", "block", "other").join(texts, "key")
             .repartition("cell").sortWithinPartitions("cell"))
    found = stage(map_arrow(cells.select("cell", "key", "copies", "block", "other", "text"), _verify(k, least),
                            "a binary, b binary, n bigint"), "near-found")

    links = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("linked"))
    roots = components(found.where("b is not null").select("a", "b"), "near-components").withColumnRenamed("node", "key")
    known = stage(nodes.select("key", "first_id", "copies").join(links, "key", "left").join(roots, "key", "left")
                  .select("key", "first_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"),
                          F.coalesce("root", "key").alias("root")), "near-known")
    least_id = known.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("best"))
    known = known.join(least_id, "root").select("key", "links", "best")
    out = rows.select("doc_id", "key").join(known, "key", "left")
    alone = F.col("links").isNull()
    return out.select("doc_id", "key", F.when(alone, F.col("doc_id")).otherwise(F.col("best.first_id")).alias("class_id"),
                      F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                      (alone | ((F.col("key") == F.col("best.key")) & F.col("doc_id").eqNullSafe(F.col("best.first_id"))))
                      .alias("kept"))


def _signed(k: int, trees: int, depth: int, length: int):
    sign = _sign(k, trees, depth, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = pa.array(np.arange(b.num_rows))
            numbered = pa.RecordBatch.from_arrays([row, b.column(1)], ["key", "text"])
            for x in sign(iter([numbered])):
                at = x.column(0)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(2).take(at), x.column(1), x.column(2)],
                                                 ["key", "doc_id", "labels", "sig"])
    return run


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near-duplicates: of every class the row with the smallest
    doc_id stays (once, if it is repeated); documents without words all stay."""
    key, i, k = fresh(docs, "near_key", "near_id", "near_text")
    keep = near_texts(docs, **options).where("kept").select(F.col("doc_id").alias(i), F.col("key").alias(k)).distinct()
    rows = docs.withColumn(key, text_key(docs["text"]))
    return (rows.join(keep, rows["doc_id"].cast("bigint").eqNullSafe(keep[i]) & (rows[key] == keep[k]))
            .dropDuplicates([i, k]).select(*docs.columns))
