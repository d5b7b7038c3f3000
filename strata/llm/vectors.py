"""Embedding near-dedup: a pivot-permutation index with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, block_cells, components, map_arrow, stage, whole_groups

COSINE = 0.98
PIVOTS = 256               # reference points, drawn from a bounded sample
NEAREST = 8                # a vector is listed under so many nearest pivots, in order
SHARED = 2                 # pivots that two vectors' lists must share
SAMPLE = 8192              # vectors from which the pivots are drawn, about
BLOCK = 1024               # rows of an inverted list compared at once


def _matrix(col: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (double) of a list column, and which rows are valid: not
    null, all components finite, not zero, and of ``dim`` components."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    lens = np.where(col.is_valid().to_numpy(zero_copy_only=False),
                    pa.compute.fill_null(pa.compute.list_value_length(col), 0).to_numpy(zero_copy_only=False), 0)
    if dim is None:
        dim = int(np.bincount(lens).argmax()) if len(lens) else 0
    ok = (lens == dim) & (dim > 0)
    flat = pa.compute.list_flatten(col.filter(pa.array(ok)))
    x = np.zeros((len(lens), dim))
    if ok.any():
        x[ok] = pa.compute.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
    ok &= np.isfinite(x).all(1)
    x[~ok] = 0.0
    top = np.abs(x).max(1, initial=0.0)
    ok &= top > 0
    x = x / np.where(ok, top, 1.0)[:, None]                 # against overflow of the squares
    norm = np.sqrt((x * x).sum(1))
    return x / np.where(ok, norm, 1.0)[:, None], ok


def fit_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Reference points for each number of dimensions: vectors of the bounded,
    documented sample (about ``sample`` different vectors, those with the
    smallest hashes), chosen farthest-first so that they cover the space."""
    valid = vectors.where("embedding is not null and size(embedding) > 0")
    total = valid.count()
    part = F.abs(F.xxhash64("embedding") % F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = valid.where(part * F.lit(total) <= sample).select("embedding").distinct()
    got = drawn.orderBy(F.xxhash64("embedding"), F.hash("embedding")).limit(2 * sample).toArrow().column(0)
    out = {}
    lens = pa.compute.list_value_length(got).to_numpy(zero_copy_only=False) if len(got) else np.empty(0)
    for dim in sorted({int(n) for n in lens}):
        x, ok = _matrix(got, dim)
        x = x[ok]
        if not len(x):
            continue
        chosen, best = [0], x @ x[0]
        while len(chosen) < min(pivots, len(x)):
            chosen.append(int(best.argmin()))
            best = np.maximum(best, x @ x[chosen[-1]])
        out[dim] = x[chosen]
    return out


_LISTED = pa.schema([("vkey", pa.binary()), ("dim", pa.int32()), ("pivots", pa.list_(pa.int32())),
                     ("unit", pa.binary())])
_LISTED_DDL = "vkey binary, dim int, pivots array<int>, unit binary"


def _list_under(pivots, nearest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots.value
        for b in batches:
            dims = set(pa.compute.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)[
                b.column(1).is_valid().to_numpy(zero_copy_only=False)].tolist())
            for dim in sorted(int(d) for d in dims if d):
                x, ok = _matrix(b.column(1), dim)
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                x = x[at]
                ref = refs.get(dim, np.eye(1, dim))
                n = min(nearest, len(ref))
                order = np.argsort(-(x @ ref.T), axis=1, kind="stable")[:, :n].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)),
                     pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * n, order.ravel()),
                     pa.array([v.tobytes() for v in x], pa.binary())], schema=_LISTED)
    return run


_FOUND = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])


def _verify(least: float, shared: int):
    """Links within the cells of the inverted lists: for every vector the number
    of its links (b null), and a spanning forest of the links (n 0).

    A cell's own inverted lists, one for each further pivot, bring together the
    rows that share that pivot besides the cell's; they are counted up before any
    cosine, so only pairs with ``shared`` common pivots are multiplied.  A pair
    belongs to the cell of the smallest pivot that it shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, "cell"):
            keys = rows.column("vkey").to_pylist()
            units = rows.column("unit").to_pylist()
            pivot = rows.column("pivot").to_numpy()
            copies = rows.column("copies").to_numpy()
            block, other = rows.column("block").to_numpy(), rows.column("other").to_numpy()
            lists = rows.column("pivots").to_pylist()
            out_a, out_b, out_n = [], [], []
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                x = np.array([np.frombuffer(u) for u in units[s:e]])
                p = np.array(lists[s:e])
                cross = bool((block[s:e] != other[s:e]).any())
                side = block[s:e]
                need = min(shared, p.shape[1])
                by_pivot: dict[int, np.ndarray] = {}
                for q in np.unique(p).tolist():
                    by_pivot[q] = np.flatnonzero((p == q).any(1))
                forest = Forest(e - s)
                links = np.zeros(e - s, np.int64)
                for i in range(e - s - 1):
                    # Shared pivots of row i with each later row, counted over the lists.
                    meet = np.concatenate([by_pivot[q][np.searchsorted(by_pivot[q], i, "right"):] for q in p[i].tolist()])
                    less = np.concatenate([by_pivot[q][np.searchsorted(by_pivot[q], i, "right"):]
                                           for q in p[i].tolist() if q < pivot[s + i]] or [meet[:0]])
                    common = np.bincount(meet, minlength=e - s)
                    hit = np.flatnonzero((common >= need) & (np.bincount(less, minlength=e - s) == 0))
                    if cross:
                        hit = hit[side[hit] != side[i]]
                    if not len(hit):
                        continue
                    hit = hit[(x[hit] * x[i]).sum(1) >= least]
                    links[i] += copies[s + hit].sum()
                    links[hit] += copies[s + i]
                    for j in hit.tolist():
                        if forest.join(i, j):
                            out_a.append(keys[s + i])
                            out_b.append(keys[s + j])
                            out_n.append(0)
                for i in np.flatnonzero(links).tolist():
                    out_a.append(keys[s + i])
                    out_b.append(None)
                    out_n.append(int(links[i]))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary()),
                                                  pa.array(out_n, pa.int64())], schema=_FOUND)
    return run


def near_vectors(vectors: DataFrame, least: float = COSINE, pivots: int = PIVOTS, nearest: int = NEAREST,
                 shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """Links between vectors of equal label with cosine >= ``least`` (double
    precision), and their groups: (vec_id, n_links, component_id, kept), one row
    per input row.

    Equal vectors of a label are first collapsed, so copies cost nothing.  Every
    vector is described by the order of its ``nearest`` pivots and stored in
    their inverted lists, kept apart by label; for vectors that meet in a list the
    shared pivots are counted, and those with at least ``shared`` are verified
    exactly.  A list is compared
    in blocks of about ``block`` rows, each pair of blocks in a cell of its own;
    tasks return link counts and a spanning forest, never all pairs.

    Null, zero or non-finite vectors and vectors of a null label link with
    nothing; vectors of different lengths never link.  Rows that agree in
    label and vector are copies of each other, also when vec_id is repeated;
    component_id is the smallest vec_id that is not null (null if there is
    none), kept tells whether vec_id is it.  An empty table gives none."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("label").cast("string").alias("label"), "embedding")
    raw = F.concat(F.lit("v"), F.to_json(F.struct("label", "embedding"))).cast("binary")
    rows = rows.withColumn("vkey", F.unhex(F.md5(raw)))
    distinct = (rows.where("label is not null and embedding is not null").groupBy("vkey")
                .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"),
                     F.first("label").alias("label"), F.first("embedding").alias("embedding")))
    distinct = stage(distinct, "vec-distinct")
    refs = spark.sparkContext.broadcast(fit_pivots(distinct.select("embedding"), pivots))
    listed = map_arrow(distinct.select("vkey", "embedding"), _list_under(refs, nearest), _LISTED_DDL)
    listed = stage(listed.join(distinct.select("vkey", "label", "copies", "first_id"), "vkey"), "vec-listed")

    entries = listed.select("vkey", "label", "dim", F.explode("pivots").alias("pivot"))
    counts = entries.groupBy("label", "dim", "pivot").agg(F.count("*").alias("n")).where("n > 1")
    cells = block_cells(listed.select("*", F.explode("pivots").alias("pivot")), counts, ["label", "dim", "pivot"],
                        F.xxhash64("vkey"), block)
    cells = (cells.select("cell", "vkey", "pivot", "pivots", "unit", "copies", "block", "other")
             .repartition("cell").sortWithinPartitions("cell"))
    found = stage(map_arrow(cells, _verify(least, shared), "a binary, b binary, n bigint"), "vec-found")

    links = found.where("b is null").groupBy(F.col("a").alias("vkey")).agg(F.sum("n").alias("linked"))
    roots = components(found.where("b is not null").select("a", "b"), "vec-components")
    known = (listed.select("vkey", "copies", "first_id").join(links, "vkey", "left")
             .join(roots.withColumnRenamed("node", "vkey"), "vkey", "left")
             .select("vkey", "first_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"),
                     F.coalesce("root", "vkey").alias("root")))
    known = stage(known, "vec-known")
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component"))
    known = known.join(smallest, "root").select("vkey", "links", "component")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return (rows.select("vec_id", "vkey").join(known, "vkey", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")))
