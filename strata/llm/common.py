"""Helpers shared by the operators: tables, lineage cuts, word and shingle
hashes, bounded groups inside Python tasks, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ctypes
import gc
import os
import re
import tempfile
import unicodedata
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

U = np.uint64
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that the
    functions of Python tasks can be imported there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parents[2]
    path = os.path.join(tempfile.mkdtemp(), "strata.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "strata").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(path)


_MEMO: list = []


def use_memo(owner=None) -> None:
    """A worker keeps what it has learnt about words for one operator at a time:
    Spark hands the same Python processes from stage to stage."""
    if not _MEMO or _MEMO[0] is not owner:
        for other in _MEMO:
            other.forget()
        _MEMO[:] = [] if owner is None else [owner]


def give_back() -> None:
    """Memory that this process has freed goes back to the system: a worker lives
    through all stages, and would hold the most that any of its tasks has held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's
    if trim:
        trim(0)


def _task(fn, memo: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not memo:
            use_memo()
        try:
            yield from fn(batches)
        finally:
            give_back()
    return run


BATCH_BYTES = 1 << 22      # bytes of a batch of rows that goes to a Python task
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, fn, schema: str, memo: bool = False) -> DataFrame:
    """``df.mapInArrow`` with batches of about BATCH_BYTES: 10,000 rows, Spark's
    own bound, may be long texts, and executor and worker hold a batch several
    times.  The setting stays, as the plan is made later.  ``memo``: the tasks
    call ``use_memo``; others drop what a worker has learnt before."""
    spark = df.sparkSession
    ship(spark)
    spark.conf.set(_BATCH, BATCH_BYTES)
    return df.mapInArrow(_task(fn, memo), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to shared storage and read back: a lineage cut that outlives
    executors and keeps column pruning."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: its cleaner
    acts when the driver collects garbage, which a driver that only plans may
    not do for half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none of ``df``'s (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_key(text) -> F.Column:
    """128-bit key of a whole text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


# --- words and shingles ----------------------------------------------------

_WORD = np.zeros(256, bool)
_WORD[[c for c in range(128) if chr(c).isalnum()]] = True
_WORD[128:] = True
_CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def _hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a buffer, and where each word starts."""
    buf = np.frombuffer(raw, np.uint8)
    word = _WORD[buf]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, U), starts
    lens = ends - starts
    at = np.flatnonzero(word)
    offset = np.arange(len(at)) - np.repeat(np.cumsum(lens) - lens, lens)
    top = int(lens.max())
    power = np.full(top, 0x9E3779B97F4A7C15, U)     # unsigned throughout: a float here would drop low bits
    power[0] = 1
    power = np.multiply.accumulate(power)
    terms = (buf[at].astype(U) + U(1)) * power[offset]
    return mix(np.add.reduceat(terms, np.cumsum(lens) - lens) + mix(lens.astype(U))), starts


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Cuts of a very long text at ASCII white space, so that memory stays bounded."""
    at = 0
    while len(raw) - at > _CHUNK:
        cut = max(raw.rfind(c, at, at + _CHUNK) for c in (b" ", b"\n", b"\t"))
        if cut <= at:
            cut = min((x for x in (raw.find(c, at + _CHUNK) for c in (b" ", b"\n", b"\t")) if x >= 0),
                      default=len(raw))
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def word_hashes(texts: Iterable[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of texts, chunk by chunk: (first text, number of texts,
    hashes, offsets).  Text ``first + i`` has ``hashes[offsets[i]:offsets[i + 1]]``.
    Words are runs of ASCII letters and digits and of any non-ASCII characters
    of the lower-cased text; ``spaced`` texts have words by Unicode's classes."""
    hold: list[bytes] = []
    size = first = 0

    def flush():
        ends = np.cumsum([len(x) + 1 for x in hold])
        h, starts = _hash_words(b"\n".join(hold) + b"\n")
        return first, len(hold), h, np.concatenate([[0], np.searchsorted(starts, ends)])

    n = 0
    for text in texts:
        raw = (text or "").lower().encode("utf-8", "surrogatepass")
        if len(raw) > _CHUNK or size + len(raw) > _CHUNK:
            if hold:
                yield flush()
            hold, size, first = [], 0, n
        if len(raw) > _CHUNK:
            h = np.concatenate([_hash_words(p)[0] for p in _pieces(raw)])
            yield n, 1, h, np.array([0, len(h)])
            first = n + 1
        else:
            hold.append(raw)
            size += len(raw)
        n += 1
    if hold:
        yield flush()


# Blocks of scripts written without spaces between words: Thai, Lao, Burmese, Khmer, Tai and
# Javanese scripts, kana, Chinese characters, Yi.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF),
            (0x1B00, 0x1B7F), (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF),
            (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF))
_NOT_ASCII = re.compile(r"[^\x00-\x7f]+")


class _Spaced(dict):
    """Characters as ``spaced`` writes them, worked out when first met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if not (c.isalnum() or unicodedata.category(c)[0] == "M"):
            out = " "
        elif any(a <= code <= b for a, b in UNSPACED):
            out = f" {c} "
        else:
            out = c
        self[code] = out
        return out


_SPACED = _Spaced()


def spaced(text: str | None) -> str:
    """``text`` in lower case with a space for every non-ASCII character that is
    no letter, digit or combining mark, and spaces around each character of a
    script without them, so that ``word_hashes`` finds its words."""
    text = (text or "").lower()
    return text if text.isascii() else _NOT_ASCII.sub(lambda m: m[0].translate(_SPACED), text)


def word_count(text) -> F.Column:
    """The number of words of ``spaced`` texts (for bounds: Java's tables of
    characters may be older or newer than Python's)."""
    alone = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED)
    letter = r"\p{L}\p{N}\p{M}"
    return F.regexp_count(text, F.lit(rf"[{letter}&&[{alone}]]|[{letter}&&[^{alone}]]+"))


def shingles(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of each text (a text of 1 to k-1 words has
    one shingle, all its words), and the offsets of each text's shingles."""
    counts = np.diff(offsets)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(offsets[:-1], made) + np.arange(out[-1]) - np.repeat(out[:-1], made)
    last = np.repeat(offsets[1:], made)
    total = np.zeros(len(at), U)
    padded = np.concatenate([h, np.zeros(k, U)])
    for i in range(k):
        m = U(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
        total += np.where(at + i < last, padded[at + i], U(0)) * m
    return mix(total), out


# --- groups in Python tasks --------------------------------------------------

def group_starts(key: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of a partition sorted by a long ``key``, cut so that no group is
    split: yields (rows, starts of the groups and the end)."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        if last is not None and k[-1] == last:
            held.append(b)
            continue
        cut = int(np.searchsorted(k, k[-1], "left")) if k[0] <= k[-1] else int(group_starts(k)[-2])
        t = pa.Table.from_batches([*held, b.slice(0, cut)]) if held or cut else None
        if t is not None and t.num_rows:
            t = t.combine_chunks()
            yield t, group_starts(t.column(key).to_numpy())
        held, last = [b.slice(cut)], k[-1]
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, group_starts(t.column(key).to_numpy())


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


HOT_KEYS = 1000     # a key with more than one in HOT_KEYS of all rows is dealt over several tasks


def deal_join(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``keys``, unique in ``on``, whose column ``n``
    counts the rows of each key (it is dropped).  ``keys`` should be a stored
    table: it is read three times.

    A key that holds over one in HOT_KEYS of the rows is dealt over as many parts
    as it holds such shares: its row of ``keys`` is repeated for each part, and
    each of ``rows`` goes to one of them by its hash and its task's number (rows
    may be equal).  Fewer than HOT_KEYS keys can be so large, so their numbers of
    parts are broadcast; they add up to less than twice HOT_KEYS."""
    total = keys.agg(F.sum("n")).first()[0]
    if not total:
        return rows.join(keys.drop("n"), on)
    parts, part = fresh(rows.join(keys, on), "parts", "part")
    keys = keys.withColumn(parts, F.ceil(F.col("n") * HOT_KEYS / F.lit(total)).cast("int")).drop("n")
    hot = F.broadcast(keys.where(F.col(parts) > 1).select(*on, parts))
    here = F.xxhash64(*rows.columns, F.spark_partition_id())
    dealt = (rows.join(hot, on, "left")
             .withColumn(part, F.pmod(here, F.coalesce(parts, F.lit(1))).cast("int")).drop(parts))
    places = keys.withColumn(part, F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).drop(parts)
    return dealt.join(places, [*on, part]).drop(part)


def block_cells(rows: DataFrame, counts: DataFrame, on: list[str], spread_by, size: int) -> DataFrame:
    """Deal the rows of every group (``counts``: on, n) into cells in which all
    pairs of a group meet, none of which grows with the group: a group of n rows
    is cut into ceil(n / size) blocks, and each pair of blocks is a cell.  Adds
    ``cell`` (long), ``block`` (this row's side) and ``other`` (the cell's
    second block).  A group of up to ``size`` rows is one cell.  The rows of a
    large group are dealt over tasks before they meet its count."""
    counts = stage(counts.select(*on, "n", F.ceil(F.col("n") / size).cast("int").alias("blocks")), "block-counts")
    j = (deal_join(rows, counts, on)
         .withColumn("block", F.pmod(spread_by, F.col("blocks")).cast("int"))
         .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    lo, hi = F.least("block", "with"), F.greatest("block", "with")
    return (j.withColumn("cell", F.xxhash64(*on, lo, hi))
            .withColumn("other", F.when(F.col("block") == F.col("with"), F.col("block"))
                        .otherwise(F.col("with")).cast("int"))
            .drop("blocks", "with"))


# --- connected components ----------------------------------------------------

def _fingerprint(e: DataFrame):
    return e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root being the
    smallest node reachable.  Alternating large-star / small-star rounds; each
    round is two aggregations and joins over the edges, written to shared
    storage, and only a count and a checksum reach the driver."""
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct(), name)
    seen = _fingerprint(e)
    while seen[0]:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name)
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
