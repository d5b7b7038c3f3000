"""Benchmark decontamination: CGK embedding, bit-sampling LSH, edit distance."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import fresh, map_arrow, mix, spaced, word_count, word_hashes

RATIO = 0.2                # edits a benchmark item may have, of its words
MIN_WORDS = 5              # shorter items have no edits and are looked up exactly
RECALL = 0.99              # target, for windows with the most edits allowed
SAMPLED = 4                # embedded positions in one hash
MAX_REPEATS = 96
ITEM_WORDS = 200_000       # words of benchmark items handled in one pass over the documents
U = np.uint64
PAD = U(0x5bd1e995)
_WINDOWS = 4096            # windows embedded at once
_CELLS = 1 << 20           # words of windows (or of regions) held at once: long items go in smaller batches


def edits(n: np.ndarray | int):
    """Edits allowed in an item of n words."""
    return (np.asarray(n) * RATIO + 1e-9).astype(int)


class Embedding:
    """The CGK walk: reading a word string, step j copies the current word and
    moves on or stays by a random bit of (j, word).  After 3n steps, strings of
    small edit distance agree in most positions, because their walks meet again
    after an edit.  Every repetition has a walk and ``SAMPLED`` positions of its
    own; the words there make its hash."""

    def __init__(self, longest: int, repeats: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.longest, self.repeats = longest, repeats
        steps = 3 * longest
        self.turn = rng.integers(1, 1 << 63, (steps, repeats), dtype=np.int64).astype(U) * U(2) + U(1)
        # Sampled positions as shares of the 3n steps, and the factors of the words there.
        self.at = rng.random((repeats, SAMPLED))
        self.odd = rng.integers(1, 1 << 63, (repeats, SAMPLED), dtype=np.int64).astype(U) * U(2) + U(1)

    def keys(self, words: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hashes (windows x repeats) of the first n[i] words of each row."""
        rows = np.arange(len(words))[:, None]
        i = np.zeros((len(words), self.repeats), np.int64)
        key = np.zeros((len(words), self.repeats), U)
        n = n.astype(np.int64)
        top = int(n.max()) if len(n) else 0
        padded = np.concatenate([words, np.full((len(words), 1), PAD, U)], axis=1)
        end = np.where(n < words.shape[1], n, words.shape[1])[:, None]
        padded[np.arange(padded.shape[1])[None, :] >= end] = PAD
        lengths, which = np.unique(n, return_inverse=True)
        step = (self.at * 3 * lengths[:, None, None]).astype(np.int64)
        order = np.argsort(step.ravel(), kind="stable")
        row, repeat, k = np.unravel_index(order, step.shape)
        cut = np.searchsorted(step.ravel()[order], np.arange(3 * top + 1))
        for j in range(3 * top):
            now = padded[rows, i]
            if cut[j] < cut[j + 1]:
                part = slice(cut[j], cut[j + 1])
                coef = np.zeros((len(lengths), self.repeats), U)
                np.add.at(coef, (row[part], repeat[part]), self.odd[repeat[part], k[part]])
                key += now * coef[which]
            i = np.minimum(i + (mix(now * self.turn[j]) >> U(63)).astype(np.int64), end)
        return mix(key + np.arange(self.repeats, dtype=U) * U(0x9E3779B97F4A7C15) + n[:, None].astype(U))


def best_edit(item: np.ndarray, n: np.ndarray, region: np.ndarray) -> np.ndarray:
    """Least edit distance of each item (its first n[i] words) to any substring
    of its region, for all rows at once."""
    width = region.shape[1]
    col = np.arange(width + 1)
    d = np.zeros((len(item), width + 1), np.int32)
    out = np.zeros(len(item), np.int32)
    for i in range(int(n.max(initial=0))):
        t = np.empty_like(d)
        t[:, 0] = i + 1
        t[:, 1:] = np.minimum(d[:, 1:] + 1, d[:, :-1] + (region != item[:, i:i + 1]))
        d = np.minimum.accumulate(t - col, axis=1).astype(np.int32) + col
        done = n == i + 1
        out[done] = d[done].min(1)
    return out


def _runs(h: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all runs of q words."""
    out = np.zeros(max(0, len(h) - q + 1), U)
    for i in range(q):
        out = mix(out * U(0xD6E8FEB86659FD93) + h[i:len(h) - q + 1 + i])
    return out


class Short:
    """Items of fewer than MIN_WORDS words, looked up as exact runs of words; an
    item of one word, which any text may hold by chance, only as a whole text."""

    def __init__(self, words: list[np.ndarray]):
        self.of = {}
        for q in range(1, MIN_WORDS):
            mine = np.array([i for i, w in enumerate(words) if len(w) == q], np.int64)
            if len(mine):
                keys = np.concatenate([_runs(words[i], q) for i in mine])
                order = np.argsort(keys, kind="stable")
                self.of[q] = keys[order], mine[order]

    def find(self, h: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """(text, item) of the items in the texts."""
        for q, (keys, owner) in self.of.items():
            runs = _runs(h, q)
            first = np.searchsorted(keys, runs, "left")
            at = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == runs)
            doc = np.searchsorted(offsets, at, "right") - 1
            inside = at + q <= offsets[doc + 1]
            if q == 1:
                inside &= np.diff(offsets)[doc] == 1
            for d, k in np.unique(np.stack([doc[inside], first[at[inside]]]), axis=1).T.tolist():
                for item in owner[k:np.searchsorted(keys, keys[k], "right")].tolist():
                    yield d, item


class Grams:
    """Runs of q words of the items, and the windows of a text with enough of
    them (the q-gram lemma) to be within the allowed distance of some item."""

    def __init__(self, q: int, words: list[np.ndarray], n: np.ndarray):
        three = n - 2 - 3 * edits(n) >= 2
        mine = three if q == 3 else ~three
        self.q, self.lengths = q, np.unique(n[mine])
        if not len(self.lengths):
            return
        self.known = np.unique(np.concatenate([_runs(w, q) for w, m in zip(words, mine) if m]))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known >> U(44)).astype(np.int64)] = True
        self.of = np.zeros((len(self.lengths), len(self.known)), bool)     # which lengths a run comes from
        for w, m in zip(words, mine):
            if m:
                self.of[np.searchsorted(self.lengths, len(w)), np.searchsorted(self.known, _runs(w, q))] = True
        e = edits(self.lengths)
        self.span, self.need = self.lengths + e, self.lengths - q + 1 - q * e
        # Of the stretches of ``part`` run starts that make up a rich window, one is rich.
        self.part = int(self.span.min())
        self.part_need = max(1, int(np.ceil(self.need / np.ceil((self.span - q + 1) / self.part)).min()))

    def windows(self, h: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, start, length, end of the text) of windows, length by length."""
        q = self.q
        runs = _runs(h, q)
        at = np.flatnonzero(self.maybe[(runs >> U(44)).astype(np.int64)])
        which = np.minimum(np.searchsorted(self.known, runs[at]), len(self.known) - 1)
        at, which = at[self.known[which] == runs[at]], which[self.known[which] == runs[at]]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + q <= offsets[doc + 1]
        at, which = at[inside], which[inside]
        far = np.searchsorted(at, at + self.part, "left") - np.arange(len(at))
        for d in np.unique(np.searchsorted(offsets, at[far >= self.part_need], "right") - 1).tolist():
            a, b = int(offsets[d]), int(offsets[d + 1])
            p, r = np.searchsorted(at, [a, b])
            for of, n, span, need in zip(self.of, self.lengths, self.span, self.need):
                own = of[which[p:r]]
                if np.count_nonzero(own) < need:
                    continue
                run = np.zeros(b - a + 1, np.int64)
                run[at[p:r][own] - a + 1] = 1
                run = np.cumsum(run)
                s = np.arange(b - a)
                ok = a + s[run[np.minimum(s + span - q + 1, b - a)] - run[s] >= need]
                if len(ok):
                    yield np.full(len(ok), d), ok, np.full(len(ok), n), np.full(len(ok), b)


def _batches(n: np.ndarray, most: int) -> Iterator[slice]:
    """Cuts of rising sizes n, of at most ``most`` rows and _CELLS in a rectangle."""
    lo = 0
    while lo < len(n):
        some = n[lo:lo + most]
        hi = lo + max(1, int(np.searchsorted(some * np.arange(1, len(some) + 1), _CELLS, "right")))
        yield slice(lo, hi)
        lo = hi


class Index:
    """Benchmark items, their runs of words and their LSH keys."""

    def __init__(self, ids: list[int | None], texts: list[str | None], recall: float = RECALL):
        words = [h[o[i]:o[i + 1]] for _, n, h, o in word_hashes(map(spaced, texts)) for i in range(n)]
        use = [i for i, w in enumerate(words) if len(w) >= MIN_WORDS]
        self.ids, self.use, self.short = list(ids), use, Short(words)
        words = [words[i] for i in use]
        self.n = np.array([len(w) for w in words], np.int64)
        self.grams: list[Grams] = []
        if not use:
            return
        self.longest = int(self.n.max())
        self.flat, self.start = np.concatenate(words), np.cumsum(self.n) - self.n
        self.alike = dict(zip(*(x.tolist() for x in np.unique(self.n, return_counts=True))))   # items of each length
        # A text that differs from an item in e words shares n - q + 1 - q e runs of q words with
        # it, in n + e words: runs of three, or of two for the lengths that leave too few.
        self.grams = [Grams(q, words, self.n) for q in (2, 3)]
        self.grams = [g for g in self.grams if len(g.lengths)]
        self.embedding = Embedding(self.longest, self._repeats(recall))
        flat = self._keys(self.embedding, np.arange(len(words))).ravel()
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner = flat[order], np.repeat(np.arange(len(words)), self.embedding.repeats)[order]

    def _grid(self, items: np.ndarray) -> np.ndarray:
        """Words of items, a row each."""
        n = self.n[items][:, None]
        ahead = np.arange(int(n.max()))
        return np.where(ahead < n, self.flat[np.minimum(self.start[items][:, None] + ahead, len(self.flat) - 1)], PAD)

    def _keys(self, embedding: Embedding, items: np.ndarray) -> np.ndarray:
        out = np.zeros((len(items), embedding.repeats), U)
        order = np.argsort(self.n[items], kind="stable")
        for cut in _batches(self.n[items[order]], _WINDOWS):
            out[order[cut]] = embedding.keys(self._grid(items[order[cut]]), self.n[items[order[cut]]])
        return out

    def _repeats(self, recall: float) -> int:
        """Repetitions for the target: items with as many random edits as
        allowed are embedded, and repetitions are added until that share of them
        meets its item.  Few long items are tried less often."""
        rng = np.random.default_rng(11)
        take = rng.permutation(len(self.n))[:200]
        once = len(take)
        take = np.concatenate([take] * max(1, min(400, (1 << 21) // self.longest) // once))
        changed = []
        for i in take:
            w = list(self.flat[self.start[i]:self.start[i] + self.n[i]])
            for _ in range(int(edits(self.n[i]))):
                at, kind = int(rng.integers(len(w))), int(rng.integers(3))
                new = U(rng.integers(1, 1 << 62))
                w[at:at + (kind != 0)] = [new] if kind != 2 else []
            more = rng.integers(1, 1 << 62, self.longest).astype(U)
            changed.append(np.array([*w, *more[:max(0, self.n[i] - len(w))]], U)[:self.n[i]])
        probe = Embedding(self.longest, MAX_REPEATS)
        own = self._keys(probe, take[:once])
        same = np.zeros((len(take), MAX_REPEATS), bool)
        order = np.argsort(self.n[take], kind="stable")
        for cut in _batches(self.n[take[order]], _WINDOWS):
            rows = order[cut]
            grid = np.full((len(rows), int(self.n[take[rows]].max())), PAD, U)
            for r, i in enumerate(rows):
                grid[r, :len(changed[i])] = changed[i]
            same[rows] = probe.keys(grid, self.n[take[rows]]) == own[rows % once]
        met = np.logical_or.accumulate(same, axis=1).mean(0)
        enough = np.flatnonzero(met >= recall)
        return int(enough[0]) + 1 if len(enough) else MAX_REPEATS

    def find(self, texts: list[str | None]) -> list[list]:
        """For every text the ids of the items it contains."""
        found: list[set[int]] = [set() for _ in texts]
        for first, count, h, offsets in word_hashes(map(spaced, texts)) if self.use or self.short.of else ():
            for doc, item in self.short.find(h, offsets):
                found[first + doc].add(item)
            where = [w for g in self.grams for w in g.windows(h, offsets)]
            for doc, item in self._search(h, offsets, where):
                found[first + doc].add(self.use[item])
        return [sorted((self.ids[i] for i in f), key=lambda x: (x is None, x)) for f in found]

    def _search(self, h, offsets, where) -> set[tuple[int, int]]:
        if not where:
            return set()
        doc, start, n, end = (np.concatenate(x) for x in zip(*where))
        out: set[tuple[int, int]] = set()
        tried: set[tuple[int, int, int]] = set()
        padded = np.concatenate([h, np.full(self.longest, PAD, U)])
        # By length; windows of long items in scattered order, so that an item is met, and
        # the rest of its windows left, after few of them.
        far = np.where(n * _WINDOWS > _CELLS, start.astype(U) * U(0x9E3779B97F4A7C15), U(0))
        order = np.lexsort((far, n))
        doc, start, n, end = doc[order], start[order], n[order], end[order]
        while len(doc):
            cut = next(_batches(n, _WINDOWS))
            d, s, m, b = doc[cut], start[cut], n[cut], end[cut]
            doc, start, n, end = (x[cut.stop:] for x in (doc, start, n, end))
            at = s[:, None] + np.arange(int(m.max()))
            words = padded[at]
            words[at >= b[:, None]] = PAD
            keys = self.embedding.keys(words, m)
            first = np.searchsorted(self.keys, keys.ravel(), "left")
            last = np.searchsorted(self.keys, keys.ravel(), "right")
            hit = np.flatnonzero(last > first)
            many = last[hit] - first[hit]
            item = self.owner[np.repeat(first[hit], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            win = np.repeat(hit // keys.shape[1], many)
            # Windows of one text that start close to each other lie in one region.
            cell = s[win] // (self.n[item] // 2 + 1)
            pairs = np.unique(np.stack([d[win], item, cell]), axis=1)
            new = np.array([(x, y) not in out and (x, y, z) not in tried for x, y, z in pairs.T.tolist()], bool)
            pairs = pairs[:, new]
            if not pairs.shape[1]:
                continue
            tried.update(map(tuple, pairs.T.tolist()))
            x, item, cell = pairs[:, np.argsort(self.n[pairs[1]], kind="stable")]
            step = self.n[item] // 2 + 1
            begin = np.maximum(cell * step - self.n[item], offsets[x])
            stop = np.minimum((cell + 1) * step + 2 * self.n[item], offsets[x + 1])
            before = len(out)
            for q in _batches(4 * self.n[item] + 2, 2048):
                col = begin[q, None] + np.arange(4 * int(self.n[item[q]].max()) + 2)
                region = np.where(col < stop[q, None], h[np.minimum(col, len(h) - 1)], U(0))
                far = best_edit(self._grid(item[q]), self.n[item[q]], region)
                good = far <= edits(self.n[item[q]])
                out.update(zip(x[q][good].tolist(), item[q][good].tolist()))
            if len(out) > before and len(doc) and n[-1] * _WINDOWS > _CELLS:
                # Windows of a length whose items are all found in their text say nothing new.
                got = Counter((x, int(self.n[i])) for x, i in out)
                full = [x * (self.longest + 1) + k for (x, k), c in got.items() if c == self.alike[k]]
                left = ~np.isin(doc * (self.longest + 1) + n, np.array(full, np.int64))
                doc, start, n, end = doc[left], start[left], n[left], end[left]
        return out


def _find(index, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = index.value.find(b.column(text_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.list_(pa.int64()))], names)
    return run


def find_items(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL,
               item_words: int = ITEM_WORDS) -> DataFrame:
    """``docs`` with one more column, the ids (array<bigint>) of the benchmark
    items that the text contains; its name is ``item_column(docs)``.

    A text contains an item of n words if some run of its words is at most
    0.2 n edits (insert, delete, replace a word) from the item, for fewer than 5
    words exactly the item; an item of one word must be the whole text.  Words
    are runs of letters, digits and combining marks by Unicode's classes,
    lower-cased; in scripts written without spaces every character is a word.
    Candidate windows, of the items' sizes,
    are embedded by the CGK walk and looked up by bit-sampling LSH; repetitions
    are added until items with the most edits allowed reach the target recall;
    what is found is verified by exact edit distance.  Windows that share too
    few runs of words with all items to be within the distance (the q-gram lemma,
    so none is lost) are not embedded.

    Documents are not shuffled.  The index is sent to all tasks; its size is
    bounded by ``item_words``: a larger benchmark is cut into parts of at most
    about that many words, each of which is a pass over the documents.

    Null and empty texts contain nothing.  Null item texts and items without a
    letter or digit are not looked for; a null item_id is a null in the list.
    Repeated rows get the same result; an empty benchmark finds nothing, an
    empty table gives an empty result.  Other columns pass through."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    passes = -(-int(total) // item_words)
    name, more = fresh(docs, "item_ids", "item_ids_more")
    schema = StructType([*docs.schema.fields, StructField(name, ArrayType(LongType()))])
    if passes == 0:
        return docs.withColumn(name, F.array().cast("array<bigint>"))
    out, names = None, list(docs.columns)
    for p in range(passes):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == p).collect()      # bounded by item_words
        index = spark.sparkContext.broadcast(Index([r[0] for r in part], [r[1] for r in part], recall))
        rows = docs if out is None else out
        now = schema if out is None else StructType([*out.schema.fields, StructField(more, ArrayType(LongType()))])
        found = map_arrow(rows, _find(index, docs.columns.index("text"), now.names), now)
        out = found if out is None else found.withColumn(
            name, F.array_sort(F.array_union(name, more))).select(*names, name)
    return out


def item_column(docs: DataFrame) -> str:
    return fresh(docs, "item_ids")[0]


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item."""
    return find_items(docs, benchmark, **options).where(F.size(item_column(docs)) == 0).select(*docs.columns)
