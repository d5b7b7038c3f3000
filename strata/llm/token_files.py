"""Token ids in files: frequency-ranked ids, byte-aligned variable-length
codes with separate control bytes, decoded by numpy table lookup.

A token data set is a folder of three Parquet tables:

* ``blocks`` -- part, seq, start (of the block's first id within its part),
  doc_ids, n_tokens (arrays, one entry per document), control, data;
* ``parts``  -- part, n_tokens: ids in each range partition, in order;
* ``ranks``  -- rank, id: the ids by falling frequency in the data set.

An id is stored as its rank in 1 to 4 little-endian bytes of ``data``; the
number of bytes, less one, takes two bits of ``control``, four ids to a byte.
"""

from __future__ import annotations

import codecs
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_arrow, text_key, use_memo

END_ID = 2
BLOCK = 1 << 18            # ids after which a block ends (at the end of a document)
PARTS_KEPT = 1 << 25       # bytes of parts of words and their ids that a worker keeps, about
LEARNT = 1 << 21           # bytes of texts whose words are looked up together, about


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# --- encoding ----------------------------------------------------------------

# What a byte-level model calls each byte (Latin-1's visible signs as they are,
# the others from U+0100 on); a space stays one, as it parts the words.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
_SIGNS = "".join(" " if b == 32 else chr(b) if b in _VISIBLE else chr(256 + _HIDDEN.index(b)) for b in range(256))


class WordEncoder:
    """Ids of whole texts by the tokenizers library, with the ids of words kept.

    The tokenizer (word_bpe) drops white space and matches nothing across it,
    so a text's ids are those of its words.  Texts with characters that Python
    alone takes for white space, or with a special token's opening, are encoded
    whole.

    A word of letters is one piece to the tokenizer's pattern, so new ones go to
    its model through ``plain``, a second tokenizer of the same model that splits
    at spaces only: their letters are put into the model's signs for bytes first,
    normalised by the library where they are not ASCII."""

    _ODD = "<\\||[\x1c-\x1f]"
    _TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"     # ASCII punctuation but the apostrophe

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.lib = Tokenizer.from_file(path)
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.apart: dict[str, bool] = {}
        self.letter: dict[str, bool] = {" ": True}
        self.plain = None
        if self._bytes_of_pieces():
            self.plain = Tokenizer(self.lib.model)
            self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.forget()

    def forget(self) -> None:
        # Known parts of words, their ids, and the look-up that last met each.
        self.parts, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.met, self.lookups = np.zeros(0, np.int64), 0

    def _bytes_of_pieces(self) -> bool:
        """Whether the model sees each piece of the pattern as signs for its bytes."""
        from tokenizers import models
        if self.lib.pre_tokenizer is None or self.lib.normalizer is None or self.lib.post_processor is not None:
            return False
        steps = json.loads(self.lib.pre_tokenizer.__getstate__()).get("pretokenizers", [])
        return (isinstance(self.lib.model, models.BPE) and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])

    def _lib(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _ends_piece(self, c: str) -> bool:
        """Whether the tokenizer itself, by its own classes of characters, ends
        a piece between ``c`` and punctuation."""
        if c not in self.apart:
            norm = self.lib.normalizer.normalize_str(c + ",") if self.lib.normalizer else c + ","
            self.apart[c] = self.lib.pre_tokenizer.pre_tokenize_str(norm)[-1][0] == ","
        return self.apart[c]

    def _is_letter(self, c: str) -> bool:
        """Whether the tokenizer's pattern takes ``c`` into a run of letters."""
        if c not in self.letter:
            self.letter[c] = len(self.lib.pre_tokenizer.pre_tokenize_str(f"a{c}a")) == 1
        return self.letter[c]

    def _letters(self, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Which of these words of letters are such to the tokenizer too, and
        their ids: they are encoded in one text, whose word ends show in the ids."""
        good = np.ones(len(words), bool)
        text = " ".join(words.to_numpy(zero_copy_only=False))
        if self.plain is None:
            raw = self._lib([text])[0]
        else:
            if not text.isascii():
                text = self.lib.normalizer.normalize_str(text)
                signs = {c for c in set(text) if not self._is_letter(c)}
                if signs:
                    normal = text.split(" ")
                    good = np.array([signs.isdisjoint(w) for w in normal])
                    text = " ".join(w for w, g in zip(normal, good.tolist()) if g)
                text = codecs.charmap_decode(text.encode(), "strict", _SIGNS)[0]
            raw = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype).tobytes()
        ends = np.flatnonzero(self.ends[np.frombuffer(raw, self.dtype)]) + 1
        if len(ends) != good.sum() or len(good) != len(words):
            return np.zeros(len(words), bool), self.ids[:0]
        at = np.concatenate([[0], ends]) * self.dtype.itemsize
        return good, pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(raw)])

    def _learn(self, missing: pa.Array) -> None:
        """Ids of new parts, put behind the known ones in this order."""
        lower = pc.and_(pc.ascii_is_alpha(missing), pc.ascii_is_lower(missing)).to_numpy(zero_copy_only=False)
        other = pc.utf8_is_alpha(missing).to_numpy(zero_copy_only=False) & ~lower
        order, ids = [], []
        for which in lower, other:
            rows = np.flatnonzero(which)
            if len(rows):
                good, got = self._letters(missing.take(pa.array(rows)))
                order.append(rows[good])
                ids.append(got)
        rest = np.ones(len(missing), bool)
        rest[np.concatenate([*order, np.zeros(0, np.int64)])] = False
        order.append(np.flatnonzero(rest))
        ids.append(pa.array(self._lib(missing.filter(pa.array(rest)).to_pylist()), pa.large_binary()))
        ids = pa.concat_arrays(ids).take(pa.array(np.argsort(np.concatenate(order))))
        self.parts, self.ids = pa.concat_arrays([self.parts, missing]), pa.concat_arrays([self.ids, ids])
        self.met = np.concatenate([self.met, np.zeros(len(missing), np.int64)])

    def _parts(self, parts: pa.Array) -> pa.Array:
        """Ids of parts that are encoded on their own."""
        if self.parts.nbytes + self.ids.nbytes > PARTS_KEPT:
            kept = pa.array(np.sort(np.argsort(-self.met, kind="stable")[:len(self.met) // 2]))
            self.parts, self.ids, self.met = self.parts.take(kept), self.ids.take(kept), self.met[kept.to_numpy()]
        coded = parts.dictionary_encode()
        found, n = coded.dictionary, len(self.parts)
        place = pc.fill_null(pc.index_in(self.parts, found), -1).to_numpy()    # builds a table of the fewer
        known = np.flatnonzero(place >= 0)
        at = np.full(len(found), -1)
        at[place[known]] = known
        missing = at < 0
        if missing.any():
            self._learn(found.filter(pa.array(missing)))
            at[missing] = np.arange(n, len(self.parts))
        self.lookups += 1
        self.met[at] = self.lookups
        return self.ids.take(pa.array(at[coded.indices.to_numpy()]))

    @staticmethod
    def _ends_of(words: pa.Array, skipped: pa.Array) -> pa.Array:
        """The words without so many of their first bytes."""
        if not len(words):
            return words
        _, at, raw = words.buffers()
        at = np.frombuffer(at, np.int64, len(words) + 1, words.offset * 8)
        left = np.diff(at) - skipped.to_numpy()
        ends = np.cumsum(left)
        raw = np.frombuffer(raw, np.uint8)[np.arange(ends[-1]) + np.repeat(at[1:] - ends, left)]
        return pa.Array.from_buffers(words.type, len(words),
                                     [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(raw)])

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of words.  Punctuation after a letter or number at a word's end is
        split off by the tokenizer anyway, so both parts are looked up on their
        own; punctuation after anything else is one piece with it, so such words
        are encoded whole."""
        cores = pc.utf8_rtrim(words, characters=self._TAIL)
        lens = pc.binary_length(cores)
        cut = np.flatnonzero(pc.less(lens, pc.binary_length(words)).to_numpy(zero_copy_only=False))
        tailed = words.take(cut)
        last = pc.utf8_slice_codeunits(cores.take(cut), -1).dictionary_encode()
        apart = np.array([not c or self._ends_piece(c) for c in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]
        whole = np.zeros(len(words), bool)
        whole[cut[~apart]] = True
        cores = pc.if_else(pa.array(whole), words, cores)
        cores = pc.if_else(pc.string_is_ascii(cores), pc.ascii_lower(cores), cores)
        tails = self._ends_of(tailed.filter(pa.array(apart)), lens.take(cut[apart]))
        ids = self._parts(pa.concat_arrays([cores, pa.array([""], cores.type), tails]))
        at = np.zeros(len(words), np.int64)
        at[cut[apart]] = np.arange(len(tails)) + 1
        return pc.binary_join_element_wise(ids[:len(words)], ids[len(words):].take(pa.array(at)), pa.scalar(b"", ids.type))

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """Ids of the texts, about LEARNT bytes of texts at a time: each word
        that differs is looked up once, and the words' ids are laid out by Arrow."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        held = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            first, at = at, int(np.searchsorted(held, (held[at - 1] if at else 0) + LEARNT)) + 1
            chunk = texts[first:at]
            whole = pc.match_substring_regex(chunk, self._ODD)
            split = pc.utf8_split_whitespace(pc.if_else(whole, "", chunk))
            words = split.values.dictionary_encode()
            laid = self._words(words.dictionary).take(words.indices)
            _, ends, raw = laid.buffers()
            raw = memoryview(raw or b"")
            ends = np.frombuffer(ends, np.int64, len(laid) + 1)[split.offsets.to_numpy()].tolist()
            for i, odd in enumerate(whole.to_pylist()):
                yield self._lib([chunk[i].as_py()])[0] if odd else bytes(raw[ends[i]:ends[i + 1]])

    def __call__(self, text: str) -> bytes:
        return next(self.encode([text]))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


_RAW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()),
                  ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
                  ("ids", pa.binary()), ("counts", pa.binary())])
_RAW_DDL = ("part int, seq int, start bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
            "ids binary, counts binary")


def _encode_blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        use_memo(enc)
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        counts = np.zeros(enc.size, np.int64)
        doc_ids, lens, ids, held, seq, start = [], [], [], 0, 0, 0

        def block():
            nonlocal doc_ids, lens, ids, held, seq, start, counts
            raw = b"".join(ids)
            counts += np.bincount(np.frombuffer(raw, enc.dtype), minlength=enc.size)
            row = pa.RecordBatch.from_pylist([dict(part=part, seq=seq, start=start, doc_ids=doc_ids, n_tokens=lens,
                                                   ids=raw, counts=None)], schema=_RAW)
            seq, start = seq + 1, start + held
            doc_ids, lens, ids, held = [], [], [], 0
            return row

        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), enc.encode(pc.fill_null(b.column(1), ""))):
                raw += end
                doc_ids.append(doc_id)
                ids.append(raw)
                lens.append(len(raw) // width)
                held += lens[-1]
                if held >= BLOCK:
                    yield block()
        if doc_ids:
            yield block()
        if seq:
            yield pa.RecordBatch.from_pylist([dict(part=part, counts=counts.tobytes())], schema=_RAW)
    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for raw in b.column(0).to_pylist():
            n = np.frombuffer(raw, np.int64)
            total = n if total is None else total + n
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["id", "n"])


# --- variable-length code ------------------------------------------------------

def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    v = values.astype(np.uint32)
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = np.concatenate([extra, np.zeros(-len(v) % 4, np.uint8)]).reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    size = extra.astype(np.int64) + 1
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for k in range(4):
        m = extra >= k
        data[at[m] + k] = (v[m] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return control.astype(np.uint8).tobytes(), data.tobytes()


# Lengths of the four values of every control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of a (control, data) pair, by looking the control bytes up."""
    size = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    d = np.frombuffer(data, np.uint8)
    at = np.cumsum(size, dtype=np.int64) - size
    out = d[at].astype(np.uint32)
    for k in range(1, 4):
        m = size > k
        if not m.any():
            break
        out[m] |= d[at[m] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


_BLOCKS_DDL = ("part int, seq int, start bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
               "control binary, data binary")


def _pack_blocks(rank_of: np.ndarray, dtype: str):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                control, data = pack(rank_of[np.frombuffer(b.column("ids")[i].as_buffer(), dtype)])
                keep = [b.column(c).slice(i, 1) for c in ("part", "seq", "start", "doc_ids", "n_tokens")]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                    ["part", "seq", "start", "doc_ids", "n_tokens", "control", "data"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> str:
    """Encode every whole text of ``docs`` (doc_id, text) and write the token
    data set under ``path`` in ascending doc_id order (nulls first, equal ids by
    the md5 of the text); each document ends with ``end_id``.

    Documents are range-partitioned by doc_id, so order needs no single task;
    equal rows are told apart by a row number, so no doc_id is too common.
    Texts are encoded once; the ids wait in shared storage until their
    frequencies, summed per task and then per id, have given the ranks.  What
    passes through the driver is one number per vocabulary entry.  A null text
    is empty (its ids are the end id alone); an empty table gives empty tables."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    enc = encoder(tokenizer)
    order = [F.col("doc_id").asc_nulls_first(), F.col("key"), F.col("row")]
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key(F.col("text")).alias("key"),
                        F.monotonically_increasing_id().alias("row"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    raw_path = scratch_path(spark, "token-ids")
    map_arrow(rows, _encode_blocks(tokenizer, end_id), _RAW_DDL, memo=True).write.option("compression", "zstd").parquet(raw_path)
    raw = spark.read.schema(_RAW_DDL).parquet(raw_path)

    seen = (map_arrow(raw.where("counts is not null").select("counts"), _sum_counts, "id bigint, n bigint")
            .groupBy("id").agg(F.sum("n").alias("n")).toPandas())          # one row per vocabulary entry
    n = np.zeros(enc.size, np.int64)
    n[seen["id"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)
    ids = np.lexsort([np.arange(enc.size), -n])
    rank_of = np.empty(enc.size, np.uint32)
    rank_of[ids] = np.arange(enc.size)
    spark.createDataFrame([(int(r), int(i)) for r, i in enumerate(ids)], "rank int, id int") \
        .write.parquet(f"{path}/ranks")
    blocks = raw.where("ids is not null")
    (blocks.select("part", F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
     .groupBy("part").agg(F.sum("n").alias("n_tokens")).write.parquet(f"{path}/parts"))
    map_arrow(blocks.drop("counts"), _pack_blocks(rank_of, enc.dtype.str), _BLOCKS_DDL).write.parquet(f"{path}/blocks")
    return path


# --- reading -------------------------------------------------------------------

def _decode(ids: np.ndarray, with_ids: bool):
    def run(batches):
        for b in batches:
            cols = b.to_pydict()
            for part, start, docs, lens, control, data in zip(cols["part"], cols["start"], cols["doc_ids"],
                                                              cols["n_tokens"], cols["control"], cols["data"]):
                lens = np.array(lens, np.int64)
                ends = np.cumsum(lens)
                all_ids = ids[unpack(control, data, int(ends[-1]))]
                raw = all_ids.tobytes()
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lens.tolist())]
                out = [pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()),
                       pa.array(start + ends - lens), pa.array(lens), pa.array(crc, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32),
                                                        all_ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(out, ["part", "doc_id", "at", "n_tokens", "ids_crc32", "ids"][:len(out)])
    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of a token
    data set, decoded from its files; ``start`` counts the ids of all documents
    before it, ``ids_crc32`` is over little-endian unsigned 32-bit ids."""
    ranks = spark.read.schema("rank int, id int").parquet(f"{path}/ranks").toPandas()   # the vocabulary
    ids = np.zeros(len(ranks), "<u4")
    ids[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()
    blocks = spark.read.schema(_BLOCKS_DDL).parquet(f"{path}/blocks")
    ddl = "part int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    rows = map_arrow(blocks, _decode(ids, with_ids), ddl + ", ids array<bigint>" * with_ids)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (spark.read.schema("part int, n_tokens bigint").parquet(f"{path}/parts")       # a row per partition
             .select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before")))
    out = ["doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return rows.join(parts, "part").select(*out)
