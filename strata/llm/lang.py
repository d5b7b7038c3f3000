"""Language ID: segmentation-marginalised unigrams over a fixed public vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import fresh, map_arrow, use_memo

SAMPLE = 1500              # documents of each language that the model is fitted on, about
SMOOTHING = 0.5            # added to every piece count
WORDS_KEPT = 300_000       # words whose scores a worker keeps
LONG = 40                  # characters from which a word is scored on its own
UNKNOWN = "und"
_RUNS = re.compile(r"[^\W\d_]+")
_START = "▁"
LEARNT = 1 << 21           # characters of texts whose new words are learnt together, about
_TOGETHER = 4096           # words of one length that the forward algorithm runs over at once


def letter_runs(text: str) -> list[str]:
    """The runs of letters (Unicode's class L, so no numerals such as ½ or ⅷ) of
    the lower-cased text."""
    runs = _RUNS.findall(text.lower())
    if not runs or "".join(runs).isalpha():
        return runs
    return [w for r in runs for w in ([r] if r.isalpha() else "".join(c if c.isalpha() else " " for c in r).split())]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def pieces(path: str) -> list[str]:
    """The vocabulary's pieces that lower-cased words can be made of."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i)
                                                                         or sp.is_unknown(i))}
    return sorted(p for p in {p.lower() for p in out} if (p.removeprefix(_START) or "a").isalpha())


class Trie:
    """The pieces as a trie whose steps many words take at once: edges are
    (state, character) pairs in a hash table of two arrays."""

    def __init__(self, vocab: list[str]):
        self.letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(vocab))))}
        self.width = len(self.letters) + 1               # 0: a character of no piece
        edges: dict[int, int] = {}
        ends = {}
        for row, piece in enumerate(vocab, start=1):
            state = 0
            for c in piece:
                state = edges.setdefault(state * self.width + self.letters[c], len(edges) + 1)
            ends[state] = row
        self.row = np.full(len(edges) + 1, -1)           # the piece that ends at a state
        self.row[list(ends)] = list(ends.values())
        bits = max(4, (8 * len(edges)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.next = np.full(1 << bits, -1), np.full(1 << bits, -1, np.int32)
        todo = np.array(list(edges), np.int64)
        to = np.array(list(edges.values()), np.int32)
        at = self._slot(todo)
        while len(todo):
            free = self.keys[at] == -1
            self.keys[at[free]], self.next[at[free]] = todo[free], to[free]
            left = self.keys[at] != todo                 # another edge took the slot
            todo, to, at = todo[left], to[left], (at[left] + 1) % len(self.keys)
        codes = np.array([ord(c) for c in self.letters], np.int64)
        self.code = np.zeros(int(codes.max(initial=0)) + 2, np.int32)
        self.code[codes] = list(self.letters.values())

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def read(self, words: list[str]) -> np.ndarray:
        """Words of one length as rows of character numbers."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
        return self.code[np.minimum(codes, len(self.code) - 1)]

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states that follow, -1 where there is none."""
        key = state.astype(np.int64) * self.width + letter
        at = self._slot(key)
        seen = self.keys[at]
        out = np.where(seen == key, self.next[at], -1)
        wait = np.flatnonzero((seen != key) & (seen != -1))
        while len(wait):
            at[wait] = (at[wait] + 1) % len(self.keys)
            seen = self.keys[at[wait]]
            found = seen == key[wait]
            out[wait[found]] = self.next[at[wait[found]]]
            wait = wait[~found & (seen != -1)]
        return out


class Model:
    """log P(word | language), summed over all segmentations of the word into
    pieces, each piece with its language's unigram probability."""

    def __init__(self, vocab: list[str], langs: list[str], counts: np.ndarray):
        """counts: pieces x languages.  A character that no piece covers has the
        probability of a piece never seen."""
        self.langs = langs
        total = counts.sum(0) + SMOOTHING * (len(vocab) + 1)
        # Row 0 is the character that no piece covers, the last row no piece at all.
        self.p = np.vstack([np.full((1, len(langs)), SMOOTHING), counts + SMOOTHING, np.zeros((1, len(langs)))])
        self.p /= total
        self.table = {w: i + 1 for i, w in enumerate(vocab)}
        self.longest = max(map(len, vocab), default=1)
        self.trie = Trie(vocab)
        size = np.array([1, *map(len, vocab), 1])[:, None]
        self.scale = self.p[0] ** -0.5
        self.scaled = self.p * self.scale ** size
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.empty((0, len(self.langs)))

    def _piece(self, s: str, i: int, j: int) -> int:
        return self.table.get(s[i:j], 0 if j == i + 1 else -1)

    def _equal(self, words: list[str]) -> np.ndarray:
        """The forward algorithm over words of one length: alpha[j] sums, over
        the pieces that end at j, alpha[i] * P(piece).  Only pieces that the
        words hold are met, by walks in the trie from every start.  Each
        character's probability is scaled up by a fixed factor, taken off again
        at the end, so that sums of many rare pieces stay far from the least
        double however large the counts are."""
        n, trie = len(words[0]) + 1, self.trie
        letters = trie.read([_START + w for w in words])
        alpha = np.zeros((n + 1, len(words), len(self.langs)))
        alpha[0] = 1.0
        for i in range(n):
            live = np.arange(len(words))
            state = trie.step(np.zeros(len(words), np.int32), letters[:, i])
            alpha[i + 1] += alpha[i] * self.scaled[np.where(state >= 0, np.maximum(trie.row[state], 0), 0)]
            for j in range(i + 1, n):
                live, state = live[state >= 0], state[state >= 0]
                if not len(live):
                    break
                state = trie.step(state, letters[live, j])
                row = np.where(state >= 0, trie.row[state], -1)
                hit = np.flatnonzero(row >= 0)
                if len(hit):
                    alpha[j + 1, live[hit]] += alpha[i, live[hit]] * self.scaled[row[hit]]
        return np.log(alpha[n]) - n * np.log(self.scale)

    def _long(self, word: str) -> np.ndarray:
        """The same for one long word, in logarithms."""
        s, logs = _START + word, np.log(np.maximum(self.p, 1e-300))
        alpha = [np.zeros(len(self.langs))]
        for j in range(1, len(s) + 1):
            first = max(0, j - self.longest)
            ways = [alpha[i - first if first else i] + logs[at] for i in range(first, j)
                    if (at := self._piece(s, i, j)) >= 0]
            alpha.append(np.logaddexp.reduce(ways))
            alpha = alpha[-self.longest:] if j >= self.longest else alpha
        return alpha[-1]

    def _learn(self, missing: set[str]) -> None:
        if len(self.known) + len(missing) > WORDS_KEPT:
            self.known.clear()
        by_length: dict[int, list[str]] = {}
        for w in missing:
            by_length.setdefault(len(w), []).append(w)
        at = len(self.known)
        if at + len(missing) > len(self.scores):
            grown = np.empty((max(at + len(missing), 2 * len(self.scores)), len(self.langs)))
            grown[:at] = self.scores[:at]
            self.scores = grown
        for n, words in by_length.items():
            for first in range(0, len(words), _TOGETHER):
                some = words[first:first + _TOGETHER]
                got = self._equal(some) if n < LONG else [self._long(w) for w in some]
                self.scores[at:at + len(some)] = got
                self.known.update(zip(some, range(at, at + len(some))))
                at += len(some)

    def logs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """log P(text | language) of every text, and whether it has a letter."""
        out = np.zeros((len(texts), len(self.langs)))
        has = np.zeros(len(texts), bool)
        at = 0
        while at < len(texts):
            part, held = [], 0              # texts whose new words are learnt together
            while at < len(texts) and held < LEARNT:
                text = texts[at] or ""
                part.append(letter_runs(text))
                held += len(text)
                at += 1
            missing = set().union(*part).difference(self.known)
            if missing:
                if len(self.known) + len(missing) > WORDS_KEPT:
                    self.known.clear()
                    missing = set().union(*part)
                self._learn(missing)
            for i, words in enumerate(part, at - len(part)):
                if words:
                    has[i] = True
                    out[i] = self.scores[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(0)
        return out, has


def _count_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = sp.encode(" ".join(letter_runs(text)))
                n = np.bincount(ids, minlength=sp.get_piece_size())
                counts[lang] = counts[lang] + n if lang in counts else n
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array([sp.id_to_piece(int(i)) for i in at]), pa.array(n[at])],
                ["lang", "piece", "n"])
    return run


def held_out(doc_id) -> F.Column:
    """Documents kept from training: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, vocabulary: str | None = None, sample: int = SAMPLE) -> Model:
    """Piece probabilities of each value of ``lang``, from documents that are
    not held out: about ``sample`` of each language, those with the smallest
    hashes of doc_id (the bounded, documented sample; a language with fewer
    gives all).  Executors count the pieces; the driver gets at most a number
    per piece and language."""
    vocabulary = vocabulary or default_vocabulary()
    train = docs.where(~held_out(F.col("doc_id"))).where("lang is not null and text is not null") \
                .select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    per = train.groupBy("lang").agg(F.count("*").alias("n"))
    part = F.abs(F.xxhash64("doc_id") % F.lit(1 << 30)) / F.lit(float(1 << 30))
    # One row per language, as the model has a column per language.
    drawn = train.join(F.broadcast(per), "lang").where(part * F.col("n") <= sample).select("lang", "text")
    counts = (map_arrow(drawn, _count_pieces(vocabulary), "lang string, piece string, n bigint")
              .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas())
    vocab = pieces(vocabulary)
    langs = sorted(r["lang"] for r in per.select("lang").collect())
    row, col = {p: i for i, p in enumerate(vocab)}, {x: i for i, x in enumerate(langs)}
    table = np.zeros((len(vocab), len(langs)))
    for lang, piece, n in counts.itertuples(index=False):
        if piece in row:
            table[row[piece], col[lang]] += n
    return Model(vocab, langs, table)


def _predict(model, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        use_memo(m)
        langs = np.array([*m.langs, UNKNOWN], object)
        for b in batches:
            logs, has = m.logs(b.column(text_at).to_pylist())
            if m.langs:
                p = np.exp(logs - logs.max(1, keepdims=True))
                best = p.argmax(1)
                score = p.max(1) / p.sum(1)
            else:
                has, best, score = np.zeros(len(has), bool), np.zeros(len(has), int), np.zeros(len(has))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(langs[np.where(has, best, -1)].tolist(), pa.string()),
                 pa.array(np.where(has, score, 0.0))], names)
    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with two more columns, lang_pred and score (named otherwise if
    they clash: see ``prediction_columns``).

    A text's words are its runs of letters, lower-cased.  The score is the
    predicted language's share of the languages' likelihoods, 0 to 1.  A null
    text, or one without a letter, is ``und`` with score 0; so is every text if
    the model has no language.  Only the text is read; rows are independent, so
    repeated rows and null ids need no care.  An empty table gives none."""
    spark = docs.sparkSession
    pred, score = prediction_columns(docs)
    schema = StructType([*docs.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())])
    return map_arrow(docs, _predict(spark.sparkContext.broadcast(model), docs.columns.index("text"), schema.names), schema,
                     memo=True)


def prediction_columns(docs: DataFrame) -> list[str]:
    return fresh(docs, "lang_pred", "score")
