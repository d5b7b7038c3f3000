"""Token counts: greedy word pieces counted by a linear longest-match automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, use_memo

START = "▁"                # marks a word's first piece
WORDS_KEPT = 300_000       # words whose counts a worker keeps
LONG = 64                  # longer words are counted each time


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> list[str]:
    """Pieces of a public sentencepiece vocabulary, without its bytes and marks."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]


class Automaton:
    """A vocabulary trie with failure links.

    Where a text leaves the trie at a node, greedy matching has certainly
    produced some pieces of the node's string; ``pops`` counts them and
    ``fail`` is the node of what is left.  Following the links instead of going
    back in the text makes the count linear in its length.  A character that
    starts no piece counts as its UTF-8 bytes."""

    def __init__(self, vocab: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in vocab:
            v = 0
            for c in piece:
                if c not in self.next[v]:
                    self.next[v][c] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                v = self.next[v][c]
            ends[v] = True
        self.fail = [0] * len(self.next)
        self.pops = [0] * len(self.next)
        queue = []
        for c, v in self.next[0].items():
            self.pops[v] = 1 if ends[v] else len(c.encode("utf-8", "surrogatepass"))
            queue.append(v)
        for u in queue:                       # breadth first; grows as it is read
            for c, v in self.next[u].items():
                if ends[v]:
                    self.fail[v], self.pops[v] = 0, 1
                else:
                    z, n = self.fail[u], self.pops[u]
                    while c not in self.next[z] and z:
                        n += self.pops[z]
                        z = self.fail[z]
                    if c in self.next[z]:
                        z = self.next[z][c]
                    else:
                        n += len(c.encode("utf-8", "surrogatepass"))
                    self.fail[v], self.pops[v] = z, n
                queue.append(v)

    def count(self, word: str) -> int:
        nxt, fail, pops = self.next, self.fail, self.pops
        v = n = 0
        for c in word:
            while c not in nxt[v]:
                if not v:
                    n += len(c.encode("utf-8", "surrogatepass"))
                    break
                n += pops[v]
                v = fail[v]
            else:
                v = nxt[v][c]
        while v:
            n += pops[v]
            v = fail[v]
        return n


class Counts:
    """Counts of the words met by a worker."""

    def __init__(self, path: str):
        self.auto, self.known = Automaton(load_pieces(path)), {}

    def forget(self) -> None:
        self.known.clear()


_MADE: dict[str, Counts] = {}


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _MADE:
            _MADE[path] = Counts(path)
        use_memo(_MADE[path])
        auto, known = _MADE[path].auto, _MADE[path].known
        for b in batches:
            n_words, n_tokens = [], []
            for text in b.column(1).to_pylist():
                words = text.split() if text else []
                for w in set(words).difference(known):
                    if len(w) <= LONG:
                        known[w] = auto.count(START + w)
                n_words.append(len(words))
                n_tokens.append(sum(known[w] if len(w) <= LONG else auto.count(START + w) for w in words)
                                if any(len(w) > LONG for w in words) else sum(map(known.__getitem__, words)))
                if len(known) > WORDS_KEPT:
                    known.clear()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             ["doc_id", "n_words", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every whole text, one row per input row.

    Words are what white space separates; each counts as many pieces as greedy
    longest-match tokenisation of the word (with the start mark before it) over
    the vocabulary yields, without building a piece.  A null or empty text has
    0 words.  Rows are independent: nothing is shuffled, repeated rows and null
    ids need no care, an empty table gives an empty result."""
    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
                     _counter(vocabulary or default_vocabulary()), "doc_id bigint, n_words bigint, n_tokens bigint",
                     memo=True)
