"""Personal data: fixed patterns, and a character-level bidirectional LSTM with
CRF transitions for what the patterns miss.

The network is trained in numpy from labelled spans: those that the patterns
find in a bounded sample of documents, set next to each other, rewritten with
other separators, and mixed with numbers that are no personal data.  Overlapping
windows of a text are decoded one by one, and the decoded spans are reconciled
over the whole text."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import fresh, map_arrow

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 4000              # documents with a digit or an @ whose spans and contexts the network learns from, about
WINDOWS = 4096             # training windows made of them
WIDTH = 80                 # characters of a window ...
STEP = 40                  # ... and of the step to the next one
CONTEXT = 24               # characters round a place that may hold personal data
HIDDEN, EMBEDDED = 24, 12
STEPS, BATCH = 360, 64
_TOGETHER = 512            # windows decoded at once

# --- fixed patterns ----------------------------------------------------------------

# The patterns of the contract, written so that they take linear time on any text: digits and
# separators are taken whole, and no match starts inside a run that another start has failed on.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    own = [int(c) for c in reversed(digits)]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _is_card(s: str) -> bool:
    d = _digits(s)
    return 14 <= len(d) <= 19 and luhn(d)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", at + 1)


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, end, kind, whether it passes its check) of every pattern match."""
    if "@" in text:
        for a, b in _emails(text):
            yield a, b, 0, True
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            yield *m.span(), 1, all(map(_small, m[0].split(".")))
        for m in _CARD.finditer(text):
            yield *m.span(), 2, _is_card(m[0])
        if "+" in text:
            for m in _PHONE.finditer(text):
                yield *m.span(), 3, 10 <= len(_digits(m[0])) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, end, kind) of the patterns, by start and kind."""
    return sorted(((a, b, k) for a, b, k, good in _matches(text) if good), key=lambda s: (s[0], s[2]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


# --- windows -----------------------------------------------------------------------

# Places that personal data of these kinds must hold: a digit, an @, or one spelt out.
_PLACE = re.compile(r"[0-9@]|[\[({]\s?(?:at|dot)\s?[\])}]|\s(?:at|dot)\s(?=\S+\s?[\[({.]?\s?(?:dot\b|\.))", re.I)


def _regions(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches round the places that lie in no known span, overlaps joined."""
    out: list[tuple[int, int]] = []
    ends, far = [], 0
    for a, b, _ in known:
        far = max(far, b)
        ends.append(far)
    starts = [a for a, _, _ in known]
    for m in _PLACE.finditer(text):
        at = m.start()
        k = bisect_right(starts, at) - 1
        if k >= 0 and ends[k] > at:
            continue
        a, b = max(0, at - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def windows(text: str, known: list[tuple[int, int, int]]) -> Iterator[int]:
    """Starts of the windows over a text's regions: overlapping ones, so that
    each span up to WIDTH - STEP characters lies whole in one of them."""
    for a, b in _regions(text, known):
        first = max(0, min(a, len(text) - WIDTH))
        yield first
        while first + WIDTH < b:
            first = min(first + STEP, max(0, len(text) - WIDTH))
            yield first


_CODES = np.full(0x110000, 2, np.uint8)            # 2: any other character
_PAD = 0


def _fill_codes() -> None:
    _CODES[[c for c in range(0x250) if chr(c).isalpha()]] = 1                      # other Latin letters
    _CODES[[ord(c) for c in " \t\n\r\x0b\x0c "]] = 3
    _CODES[33:127] = np.arange(4, 98)


_fill_codes()
SYMBOLS = 98
TAGS = 1 + 2 * len(KINDS)                          # 0, then begin and inside of each kind


def encode(texts: list[str]) -> np.ndarray:
    """Windows as rows of WIDTH character numbers."""
    out = np.full((len(texts), WIDTH), _PAD, np.uint8)
    for row, t in zip(out, texts):
        row[:len(t)] = _CODES[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return out


# --- the network -----------------------------------------------------------------------

def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lse(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    """Bidirectional LSTM over characters, CRF over tags.  Both directions run
    as one batch: arrays begin with the direction."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        shape = {"embed": (SYMBOLS, EMBEDDED), "w": (2, EMBEDDED, 4 * HIDDEN), "u": (2, HIDDEN, 4 * HIDDEN),
                 "b": (2, 1, 4 * HIDDEN), "out": (2 * HIDDEN, TAGS), "bias": (TAGS,), "move": (TAGS, TAGS), "first": (TAGS,)}
        size = {"embed": 0.5, "w": 0.25, "u": 0.2, "out": 0.2}
        self.p = {k: (r.standard_normal(s) * size.get(k, 0.0)).astype(np.float32) for k, s in shape.items()}
        self.p["b"][:, :, HIDDEN:2 * HIDDEN] = 1.0                                 # remember at first
        # An inside tag follows only the begin or inside of its kind.
        self.banned = np.zeros((TAGS, TAGS), np.float32)
        for k in range(len(KINDS)):
            self.banned[:, 2 + 2 * k] = -1e4
            self.banned[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0.0

    def _run(self, ids: np.ndarray, keep: bool):
        """Hidden states (direction, position, window, unit); with ``keep`` all
        that the gradient needs."""
        p, h4 = self.p, HIDDEN
        both = np.stack([ids.T, ids.T[::-1]])                                      # direction, position, window
        table = np.matmul(p["embed"], p["w"]) + p["b"]                             # direction, symbol, gates
        n = len(ids)
        h = np.zeros((2, n, HIDDEN), np.float32)
        c = np.zeros_like(h)
        states = np.empty((2, WIDTH, n, HIDDEN), np.float32)
        kept = []
        for t in range(WIDTH):
            g = np.matmul(h, p["u"])
            g[0] += table[0][both[0, t]]
            g[1] += table[1][both[1, t]]
            g[..., :3 * h4] = _sigmoid(g[..., :3 * h4])
            g[..., 3 * h4:] = np.tanh(g[..., 3 * h4:])
            before, past = c, h
            c = g[..., h4:2 * h4] * c + g[..., :h4] * g[..., 3 * h4:]
            tc = np.tanh(c)
            h = g[..., 2 * h4:3 * h4] * tc
            states[:, t] = h
            if keep:
                kept.append((g, before, past, tc))
        return both, states, kept

    def emissions(self, ids: np.ndarray, states: np.ndarray | None = None) -> np.ndarray:
        """Scores (position, window, tag)."""
        if states is None:
            states = self._run(ids, False)[1]
        both = np.concatenate([states[0], states[1, ::-1]], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def step(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the windows' tags, and its gradient."""
        p, h4, n = self.p, HIDDEN, len(ids)
        both, states, kept = self._run(ids, True)
        e = self.emissions(ids, states)
        real = (ids.T != _PAD)
        move = p["move"] + self.banned
        # CRF: forward and backward sums; padding at the end of a window carries nothing.
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = p["first"] + e[0]
        for t in range(1, WIDTH):
            new = _lse(alpha[t - 1][:, :, None] + move, 1) + e[t]
            alpha[t] = np.where(real[t][:, None], new, alpha[t - 1])
        for t in range(WIDTH - 2, -1, -1):
            new = _lse(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(real[t + 1][:, None], new, beta[t + 1])
        z = _lse(alpha[-1], 1)
        share = np.exp(alpha + beta - z[None, :, None]) * real[:, :, None]
        gold, at, who = tags.T, np.arange(WIDTH)[:, None], np.arange(n)[None, :]
        score = (e[at, who, gold] * real).sum() + p["first"][gold[0]].sum() \
            + (move[gold[:-1], gold[1:]] * real[1:]).sum()
        loss = float(z.sum() - score) / n
        de = share.copy()
        de[at, who, gold] -= real
        de /= n
        g = {k: np.zeros_like(v) for k, v in p.items()}
        pair = np.exp(alpha[:-1, :, :, None] + move + (e[1:] + beta[1:])[:, :, None, :] - z[None, :, None, None])
        g["move"] = (pair * real[1:, :, None, None]).sum((0, 1))
        np.subtract.at(g["move"], (gold[:-1][real[1:]], gold[1:][real[1:]]), 1)
        g["move"] = np.where(self.banned < 0, 0, g["move"] / n).astype(np.float32)
        g["first"] = de[0].sum(0)
        flat = np.concatenate([states[0], states[1, ::-1]], axis=2)
        g["out"] = np.tensordot(flat, de, ([0, 1], [0, 1]))
        g["bias"] = de.sum((0, 1))
        dstate = de @ p["out"].T
        dh_out = np.stack([dstate[..., :h4], dstate[::-1, :, h4:]])
        dh = np.zeros((2, n, HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        gates = np.empty((2, WIDTH, n, 4 * HIDDEN), np.float32)
        ut = p["u"].transpose(0, 2, 1)
        for t in range(WIDTH - 1, -1, -1):
            gate, before, past, tc = kept[t]
            i, f, o, a = (gate[..., k * h4:(k + 1) * h4] for k in range(4))
            dh = dh + dh_out[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dg = np.concatenate([dc * a * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - a * a)], 2)
            g["u"] += np.matmul(past.transpose(0, 2, 1), dg)
            gates[:, t] = dg
            dh, dc = np.matmul(dg, ut), dc * f
        symbols = np.arange(SYMBOLS)[:, None]
        dtable = np.stack([(symbols == both[d].ravel()).astype(np.float32) @ gates[d].reshape(WIDTH * n, -1) for d in (0, 1)])
        g["b"] = dtable.sum(1, keepdims=True)
        g["w"] = np.matmul(p["embed"].T, dtable)
        g["embed"] = np.matmul(dtable, p["w"].transpose(0, 2, 1)).sum(0)
        return loss, g

    def train(self, ids: np.ndarray, tags: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 4) -> list[float]:
        """Adam over shuffled batches, the rate falling to zero."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses, order = [], np.empty(0, np.int64)
        for s in range(1, steps + 1):
            if len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(ids))])
            take, order = order[:batch], order[batch:]
            loss, g = self.step(ids[take], tags[take])
            losses.append(loss)
            size = float(np.sqrt(sum((x * x).sum() for x in g.values())))
            rate = 0.02 * (1 - (s - 1) / steps) * min(1.0, s / 10)
            for k in self.p:
                x = g[k] * min(1.0, 5.0 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.p[k] -= (rate * (m[k] / (1 - 0.9 ** s)) / (np.sqrt(v[k] / (1 - 0.99 ** s)) + 1e-8)).astype(np.float32)
        return losses

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window (Viterbi), and how much each position's tag
        outscores the outside tag."""
        e = self.emissions(ids)
        move = self.p["move"] + self.banned
        n = len(ids)
        score, back = self.p["first"] + e[0], np.zeros((WIDTH, n, TAGS), np.int8)
        for t in range(1, WIDTH):
            ways = score[:, :, None] + move
            back[t] = ways.argmax(1)
            score = ways.max(1) + e[t]
        tags = np.empty((WIDTH, n), np.int64)
        tags[-1] = score.argmax(1)
        who = np.arange(n)
        for t in range(WIDTH - 1, 0, -1):
            tags[t - 1] = back[t, who, tags[t]]
        lead = np.take_along_axis(e, tags[:, :, None], 2)[:, :, 0] - e[:, :, 0]
        return tags.T, lead.T


# --- training windows ---------------------------------------------------------------------

def _new_digits(rng: random.Random, s: str) -> str:
    return "".join(str(rng.randrange(10)) if "0" <= c <= "9" else c for c in s)


def _rewrite(rng: random.Random, kind: int, s: str) -> str:
    """A span like a labelled one: other digits, sometimes other separators."""
    if kind == 0:
        at = s.rfind("@")
        name = rng.choice([s[:at], s[:at] + str(rng.randrange(100)), s[:at].split(".")[0]]) or s[:at]
        how = rng.random()
        host = s[at + 1:]
        if how < 0.5:
            return f"{name}@{host}"
        left, right = rng.choice([(" (", ") "), ("(", ")"), (" [", "] "), ("[", "]"), (" ", " ")])
        dot = f"{left}dot{right}" if rng.random() < 0.6 or left == " " else "."
        return (name if dot == "." else name.replace(".", dot)) + f"{left}at{right}" + host.replace(".", dot)
    if kind == 1:
        dot = "." if rng.random() < 0.5 else rng.choice(["[.]", "(.)", " . ", "[dot]"])
        return dot.join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        d = _new_digits(rng, _digits(s))
        d = next(d[:-1] + c for c in "0123456789" if luhn(d[:-1] + c))
        sep = rng.choice(["", "", "", " ", "-", ".", "/", " ", " - "])
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    s = _new_digits(rng, s)
    if rng.random() < 0.6:
        return s
    groups = re.findall(r"[0-9]+", s)
    if len(groups) < 3:
        groups = [s[1:2], *re.findall(r"[0-9]{1,4}", _digits(s)[1:])]
    sep = rng.choice([" ", "-", ".", "/", " "])
    return rng.choice(["+", "+", "", "00"]) + sep.join(groups)


def _distractor(rng: random.Random) -> str:
    """Numbers that are no personal data."""
    n = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))                # noqa: E731
    return rng.choice([
        lambda: n(rng.randint(1, 12)), lambda: f"{1900 + rng.randrange(130)}-{1 + rng.randrange(12):02}-{1 + rng.randrange(28):02}",
        lambda: f"{rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}", lambda: f"{n(rng.randint(1, 4))}.{n(2)}",
        lambda: f"{rng.randrange(10)}.{rng.randrange(20)}.{rng.randrange(99)}", lambda: f"{rng.randrange(20)}.",
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(6, 40))),
        lambda: f"{n(3)},{n(3)},{n(3)}", lambda: f"{n(2)}-{n(3)}", lambda: f"{n(4)}-{n(2)}-{n(2)} {n(2)}:{n(2)}:{n(2)}",
        lambda: f"({n(4)})", lambda: f"{n(3)}/{n(4)}", lambda: f"@{rng.choice('abcdef')}{n(3)}", lambda: f"{n(1)}.{n(1)}.",
        lambda: f"{n(2)}.{n(2)}.{n(4)}", lambda: f"{n(3)} {n(3)} {n(2)}"])()


def training_set(spans: list[tuple[int, str]], contexts: list[str], count: int = WINDOWS,
                 seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """``count`` windows and their tags, made of labelled spans (kind, text) and
    contexts without personal data."""
    rng = random.Random(seed)
    by_kind = [sorted({s for k, s in spans if k == kind}) for kind in range(len(KINDS))]
    have = [k for k, x in enumerate(by_kind) if x]
    texts, tags = [], []
    contexts = sorted(set(contexts)) or [" "]
    for _ in range(count):
        text, tag = "", []

        def add(s, kind=None):
            nonlocal text
            text += s
            tag.extend([0] * len(s) if kind is None else [1 + 2 * kind] + [2 + 2 * kind] * (len(s) - 1))

        def context():
            c = rng.choice(contexts)
            at = rng.randrange(max(1, len(c) - 50))
            add(c[at:at + rng.randint(5, 50)])
            if rng.random() < 0.9:
                add(rng.choice([" ", " ", " ", "\n", ": ", " (", ", "]))
        context()
        for _ in range(rng.choice([0, 1, 1, 1, 2, 2, 3])):
            if have and rng.random() < 0.72:
                kind = rng.choice(have)
                add(_rewrite(rng, kind, rng.choice(by_kind[kind])), kind)
            else:
                add(_distractor(rng))
            add(rng.choice([" ", " ", " ", ", ", ". ", "\n", " | ", ") ", "; "]))
        context()
        at = rng.randrange(max(1, len(text) - WIDTH + 1))
        texts.append(text[at:at + WIDTH])
        tags.append((tag[at:at + WIDTH] + [0] * WIDTH)[:WIDTH])
    return encode(texts), np.array(tags)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled spans (kind, text) of texts, and (-1, stretches without any place)."""
    for b in batches:
        kinds, texts = [], []
        for text in b.column(0).to_pylist():
            known = base_spans(text)
            for a, e, k in known:
                if e - a <= WIDTH:
                    kinds.append(k)
                    texts.append(text[a:e])
            at = len(kinds) % max(1, len(text) - 200)
            if not _PLACE.search(text, at, at + 200):
                kinds.append(-1)
                texts.append(text[at:at + 200])
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], ["kind", "text"])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Tagger | None:
    """A tagger trained on the labelled spans of about ``sample`` documents with
    a digit or an @ (those with the smallest hashes of their text: the bounded,
    documented sample; a smaller table gives all).  None if they hold no span."""
    some = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    total = some.count()
    part = F.abs(F.xxhash64("text") % F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = some.where(part * F.lit(total) <= sample).distinct()
    got = map_arrow(drawn, _labelled, "kind int, text string").distinct().orderBy("kind", F.xxhash64("text"), "text") \
        .limit(8 * sample).collect()                                               # bounded by the sample
    spans = [(r["kind"], r["text"]) for r in got if r["kind"] >= 0]
    if not spans:
        return None
    tagger = Tagger()
    tagger.train(*training_set(spans, [r["text"] for r in got if r["kind"] < 0]))
    return tagger


# --- decoding -----------------------------------------------------------------------------

_AT = re.compile(r"\s?[\[({]\s?at\s?[\])}]\s?|\sat\s", re.I)
_DOT = re.compile(r"\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s|\s\.\s", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_FOUR = re.compile(r"[0-9]+(?:\.[0-9]+){3}")


def holds(kind: int, s: str) -> bool:
    """Whether a decoded span is personal data of its kind: the patterns' own
    checks, after spelt-out signs and other separators are put aside."""
    if kind == 0:
        return bool(_EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", s))))
    if kind == 1:
        plain = _DOT.sub(".", s)
        return bool(_FOUR.fullmatch(plain)) and all(map(_small, plain.split(".")))
    if any(c.isalpha() for c in s):
        return False
    if kind == 2:
        return _is_card(s)
    d = _digits(s)
    return 10 <= len(d) <= 15 and (s[0] == "+" or len(re.findall("[0-9]+", s)) >= 3)


def _trimmed(text: str, a: int, b: int, kind: int) -> tuple[int, int]:
    """Without what cannot begin or end a span."""
    good = (lambda c: c.isalnum() or c in "_%+-") if kind == 0 else (lambda c: "0" <= c <= "9")
    while a < b and not (good(text[a]) or kind == 3 and text[a] in "+("):
        a += 1
    while b > a and not good(text[b - 1]):
        b -= 1
    return a, b


def reconcile(text: str, known: list[tuple[int, int, int]], pieces: list[tuple[int, int, int, float, bool, bool]]
              ) -> list[tuple[int, int, int]]:
    """Spans to add to the known ones, from the pieces (start, end, kind, score,
    cut on the left, cut on the right) of all of a text's windows: pieces of one
    kind that windows have cut are joined where they overlap; each must hold;
    of those that overlap, the set with the greatest total score stays."""
    whole = {(a, b, k): s for a, b, k, s, left, right in pieces if not (left or right)}
    for kind in range(len(KINDS)):
        cut = sorted((a, b, s) for a, b, k, s, left, right in pieces if k == kind and (left or right))
        far = None
        for a, b, s in [*cut, (len(text) + 2, len(text) + 2, 0.0)]:
            if far and a <= far[1]:
                far = far[0], max(b, far[1]), max(s, far[2])
                continue
            if far:
                whole.setdefault((far[0], far[1], kind), far[2])
            far = a, b, s
    found: dict[tuple[int, int, int], float] = {}
    starts = [a for a, _, _ in known]
    ends, top = [], 0
    for _, b, _ in known:
        top = max(top, b)
        ends.append(top)
    for (a, b, kind), score in whole.items():
        a, b = _trimmed(text, a, b, kind)
        k = bisect_right(starts, b - 1) - 1
        if a < b and not (k >= 0 and ends[k] > a) and holds(kind, text[a:b]):
            found[a, b, kind] = max(score, found.get((a, b, kind), 0.0), 1e-6)
    order = sorted(found, key=lambda x: (x[1], x[0], x[2]))
    last, best, keep = [x[1] for x in order], [0.0], []
    for i, x in enumerate(order):
        before = bisect_right(last, x[0], 0, i)
        take = best[before] + found[x]
        keep.append((take > best[-1], before))
        best.append(max(best[-1], take))
    out, i = [], len(order)
    while i:
        taken, before = keep[i - 1]
        if taken:
            out.append(order[i - 1])
        i = before if taken else i - 1
    return out


def _pieces(start: int, length: int, tags: np.ndarray, lead: np.ndarray) -> Iterator[tuple]:
    at = 0
    n = min(WIDTH, length - start)
    while at < n:
        if not tags[at]:
            at += 1
            continue
        kind, end = (int(tags[at]) - 1) // 2, at + 1
        while end < n and tags[end] == 2 + 2 * kind:
            end += 1
        yield (start + at, start + end, kind, float(lead[at:end].sum()), at == 0 and start > 0,
               end == n and start + n < length)
        at = end


def find_all(texts: list[str], tagger: Tagger | None) -> Iterator[tuple[list, list]]:
    """(base spans, added spans) of every text."""
    known = [base_spans(t) for t in texts]
    found: list[list] = [[] for _ in texts]
    held: list[tuple[int, int]] = []

    def run():
        ids = encode([texts[i][a:a + WIDTH] for i, a in held])
        tags, lead = tagger.decode(ids)
        for (i, a), t, s in zip(held, tags, lead):
            found[i].extend(_pieces(a, len(texts[i]), t, s))
        held.clear()
    for i, text in enumerate(texts if tagger else ()):
        for a in windows(text, known[i]):
            held.append((i, a))
            if len(held) == _TOGETHER:
                run()
    if held:
        run()
    for text, base, pieces in zip(texts, known, found):
        yield base, reconcile(text, base, pieces)


def _find(tagger, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(text_at).to_pylist()]
            counts, digests, spans = [[] for _ in KINDS], [], []
            for base, added in find_all(texts, tagger.value):
                for k, n in enumerate(counts):
                    n.append(sum(s[2] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + added))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(n, pa.int64()) for n in counts),
                                              pa.array(digests, pa.string()), pa.array(spans, pa.string())], names)
    return run


def span_columns(docs: DataFrame) -> list[str]:
    return fresh(docs, *(f"n_{k}" for k in KINDS), "base_sha256", "spans")


def find_personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with the columns ``span_columns(docs)``: the number of pattern
    spans of each kind, the SHA-256 of ``kind:start:end`` of all pattern spans,
    and ``spans``, those and the added ones, in code points, end exclusive, by
    start and then kind, joined by commas.

    Every whole text is read; the network looks at windows round each digit, @
    or spelt-out sign that lies in no pattern span, since without one there is
    nothing of these kinds.  An added span overlaps no pattern span and passes
    the check of its kind (a card's digits, numbers up to 255, a whole address).
    Without a tagger nothing is added.  Null and empty texts have no spans, rows
    are independent of each other, repeated rows get equal results, other
    columns pass through, and an empty table gives none."""
    names = span_columns(docs)
    schema = StructType([*docs.schema.fields, *(StructField(n, LongType()) for n in names[:4]),
                         *(StructField(n, StringType()) for n in names[4:])])
    return map_arrow(docs, _find(docs.sparkSession.sparkContext.broadcast(tagger), docs.columns.index("text"), schema.names),
                     schema)
