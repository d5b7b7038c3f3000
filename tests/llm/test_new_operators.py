"""Whitening, personal data and ranked search against brute-force versions."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from strata.llm import lexical, pii, queries, whitening
from strata.llm.common import table
from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("component", T.IntegerType())])


# --- whitening ---------------------------------------------------------------------

def _whitened(rows):
    """By numpy's own solver, over distinct integer vectors."""
    x = {i: np.floor(64 * np.array(v, float)).astype(np.int64) + 1000000 for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, total = len(fit), fit.sum(0)
    d = fit - total / n
    v = d.T @ d / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    keep = e > 1e-13 * np.trace(v)
    return x, n, total, v, e[keep], u[:, keep]


def _check(got, rows):
    x, n, total, v, e, u = _whitened(rows)
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, k + 1) for i in x for k in range(len(e)))
    y = np.zeros((len(x), len(e)))
    at = {i: k for k, i in enumerate(x)}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["deviation"] == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[r["vec_id"]], total))
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(v), rel=1e-9)
        y[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    want = (np.array(list(x.values())) - total / n) @ u / np.sqrt(e)
    for k in range(len(e)):
        assert min(np.abs(y[:, k] - want[:, k]).max(), np.abs(y[:, k] + want[:, k]).max()) < 1e-6


def test_whitening_of_the_given_vectors(spark):
    rows = [(r[0], r[1]) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    _check(queries.op11_embedding_whitening(spark, SF).collect(), rows)


@pytest.mark.parametrize("d,n", [(1, 5), (3, 40), (20, 6), (40, 300)])
def test_whitening_of_random_vectors(spark, d, n):
    rng = np.random.default_rng(d)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((n, d)) * rng.uniform(0.2, 9, d))]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]                          # copies count once
    _check(whitening.whiten(spark.createDataFrame([(*r, 7) for r in rows], VECTORS)).collect(), rows)


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0]), (2, [2.0, -1.0]), (3, [0.0, 0.25]), (3, [0.0, 0.25]), (None, [0.5, 1.0])]
    bad = [(4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame([(*r, None) for r in good + bad], VECTORS)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == sorted((i or 0, k) for i, _ in good for k in (1, 2))
    assert {r["n"] for r in got} == {3}
    for rows in ([], bad[:5], good[:1] * 3):                                     # no vector, or no spread
        out = whitening.whiten(spark.createDataFrame([(*r, None) for r in rows], VECTORS))
        assert out.count() == 0 and out.columns == [c.split()[0] for c in whitening._OUT.split(", ")]
    far = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [1.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame([(*r, None) for r in far], VECTORS)).collect()
    assert {r["vec_id"]: r["deviation"] is None for r in got} == {1: True, 2: True, 3: False}
    assert all(math.isfinite(r["whitened"]) for r in got)


def test_sums_of_products_are_exact():
    import pyarrow as pa
    rng = np.random.default_rng(1)
    for top in (100, 1 << 40, 1 << 61):
        x = rng.integers(-top, top, (50, 3))
        batch = pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.int64()))], ["x"])
        got = {}
        for b in whitening._sum_products(np.zeros(3, np.int64))(iter([batch])):
            for p, i, j, v in zip(*(c.to_pylist() for c in b.columns)):
                got[i, j] = got.get((i, j), 0) + (v << (whitening._LIMB * p))
        assert got == {(i, j): sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for i in range(3) for j in range(i, 3)}


@pytest.mark.parametrize("spectrum", [[5.0] * 3 + [4.0] * 20 + [1.0] * 17, [1.0] * 40, list(range(1, 41)),
                                      [1e6, 1e3, 1.0, 1e-3] + [1e-6] * 36, [3.0, 2.0] + [0.0] * 38])
def test_components_of_any_spectrum(spark, spectrum):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    a = (q * np.array(spectrum)) @ q.T
    value, vector = whitening.components(spark, (a + a.T) / 2)
    want = sorted((x for x in spectrum if x > 1e-13 * sum(spectrum)), reverse=True)[:16]
    assert np.allclose(value, want, rtol=1e-9, atol=1e-12 * max(spectrum))
    assert np.abs(a @ vector - vector * value).max() < 1e-13 * max(spectrum) * 40
    assert np.abs(vector.T @ vector - np.eye(len(value))).max() < 1e-8


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        shifts = np.linspace(-12, 12, 41)
        assert (whitening.above(whitening.tridiagonal(a), shifts) == [(np.linalg.eigvalsh(a) > s).sum() for s in shifts]).all()


# --- personal data -----------------------------------------------------------------

BASE = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0


def _brute(text):
    out = []
    for kind, p in enumerate(BASE):
        for m in p.finditer(text):
            d = "".join(c for c in m[0] if c.isdigit())
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == 2 and 14 <= len(d) <= 19 and _luhn(d) or kind == 3 and 10 <= len(d) <= 15):
                out.append((m.start(), kind, m.end()))
    return [(a, b, k) for a, k, b in sorted(out)]


def test_patterns_against_the_contract():
    rng = random.Random(0)
    for letters in ("a@.-+1 ", "19. +()-", "0123456789 -", "x@y.z%_+1\n", "4 1+(9).-é"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == _brute(text), text
    text = "4111 1111-1111 1111, 4111111111111111 a.b@c.d-e.f 001.2.3.255 +1 (974) 555-3436 x"
    assert pii.base_spans(text) == _brute(text) and len(_brute(text)) == 5


def test_very_long_runs_take_linear_time():
    import time
    start = time.time()
    for unit in ("1", "1.", "1 ", "a", "a@", "+", "+1 ", "@", ".", "a.", "1-", "+1("):
        pii.base_spans(unit * (1_000_000 // len(unit)))
    assert time.time() - start < 30


def test_personal_data_query(spark):
    texts = {r[0]: r[1] or "" for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    got = queries.op12_personal_data(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base = _brute(texts[r["doc_id"]])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[2] == k for s in base) for k in range(4)]
        assert set(text.split(",")) <= set(r["spans"].split(",")) or not base


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.fit(table(spark, "/root/testdata/sf0.1", "documents"))


def test_held_out_windows(tagger):
    """Spans of other digits and names than those it was trained on."""
    rng = random.Random(77)
    spans = [(0, f"{w}.{rng.randrange(99)}@host{rng.randrange(9)}.example.org") for w in ("peter", "maria.k", "ab-c")]
    spans += [(1, "10.20.30.40"), (2, "4539578763621486"), (3, "+44 (207) 555-0199")]
    ids, tags = pii.training_set(spans, ["these are words of a text that the tagger has never seen before, in a new order "] * 3,
                                 400, seed=9)
    got, _ = tagger.decode(ids)
    real, inside = ids != 0, (ids != 0) & (tags > 0)
    assert (got == tags)[real].mean() > 0.95 and (got == tags)[inside].mean() > 0.85


def test_added_spans(spark, tagger):
    """What the patterns miss: a phone and a card they take for one number, other
    separators, spelt-out signs; and clean texts stay clean."""
    planted = ["erntou +1 (269) 555-3296 4524132264652876 and onrend", "ineahe. 38.253.197.126 4880761348116108",
               "thand card 4539.5787.6362.1486 the reing", "touing anna.17 (at) mail3 (dot) example (dot) com hessth",
               "host 97[.]51[.]17[.]173 isthe on"]
    want = ["+1 (269) 555-3296|4524132264652876", "4880761348116108", "4539.5787.6362.1486",
            "anna.17 (at) mail3 (dot) example (dot) com", "97[.]51[.]17[.]173"]
    found = 0
    for text, spans in zip(planted, want):
        (base, added), = pii.find_all([text], tagger)
        found += {text[a:b] for a, b, _ in added} >= set(spans.split("|"))
    assert found >= 4
    clean = ["In 2024-05-17 at 10:22:33 the price rose by 3.5 to 1,234,567 units (see 12.3.4).", "", "x" * 5000,
             "version 10.2.33 of build 20240517102233 at a9f3c2d1e0b84f6799", "call 12-345 at 7 or 8", "page 12 13 14 15 16 17 18"]
    for base, added in pii.find_all(clean, tagger):
        assert not base and not added


def test_added_spans_do_not_depend_on_where_windows_fall(tagger):
    """A span in a long stretch of numbers, at every offset."""
    phone = "+1 (269) 555-3296 4524132264652876"
    hits = 0
    for pad in range(0, 60, 3):
        text = "and the " * 9 + "12 of " * (pad // 2) + phone + " 13 of" * 30
        (base, added), = pii.find_all([text], tagger)
        hits += {text[a:b] for a, b, _ in added} >= {phone[:17], phone[18:]}
        assert all(a >= 0 and b <= len(text) for a, b, _ in added)
    assert hits >= 18


def test_reconcile_takes_the_best_set():
    text = "4539578763621486 10.20.30.40 4539578763621486"
    pieces = [(0, 16, 2, 5.0, False, False), (0, 12, 2, 9.0, False, True), (8, 16, 2, 3.0, True, False),
              (17, 28, 1, 4.0, False, False), (29, 45, 2, 7.0, False, False), (29, 45, 3, 1.0, False, False)]
    assert pii.reconcile(text, [], pieces) == [(29, 45, 2), (17, 28, 1), (0, 16, 2)]
    assert pii.reconcile(text, [(20, 30, 0)], pieces) == [(0, 16, 2)]


def test_gradient():
    ids, tags = pii.training_set([(2, "4539578763621486"), (0, "ab.1@c.de")], ["some words of a context here "], 4)
    m = pii.Tagger()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    _, g = m.step(ids, tags)
    for k, v in m.p.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), v.shape)
        own, e = v[at], 1e-5
        v[at] = own + e
        up = m.step(ids, tags)[0]
        v[at] = own - e
        down = m.step(ids, tags)[0]
        v[at] = own
        assert g[k][at] == pytest.approx((up - down) / (2 * e), rel=2e-3)


def test_personal_data_edges(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "a@b.c 4539578763621486 " * 3, 3), (1, "a@b.c 4539578763621486 " * 3, 3)],
                                 "doc_id long, text string, N_EMAIL int")
    out = pii.find_personal_data(docs, None)
    assert out.columns == ["doc_id", "text", "N_EMAIL", "_n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = out.orderBy("N_EMAIL").collect()
    assert rows[0]["spans"] == "" and rows[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[2] == rows[3] and (rows[2]["_n_email"], rows[2]["n_card"]) == (3, 3)
    assert pii.fit(docs.where("text = ''")) is None and pii.find_personal_data(docs.limit(0), None).count() == 0


# --- ranked search ------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _ranked(docs, items, top=10):
    split = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    split = [(i, w) for i, w in split if w]
    n_docs, total = len(split), sum(len(w) for _, w in split)
    df = {}
    for _, w in split:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, w in split:
            m = 25 + (75 * len(w) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * w.count(t)) // (1000 * w.count(t) + 8 * m))
                    for t in TERM.findall((text or "").translate(LOWER)) if t in df)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0))
        out += [(item_id, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_ranked_search_sql(spark):
    df = queries.op13_lexical_search(spark, SF)
    res = duck(SF).execute(queries.ORACLE["op13_lexical_search"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in res.description], res.fetchall())


@pytest.mark.parametrize("options", [{}, {"item_terms": 20}, {"top": 3}])
def test_ranked_search(spark, monkeypatch, options):
    monkeypatch.setattr(lexical, "TILE_TERMS", 5)
    monkeypatch.setattr(lexical, "TILE_DOCS", 7)
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(30)] + ["Été", "été", "日本", "A", "a", "x_y", "it's"]
    docs = [(rng.choice([None, *range(60)]), " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30)))) for _ in range(80)]
    docs += [(5, None), (6, ""), (7, "-- !"), (8, "w1 " * 400), (8, "w1 " * 400), (99, "w2 w3"), (98, "w2 w3")]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12)))) for i in range(12)]
    items += [(3, "w1 w1 w1"), (None, "w2 w3"), (50, None), (51, ""), (52, "unseen"), (53, "w2 w2 W2 w3")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, rank int").repartition(5)
    got = lexical.search(d, spark.createDataFrame(items, "item_id long, text string"), **options).collect()
    assert sorted(map(tuple, got), key=str) == _ranked(docs, items, options.get("top", 10))
    empty = d.limit(0)
    assert lexical.search(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert lexical.search(d, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_partial_sums_stay_exact():
    items = lexical.Items([" ".join(f"t{i}" for i in range(3000) for _ in range(600)), "t5 t6"])
    df = np.ones(3000, np.int64)
    tiles = lexical.Tiles(items, df, 10 ** 9, 10 ** 11, tile=4000)
    assert len(tiles.cuts) > 3                                                  # cut below 2^53, not by their size
    n = np.array([3000, 5])
    doc, term = np.repeat([0, 1], [3000, 1]), np.concatenate([np.arange(3000), [5]])
    got = tiles.scores(n, doc, term, np.full(3001, 9))
    w, m = lexical.weight(10 ** 9, 1), [25 + 75 * int(x) * 10 ** 9 // 10 ** 11 for x in n]
    impact = [9 * 10 ** 9 // (9000 + 8 * x) for x in m]
    assert got.tolist() == [[3000 * 600 * w * impact[0], 2 * w * impact[0]], [600 * w * impact[1], w * impact[1]]]
