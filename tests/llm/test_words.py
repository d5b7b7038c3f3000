"""Words and their hashes: whole words count, whatever their length or script.
Near texts and benchmark items over words that share long beginnings are held
against brute force on the words themselves."""

import random
import re

import numpy as np
import pytest

from strata.llm import common, contamination, lang, near_text, queries
from strata.llm.common import table

SF = "/root/testdata/sf0.01"


def _hashes(words):
    return [int(h[0]) for _, n, hs, o in common.word_hashes(words) for h in (hs[o[i]:o[i + 1]] for i in range(n))]


def test_distinct_words_have_distinct_hashes(spark):
    words = {w for r in table(spark, SF, "documents").select("text").collect()
             for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", (r[0] or "").lower())}
    rng = random.Random(0)
    for n in (6, 7, 12, 100, 5000):
        base = "".join(rng.choice("abcdefghij") for _ in range(n))
        words |= {base[:i] + c + base[i + 1:] for i in range(0, n, max(1, n // 50)) for c in "xyz"} | {base, base + "a"}
    words |= {"a" * 700, "a" * 700 + "b", "международный", "международная", "международного"}
    assert len(set(_hashes(sorted(words)))) == len(words)


# Words with long common beginnings, Latin and Cyrillic.
LATIN = ["national", "nations", "international", "internal", "internally", "governments", "governor", "governing",
         "contained", "container", "containment", "conditions", "conditional", "regarding", "regards", "regardless",
         "constitution", "constituents", "constituency"]
CYRILLIC = ["международный", "международная", "государство", "государственный", "государства", "условия", "условный",
            "относительно", "относительный", "конституция", "конституционный"]


def test_words_that_begin_alike_are_not_alike(spark, make_docs):
    rows = [(1, "national international governments contained conditions regarding constitution"),
            (2, "nations internal governor container conditional regards constituents"),
            (3, "the international government establishes relations between communities regarding distribution"),
            (4, "internal governors establishment relatives betwixt commutes regardless distributors")]
    got = {r["doc_id"]: (r["n_links"], r["kept"]) for r in near_text.near_texts(make_docs(rows)).collect()}
    assert got == {i: (0, True) for i in (1, 2, 3, 4)}
    items = spark.createDataFrame([(7, "international government establishes relations between communities regarding "
                                       "distribution")], "item_id long, text string")
    found = {r["doc_id"]: r["item_ids"] for r in contamination.find_items(make_docs(rows), items).collect()}
    assert found == {1: [], 2: [], 3: [7], 4: []}


def _shingles(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("vocabulary", [LATIN, CYRILLIC], ids=["latin", "cyrillic"])
def test_near_texts_by_whole_words(make_docs, vocabulary):
    rng = random.Random(len(vocabulary))
    rows = []
    for i in range(40):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 60))]
        rows.append((2 * i, " ".join(w)))
        w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((2 * i + 1, " ".join(w[:-1] if i % 3 else w)))
    sets = {i: _shingles(t) for i, t in rows}
    links = {i: sum(1 for j in sets if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in sets}
    got = {r["doc_id"]: r["n_links"] for r in near_text.near_texts(make_docs(rows)).collect()}
    assert got == links and sum(links.values()) > 10


def _distance(item, words):
    d = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        prev, d[0] = d[0], i
        for j, y in enumerate(words, 1):
            prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (x != y))
    return min(d)


@pytest.mark.parametrize("vocabulary", [LATIN, CYRILLIC], ids=["latin", "cyrillic"])
def test_items_by_whole_words(spark, make_docs, vocabulary):
    rng = random.Random(3)
    item = [[rng.choice(vocabulary) for _ in range(rng.randint(10, 25))] for _ in range(12)]
    rows, truth = [], {}
    for i in range(60):
        w = list(item[i % 12])
        for _ in range(rng.randint(0, len(w) // 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        text = [rng.choice(vocabulary) for _ in range(15)] + w + [rng.choice(vocabulary) for _ in range(9)]
        rows.append((i, " ".join(text)))
        truth[i] = [k for k, x in enumerate(item) if _distance(x, text) <= int(len(x) * 0.2 + 1e-9)]
    items = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(item)], "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in contamination.find_items(make_docs(rows), items).collect()}
    assert all(set(got[i]) <= set(truth[i]) for i in truth)
    assert sum(map(len, got.values())) >= 0.97 * sum(map(len, truth.values())) > 0


def test_letters_are_no_numerals(make_docs):
    train = [(i, "the cat sat on the mat" if i % 2 else "le chat est sur la table", "en" if i % 2 else "fr")
             for i in range(40)]
    docs = make_docs([*train, (100, "½ ² ³"), (101, "ⅷ 12 _"), (102, "½ the"), (103, None)])
    got = {r["doc_id"]: r["lang_pred"] for r in lang.identify(docs, lang.fit(docs)).collect()}
    assert [got[i] for i in (100, 101, 102, 103)] == ["und", "und", "en", "und"]


def test_rare_pieces_do_not_underflow():
    m = lang.Model(["▁ab", "a", "é"], ["x", "y"], np.array([[1e9, 2e13], [3, 4], [1, 1]]))
    for w in ("z" * 39, "aéz" * 13, "漢" * 20):
        assert np.isfinite(m._equal([w])).all() and np.allclose(m._equal([w])[0], m._long(w))


def test_language_query_against_the_sum_over_segmentations(spark):
    """Every word of some texts by a plain recursion, document by document."""
    small = "/root/testdata/sf0.001"
    docs = table(spark, small, "documents")
    model = lang.fit(docs)
    known: dict[str, np.ndarray] = {}

    def word(s):
        if s not in known:
            ways = [np.zeros(len(model.langs))]
            for j in range(1, len(s) + 1):
                ways.append(sum((ways[i] if i else 1.0) * model.p[at]
                                for i in range(max(0, j - model.longest), j) if (at := model._piece(s, i, j)) >= 0))
            known[s] = np.log(ways[-1])
        return known[s]
    got = {r["doc_id"]: r for r in queries.op10_language_id(spark, small).collect()}
    for r in docs.collect():
        runs = re.findall(r"[^\W\d_]+", (r["text"] or "").lower())
        if not runs or not "".join(runs).isalpha():
            continue
        logs = sum(word("▁" + w) if len(w) < 30 else model._long(w) for w in runs)
        p = np.exp(logs - logs.max())
        assert got[r["doc_id"]]["lang_pred"] == model.langs[int(logs.argmax())]
        assert abs(got[r["doc_id"]]["score"] - p.max() / p.sum()) < 1e-9
