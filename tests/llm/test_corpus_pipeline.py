"""run() of the pipeline, stage by stage, against brute-force versions."""

import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from strata.llm import lang, mixing, token_files

ITEMS = [(1, "who wrote the old play"), (2, "name the capital town"),
         (3, "seven red foxes ran over the long cold hill at dawn while two owls slept"), (4, None)]


def _documents():
    rng = random.Random(12)
    words = {"en": "the of and house stone walk bright river winter under wheel cold hill long red town".split(),
             "fr": "le de et maison pierre marche clair fleuve hiver sous roue froid colline ville rouge loin".split()}
    rows = []
    for i in range(60):
        code = "en" if i % 2 else "fr"
        rows.append([i, " ".join(rng.choice(words[code]) for _ in range(rng.randint(12, 60))), code, "abc"[i % 3]])
    long = max(rows, key=lambda r: len(r[1]))[1]
    near = long.split()
    near[-1] = "other"
    far = [w if i % 6 else "changed" for i, w in enumerate(long.split())]
    edited = ITEMS[2][1].replace("cold ", "").replace("owls", "cats")
    extra = [long, " ".join(near), " ".join(far), rows[4][1], "x " + ITEMS[0][1] + " y", "who wrote the new play",
             "Then: name the capital TOWN!", "name the big capital town", f"so {edited} they say", "so " + ITEMS[2][1].replace("the", "a b c d"),
             None, "", "12 34 - 56", "12 34 - 56", "it's 'x'. dogs', and “that”… wow\U0001F600!"]
    rows += [[100 + i, t, "en", "abc"[i % 3]] for i, t in enumerate(extra)]
    return {r[0]: r for r in rows}


def _words(text):
    return re.findall("[0-9a-z]+", (text or "").lower())


def _languages(docs, model):
    kept = set()
    for i, r in docs.items():
        words = "".join(c if c.isalpha() else " " for c in (r[1] or "").lower()).split()
        if words:
            logs = sum(model._long(w) for w in words)
            kept |= {i} if np.exp(logs - logs.max()).sum() <= 1 / corpus_pipeline.LEAST_SCORE else set()
    return kept


def _one_of_each_class(docs):
    sets = {}
    for i, r in docs.items():
        w = _words(r[1])
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in docs}
    for a, b in itertools.combinations(sorted(docs), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.8 * len(x | y):
            lo, hi = sorted((root[a], root[b]))
            root = {i: lo if r == hi else r for i, r in root.items()}
    return set(root.values())


def _contains(words, item):
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, w in enumerate(words):
            new.append(min(row[j] + (x != w), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row) <= int(0.2 * len(item) + 1e-9)


def _clean(docs):
    items = [_words(t) for _, t in ITEMS if t]
    return {i for i, r in docs.items() if not any(_contains(_words(r[1]), x) for x in items)}


def _mixed(docs):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(list(docs.values()), columns=["doc_id", "text", "lang", "source"]))
    return Counter({i: n for i, n in con.execute(
        f"SELECT doc_id, copies FROM ({mixing.oracle_sql()})").fetchall() if n})


def test_run(spark, make_docs, tmp_path, monkeypatch):
    docs = _documents()
    table = make_docs([tuple(r) for r in docs.values()])
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out, stage = {}, corpus_pipeline.stage

    def keep(df, name):
        out[name.removeprefix("corpus-")] = got = stage(df, name)
        return got
    monkeypatch.setattr(corpus_pipeline, "stage", keep)
    rows = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: r["start"])
    assert list(out) == [name for name, _ in corpus_pipeline.STAGES]

    def check(name, want):
        got = Counter((r["doc_id"], r["text"], r["source"]) for r in out[name].collect())
        assert got == Counter({(i, docs[i][1], docs[i][3]): n for i, n in Counter(want).items()}), name
        return {i: docs[i] for i in sorted(want)}

    left = check("language_id", _languages(docs, lang.fit(table)))
    assert not {110, 111, 112, 113} & set(left)
    less = check("near_duplicates", _one_of_each_class(left))
    assert {100, 101, 103}.isdisjoint(less) and 102 in less
    left = check("decontamination", _clean(less))
    assert set(less) - set(left) == {104, 105, 106, 108}
    taken = _mixed(left)
    check("source_mix", taken)
    lib = token_files.WordEncoder(token_files.default_tokenizer()).lib
    want = []
    for i in taken.elements():
        ids = [*lib.encode(docs[i][1], add_special_tokens=False).ids, token_files.END_ID]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert [r["start"] for r in rows] == [0, *itertools.accumulate(r["n_tokens"] for r in rows)][:-1]
