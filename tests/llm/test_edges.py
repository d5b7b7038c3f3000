"""Nulls in every column, empty and very long texts, repeated rows, an empty
table and clashing extra columns, for every operator over documents."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import common, contamination, html_text, lang, lines, mixing, near_text, repeats, token_counts, token_files, vectors
from strata.session import scratch_path

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [(1, None, None, None), (None, "alpha beta gamma delta epsilon zeta", "en", "s"), (2, "", "en", "s"),
        (3, LONG, None, "s"), (4, "one two three four five six seven", "fr", None),
        (4, "one two three four five six seven", "fr", None), (5, "one two three four five six seven", "en", "t"),
        (6, " \n\t ", "en", "t"), (7, "x" * 50_000, "en", "t"), (8, "\x1c<|endoftext|> 12 ab", "en", "t")]
ITEMS = [(1, "one two three four five six seven"), (2, None), (None, "alpha beta gamma delta epsilon zeta"), (3, "one")]

OPERATORS = {
    "lines": lambda s, d: lines.dedup_lines(d),
    "near": lambda s, d: near_text.near_texts(d),
    "mix": lambda s, d: mixing.fair_mix(d),
    "tokens": lambda s, d: token_files.read_tokens(s, token_files.write_tokens(d, scratch_path(s, "t"))),
    "contamination": lambda s, d: contamination.find_items(d, s.createDataFrame(ITEMS, "item_id long, text string")),
    "counts": lambda s, d: token_counts.count_tokens(d),
    "repeats": lambda s, d: repeats.remove_repeats(d),
    "lang": lambda s, d: lang.identify(d, lang.fit(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, make_docs, name):
    out = OPERATORS[name](spark, make_docs(ROWS)).collect()
    assert len(out) == len(ROWS)
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, make_docs, name):
    assert OPERATORS[name](spark, make_docs([])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(spark, make_docs, name):
    clash = ("key", "size", "raw", "dk", "row", "lang_pred", "score", "item_ids", "cell", "lines", "id", "upto", "target")
    plain = OPERATORS[name](spark, make_docs(ROWS[1:6]))
    more = make_docs(ROWS[1:6]).select("*", *[F.lit("?").alias(c) for c in clash])
    cols = [c for c in plain.columns if c not in ("lang_pred", "score", "item_ids")]
    got = OPERATORS[name](spark, more).select(*cols).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain.select(*cols).collect()))


def test_near_and_repeats_of_copies(spark, make_docs):
    near = {(r["doc_id"], r["class_id"], r["n_links"]) for r in near_text.near_texts(make_docs(ROWS)).collect()}
    assert {(4, 4, 2), (5, 4, 2), (1, 1, 0), (2, 2, 0), (6, 6, 0)} <= near
    assert near_text.keep_one(make_docs(ROWS)).count() == len(ROWS) - 2
    gone = {r["doc_id"]: r for r in repeats.remove_repeats(make_docs([*ROWS, (9, LONG)])).collect()}
    assert gone[3]["n_removed"] == gone[3]["n_bytes"] == len(LONG)
    assert (gone[7]["n_removed"], gone[7]["n_spans"]) == (50_000, 1) and gone[1]["n_removed"] == 0


def test_language_of_nothing(spark, make_docs):
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang.identify(make_docs(ROWS), lang.fit(make_docs(ROWS))).collect()}
    assert out[1] == out[2] == out[6] == ("und", 0.0)


def test_contamination_rows(spark, make_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = [(r["doc_id"], r["item_ids"]) for r in contamination.find_items(make_docs(ROWS), items).collect()]
    assert out.count((4, [1])) == 2 and (5, [1]) in out and (None, [None]) in out and (3, []) in out
    # a benchmark over the bound is looked up part by part, with the same result
    parts = contamination.find_items(make_docs(ROWS), items, item_words=5).collect()
    assert sorted(str((r["doc_id"], r["item_ids"])) for r in parts) == sorted(map(str, out))


def test_short_items_and_items_of_every_script(spark, make_docs):
    items = [(1, "Who wrote Hamlet?"), (2, "what is the answer"), (3, "中国的首都是哪里？"), (4, "日本の首都はどこですか"),
             (5, "เมืองหลวงของไทยคืออะไร"), (6, "¿Cuál es la capital de España?"), (7, "столица"), (8, "ok"), (9, "?!")]
    rows = [(1, "so who wrote hamlet then"), (2, "what is the right answer"), (3, "问：中国的首都是哪里？答：北京"),
            (4, "質問:日本の首都はどこですか。東京"), (5, "ถามว่าเมืองหลวงของไทยคืออะไรครับ"),
            (6, "«¿cuál\u00a0es la—capital de españa?»"), (7, "Столица"), (8, "it is ok"), (9, "?!"),
            (10, "中国的首都在哪里"), (11, "what is the"), (12, "answer"), (13, "what IS\u2003the “answer”"), (14, "北京很大")]
    found = contamination.find_items(make_docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    got = {r["doc_id"]: r["item_ids"] for r in found.collect()}
    assert got == {1: [1], 2: [], 3: [3], 4: [4], 5: [5], 6: [6], 7: [7], 8: [], 9: [], 10: [3], 11: [], 12: [],
                   13: [2], 14: []}
    assert found.sparkSession.range(1).select(common.word_count(F.lit("a bc, 中国x हिन्दी"))).first()[0] == 6


def test_tokens_round_trip(spark, make_docs):
    path = token_files.write_tokens(make_docs(ROWS), scratch_path(spark, "t"))
    rows = sorted(token_files.read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    lib = token_files.WordEncoder(token_files.default_tokenizer()).lib
    want = sorted(str((r[0], lib.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in ROWS)
    assert sorted(str((r["doc_id"], r["ids"])) for r in rows) == want
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]


def test_words_ending_in_other_signs_are_encoded_whole():
    enc = token_files.WordEncoder(token_files.default_tokenizer())
    words = ["'x'.", "dogs',", "”.", "»,", "…)", "wow😀!", "हिन्दी,", "İ,", "I\u0307.", "e\u0301.", "x²,", "½)", "ª.",
             "don't.", "'S.", "--", "…", "'", "''.", "A—,", "한글.", "日本語!", "a\u200d,", "٣."]
    rng = random.Random(6)
    signs = "aZ9 '’”»…😀िé\u0301²İßσ.,)!-<|_한\u1161"
    words += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 7))) for _ in range(4000)]
    for text in [*words, " ".join(words[:24])]:
        want = enc.lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc(text), enc.dtype).tolist() == want, text


def test_words_of_known_parts_are_not_learnt_again():
    enc = token_files.WordEncoder(token_files.default_tokenizer())
    calls, learn = [], enc._learn
    enc._learn = lambda missing: (calls.append(set(missing)), learn(missing))
    list(enc.encode(["word , . !", "other"]))
    texts = ["Word, WORD. other! OTHER", "", " Other,\nword!\n", "wOrd. <|", "x\x1cy"]
    got = [np.frombuffer(r, enc.dtype).tolist() for r in enc.encode(texts)]
    assert got == [enc.lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert not set().union(*calls[1:]) and list(enc.encode([])) == []


def test_new_words_of_letters_go_to_the_model_alone():
    enc = token_files.WordEncoder(token_files.default_tokenizer())
    whole, lib = [], enc._lib
    enc._lib = lambda texts: (whole.extend(texts), lib(texts))[1]
    letters = ["word", "Straße", "ΣΊΣΥΦΟΣ", "слово", "Дом", "한글", "日本語", "ﬁn", "ǅ", "ªº", "a" * 700, "ж" * 300]
    signs = ["İ", "İstanbul", "हिन्दी", "e\u0301t", "x²y", "don't", "\u1112\u1161", "\u1161", "ẞ", "K"]
    rng = random.Random(7)
    mixed = ["".join(rng.choice("aZéßİıΣсЖ한\u1112\u1161\u11ab語ªʰǅﬁ\u0301्ी") for _ in range(rng.randint(1, 6)))
             for _ in range(3000)]
    texts = [" ".join(letters), " ".join(w + ", " + w.upper() + "." for w in letters), " ".join(signs), *mixed, " ".join(mixed)]
    got = [np.frombuffer(r, enc.dtype).tolist() for r in enc.encode(texts)]
    assert got == [enc.lib.encode(t, add_special_tokens=False).ids for t in texts]
    seen = set(" ".join(whole).split())
    assert not seen & {"word", "straße", "слово", "Дом", "한글", "日本語", "a" * 700} and "don't" in seen


def test_parts_let_go_are_learnt_again(monkeypatch):
    monkeypatch.setattr(token_files, "PARTS_KEPT", 400)
    monkeypatch.setattr(token_files, "LEARNT", 60)
    enc = token_files.WordEncoder(token_files.default_tokenizer())
    rng = random.Random(8)
    texts = [" ".join(f"{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{rng.choice(['', ',', '.)', 'é!'])}"
                      for _ in range(rng.randrange(40))) for _ in range(120)]
    assert [np.frombuffer(r, enc.dtype).tolist() for r in enc.encode(texts)] == [
        enc.lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(enc.parts) == len(enc.ids) == len(enc.met) < 200


def test_batches_of_tasks_are_bounded_in_bytes(spark):
    rows = spark.range(4000, numPartitions=1).select("id", F.repeat(F.lit("ab"), 5000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])
    got = common.map_arrow(rows, sizes, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in got) == 4000 and max(r["size"] for r in got) < 1.1 * common.BATCH_BYTES


def test_tasks_that_use_no_memo_drop_it(monkeypatch):
    class Learnt:
        words = ("some",)

        def forget(self):
            self.words = ()
    memo, given = [], []
    monkeypatch.setattr(common, "_MEMO", memo)
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    owner = Learnt()

    def learns(batches):
        common.use_memo(owner)
        yield from batches
    assert list(common._task(learns, True)(iter("ab"))) == ["a", "b"] and memo == [owner]
    assert list(common._task(learns, True)(iter("c"))) == ["c"] and owner.words and len(given) == 2
    assert list(common._task(lambda batches: batches, False)(iter("d"))) == ["d"] and not memo and not owner.words


def test_mix_and_stages(spark, make_docs):
    mixed = mixing.mix(make_docs(ROWS))
    plan = {(r["doc_id"], r["source"]): r for r in mixing.fair_mix(make_docs(ROWS)).collect()}
    assert mixed.columns == make_docs([]).columns
    assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in plan.values())
    assert plan[(1, None)]["taken"] == 0


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES)
@pytest.mark.parametrize("rows", [ROWS, []], ids=["rows", "empty"])
def test_stages(spark, make_docs, tmp_path, name, step, rows):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = make_docs(rows).withColumn("score", F.lit(1)).withColumn("key", F.lit("k"))
    out = step(spark, docs, str(tmp_path))
    n = out.count()
    assert (n == 0) if not rows else n > 0
    if name != "token_ids":
        assert out.columns == docs.columns


PAGES = [(1, "u", None), (None, None, ""), (2, "v", "<article><p>" + LONG + "</p></article>"), (3, "w", "<p>a b"), (3, "w", "<p>a b"),
         (4, "x", "<div><nav>only</nav></div>"), (5, "y", "<" * 5000), (6, "z", "<div>" * 3000 + "deep text")]


def test_pages_edges(spark):
    ddl = "page_id long, url string, html string"
    pages = spark.createDataFrame(PAGES, ddl)
    plain = sorted(map(str, html_text.extract(pages).collect()))
    assert len(plain) == len(PAGES)
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got[1] == got[None] == got[4] == "" and got[2] == LONG and got[3] == "a b" and got[6] == "deep text"
    assert all(r["n_chars"] == len(r["text"]) for r in html_text.extract(pages).collect())
    clash = pages.select("*", *[F.lit("?").alias(c) for c in ("text", "n_chars", "token", "inner")])
    assert sorted(map(str, html_text.extract(clash).collect())) == plain
    assert html_text.extract(spark.createDataFrame([], ddl)).collect() == []


NAN, INF = float("nan"), float("inf")
VECTORS = [(1, "a", [1.0, 0.0, 0.0]), (2, "a", [2.0, 0.0, 0.0]), (3, "a", [1.0, 0.1, 0.0]), (4, "a", [0.0, 1.0, 0.0]),
           (5, "b", [1.0, 0.0, 0.0]), (6, None, [1.0, 0.0, 0.0]), (7, "a", None), (8, "a", [0.0, 0.0, 0.0]), (9, "a", [NAN, 0.0, 1.0]),
           (10, "a", [INF, 0.0, 0.0]), (11, "a", [None, 0.0, 1.0]), (12, "a", []), (13, "a", [1.0, 0.0]), (14, "a", [1e300, 0.0, 0.0]),
           (None, "a", [0.0, 1.0, 0.0]), (4, "a", [0.0, 1.0, 0.0])]


def test_vectors_edges(spark):
    ddl = "vec_id long, label string, embedding array<double>"
    vecs = spark.createDataFrame(VECTORS, ddl)
    out = vectors.near_vectors(vecs).collect()
    assert len(out) == len(VECTORS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out}
    for i in (1, 2, 3, 14):
        assert got[i] == (3, 1, i == 1)
    assert got[4] == (2, 4, True) and got[None] == (2, 4, False)
    for i in (5, 6, 7, 8, 9, 10, 11, 12, 13):
        assert got[i] == (0, i, True)
    clash = vecs.select("*", *[F.lit("?").alias(c) for c in ("vkey", "cell", "n", "block", "blocks", "dim", "pivot", "unit")])
    assert sorted(map(str, vectors.near_vectors(clash).collect())) == sorted(map(str, out))
    assert vectors.near_vectors(spark.createDataFrame([], ddl)).collect() == []


def test_vector_links_near_the_threshold(spark):
    """Recall on pairs within 0.002 of the least cosine, by brute force."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    cos = rng.uniform(0.979, 0.983, len(x))[:, None]
    both = np.concatenate([x, cos * x + np.sqrt(1 - cos ** 2) * side])
    rows = [(i, "a", v.tolist()) for i, v in enumerate(both)]
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")).collect()
    unit = both / np.linalg.norm(both, axis=1)[:, None]
    want = ((unit @ unit.T >= 0.98).sum(1) - 1)
    got = np.array([r["n_links"] for r in sorted(out, key=lambda r: r["vec_id"])])
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()
    print(got.sum(), want.sum())
