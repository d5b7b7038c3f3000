"""Operators against brute-force versions on the smallest tables."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest

import __spark_entry__ as E
from strata.llm import common, contamination, html_text, lang, lines, pfp, queries, repeats, token_counts, token_files
from strata.llm.common import table
from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r[0]: r[1] for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    df = E.queries()[name](spark, SF)
    res = duck(SF).execute(E.oracle_sql()[name])
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of([c[0] for c in res.description], res.fetchall())


def _cover(raws, size):
    seen = collections.Counter(x[p:p + size] for x in raws for p in range(len(x) - size + 1))
    for x in raws:
        gone = np.zeros(len(x) + 1, np.int8)
        for p in range(len(x) - size + 1):
            if seen[x[p:p + size]] > 1:
                gone[p:p + size] = 1
        yield x, gone[:-1], int((np.diff(np.concatenate([[0], gone])) == 1).sum())


@pytest.mark.parametrize("hot", [repeats.HOT, 1], ids=["grouped", "singly"])
def test_repeats(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(repeats.repeated_ranges, "__defaults__", (repeats.SIZE, hot))
    got = {r["doc_id"]: r for r in queries.op9_suffix_dedup(spark, SF).collect()}
    ids = sorted(texts)
    for i, (x, gone, spans) in zip(ids, _cover([texts[i].encode() for i in ids], 200)):
        kept = bytes(np.frombuffer(x, np.uint8)[gone == 0])
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == \
            (len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_repeats_within_a_text(spark, make_docs):
    rng = random.Random(3)
    unit = "".join(rng.choice("abcdefgh") for _ in range(230))
    rows = [(1, unit + "-" + unit[:215] + "+" + unit[10:]), (2, "q" * 201), (3, "ab" * 120), (4, unit[5:204])]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(make_docs(rows)).collect()}
    for (i, _), (x, gone, spans) in zip(rows, _cover([t.encode() for _, t in rows], 200)):
        assert (got[i]["n_removed"], got[i]["n_spans"]) == (int(gone.sum()), spans)


def test_contamination(spark, texts):
    items = {r[0]: r[1] for r in table(spark, SF, "benchmark").select("item_id", "text").collect()}
    words = lambda xs: [h[o[i]:o[i + 1]] for _, n, h, o in common.word_hashes(xs) for i in range(n)]
    n = np.array([len(w) for w in words(items.values())])
    grid = np.zeros((len(n), n.max()), np.uint64)
    for row, w in zip(grid, words(items.values())):
        row[:len(w)] = w
    truth = set()
    for doc_id, w in zip(texts, words(texts.values())):
        if len(w):
            far = contamination.best_edit(grid, n, np.broadcast_to(w, (len(n), len(w))))
            truth |= {(doc_id, list(items)[i]) for i in np.flatnonzero(far <= contamination.edits(n))}
    got = {(r["doc_id"], i) for r in queries.op7_decontamination(spark, SF).collect() for i in r["item_ids"]}
    assert got <= truth and len(got) >= 0.99 * len(truth) > 0


def test_edited_items_are_found():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randint(8, 60))) for _ in range(60)]
    index = contamination.Index(list(range(60)), items)
    texts = []
    for x in items:
        w = x.split()
        for _ in range(int(contamination.edits(len(w)))):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 1)] = ["new"] * rng.randint(0, 1)
        texts.append(" ".join(rng.choice(vocab) for _ in range(40)) + " " + " ".join(w) + " and so on")
    assert sum(i in f for i, f in enumerate(index.find(texts))) >= 58


def test_long_items():
    import pickle
    rng = random.Random(8)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(3000)]
    items = [" ".join(words), *(" ".join(f"v{rng.randrange(999)}" for _ in range(30)) for _ in range(40))]
    index = contamination.Index(list(range(41)), items)
    assert len(pickle.dumps(index)) < 32 << 20
    changed = [w if i % 50 else "new" for i, w in enumerate(words)]
    texts = ["x " * 700 + items[0] + " y" * 50, "a b " + " ".join(changed), " ".join(words[:2000]), "x " + items[7]]
    assert index.find(texts) == [[0], [0], [], [7]]


def test_keys_of_the_walk():
    rng = np.random.default_rng(1)
    e, n = contamination.Embedding(40, 5), np.array([40, 7, 7, 1, 23])
    words = rng.integers(1, 1 << 62, (5, 40)).astype(np.uint64)
    got = e.keys(words, n)
    for w, m, keys in zip(words.tolist(), n.tolist(), got.tolist()):
        for r, key in enumerate(keys):
            at, total, w = 0, 0, [*w[:m], int(contamination.PAD)]
            for j in range(3 * m):
                total += w[at] * sum(int(o) for a, o in zip(e.at[r], e.odd[r]) if int(a * 3 * m) == j)
                turn = np.array([w[at] * int(e.turn[j, r]) % (1 << 64)], np.uint64)
                at = min(at + int(common.mix(turn)[0] >> np.uint64(63)), m)
            total = np.array([(total + r * 0x9E3779B97F4A7C15 + m) % (1 << 64)], np.uint64)
            assert key == int(common.mix(total)[0])


def test_language(spark):
    rows = queries.op10_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_forward_sums_all_segmentations():
    m = lang.Model(["▁ab", "a", "b", "ab", "▁a"], ["x", "y"], np.array([[1, 2], [3, 4], [5, 1], [2, 2], [1, 9.]]))

    def brute(s, k):
        return sum(m.p[m._piece(s, 0, j), k] * brute(s[j:], k) for j in range(1, len(s) + 1)
                   if m._piece(s, 0, j) >= 0) if s else 1.0
    for w in ("abab", "b", "aabc", "abababab"):
        want = np.log([brute("▁" + w, k) for k in (0, 1)])
        assert np.allclose(m._equal([w])[0], want) and np.allclose(m._long(w), want)


def test_greedy_counts():
    for vocab, letters in ((["a", "ab", "abc", "bcde", "cd", "xyz", "éa"], "abcdexyzé"),
                           (token_counts.load_pieces(token_counts.default_vocabulary()), "etaoinsr▁")):
        auto, known = token_counts.Automaton(vocab), set(vocab)
        top, rng = max(map(len, known)), random.Random(1)
        for _ in range(3000):
            s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 16)))
            n = i = 0
            while i < len(s):
                j = next((j for j in range(min(len(s), i + top), i, -1) if s[i:j] in known), None)
                n, i = (n + 1, j) if j else (n + len(s[i].encode()), i + 1)
            assert auto.count(s) == n


def test_codes_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert (token_files.unpack(*token_files.pack(v), n) == v).all()


def test_best_run_is_the_best():
    rng = random.Random(4)
    weights = {"word": 0.7, "p": -0.9, "/p": -0.4, "left": -2.0}
    for _ in range(200):
        items = [rng.choice([(0, "", "w " * rng.randint(1, 3)), (1, "p", ""), (1, "/p", ""), (2, "nav", "")])
                 for _ in range(rng.randint(1, 12))]
        score = lambda a, b: sum(weights["word"] * len(x[2].split()) if x[0] == 0 else weights[html_text._token(x)]
                                 for x in items[a:b])
        best = max(score(a, b) for a, b in itertools.combinations(range(len(items) + 1), 2))
        run = html_text.best_run(items, weights)
        assert (run is None and best <= 0) or abs(score(*run) - best) < 1e-9


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain &amp; simple text", "plain & simple text"),
    ("<nav>a b c</nav><article><h1>T</h1><p>one  two<br>three<p>fo<b>u</b>r &eacute;&#233;</article><footer>x y z</footer>",
     "T\none two three\nfour éé"),
    ("<ARTICLE><P>keep this text<script>if (a<b) '</p>'</script> going</P><div class='x comments'>no no</div></ARTICLE>",
     "keep this text going"),
    ("<article><p title='a>b'>one two three<!-- <p>no</p> --> four</p><aside>no</aside><p>five six seven</p></article>",
     "one two three four\nfive six seven"),
])
def test_pages(page, text):
    assert html_text.extract_text(page, html_text.UNFITTED) == text


@pytest.mark.parametrize("page,text", [
    ('<article><h2 id="related-work">Related work</h2><p>one two</p><h2 class="search">Search</h2><p id="notice-period">'
     'three four</p><p>do <span class="share">share</span> it</p></article>',
     "Related work\none two\nSearch\nthree four\ndo share it"),
    ('<main><section id="social-impact"><h2 id="search-results">Impact</h2><p>one two</p></section><section id="notice">'
     '<p>five six</p></section></main>', "Impact\none two\nfive six"),
    ('<div class="content with-sidebar"><p>one two three</p><div id="sidebar">no</div><div class="site-footer">no</div></div>',
     "one two three"),
    ('<div class="widget"><p>one two three four</p><ul class="related-posts"><li>no</li></ul></div>', "one two three four"),
    ('<form id="page"><p>one two three four</p><div role="search">no</div></form>', "one two three four"),
    ('<article><p title="the class=ad">one two</p><div class="share-buttons">no</div></article><div class="comments">'
     'no no no no no no</div>', "one two"),
])
def test_names_that_only_look_like_asides(page, text):
    assert html_text.extract_text(page, html_text.UNFITTED) == text


ASIDES = ["class='reader-comments'", "class='user-comments'", "class='post-comments'", "class='comment-thread'",
          "class='ad-slot'", "class='google-ads'", "class='sticky-ad'", "class='gdpr-notice'", "class='related-articles'",
          "class='social-media'", "class='share-this'", "class='discussion'", "id='comments-section'", "id='sidebar-left'",
          "id='site-nav'", "id='ad-1'", "class='adSlot'", "class='x commentList'"]
PROSE = " ".join(f"word{i}" for i in range(90))


@pytest.mark.parametrize("attr", ASIDES)
def test_asides_of_other_names(attr):
    page = f"<article><p>one two three</p><div {attr}><p>no <a href='/'>no no</a></p></div><p>four five</p></article>"
    assert html_text.extract_text(page, html_text.UNFITTED) == "one two three\nfour five"


@pytest.mark.parametrize("attr", ["class='related-work'", "class='social-history'", "class='search-engines'", "class='has-sidebar'",
                                  "class='no-comments'", "class='address'", "class='advice'", "id='menu-theory'"])
def test_main_text_of_such_names(attr):
    page = f"<article><p>one two three</p><div {attr}><p>{PROSE}</p></div><p>four five</p></article>"
    assert html_text.extract_text(page, html_text.UNFITTED) == f"one two three\n{PROSE}\nfour five"


def test_long_comments_go(spark):
    page = f"<article><p>one two three</p><div class='reader-comments'><p>{PROSE}</p></div></article>"
    assert html_text.extract_text(page, html_text.UNFITTED) == "one two three"


def test_page_weights(spark):
    w = html_text.fit(table(spark, SF, "pages"))
    assert w["word"] > 0 and all(v < 0 for k, v in w.items() if k != "word")


def test_windows_share_fingerprints(spark, make_docs):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\n\nd\ny"), (3, "b\nc"), (4, "b\nc"), (5, "q\nq\nq\nq\nq\nq")]
    out = {r["doc_id"]: (r["n_removed"], r["text"]) for r in lines.dedup_lines(make_docs(rows)).collect()}
    assert out == {1: (0, "a\nb\nc\nd\ne"), 2: (3, "x\n\ny"), 3: (0, "b\nc"), 4: (2, ""), 5: (3, "q\nq\nq")}


def test_short_runs_of_many_words(spark, make_docs):
    line = " ".join(f"w{i}" for i in range(60))
    half = [" ".join(f"{c}{i}" for i in range(30)) for c in "xy"]
    rows = [(1, f"one\n{line}\ntwo"), (2, f"three\n{line}"), (3, line), (4, "p\n" + "\n".join(half) + "\nq"),
            (5, "\n".join(half)), (6, f"r\n{half[0]}\ns\n{half[1]}"), (7, f"{line}\n{line}\nlast")]
    out = {r["doc_id"]: (r["n_removed"], r["text"]) for r in lines.dedup_lines(make_docs(rows)).collect()}
    assert out == {1: (0, rows[0][1]), 2: (1, "three"), 3: (1, ""), 4: (0, rows[3][1]), 5: (2, ""), 6: (0, rows[5][1]),
                   7: (2, "last")}


def test_lines_are_trimmed_of_spaces_only(spark, make_docs):
    # Digits at the ends of line number i, spaces, and tabs, which stay.
    rows = [(1, "a 0\nb 1\nc 2"), (2, "a \nb \nc "), (3, " a 0\nb 1 \n c 2"), (4, "\ta 0\nb 1\nc 2")]
    out = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(make_docs(rows)).collect()}
    assert out == {1: 0, 2: 0, 3: 3, 4: 0}


def _delete_repeats(rows, run, words):
    """Every window against all earlier ones, line by line."""
    docs = {i: [x.strip(" ") for x in t.split("\n") if x.strip(" ")] for i, t in rows}
    first, gone = {}, {i: set() for i in docs}
    for i in sorted(docs):
        x = docs[i]
        for s in range(len(x)):
            for n in range(1, run + 1):
                w = tuple(x[s:s + n])
                if len(w) < n or not (n == run or len(x) == n or sum(len(y.split()) for y in w) >= words):
                    continue
                j, at = first.setdefault(w, (i, s))
                if (j, at) != (i, s):
                    gone[i] |= set(range(max(s, at + n) if i == j else s, s + n))
    return {i: len(x) for i, x in gone.items()}


@pytest.mark.parametrize("run,words", [(3, 6), (2, 5), (4, 9)])
def test_line_windows_by_brute_force(spark, make_docs, run, words):
    rng = random.Random(run)
    pool = [" ".join(rng.choice("abcd") for _ in range(rng.choice([1, 2, 3, 7]))) for _ in range(9)]
    rows = [(i, "\n".join(rng.choice([*pool, f"own {i} {k}"]) for k in range(rng.randrange(1, 12)))) for i in range(60)]
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(make_docs(rows), run, words).collect()}
    assert got == _delete_repeats(rows, run, words)


def test_triggers_depend_on_the_window_only():
    rng = np.random.default_rng(0)
    same = rng.integers(97, 105, 500).astype(np.uint8)
    found = []
    for pad in (0, 7, 333):
        buf = np.concatenate([rng.integers(97, 105, pad).astype(np.uint8), same])
        t, first, last, _, _ = pfp.triggers(buf, np.arange(len(buf)) <= len(buf) - 200, 200)
        own = np.repeat(t, last - first + 1)[pad:] - pad
        found.append(own)
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all()


@pytest.mark.parametrize("unit", [b"ab", b"abcdefghij"])
def test_suffix_ranks(unit):
    rng = random.Random(5)
    raw = unit * 40 + bytes(rng.choice(b"ab\xff\x00") for _ in range(300)) + unit * 30
    for length in (8, 13, 64, 200):
        rank = pfp.suffix_ranks(np.frombuffer(raw, np.uint8), length)
        cut = [raw[p:p + length] for p in range(len(raw) - length + 1)]
        place = {x: i for i, x in enumerate(sorted(set(cut)))}
        assert rank.tolist() == [place[x] for x in cut]
    assert not len(pfp.suffix_ranks(np.frombuffer(raw[:7], np.uint8), 8))


def test_deal_join(spark):
    rows = spark.createDataFrame([("hot", i % 7) for i in range(3000)] + [(f"k{i}", i) for i in range(50)],
                                 "k string, part int")
    keys = rows.groupBy("k").agg(common.F.count("*").alias("n"), common.F.max("part").alias("top")).where("k <> 'k3'")
    got = common.deal_join(rows, keys, ["k"])
    assert got.columns == ["k", "part", "top"]
    want = rows.join(keys.drop("n"), "k")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert common.deal_join(rows, keys.where("n < 0"), ["k"]).isEmpty()


def test_copies_give_their_strings_once():
    import pyarrow as pa
    want = [{"anchor": 5, "first": 0, "more": 1, "turn": 0, "single": True, "hot": False}]
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("first", pa.int32()), ("more", pa.int16()),
                               ("turn", pa.int16()), ("single", pa.bool_()), ("hot", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 1]), pa.array([2, 2], pa.int32()), pa.array([b"x" * 201] * 2), pa.array([want] * 2, kind)],
        ["dk", "d2", "raw", "want"])
    assert sum(b.num_rows for b in repeats._contexts(200)(iter([batch, batch]))) == 1


def test_hashes_of_stretches():
    rng = np.random.default_rng(4)
    buf = rng.integers(0, 256, 300).astype(np.uint8)
    h = pfp.Hashes(buf, pfp.BASE_2)
    want = lambda p, n: sum((int(c) + 1) * pow(pfp.BASE_2, k, 1 << 64) for k, c in enumerate(buf[p:p + n])) % (1 << 64)
    assert h.at(np.arange(236), 65).tolist() == [want(p, 65) for p in range(236)]
    assert h.all(16).tolist() == [want(p, 16) for p in range(300)]


def test_ranges_of_a_text_are_joined(spark):
    rng = random.Random(2)
    rows = [(k, 0, a, a + rng.randint(1, 9)) for k in (1, 2) for a in rng.sample(range(300), 60)]
    got = repeats.merged_ranges(spark.createDataFrame(rows, "dk long, d2 int, start int, stop int")).collect()
    for k in (1, 2):
        covered = {x for d, _, a, b in rows if d == k for x in range(a, b)}
        mine = sorted((r["start"], r["stop"]) for r in got if r["dk"] == k)
        assert {x for a, b in mine for x in range(a, b)} == covered and all(b < c for (_, b), (c, _) in zip(mine, mine[1:]))


def test_a_long_periodic_text(spark, make_docs):
    """Twenty megabytes of one period: all of it goes, from one row of ranges."""
    got = repeats.remove_repeats(make_docs([(1, "the same words again " * 1_000_000), (2, "other")])).collect()
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in got} == {1: (21_000_000, 1), 2: (0, 0)}
