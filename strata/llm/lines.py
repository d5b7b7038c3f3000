"""Line dedup by winnowing over line hashes (native)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deal_join, stage, text_key

RUN = 3       # lines: the shortest repeated run that is deleted whatever its words
WORDS = 50    # a shorter run is deleted too if it holds so many words
_WORD = "[^\\x09-\\x0D ]+"


def _fingerprints(docs: DataFrame, run: int, words: int) -> DataFrame:
    """One row per selected position: (doc_id, key, fp, windows).  fp is the line
    hash at the position, the smallest of some window of ``run`` lines, or of
    fewer lines with ``words`` words; windows are those that it stands for."""
    lines = docs.select("doc_id", text_key(F.col("text")).alias("key"),
                        F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x)),
                                 lambda x: x != "").alias("lines"))
    # The one-element explodes keep an array from being computed again for each of its elements.
    both = lines.select("doc_id", "key", F.inline(F.array(F.struct(
        F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("h"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(2), x)).alias("g"),
        F.transform("lines", lambda x: F.regexp_count(x, F.lit(_WORD))).alias("w"))))).where("size(h) > 0")

    def here(pos):
        low = F.greatest(pos - (run - 1), F.lit(0))
        size = F.least(pos + run, F.size("h")) - low
        return F.struct(pos.cast("int").alias("pos"), F.size("h").alias("n"), F.element_at("h", pos + 1).alias("fp"),
                        (pos - low).cast("int").alias("before"),
                        *[F.slice(c, low + 1, size).alias(c) for c in ("h", "g", "w")])

    places = both.select("doc_id", "key", F.inline(F.transform(F.sequence(F.lit(0), F.size("h") - 1), here)))
    return (places.where(reduce(or_, [w[0] for w in _windows(run, words)]))
            .select("doc_id", "key", "fp", _extensions(run, words).alias("windows")))


def _windows(run: int, words: int):
    """The windows that a position's fingerprint may stand for: the position
    extended by every number of lines to the left and to the right that makes a
    window of ``run`` lines, of fewer with ``words`` words, or of a shorter
    document's all lines.  The position's row has fp, pos, n (the document's
    lines) and h, g and w, two hashes and the number of words of each line less
    than ``run`` lines away, ``before`` of them before pos.  Of each (valid, s, len, h, g): whether it lies in the
    document and its first smallest line hash stands at the position, where it
    starts, and the two hashes of its lines."""
    out = []
    for size in range(1, run + 1):
        for left in range(size):
            s = F.col("pos") - left
            inside = (F.col("before") >= left) & (s + size <= F.col("n"))
            # Out of the document, slice(.., 1, 0) keeps the expression defined.
            at = F.when(inside, F.col("before") - left + 1).otherwise(F.lit(1))
            part, twin, held = (F.slice(c, at, F.when(inside, F.lit(size)).otherwise(F.lit(0))) for c in ("h", "g", "w"))
            whole = F.lit(True) if size == run else (
                (F.col("n") == size) | (F.aggregate(held, F.lit(0), lambda a, x: a + x) >= words))
            lowest = F.array_position(part, F.array_min(part)) == left + 1
            out.append((F.coalesce(inside & whole & lowest, F.lit(False)), s, F.lit(size), part, twin))
    return out


def _extensions(run: int, words: int):
    """The valid ones of ``_windows``, as an array of (s, len, k1, k2); k1 and k2
    identify the window's lines."""
    valid = F.filter(F.array(*[
        F.struct(valid.alias("valid"), s.alias("s"), size.alias("len"), F.xxhash64(part).alias("k1"),
                 F.xxhash64(F.lit(3), twin).alias("k2")) for valid, s, size, part, twin in _windows(run, words)]),
        lambda x: x["valid"])
    return F.transform(valid, lambda x: F.struct(x["s"].alias("s"), x["len"].alias("len"), x["k1"].alias("k1"),
                                                 x["k2"].alias("k2")))


def repeated_lines(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """(doc_id, key, removed): per document with deletions, the positions
    (among its lines that are not blank) to delete.

    Winnowing: every window of ``run`` lines, and every shorter one with
    ``words`` words, selects its smallest line hash as fingerprint, so two
    documents that share such a window are guaranteed to share a fingerprint.
    Positions are joined with the fingerprints that occur at several places;
    those that join are matched by their extensions both ways, the windows that
    they stand for (hashed when the position is selected): each with the first
    place, in order of (doc_id, text key, position), that extends alike.  That place
    stays, later ones go; overlapping windows make up longer runs.
    Groups are only aggregated (map-side first), never gathered, each window is
    compared with the first of its group alone, and the places of a frequent
    fingerprint are dealt over several tasks."""
    prints = stage(_fingerprints(docs, run, words), "line-prints")
    marks = stage(prints.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1"), "line-marks")
    # These grow with the corpus: always merge joins, whatever size they have by chance.
    near = stage(deal_join(prints, marks.hint("merge"), ["fp"]).select("doc_id", "key", F.inline("windows")), "line-near")
    place = F.struct("doc_id", "key", "s")
    same_run = ["k1", "k2", "len"]
    firsts = near.groupBy(*same_run).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = deal_join(near, stage(firsts, "line-firsts").hint("merge"), same_run).where(place > F.col("first"))
    # Lines of a first occurrence that its own repetition overlaps stay.
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    start = F.when(same, F.greatest("s", F.col("first.s") + F.col("len"))).otherwise(F.col("s"))
    spans = (later.select("doc_id", "key", start.alias("from"), (F.col("s") + F.col("len") - 1).alias("to"))
             .where("from <= to").groupBy("doc_id", "key").agg(F.collect_set(F.struct("from", "to")).alias("spans")))
    # Stored, so that what the windows shuffled is gone before the texts move.
    return stage(spans.select("doc_id", "key", F.array_distinct(F.flatten(F.transform(
        "spans", lambda x: F.sequence(x["from"], x["to"])))).alias("removed")), "line-gone")


def dedup_lines(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """Delete runs of ``run`` or more lines, or of ``words`` or more words, that
    occur earlier in the corpus.

    Lines are the pieces between line feeds, compared without the spaces around
    them; blank lines are skipped in matching and always stay.  A document of
    fewer lines than ``run`` is also one run as a whole, which, short of ``words``
    words, matches only all lines of another such document.  Words are runs of
    characters other than ASCII white space.  Null and empty texts have no lines.  Rows with the same
    doc_id and text count as one document and get the same result.  Nulls in
    doc_id order first.

    Returns (doc_id, n_lines, n_removed, text), one row per input row: lines
    that are not blank, those deleted, and the text without them ('' for a null
    text)."""
    gone = repeated_lines(docs, run, words).hint("merge")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key(F.col("text")).alias("key"))
    d, gone = d.alias("d"), gone.alias("r")
    d = (d.join(gone, F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.key") == F.col("r.key")), "left")
         .select("d.doc_id", "d.text", "r.removed"))
    # Number the lines that are not blank by a running count, then drop the removed numbers.
    parts = d.select("doc_id", "text", "removed", F.inline(F.array(F.struct(F.split("text", "\n").alias("lines")))))
    filled = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: F.trim(F.element_at(F.col("lines"), i)) != "")
    parts = parts.select("doc_id", "text", "lines", "removed", F.inline(F.array(F.struct(filled.alias("filled")))))
    drop = F.transform("removed", lambda i: F.element_at(F.col("filled"), i + 1))
    parts = parts.select("doc_id", "text", "lines", "removed", F.size("filled").alias("n_lines"),
                         F.inline(F.array(F.struct(drop.alias("drop")))))
    left = F.transform(F.array_except(F.sequence(F.lit(1), F.size("lines")), F.col("drop")),
                       lambda i: F.element_at(F.col("lines"), i))
    return parts.select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
                        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"))


def oracle_sql(run: int = RUN, words: int = WORDS) -> str:
    """The rule itself in DuckDB SQL: all windows, without fingerprints."""
    windows = " UNION ALL ".join(f"""
      SELECT l.doc_id, s, {size} AS len, string_agg(trim(line), chr(10)) OVER o AS body
      FROM l JOIN n USING (doc_id)
      WINDOW o AS (PARTITION BY l.doc_id ORDER BY s ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)
      QUALIFY s <= n - {size - 1} AND ({size} = {run} OR n = {size} OR sum(words) OVER o >= {words})"""
                               for size in range(1, run + 1))
    return f"""
WITH l AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS s, i, line,
                  len(regexp_extract_all(line, '[^\\x09-\\x0D ]+')) AS words FROM (
             SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
                    unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
           WHERE trim(line) <> ''),
n AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id),
w AS ({windows}),
f AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(s) OVER o AS fs, row_number() OVER o AS nth
      FROM w WINDOW o AS (PARTITION BY body, len ORDER BY doc_id, s)),
g AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN fd = doc_id THEN greatest(s, fs + len) ELSE s END, s + len)) AS s
      FROM f WHERE nth > 1),
a AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (g.s IS NOT NULL) AS n_removed
      FROM l LEFT JOIN g USING (doc_id, s) GROUP BY doc_id),
k AS (SELECT d.doc_id, string_agg(d.line, chr(10) ORDER BY d.i) AS text
      FROM (SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
                   unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) d
      LEFT JOIN l USING (doc_id, i) LEFT JOIN g ON g.doc_id = d.doc_id AND g.s = l.s
      WHERE g.s IS NULL GROUP BY d.doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed,
       coalesce(k.text, '') AS text
FROM (SELECT doc_id FROM documents) LEFT JOIN a USING (doc_id) LEFT JOIN k USING (doc_id)"""
