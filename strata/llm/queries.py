"""The operators as named queries over the given tables, whole, and the SQL of
those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from . import (contamination, html_text, lang, lexical, lines, mixing, near_text, pii, repeats, token_counts,
               token_files, vectors, whitening)
from .common import table


def op1_line_dedup(spark, src):
    return lines.dedup_lines(table(spark, src, "documents"))


def op2_ngram_jaccard(spark, src):
    return near_text.near_texts(table(spark, src, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op3_html_text(spark, src):
    return html_text.extract(table(spark, src, "pages"))


def op4_embedding_near_dup(spark, src):
    return vectors.near_vectors(table(spark, src, "embeddings"))


def op5_source_mix(spark, src):
    return mixing.fair_mix(table(spark, src, "documents")).drop("source", "key")


def op6_token_files(spark, src):
    return token_files.read_tokens(spark, token_files.write_tokens(table(spark, src, "documents"),
                                                                   scratch_path(spark, "tokens")))


def op7_decontamination(spark, src):
    docs = table(spark, src, "documents").select("doc_id", "text")
    found = contamination.find_items(docs, table(spark, src, "benchmark"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids")


def op8_token_counts(spark, src):
    return token_counts.count_tokens(table(spark, src, "documents"))


def op9_suffix_dedup(spark, src):
    return repeats.remove_repeats(table(spark, src, "documents")).drop("spans")


def op10_language_id(spark, src):
    docs = table(spark, src, "documents")
    found = lang.identify(docs.select("doc_id", "text"), lang.fit(docs))
    return found.select("doc_id", lang.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_embedding_whitening(spark, src):
    return whitening.whiten(table(spark, src, "embeddings"))


def op12_personal_data(spark, src):
    docs = table(spark, src, "documents")
    found = pii.find_personal_data(docs.select("doc_id", "text"), pii.fit(docs))
    return found.drop("text")


def op13_lexical_search(spark, src):
    return lexical.search(table(spark, src, "documents"), table(spark, src, "benchmark"))


REGISTRY = {f.__name__: f for f in (op1_line_dedup, op2_ngram_jaccard, op3_html_text, op4_embedding_near_dup,
                                    op5_source_mix, op6_token_files, op7_decontamination, op8_token_counts,
                                    op9_suffix_dedup, op10_language_id, op11_embedding_whitening,
                                    op12_personal_data, op13_lexical_search)}

# Shared shingles counted pair by pair; classes by a recursive walk over the links.
_OP2 = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')),
                                                       '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE c >= 0.8 * (x.n + y.n - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, min(root) AS class_id, CAST(coalesce(any_value(n_links), 0) AS BIGINT) AS n_links,
       doc_id = min(root) AS kept
FROM r LEFT JOIN k USING (doc_id) GROUP BY doc_id"""

_OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT *, list_inner_product(e, e) AS q FROM v
      WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) WHERE a.q > 0 AND b.q > 0 AND list_inner_product(a.e, b.e) >= 0.98 * sqrt(a.q) * sqrt(b.q)),
r(vec_id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
k AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_links, min(root) AS component_id, vec_id = min(root) AS kept
FROM r LEFT JOIN k USING (vec_id) GROUP BY vec_id"""

ORACLE = {
    "op1_line_dedup": lines.oracle_sql(),
    "op2_ngram_jaccard": _OP2,
    "op4_embedding_near_dup": _OP4,
    "op5_source_mix": f"SELECT * FROM ({mixing.oracle_sql()})",
    "op13_lexical_search": lexical.ORACLE_SQL,
}
