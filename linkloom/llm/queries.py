"""The corpus operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.common import table
from linkloom.llm.decontamination import benchmark_hits
from linkloom.llm.language_id import language_ids
from linkloom.llm.license_scan import license_scan
from linkloom.llm.ngram_join import ngram_jaccard_classes
from linkloom.llm.packing import best_fit_packing
from linkloom.llm.pii import pii_spans
from linkloom.llm.pitman_yor import perplexities
from linkloom.llm.pivot_index import embedding_classes
from linkloom.llm.quality_gam import quality_scores
from linkloom.llm.token_counts import token_counts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_perplexity": lambda s, d: perplexities(table(s, d, "documents")),
        "op2_pii_spans": lambda s, d: pii_spans(table(s, d, "documents")),
        "op3_language_id": lambda s, d: language_ids(table(s, d, "documents")),
        "op4_ngram_jaccard": lambda s, d: ngram_jaccard_classes(table(s, d, "documents")),
        "op5_license_scan": lambda s, d: license_scan(table(s, d, "documents")),
        "op6_benchmark_hits": lambda s, d: benchmark_hits(table(s, d, "documents"), table(s, d, "benchmark")),
        "op7_embedding_pairs": lambda s, d: embedding_classes(table(s, d, "embeddings")),
        "op8_token_counts": lambda s, d: token_counts(table(s, d, "documents")),
        "op9_quality_scores": lambda s, d: quality_scores(table(s, d, "documents"), table(s, d, "labels")),
        "op10_best_fit_packing": lambda s, d: best_fit_packing(table(s, d, "documents")),
    }


_CLASSES = """
reach(id, other) AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
    UNION SELECT r.id, l.other FROM reach r JOIN (SELECT a AS id, b AS other FROM links UNION SELECT b, a FROM links) l ON r.other = l.id),
counts AS (SELECT id, count(*) AS n_links FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
"""

_NGRAM_JACCARD = f"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-zA-Z\\x{{80}}-\\x{{10FFFF}}]+') AS w
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i IN range(1, len(w) - 1)]
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
    FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE k >= 0.6 * (s.n + t.n - k) - 1e-9),
{_CLASSES}
SELECT id AS doc_id, least(id, min(other)) AS class_id, any_value(n_links) AS n_links FROM reach JOIN counts USING (id) GROUP BY id
"""

_EMBEDDINGS = f"""
WITH RECURSIVE links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id
    WHERE list_cosine_similarity(x.embedding, y.embedding) >= 0.95),
{_CLASSES}
SELECT id AS vec_id, least(id, min(other)) AS class_id, any_value(n_links) AS n_links FROM reach JOIN counts USING (id) GROUP BY id
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that are exact, or, for the index of embeddings, of what it is to find."""
    return {"op4_ngram_jaccard": _NGRAM_JACCARD, "op7_embedding_pairs": _EMBEDDINGS}
