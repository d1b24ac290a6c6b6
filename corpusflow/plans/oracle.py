"""The checked queries once more, as SQL over the same tables."""

from __future__ import annotations

from .queries import STOP_WORDS, K

_SPLIT = r"""regexp_split_to_array(lower(text), '[\t\n\r\f,.:;?!\[\]''"()& ]+')"""
_STOP = "(VALUES " + ", ".join(f"('{w}')" for w in STOP_WORDS) + ") AS s(term)"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


TOKENS = f"""tokens AS (
  SELECT doc_id, term FROM (SELECT doc_id, unnest({_SPLIT}) AS term FROM documents) WHERE term <> '')"""
DICTIONARY = f"""dictionary AS (
  SELECT term, row_number() OVER (ORDER BY term) AS term_id
  FROM (SELECT DISTINCT unnest({_SPLIT}) AS term FROM benchmark) WHERE term <> '')"""
COUNTS = f"""counts AS (
  SELECT term, doc_id, count(*) AS freq FROM tokens WHERE term NOT IN (SELECT term FROM {_STOP}) GROUP BY term, doc_id)"""
DICT_COUNTS = f"""dict_counts AS (
  SELECT term_id, doc_id, count(*) AS freq FROM tokens JOIN dictionary USING (term)
  WHERE doc_id IN (SELECT doc_id FROM labels) AND term NOT IN (SELECT term FROM {_STOP}) GROUP BY term_id, doc_id)"""
SUITABLE = """suitable AS (
  SELECT term, CAST(sum(freq) AS BIGINT) AS total, row_number() OVER (ORDER BY term) AS term_id
  FROM counts GROUP BY term HAVING sum(freq) >= 3)"""
KEPT = "kept AS (SELECT term, term_id, doc_id, freq FROM counts JOIN suitable USING (term))"
DICT_KEPT = """kept AS (
  SELECT term_id, doc_id, freq FROM dict_counts
  WHERE term_id IN (SELECT term_id FROM dict_counts GROUP BY term_id HAVING sum(freq) >= 3))"""
LISTS = """frequency AS (SELECT term_id, count(*) AS df FROM kept GROUP BY term_id),
lengths AS (SELECT doc_id, sum(freq) AS n_terms FROM kept GROUP BY doc_id),
documents_left AS (SELECT count(*) AS n_docs FROM lengths)"""
WEIGHTS = f"""{LISTS},
weights AS (
  SELECT term_id, doc_id, CAST(freq AS DOUBLE) / CAST(n_terms AS DOUBLE) * ln(CAST(n_docs AS DOUBLE) / df) AS weight
  FROM kept JOIN frequency USING (term_id) JOIN lengths USING (doc_id) CROSS JOIN documents_left),
vocabulary AS (SELECT DISTINCT term_id FROM kept)"""

OPEN = (TOKENS, COUNTS, SUITABLE, KEPT)
OPEN_WEIGHTS = (*OPEN, WEIGHTS)
DICT_WEIGHTS = (TOKENS, DICTIONARY, DICT_COUNTS, DICT_KEPT, WEIGHTS)


def _start(name: str, seed: int = 0, vocabulary: str = "vocabulary") -> str:
    return f"""{name} AS (
  SELECT CAST(c AS INTEGER) AS cluster, term_id,
    CAST(((c + 1) * (term_id % 10007 + 1) * 7919 + (term_id % 10007) * (term_id % 10007) * 104729
      + {seed} * 15485863) % 10007 AS DOUBLE) / CAST(10007 AS DOUBLE) AS weight
  FROM {vocabulary} CROSS JOIN range({K}) AS r(c))"""


def _sims(name: str, centroids: str) -> str:
    return f"""{name} AS (
  WITH dots AS (
    SELECT w.doc_id, c.cluster, sum(w.weight * c.weight) AS dot
    FROM weights w JOIN {centroids} c USING (term_id) GROUP BY ALL),
  lens AS (SELECT doc_id, sqrt(sum(weight * weight)) AS len FROM weights GROUP BY doc_id),
  center_lens AS (SELECT cluster, sqrt(sum(weight * weight)) AS center_len FROM {centroids} GROUP BY cluster)
  SELECT lens.doc_id, center_lens.cluster,
    CASE WHEN len > 0 AND center_len > 0 THEN coalesce(dot, 0) / (len * center_len) END AS similarity
  FROM lens CROSS JOIN center_lens LEFT JOIN dots USING (doc_id, cluster))"""


def _classes(name: str, sims: str) -> str:
    return f"""{name} AS (
  SELECT doc_id, coalesce(cluster, 0) AS cluster FROM (SELECT DISTINCT doc_id FROM weights) LEFT JOIN (
    SELECT doc_id, cluster FROM {sims} WHERE similarity > 0
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(similarity, 9) DESC, cluster) = 1) USING (doc_id))"""


def _means(name: str, classes: str) -> str:
    return f"""{name} AS (
  SELECT cluster, term_id, sum(weight) / max(size) AS weight
  FROM weights JOIN {classes} USING (doc_id)
  JOIN (SELECT cluster, count(*) AS size FROM {classes} GROUP BY cluster) USING (cluster)
  GROUP BY cluster, term_id)"""


def _loss(sims: str, classes: str) -> str:
    return f"""SELECT round(sum(1 - coalesce(similarity, 0)), 6) AS loss
  FROM {classes} LEFT JOIN {sims} USING (doc_id, cluster)"""


def _pass(i: int, centroids: str) -> tuple[str, ...]:
    """CTEs of one pass: classes_i, centers_i and own_i, the similarities to the new centers."""
    return (
        _sims(f"sims_{i}", centroids),
        _classes(f"classes_{i}", f"sims_{i}"),
        _means(f"centers_{i}", f"classes_{i}"),
        _sims(f"own_{i}", f"centers_{i}"),
    )


def _passes(base: tuple[str, ...]) -> tuple[str, ...]:
    return (*base, _start("start"), *_pass(0, "start"), *_pass(1, "centers_0"))


ONE_PASS = (*OPEN_WEIGHTS, _start("start"), *_pass(0, "start"))
ROUNDED = "centroids AS (SELECT cluster, term_id, round(weight, 12) AS weight FROM centers_0)"
COLLAPSED = "single AS (SELECT cluster, weight, max(term_id) AS term_id FROM centroids GROUP BY cluster, weight)"
CUMULATIVE = """shown AS (
  SELECT c.cluster, s.weight, arg_max(s.term_id, CAST(s.cluster AS VARCHAR)) AS term_id
  FROM single s JOIN (SELECT DISTINCT cluster FROM single) c
    ON CAST(c.cluster AS VARCHAR) >= CAST(s.cluster AS VARCHAR)
  GROUP BY c.cluster, s.weight)"""


def _top(table: str, columns: str = "cluster, rank, term_id, round(weight, 6) AS weight") -> str:
    return f"""SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term_id) AS rank FROM {table})
WHERE rank <= 10"""


def _stacked(select: str) -> str:
    return " UNION ALL ".join(select.format(i=i) for i in (0, 1))


_DOC_LENGTH = _with(
    *OPEN, select="SELECT doc_id, CAST(sum(freq) AS BIGINT) AS n_terms FROM kept GROUP BY doc_id"
)
_TERM_DICTIONARY = _with(DICTIONARY, select="SELECT term, term_id FROM dictionary")
_TERM_FREQUENCY = _with(TOKENS, DICTIONARY, DICT_COUNTS, select="SELECT term_id, doc_id, freq FROM dict_counts")
_CENTROIDS = "SELECT cluster, term_id, round(weight, 6) AS weight FROM centers_0"
_RUN_CENTROIDS = _stacked(
    "SELECT {i} AS iteration, cluster, term_id, round(weight, 6) AS weight FROM centers_{i}"
)

ORACLE: dict[str, str] = {
    "token_counts": _with(TOKENS, select="SELECT term, count(*) AS n FROM tokens GROUP BY term"),
    "corpus_scan": _with(
        TOKENS,
        select="SELECT source AS folder, count(*) AS n FROM tokens JOIN documents USING (doc_id) GROUP BY source",
    ),
    "stopword_filtered_counts": _with(
        TOKENS,
        select=f"SELECT term, count(*) AS n FROM tokens WHERE term NOT IN (SELECT term FROM {_STOP}) GROUP BY term",
    ),
    "term_dictionary": _TERM_DICTIONARY,
    "dictionary_file": _TERM_DICTIONARY,
    "term_frequency": _TERM_FREQUENCY,
    "term_frequency_open": _with(TOKENS, COUNTS, select="SELECT term, doc_id, freq FROM counts"),
    "term_totals": _with(
        TOKENS, COUNTS, select="SELECT term, CAST(sum(freq) AS BIGINT) AS total FROM counts GROUP BY term"
    ),
    "suitable_terms": _with(TOKENS, COUNTS, SUITABLE, select="SELECT term, total FROM suitable"),
    "eliminated_terms": _with(*OPEN, select="SELECT DISTINCT term, doc_id, freq FROM kept"),
    "top_terms": _with(
        TOKENS,
        COUNTS,
        select="SELECT term, CAST(sum(freq) AS BIGINT) AS total FROM counts GROUP BY term"
        " ORDER BY total DESC, term LIMIT 10",
    ),
    "document_frequency": _with(*OPEN, select="SELECT term, count(*) AS df FROM kept GROUP BY term"),
    "idf": _with(
        *OPEN,
        LISTS,
        select="SELECT term, round(ln(CAST(n_docs AS DOUBLE) / df), 6) AS idf"
        " FROM suitable JOIN frequency USING (term_id) CROSS JOIN documents_left",
    ),
    "doc_length": _DOC_LENGTH,
    "tf_idf": _with(
        *OPEN_WEIGHTS,
        select="SELECT term, doc_id, round(weight, 6) AS weight FROM weights JOIN suitable USING (term_id)",
    ),
    "sum_weights": _with(
        *OPEN_WEIGHTS, select="SELECT term_id, doc_id, round(2 * weight, 6) AS weight FROM weights"
    ),
    "tf_idf_copies": _with(
        *OPEN,
        LISTS,
        select="SELECT term, doc_id, round(2 * CAST(freq AS DOUBLE) / CAST(2 * n_terms AS DOUBLE)"
        " * ln(CAST(n_docs AS DOUBLE) / (2 * df)), 6) AS weight"
        " FROM kept JOIN frequency USING (term_id) JOIN lengths USING (doc_id) CROSS JOIN documents_left",
    ),
    "dense_vectors": _with(
        *DICT_WEIGHTS,
        "places AS (SELECT term_id, (row_number() OVER (ORDER BY term_id) - 1) // 65536 AS block FROM vocabulary)",
        select="SELECT doc_id, block, string_agg(term_id || ':' || CAST(round(coalesce(weight, 0) * 1e6) AS BIGINT), ','"
        " ORDER BY term_id) AS vector"
        " FROM lengths CROSS JOIN places LEFT JOIN weights USING (doc_id, term_id) GROUP BY doc_id, block",
    ),
    "dense_vectors_subset": _with(
        *DICT_WEIGHTS,
        f"spoken AS (SELECT DISTINCT unnest({_SPLIT}) AS term FROM conversations)",
        "places AS (SELECT term_id, (row_number() OVER (ORDER BY term_id) - 1) // 20 AS block"
        " FROM vocabulary WHERE term_id IN (SELECT term_id FROM dictionary JOIN spoken USING (term)))",
        select="SELECT doc_id, block, count(*) AS cells, round(sum(coalesce(weight, 0)), 6) AS total"
        " FROM lengths CROSS JOIN places LEFT JOIN weights USING (doc_id, term_id) GROUP BY doc_id, block",
    ),
    "stop_word_file": _with(
        TOKENS,
        DICTIONARY,
        select="SELECT term, count(*) AS n FROM tokens WHERE term NOT IN (SELECT term FROM dictionary) GROUP BY term",
    ),
    "doc_dictionary_file": "SELECT 'doc.' || doc_id AS doc_name, row_number() OVER (ORDER BY CAST(doc_id AS VARCHAR))"
    " AS doc_id FROM (SELECT DISTINCT doc_id FROM labels)",
    "document_names": "SELECT 'lang=' || lang || ' +x.txt' AS doc_name,"
    " CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n FROM documents GROUP BY lang",
    "eliminated_copies": _with(*OPEN, select="SELECT term, doc_id, freq FROM kept"),
    "overwritten_output": _with(
        TOKENS,
        DICTIONARY,
        DICT_COUNTS,
        select="SELECT term_id, CAST(sum(freq) AS BIGINT) AS total FROM dict_counts GROUP BY term_id",
    ),
    "kmeans_restart_classes": _with(
        *OPEN_WEIGHTS,
        _start("start_0", seed=0),
        *_pass(0, "start_0"),
        _start("start_1", seed=1),
        *_pass(1, "start_1"),
        select=_stacked("SELECT {i} AS iteration, doc_id, cluster FROM classes_{i}"),
    ),
    "kmeans_iteration_loss": _with(
        *_passes(OPEN_WEIGHTS),
        select=" UNION ALL ".join(
            f"SELECT {i} AS iteration, loss FROM ({_loss(f'own_{i}', f'classes_{i}')})" for i in (0, 1)
        ),
    ),
    "vector_roundtrip": _with(
        *OPEN_WEIGHTS, select="SELECT term_id, doc_id, round(weight, 6) AS weight FROM weights"
    ),
    "triples_roundtrip": _TERM_FREQUENCY,
    "pairs_roundtrip": _DOC_LENGTH,
    "initial_centroids": _with(
        TOKENS,
        COUNTS,
        SUITABLE,
        _start("start", vocabulary="suitable"),
        select="SELECT cluster, term_id, round(weight, 6) AS weight FROM start",
    ),
    "document_centroids": _with(
        *OPEN_WEIGHTS,
        "vectors AS (SELECT doc_id, list((term_id, weight) ORDER BY term_id) AS vector FROM weights GROUP BY doc_id)",
        "seeds AS (SELECT min(doc_id) AS doc_id FROM vectors GROUP BY vector ORDER BY doc_id LIMIT 5)",
        select="SELECT CAST(cluster AS INTEGER) AS cluster, term_id, round(weight, 6) AS weight FROM weights JOIN"
        " (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS cluster FROM seeds) USING (doc_id)",
    ),
    "centroid_similarity": _with(
        *OPEN_WEIGHTS,
        _start("start"),
        _sims("sims", "start"),
        select="SELECT doc_id, cluster, round(similarity, 6) AS similarity FROM sims",
    ),
    "kmeans_assign": _with(*ONE_PASS, select="SELECT doc_id, cluster FROM classes_0"),
    "kmeans_update": _with(*ONE_PASS, select=_CENTROIDS),
    "kmeans_loss": _with(*ONE_PASS, select=_loss("own_0", "classes_0")),
    "cluster_top_terms": _with(*ONE_PASS, ROUNDED, select=_top("centroids")),
    "cluster_top_terms_collapsed": _with(*ONE_PASS, ROUNDED, COLLAPSED, select=_top("single")),
    "cluster_top_terms_cumulative": _with(*ONE_PASS, ROUNDED, COLLAPSED, CUMULATIVE, select=_top("shown")),
    "centroid_roundtrip": _with(*ONE_PASS, select=_CENTROIDS),
    "top_terms_roundtrip": _with(*ONE_PASS, ROUNDED, select=_top("centroids", "cluster, rank, term_id")),
    "kmeans_fit": _with(
        *_passes(OPEN_WEIGHTS), select=_stacked("SELECT {i} AS iteration, doc_id, cluster FROM classes_{i}")
    ),
    "kmeans_fit_loss": _with(
        *_passes(OPEN_WEIGHTS),
        select=" UNION ALL ".join(
            f"SELECT {i} AS iteration, loss FROM ({_loss(f'own_{i}', f'classes_{i}')})" for i in (0, 1)
        ),
    ),
    "kmeans_iterations": _with(*_passes(OPEN_WEIGHTS), select=_RUN_CENTROIDS),
    "kmeans_restarts": _with(
        *OPEN_WEIGHTS,
        _start("start_0", seed=0),
        *_pass(0, "start_0"),
        _start("start_1", seed=1),
        *_pass(1, "start_1"),
        select=" UNION ALL ".join(
            f"SELECT {i} AS iteration, loss FROM ({_loss(f'own_{i}', f'classes_{i}')})" for i in (0, 1)
        ),
    ),
    "kmeans_assign_dense": _with(
        "vectors AS (SELECT vec_id AS doc_id, unnest(range(1, len(embedding) + 1)) AS term_id,"
        " CAST(unnest(embedding) AS DOUBLE) AS weight FROM embeddings)",
        "weights AS (SELECT * FROM vectors)",
        "vocabulary AS (SELECT DISTINCT term_id FROM vectors)",
        _start("start"),
        _sims("sims", "start"),
        _classes("classes", "sims"),
        select="SELECT doc_id AS vec_id, cluster, round(CASE WHEN similarity > 0 THEN similarity ELSE 0 END, 6)"
        " AS similarity FROM classes LEFT JOIN sims USING (doc_id, cluster)",
    ),
    "corpus_pipeline": _with(*_passes(DICT_WEIGHTS), select=_RUN_CENTROIDS),
}
