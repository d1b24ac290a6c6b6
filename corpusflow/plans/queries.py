"""The checked queries: each operator over the given Parquet tables.

The tables have no dictionaries of their own. The distinct tokens of
``benchmark.text`` serve as term dictionary, ``labels.doc_id`` as document
dictionary, and a short list of function words as stop words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks, sources
from ..operators import clustering, scale, terms, vectors, weights
from ..operators.layout import ByDocument, look_up
from .pipeline import Weighted, cluster_corpus, weigh

STOP_WORDS = """
a about after all also an and any are as at be because been but by can could do for from had has have he her his how
i if in into is it its like more most no not of on one only or other our out over she so some such than that the their
them then there these they this to two up was we were what when which who will with would you
""".split()

K = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sources.read_table(spark, f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))


def stop_words(spark: SparkSession) -> DataFrame:
    listed = ", ".join(f"('{w}')" for w in STOP_WORDS)
    return spark.sql(f"SELECT term FROM VALUES {listed} AS s(term)")


def _benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark").select(F.col("text").alias("value"))
    return terms.tokenize(items).distinct()


def term_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.vocabulary(_benchmark_terms(spark, sf_dir))


def doc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doc_name"), "doc_id")


def named_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("doc_name"), F.col("text").alias("value"))


def open_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all words of all documents, stop words removed."""
    return terms.term_frequency(corpus(spark, sf_dir), stop_words(spark))


def _kept(spark: SparkSession, sf_dir: str) -> tuple[ByDocument, DataFrame]:
    """Open counts without rare terms, laid out by document, and the statistics of their terms."""
    counts = terms.counts_by_document(corpus(spark, sf_dir), stop_words(spark))
    known = scale.written_lookup(terms.term_statistics(counts.rows, "term").filter("total >= 3"))
    return look_up(counts, known.select("term", "df"), "term", small=scale.fits_broadcast(known)), known


def _open_weights(spark: SparkSession, sf_dir: str) -> Weighted:
    weighted = weigh(corpus(spark, sf_dir), stop_words(spark))
    weighted.points()
    return weighted


def _dictionary_weights(spark: SparkSession, sf_dir: str) -> Weighted:
    return weigh(
        named_corpus(spark, sf_dir), stop_words(spark), term_dictionary(spark, sf_dir), doc_dictionary(spark, sf_dir)
    )


def _twice(rows: DataFrame) -> DataFrame:
    """Every row two times, where it is."""
    return rows.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


def _rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.tokenize(corpus(spark, sf_dir)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def corpus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files, one folder per source, and read as a corpus: tokens by folder."""
    path = scale.table_path(spark)
    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("folder"), "text")
    docs.write.partitionBy("folder").text(path)
    lines = sources.read_corpus(spark, path)
    folder = F.regexp_extract("doc_name", r"^folder=(.*?)\.part-", 1)
    tokens = terms.tokenize(lines.select(folder.alias("folder"), "value"))
    return tokens.groupBy("folder").agg(F.count(F.lit(1)).alias("n"))


def stopword_filtered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = terms.remove_stop_words(terms.tokenize(corpus(spark, sf_dir)), stop_words(spark))
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term dictionary written as ordered lines and numbered when it is read."""
    path = scale.table_path(spark)
    sinks.write_lines(_benchmark_terms(spark, sf_dir).orderBy("term").select(F.col("term").alias("value")), path)
    return sources.read_term_dictionary(spark, path)


def stop_word_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of ``benchmark`` written as a stop-word file with padding and capitals, read and applied."""
    path = scale.table_path(spark)
    letters = "abcdefghijklmnopqrstuvwxyz"  # capitals of others need not lead back to the same word
    capitals = F.translate("term", letters, letters.upper())
    padded = F.concat(F.lit(" \t"), capitals, F.lit(" \x01 ")).alias("value")
    sinks.write_lines(_benchmark_terms(spark, sf_dir).select(padded), path)
    left = terms.remove_stop_words(terms.tokenize(corpus(spark, sf_dir)), scale.written(sources.read_stop_words(spark, path)))
    return left.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def doc_dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents as a dictionary file of names, numbered when it is read."""
    path = scale.table_path(spark)
    names = doc_dictionary(spark, sf_dir).orderBy("doc_name").select(F.concat(F.lit(" Doc."), "doc_name").alias("value"))
    sinks.write_lines(names, path)
    return sources.read_doc_dictionary(spark, path)


def document_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written by source and language, read as a corpus: lines by folder and file name without its number."""
    path = scale.table_path(spark)
    docs = _table(spark, sf_dir, "documents").select("source", F.concat("lang", F.lit(" +x.txt")).alias("lang"), "text")
    docs.write.partitionBy("source", "lang").text(path)
    lines = sources.read_corpus(spark, path)
    name = F.regexp_replace("doc_name", r"\.part-.*", "")
    return lines.groupBy(name.alias("doc_name")).agg(F.count(F.lit(1)).alias("n"))


def eliminated_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every triple is given twice and comes out once."""
    counts = terms.counts_by_document(corpus(spark, sf_dir), stop_words(spark)).rows
    suitable = scale.written_lookup(terms.suitable_terms(counts, term="term"))
    return terms.eliminate_terms(_twice(counts), suitable, "term", stored=True, in_place=True)


def overwritten_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals written over the lengths of an earlier run, then read."""
    path = scale.table_path(spark)
    sinks.write_pairs(doc_length(spark, sf_dir), path)
    counts = term_frequency(spark, sf_dir)
    sinks.write_pairs(terms.term_totals(counts), path)
    return sources.read_pairs(spark, path, "term_id", "total")


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_frequency(
        named_corpus(spark, sf_dir), stop_words(spark), term_dictionary(spark, sf_dir), doc_dictionary(spark, sf_dir)
    )


def term_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_totals(open_counts(spark, sf_dir), "term")


def suitable_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.suitable_terms(open_counts(spark, sf_dir), term="term")


def eliminated_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = scale.written(open_counts(spark, sf_dir))
    suitable = scale.written_lookup(terms.suitable_terms(counts, term="term"))
    return terms.eliminate_terms(counts, suitable, "term", unique_input=True)


def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.top_terms(term_totals(spark, sf_dir), 10, "term")


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.document_frequency(_kept(spark, sf_dir)[0].rows, "term")


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, known = _kept(spark, sf_dir)
    return weights.idf(kept.rows, kept.documents().count(), "term", known).select("term", _rounded("idf"))


def doc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.doc_length(_kept(spark, sf_dir)[0].rows)


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _kept(spark, sf_dir)
    weighted = weights.tf_idf_by_document(kept, term="term")
    return weighted.rows.select("term", "doc_id", _rounded("weight"))


def tf_idf_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every triple is given twice."""
    triples = _kept(spark, sf_dir)[0].rows.select("term", "doc_id", "freq", "part")
    weighted = weights.tf_idf(_twice(triples), term="term", in_place=True)
    return weighted.select("term", "doc_id", _rounded("weight"))


def sum_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every weight is given twice."""
    weighted = _open_weights(spark, sf_dir).weights
    return weights.sum_weights(_twice(weighted), in_place=True).select("term_id", "doc_id", _rounded("weight"))


def dense_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense rows as text, each weight in millionths."""
    weighted = _dictionary_weights(spark, sf_dir)
    dense = vectors.to_dense_vectors(weighted.weights, weighted.vocabulary)
    millionths = F.transform(
        "vector", lambda e: F.concat_ws(":", e["term_id"], F.round(e["weight"] * 1e6).cast("bigint"))
    )
    return dense.select("doc_id", "block", F.array_join(millionths, ",").alias("vector"))


def dense_vectors_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense rows over the terms that occur in conversations, in blocks of 20; other documents keep zero rows."""
    weighted = _dictionary_weights(spark, sf_dir)
    said = terms.tokenize(_table(spark, sf_dir, "conversations").select(F.col("text").alias("value"))).distinct()
    spoken = terms.encode_terms(said, term_dictionary(spark, sf_dir))
    part = weighted.vocabulary.join(spoken, "term_id", "left_semi")
    dense = vectors.to_dense_vectors(weighted.weights, part, block_terms=20)
    total = F.aggregate("vector", F.lit(0.0), lambda acc, e: acc + e["weight"])
    cells = F.size("vector").cast("bigint").alias("cells")
    return dense.select("doc_id", "block", cells, F.round(total, 6).alias("total"))


def vector_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights written as one vector line per document and read back."""
    path = scale.table_path(spark)
    packed = vectors.sparse_vectors(_open_weights(spark, sf_dir).weights)
    sinks.write_lines(sinks.vector_lines(packed), path)
    return sources.read_vectors(spark, path).select("term_id", "doc_id", _rounded("weight"))


def triples_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scale.table_path(spark)
    sinks.write_triples(term_frequency(spark, sf_dir), path)
    return sources.read_triples(spark, path)


def pairs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scale.table_path(spark)
    sinks.write_pairs(doc_length(spark, sf_dir), path)
    return sources.read_pairs(spark, path, "doc_id", "n_terms")


def initial_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = _open_weights_vocabulary(spark, sf_dir)
    return clustering.initial_centroids(vocabulary, K).select("cluster", "term_id", _rounded("weight"))


def _open_weights_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.vocabulary(suitable_terms(spark, sf_dir))


def _start(weighted: Weighted) -> DataFrame:
    return clustering.initial_centroids(weighted.vocabulary, K)


def document_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = clustering.document_centroids(_open_weights(spark, sf_dir).weights, K)
    return start.select("cluster", "term_id", _rounded("weight"))


def centroid_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = _open_weights(spark, sf_dir)
    found = clustering.similarities(weighted.weights, _start(weighted), K)
    return found.select("doc_id", "cluster", _rounded("similarity"))


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = _open_weights(spark, sf_dir)
    return clustering.assign(weighted.weights, _start(weighted), K)


def _one_pass(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    weighted = _open_weights(spark, sf_dir)
    classes = scale.written(clustering.assign(weighted.weights, _start(weighted), K))
    return weighted.weights, classes, scale.written(clustering.update(weighted.weights, classes))


def kmeans_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, centroids = _one_pass(spark, sf_dir)
    return centroids.select("cluster", "term_id", _rounded("weight"))


def kmeans_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.loss(*_one_pass(spark, sf_dir), K).select(_rounded("loss"))


def _comparable_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded, so that equal weights are equal in any engine."""
    _, _, centroids = _one_pass(spark, sf_dir)
    return centroids.select("cluster", "term_id", _rounded("weight", 12))


def _listed(top: DataFrame) -> DataFrame:
    return top.select("cluster", F.col("rank").cast("bigint").alias("rank"), "term_id", _rounded("weight"))


def cluster_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(clustering.cluster_top_terms(_comparable_centroids(spark, sf_dir)))


def cluster_top_terms_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(clustering.collapsed_top_terms(_comparable_centroids(spark, sf_dir)))


def cluster_top_terms_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(clustering.collapsed_top_terms(_comparable_centroids(spark, sf_dir), cumulative=True))


def centroid_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scale.table_path(spark)
    _, _, centroids = _one_pass(spark, sf_dir)
    sinks.write_lines(sinks.centroid_lines(centroids, vectors.BLOCK_TERMS), path)
    return sources.read_centroids(spark, path).select("cluster", "term_id", _rounded("weight"))


def top_terms_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scale.table_path(spark)
    top = clustering.cluster_top_terms(_comparable_centroids(spark, sf_dir))
    sinks.write_lines(sinks.top_term_lines(top), path)
    back = sources.read_top_terms(spark, path)
    return back.select("cluster", F.col("rank").cast("bigint").alias("rank"), "term_id")


def _fit(spark: SparkSession, sf_dir: str) -> clustering.KMeansRun:
    return cluster_corpus(corpus(spark, sf_dir), stop_words(spark), k=K, iterations=2)


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit(spark, sf_dir).classes


def kmeans_fit_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit(spark, sf_dir).loss.select("iteration", _rounded("loss"))


def kmeans_iterations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of both passes written by iteration; the centroids read back."""
    path = scale.table_path(spark)
    run = _fit(spark, sf_dir)
    sinks.write_iterations({"centers": run.centroids, "loss": run.loss}, path)
    return spark.read.parquet(f"{path}/centers").select("iteration", "cluster", "term_id", _rounded("weight"))


def _restarts(spark: SparkSession, sf_dir: str) -> clustering.KMeansRun:
    weighted = _open_weights(spark, sf_dir)
    return clustering.kmeans_restarts(weighted.weights, weighted.vocabulary, K, restarts=2)


def kmeans_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restarts(spark, sf_dir).loss.select("iteration", _rounded("loss"))


def kmeans_restart_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restarts(spark, sf_dir).classes


def kmeans_iteration_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loss of both passes written by iteration and read back."""
    path = scale.table_path(spark)
    sinks.write_iterations({"loss": _fit(spark, sf_dir).loss}, path)
    return spark.read.parquet(f"{path}/loss").select("iteration", _rounded("loss"))


def kmeans_assign_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings against random centroids with one coordinate per array position."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    width = scale.written(rows.select(F.size("vector").alias("width")).distinct())
    places = width.select(F.explode(F.sequence(F.lit(1), F.col("width"))).alias("place")).distinct()
    places = places.select(F.col("place").cast("bigint").alias("term_id"))
    start = vectors.sparse_vectors(clustering.initial_centroids(places, K), "cluster")
    start = scale.written(start.select("cluster", F.transform("vector", lambda e: e["weight"]).alias("vector")))
    found = clustering.assign_dense(rows, start, "vec_id")
    return found.select("vec_id", "cluster", _rounded("similarity"))


def corpus_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain with dictionaries; centroids of both passes."""
    run = cluster_corpus(
        named_corpus(spark, sf_dir),
        stop_words(spark),
        term_dictionary(spark, sf_dir),
        doc_dictionary(spark, sf_dir),
        k=K,
        iterations=2,
    )
    return run.centroids.select("iteration", "cluster", "term_id", _rounded("weight"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "token_counts": token_counts,
    "corpus_scan": corpus_scan,
    "stopword_filtered_counts": stopword_filtered_counts,
    "term_dictionary": term_dictionary,
    "dictionary_file": dictionary_file,
    "term_frequency": term_frequency,
    "term_frequency_open": open_counts,
    "term_totals": term_totals,
    "suitable_terms": suitable_terms,
    "eliminated_terms": eliminated_terms,
    "top_terms": top_terms,
    "document_frequency": document_frequency,
    "idf": idf,
    "doc_length": doc_length,
    "tf_idf": tf_idf,
    "tf_idf_copies": tf_idf_copies,
    "sum_weights": sum_weights,
    "dense_vectors": dense_vectors,
    "dense_vectors_subset": dense_vectors_subset,
    "stop_word_file": stop_word_file,
    "doc_dictionary_file": doc_dictionary_file,
    "document_names": document_names,
    "eliminated_copies": eliminated_copies,
    "overwritten_output": overwritten_output,
    "kmeans_restart_classes": kmeans_restart_classes,
    "kmeans_iteration_loss": kmeans_iteration_loss,
    "vector_roundtrip": vector_roundtrip,
    "triples_roundtrip": triples_roundtrip,
    "pairs_roundtrip": pairs_roundtrip,
    "initial_centroids": initial_centroids,
    "document_centroids": document_centroids,
    "centroid_similarity": centroid_similarity,
    "kmeans_assign": kmeans_assign,
    "kmeans_update": kmeans_update,
    "kmeans_loss": kmeans_loss,
    "cluster_top_terms": cluster_top_terms,
    "cluster_top_terms_collapsed": cluster_top_terms_collapsed,
    "cluster_top_terms_cumulative": cluster_top_terms_cumulative,
    "centroid_roundtrip": centroid_roundtrip,
    "top_terms_roundtrip": top_terms_roundtrip,
    "kmeans_fit": kmeans_fit,
    "kmeans_fit_loss": kmeans_fit_loss,
    "kmeans_iterations": kmeans_iterations,
    "kmeans_restarts": kmeans_restarts,
    "kmeans_assign_dense": kmeans_assign_dense,
    "corpus_pipeline": corpus_pipeline,
}
