"""The chain from a corpus to clusters of documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clustering, scale, terms, weights
from ..operators.layout import ByDocument, look_up, store


@dataclass
class Weighted:
    """Counts after rare terms are dropped, with ids, and their TF-IDF weights."""

    vocabulary: DataFrame
    triples: DataFrame
    weights: DataFrame
    layout: ByDocument | None = None

    def points(self) -> DataFrame:
        """The weights written once, laid out by document; they are ``weights`` from then on."""
        if clustering.layout_of(self.weights) is None:
            if self.layout is None:
                self.weights = clustering.lay_out(self.weights, self.triples)
            else:
                self.weights = clustering.lay_out(self.layout)
        return self.weights


def weigh(
    corpus: DataFrame,
    stop_words: DataFrame | None = None,
    term_dict: DataFrame | None = None,
    doc_dict: DataFrame | None = None,
    min_total: int = 3,
    n_docs: int | None = None,
) -> Weighted:
    """Count, drop rare terms, weigh.

    With a term dictionary the ids are its own. Without one every word counts,
    and the words that reach the threshold are numbered by alphabet. The text is
    read once: the counts of all words are laid out by document by the shuffle
    that makes them, terms are looked up where the counts are, part by part if
    they are too many for a broadcast, and the weights stay there, too.
    """
    triples = terms.counts_by_document(corpus, stop_words, term_dict, doc_dict)
    name = "term" if term_dict is None else "term_id"
    known = terms.term_statistics(triples.rows, name).filter(F.col("total") >= min_total)
    if term_dict is None:
        # the documents of a term come with its id, which spares looking up the idf
        vocabulary = scale.numbered(known.select("term", "df"), "term", "term_id")
        triples = store(look_up(triples, vocabulary, "term", columns=["term_id", "doc_id", "freq", "df", "part"]))
        layout = weights.tf_idf_by_document(triples, n_docs)
    else:
        vocabulary = scale.written_lookup(known)
        triples = look_up(triples, vocabulary.select("term_id"), "term_id", "left_semi", scale.fits_broadcast(vocabulary))
        layout = weights.tf_idf_by_document(triples, n_docs, df=vocabulary)
    flat = layout.rows.select("term_id", "doc_id", "weight")
    return Weighted(vocabulary, triples.rows.select("term_id", "doc_id", "freq"), flat, layout)


def start_centroids(weighted: Weighted, k: int, method: str, seed: int) -> DataFrame:
    """Centroids to start from: random ones, or the first ``k`` different documents (method "docs")."""
    if method == "docs":
        return clustering.document_centroids(weighted.weights, k)
    return clustering.initial_centroids(weighted.vocabulary, k, method, seed)


def cluster_corpus(
    corpus: DataFrame,
    stop_words: DataFrame | None = None,
    term_dict: DataFrame | None = None,
    doc_dict: DataFrame | None = None,
    min_total: int = 3,
    n_docs: int | None = None,
    k: int = 5,
    iterations: int = 2,
    method: str = "uniform",
    seed: int = 0,
) -> clustering.KMeansRun:
    """From text to classes, centroids, loss and top terms of each pass."""
    weighted = weigh(corpus, stop_words, term_dict, doc_dict, min_total, n_docs)
    points = weighted.points()
    return clustering.kmeans_fit(points, start_centroids(weighted, k, method, seed), k, iterations)
