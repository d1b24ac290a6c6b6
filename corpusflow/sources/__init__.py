"""Readers for text corpora, lists and matrix files."""

from .text import (
    read_centroids,
    read_corpus,
    read_dictionary,
    read_doc_dictionary,
    read_pairs,
    read_stop_words,
    read_table,
    read_term_dictionary,
    read_top_terms,
    read_triples,
    read_vectors,
    read_weights,
)

__all__ = [
    "read_centroids",
    "read_corpus",
    "read_dictionary",
    "read_doc_dictionary",
    "read_pairs",
    "read_stop_words",
    "read_table",
    "read_term_dictionary",
    "read_top_terms",
    "read_triples",
    "read_vectors",
    "read_weights",
]
