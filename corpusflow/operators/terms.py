"""From text to term counts: tokens, term frequency, rare and top terms.

Operators on counts work for integer ids and for plain words alike; ``term``
names the column that holds them (``term_id`` or ``term``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from .layout import ByDocument, by_document, counted, dealt_lines, hot_documents
from .scale import fits_broadcast, in_parts, lookup_join, marked, marks, numbered, salted_join, written, written_parts


def tokenize(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row per token: column ``text`` is replaced by ``term``."""
    keep = [c for c in lines.columns if c != text]
    return lines.select(*keep, F.explode(tokens(F.col(text))).alias("term")).filter(F.col("term") != "")


def remove_stop_words(tokens: DataFrame, stop_words: DataFrame, **known: bool) -> DataFrame:
    """``known``: the arguments ``stored`` and ``small`` of ``lookup_join``, here and below."""
    return lookup_join(tokens, stop_words.select("term"), "term", "left_anti", **known)


def encode_terms(tokens: DataFrame, term_dict: DataFrame, **known: bool) -> DataFrame:
    """Replace ``term`` by its ``term_id``; terms outside the dictionary are dropped."""
    return lookup_join(tokens, term_dict.select("term", "term_id"), "term", **known).drop("term")


def encode_documents(lines: DataFrame, doc_dict: DataFrame, **known: bool) -> DataFrame:
    """Replace ``doc_name`` by its ``doc_id``; unknown documents are dropped."""
    return lookup_join(lines, doc_dict.select("doc_name", "doc_id"), "doc_name", **known).drop("doc_name")


def _document_lines(corpus: DataFrame, doc_dict: DataFrame | None, text: str) -> tuple[DataFrame, bool]:
    """Lines of the corpus, with ids if the documents need no dictionary or a small one, and whether they have them."""
    if doc_dict is None:
        return corpus.select("doc_id", text), True
    lines = corpus.select("doc_name", text)
    if fits_broadcast(doc_dict):
        return encode_documents(lines, doc_dict, small=True), True
    return lines, False


def _early(
    rows: DataFrame, stop_words: DataFrame | None, term_dict: DataFrame | None
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Tokens after the lists that are small enough to be broadcast, and the lists that are left."""
    stop_first, terms_first = [d is not None and fits_broadcast(d) for d in (stop_words, term_dict)]
    if stop_first:
        rows, stop_words = remove_stop_words(rows, stop_words, small=True), None
    # a stop word may be in the dictionary, so ids cannot come before the stop words
    if terms_first and stop_words is None:
        return encode_terms(rows, term_dict, small=True), None, None
    if term_dict is not None:
        # words outside the dictionary go before the counts move; the join behind decides
        rows = marked(rows, marks(term_dict, "term"), "term")
    return rows, stop_words, term_dict


def term_frequency(
    corpus: DataFrame,
    stop_words: DataFrame | None = None,
    term_dict: DataFrame | None = None,
    doc_dict: DataFrame | None = None,
    text: str = "value",
) -> DataFrame:
    """Occurrences of each term in each document, one row per pair.

    ``corpus`` has the text column and ``doc_name`` (with ``doc_dict``) or
    ``doc_id``. Lists small enough to broadcast act on the lines and the single
    tokens, before anything is shuffled. A larger list is joined after the
    tokens have been counted: text is never shuffled for it, and the join meets
    one row per document and word. Of the words outside a large term dictionary
    few are counted: marks of fixed size tell most of them.
    """
    lines, known = _document_lines(corpus, doc_dict, text)
    rows, stop_left, terms_left = _early(tokenize(lines, text), stop_words, term_dict)
    rows = rows.groupBy(*reversed(rows.columns)).agg(F.count(F.lit(1)).alias("freq"))

    if not known:
        rows = encode_documents(rows, doc_dict, small=False)
    if stop_left is not None:
        rows = remove_stop_words(rows, stop_left, small=False)
    if terms_left is not None:
        rows = encode_terms(rows, terms_left)
    return rows.select("term" if term_dict is None else "term_id", "doc_id", "freq")


def counts_by_document(
    corpus: DataFrame,
    stop_words: DataFrame | None = None,
    term_dict: DataFrame | None = None,
    doc_dict: DataFrame | None = None,
    text: str = "value",
) -> ByDocument:
    """``term_frequency`` as a layout by document: (term, doc_id, freq, part).

    With lists that can be broadcast the tokens are dealt out by document and
    counted there, one shuffle in all. Larger lists are joined with the counts
    first, as in ``term_frequency``, and the rest is laid out. Without a term
    dictionary nearly all tokens stay, and they take more than their text: then
    the lines move, unless a document must be cut.
    """
    term = "term" if term_dict is None else "term_id"
    lines, known = _document_lines(corpus, doc_dict, text)
    rows, stop_left, terms_left = _early(tokenize(lines, text), stop_words, term_dict)
    if known and stop_left is None and terms_left is None:
        hot, size = hot_documents(lines, text)
        if term_dict is None and hot is None:
            there = _early(tokenize(dealt_lines(lines, size), text), stop_words, None)[0]
            return counted(there, term, None, moved=True, text_bytes=size)
        return counted(rows, term, hot, text_bytes=size)
    return by_document(term_frequency(corpus, stop_words, term_dict, doc_dict, text), term=term)


def vocabulary(terms: DataFrame) -> DataFrame:
    """A term dictionary from the distinct values of ``term``: id 1..n by alphabet."""
    return numbered(terms.select("term").distinct(), "term", "term_id")


def term_totals(triples: DataFrame, term: str = "term_id") -> DataFrame:
    return triples.groupBy(term).agg(F.sum("freq").alias("total"))


def suitable_terms(triples: DataFrame, min_total: int = 3, term: str = "term_id") -> DataFrame:
    """Terms that occur at least ``min_total`` times in the whole corpus."""
    return term_totals(triples, term).filter(F.col("total") >= min_total)


def term_statistics(triples: DataFrame, term: str = "term_id") -> DataFrame:
    """(term, total, df) of unique triples: occurrences and documents of each term in one pass."""
    return triples.groupBy(term).agg(F.sum("freq").alias("total"), F.count(F.lit(1)).alias("df"))


def eliminate_terms(
    triples: DataFrame,
    suitable: DataFrame,
    term: str = "term_id",
    unique_input: bool = False,
    stored: bool = False,
    in_place: bool = False,
) -> DataFrame:
    """Triples of suitable terms, each once.

    ``unique_input`` skips the distinct (a shuffle of all rows) for a written
    table of unique triples, such as the stored result of ``term_frequency``.
    ``stored`` says that ``triples`` are read from written tables: terms beyond
    a broadcast meet them part by part, and copies meet within a part; ``in_place``
    as in ``weights.sum_weights``. Without ``stored``, or with too many parts, marks
    of fixed size drop most rows of other terms; the rest is dealt out by term, a
    hot term by document, too, and joined and made distinct there in one shuffle.
    Copies of one triple meet in one task.
    """
    columns, kept = [term, "doc_id", "freq"], suitable.select(term)
    # the part follows from document and term: copies in a layout are found where they are
    placed = triples.select(*columns, *(["part"] if in_place else []))
    triples = triples.select(*columns)

    def single(rows: DataFrame) -> DataFrame:
        return (rows if unique_input else rows.distinct()).select(*columns)

    if fits_broadcast(suitable):
        return single(lookup_join(placed, kept, term, "left_semi", small=True))
    parts = in_parts(placed, kept, term, "left_semi") if unique_input or stored else None
    if parts:
        return written_parts([single(rows) for rows in parts])
    if unique_input:
        return lookup_join(triples, kept, term, "left_semi", stored=True, small=False)
    rows = written(marked(triples, marks(kept, term), term))
    return salted_join(rows, kept, [term], "left_semi", distinct=True)


def top_terms(totals: DataFrame, k: int = 10, term: str = "term_id") -> DataFrame:
    """The ``k`` terms with the highest total; equal totals in ascending term order."""
    return totals.orderBy(F.desc("total"), F.asc(term)).limit(k)
