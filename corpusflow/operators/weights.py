"""TF-IDF: document frequency, unsmoothed idf, document length, weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .layout import ByDocument, look_up
from .scale import below_broadcast_limit, fits_broadcast, is_stored, stored_join, written, written_lookup


def document_frequency(triples: DataFrame, term: str = "term_id") -> DataFrame:
    """Rows per term, which is documents per term on unique triples."""
    return triples.groupBy(term).agg(F.count(F.lit(1)).alias("df"))


def _log_ratio(n_docs: int) -> Column:
    return F.log(F.lit(float(n_docs)) / F.col("df")).alias("idf")


def idf(
    triples: DataFrame, n_docs: int | None = None, term: str = "term_id", df: DataFrame | None = None
) -> DataFrame:
    """Natural log of ``n_docs / df``, unsmoothed.

    ``n_docs`` defaults to the number of documents that occur in ``triples``;
    ``df`` (term, df), if it is at hand, spares counting the documents of each term.
    """
    if n_docs is None:
        n_docs = triples.select("doc_id").distinct().count()
    return (document_frequency(triples, term) if df is None else df).select(term, _log_ratio(n_docs))


def doc_length(triples: DataFrame) -> DataFrame:
    """Term occurrences per document that are left after all filters."""
    return triples.groupBy("doc_id").agg(F.sum("freq").alias("n_terms"))


def sum_weights(weights: DataFrame, term: str = "term_id", in_place: bool = False) -> DataFrame:
    """One row per term and document; weights of repeated rows are added.

    ``in_place`` says that ``weights`` are rows of one layout with their ``part``, which are added up where
    they are. (Not so the union of two layouts, whose buckets Spark need not bring together.)
    """
    rows = weights.groupBy(term, "doc_id", *_place(in_place)).agg(F.sum("weight").alias("weight"))
    return rows.select(term, "doc_id", "weight")


def _place(in_place: bool) -> list[str]:
    """The part follows from term and document: grouped by it, too, rows of a layout do not move."""
    return ["part"] if in_place else []


def tf_idf(
    triples: DataFrame,
    n_docs: int | None = None,
    term: str = "term_id",
    unique_input: bool = False,
    in_place: bool = False,
) -> DataFrame:
    """Weight ``freq / n_terms * idf`` of each term in each document.

    Repeated rows of a term and document count apart in the document frequency
    and together in the weight; they are combined first. ``unique_input`` skips
    that for a written table of unique triples; ``in_place`` as in ``sum_weights``. The triples are read three
    times, each lookup is written once, measured and then joined; one beyond a
    broadcast is joined part by part.
    """
    copies = F.count(F.lit(1)).alias("copies")
    if unique_input:
        triples = triples.withColumn("copies", F.lit(1))
    else:
        summed = triples.groupBy(term, "doc_id", *_place(in_place)).agg(F.sum("freq").alias("freq"), copies)
        triples = written(summed.select(term, "doc_id", "freq", "copies"))
    lengths = written_lookup(doc_length(triples))
    if n_docs is None:
        n_docs = lengths.observed["rows"]
    rarity = triples.groupBy(term).agg(F.sum("copies").alias("df")).select(term, _log_ratio(n_docs))
    # the lengths first: they are the lookup that outgrows a broadcast, and the triples are stored
    rows = stored_join(triples.drop("copies"), lengths, "doc_id")
    rows = stored_join(rows, written_lookup(rarity), term, stored=is_stored(rows))
    return rows.select(term, "doc_id", (F.col("freq") / F.col("n_terms") * F.col("idf")).alias("weight"))


def tf_idf_by_document(
    triples: ByDocument,
    n_docs: int | None = None,
    term: str = "term_id",
    df: DataFrame | None = None,
) -> ByDocument:
    """``tf_idf`` of a layout of unique triples; the result has the same layout.

    Lengths are summed and joined bucket by bucket. ``df`` (term, df), if it is
    at hand, spares counting the documents of each term; rows of other terms are
    harmless. An idf that is too large for a broadcast is looked up part by part.
    Stored triples with a column ``df`` need no lookup: their lengths are written,
    and a weight is computed where it is read, which costs less than to store it.
    """
    weight = F.col("freq") / F.col("n_terms") * F.col("idf")
    columns = [term, "doc_id", weight.alias("weight"), "part"]
    n_terms = F.sum("freq").alias("n_terms")
    if triples.stored and "df" in triples.rows.columns:
        lengths = triples.written_sums(n_terms)
        n_docs = lengths.filter("part = 0").count() if n_docs is None else n_docs  # every document has a part 0
        sized = triples.rows.join(lengths.hint("shuffle_hash"), ["doc_id", "part"])
        return triples.having(sized.withColumn("idf", _log_ratio(n_docs)).select(*columns), ready=True)
    if df is None:
        df = document_frequency(triples.rows, term)
    number = triples.documents().agg(F.count(F.lit(1)).alias("n")).scalar() if n_docs is None else F.lit(n_docs)
    known = getattr(df, "observed", {}).get("rows")
    rarity = df.select(term, F.log(number.cast("double") / F.col("df")).alias("idf"))
    if known is None:
        rarity = written_lookup(rarity)
        small = fits_broadcast(rarity)
    else:
        small = below_broadcast_limit(triples.rows.sparkSession, df.observed["bytes"])
        rarity = rarity if small else written_lookup(rarity)
    # the idf first: every triple has one, and written triples may be read again for each part of it
    found = look_up(triples, rarity, term, small=small)
    return found.having(found.join_sums(n_terms).select(*columns))
