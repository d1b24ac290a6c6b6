"""Between sparse weights and one-row-per-document vectors."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scale import below_broadcast_limit, is_stored, lookup_join, numbered, written

# Terms in one row of a dense vector, about 1 MB.
BLOCK_TERMS = 65_536


def sparse_vectors(weights: DataFrame, key: str = "doc_id", entries_per_row: int | None = None) -> DataFrame:
    """Rows (key, vector): the (term_id, weight) entries of a document by ascending term.

    By default a document is one row. ``entries_per_row`` deals its entries out
    over rows of about that many, by a hash of the term; for keys with a great
    part of all terms. Weights laid out by document are packed where they are.
    """
    entries = F.sort_array(F.collect_list(F.struct("term_id", "weight"))).alias("vector")
    if entries_per_row is None:
        layout = getattr(weights, "layout", None)
        in_place = key == "doc_id" and layout is not None and layout.hot is None
        return weights.groupBy(key, *(["part"] if in_place else [])).agg(entries).select(key, "vector")
    weights = weights if is_stored(weights) else written(weights)
    sizes = weights.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / entries_per_row)
    rows = lookup_join(weights, written(sizes), key, stored=True)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("term_id"), parts))
    return rows.groupBy(key, "_part").agg(entries).drop("_part")


def from_vectors(vectors: DataFrame, key: str = "doc_id") -> DataFrame:
    """Vectors back to one row per entry; zero entries are kept."""
    return vectors.select(key, F.inline("vector")).select("term_id", key, "weight")


def to_dense_vectors(
    weights: DataFrame, vocabulary: DataFrame | None = None, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """Rows (doc_id, block, vector) with an entry for every vocabulary term, zeros filled in.

    A block holds ``block_terms`` terms of the sorted vocabulary, the last one
    what is left, so no row grows with the vocabulary. ``vocabulary`` (column
    term_id) defaults to the terms of ``weights``; other terms of ``weights``
    are dropped, their documents stay. The result has documents x terms cells:
    it is an export form, clustering works on the sparse rows.

    The entries of a block are sorted where they meet; each becomes the zeros
    since the one before and itself, so a block is filled by place without a
    look at its cells. The weights are written once if they are not stored.
    """
    if not is_stored(weights):
        weights = written(weights.select("term_id", "doc_id", "weight"))
    source = weights if vocabulary is None else vocabulary
    places = numbered(source.select("term_id").distinct(), "term_id", "place")
    n_terms, at = places.observed["rows"], F.col("place") - 1
    size = {"rows": n_terms, "bytes": places.observed["bytes"] + 8 * n_terms}
    places = places.select("term_id", F.floor(at / block_terms).alias("block"), F.pmod(at, F.lit(block_terms)).alias("at"))
    small = below_broadcast_limit(weights.sparkSession, size["bytes"])
    if not small:
        places = written(places)
    blocks = places.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "term_id")))["term_id"].alias("term_id"))

    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(math.ceil(n_terms / block_terms), 1) - 1).cast("bigint")))
    none = [F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("double").alias("weight")]
    grid = weights.select("doc_id").distinct().select("doc_id", every.alias("block"), *none)
    found = lookup_join(weights, places, "term_id", stored=True, small=small).select("doc_id", "block", "at", "weight")
    before = F.lag("at").over(Window.partitionBy("doc_id", "block").orderBy("at"))  # the row of the grid comes first
    gap = (F.col("at") - F.coalesce(before, F.lit(-1)) - 1).cast("int")
    piece = F.concat(F.array_repeat(F.lit(0.0), gap), F.array("weight"))
    pieces = found.unionByName(grid).select("doc_id", "block", "at", piece.alias("piece"))
    entry = F.when(F.col("at").isNotNull(), F.struct("at", "piece"))
    rows = pieces.groupBy("doc_id", "block").agg(
        F.array_sort(F.collect_list(entry))["piece"].alias("pieces"), (F.coalesce(F.max("at"), F.lit(-1)) + 1).alias("filled")
    )
    # a block stands against all documents: small tables of blocks are broadcast, AQE splits larger ones
    rows = rows.join(F.broadcast(blocks) if small else blocks, "block")
    nothing = F.array().cast("array<array<double>>")
    filled = F.flatten(F.concat(nothing, "pieces"))
    tail = F.array_repeat(F.lit(0.0), (F.size("term_id") - F.col("filled")).cast("int"))
    rows = rows.select("doc_id", "block", "term_id", F.concat(filled, tail).alias("weight"))
    return rows.select("doc_id", "block", F.arrays_zip("term_id", "weight").alias("vector"))
