"""Text lines of the result tables, and their writers.

The vector and top-term formats put a whole vector on one line unless told
otherwise, so a line grows with the vocabulary. They are for exchange; between
stages use Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import vector_text
from ..operators.vectors import sparse_vectors


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_pairs(df: DataFrame, path: str) -> None:
    """Last column after a tab, the columns before it joined by spaces."""
    *key, value = df.columns
    write_lines(df.select(F.concat_ws("\t", F.concat_ws(" ", *key), value).alias("value")), path)


def write_triples(df: DataFrame, path: str) -> None:
    """All columns joined by spaces."""
    write_lines(df.select(F.concat_ws(" ", *df.columns).alias("value")), path)


def vector_lines(vectors: DataFrame) -> DataFrame:
    """``doc|t:w,t:w,...`` from (doc_id, vector)."""
    return vectors.select(F.concat_ws("|", "doc_id", vector_text(F.col("vector"))).alias("value"))


def centroid_lines(centroids: DataFrame, entries_per_line: int | None = None) -> DataFrame:
    """``cluster<tab>t:w,t:w,...`` from (cluster, term_id, weight).

    By default a cluster is one line; ``entries_per_line`` gives it several of
    about that many entries, which the readers put together again.
    """
    packed = sparse_vectors(centroids, "cluster", entries_per_line)
    return packed.select(F.concat_ws("\t", "cluster", vector_text(F.col("vector"))).alias("value"))


def top_term_lines(top_terms: DataFrame) -> DataFrame:
    """``cluster<tab>t,t,...,`` with a comma after every term, from (cluster, rank, term_id)."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "term_id")))["term_id"]
    listed = top_terms.groupBy("cluster").agg(F.array_join(ranked, ",").alias("terms"))
    return listed.select(F.concat(F.concat_ws("\t", "cluster", "terms"), F.lit(",")).alias("value"))


def write_iterations(tables: dict[str, DataFrame], path: str) -> None:
    """Parquet outputs of a clustering run: ``path/<name>/iteration=<i>``."""
    for name, table in tables.items():
        table.write.mode("overwrite").partitionBy("iteration").parquet(f"{path}/{name}")
