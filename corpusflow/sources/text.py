"""Text readers. Each returns typed columns; numbers that do not parse raise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import doc_name, list_entry
from ..functions.vectors import vector_entries
from ..operators.scale import size_shuffles, spread


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; shuffles are sized for it; one with fewer splits than cores is dealt out when it is read."""
    scan = spark.read.parquet(path)
    size_shuffles(scan)
    return spread(scan)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a folder tree ``category/name.txt``: (doc_name, value). The files are listed once, also to size shuffles."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    size_shuffles(lines)
    return lines.select(doc_name(F.col("_metadata.file_path")).alias("doc_name"), "value")


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line: (term)."""
    return spark.read.text(path).select(list_entry(F.col("value")).alias("term")).distinct()


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their 0-based position, over all splits of the file.

    A line's position is its place inside its split plus the lines of the
    splits before; only one row per split meets in a single task.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    splits = lines.groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file", "_start")) - F.col("_n")
    splits = splits.select("_file", "_start", (before - F.col("_first")).alias("_shift"))
    placed = lines.join(F.broadcast(splits), ["_file", "_start"])
    return placed.select("value", (F.col("_row") + F.col("_shift")).alias("position"))


def read_dictionary(spark: SparkSession, path: str, name: str, id_name: str, skip_first: bool = False) -> DataFrame:
    """One entry per line, its id the line number from 1; a repeated entry keeps its last id.

    ``skip_first`` leaves out the first line and counts from the second, which
    is how the published result matrices were numbered.
    """
    lines = _numbered_lines(spark, path)
    position = F.col("position") + (0 if skip_first else 1)
    entries = lines.select(list_entry(F.col("value")).alias(name), position.alias(id_name)).filter(F.col(id_name) > 0)
    return entries.groupBy(name).agg(F.max(id_name).alias(id_name))


def read_term_dictionary(spark: SparkSession, path: str, skip_first: bool = False) -> DataFrame:
    return read_dictionary(spark, path, "term", "term_id", skip_first)


def read_doc_dictionary(spark: SparkSession, path: str, skip_first: bool = False) -> DataFrame:
    """Names are lower-cased here but not in ``read_corpus``: a folder with capitals has no match."""
    return read_dictionary(spark, path, "doc_name", "doc_id", skip_first)


def _fields(spark: SparkSession, path: str, **types: str) -> DataFrame:
    """Columns of a file whose fields are separated by any white space."""
    parts = F.split("value", r"\s+")
    lines = spark.read.text(path)
    size_shuffles(lines)
    return lines.select(*[parts[i].cast(t).alias(c) for i, (c, t) in enumerate(types.items())])


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """``term doc freq``."""
    return _fields(spark, path, term_id="bigint", doc_id="bigint", freq="bigint")


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """``term doc weight``."""
    return _fields(spark, path, term_id="bigint", doc_id="bigint", weight="double")


def read_pairs(
    spark: SparkSession, path: str, key: str, value: str, value_type: str = "bigint", key_type: str = "bigint"
) -> DataFrame:
    """Key and value: totals, idf, document lengths, classes, loss."""
    return _fields(spark, path, **{key: key_type, value: value_type})


def _vector_lines(spark: SparkSession, path: str, separator: str, key: str, key_type: str) -> DataFrame:
    parts = F.split("value", separator)
    lines = spark.read.text(path)
    size_shuffles(lines)
    lines = lines.select(parts[0].cast(key_type).alias(key), vector_entries(parts[1]).alias("vector"))
    return lines.select(key, F.inline("vector"))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``doc|t:w,t:w,...`` as weights; zero entries are kept, so zero documents stay."""
    return _vector_lines(spark, path, r"\|", "doc_id", "bigint").select("term_id", "doc_id", "weight")


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``cluster<white space>t:w,t:w,...`` as (cluster, term_id, weight)."""
    return _vector_lines(spark, path, r"\s+", "cluster", "int")


def read_top_terms(spark: SparkSession, path: str) -> DataFrame:
    """``cluster<white space>t,t,...,`` as (cluster, rank, term_id)."""
    parts = F.split("value", r"\s+")
    lists = spark.read.text(path).select(
        parts[0].cast("int").alias("cluster"), F.split(F.rtrim(parts[1], F.lit(",")), ",").alias("terms")
    )
    ranked = lists.select("cluster", F.posexplode("terms").alias("place", "term_id"))
    return ranked.select("cluster", (F.col("place") + 1).alias("rank"), F.col("term_id").cast("bigint"))
