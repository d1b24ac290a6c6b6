"""Tables laid out by document: later joins and sums by document move nothing.

A layout is a table bucketed by document. A document with too many rows for one
task is cut into parts by a hash of its terms; the column ``part`` is 0 for all
other documents. As a document of a layout without cut ones is in one bucket, its
length, its sums and its choice of a cluster are found where its rows are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .scale import (
    HOT_ROWS,
    _setting,
    fits_broadcast,
    hot_keys,
    in_parts,
    lookup_join,
    scan_bytes,
    table_path,
    with_parts,
    written,
    written_lookup,
)

# Rows per bucket of a laid-out table, around 200 MB. A task adds up the
# terms of its bucket before it shuffles, so large buckets shuffle less.
BUCKET_ROWS = 16_000_000
# Bytes of text that stand for one row when documents are cut before they are counted.
TEXT_BYTES_PER_ROW = 16
# Text per bucket where tokens are counted: some 3 million counts, whose hash table takes 300 MB.
BUCKET_TEXT_BYTES = 32 * 1024 * 1024
# Files that a task writes at the same time before it sorts its rows by bucket.
OPEN_FILES = 4


@dataclass
class ByDocument:
    """Rows (term, doc_id, ..., part) partitioned by (doc_id, part); ``hot`` lists the cut documents, if there are any.

    ``stored`` says that ``rows`` are a written table, ``ready`` that they are made of one row by
    row, next to no work to read again; other rows are written before they are read several times.
    """

    rows: DataFrame
    buckets: int
    hot: DataFrame | None = None
    stored: bool = False
    ready: bool = False

    def having(self, rows: DataFrame, stored: bool = False, ready: bool = False) -> ByDocument:
        """The same layout with other rows that did not move."""
        return replace(self, rows=rows, stored=stored, ready=ready)

    def sums(self, *sums: Column) -> DataFrame:
        """(doc_id, part, ...) with a document's sums in each of its parts. Moves only sums of cut documents.

        The sums need names and must be sums: those of the parts are added up.
        """
        inside = self.rows.groupBy("doc_id", "part").agg(*sums)
        if self.hot is None:
            return inside
        names = [c for c in inside.columns if c not in ("doc_id", "part")]
        cut = with_parts(inside, self.hot, ["doc_id"])
        whole = cut.filter("_parts IS NULL").drop("_parts")
        summed = cut.filter("_parts IS NOT NULL").groupBy("doc_id", "_parts").agg(*[F.sum(n).alias(n) for n in names])
        spread = summed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        return whole.unionByName(spread.select(*whole.columns))

    def join_sums(self, *sums: Column) -> DataFrame:
        """The rows with their document's sums: bucket by bucket."""
        # hashing one row per document spares sorting the rows
        return self.rows.join(self.sums(*sums).hint("shuffle_hash"), ["doc_id", "part"])

    def written_sums(self, *sums: Column) -> DataFrame:
        """``sums`` as a written table with the same layout."""
        return bucketed(self.sums(*sums), self.buckets, "doc_id", moved=self.hot is None)

    def documents(self) -> DataFrame:
        """(doc_id): each document once."""
        inside = self.rows.groupBy("doc_id", "part").agg(F.lit(1).alias("_one")).select("doc_id")
        return inside if self.hot is None else inside.distinct()


def bucket_number(spark: SparkSession, rows: int | None = None, text_bytes: int = 0) -> int:
    """Buckets for a table of so many rows, or for what shuffles are sized for and the counts of so much text."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions")) if rows is None else math.ceil(rows / BUCKET_ROWS)
    wanted = max(wanted, math.ceil(text_bytes / _setting(spark, "bucketTextBytes", BUCKET_TEXT_BYTES)))
    # beyond Spark's own limit buckets grow, and with them the tasks
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(spark.sparkContext.defaultParallelism, wanted), most)


@contextmanager
def _files_at_once(spark: SparkSession) -> Iterator[None]:
    """Tasks write their buckets as the rows come.

    Else Spark sorts, and spills, all rows of a task by their bucket, although a task has one
    bucket only. A task with more buckets than open files still sorts, so a layout that is read
    for another one is read bucket by bucket, not with many buckets in a task.
    """
    writers, scans = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = {name: spark.conf.get(name) for name in (writers, scans)}
    spark.conf.set(writers, str(max(OPEN_FILES, int(before[writers]))))
    spark.conf.set(scans, "false")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def bucketed(rows: DataFrame | list[DataFrame], buckets: int, key: str, moved: bool = False) -> DataFrame:
    """``rows`` as a written table bucketed by ``key`` and ``part``; ``moved`` rows are partitioned that way already.

    Several tables of rows are written one after the other.
    """
    tables = rows if isinstance(rows, list) else [rows]
    spark = tables[0].sparkSession
    path = table_path(spark)
    name = path.rsplit("/", 1)[1]
    with _files_at_once(spark):
        for table in tables:
            # one task per bucket, so one file per bucket
            dealt = table if moved else table.repartition(buckets, key, "part")
            dealt.write.mode("append").bucketBy(buckets, key, "part").option("path", path).saveAsTable(name)
    laid_out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files lie outside the warehouse
    return laid_out


def parted(rows: DataFrame, hot: DataFrame | None, key: str, other: str) -> DataFrame:
    """``rows`` with ``part``: rows of hot keys are cut by a hash of ``other``."""
    if hot is None:
        # 0, but no constant: grouping keys lose constants, and rows dealt out by one would be dealt out again
        return rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(1)).cast("int"))
    part = F.pmod(F.xxhash64(other), F.coalesce("_parts", F.lit(1))).cast("int")
    return with_parts(rows, hot, [key]).withColumn("part", part).drop("_parts")


def by_document(rows: DataFrame, stored: DataFrame | None = None, term: str = "term_id") -> ByDocument:
    """``rows`` (term, doc_id, ...) as a written layout.

    ``stored``, a written table with the same terms and documents, spares
    writing the rows twice.
    """
    if stored is None:
        rows = stored = written(rows)
    buckets = bucket_number(rows.sparkSession, stored.count())
    hot = hot_keys(stored, ["doc_id"])
    hot = None if hot is None else written_lookup(hot)
    return ByDocument(bucketed(parted(rows, hot, "doc_id", term), buckets, "doc_id"), buckets, hot, stored=True)


def store(layout: ByDocument) -> ByDocument:
    """The layout with its rows written, if they are not at hand; they do not move."""
    return layout if layout.stored or layout.ready else layout.having(bucketed(layout.rows, layout.buckets, "doc_id", moved=True), stored=True)


def hot_documents(lines: DataFrame, text: str) -> tuple[DataFrame | None, int]:
    """Documents with too much text for one task, as ``hot_keys`` lists them, and the bytes of all text.

    ``lines`` has doc_id and the text, which is measured, not split. A corpus whose
    files are far smaller than such a document is not looked at: its text counts as 0.
    """
    limit = _setting(lines.sparkSession, "hotRows", HOT_ROWS) * TEXT_BYTES_PER_ROW
    if 8 * scan_bytes(lines) <= limit:
        return None, 0
    seen = Observation()
    sizes = lines.groupBy("doc_id").agg(F.sum(F.octet_length(text)).alias("_n"))
    sizes = sizes.observe(seen, F.sum("_n").alias("bytes")).filter(F.col("_n") > limit)
    hot = written_lookup(sizes.select("doc_id", F.ceil(F.col("_n") / limit).cast("int").alias("_parts")))
    return hot if hot.observed["rows"] else None, seen.get["bytes"] or 0


def dealt_lines(lines: DataFrame, text_bytes: int = 0) -> DataFrame:
    """Lines (doc_id, text) dealt out by document, without cut ones: their tokens are where ``counted`` wants them."""
    buckets = bucket_number(lines.sparkSession, text_bytes=text_bytes)
    return parted(lines, None, "doc_id", "").repartition(buckets, "doc_id", "part")


def counted(tokens: DataFrame, term: str, hot: DataFrame | None, moved: bool = False, text_bytes: int = 0) -> ByDocument:
    """Occurrences of each term in each document, (term, doc_id, freq, part), laid out by the shuffle that counts them.

    Words of one document seldom repeat, so counting before the shuffle would
    save less than a second shuffle costs. ``moved`` tokens come from ``dealt_lines``,
    with the same ``text_bytes``: buckets do not grow with the corpus, so neither
    do the counts that a task holds.
    """
    buckets = bucket_number(tokens.sparkSession, text_bytes=text_bytes)
    rows = tokens if moved else parted(tokens.select(term, "doc_id"), hot, "doc_id", term).repartition(buckets, "doc_id", "part")
    counts = rows.groupBy(term, "doc_id", "part").agg(F.count(F.lit(1)).alias("freq"))
    counts = counts.select(term, "doc_id", "freq", "part")
    return ByDocument(bucketed(counts, buckets, "doc_id", moved=True), buckets, hot, stored=True)


def look_up(
    layout: ByDocument,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    small: bool | None = None,
    columns: list[str] | None = None,
) -> ByDocument:
    """The layout joined with a lookup by term; ``columns``, if given, are kept.

    A lookup that can be broadcast is joined in place, and so is a larger one, part by part
    into a written table. Only a lookup of too many parts lets the rows move, once by term and once back.
    """
    small = fits_broadcast(lookup) if small is None else small
    if small:
        joined = layout.rows.join(F.broadcast(lookup), key, how)
        return layout.having(joined.select(*columns) if columns else joined)
    parts = in_parts(layout.rows, lookup, key, how)
    joined = parts or [lookup_join(layout.rows, lookup, key, how, small=False)]
    kept = [rows.select(*columns) if columns else rows for rows in joined]
    return layout.having(bucketed(kept, layout.buckets, "doc_id", moved=parts is not None), stored=True)
