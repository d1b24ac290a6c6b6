"""Helpers that keep joins and stage results safe on a large cluster."""

from __future__ import annotations

import math
import uuid
import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured size stays below this many bytes
# (session setting spark.corpusflow.broadcastBytes).
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is split over several tasks
# (session setting spark.corpusflow.hotRows).
HOT_ROWS = 4_000_000
# A list of hot keys may be broadcast up to this size (spark.corpusflow.hotListBytes).
# It has at most one entry per HOT_ROWS rows: some 50 MB for the counts of 100 TB of text.
HOT_LIST_BYTES = 256 * 1024 * 1024
# Input bytes per shuffle partition: the counts of a text take about its own size.
SHUFFLE_BYTES = 128 * 1024 * 1024
# Rows in a batch that goes to Python or comes from there, where rows hold whole texts.
ARROW_ROWS = 1000
# A stored table may be read this many times, each time against a part of a lookup that is too large for one broadcast.
LOOKUP_READS = 12
# Rows of a table of marks, 4 KB (32,768 bits) each: 8 MB, whatever it marks.
MARK_ROWS = 2048


def _setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"spark.corpusflow.{name}", str(default)))


def _work_folder(spark: SparkSession) -> str:
    """The folder for the tables this application writes between stages.

    It lies in ``spark.checkpoint.dir`` (or the context's checkpoint folder),
    which all executors share; where neither is set, below the session's
    warehouse, which a cluster shares too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local[") and "://" not in base.removeprefix("file:"):
            warnings.warn(f"spark.checkpoint.dir is not set: tables go to {base}, which all executors must share", stacklevel=3)
    return f"{base.rstrip('/')}/corpusflow-{spark.sparkContext.applicationId}"


def table_path(spark: SparkSession) -> str:
    """A fresh path for one written table."""
    return f"{_work_folder(spark)}/table_{uuid.uuid4().hex}"


def remove_written(spark: SparkSession) -> None:
    """Delete every table this application has written between stages; call it last."""
    _delete(spark, _work_folder(spark))


def written(df: DataFrame, **metrics: Column) -> DataFrame:
    """``df`` as a written table: computed once, lineage cut, safe from executor loss.

    ``metrics`` are aggregates taken while the rows are written; the table has
    their values as ``observed``, which spares a job over it.
    """
    path = table_path(df.sparkSession)
    if metrics:
        seen = Observation()
        df.observe(seen, *[m.alias(name) for name, m in metrics.items()]).write.parquet(path)
    else:
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path  # results of operations on the table do not have this
    table.observed = dict(seen.get) if metrics else {}
    return table


def written_lookup(df: DataFrame) -> DataFrame:
    """``written`` for a lookup (flat columns): its rows and bytes are taken on the way, for ``fits_broadcast``."""
    return written(df, rows=F.count(F.lit(1)), bytes=table_bytes(df))


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is itself a result of ``written``: reading it again costs a scan, not its plan."""
    return hasattr(df, "written_path")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_written(table: DataFrame) -> None:
    """Delete a result of ``written`` that no later step reads, not even through a plan made of it."""
    _delete(table.sparkSession, table.written_path)


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer tasks than the cluster has cores.

    A large input already has more splits than cores and is left as it is, so
    this never shuffles big data.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def scan_bytes(scan: DataFrame) -> int:
    """Bytes of the files of a table just read, from the listing that reading it has made."""
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def size_shuffles(scan: DataFrame) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to suit the files of ``scan``; return the setting.

    A session setting that is higher stays. AQE joins partitions that turn out small.
    """
    spark, size = scan.sparkSession, scan_bytes(scan)
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SHUFFLE_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def bound_batches(spark: SparkSession) -> None:
    """Lower ``spark.sql.execution.arrow.maxRecordsPerBatch`` to ARROW_ROWS.

    Of whole texts a batch of 10,000 rows, Spark's default, takes tens of MB several times over,
    in the executor as in its Python workers, which keep the memory. A session setting that is lower stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= ARROW_ROWS:  # 0 and less: no bound
        spark.conf.set(name, str(ARROW_ROWS))


def _column_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        raise TypeError(f"column {field.name} is nested: its size is not measured, flatten it first")
    return F.lit(8)


def fits_broadcast(df: DataFrame) -> bool:
    """Measure ``df`` (flat columns only) and compare it with the broadcast limit."""
    size = getattr(df, "observed", {}).get("bytes")
    return below_broadcast_limit(df.sparkSession, df.agg(table_bytes(df)).first()[0] if size is None else size)


def table_bytes(df: DataFrame) -> Column:
    """Aggregate: the size of all rows of ``df``, with some bytes for each row."""
    row_bytes = sum((_column_bytes(f) for f in df.schema.fields), F.lit(16))
    return F.coalesce(F.sum(row_bytes.cast("bigint")), F.lit(0))


def below_broadcast_limit(spark: SparkSession, size: int) -> bool:
    return size <= _setting(spark, "broadcastBytes", BROADCAST_BYTES)


def hot_keys(rows: DataFrame, key: list[str]) -> DataFrame | None:
    """Keys that hold too many rows for one task, with the number of parts to cut each into.

    The limit does not grow with the table: any key above it is cut. Returns
    None when the whole table is below the limit. ``rows`` should be a written
    table, for which the count reads footers only.
    """
    total = rows.count()
    limit = _setting(rows.sparkSession, "hotRows", HOT_ROWS)
    if total <= limit:
        return None
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    return counts.select(*key, F.ceil(F.col("_n") / limit).cast("int").alias("_parts"))


def with_parts(rows: DataFrame, hot: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``_parts`` of their key, null for keys that are not hot.

    ``hot`` is a written result of ``hot_keys``. Its size is checked: a list
    beyond ``hotListBytes`` is joined by shuffle, where AQE splits large keys.
    """
    size = getattr(hot, "observed", {}).get("bytes")
    size = hot.agg(table_bytes(hot)).first()[0] if size is None else size
    small = size <= _setting(rows.sparkSession, "hotListBytes", HOT_LIST_BYTES)
    return rows.join(F.broadcast(hot) if small else hot, key, "left")


def salted_join(rows: DataFrame, lookup: DataFrame, key: list[str], how: str, distinct: bool = False) -> DataFrame:
    """Shuffle join in which the rows of a hot key are dealt out over several tasks.

    ``lookup`` has one row per key; only its rows for hot keys are repeated. A
    row's part comes from a hash of its content and its place in ``rows``, a
    written table: equal rows are dealt out too, and a task that is run again
    deals its rows the same way. ``rows`` is read three times.

    ``distinct`` drops repeated rows in the same pass: the place is left out of
    the hash, so that equal rows meet where they are joined.
    """
    hot = hot_keys(rows, key)
    if hot is None:
        joined = rows.join(lookup, key, how)
        return joined.distinct() if distinct else joined
    hot = written_lookup(hot)
    parts = F.coalesce("_parts", F.lit(1))
    placed = rows if distinct else rows.select("*", F.col("_metadata.row_index").alias("_row"))
    dealt = (
        with_parts(placed, hot, key)
        .withColumn("_part", F.pmod(F.xxhash64(*placed.columns), parts).cast("int"))
        .drop("_parts", "_row")
    )
    copies = (
        with_parts(lookup, hot, key)
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    joined = dealt.join(copies, [*key, "_part"], how)
    # the join has put equal rows of a part together: this moves nothing
    return (joined.distinct() if distinct else joined).drop("_part")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str | list[str],
    how: str = "inner",
    stored: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Join ``rows`` with ``lookup``, which has at most one row per key.

    A lookup below the broadcast limit is broadcast, so ``rows`` is not
    shuffled; a larger one goes through ``salted_join``. The lookup is
    measured, so pass a file-backed or written table. ``stored`` says that
    ``rows`` is one too and need not be written for the salted join; ``small``
    is the result of ``fits_broadcast`` where the caller has it already.
    """
    key = [key] if isinstance(key, str) else key
    if fits_broadcast(lookup) if small is None else small:
        return rows.join(F.broadcast(lookup), key, how)
    return salted_join(rows if stored or is_stored(rows) else written(rows), lookup, key, how)


def in_parts(rows: DataFrame, lookup: DataFrame, key: str | list[str], how: str = "inner") -> list[DataFrame] | None:
    """``rows`` joined with a lookup that is too large for one broadcast: one result per part of the keys.

    A part of the lookup is below the broadcast limit, so ``rows`` does not move but is read
    once for each part; it should be a written table. The results together are the join.
    They are to be written one after the other, so that tasks hold one part at a time.
    None if that takes more than ``LOOKUP_READS`` reads: then a shuffle costs less.
    """
    key = [key] if isinstance(key, str) else key
    if any(rows.schema[k].dataType != lookup.schema[k].dataType for k in key):
        return None  # equal keys of different types have different hashes
    limit = _setting(rows.sparkSession, "broadcastBytes", BROADCAST_BYTES)
    size = getattr(lookup, "observed", {}).get("bytes")
    size = lookup.agg(table_bytes(lookup)).first()[0] if size is None else size
    if 1.1 * size > limit * LOOKUP_READS:  # parts differ in size by some percent
        return None
    parts = max(1, math.ceil(1.1 * size / limit))
    lookup = lookup if is_stored(lookup) else written(lookup)
    part = F.pmod(F.xxhash64(*key), F.lit(parts))
    return [rows.filter(part == i).join(F.broadcast(lookup.filter(part == i)), key, how) for i in range(parts)]


def written_parts(parts: list[DataFrame]) -> DataFrame:
    """Results of ``in_parts`` as one written table, computed one after the other."""
    spark = parts[0].sparkSession
    path = table_path(spark)
    for part in parts:
        part.write.mode("append").parquet(path)
    table = spark.read.schema(parts[0].schema).parquet(path)
    table.written_path, table.observed = path, {}
    return table


def stored_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner", stored: bool = True) -> DataFrame:
    """``lookup_join`` of rows that are cheap to read again: a lookup beyond a broadcast meets them ``in_parts``."""
    if fits_broadcast(lookup):
        return lookup_join(rows, lookup, key, how, small=True)
    parts = in_parts(rows, lookup, key, how)
    return written_parts(parts) if parts else lookup_join(rows, lookup, key, how, stored=stored, small=False)


def _mark(columns: list[Column]) -> tuple[Column, Column]:
    """Row and bit of the marks of a key."""
    key = F.xxhash64(*columns)
    return F.pmod(key, F.lit(MARK_ROWS)), F.pmod(F.shiftright(key, 16), F.lit(32768)).cast("int")


def marks(keys: DataFrame, *columns: str) -> DataFrame:
    """Written table of marks for all keys: bits at their hashes, at most 8 MB.

    It tells most rows without a partner before a shuffle. At very many keys
    more rows pass; the join behind it decides.
    """
    row, bit = _mark([F.col(c) for c in columns])
    bits = keys.select(row.alias("_mark_row"), bit.alias("_bit")).groupBy("_mark_row")
    bits = bits.agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    word = lambda i: F.conv(F.hex(F.substring("_bits", i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    return written(bits.select("_mark_row", F.transform(F.sequence(F.lit(0), F.lit(1023)), word).alias("_marks")))


def marked(rows: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The rows whose key has a mark: all that ``marks`` has seen, and few others."""
    row, bit = _mark([F.col(c) for c in columns])
    # a byte has its lowest bit first, a word of four bytes its first byte on top
    is_set = F.expr("shiftright(get(_marks, _bit div 32), 8 * (3 - _bit div 8 % 4) + _bit % 8) & 1 = 1")
    found = rows.select("*", row.alias("_mark_row"), bit.alias("_bit")).join(F.broadcast(table), "_mark_row")
    return found.filter(is_set).select(*rows.columns)


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... in the order of the unique column ``order``.

    The rows are sorted over all tasks and written; a row's number is its place
    in its file plus the rows of the files before. Only one row per file meets
    in a single task.
    """
    stored = written_lookup(df.orderBy(order))
    rows, size = stored.observed["rows"], stored.observed["bytes"]
    stored = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = stored.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    # a task may write several files: they share the part number and differ in the sequence number
    place = [F.regexp_extract("_file", pattern, 1).cast("int") for pattern in (r"^part-(\d+)", r"-c(\d+)\.")]
    in_order = Window.orderBy(*place, "_file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = sizes.select("_file", (F.sum("_n").over(in_order) - F.col("_n")).alias("_before"))
    found = stored.join(F.broadcast(before), "_file").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(name)
    )
    found.observed = {"rows": rows, "bytes": size + 8 * rows}
    return found
