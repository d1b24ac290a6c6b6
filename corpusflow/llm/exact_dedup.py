"""Exact deduplication by progressive refinement, in DataFrame operations only.

Documents are told apart in three steps, each applied only to what the step
before left together: by length, by a hash of the first characters, by a hash
of the whole text. Numbers leave the scan, texts never do: no step shuffles a
text. Which texts need their full hash is known to every task through a bitmap
of fixed size that marks the surviving (length, prefix) groups. A false mark
costs one more hash and cannot change the result.

Cases: a null text counts as empty, and empty texts are equal to each other. For
``exact_groups`` a repeated row (same id, same text) is one more member of its
group and stays or goes with its id; ``deduplicate`` keeps one of them. An empty table gives an empty result. Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import drop_written, lookup_join, written, written_lookup
from .common import addressed, fresh, normalised, text_or_empty

#: Code points of the text that the prefix hash reads.
PREFIX_CHARS = 128
#: Rows of the bitmap, 4 KB (32,768 bits) each: 8 MB, whatever the input. At
#: more than some 30 million groups more texts are hashed in full than need be.
BITMAP_ROWS = 2048


def _bit(hash_: Column) -> tuple[Column, Column]:
    """Row and bit of the bitmap for a hash."""
    return F.pmod(hash_, F.lit(BITMAP_ROWS)), F.pmod(F.shiftright(hash_, 16), F.lit(32768)).cast("int")


#: Whether the bit ``_bit`` of the bitmap row ``_bits`` is set.
_BYTE = "cast(conv(hex(substring(_bits, _bit div 8 + 1, 1)), 16, 10) AS int)"
_MARKED = f"coalesce(shiftright({_BYTE}, _bit % 8) & 1, 0) = 1"


def bitmap_of(keys: DataFrame, hash_: Column) -> DataFrame:
    """(_row, _bits): bits set for all hashes; at most BITMAP_ROWS rows of 4 KB."""
    row, bit = _bit(hash_)
    return keys.select(row.alias("_row"), bit.alias("_bit")).groupBy("_row").agg(
        F.bitmap_construct_agg("_bit").alias("_bits")
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id, keep_id, group_size, kept), one row per row of ``docs``.

    Texts are equal when they agree after each run of white space has become
    one space. The smallest id of a group is its ``keep_id``; a row is kept if
    it has that id. ``digest`` adds ``text_sha256`` of the normalised text for
    every row, which reads all texts in full.
    """
    text = normalised(text_or_empty(text_col))
    measured = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("_text")
    ).select(
        "doc_id",
        F.octet_length("_text").cast("bigint").alias("_length"),
        F.xxhash64(F.substring("_text", 1, PREFIX_CHARS)).alias("_prefix"),
        "_text",
    )

    # length: a length held by one row needs no further look
    sizes = written(measured.select("_length", "_prefix"))
    common = sizes.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # prefix hash: (length, prefix) pairs that several rows share, rows counted before they are joined
    pairs = sizes.groupBy("_length", "_prefix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = pairs.join(common.select("_length"), "_length", "left_semi")
    key = F.xxhash64("_length", "_prefix")
    bits = written(bitmap_of(pairs, key))

    # full hash: only for rows whose pair is marked, or for all if the digest is asked for
    row, bit = _bit(key)
    rows = measured.select("*", row.alias("_row"), bit.alias("_bit")).join(F.broadcast(bits), "_row", "left")
    full, marked = F.sha2("_text", 256), F.expr(_MARKED)
    if digest:
        rows = rows.select("doc_id", full.alias("text_sha256"), marked.alias("_marked"))
    else:
        rows = rows.select("doc_id", F.when(marked, full).alias("text_sha256"), marked.alias("_marked"))
    rows = written(rows)

    alone = F.lit(1).cast("bigint")
    single = rows.filter("NOT _marked").select(
        "doc_id", F.col("doc_id").alias("keep_id"), alone.alias("group_size"), "text_sha256"
    )
    marked_rows = rows.filter("_marked")
    groups = marked_rows.groupBy("text_sha256").agg(F.min("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
    groups = written(groups.filter("_size > 1"))
    # a group of copies may hold a large part of all rows: AQE splits it, as one row stands against it
    copies = marked_rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.coalesce("_keep", "doc_id").alias("keep_id"),
        F.coalesce("_size", alone).alias("group_size"),
        "text_sha256",
    )
    found = single.unionByName(copies)
    return found.select(
        F.col("doc_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        *(["text_sha256"] if digest else []),
    )


def _copies(docs: DataFrame, row: str, id_col: str, text_col: str) -> DataFrame:
    """(row): the rows that go. Only texts that share length and prefix with another are normalised twice and hashed."""
    text = normalised(text_or_empty(text_col))
    keys = docs.select(row, text.alias("_text")).select(
        row,
        F.octet_length("_text").cast("bigint").alias("_length"),
        F.xxhash64(F.substring("_text", 1, PREFIX_CHARS)).alias("_prefix"),
    )
    keys = written(keys)
    # a length held by one row needs no further look; rows are counted before they are joined
    common = keys.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = keys.groupBy("_length", "_prefix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = written_lookup(pairs.join(common.select("_length"), "_length", "left_semi").select("_length", "_prefix"))
    surviving = lookup_join(keys, pairs, ["_length", "_prefix"], "left_semi", stored=True)
    bits = written(bitmap_of(surviving, F.xxhash64(row)))
    drop_written(keys)

    at, bit = _bit(F.xxhash64(row))
    rows = docs.select(row, F.col(id_col).alias("_id"), F.col(text_col).alias("_given"), at.alias("_row"), bit.alias("_bit"))
    rows = rows.join(F.broadcast(bits), "_row").filter(F.expr(_MARKED))
    full = F.sha2(normalised(text_or_empty("_given")), 256).alias("_digest")
    full = written(rows.select(row, "_id", full))
    # the smallest id stays, of rows with that id the first; a null id is greater than any
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", row))
    groups = full.groupBy("_digest").agg(first.alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    groups = written_lookup(groups.select("_digest", F.col("_first")[row].alias("_stays")))
    gone = lookup_join(full, groups, "_digest", stored=True)
    return written_lookup(gone.filter(F.col(row) != F.col("_stays")).select(row))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts.

    That is the row with the smallest id, of several such rows one. Rows are told
    apart by their place, so an id may stand for several texts, and a text may
    come with one id several times. Only the numbers of the rows that go meet the
    table; they are broadcast if their measured size allows it.
    """
    row = fresh(docs, "_number")
    placed = addressed(docs, row)
    gone = _copies(placed, row, id_col, text_col)
    return lookup_join(placed, gone, row, "left_anti", stored=False).select(*[F.col(f"`{c}`") for c in docs.columns])
