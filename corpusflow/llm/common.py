"""Column expressions and small helpers that several operators here share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import size_shuffles, written, written_lookup

#: Fixed value: the white space of the contracts, as a regular-expression class.
SPACE = r"[\x20\x09-\x0D]+"


def text_or_empty(name: str = "text") -> Column:
    """The column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def normalised(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, SPACE, " ")


def read(spark, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """A given table; shuffles are sized for its files."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    size_shuffles(rows)
    return rows.select(*columns) if columns else rows


def addressed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number for every row that stays the same however often it is read: its file and its place there.

    A table that is not read straight from files is written first. The files
    are numbered by their paths, one row for each.
    """
    try:
        place = df.metadataColumn("_metadata")
        df.select(place["row_index"], place["file_path"])
    except AnalysisException:
        df = written(df)
        place = df.metadataColumn("_metadata")
    path, row = fresh(df, "_path"), fresh(df, "_place")
    files = df.select(place["file_path"].alias(path)).distinct()
    number = (F.row_number().over(Window.orderBy(path)) - 1).cast("bigint")
    files = written_lookup(files.select(path, number.alias(name)))
    placed = df.select("*", place["file_path"].alias(path), place["row_index"].alias(row))
    # far fewer files than rows: a path and a number each
    placed = placed.join(F.broadcast(files), path)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.shiftleft(name, 40) + F.col(row)).alias(name))


def fresh(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, starting with ``wanted`` (case does not tell names apart)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_blocks(batches: Iterator, size: int, *columns: str) -> Iterator[tuple]:
    """Gather Arrow batches into blocks of about ``size`` bytes of text: one list per column.

    The last of ``columns`` is the text; null is read as empty. A longer text
    is a block of its own, so memory is bounded by ``size`` and the longest row.
    """
    held: list[list] = [[] for _ in columns]
    total = 0
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in columns]
        for row in zip(*lists, strict=True):
            text = row[-1] or ""
            if total and total + len(text) > size:
                yield tuple(held)
                held, total = [[] for _ in columns], 0
            for column, value in zip(held[:-1], row, strict=False):
                column.append(value)
            held[-1].append(text)
            total += len(text) + 64
    if held[-1]:
        yield tuple(held)


_held: dict = {}


def remembered(key: tuple, make: Callable):
    """What a Python worker keeps from task to task: one thing at a time, made by ``make``."""
    if key not in _held:
        forget()
        _held[key] = make()
    return _held[key]


def forget() -> None:
    """Give back the memory that earlier tasks of this worker have left: workers are used again, by other operators, too."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not on every system
    if trim is not None:
        trim(0)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[s:s+n]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[np.arange(total) + shift]
