"""Vector expressions: dense arrays and the ``t:w,t:w`` text form."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product of two equally long arrays of doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x * x))


def vector_text(entries: Column) -> Column:
    """An array of (term_id, weight) structs as ``t:w,t:w,...``."""
    return F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e.term_id, e.weight)), ",")


def vector_entries(text: Column) -> Column:
    """``t:w,t:w,...`` as an array of (term_id, weight) structs."""

    def entry(item: Column) -> Column:
        pair = F.split(item, ":")
        return F.struct(pair[0].cast("bigint").alias("term_id"), pair[1].cast("double").alias("weight"))

    return F.transform(F.split(text, ","), entry)
