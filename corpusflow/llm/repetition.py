"""Quality rules on repetition, from suffix arrays of words with their common prefixes.

The suffixes of all documents of a block are sorted together, documents apart:
ranks by the first 1, 2, 4, ... words are made until no two suffixes of a
document share one, and all ranks are kept. Neighbours in the suffix array that
agree for at least ``min_words`` words are in a common LCP interval; a suffix's
innermost interval, the greater of the common prefixes with its two
neighbours, is the longest repeated substring that begins there. The spans of
these repeats are united per document. A document is rejected if those of
``LONG_WORDS`` words or more cover more than ``max_covered`` of its words or if
one repeat is longer than ``max_longest`` words.

Cases: a null text has no words. An empty or very short text fails the base
rule. Repeated rows are judged row by row; repetition is looked for within a
text only. An empty table gives an empty result. ``reject`` keeps all columns,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, fresh, text_blocks

#: Fixed values of the contract: word pattern, symbols, window, base limits.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 8
BASE_WORDS, BASE_PERCENT = 20, 30

#: Limits of the method: part of the words covered by long repeats, words in a long repeat, words in any repeat.
#: Repeats of 20 words do not occur in ordinary texts; phrases of 8 to 13 words do.
MAX_COVERED = 0.20
LONG_WORDS = 20
MAX_LONGEST = 100
#: Characters of text in a block. All ranks of its words are held, 4 bytes for each doubling.
BLOCK_CHARS = 1_000_000


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int32)


def suffix_ranks(words: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by document and their first 1, 2, 4, ... words.

    ``words`` are numbers from 0; ``doc`` rises. The last ranks are unique.
    The end of a document comes before every word.
    """
    n = len(words)
    ranks = [_dense(doc * np.int64(words.max() + 2) + words + 1)] if n else [np.empty(0, np.int32)]
    reach = 1
    while n and ranks[-1].max() + 1 < n:
        now = ranks[-1]
        behind = np.zeros(n, np.int64)
        same = doc[:-reach] == doc[reach:] if reach < n else np.empty(0, bool)
        behind[: n - reach][same] = now[reach:][same] + 1
        ranks.append(_dense(now * np.int64(n + 1) + behind))
        reach *= 2
    return ranks


def neighbour_prefixes(ranks: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and for each of its entries the words in common with the entry before."""
    order = np.argsort(ranks[-1], kind="stable")
    n = len(order)
    common = np.zeros(n, np.int64)
    if n < 2:
        return order, common
    left, right = order[:-1].copy(), order[1:].copy()
    total = np.zeros(n - 1, np.int64)
    alive = doc[left] == doc[right]
    ends = np.searchsorted(doc, doc, side="right")  # first place behind the document
    for level in range(len(ranks) - 1, -1, -1):
        reach = 1 << level
        inside = alive & (left + reach <= ends[order[:-1]]) & (right + reach <= ends[order[1:]])
        at = np.flatnonzero(inside)
        at = at[ranks[level][left[at]] == ranks[level][right[at]]]
        left[at] += reach
        right[at] += reach
        total[at] += reach
    common[1:] = total
    return order, common


def repeats(
    words: np.ndarray, doc: np.ndarray, n_docs: int, min_words: int, long_words: int = LONG_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: words covered by repeats of ``min_words`` words or more, by those of ``long_words``, words of the longest."""
    n = len(words)
    longest = np.zeros(n_docs, np.int64)
    if not n:
        return longest, longest.copy(), longest.copy()
    order, common = neighbour_prefixes(suffix_ranks(words, doc), doc)
    innermost = np.maximum(common, np.append(common[1:], 0))

    def covered(least: int) -> np.ndarray:
        length = np.zeros(n, np.int64)
        length[order] = np.where(innermost >= least, innermost, 0)
        if least == min_words:
            np.maximum.at(longest, doc, length)
        begins = np.flatnonzero(length)
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, begins, 1)
        np.add.at(edges, begins + length[begins], -1)
        return np.bincount(doc, weights=np.cumsum(edges)[:n] > 0, minlength=n_docs).astype(np.int64)

    return covered(min_words), covered(long_words), longest


def _measures(texts: list[str], min_words: int) -> dict[str, np.ndarray]:
    numbers: dict[str, int] = {}
    per_text = [[numbers.setdefault(w, len(numbers)) for w in WORD.findall(text)] for text in texts]
    sizes = np.fromiter(map(len, per_text), np.int64, len(per_text))
    words = np.fromiter((w for found in per_text for w in found), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    chars = np.fromiter(map(len, numbers), np.int64, len(numbers))
    covered, long, longest = repeats(words, doc, len(texts), min_words)
    duplicates = []
    for text in texts:
        lines = [line for line in text.split("\n") if WORD.search(line)]
        duplicates.append(len(lines) - len(set(lines)))
    return {
        "n_words": sizes,
        "word_chars": np.bincount(doc, weights=chars[words], minlength=len(texts)).astype(np.int64),
        "n_symbols": np.array([sum(map(text.count, SYMBOLS)) for text in texts], np.int64),
        "n_dup_lines": np.array(duplicates, np.int64),
        "n_repeat_words": covered,
        "n_long_words": long,
        "longest_repeat": longest,
    }


def measure(
    docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_long_words, longest_repeat) of every row."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_long_words", "longest_repeat"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for doc_ids, texts in text_blocks(batches, block_chars, "doc_id", "text"):
            found = _measures(texts, min_words)
            columns = [pa.array(doc_ids, pa.int64()), *(pa.array(found[n]) for n in names)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names])

    rows = docs.select("doc_id", F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{n} bigint" for n in names))


def judge(measured: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Adds ``base_failed`` and ``kept``: the base rule, then the limits of the method."""
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    within = (F.col("n_long_words") <= F.lit(max_covered) * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return measured.select("*", failed.alias("base_failed"), (~failed & within).alias("kept"))


def reject(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The texts are judged where they are read: the verdict is a column made by
    the same task, so rows are neither shuffled nor joined by id.
    """
    min_words = limits.pop("min_words", MIN_WORDS)
    verdict = fresh(docs, "kept")
    covered, longest = limits.get("max_covered", MAX_COVERED), limits.get("max_longest", MAX_LONGEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            # in blocks of bounded size: the order of rows stays
            kept: list[bool] = []
            texts = batch.column(batch.schema.get_field_index(text_col))
            for (block,) in text_blocks([pa.RecordBatch.from_arrays([texts], ["text"])], BLOCK_CHARS, "text"):
                m = _measures(block, min_words)
                n, repeated = m["n_words"], m["n_repeat_words"]
                good = (n >= BASE_WORDS) & (100 * repeated <= BASE_PERCENT * n)
                kept.extend(good & (m["n_long_words"] <= covered * n) & (m["longest_repeat"] <= longest))
            yield batch.append_column(verdict, pa.array(kept, pa.bool_()))

    schema = T.StructType([*docs.schema.fields, T.StructField(verdict, T.BooleanType())])
    return docs.mapInArrow(run, schema).filter(F.col(verdict)).drop(verdict)
