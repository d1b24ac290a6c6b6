"""Best-fit packing of token sequences by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens. Packing needs only how
many pieces there are of each length, at most ``capacity`` numbers at any size
of the corpus, so the plan is made on that histogram: a sequence starts with
the longest piece left; its gap is looked up among the single lengths, the sums
of two and the sums of three lengths that are still available; an exact match
completes the sequence, and the whole combination is used as often as the
counts allow. Where no combination is exact the longest piece that fits goes in
(best fit) and the rest of the gap is looked up again.

The plan is a list of places per length. Pieces are numbered within their
length and take the place of their number. The numbering runs in parts (a hash
of the piece) with one running sum over the parts, so a length that a third of
all pieces have is no single task.

Cases: a null or empty text is one piece, the closing id. Repeated rows are
packed row by row. An empty table gives an empty result. Further columns are
ignored.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import written
from .common import gather, remembered, text_blocks

CAPACITY = 2048
#: Id that closes a document.
END_ID = 0
#: Characters of text that a task encodes at once, and distinct words it remembers.
BLOCK_CHARS = 1_000_000
REMEMBERED_WORDS = 250_000
#: Words of letters that the library sees in one text.
TOGETHER = 256
#: Marks that every word pattern sets apart from a letter before them.
MARKS = ".,;:!?"
#: Pieces that one part of a length numbers, about.
PART_ROWS = 200_000


class WordEncoder:
    """Ids of texts by a ``tokenizers`` file that drops white space between words.

    Words are separated by space and line feed only, other white space is left
    to the library. Words of ASCII characters are told apart in lower case, as
    the library sees them. A word is encoded once and then remembered; when too many
    are, the half that came in the most blocks stays.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        #: Which ids close a word of the library.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for name, i in vocabulary.items() if name.endswith("</w>")]] = True
        self.remembered = remembered
        self.words: dict[str, int] = {"": 0}
        #: Ids of all words, filled up to ``held``; the other arrays have a place for each word. All have room for more.
        self.flat, self.held = np.empty(0, np.uint32), 0
        self.starts, self.lengths, self.used = (np.zeros(1, np.int64) for _ in range(3))  # the empty word
        self.parted: dict[str, bool] = {}

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. The words are split and told apart in Arrow, so Python sees distinct ones only."""
        if len(self.words) > self.remembered:
            self._keep_half()
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        # the library lower-cases what it does not take for a control word
        names = coded.dictionary
        plain = pc.and_(pc.string_is_ascii(names), pc.invert(pc.match_substring(names, "<|")))
        lowered = pc.if_else(plain, pc.ascii_lower(names), names).dictionary_encode()
        distinct = lowered.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.words.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [distinct[i] for i in missing.tolist()]
            self._add(new)
            places[missing] = np.fromiter(map(self.words.__getitem__, new), np.int64, len(new))
        self.used[places] += 1
        of_word = places[lowered.indices.to_numpy()][coded.indices.to_numpy()]
        lengths = self.lengths[of_word]
        ids = gather(self.flat, self.starts[of_word], lengths)
        ends = np.concatenate([[0], np.cumsum(lengths)])[lists.offsets.to_numpy()]
        for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            yield ids[begin:end]

    def _keep_half(self) -> None:
        kept = np.argsort(-self.used[1 : len(self.words)], kind="stable")[: self.remembered // 2] + 1
        kept = np.concatenate([[0], np.sort(kept)])
        names = list(self.words)
        self.words = {names[place]: i for i, place in enumerate(kept)}
        self.flat = gather(self.flat, self.starts[kept], self.lengths[kept])
        self.lengths, self.used = self.lengths[kept], self.used[kept] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.held = len(self.flat)

    def _is_parted(self, letter: str) -> bool:
        """Whether a mark behind this letter is a word of its own: not if the letter normalises into one with a mark."""
        known = self.parted.get(letter)
        if known is None:
            known = letter.isalpha() and self.library.normalizer.normalize_str(letter).isalpha()
            self.parted[letter] = known
        return known

    def _add(self, new: list[str]) -> None:
        """Ids of new words; a word and the mark behind it are encoded apart: many words differ in the mark only."""
        split = {w for w in new if w[-1] in MARKS and len(w) > 1 and self._is_parted(w[-2])}
        parts = dict.fromkeys(chain.from_iterable((w[:-1], w[-1]) if w in split else (w,) for w in new))
        parts = [w for w in parts if w not in self.words]
        whole, rest = [], []
        for w in parts:
            (whole if w.isalpha() else rest).append(w)
        self._append(whole, *self._ids_of_letters(whole))
        self._append(rest, *self._ids_of_each(rest))
        split = [w for w in new if w not in self.words]
        pairs = [self.words[part] for w in split for part in (w[:-1], w[-1])]
        lengths = self.lengths[pairs].reshape(-1, 2).sum(axis=1)
        self._append(split, gather(self.flat, self.starts[pairs], self.lengths[pairs]), lengths)

    def _ids_of_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of words of letters, many in one text: each is one word of the library, too."""
        groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        texts = [" ".join(group) for group in groups]
        flat, lengths = [], []
        for group, text, found in zip(groups, texts, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(group) and ends[-1] + 1 == len(ids) and all(map(self._is_parted, set(text) - {" "})):
                sizes = np.diff(ends, prepend=-1)
            else:  # letters that become more than letters, or that only Python takes for some
                ids, sizes = self._ids_of_each(group)
            flat.append(ids)
            lengths.append(sizes)
        none = np.empty(0, np.uint32), np.empty(0, np.int64)
        return np.concatenate([none[0], *flat]), np.concatenate([none[1], *lengths])

    def _ids_of_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [f.ids for f in self.library.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _append(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        known = len(self.words)
        self.words.update(zip(words, range(known, known + len(words)), strict=True))
        self.starts = _put(self.starts, known, self.held + np.cumsum(lengths) - lengths)
        self.lengths = _put(self.lengths, known, lengths)
        self.used = _put(self.used, known, np.zeros(len(words), np.int64))
        self.flat = _put(self.flat, self.held, ids)
        self.held += len(ids)


def _put(values: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``values`` with ``more`` from ``at`` on; they are copied only when their room is used up, by half at least."""
    if at + len(more) > len(values):
        room = np.empty(max(at + len(more), len(values) * 3 // 2), values.dtype)
        room[:at] = values[:at]
        values = room
    values[at : at + len(more)] = more
    return values


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), with ``ids`` if asked for.

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # words of earlier tasks are remembered
        encoder = remembered(("words", tokenizer), lambda: WordEncoder(tokenizer))
        for doc_ids, texts in text_blocks(batches, BLOCK_CHARS, "doc_id", "text"):
            rows: list[tuple] = []
            for doc_id, ids in zip(doc_ids, encoder.encode(texts), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), part))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            wanted = range(6 if with_ids else 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[i], kinds[i]) for i in wanted], [names[i] for i in wanted]
            )

    return docs.select("doc_id", F.col(text_col).alias("text")).mapInArrow(run, schema)


class ComplementIndex:
    """Which single lengths, sums of two and sums of three are available."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts  # counts[n]: pieces of length n that are left

    def _enough(self, lengths: tuple[int, ...]) -> bool:
        return all(self.counts[n] >= lengths.count(n) for n in set(lengths))

    def single(self, total: int) -> tuple[int, ...] | None:
        return (total,) if self.counts[total] > 0 else None

    def pair(self, total: int, most: int | None = None) -> tuple[int, ...] | None:
        """Two lengths with this sum, the longest first length not above ``most``."""
        top = min(total - 1, most or total - 1)
        least = (total + 1) // 2
        if top < least:
            return None
        left = self.counts[least : top + 1] > 0
        right = self.counts[total - top : total - least + 1][::-1] > 0
        for place in np.flatnonzero(left & right)[::-1]:
            found = (int(least + place), int(total - least - place))
            if self._enough(found):
                return found
        return None

    def triple(self, total: int) -> tuple[int, ...] | None:
        lengths = np.flatnonzero(self.counts[: max(total - 1, 0)] > 0)
        for longest in lengths[::-1]:
            if longest < 1 or 3 * longest < total:
                break
            self.counts[longest] -= 1  # the pair sees what is left
            rest = self.pair(int(total - longest), int(longest))
            self.counts[longest] += 1
            if rest:
                return (int(longest), *rest)
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap)

    def best_fit(self, gap: int) -> int | None:
        fitting = np.flatnonzero(self.counts[1 : gap + 1] > 0)
        return int(fitting[-1]) + 1 if len(fitting) else None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences), until no piece is left."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        counts[length] = count
    index = ComplementIndex(counts)
    made = []
    while (longest := index.best_fit(capacity)) is not None:
        chosen = [longest]
        counts[longest] -= 1
        gap = capacity - longest
        while gap:
            found = index.exact(gap)
            if found is None:
                best = index.best_fit(gap)
                if best is None:
                    break
                found = (best,)
            for length in found:
                counts[length] -= 1
            chosen.extend(found)
            gap -= sum(found)
        more = min(int(counts[n]) // chosen.count(n) for n in set(chosen))
        for length in chosen:
            counts[length] -= more
        made.append((tuple(chosen), more + 1))
    return made


def places(made: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, end number, first sequence, offset): where pieces of a length go by their number."""
    rows, numbered, sequence = [], {}, 0
    for lengths, times in made:
        offset = 0
        for length in lengths:
            first = numbered.get(length, 0)
            rows.append((length, first, first + times, sequence, offset))
            numbered[length] = first + times
            offset += length
        sequence += times
    return rows


def numbered_by_length(found: DataFrame) -> DataFrame:
    """Add ``number``: 0, 1, 2, ... within each length. ``found`` is a written table."""
    parts = max(16, math.ceil(found.count() / PART_ROWS))
    rows = found.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    sizes = rows.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # at most one row per part and length
    so_far = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "_part", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece")
    rows = rows.withColumn("_row", F.row_number().over(within) - 1)
    return rows.join(written(before), ["length", "_part"]).select(
        *found.columns, (F.col("_before") + F.col("_row")).alias("number")
    )


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (pieces) with ``sequence_id`` and ``offset``."""
    found = written(found)
    histogram = {n: c for n, c in found.groupBy("length").count().collect()}  # at most ``capacity`` rows
    spark = found.sparkSession
    schema = "length bigint, first bigint, end bigint, first_sequence bigint, offset bigint"
    # a few places per length: the size depends on the capacity, not on the corpus
    table = F.broadcast(spark.createDataFrame(places(plan(histogram, capacity)), schema))
    rows = numbered_by_length(found).join(table, "length")
    rows = rows.filter((F.col("first") <= F.col("number")) & (F.col("number") < F.col("end")))
    sequence = F.col("first_sequence") + F.col("number") - F.col("first")
    return rows.select(*found.columns, sequence.alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences, from packed pieces with ``ids``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` tokens
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
