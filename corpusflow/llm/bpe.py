"""Byte-level BPE by merge replay over all words of a slice of the corpus.

The text is cut into words by the vocabulary's pattern. A task replays the
merges over the new distinct words of a slice at once: an inverted index leads from
the rank of each token pair to the places where the pair stands, the ranks are
taken in ascending order, and a merge updates only the places next to it.
Words do not depend on each other, so a corpus can be replayed in slices of
bounded size with the same ids, and no word table has to travel. The ids of a
document are gathered from its words.

Cases: null and empty texts have no ids. Special strings in a text are text.
Repeated rows are encoded row by row. A text longer than a slice is a slice of
its own. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gather, text_blocks

#: Characters of text in a slice.
SLICE_CHARS = 6_000_000
#: Distinct words that a task remembers before it starts anew.
REMEMBERED_WORDS = 700_000
_NONE = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank per line, base64 and decimal."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeReplay:
    """Encodes word lists with one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.first = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}

    def _rank(self, a: int, b: int) -> int:
        """Rank of the token that the pair merges to, or _NONE."""
        found = self.pairs.get((a, b))
        if found is None:
            found = self.pairs[a, b] = self.ranks.get(self.tokens[a] + self.tokens[b], _NONE)
        return found

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        results: list[list[int] | None] = [None] * len(words)
        symbol: list[int] = []
        after: list[int] = []
        before: list[int] = []
        begin: list[tuple[int, int]] = []
        for number, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:  # a word of the vocabulary is one token
                results[number] = [whole]
                continue
            if not word:
                results[number] = []
                continue
            at = len(symbol)
            begin.append((number, at))
            symbol.extend(self.first[b] for b in word)
            before.append(_NONE)
            before.extend(range(at, len(symbol) - 1))
            after.extend(range(at + 1, len(symbol)))
            after.append(_NONE)

        rank_of = self._rank
        index: dict[int, list[int]] = {}
        for at, following in enumerate(after):
            if following >= 0:
                rank = rank_of(symbol[at], symbol[following])
                if rank >= 0:
                    index.setdefault(rank, []).append(at)
        waiting = list(index)
        heapify(waiting)

        def touch(left: int, right: int) -> None:
            rank = rank_of(symbol[left], symbol[right])
            if rank >= 0:
                places = index.get(rank)
                if places is None:
                    index[rank] = [left]
                    heappush(waiting, rank)
                else:
                    places.append(left)

        while waiting:
            rank = heappop(waiting)
            for at in sorted(index.pop(rank)):  # from left to right within a word
                following = after[at]
                if symbol[at] < 0 or following < 0 or rank_of(symbol[at], symbol[following]) != rank:
                    continue  # a merge before has changed this place
                symbol[at] = rank
                symbol[following] = _NONE
                behind = after[at] = after[following]
                if behind >= 0:
                    before[behind] = at
                    touch(at, behind)
                if before[at] >= 0:
                    touch(before[at], at)

        for number, at in begin:
            ids = []
            while at >= 0:
                ids.append(symbol[at])
                at = after[at]
            results[number] = ids
        return results


class SliceEncoder:
    """Ids of the texts of slices; words of earlier slices are remembered up to a bound."""

    def __init__(self, replay: MergeReplay, pattern):
        self.replay, self.pattern = replay, pattern
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.starts = self.lengths = np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.words) > REMEMBERED_WORDS:
            self._forget()
        words, known = self.words, len(self.words)
        per_text = [
            np.fromiter((words.setdefault(w, len(words)) for w in self.pattern.findall(text)), np.int64)
            for text in texts
        ]
        if len(words) > known:
            ids = self.replay.encode([w.encode("utf-8") for w in islice(words, known, None)])
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, flat])
        for chosen in per_text:
            yield gather(self.flat, self.starts[chosen], self.lengths[chosen])


def split_pattern(pattern: str):
    """The word pattern, with white space as the Unicode property and not as Python's own set."""
    import regex

    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, pattern: str) -> SliceEncoder:
    """One for all tasks of a worker: words of earlier tasks are remembered."""
    return SliceEncoder(MergeReplay(read_ranks(vocabulary)), split_pattern(pattern))


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", slice_chars: int = SLICE_CHARS
) -> DataFrame:
    """(doc_id, ids array<int>) of every row.

    ``vocabulary`` is the path of a rank file that every executor can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)
        for doc_ids, texts in text_blocks(batches, slice_chars, "doc_id", "text"):
            ids = pa.array(list(encoder.encode(texts)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), ids], ["doc_id", "ids"])

    return docs.select("doc_id", F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


class Decoder:
    """Bytes of id arrays, gathered from one table of token bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.starts[ids], self.lengths[ids]).tobytes()


def digests(
    docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", slice_chars: int = SLICE_CHARS
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, decode the ids again, and digest both."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)
        decoder = Decoder(encoder.replay.ranks)
        for doc_ids, texts in text_blocks(batches, slice_chars, "doc_id", "text"):
            counts, coded, decoded = [], [], []
            for ids in encoder.encode(texts):
                counts.append(len(ids))
                coded.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", F.col(text_col).alias("text")).mapInArrow(run, schema)
