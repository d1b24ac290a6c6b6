"""Benchmark decontamination with a generalised suffix automaton of the test items.

The words of all items, in lower case, make one automaton whose states stand for
the strings of words that occur in them. A text streams through it word by word; at
each word the automaton knows the longest string of item words that ends there. A
match of at least ``window`` words is a hit: all its words belong to windows of an
item. An item of fewer words is a window by itself. The state of the last
``window`` words names the items they occur in.

Most of a text cannot match: neighbouring words that are neighbours in no item
break every match. Their places come from a vectorised lookup, and only runs
that are long enough go through the automaton, with the same result.

Items make automata of at most ``SHARD_WORDS`` words, so what a task holds does not
grow with the benchmark. A longer item is cut into parts that overlap by
``window`` - 1 words, which keeps its windows. With several automata the texts are
scanned once for each, and only places of hits are put together, by row.

Cases: a null text has no words, like an empty one; an item without words is
ignored. A null item id counts as the empty string, repeated items as one. A
repeated row is a row of its own. Empty tables give no hits, or no rows. Further
columns are ignored by ``matches`` and kept by ``decontaminate``, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import written
from .common import fresh, text_blocks

#: Words of a window.
WINDOW = 10
#: Share of hit words above which a document goes as a whole.
MAX_COVERED = 0.5
#: Item words in one automaton, some 150 MB; bytes of text in a block of documents.
SHARD_WORDS, BLOCK_BYTES = 200_000, 4_000_000
#: Distinct pairs of words are looked up in a table of words x words up to this many cells.
TABLE_CELLS = 1 << 25

#: Fixed values of the contract: A-Z in lower case; these bytes are no part of a word.
_BREAKS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_PLAIN = bytes(
    0x20 if (b + 32 if 0x41 <= b <= 0x5A else b) in _BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
_WORD = re.compile(rb"[^\x20]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Automaton:
    """The strings of words that occur in ``items``: (item id, words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = []
        for item, words in items:
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            numbered.append((item, ids))
            last = 0
            for word in ids:
                last = self._extend(last, word)
        #: The state of the last ``window`` words, for states whose longest string has as many.
        self.tail = [0] * len(self.next)
        #: (words, item) of the short items that end with a state; the next state with some on the way of links.
        self.short: dict[int, list[tuple[int, str]]] = defaultdict(list)
        self.items: dict[int, set[str]] = defaultdict(set)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for state in order:
            if self.length[state] >= window:
                above = self.link[state]
                self.tail[state] = self.tail[above] if self.length[above] >= window else state
        for item, ids in numbered:
            state = 0
            for place, word in enumerate(ids):
                state = self.next[state][word]
                if place + 1 >= window:
                    self.items[self.tail[state]].add(item)
            if 0 < len(ids) < window:
                self.short[state].append((len(ids), item))
        self.short_at = [0] * len(self.next)
        for state in order:
            self.short_at[state] = state if state in self.short else self.short_at[self.link[state]]
        self.least = min([window, *(n for found in self.short.values() for n, _ in found)])
        self._pairs(ids for _, ids in numbered)

    def _extend(self, last: int, word: int) -> int:
        """The state of the string of ``last`` with ``word`` behind it."""
        nexts, link, length = self.next, self.link, self.length
        known = nexts[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._clone(last, word, known)
        made = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        while last >= 0 and word not in nexts[last]:
            nexts[last][word] = made
            last = link[last]
        if last >= 0:
            behind = nexts[last][word]
            link[made] = behind if length[behind] == length[last] + 1 else self._clone(last, word, behind)
        return made

    def _clone(self, state: int, word: int, behind: int) -> int:
        """Part ``behind`` in two: its strings as long as that of ``state`` with ``word``, and the longer ones."""
        made = len(self.next)
        self.next.append(dict(self.next[behind]))
        self.length.append(self.length[state] + 1)
        self.link.append(self.link[behind])
        self.link[behind] = made
        while state >= 0 and self.next[state].get(word) == behind:
            self.next[state][word] = made
            state = self.link[state]
        return made

    def _pairs(self, numbered: Iterator[list[int]]) -> None:
        n = max(len(self.numbers), 1)
        codes = {a * n + b for ids in numbered for a, b in zip(ids, ids[1:], strict=False)}
        self.pairs = np.sort(np.fromiter(codes, np.int64, len(codes)))
        self.table = None
        if n * n <= TABLE_CELLS:
            self.table = np.zeros(n * n, bool)
            self.table[self.pairs] = True

    def _runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Runs of words that are long enough for a match; ``ids`` has -1 for words of no item."""
        known = ids >= 0
        if self.least > 1:
            # joined[i]: words i and i + 1 are neighbours in some item
            joined = known[:-1] & known[1:]
            at = np.flatnonzero(joined)
            codes = ids[at].astype(np.int64) * len(self.numbers) + ids[at + 1]
            if self.table is not None:
                joined[at] = self.table[codes]
            else:
                place = np.minimum(np.searchsorted(self.pairs, codes), max(len(self.pairs) - 1, 0))
                joined[at] = self.pairs[place] == codes if len(self.pairs) else False
            known, needed, more = joined, self.least - 1, 1
        else:
            needed, more = 1, 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], known.astype(np.int8), [0]])))
        begins, ends = edges[::2], edges[1::2]
        long = ends - begins >= needed
        return list(zip(begins[long].tolist(), (ends[long] + more).tolist(), strict=True))

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """(begin, end, items) of matches in ``ids``, by end; several may overlap."""
        nexts, link, length, window = self.next, self.link, self.length, self.window
        for begin, end in self._runs(ids):
            state = matched = 0
            for place, word in enumerate(ids[begin:end].tolist(), begin + 1):
                while state and word not in nexts[state]:
                    state = link[state]
                    matched = length[state]
                behind = nexts[state].get(word)
                if behind is None:
                    matched = 0
                    continue
                state, matched = behind, matched + 1
                if matched >= window:
                    yield place - matched, place, self.items[self.tail[state]]
                at = self.short_at[state]
                while at:
                    for n, item in self.short[at]:
                        if n <= matched:
                            yield place - n, place, {item}
                    at = self.short_at[link[at]]


def _merged(spans: list[list[int]]) -> list[list[int]]:
    made: list[list[int]] = []
    for begin, end in sorted(spans):
        if made and begin <= made[-1][1]:
            made[-1][1] = max(made[-1][1], end)
        else:
            made.append([begin, end])
    return made


def find(automaton: Automaton, texts: list[bytes]) -> Iterator[tuple[int, list[list[int]], int, list[str]]]:
    """Per text: words, merged spans of hit words, words of the longest match, items."""
    number, parts = automaton.numbers.get, []
    for text in texts:
        found = words_of(text)
        parts.append(np.fromiter(map(number, found, repeat(-1)), np.int32, len(found)))
        parts.append(np.array([-1], np.int32))  # no match goes on into the next text
    ids = np.concatenate(parts)
    sizes = np.fromiter(map(len, parts[::2]), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    hits: dict[int, tuple[list[list[int]], list[int], set[str]]] = {}
    for begin, end, items in automaton.scan(ids):
        text = int(np.searchsorted(starts, begin, side="right")) - 1
        spans, longest, named = hits.setdefault(text, ([], [0], set()))
        begin, end = begin - int(starts[text]), end - int(starts[text])
        if spans and begin >= spans[-1][0] and begin <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([begin, end])
        longest[0] = max(longest[0], end - begin)
        named |= items
    for text, n in enumerate(sizes.tolist()):
        spans, longest, named = hits.get(text, ([], [0], set()))
        yield n, _merged(spans), longest[0], sorted(named)


_SPANS = "array<struct<begin:bigint,end:bigint>>"
_FOUND = [("n_words", "bigint"), ("spans", _SPANS), ("longest", "bigint"), ("items", "array<string>")]
_ARROW = [pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.list_(pa.string())]


def _item_parts(items: DataFrame, window: int, most: int) -> DataFrame:
    """(item, n, words, shard-to-be key): items as words, long ones in overlapping parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), most):
                    part = words[at : at + most + window - 1]
                    rows.append((item, len(part), b" ".join(part)))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = [pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item", "n", "words"]
            )

    named = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return written(named.mapInArrow(run, "item string, n bigint, words binary").distinct())


def _shards(items: DataFrame, window: int, shard_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in lists of about ``shard_words`` words, one list at a time."""
    parts = _item_parts(items, window, max(shard_words // 4, window))
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    number = math.ceil(2 * total / shard_words) if total > shard_words else 1
    for shard in range(number):
        some = parts.filter(F.pmod(F.xxhash64("item", "words"), F.lit(number)) == shard) if number > 1 else parts
        yield [(r.item, bytes(r.words).split()) for r in some.select("item", "words").toLocalIterator()]


def _scanned(rows: DataFrame, text: str, shard: Broadcast, window: int) -> DataFrame:
    """``rows`` with what ``find`` finds in the column ``text``, under names that start with an underscore."""
    names = [fresh(rows, f"_{n}") for n, _ in _FOUND]
    added = T._parse_datatype_string(", ".join(f"`{n}` {kind}" for n, (_, kind) in zip(names, _FOUND, strict=True)))
    schema = T.StructType([*rows.schema.fields, *added.fields])
    place = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(shard.value, window)
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(place).cast(pa.binary()).fill_null(b"")], ["text"])
            found: list[tuple] = []
            for (block,) in text_blocks([texts], BLOCK_BYTES, "text"):
                found.extend(find(automaton, [t or b"" for t in block]))
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            for name, kind, values in zip(names, _ARROW, columns, strict=True):
                if name == names[1]:
                    values = [[{"begin": b, "end": e} for b, e in spans] for spans in values]
                batch = batch.append_column(name, pa.array(values, kind))
            yield batch

    return rows.mapInArrow(run, schema)


def _union_of(spans: Column) -> Column:
    """Sorted spans with those that touch put together."""
    start = F.array().cast(_SPANS)
    last = lambda made: F.element_at(made, -1)

    def add(made, span):
        joined = F.struct(last(made)["begin"].alias("begin"), F.greatest(last(made)["end"], span["end"]).alias("end"))
        touches = (F.size(made) > 0) & (span["begin"] <= F.get(made, F.size(made) - 1)["end"])
        return F.when(touches, F.concat(F.slice(made, 1, F.size(made) - 1), F.array(joined))).otherwise(
            F.concat(made, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), start, add)


def _found(rows: DataFrame, text: str, items: DataFrame, window: int, shard_words: int) -> tuple[DataFrame, list[str]]:
    """``rows`` with n_words, spans, longest and items, and the names of these columns."""
    spark = rows.sparkSession
    names = [fresh(rows, f"_{n}") for n, _ in _FOUND]
    shards = _shards(items, window, shard_words)
    first = next(shards)
    second = next(shards, None)
    if second is None:
        return _scanned(rows, text, spark.sparkContext.broadcast(first), window), names
    row = fresh(rows, "_row")
    rows = written(rows.withColumn(row, F.monotonically_increasing_id()))
    found = None
    for shard in (s for some in ([first, second], shards) for s in some):
        scan = _scanned(rows.select(row, F.col(text).alias("text")), "text", spark.sparkContext.broadcast(shard), window)
        # each automaton in a job of its own: never two in one task
        scan = written(scan.drop("text"))
        found = scan if found is None else found.unionByName(scan)
    together = found.groupBy(row).agg(
        F.max("_n_words").alias(names[0]),
        _union_of(F.flatten(F.collect_list("_spans"))).alias(names[1]),
        F.max("_longest").alias(names[2]),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias(names[3]),
    )
    return rows.join(together, row).drop(row), names


def matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", shard_words: int = SHARD_WORDS
) -> DataFrame:
    """(doc_id, n_words, spans, longest, items) of every row of ``docs``.

    ``spans`` are the hit words, from ``begin`` to before ``end``; ``longest`` is
    the longest match in words; ``items`` are the ids of ``items`` (item_id, text)
    with a window in the text, as sorted strings.
    """
    rows, names = _found(docs.select("doc_id", F.col(text_col).alias("text")), "text", items, window, shard_words)
    return rows.select("doc_id", *[F.col(n).alias(wanted) for n, (wanted, _) in zip(names, _FOUND, strict=True)])


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_PLAIN))]
    kept, before = [], 0
    for begin, end in spans:
        kept.append(raw[before : at[begin][0]])
        before = at[end - 1][1]
    return b"".join([*kept, raw[before:]]).decode()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_covered: float = MAX_COVERED,
    text_col: str = "text",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without the spans that match ``window`` words or more, and without rows that such spans cover too much.

    A row of which more than ``max_covered`` of the words are hit goes; of the
    others the hit words go. All columns stay, whatever their names.
    """
    rows, (n_words, spans, longest, named) = _found(docs, text_col, items, window, shard_words)
    n_hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    rows = rows.filter(n_hit <= F.lit(max_covered) * F.col(n_words)).drop(n_words, longest, named)
    columns = docs.columns
    place, spans_at = columns.index(text_col), len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                cut(text, [(s["begin"], s["end"]) for s in found]) if found else text
                for text, found in zip(batch.column(place).to_pylist(), batch.column(spans_at).to_pylist(), strict=True)
            ]
            arrays = [batch.column(i) if i != place else pa.array(texts, pa.string()) for i in range(spans_at)]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:spans_at])

    return rows.select(*[F.col(f"`{c}`") for c in columns], spans).mapInArrow(run, docs.schema)
