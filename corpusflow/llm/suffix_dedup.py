"""Removal of repeated byte strings with suffix arrays over the texts that share an anchor.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else. In each string of ``length`` bytes the 32 bytes with the smallest hash are its
anchor; equal strings have equal anchors, so strings meet only those of the same anchor:

1. Neighbouring strings with one anchor are a run, some 85 strings that 284 bytes
   hold. A run moves as its place, its anchor and a hash of its bytes. Equal runs of a
   block of text are found where they are read, and one of them moves.
2. Runs that are alone at their anchor cannot occur again. Runs that occur again as a
   whole are removed as a whole, and only one of each goes on, if its anchor has others.
3. The bytes of these move to their anchor. A task sorts the suffixes of some groups
   by 8, 16, 32, ... and ``length`` bytes (names of names); strings that share
   their place in that order are equal, byte by byte.

An anchor with more than ``GROUP_RUNS`` different runs is too common for one task. Its
runs are cut into slices of ``SLICE`` strings, counted from the anchor. All bytes that the
strings of a slice share are its anchor now, and the three steps are done again. What is
still too common are fragments of one suffix array over all tasks, from the difference
cover {1, 2} modulo 3:

1. Positions p with p mod 3 in {1, 2} are the sample. They are sorted by their
   first 27 bytes (three levels of triples, read off the text) and named by rank.
2. The names are the text of the next level: triples of names that lie 27, then
   81 bytes apart are sorted and named again, so names tell 81, then 243 bytes
   apart. Each level keeps all sampled positions, which saves the merge of
   levels on the way back.
3. The remaining suffixes are merged with the sample by a byte, or two, and the
   name behind: (byte, name of p + 1) orders positions 0 and 1 modulo 3, (two
   bytes, name of p + 2) positions 0 and 2, the names themselves 1 and 2.
4. In each of these orders equal prefixes stand side by side; neighbours are
   compared by the 64-bit hash of their ``length`` bytes.

All these sorts are range partitioned with the position as last key, so a string that
stands at very many places is cut over several tasks.

Cases: null and empty texts have no bytes. A text shorter than ``length`` keeps
all. Repeated rows are repetitions of each other: both lose all strings, like
any two copies. An empty table gives an empty result. Further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import bound_batches, drop_written, fits_broadcast, in_parts, is_stored, written, written_lookup, written_parts
from .common import addressed
from .jaccard import mixed

LENGTH = 200
ANCHOR = 32
#: Different runs of an anchor that one task sorts; those of a more common anchor are sorted by all tasks.
GROUP_RUNS = 8192
#: Strings in a slice of a run whose anchor is too common.
SLICE = 16
#: Bytes whose suffixes are sorted at once, but for a larger group.
SORT_BYTES = 1 << 20
#: Bytes of text in a block; longer texts are cut into several.
BLOCK_BYTES = 1 << 21
_AT_BITS = 24  # place in a block, below the anchor hash

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

Batches = Iterator[pa.RecordBatch]


def _blocks(batches: Batches, size: int, length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(ref, place in the text, bytes) in blocks of bounded size.

    A text longer than a block is cut into parts that overlap by ``length`` - 1
    bytes, so every string of ``length`` bytes is in exactly one of them.
    """
    size = min(size, (1 << _AT_BITS) - length)  # places in a block have _AT_BITS bits
    held: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    total = 0
    for batch in batches:
        for ref, text in zip(*(batch.column(c).to_pylist() for c in ("ref", "text")), strict=True):
            coded = text.encode("utf-8")
            for at in range(0, max(1, len(coded) - length + 1), size):
                part = coded[at : at + size + length - 1]
                if total and total + len(part) > size:
                    yield held
                    held, total = ([], [], []), 0
                for column, value in zip(held, (ref, at, part), strict=True):
                    column.append(value)
                total += len(part)
    if held[0]:
        yield held


class Hashes:
    """Hash of any ``width`` bytes of a text, from running sums."""

    def __init__(self, data: np.ndarray):
        powers = np.full(len(data), _BASE)
        powers[:1] = 1
        back = np.full(len(data), _INVERSE)
        back[:1] = 1
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * np.cumprod(powers))])
        self.back = np.cumprod(back)

    def of(self, begin: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64), salt)

    def all(self, width: int, salt: int = 0) -> np.ndarray:
        n = len(self.back) - width + 1
        return mixed((self.sums[width:] - self.sums[:n]) * self.back[:n] + np.uint64(width), salt)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


_RUNS = "ref bigint, low bigint, windows int, several boolean, anchor bigint, key bigint"


def _once(ref: np.ndarray, low: np.ndarray, windows: np.ndarray, anchor: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """The runs of a block, in the order of the texts, with one row for equal ones (``several``).

    The strings of all of these have rows without partners: ``several`` and an anchor below zero.
    """
    order = np.lexsort((key, anchor))
    new = np.append(True, (anchor[order][1:] != anchor[order][:-1]) | (key[order][1:] != key[order][:-1]))
    group = np.cumsum(new) - 1
    several = np.zeros(len(low), bool)
    several[order] = np.bincount(group)[group] > 1
    one = np.sort(order[new])
    again = np.flatnonzero(several)  # side by side they are one row
    parted = ((low + windows)[again][:-1] != low[again][1:]) | (ref[again][:-1] != ref[again][1:])
    head, tail = again[np.append(True, parted)[: len(again)]], again[np.append(parted, True)[: len(again)]]
    apart = mixed(mixed(ref[head].view(np.uint64), 12) + low[head].astype(np.uint64), 13)
    at = np.append(one, head)
    columns = [
        pa.array(ref[at]),
        pa.array(low[at]),
        pa.array((np.append((low + windows)[one], (low + windows)[tail]) - low[at]).astype(np.int32)),
        pa.array(several[at]),
        pa.array(np.append(anchor[one], ~(apart >> np.uint64(1)).view(np.int64))),
        pa.array(np.append(key[one], np.zeros(len(head), np.int64))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["ref", "low", "windows", "several", "anchor", "key"])


def runs(texts: DataFrame, length: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Runs of every text: where they start, how many strings start in them, their anchor, a hash of their bytes.

    Of equal runs in a block one goes on, see ``_once``.
    """

    def run(batches: Batches) -> Batches:
        for refs, places, coded in _blocks(batches, block_bytes, length):
            data = np.frombuffer(b"".join(coded), np.uint8)
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            long = np.flatnonzero(sizes >= length)
            if not len(long):
                continue
            begin = np.cumsum(sizes) - sizes
            shift = (np.array(places) - begin)[long]  # from the block to the text
            ref = np.array(refs)[long]
            hashes = Hashes(data)
            grams = hashes.all(ANCHOR)
            keyed = (grams & np.uint64((1 << 64) - (1 << _AT_BITS))) | np.arange(len(grams), dtype=np.uint64)
            least = sliding_minimum(keyed, length - ANCHOR + 1)

            # where the place of the anchor changes or a text begins; strings do not cross texts
            first = begin[long]
            low = np.union1d(np.flatnonzero(least[1:] != least[:-1]) + 1, first)
            of = np.searchsorted(first, low, side="right") - 1
            end = np.minimum(np.append(low[1:], len(least)), (first + sizes[long] - length + 1)[of])
            good = (of >= 0) & (low < end)
            low, end, of = low[good], end[good], of[good]
            anchor = (least[low] >> np.uint64(_AT_BITS)).view(np.int64)
            key = hashes.of(low, end + length - 1, 11).view(np.int64)
            yield _once(ref[of], low + shift[of], end - low, anchor, key)

    return texts.mapInArrow(run, _RUNS)


def repeated_runs(found: DataFrame, group_runs: int) -> DataFrame:
    """Written table (ref, low, windows, anchor, whole, rest, common) of the runs whose anchor others have.

    ``whole`` runs occur again as a whole. ``rest`` has one of each run whose anchor has
    different ones, ``common`` says that these are more than ``group_runs``.
    """
    anchor = Window.partitionBy("anchor")
    order = anchor.orderBy("key", "ref", "low")
    rows = found.repartition("anchor")
    rows = rows.withColumns({"_before": F.lag("key").over(order), "_after": F.lead("key").over(order)})
    first = F.expr("_before IS NULL OR _before <> key")
    rows = rows.select(
        *["ref", "low", "windows", "anchor"],
        F.expr("several OR _before <=> key OR _after <=> key").alias("whole"),
        first.alias("_first"),
        F.sum(first.cast("int")).over(anchor).alias("_keys"),
    )
    rows = rows.filter("whole OR _keys > 1")
    rest = F.expr("_first AND _keys > 1")
    rows = rows.select("ref", "low", "windows", "anchor", "whole", rest.alias("rest"), (rest & (F.col("_keys") > group_runs)).alias("common"))
    return written(rows, rest=F.count_if("rest"), common=F.count_if("common"))


def _listed(rows: DataFrame, order: str, kind: np.dtype, pack: Callable[[dict], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Written table (ref, list): the rows of a text as records of ``kind``, which ``pack`` makes with the ref of each."""

    def run(batches: Batches) -> Batches:
        def act(columns: dict) -> pa.RecordBatch:
            ref, records = pack({n: c.to_numpy() for n, c in columns.items()})
            first = np.flatnonzero(np.append(True, ref[1:] != ref[:-1]))
            offsets = (np.append(first, len(ref)) * kind.itemsize).astype(np.int32)
            data = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(records.astype(kind).tobytes())]
            lists = pa.Array.from_buffers(pa.binary(), len(first), data)
            return pa.RecordBatch.from_arrays([pa.array(ref[first]), lists], ["ref", "list"])

        return _by_fragment(batches, names, act, "ref")

    names = rows.columns
    dealt = rows.repartition("ref").sortWithinPartitions("ref", order)
    return written_lookup(dealt.mapInArrow(run, "ref bigint, list binary"))


#: A text has less than 2 GB.
_PIECE = np.dtype([("anchor", "<i8"), ("low", "<u4"), ("windows", "<u4"), ("alone", "?")])
_PIECES = "ref bigint, start bigint, anchor bigint, alone boolean, bytes binary"


def pieces(texts: DataFrame, rest: DataFrame, length: int) -> DataFrame:
    """(ref, start, anchor, alone, bytes) of the runs ``rest``; ``alone`` says that a run has no copy.

    Texts do not move: lists beyond a broadcast meet them part by part, and the bytes are written;
    beyond as many parts as ``in_parts`` allows texts move after all.
    """

    def pack(columns: dict) -> tuple[np.ndarray, np.ndarray]:
        records = np.zeros(len(columns["ref"]), _PIECE)
        for name in ("anchor", "low", "windows"):
            records[name] = columns[name]
        records["alone"] = ~columns["whole"].astype(bool)
        return columns["ref"], records

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            out: list[tuple] = []
            for ref, text, found in zip(*(batch.column(c).to_pylist() for c in ("ref", "text", "list")), strict=True):
                coded = text.encode("utf-8")
                for anchor, low, windows, alone in np.frombuffer(found, _PIECE).tolist():
                    out.append((ref, low, anchor, alone, coded[low : low + windows + length - 1]))
                if len(out) > 10_000:
                    yield _piece_rows(out)
                    out = []
            if out:
                yield _piece_rows(out)

    texts = texts.select("ref", "text")
    lists = _listed(rest.select("ref", "low", "windows", "anchor", "whole"), "low", _PIECE, pack)
    small = fits_broadcast(lists)
    parts = None if small else in_parts(texts, lists, "ref")
    if parts:
        return written_parts([p.select("ref", "text", "list").mapInArrow(cut, _PIECES) for p in parts])
    rows = texts.join(F.broadcast(lists) if small else lists, "ref")
    return rows.select("ref", "text", "list").mapInArrow(cut, _PIECES)


def _piece_rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["ref", "start", "anchor", "alone", "bytes"])


def slices(found: DataFrame, length: int) -> DataFrame:
    """The strings of pieces as runs of up to ``SLICE``, whose anchor is a hash of the bytes that all of these share.

    Slices are counted from the anchor of the piece, so equal strings are in slices with equal anchors.
    """

    def cut(table: pa.Table) -> pa.RecordBatch:
        ref, start, anchor = (table.column(c).to_numpy() for c in ("ref", "start", "anchor"))
        coded = table.column("bytes").to_pylist()
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        begin = np.cumsum(sizes) - sizes
        hashes = Hashes(np.frombuffer(b"".join(coded), np.uint8))
        grams = (hashes.all(ANCHOR) >> np.uint64(_AT_BITS)).view(np.int64)
        owner = np.repeat(np.arange(len(coded)), sizes)[: len(grams)]
        at = np.flatnonzero((grams == anchor[owner]) & (np.arange(len(grams)) + ANCHOR <= (begin + sizes)[owner]))
        place = at[np.unique(owner[at], return_index=True)[1]] - begin  # where the anchor stands first in each piece
        windows = sizes - length + 1
        last = place // SLICE  # the slice of the first string
        count = last - (place - windows + 1) // SLICE + 1
        of = np.repeat(np.arange(len(coded)), count)
        number = last[of] - (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
        first = place[of] - SLICE * number - SLICE + 1  # below zero in a slice that begins before the piece
        low, end = np.maximum(first, 0), np.minimum(first + SLICE, windows[of])
        core = hashes.of(begin[of] + first + SLICE - 1, begin[of] + first + length, 14)
        core = (mixed(core + number.astype(np.uint64), 15) >> np.uint64(1)).view(np.int64)
        key = hashes.of(begin[of] + low, begin[of] + end + length - 1, 11).view(np.int64)
        return _once(ref[of], start[of] + low, end - low, core, key)

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch] if batch.num_rows else []
            if sum(b.num_rows for b in held) >= 8192:
                yield cut(pa.Table.from_batches(held))
                held = []
        if held:
            yield cut(pa.Table.from_batches(held))

    return found.mapInArrow(run, _RUNS)


def repeated_starts(data: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Places whose ``length`` bytes start at another place, too; ``left`` are the bytes from a place to the end of its piece.

    Suffixes are sorted by 8 bytes, then by twice as many, up to ``length``: by the rank of
    their beginning and the rank of what follows. Places that have their rank for themselves need no further sort.
    """
    n = len(data)
    padded = np.append(data, np.zeros(8, np.uint8))
    words = np.zeros(n, np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : i + n]
    depth = 8
    at = np.flatnonzero(left >= depth)
    at = at[np.argsort(words[at], kind="stable")]
    new = np.append(True, words[at][1:] != words[at][:-1])[: len(at)]
    rank = np.zeros(n, np.int64)
    rank[at] = np.flatnonzero(new)[np.cumsum(new) - 1]
    tied = at[~(new & np.append(new[1:], True))]
    while depth < length:
        step = min(depth, length - depth)
        depth += step
        at = tied[left[tied] >= depth]
        pair = rank[at] * n + rank[at + step]
        order = np.argsort(pair, kind="stable")
        at, pair = at[order], pair[order]
        old = rank[at]
        new = np.append(True, pair[1:] != pair[:-1])[: len(at)]
        old_start = np.flatnonzero(np.append(True, old[1:] != old[:-1])[: len(at)])
        start = np.flatnonzero(new)
        offset = start - old_start[np.searchsorted(old_start, start, side="right") - 1]
        rank[at] = old + offset[np.cumsum(new) - 1]
        tied = at[~(new & np.append(new[1:], True))[: len(at)]]
    return np.sort(tied)


def _stretches(group: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows [low, high) of whole groups with about ``most`` bytes in all; a larger group is on its own or the last."""
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
    total = np.cumsum(sizes)
    low = 0
    while low < len(group):
        before = int(total[low - 1]) if low else 0
        over = int(np.searchsorted(total, before + most))  # the row that reaches it
        high = int(ends[min(np.searchsorted(ends, over, side="right"), len(ends) - 1)])
        yield low, high
        low = high


def group_matches(found: DataFrame, length: int) -> DataFrame:
    """(ref, low, end): spans of the pieces whose strings occur again in a piece with the same anchor."""

    def run(batches: Batches) -> Batches:
        def act(columns: dict) -> pa.RecordBatch | None:
            ref, start, anchor = (columns[c].to_numpy() for c in ("ref", "start", "anchor"))
            alone = np.array(columns["alone"].to_pylist())
            coded = columns["bytes"].to_pylist()
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            out = []
            for low, high in _stretches(anchor, sizes, SORT_BYTES):
                data = np.frombuffer(b"".join(coded[low:high]), np.uint8)
                end = np.cumsum(sizes[low:high])
                owner = np.repeat(np.arange(low, high), sizes[low:high])
                place = repeated_starts(data, end[owner - low] - np.arange(len(data)), length)
                place = place[alone[owner[place]]]
                if not len(place):
                    continue
                of = owner[place]
                local = place - (end[of - low] - sizes[of])
                new = np.append(True, (of[1:] != of[:-1]) | (place[1:] > place[:-1] + 1))
                last = np.append(new[1:], True)
                out.append((ref[of[new]], (start[of] + local)[new], (start[of] + local)[last] + length))
            if not out:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["ref", "low", "end"])

        return _by_fragment(batches, ["ref", "start", "anchor", "alone", "bytes"], act, "anchor", SORT_BYTES >> 8)

    rows = found.repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(run, "ref bigint, low bigint, end bigint")


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def first_keys(frags: DataFrame) -> DataFrame:
    """(frag, place, k0..k3): the first 27 bytes of every sampled position, zero behind the end."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            coded = [b.as_py() for b in batch.column("bytes")]
            frag = batch.column("frag").to_numpy()
            step = 1 << 12  # fragments at once
            for low in range(0, len(coded), step):
                part = coded[low : low + step]
                data = np.frombuffer(b"".join(c + bytes(32) for c in part), np.uint8)
                sizes = np.fromiter(map(len, part), np.int64, len(part))
                begin = np.cumsum(sizes + 32) - (sizes + 32)
                place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                sampled = place % 3 > 0
                at = (np.repeat(begin, sizes) + place)[sampled]
                words = np.lib.stride_tricks.sliding_window_view(data, 7)
                keys = []
                for word in range(4):  # 7, 7, 7 and 6 bytes: below 2^63, in the order of the bytes
                    taken = words[at + 7 * word].astype(np.int64)
                    if word == 3:
                        taken[:, 6] = 0
                    value = np.zeros(len(at), np.int64)
                    for i in range(7):
                        value = (value << 8) | taken[:, i]
                    keys.append(value)
                owner = np.repeat(frag[low : low + step], sizes)[sampled]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(place[sampled].astype(np.int32)), *map(pa.array, keys)],
                    ["frag", "place", "k0", "k1", "k2", "k3"],
                )

    schema = "frag bigint, place int, k0 bigint, k1 bigint, k2 bigint, k3 bigint"
    return frags.select("frag", "bytes").mapInArrow(run, schema)


def named(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frag, place, name): the rank of every row's key, equal keys having one name; and the written table it reads.

    The rows are range partitioned by key and position. A task numbers the keys
    it has; the tasks' first and last keys, a few bytes each, give the base of
    each task's names.
    """
    keys = [c for c in keyed.columns if c.startswith("k")]

    def number(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        last, local = None, -1
        final: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _numbers(batch, *keys)
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            head, tail = [tuple(int(c[i]) for c in columns) for i in (0, -1)]
            new[0] = head != last
            numbers = local + np.cumsum(new)
            edge = np.full(batch.num_rows, None, object)
            if last is None:
                edge[0] = repr(head)
            last, local = tail, int(numbers[-1])
            final = (tail, local)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(batch.num_rows, part, np.int32)),
                    pa.array(numbers),
                    batch.column("frag"),
                    batch.column("place"),
                    pa.array(edge, pa.string()),
                ],
                ["part", "local", "frag", "place", "edge"],
            )
        if final:
            row = [[part], [final[1]], [None], [None], [repr(final[0])]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "local", "frag", "place", "edge"]
            )

    dealt = keyed.repartitionByRange(*keys, "frag", "place").sortWithinPartitions(*keys)
    rows = stored = written(dealt.mapInArrow(number, "part int, local bigint, frag bigint, place int, edge string"))
    edges: dict[int, dict] = {}
    for row in rows.filter("edge IS NOT NULL").collect():  # two rows of each task
        known = edges.setdefault(row.part, {})
        if row.frag is None:
            known["last"], known["count"] = row.edge, row.local + 1
        else:
            known["first"] = row.edge
    bases, base, before = [], 1, None
    for part in sorted(edges):
        if edges[part]["first"] == before:
            base -= 1  # the key goes on from the task before
        bases.append((part, base))
        base += edges[part]["count"]
        before = edges[part]["last"]
    spark = keyed.sparkSession
    table = F.broadcast(spark.createDataFrame(bases, "part int, base bigint"))  # a row of each task
    rows = rows.filter("frag IS NOT NULL").join(table, "part")
    return rows.select("frag", "place", (F.col("base") + F.col("local")).alias("name")), stored


def _by_fragment(
    batches: Batches, names: list[str], act: Callable[[dict], pa.RecordBatch | None], by: str = "frag", least: int = 50_000
) -> Batches:
    """Hand on rows that are sorted by ``by`` in stretches of ``least`` rows or more that end with a fragment."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        frag = held.column(by).to_numpy()
        cut = int(np.searchsorted(frag, frag[-1])) if len(frag) else 0
        if cut > least:
            found = act({n: held.slice(0, cut).column(n) for n in names})
            if found is not None:
                yield found
            held = held.slice(cut)
    if held is not None and held.num_rows:
        found = act({n: held.column(n) for n in names})
        if found is not None:
            yield found


def triple_keys(names: DataFrame, reach: int) -> DataFrame:
    """(frag, place, k0, k1, k2): the names at a position, ``reach`` and twice ``reach`` behind it."""
    step = reach // 3 * 2  # places between them among the sampled positions of a fragment

    def run(batches: Batches) -> Batches:
        def act(columns: dict) -> pa.RecordBatch:
            frag, place, name = (columns[c].to_numpy() for c in ("frag", "place", "name"))
            keys = [name]
            for shift in (step, 2 * step):
                ahead = np.zeros(len(name), np.int64)
                if shift < len(name):
                    same = frag[shift:] == frag[:-shift]
                    ahead[:-shift][same] = name[shift:][same]
                keys.append(ahead)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (frag, place, *keys)], ["frag", "place", "k0", "k1", "k2"])

        return _by_fragment(batches, ["frag", "place", "name"], act)

    rows = names.repartition("frag").sortWithinPartitions("frag", "place")
    return rows.mapInArrow(run, "frag bigint, place int, k0 bigint, k1 bigint, k2 bigint")


def merged_orders(frags: DataFrame, names: DataFrame, length: int) -> DataFrame:
    """(list, head, name, hash, frag, place): every string twice, in the orders of two of the three residues."""
    texts = frags.select("frag", F.lit(-1).alias("place"), F.lit(0).cast("bigint").alias("name"), "bytes")
    rows = texts.unionByName(names.withColumn("bytes", F.lit(None).cast("binary")))

    def run(batches: Batches) -> Batches:
        def act(columns: dict) -> pa.RecordBatch | None:
            frag, place, name = (columns[c].to_numpy() for c in ("frag", "place", "name"))
            heads = np.flatnonzero(place < 0)  # one row with the bytes before the names of each fragment
            coded = [columns["bytes"][int(i)].as_py() for i in heads]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            data = np.frombuffer(b"".join(coded) + bytes(2), np.uint8)
            begin = np.cumsum(sizes) - sizes
            n = int(sizes.sum())
            owner = np.repeat(np.arange(len(coded)), sizes)
            local = np.arange(n) - begin[owner]
            rank = np.zeros(n + 2, np.int64)
            at = np.flatnonzero(place >= 0)
            rank[begin[np.searchsorted(frag[heads], frag[at])] + place[at]] = name[at]
            use = np.flatnonzero(local + length <= sizes[owner])
            if not len(use):
                return None
            hashed = Hashes(data).of(use, use + length, 21).view(np.int64)
            residue = local[use] % 3
            parts = []
            for number, (pair, head, behind) in enumerate(
                (
                    ((0, 1), data[use].astype(np.int32), rank[use + 1]),
                    ((0, 2), data[use].astype(np.int32) * 256 + data[use + 1], rank[use + 2]),
                    ((1, 2), np.zeros(len(use), np.int32), rank[use]),
                )
            ):
                chosen = np.flatnonzero(np.isin(residue, pair))
                values = (np.full(len(chosen), number, np.int32), head[chosen], behind[chosen], hashed[chosen])
                parts.append((*values, frag[heads][owner[use[chosen]]], local[use[chosen]].astype(np.int32)))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)],
                ["list", "head", "name", "hash", "frag", "place"],
            )

        return _by_fragment(batches, ["frag", "place", "name", "bytes"], act)

    dealt = rows.repartition("frag").sortWithinPartitions("frag", "place")
    return dealt.mapInArrow(run, "list int, head int, name bigint, hash bigint, frag bigint, place int")


def equal_neighbours(orders: DataFrame) -> DataFrame:
    """(frag, place) of all strings that a neighbour in an order is equal to."""
    columns = ["list", "head", "name", "hash", "frag", "place"]
    spark = orders.sparkSession

    def compare(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] | None = None  # the last row: its other neighbour is still to come
        first = True
        marked = False

        def edge_row(values: list, last: bool) -> pa.RecordBatch:
            row = [int(values[4]), int(values[5]), part, last, f"{int(values[0])}:{int(values[3])}"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        names = ["frag", "place", "part", "last", "edge"]
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _numbers(batch, *columns)
            if held is not None:
                values = [np.concatenate([h, v]) for h, v in zip(held, values, strict=True)]
            if first:
                yield edge_row([v[0] for v in values], False)
                first = False
            same = (values[0][1:] == values[0][:-1]) & (values[3][1:] == values[3][:-1])
            equal = np.zeros(len(values[0]), bool)
            equal[1:] |= same
            equal[:-1] |= same
            equal[0] |= marked
            marked = bool(equal[-1])
            found = np.flatnonzero(equal)
            held = [v[-1:] for v in values]
            if len(found):
                size = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values[4][found]),
                        pa.array(values[5][found]),
                        pa.nulls(size, pa.int32()),
                        pa.nulls(size, pa.bool_()),
                        pa.nulls(size, pa.string()),
                    ],
                    names,
                )
        if held is not None:
            yield edge_row([v[0] for v in held], True)

    order = ["list", "head", "name", "hash", "frag", "place"]
    dealt = orders.repartitionByRange("list", "head", "name", "frag", "place").sortWithinPartitions(*order[:3])
    schema = "frag bigint, place int, part int, last boolean, edge string"
    rows = written(dealt.mapInArrow(compare, schema))
    edges = sorted(
        ((r.part, r.last, r.edge, r.frag, r.place) for r in rows.filter("edge IS NOT NULL").collect())
    )  # two rows of each task
    extra = []
    for before, after in zip(edges[1::2], edges[2::2], strict=False):
        if before[2] == after[2]:
            extra += [before[3:], after[3:]]
    found = rows.filter("edge IS NULL").select("frag", "place")
    return found.unionByName(spark.createDataFrame(extra, "frag bigint, place int"))


def _spans(found: DataFrame, length: int) -> DataFrame:
    """(frag, low, end): runs of neighbouring strings as spans of bytes."""

    def run(batches: Batches) -> Batches:
        def act(columns: dict) -> pa.RecordBatch:
            frag, place = columns["frag"].to_numpy(), columns["place"].to_numpy().astype(np.int64)
            new = np.ones(len(frag), bool)
            new[1:] = (frag[1:] != frag[:-1]) | (place[1:] > place[:-1] + 1)
            last = np.append(new[1:], True)
            return pa.RecordBatch.from_arrays(
                [pa.array(frag[new]), pa.array(place[new]), pa.array(place[last] + length)], ["frag", "low", "end"]
            )

        return _by_fragment(batches, ["frag", "place"], act)

    rows = found.repartition("frag").sortWithinPartitions("frag", "place")
    return rows.mapInArrow(run, "frag bigint, low bigint, end bigint")


def partial_matches(frags: DataFrame, length: int) -> DataFrame:
    """(ref, low, end): spans of the fragments whose strings occur again."""
    names, stored = named(first_keys(frags))
    reach = 27
    while reach < length:
        before = stored
        names, stored = named(triple_keys(names, reach))
        drop_written(before)
        reach *= 3
    found = equal_neighbours(merged_orders(frags.select("frag", "bytes"), names, length))
    places = frags.filter("alone").select("frag", "ref", "start")
    spans = written(_spans(found, length)).join(places, "frag")
    return spans.select("ref", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("end")).alias("end"))


_SPAN = np.dtype([("low", "<u4"), ("end", "<u4")])


def _joined(spans: DataFrame) -> DataFrame:
    """Written table (ref, list): spans that overlap or touch are one, in the order of the text."""

    def pack(columns: dict) -> tuple[np.ndarray, np.ndarray]:
        ref, low, end = (columns[c] for c in ("ref", "low", "end"))
        far = (np.cumsum(np.append(True, ref[1:] != ref[:-1])) - 1) << 32  # beyond any text
        reach = np.maximum.accumulate(far + end)
        new = np.append(True, (far + low)[1:] > reach[:-1])
        records = np.zeros(np.count_nonzero(new), _SPAN)
        records["low"], records["end"] = low[new], (reach - far)[np.append(new[1:], True)]
        return ref[new], records

    return _listed(spans.select("ref", "low", "end"), "low", _SPAN, pack)


def repeated_spans(texts: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, group_runs: int = GROUP_RUNS) -> DataFrame:
    """Written table (ref, list): bytes to remove, as records of ``_SPAN``.

    ``texts`` has ref, a number of its own for each row, and text.
    """
    read, parts = [], []

    def moved(found: DataFrame, rest: str) -> DataFrame:
        rows = pieces(texts, found.filter(rest), length)
        read.extend([rows] if is_stored(rows) else [])
        return rows

    def matched(cut: DataFrame) -> DataFrame:
        found = repeated_runs(cut, group_runs)
        read.append(found)
        end = (F.col("low") + F.col("windows") + length - 1).alias("end")
        parts.append(found.filter("whole").select("ref", "low", end))
        if found.observed["rest"] > found.observed["common"]:
            parts.append(group_matches(moved(found, "rest AND NOT common"), length))
        return found

    found = matched(runs(texts.select("ref", "text"), length, block_bytes))
    if found.observed["common"]:
        found = matched(slices(moved(found, "common"), length))
    if found.observed["common"]:
        frags = written(moved(found, "common").withColumn("frag", F.monotonically_increasing_id()))
        read.append(frags)
        parts.append(partial_matches(frags, length))
    spans = reduce(DataFrame.unionByName, parts)
    joined = _joined(spans)
    for table in read:
        drop_written(table)
    return joined


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, group_runs: int = GROUP_RUNS
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` are the bytes that stay."""
    bound_batches(docs.sparkSession)
    texts = addressed(docs.select("doc_id", "text"), "ref").withColumn("text", F.coalesce("text", F.lit("")))
    spans = repeated_spans(texts, length, block_bytes, group_runs)
    # no text moves if the spans fit a broadcast
    rows = texts.join(F.broadcast(spans) if fits_broadcast(spans) else spans, "ref", "left").select("doc_id", "text", "list")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                coded = text.encode("utf-8")
                kept, at, n_spans = [], 0, 0
                for low, end in np.frombuffer(found or b"", _SPAN).tolist():
                    kept.append(coded[at:low])
                    at = end
                    n_spans += 1
                kept.append(coded[at:])
                rest = b"".join(kept)
                out.append((doc_id, len(coded), len(coded) - len(rest), n_spans, rest))
            if out:
                kinds = [pa.int64()] * 4 + [pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return rows.mapInArrow(run, schema)


def brute_force(texts: list[bytes], length: int) -> list[bytes]:
    """The bytes that stay, by a table of all strings: for tests on small inputs."""
    seen: dict[bytes, int] = {}
    for text in texts:
        for at in range(len(text) - length + 1):
            seen[text[at : at + length]] = seen.get(text[at : at + length], 0) + 1
    kept = []
    for text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if seen[text[at : at + length]] > 1:
                gone[at : at + length] = b"\x01" * length
        kept.append(bytes(b for b, g in zip(text, gone, strict=True) if not g))
    return kept
