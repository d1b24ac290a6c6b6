"""Phrase collocations by marginalising the counts of the longest windows.

Every pair of neighbours leads a window: the two words and the next ones of their
piece, padded with the empty string where the piece ends. Only these longest windows are
counted. Each occurrence of a shorter phrase begins at one word, so its count is the sum
over the windows that begin with it, and Spark's ROLLUP over the window's columns sums
all lengths at once; no n-grams are made length by length.

A phrase with a rare word, a rare pair or a rare triple of neighbours is rare. A first
pass counts words, a second one the pairs of frequent words, a third one the triples of
frequent pairs, both under hashes; they mark what is frequent in bitmaps of fixed size,
and a window ends before its first unmarked word, pair or triple. A false mark leaves a
window longer than need be, which changes no count of a frequent phrase. The counts of
phrases come from the windows, those of single words from the first pass. Texts of a
block are counted together before they are shuffled. Triples move by groups of places,
three bytes each, windows by buckets of their first pair: rows for each task, not for
each of them, and the windows of a bucket are added up before Spark rolls them up.

Both parts of any cut of a frequent phrase are at least as frequent as the phrase,
so all counts that a score needs are in the table of frequent phrases. It is broadcast
if its measured size allows it, else joined by shuffle with hot parts dealt out.

Cases: a null text has no words; a null language is ``und``. Repeated rows count
as often as they occur. A text or word of any length is counted whole; a text
longer than a block goes through in parts that see the words behind them. Equal
scores rank by count, then by phrase. An empty table gives an empty result.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import lookup_join, written
from .common import text_blocks

#: Least occurrences of a phrase, words in the longest, phrases listed per language.
MIN_COUNT, MOST_WORDS, TOP = 100, 5, 2000
#: A phrase goes if a longer one that holds it has this percentage of its occurrences.
COVERED_PERCENT = 100
#: Bytes of text that are counted together.
BLOCK_BYTES = 6_000_000
#: The bitmaps of frequent words, pairs and triples: 2^26 bits, 8 MB, each.
BITMAP_BITS = 26
#: Triples are counted at 2^30 places, in groups of 2^16; a task sends so many at once.
PLACE_BITS, GROUP_BITS, HELD_PLACES = 30, 16, 2_000_000
#: Windows move in so many buckets; a task sends so many at once.
BUCKET_BITS, HELD_WINDOWS = 12, 500_000

#: Fixed values of the contract: ends of pieces, white space between words.
_ENDS, _SPACE = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_END = b"\xff"  # no byte of any UTF-8 text
_PLAIN = bytes(
    _END[0] if b in _ENDS else 0x20 if b in _SPACE else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
_BREAK, _TOKEN = re.compile(rb"[\x20\xff]"), re.compile(rb"\xff|[^\x20\xff]+")


def _tokens(text: bytes) -> list[bytes]:
    """Words and piece ends of plain text."""
    return text.replace(_END, b" \xff ").split()


def token_parts(texts: list[bytes], block: int, lead: int) -> Iterator[tuple[list[bytes], int]]:
    """Tokens of all texts in parts of about ``block`` bytes, with the number that the part owns.

    Up to ``lead`` tokens behind them only complete the windows of the owned ones.
    """
    data = _END.join(text.translate(_PLAIN) for text in texts)
    start = 0
    while start < len(data):
        end = start + block
        found = _BREAK.search(data, end) if end < len(data) else None
        end = found.start() if found else len(data)
        own = _tokens(data[start:end])
        behind = [m[0] for m in islice(_TOKEN.finditer(data, end), lead)]
        yield own + behind, len(own)
        start = end


def _numbered(tokens: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the tokens, and the distinct ones by number; 0 is the end of a piece."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    numbers[_END]
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    return ids, list(numbers)


def _by_language(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[str, list[bytes]]]:
    """Blocks of texts of one language."""
    for langs, texts in text_blocks(batches, block, "lang", "text"):
        groups: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, texts, strict=True):
            groups.setdefault(lang, []).append(text or b"")
        yield from groups.items()


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )


def _word_counts(texts: DataFrame, block: int) -> DataFrame:
    """(lang, word, n) per block; the empty word has the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, some in _by_language(batches, block):
            for tokens, own in token_parts(some, block, 0):
                ids, words = _numbered(tokens[:own])
                counts = np.bincount(ids, minlength=len(words))
                words[0], counts[0] = b"", own - counts[0]
                rows = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(rows, ["lang", "word", "n"])

    return texts.mapInArrow(run, "lang string, word string, n bigint")


def _bitmap(places: DataFrame) -> np.ndarray:
    """Bits at all ``place`` from 0 to 2^BITMAP_BITS - 1: an array of that size, whatever the input."""
    bits = places.select(F.shiftright("place", 15).alias("row"), F.col("place").bitwiseAND(32767).cast("int").alias("bit"))
    made = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for row in bits.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        made[row["row"] << 12 : (row["row"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    return made


def _is_set(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """64 bits for each word; the lower half is the checksum that Spark takes, too."""
    start = crc32(f"{lang}\n".encode())
    low = np.fromiter((crc32(w, start) for w in words), np.uint64, len(words))
    high = np.fromiter((crc32(w, ~start & 0xFFFFFFFF) for w in words), np.uint64, len(words))
    return low | high << np.uint64(32)


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed_ = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(7))
    mixed_ *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed_ ^ mixed_ >> np.uint64(31)).view(np.int64)


_PLACES = np.int64((1 << BITMAP_BITS) - 1)


class _Block:
    """Tokens as numbers of frequent words, 0 for other words and ends of pieces."""

    def __init__(self, lang: str, tokens: list[bytes], words_marked: np.ndarray):
        ids, words = _numbered(tokens)
        hashes = _hashes(lang, words)
        marked = _is_set(words_marked, (hashes & np.uint64(_PLACES)).astype(np.int64))
        marked[0] = False
        self.ids = np.where(marked, np.cumsum(marked), 0)[ids]
        self.hashes = np.concatenate([np.zeros(1, np.uint64), hashes[marked]])
        self.words = [b"", *(w for w, m in zip(words, marked, strict=True) if m)]
        #: Places with a frequent word before another one.
        self.pairs = np.flatnonzero((self.ids[:-1] > 0) & (self.ids[1:] > 0))

    def pair_hashes(self, at: np.ndarray) -> np.ndarray:
        return _pair_hashes(self.hashes[self.ids[at]], self.hashes[self.ids[at + 1]])

    def joined(self, pairs_marked: np.ndarray) -> np.ndarray:
        """Whether each token makes a frequent pair with the next one."""
        joined = np.zeros(len(self.ids), bool)
        joined[self.pairs] = _is_set(pairs_marked, self.pair_hashes(self.pairs) & _PLACES)
        return joined

    def triple_hashes(self, at: np.ndarray) -> np.ndarray:
        return _pair_hashes(self.pair_hashes(at).view(np.uint64), self.hashes[self.ids[at + 2]])


def _pair_counts(texts: DataFrame, words: Broadcast, block: int) -> DataFrame:
    """(pair, n) per block: neighbouring frequent words under 32 bits of their hash, half of what moves with 64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, some in _by_language(batches, block):
            for tokens, own in token_parts(some, block, 1):
                made = _Block(lang, tokens, words.value)
                at = made.pairs[made.pairs < own]
                _, first, counts = np.unique(
                    made.ids[at] * len(made.words) + made.ids[at + 1], return_index=True, return_counts=True
                )
                found = made.pair_hashes(at[first])
                for low in range(0, len(found), 500_000):
                    part = slice(low, low + 500_000)
                    pairs = pa.array(found[part].astype(np.int32))  # the lower half
                    yield pa.RecordBatch.from_arrays([pairs, pa.array(counts[part])], ["pair", "n"])

    return texts.mapInArrow(run, "pair int, n bigint")


def _triples(joined: np.ndarray) -> np.ndarray:
    """Places of the triples whose pairs are both frequent."""
    return np.flatnonzero(joined[:-1] & joined[1:])


def _triple_counts(texts: DataFrame, words: Broadcast, pairs: Broadcast, min_count: int, block: int) -> DataFrame:
    """(place_group, low, n): triples of frequent pairs at their places, lower bits and counts in one row for each group.

    Counts stop at ``min_count``: more is not asked for, and they stay one byte each.
    """
    kind, width = np.min_scalar_type(min_count).newbyteorder("<"), np.int64((1 << PLACE_BITS) - 1)

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        places, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([h[1] for h in held]), len(places))
        counts = np.minimum(counts, min_count).astype(kind)
        groups, first = np.unique(places >> GROUP_BITS, return_index=True)
        cuts, low = np.append(first, len(places)), (places & ((1 << GROUP_BITS) - 1)).astype("<u2")
        parts = [pa.array([c[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for c in (low, counts)]
        return pa.RecordBatch.from_arrays([pa.array(groups.astype(np.int32)), *parts], ["place_group", "low", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for lang, some in _by_language(batches, block):
            for tokens, own in token_parts(some, block, 2):
                made = _Block(lang, tokens, words.value)
                at = _triples(made.joined(pairs.value))
                held.append(np.unique(made.triple_hashes(at[at < own]) & width, return_counts=True))
                if sum(len(h[0]) for h in held) >= HELD_PLACES:
                    yield packed(held)
                    held = []
        if any(len(h[0]) for h in held):
            yield packed(held)

    return texts.mapInArrow(run, "place_group int, low binary, n binary")


def _frequent_places(counts: DataFrame, min_count: int) -> DataFrame:
    """(place) with ``min_count`` triples or more: a group is added up in 2^16 counters while its rows stream by."""
    kind = np.min_scalar_type(min_count).newbyteorder("<")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(group: int, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array((group << GROUP_BITS) + np.flatnonzero(sums >= min_count))], ["place"])

        now, sums = None, np.zeros(1 << GROUP_BITS, np.int64)
        for batch in batches:
            for group, low, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if group != now:
                    if now is not None:
                        yield finished(now, sums)
                    now, sums = group, np.zeros(1 << GROUP_BITS, np.int64)
                sums[np.frombuffer(low, "<u2")] += np.frombuffer(n, kind)  # a row has a place once
        if now is not None:
            yield finished(now, sums)

    rows = counts.repartition("place_group").sortWithinPartitions("place_group")
    return rows.mapInArrow(run, "place bigint")


def count_windows(
    ids: np.ndarray, own: int, most: int, joined: np.ndarray, tripled: np.ndarray | None = None
) -> tuple[list[np.ndarray], np.ndarray]:
    """Lead columns of the distinct padded windows that begin with an owned word, and their counts.

    ``ids`` has 0 where a window ends; ``joined`` says of each token whether a
    window goes on to the next, ``tripled`` whether one goes on to the next two.
    """
    tripled = np.ones(len(ids), bool) if tripled is None else tripled
    ids, joined, tripled = (np.concatenate([c, np.zeros(most, c.dtype)]) for c in (ids, joined, tripled))
    columns = [ids[:own]]
    for ahead in range(1, most):
        goes_on = (columns[-1] > 0) & joined[ahead - 1 : own + ahead - 1]
        if ahead > 1:
            goes_on &= tripled[ahead - 2 : own + ahead - 2]
        columns.append(np.where(goes_on, ids[ahead : own + ahead], 0))
    begins = columns[0] > 0
    columns = [c[begins] for c in columns]
    base = int(ids.max(initial=0)) + 1
    key, size = columns[0], base
    for column in columns[1:]:
        if size * base >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            size = len(distinct)
        key, size = key * base + column, size * base
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], counts


def _windows(
    texts: DataFrame, words: Broadcast, pairs: Broadcast, triples: Broadcast, most: int, block: int
) -> DataFrame:
    """(lang, bucket, phrases, counts): windows of frequent pairs and triples, one per line, by their first pair.

    Those of several blocks are counted together. No word has a line feed: it ends a piece.
    """

    def packed(held: list[pa.Table]) -> pa.RecordBatch:
        rows = _added(pa.concat_tables(held), "bucket", "lang", "phrase").sort_by([("bucket", "ascending"), ("lang", "ascending")])
        rows = rows.combine_chunks()
        bucket, langs = rows["bucket"].to_numpy(), rows["lang"].dictionary_encode().combine_chunks().indices.to_numpy()
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (langs[1:] != langs[:-1]))
        cuts = np.append(np.flatnonzero(new), rows.num_rows)
        phrases = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), rows["phrase"].combine_chunks())
        n = rows["n"].to_numpy().astype("<i8")
        counts = pa.array([n[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
        first = rows.take(pa.array(cuts[:-1])).combine_chunks()
        columns = [first["lang"].combine_chunks(), first["bucket"].combine_chunks(), pc.binary_join(phrases, "\n"), counts]
        return pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "phrases", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for lang, some in _by_language(batches, block):
            for tokens, own in token_parts(some, block, most - 1):
                made = _Block(lang, tokens, words.value)
                joined = made.joined(pairs.value)
                tripled, at = np.zeros(len(joined), bool), _triples(joined)
                tripled[at] = _is_set(triples.value, made.triple_hashes(at) & _PLACES)
                columns, counts = count_windows(made.ids, own, most, joined, tripled)
                longer = columns[1] > 0  # single words have been counted
                columns, counts = [c[longer] for c in columns], counts[longer]
                hashed = _pair_hashes(made.hashes[columns[0]], made.hashes[columns[1]]).view(np.uint64)
                bucket = (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
                kept = pa.array([None, *made.words[1:]], pa.binary()).cast(pa.string())
                parts = [kept.take(pa.array(c)) for c in columns]
                phrases = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
                rows = [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket), phrases, pa.array(counts)]
                held.append(pa.table(rows, ["lang", "bucket", "phrase", "n"]))
                if sum(h.num_rows for h in held) >= HELD_WINDOWS:
                    yield packed(held)
                    held = []
        if any(h.num_rows for h in held):
            yield packed(held)

    return texts.mapInArrow(run, "lang string, bucket int, phrases string, counts binary")


def _added(rows: pa.Table, *names: str) -> pa.Table:
    """Sums of ``n`` by ``names``."""
    found = rows.group_by(list(names), use_threads=False).aggregate([("n", "sum")])
    return found.select([*names, "n_sum"]).rename_columns([*names, "n"])


def _summed(windows: DataFrame) -> DataFrame:
    """(lang, phrase, n) of the distinct windows. A task adds up bucket by bucket."""

    def added(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        phrases = pc.split_pattern(rows["phrases"].combine_chunks(), "\n")
        langs = rows["lang"].combine_chunks().take(pc.list_parent_indices(phrases))
        n = pa.array(np.frombuffer(b"".join(rows["counts"].to_pylist()), "<i8"))
        yield from _added(pa.table([langs, phrases.flatten(), n], ["lang", "phrase", "n"]), "lang", "phrase").to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*held, batch])
            bucket = rows["bucket"].to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last one may go on
            if cut:
                yield from added(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
        if held:
            yield from added(pa.Table.from_batches(held))

    rows = windows.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "lang string, phrase string, n bigint")


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    most: int = MOST_WORDS,
    text_col: str = "text",
    lang_col: str = "lang",
    block: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases up to ``most`` words with ``min_count`` occurrences, and (lang, n)."""
    if most < 2:
        raise ValueError("a phrase has two words at least")
    texts = _texts(docs, text_col, lang_col)
    counts = _word_counts(texts, block).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = written(counts.filter((F.col("n") >= min_count) | (F.col("word") == "")))
    totals = written(counts.filter("word = ''").select("lang", "n"))
    low = (1 << BITMAP_BITS) - 1
    send = texts.sparkSession.sparkContext.broadcast
    checksum = F.crc32(F.encode(F.concat("lang", F.lit("\n"), "word"), "UTF-8"))
    words = send(_bitmap(counts.filter("word <> ''").select(checksum.bitwiseAND(low).alias("place"))))
    pairs = _pair_counts(texts, words, block).groupBy("pair").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    pairs = send(_bitmap(pairs.select(F.col("pair").bitwiseAND(low).alias("place"))))
    triples = _frequent_places(_triple_counts(texts, words, pairs, min_count, block), min_count)
    triples = send(_bitmap(triples.select(F.col("place").bitwiseAND(low).alias("place"))))
    names = [f"w{i + 1}" for i in range(most)]
    padded = [F.coalesce(F.get(F.split("phrase", " "), F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    windows = _summed(_windows(texts, words, pairs, triples, most, block)).select("lang", *padded, "n")
    summed = windows.rollup("lang", *names).agg(F.sum("n").alias("f"))
    # a prefix with padding is a window's end, not a phrase; null stands for columns that are summed up
    phrase = [F.coalesce(n, F.lit("-")) != "" for n in names]
    phrases = summed.filter((F.col("f") >= min_count) & F.col("w2").isNotNull())
    for part in phrase:
        phrases = phrases.filter(part)
    size = sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))
    phrases = phrases.select("lang", F.concat_ws(" ", *names).alias("phrase"), size.alias("size"), "f")
    single = counts.filter((F.col("word") != "") & (F.col("n") >= min_count))
    single = single.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("f"))
    return written(phrases.unionByName(single)), totals


#: Exact: the products take up to 38 digits.
_SCORE = (
    "CAST((CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0))) "
    "div (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0))) AS BIGINT)"
)


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of phrases of two words or more, by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = phrases.filter("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    )
    cuts = cuts.withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ")).withColumn(
        "rest", F.array_join(F.slice(words, F.col("cut") + 1, F.col("size") - F.col("cut")), " ")
    )
    cuts = lookup_join(cuts, phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = lookup_join(cuts, phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = lookup_join(cuts, totals, "lang").withColumn("score", F.expr(_SCORE))
    lowest = cuts.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    return lowest.select("lang", "phrase", "size", "a", "m.l", "m.r", "n", "m.score")


def not_covered(phrases: DataFrame, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, phrase) of phrases of two words or more that no longer one holds as often."""
    words = F.split("phrase", " ")
    sizes = F.sequence(F.lit(2), F.col("size") - 1)
    at = lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice(F.col("words"), i, m), " ")
    )
    longer = phrases.filter("size > 2").select("lang", "size", "f", words.alias("words"))
    parts = longer.select("lang", "f", F.explode(F.flatten(F.transform(sizes, at))).alias("phrase"))
    parts = parts.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    free = phrases.filter("size > 1").join(parts, ["lang", "phrase"], "left")
    return free.filter(F.coalesce(100 * F.col("most") < covered_percent * F.col("f"), F.lit(True))).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    most: int = MOST_WORDS,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
    text_col: str = "text",
    lang_col: str = "lang",
    block: int = BLOCK_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the lowest-scoring cut,
    ``n`` all words of the language; the score is 1000 a n / (l r), rounded down.
    """
    phrases, totals = frequent_phrases(docs, min_count, most, text_col, lang_col, block)
    found = scored(phrases, totals).join(not_covered(phrases, covered_percent), ["lang", "phrase"])
    # Spark keeps the first rows of each task before it shuffles, so a language is no large group
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
