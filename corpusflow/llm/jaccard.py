"""Jaccard similarity join on word shingles with prefix filters under several global orders.

For similarity t two sets of size n can only be similar if they share a token
among their first n - ceil(t n) + 1 tokens, in any order that is the same for
all sets. A pair is a candidate only if that holds under each of three orders.
All put rare tokens first and differ in a hash: one order alone would pass
pairs that happen to share one early token.

How rare a token is comes from a table of fixed size that all texts fill:
2^27 places with 4 bits, the logarithm of the number of occurrences there. A
place that was hit once means a token that no other text has. Tokens that meet
at a place look more frequent than they are, which changes the order but not
the result, as any global order is right. In corpora far larger than the table
no token is known to be unique, and a tenth of the tokens is shuffled.

Texts with equal sets are one class from the start and count once. Links are
looked for class by class, without making all pairs of a group:

1. A group is the texts that share a prefix token. They are compared with one
   of them, the leader: that with the fewest unique tokens, as copies of a text
   differ less from it than from each other. A text is near if its Jaccard
   distance to the leader is at most 2 (1 - t), linked if it is at most 1 - t.
   Most far texts are known without a comparison by their unique tokens.
2. Two near texts differ by their differences to the leader, less what these
   have in common. If that is nothing and the texts are similar, both are linked
   with the leader. So links between components are left only between texts
   whose differences share a token, and these are found by a prefix filter on
   the differences, rare tokens first: the text with the smaller difference
   probes as many tokens as it could have apart from the other, and one more.
3. Of the pairs with a far text those are left in which neither is linked with
   the leader: the distance is a metric, so a linked and a far text are more
   than 1 - t apart. These pairs are compared if their components differ.

No pair of similar texts in different components can escape these steps.
A pair of the later steps is compared only if it passes the filters on size,
unique tokens and the prefixes under the other orders; only then are the sets
joined.

Cases: null and empty texts have an empty set and are linked with nothing. A
text of one or two words is one token. Repeated rows get one row each, ids that
are repeated count as one document. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import fits_broadcast, lookup_join, written, written_lookup
from .common import addressed, forget, fresh, gather, text_blocks
from .components import components

PERCENT = 90
SHINGLE = 3
ORDERS = 3
#: Characters of text in a block.
BLOCK_CHARS = 1_000_000
#: The table of frequencies: 2^27 places in groups of 2^16, 64 MB at any size of the corpus.
PLACE_BITS, GROUP_BITS = 27, 16

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mix of each number; other salts give other orders."""
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, token) of the distinct shingles of each text, ordered by both."""
    coded = [t.encode("utf-8") for t in texts]
    data = _LOWER[np.frombuffer(b"\n" + b"\n".join(coded) + b"\n", np.uint8)]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    space = _SPACE[data]
    edges = np.diff(space.astype(np.int8))
    begin, end = np.flatnonzero(edges == -1) + 1, np.flatnonzero(edges == 1) + 1
    if not len(begin):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    # polynomial hash of each word: a difference of running sums, moved to power 0
    powers = np.full(len(data), _BASE)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * powers)])
    back = np.full(len(data), _BASE_INVERSE)
    back[0] = 1
    back = np.cumprod(back)[begin]
    words = mixed((sums[end] - sums[begin]) * back + (end - begin).astype(np.uint64))
    doc = np.searchsorted(np.cumsum(sizes), begin - 1, side="right")

    counts = np.bincount(doc, minlength=len(texts))
    n = len(words)
    tokens = words.copy()
    for step in range(1, shingle):
        ahead = np.zeros(n, np.uint64)
        ahead[: n - step] = words[step:]
        inside = np.zeros(n, bool)
        inside[: n - step] = doc[step:] == doc[: n - step]
        tokens = mixed(tokens * np.uint64(3) + np.where(inside, ahead, np.uint64(step)), step)
    # a shingle begins at a word with enough words behind it; a shorter text is one token
    first = np.cumsum(counts) - counts
    place = np.arange(n) - first[doc]
    begins = place <= np.maximum(counts[doc] - shingle, 0)
    doc, tokens = doc[begins], tokens[begins]
    order = np.lexsort((tokens, doc))
    doc, tokens = doc[order], tokens[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tokens[1:] != tokens[:-1])
    return doc[new].astype(np.int64), tokens[new]


def _sums(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of 64-bit values per text, with overflow."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(values)])
    ends = np.cumsum(np.bincount(doc, minlength=n))
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, sig_a, sig_b): equal sets have equal signatures of 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for ids, texts in text_blocks(batches, BLOCK_CHARS, "doc_id", "text"):
            doc, tokens = shingle_sets(texts, shingle)
            n = len(texts)
            size = np.bincount(doc, minlength=n).astype(np.int64)
            parts = [_signed(_sums(doc, mixed(tokens, salt), n)) for salt in (101, 102)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(size), *parts], ["doc_id", "n_shingles", "sig_a", "sig_b"]
            )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, sig_a bigint, sig_b bigint")


def _place(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(tokens, 7) >> np.uint64(64 - bits)).astype(np.int64)


def frequency_levels(docs: DataFrame, shingle: int = SHINGLE, place_bits: int = PLACE_BITS) -> Broadcast:
    """Table of 4-bit levels, two per byte: 0 for places hit at most once, else the bits of (hits - 1).

    Tasks send the places of their tokens, two bytes each, by group of places;
    a group is added up in 2^16 counters while its rows stream by. Only the
    finished table, whose size is fixed, goes to the driver.
    """
    groups, width = 1 << (place_bits - GROUP_BITS), 1 << GROUP_BITS

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for (texts,) in text_blocks(batches, BLOCK_CHARS, "text"):
            places = np.sort(_place(shingle_sets(texts, shingle)[1], place_bits))
            cuts = np.searchsorted(places >> GROUP_BITS, np.arange(groups + 1))
            low = (places & (width - 1)).astype("<u2")
            held = np.flatnonzero(np.diff(cuts))
            blobs = [low[cuts[g] : cuts[g + 1]].tobytes() for g in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.astype(np.int32)), pa.array(blobs, pa.binary())], ["place_group", "places"]
            )

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(group: int, counts: np.ndarray) -> pa.RecordBatch:
            level = np.minimum(np.ceil(np.log2(np.maximum(counts, 1))), 15).astype(np.uint8)
            packed = (level[0::2] | (level[1::2] << 4)).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([group], pa.int32()), pa.array([packed], pa.binary())], ["place_group", "packed"]
            )

        now, counts = None, np.zeros(width, np.int64)
        for batch in batches:
            for group, blob in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                if group != now:
                    if now is not None:
                        yield finished(now, counts)
                    now, counts = group, np.zeros(width, np.int64)
                counts += np.bincount(np.frombuffer(blob, "<u2"), minlength=width)
        if now is not None:
            yield finished(now, counts)

    rows = docs.select("text").mapInArrow(hits, "place_group int, places binary")
    rows = rows.repartition("place_group").sortWithinPartitions("place_group")
    table = np.zeros((groups, width // 2), np.uint8)
    for group, packed in rows.mapInArrow(levels, "place_group int, packed binary").collect():  # 64 MB at most
        table[group] = np.frombuffer(packed, np.uint8)
    return docs.sparkSession.sparkContext.broadcast(table.ravel())


_PREFIXES = (
    "doc_id bigint, n int, n_unique int, "
    + ", ".join(f"prefix_{i} array<bigint>" for i in range(ORDERS))
    + ", tokens binary"
)


def _level(table: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    place = _place(tokens, (2 * len(table)).bit_length() - 1)
    return (table[place >> 1] >> ((place & 1) << 2).astype(np.uint8)) & 15


def prefixes(docs: DataFrame, levels: Broadcast, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Texts that can be in a pair: their prefixes without unique tokens, and their sets.

    A text whose prefix has only unique tokens under some order has no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        table = levels.value
        for ids, texts in text_blocks(batches, BLOCK_CHARS, "doc_id", "text"):
            doc, tokens = shingle_sets(texts, shingle)
            size = np.bincount(doc, minlength=len(texts)).astype(np.int64)
            first = np.cumsum(size) - size
            level = _level(table, tokens)
            length = size - (percent * size + 99) // 100 + 1
            unique = np.bincount(doc[level == 0], minlength=len(texts))
            chosen = []
            for salt in range(ORDERS):
                order = np.lexsort((mixed(tokens, salt), level, doc))
                rank = np.arange(len(order)) - first[doc[order]]
                inside = (rank < length[doc[order]]) & (level[order] > 0)
                chosen.append(order[inside])
            held = [np.bincount(doc[c], minlength=len(texts)) for c in chosen]
            use = np.flatnonzero(np.minimum.reduce(held) > 0)
            if not len(use):
                continue
            columns = [pa.array([ids[i] for i in use], pa.int64()), pa.array(size[use].astype(np.int32))]
            columns.append(pa.array(unique[use].astype(np.int32)))
            for c, h in zip(chosen, held, strict=True):
                flat = gather(tokens[c].view(np.int64), (np.cumsum(h) - h)[use], h[use])
                columns.append(_lists(flat, h[use]))
            sets = [tokens[first[i] : first[i] + size[i]].astype("<u8").tobytes() for i in use]
            columns.append(pa.array(sets, pa.binary()))
            names = ["doc_id", "n", "n_unique", *(f"prefix_{i}" for i in range(ORDERS)), "tokens"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, _PREFIXES)


def _lists(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _with_tokens(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    tokens = sets.select("doc_id", "tokens")
    for side in ("a", "b"):
        pairs = pairs.join(tokens.select(F.col("doc_id").alias(side), F.col("tokens").alias(f"t_{side}")), side)
    return pairs.select("a", "b", "t_a", "t_b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that are similar.

    First the prefixes under the other orders must meet; the sets of the pairs
    that are left are joined and compared. ``sets`` has one row per text.
    """
    others = [f"prefix_{i}" for i in range(1, ORDERS)]
    for side in ("a", "b"):
        named = sets.select(F.col("doc_id").alias(side), *[F.col(o).alias(f"{o}_{side}") for o in others])
        pairs = pairs.join(named, side)
    for o in others:
        pairs = pairs.filter(F.arrays_overlap(f"{o}_a", f"{o}_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            good = []
            for x, y in zip(batch.column("t_a"), batch.column("t_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return _with_tokens(written(pairs.select("a", "b")), sets).mapInArrow(run, "a bigint, b bigint")


_MEASURED = "a bigint, b bigint, linked boolean, near boolean, n int, d int, own int, difference array<bigint>"


def measured(pairs: DataFrame, sets: DataFrame, levels: Broadcast, percent: int = PERCENT) -> DataFrame:
    """Texts ``b`` compared with leaders ``a``: whether they are linked or near, and of near ones the difference.

    ``d`` is the size of the difference. ``own`` of its tokens are unique to
    ``b``, so no other difference has them; ``difference`` are the rest, first
    those of ``b``, rare ones first, then those of the leader, where its unique
    tokens, which all others lack, come last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        table = levels.value

        for batch in batches:
            linked, near, size, total, own, rest = [], [], [], [], [], []
            for x, y in zip(batch.column("t_a"), batch.column("t_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                mine, lacking = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                both = len(y) - len(mine)
                union = len(x) + len(y) - both
                linked.append(100 * both >= percent * union)
                near.append(100 * both >= (2 * percent - 100) * union)
                size.append(len(y))
                total.append(len(mine) + len(lacking))
                level, missing = _level(table, mine), _level(table, lacking)
                own.append(int((level == 0).sum()))
                mine, level = mine[level > 0], level[level > 0]
                mine = mine[np.lexsort((mine, level))]
                lacking = lacking[np.lexsort((lacking, missing == 0))]
                rest.append(np.concatenate([mine, lacking]).view(np.int64) if near[-1] else None)
            columns = [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(near, pa.bool_())]
            columns += [pa.array(c, pa.int32()) for c in (size, total, own)]
            columns.append(pa.array(rest, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "linked", "near", "n", "d", "own", "difference"])

    return _with_tokens(pairs, sets).mapInArrow(run, _MEASURED)


def _can_reach(percent: int) -> Column:
    """Whether texts x and y can be this similar: unique tokens are in no other text."""
    common = F.least(F.col("n_x") - F.col("unique_x"), F.col("n_y") - F.col("unique_y"))
    return (100 + percent) * common >= percent * (F.col("n_x") + F.col("n_y"))


def _differing(near: DataFrame, percent: int) -> DataFrame:
    """Step 2: pairs (a, b) of near texts in different components whose differences share a token."""
    apart = near.groupBy("a").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    near = written(near.join(written(apart.filter("low < high").select("a")), "a"))
    # similar texts differ by at most this part of the sum of their sizes
    most = lambda n: F.floor(F.lit(100 - percent) * n / F.lit(100 + percent))
    half = F.floor(most(F.col("n") + F.col("n") * 100 / percent) / 2).cast("int") + 1
    probes = F.slice("difference", F.lit(1), F.greatest(half - F.col("own"), F.lit(0)))
    sides = [
        near.select("a", *[F.col(c).alias(f"{c}_{s}") for c in ("b", "n", "d", "component")], F.explode(t).alias("token"))
        for s, t in (("x", probes), ("y", F.col("difference")))
    ]
    left = sides[0].join(sides[1], ["a", "token"]).filter(
        (F.col("component_x") != F.col("component_y"))
        & (F.struct("d_x", "b_x") < F.struct("d_y", "b_y"))
        & (F.col("d_y") - F.col("d_x") <= most(F.col("n_x") + F.col("n_y")))
        & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y"))
    )
    return left.select(F.least("b_x", "b_y").alias("a"), F.greatest("b_x", "b_y").alias("b"))


def _far_pairs(rows: DataFrame, found: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Step 3: pairs (a, b) of a group, not both near and none linked with the leader, in different components."""
    known = found.select("a", F.col("b").alias("doc_id"), "linked", "near")
    member = rows.filter("a <> doc_id").join(known, ["a", "doc_id"], "left").filter("linked IS NULL OR NOT linked")
    member = member.join(label.withColumnRenamed("b", "doc_id"), "doc_id", "left").select(
        "token", "doc_id", "n", F.col("n_unique").alias("unique"), F.coalesce("near", F.lit(False)).alias("near"),
        F.coalesce("component", "doc_id").alias("component"),
    )
    member = written(member)
    several = member.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    member = written(member.join(written(several.filter("low < high").select("token")), "token"))
    sides = [
        member.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "n", "unique", "near", "component")])
        for s in ("x", "y")
    ]
    left = sides[0].join(sides[1], "token").filter(
        (F.col("doc_id_x") < F.col("doc_id_y"))
        & (F.col("component_x") != F.col("component_y"))
        & ~(F.col("near_x") & F.col("near_y"))
        & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y"))
        & _can_reach(percent)
    )
    return left.select(F.col("doc_id_x").alias("a"), F.col("doc_id_y").alias("b"))


def linked_classes(sets: DataFrame, levels: Broadcast, percent: int = PERCENT) -> DataFrame:
    """(node, component) of the classes that have links. ``sets`` has one row per text."""
    rows = sets.select("doc_id", "n", "n_unique", F.explode("prefix_0").alias("token"))
    # counted first: tokens that one text has in its prefix make no group
    leader = F.min(F.struct("n_unique", "doc_id", "n")).alias("leader")
    groups = rows.groupBy("token").agg(F.count(F.lit(1)).alias("size"), leader).filter("size > 1")
    groups = groups.select("token", F.col("leader.doc_id").alias("a"), F.col("leader.n").alias("n_x"), F.col("leader.n_unique").alias("unique_x"))
    rows = written(rows.join(written(groups), "token"))
    near = 2 * percent - 100
    pairs = rows.withColumnsRenamed({"n": "n_y", "n_unique": "unique_y"}).filter("a <> doc_id")
    pairs = pairs.filter((100 * F.least("n_x", "n_y") >= near * F.greatest("n_x", "n_y")) & _can_reach(near))
    pairs = written(pairs.select("a", F.col("doc_id").alias("b")).distinct())
    found = written(measured(pairs, sets, levels, percent))
    links = found.filter("linked").select("a", "b")
    first = written(components(links))

    label = first.select(F.col("node").alias("b"), "component")
    members = found.filter("near").join(label, "b", "left").withColumn("component", F.coalesce("component", "b"))
    left = _differing(written(members), percent).unionByName(_far_pairs(rows, found, label, percent)).distinct()
    more = written(verified(written(left), sets, percent))
    return first if more.isEmpty() else written(components(links.unionByName(more)))


def similar_groups(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, place_bits: int = PLACE_BITS, unique: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs`` (doc_id, text).

    ``unique`` says that no id is repeated, which spares moving the sets to drop repetitions.
    """
    docs = docs.select("doc_id", "text")
    sizes = written(signatures(docs, shingle))
    key = ["n_shingles", "sig_a", "sig_b"]
    classes = written(sizes.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("first")))
    levels = frequency_levels(docs, shingle, place_bits)
    # one text of each class, and one row of it
    chosen = classes.select(F.col("first").alias("doc_id")).distinct()
    sets = prefixes(docs, levels, percent, shingle).join(chosen, "doc_id", "left_semi")
    sets = sets if unique else sets.dropDuplicates(["doc_id"])
    found = linked_classes(written(sets), levels, percent)
    levels.unpersist()
    labels = classes.join(found.withColumnRenamed("node", "first"), "first", "left")
    labels = written(labels.select(*key, F.coalesce("component", "first").alias("component_id")))
    # one row stands against all copies of a text: AQE splits a class with very many
    return sizes.join(labels, key, "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id, of several such rows one.

    Rows are compared under numbers of their own, so an id may stand for several
    texts. A null id is greater than any; rows without words stay.
    """
    row = fresh(docs, "_number")
    placed = addressed(docs, row)
    groups = similar_groups(placed.select(F.col(row).alias("doc_id"), "text"), percent, shingle, unique=True)
    groups = written(groups.filter("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id"))
    # rows of components with several members, with their ids
    many = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("component_id")
    members = written(lookup_join(groups, written_lookup(many), "component_id", "left_semi", stored=True))
    named = lookup_join(placed.select(row, F.col("doc_id").alias("_id")), members, row, small=fits_broadcast(members))
    named = written(named)
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", row))
    stays = named.groupBy("component_id").agg(first.alias("_first")).select("component_id", F.col("_first")[row].alias("_stays"))
    gone = lookup_join(named, written_lookup(stays), "component_id", stored=True).filter(F.col(row) != F.col("_stays"))
    gone = written_lookup(gone.select(row))
    return lookup_join(placed, gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
