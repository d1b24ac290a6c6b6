"""K-means with cosine similarity on sparse weights (term_id, doc_id, weight).

A *slot* is a centroid's place among all centroids scored together: the
cluster in a single run, ``restart * k + cluster`` when several runs share a
pass. The number of slots is a parameter of the run, never grows with the
data, and fixes the number of columns of the wide centroid table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot, norm
from .layout import ByDocument, bucket_number, bucketed, by_document, parted, store
from .scale import (
    below_broadcast_limit,
    hot_keys,
    in_parts,
    is_stored,
    lookup_join,
    table_bytes,
    with_parts,
    written,
    written_lookup,
    written_parts,
)

# Similarities are compared after rounding, so that the order in which a sum
# was added up cannot decide between equal clusters.
SIMILARITY_DIGITS = 9

# Fixed values of the reproducible start: multipliers and prime modulus.
_CLUSTER_STEP, _RANK_STEP, _SEED_STEP, _MODULUS = 7919, 104729, 15485863, 10007


def initial_centroids(
    vocabulary: DataFrame, k: int = 5, method: str = "uniform", seed: int = 0, restarts: int | None = None
) -> DataFrame:
    """``k`` random centroids over the column ``term_id`` of ``vocabulary``.

    "uniform" is integer arithmetic that any SQL engine repeats exactly;
    "hash" draws from a 64-bit hash of seed, cluster and term. Both give the
    same values however the rows are partitioned. With ``restarts`` the result
    has a column ``restart``, each with its own seed (``seed + restart``).
    """
    run = F.explode(F.sequence(F.lit(0), F.lit((restarts or 1) - 1))).alias("restart")
    grid = vocabulary.select("term_id", run)
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster"))
    seeds = F.lit(seed).cast("bigint") + F.col("restart")
    if method == "uniform":
        m = F.lit(_MODULUS).cast("bigint")
        rank = F.pmod("term_id", m)  # reduced first: the products stay far from overflow
        mixed = (F.col("cluster") + 1) * (rank + 1) * _CLUSTER_STEP + rank * rank * _RANK_STEP
        weight = F.pmod(mixed + F.pmod(seeds, m) * _SEED_STEP, m).cast("double") / float(_MODULUS)
    elif method == "hash":
        bits = F.shiftrightunsigned(F.xxhash64(seeds, "cluster", "term_id"), 11)
        weight = bits.cast("double") / float(1 << 53)
    else:
        raise ValueError(f"unknown method {method!r}")
    columns = ["cluster", "term_id", weight.alias("weight")]
    return grid.select(*([] if restarts is None else ["restart"]), *columns)


def document_centroids(weights: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` documents with different vectors, by id, as centroids.

    Vectors are told apart by a signature (the terms' hashes combined, and
    their number), so no vector is gathered in one place. ``weights`` is read
    twice and should be a written table with one row per term and document.
    """
    signature = [F.bit_xor(F.xxhash64("term_id", "weight")).alias("hash"), F.count(F.lit(1)).alias("n")]
    first = weights.groupBy("doc_id").agg(*signature).groupBy("hash", "n").agg(F.min("doc_id").alias("doc_id"))
    chosen = first.select("doc_id").orderBy("doc_id").limit(k)  # k rows from here on
    place = (F.row_number().over(Window.orderBy("doc_id")) - 1).alias("cluster")
    chosen = chosen.select("doc_id", place)
    return weights.join(F.broadcast(chosen), "doc_id").select("cluster", "term_id", "weight")


def lay_out(weights: DataFrame | ByDocument, triples: DataFrame | None = None) -> DataFrame:
    """``weights`` as a written table laid out by document, for repeated passes; its ``layout`` says how.

    Later joins and sums by document read their bucket and shuffle nothing.
    A table laid out before is returned as it is. ``triples``, a written table
    with the same terms and documents, spares writing the weights twice.
    """
    if isinstance(weights, ByDocument):
        made = store(weights)
    elif layout_of(weights) is not None:
        return weights
    else:
        made = by_document(weights.select("term_id", "doc_id", "weight"), triples)
    points = made.rows.select("term_id", "doc_id", "weight", "part")
    points.layout = made.having(points, made.stored, made.ready)
    return points


def layout_of(weights: DataFrame) -> ByDocument | None:
    """How a result of ``lay_out`` is laid out; None for any other table."""
    return getattr(weights, "layout", None)


class TermLayout:
    """The weights once more, bucketed by term, for centroids that are too large to broadcast.

    Made when the first such pass needs it and kept for the passes after it:
    hot terms are found once, and a pass joins bucket by bucket, so that only
    the centroids and the partial sums of documents move.
    """

    def __init__(self, points: DataFrame):
        self.points = points
        self.table: DataFrame | None = None
        self.hot: DataFrame | None = None

    def join(self, wide: DataFrame) -> DataFrame:
        """Weights with the row of ``wide`` for their term, or nulls."""
        if self.table is None:
            hot = hot_keys(self.points, ["term_id"])
            self.hot = None if hot is None else written_lookup(hot)
            rows = parted(self.points.select("term_id", "doc_id", "weight"), self.hot, "term_id", "doc_id")
            buckets = bucket_number(self.points.sparkSession, self.points.count())
            self.table = bucketed(rows.select("term_id", "doc_id", "weight", "part"), buckets, "term_id")
        if self.hot is None:
            wide = wide.withColumn("part", F.lit(0))
        else:
            wide = with_parts(wide, self.hot, ["term_id"])
            last = F.coalesce("_parts", F.lit(1)) - 1
            wide = wide.withColumn("part", F.explode(F.sequence(F.lit(0), last))).drop("_parts")
        return self.table.join(wide.hint("shuffle_hash"), ["term_id", "part"], "left").drop("part")


def _parts(documents: DataFrame, layout: ByDocument | None) -> DataFrame:
    """One row per document with the number of its ``parts``: 1, but for the documents that the layout lists."""
    if layout is None or layout.hot is None:
        return documents.withColumn("parts", F.lit(1))
    return with_parts(documents, layout.hot, ["doc_id"]).withColumn("parts", F.coalesce("_parts", F.lit(1))).drop("_parts")


def _score(
    weights: DataFrame,
    centroids: DataFrame,
    slots: int,
    by_term: TermLayout | None = None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Cosine of every document with every slot: (doc_id, parts, sims array).

    Centroids come as (slot, term_id, weight) and are turned to one row per
    term, so a weight row meets all of them in one join row and the sums are
    plain columns. The size of that table and the length of each centroid are
    taken while it is written. A similarity is null for a zero document or an
    empty slot. Centroids that outgrow a broadcast meet stored weights part by
    part, and the sums of the parts are added up; beyond that ``by_term`` is used.
    ``carry`` (doc_id, slots), the choice that led to these centroids, is
    handed on in the same row as ``own``.
    """
    w, slot = F.col("weight"), range(slots)
    column = [F.sum(F.when(F.col("slot") == s, w)).alias(f"c{s}") for s in slot]
    wide = centroids.groupBy("term_id").agg(*column)
    squared = {f"l{s}": F.sqrt(F.sum(F.col(f"c{s}") * F.col(f"c{s}"))) for s in slot}
    wide = written(wide, bytes=table_bytes(wide), **squared)
    lengths = [wide.observed[f"l{s}"] for s in slot]
    small = below_broadcast_limit(weights.sparkSession, wide.observed["bytes"])

    layout = layout_of(weights)
    sums = [F.sum(w * F.col(f"c{s}")).alias(f"d{s}") for s in slot]
    squares = F.sum(w * w).alias("sq")
    key = ["doc_id"]
    parts = None if small or (layout is None and not is_stored(weights)) else in_parts(weights, wide, "term_id", "left")
    if parts:
        place = ["doc_id"] if layout is None else ["doc_id", "part"]
        key = place if layout is not None and layout.hot is None else key
        both = [*(f"d{s}" for s in slot), "sq"]
        # one row per document and part of the terms is written
        scored = written_parts([joined.groupBy(*place).agg(*sums, squares) for joined in parts])
        scored = scored.groupBy(*key).agg(*[F.sum(c).alias(c) for c in both])
    elif by_term is not None and not small:
        # summed inside the buckets before the sums of a document move
        scored = by_term.join(wide).groupBy("doc_id").agg(*sums, squares)
    else:
        joined = lookup_join(weights, wide, "term_id", "left", stored=layout is not None and layout.stored, small=small)
        if layout is None:
            scored = joined.groupBy("doc_id").agg(*sums, squares)
        else:
            scored = joined.groupBy("doc_id", "part").agg(*sums, squares)
            if layout.hot is None:
                key = ["doc_id", "part"]  # part is 0: all of a document is in its bucket
            else:
                both = [*(f"d{s}" for s in slot), "sq"]
                scored = scored.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in both])
    # a document that shares no term with a slot has a null sum, not similarity null
    dots = [F.coalesce(f"d{s}", F.lit(0.0)) for s in slot]
    sims = [F.try_divide(dots[s], F.sqrt("sq") * F.lit(lengths[s]).cast("double")) for s in slot]
    scored = scored.select(*key, F.array(*sims).alias("sims"))
    own = []
    if carry is not None:
        # only the choices move, one row per document
        choices = carry.select("doc_id", *(F.lit(0).alias(c) for c in key[1:]), F.col("slots").alias("own"))
        scored, own = scored.join(choices.hint("shuffle_hash"), key), ["own"]
    return _parts(scored.select("doc_id", "sims", *own), layout).select("doc_id", "parts", "sims", *own)


def _closest(sims: list[Column], first: int = 0) -> Column:
    """Index of the greatest positive similarity, lowest index on ties, else 0; plus ``first``."""
    ranked = [
        F.when(sim > 0, F.struct(F.round(sim, SIMILARITY_DIGITS).alias("sim"), F.lit(-i).alias("minus")))
        for i, sim in enumerate(sims)
    ]
    return F.coalesce(-F.array_max(F.array(*ranked))["minus"], F.lit(0)) + first


def _choose(scores: DataFrame, k: int, restarts: int = 1) -> DataFrame:
    """The scores with the chosen slot of every document, one per restart, in the array ``slots``."""
    picks = [
        _closest([F.get("sims", F.lit(s)) for s in range(r * k, r * k + k)], first=r * k) for r in range(restarts)
    ]
    return scores.withColumn("slots", F.array(*picks))


def _means(weights: DataFrame, choices: DataFrame) -> DataFrame:
    """Mean of the raw vectors per slot: (slot, term_id, weight); empty slots are absent.

    Absent entries count as zero: sums are divided by the documents of the slot.
    """
    if layout_of(weights) is not None:
        places = choices.select("doc_id", "slots", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        # only the choices move; hashing them per bucket spares sorting the weights
        rows = weights.join(places.hint("shuffle_hash"), ["doc_id", "part"])
    else:
        flat = [F.get("slots", F.lit(0)).alias("slot")]  # single run
        rows = lookup_join(weights, choices.select("doc_id", *flat), "doc_id").withColumn("slots", F.array("slot"))
    rows = rows.select(F.explode("slots").alias("slot"), "term_id", "weight")
    sums = rows.groupBy("slot", "term_id").agg(F.sum("weight").alias("weight"))
    sizes = choices.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("size"))
    # one row per slot, a parameter: safe to broadcast
    return sums.join(F.broadcast(sizes), "slot").select(
        "slot", "term_id", (F.col("weight") / F.col("size")).alias("weight")
    )


def _losses(scores: DataFrame, k: int) -> DataFrame:
    """Sum of 1 - similarity to the document's ``own`` slot, per restart."""
    own = scores.select("sims", F.explode("own").alias("slot"))
    distance = 1 - F.coalesce(F.get("sims", F.col("slot")), F.lit(0.0))
    return own.groupBy(F.floor(F.col("slot") / k).cast("int").alias("restart")).agg(F.sum(distance).alias("loss"))


def similarities(weights: DataFrame, centroids: DataFrame, k: int = 5) -> DataFrame:
    """Cosine of each document with each of the clusters 0..k-1: (doc_id, cluster, similarity)."""
    scores = _score(weights, centroids.withColumnRenamed("cluster", "slot"), k)
    return scores.select("doc_id", F.posexplode("sims").alias("cluster", "similarity"))


def assign(weights: DataFrame, centroids: DataFrame, k: int = 5) -> DataFrame:
    """The closest cluster of each document: (doc_id, cluster).

    Only similarities above zero count; equal ones go to the lowest cluster;
    a document without any goes to cluster 0.
    """
    choices = _choose(_score(weights, centroids.withColumnRenamed("cluster", "slot"), k), k)
    return choices.select("doc_id", F.get("slots", F.lit(0)).alias("cluster"))


def _as_choices(classes: DataFrame, weights: DataFrame) -> DataFrame:
    return _parts(classes.select("doc_id", F.array("cluster").alias("slots")), layout_of(weights))


def update(weights: DataFrame, classes: DataFrame) -> DataFrame:
    """New centroids: the mean raw vector of each cluster that has documents."""
    plain = weights if is_stored(weights) or layout_of(weights) else weights.select("term_id", "doc_id", "weight")
    return _means(plain, _as_choices(classes, weights)).withColumnRenamed("slot", "cluster")


def loss(weights: DataFrame, classes: DataFrame, centroids: DataFrame, k: int = 5) -> DataFrame:
    """One row: sum over documents of 1 - cosine with the centroid of their class.

    A document or centroid of length zero counts with distance 1.
    """
    choices = _as_choices(classes, weights)
    scores = _score(weights, centroids.withColumnRenamed("cluster", "slot"), k, carry=choices)
    return _losses(scores, k).select("loss")


def cluster_top_terms(centroids: DataFrame, n: int = 10, by: list[str] | None = None) -> DataFrame:
    """The ``n`` heaviest terms of each cluster, equal weights in ascending term order.

    ``by`` adds further grouping columns (``iteration``, ``restart``). The rank
    filter is applied before the shuffle as well, so at most ``n`` rows per
    cluster and task move; for a large ``n`` it is applied to parts of a cluster.
    """
    keys = [*(by or []), "cluster"]
    spark = centroids.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        # Spark no longer cuts before the shuffle: cut parts of each cluster first
        part = F.pmod(F.xxhash64("term_id"), F.lit(max(2, spark.sparkContext.defaultParallelism))).alias("_part")
        centroids = centroids.select("*", part)
        first = Window.partitionBy(*keys, "_part").orderBy(F.desc("weight"), F.asc("term_id"))
        centroids = centroids.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= n)
    order = Window.partitionBy(*keys).orderBy(F.desc("weight"), F.asc("term_id"))
    ranked = centroids.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select(*keys, "rank", "term_id", "weight")


def collapsed_top_terms(centroids: DataFrame, n: int = 10, cumulative: bool = False) -> DataFrame:
    """Top terms in which equal weights share one place, held by the highest term.

    ``cumulative`` also lets each cluster show the terms of the clusters before
    it (in the text order of their numbers); the later cluster wins a shared
    weight. Both exist to compare with lists that were made that way.
    """
    single = centroids.groupBy("cluster", "weight").agg(F.max("term_id").alias("term_id"))
    top = cluster_top_terms(single, n)
    if not cumulative:
        return top
    # n rows per cluster are left, and a cluster can only lose rows to others
    top = written(top.select("cluster", "term_id", "weight"))
    all_clusters = top.agg(F.collect_set("cluster").alias("all")).scalar()
    text = F.col("cluster").cast("string")
    later = F.filter("all", lambda c: c.cast("string") >= text)
    shown = top.select("*", all_clusters.alias("all"))
    shown = shown.select("term_id", "weight", text.alias("source"), F.explode(later).alias("cluster"))
    shown = shown.groupBy("cluster", "weight").agg(F.max_by("term_id", "source").alias("term_id"))
    return cluster_top_terms(shown, n)


@dataclass
class KMeansRun:
    """Results of a run; every table has the column ``iteration``."""

    classes: DataFrame
    centroids: DataFrame
    loss: DataFrame
    top_terms: DataFrame


def _tagged(tables: list[DataFrame]) -> DataFrame:
    """Stack one table per pass under the column ``iteration``."""
    parts = [t.select(F.lit(i).alias("iteration"), "*") for i, t in enumerate(tables)]
    return reduce(DataFrame.unionByName, parts)


def kmeans_fit(
    weights: DataFrame,
    centroids: DataFrame,
    k: int = 5,
    iterations: int = 2,
    n_top: int = 10,
    triples: DataFrame | None = None,
) -> KMeansRun:
    """Assign, update, loss and top terms, each pass starting from the last centroids.

    The weights are laid out once (``triples`` as in ``lay_out``); a pass then moves only partial sums and one
    row per document. The scores against the new centroids give both this
    pass's loss and the next pass's classes, so each pass scores once, and
    writes them and the classes in one row per document.
    """
    points = lay_out(weights, triples)
    by_term = TermLayout(points)
    start = centroids.withColumnRenamed("cluster", "slot")
    state = written(_choose(_score(points, start, k, by_term), k))
    classes, centers, losses = [], [], []
    for _ in range(iterations):
        center = written(_means(points, state))
        classes.append(state.select("doc_id", F.get("slots", F.lit(0)).alias("cluster")))
        centers.append(center.withColumnRenamed("slot", "cluster"))
        # one row per document: its class so far, its similarities now, its next class
        state = written(_choose(_score(points, center, k, by_term, state), k))
        losses.append(written(_losses(state, k).select("loss")))
    all_centers = _tagged(centers)
    top = cluster_top_terms(all_centers, n_top, by=["iteration"])
    return KMeansRun(_tagged(classes), all_centers, _tagged(losses), top)


def kmeans_restarts(
    weights: DataFrame,
    vocabulary: DataFrame,
    k: int = 5,
    restarts: int = 2,
    method: str = "uniform",
    seed: int = 0,
    n_top: int = 10,
    triples: DataFrame | None = None,
) -> KMeansRun:
    """Independent one-step runs from fresh random centroids, all in one pass.

    Column ``iteration`` numbers the restarts; ``triples`` as in ``lay_out``.
    """
    points = lay_out(weights, triples)
    slot = (F.col("restart") * k + F.col("cluster")).alias("slot")
    start = initial_centroids(vocabulary, k, method, seed, restarts).select(slot, "term_id", "weight")
    by_term = TermLayout(points)
    state = written(_choose(_score(points, start, restarts * k, by_term), k, restarts))
    center = written(_means(points, state))
    losses = _losses(_score(points, center, restarts * k, by_term, state), k)

    run, cluster = F.floor(F.col("slot") / k).cast("int"), F.pmod("slot", F.lit(k))
    classes = state.select("doc_id", F.explode("slots").alias("slot"))
    classes = classes.select(run.alias("iteration"), "doc_id", cluster.alias("cluster"))
    centroids = center.select(run.alias("iteration"), cluster.alias("cluster"), "term_id", "weight")
    top = cluster_top_terms(centroids, n_top, by=["iteration"])
    return KMeansRun(classes, centroids, losses.withColumnRenamed("restart", "iteration"), top)


def _best_dense(rows: DataFrame, block: list[tuple[int, list[float]]], key: str) -> DataFrame:
    """``rows`` (key, vector, length, best) with ``best`` raised by a block of (cluster, unit vector)."""
    # parsed once when the plan is made, from text, in which a double keeps its value
    matrix = json.dumps([{"cluster": c, "unit": unit} for c, unit in block])
    table = F.from_json(F.lit(matrix), "array<struct<cluster:int,unit:array<double>>>")

    def ranked(center: Column) -> Column:
        similarity = F.try_divide(dot(center["unit"], F.col("vector")), F.col("length"))
        return F.struct(
            F.round(similarity, SIMILARITY_DIGITS).alias("rounded"),
            (-center["cluster"]).cast("bigint").alias("minus"),
            similarity.alias("similarity"),
        )

    best = F.array_max(F.filter(F.transform(table, ranked), lambda s: s["similarity"] > 0))
    return rows.select(key, "vector", "length", F.greatest("best", best).alias("best"))


def assign_dense(vectors: DataFrame, centroids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Closest cluster of dense vectors: (key, cluster, similarity).

    ``vectors`` has an array of doubles ``vector``; ``centroids`` has one row
    (cluster, vector) per cluster. The centroids, scaled to length one, are
    handed to every task in blocks of clusters below the broadcast limit, and
    the best of all blocks is kept. With one block the vectors are scanned once;
    each further block reads and writes them once more. They are never
    shuffled. A vector without a positive similarity gets cluster 0 and
    similarity 0.
    """
    spark = vectors.sparkSession
    sizes = {row.cluster: 8 * row.width + 16 for row in centroids.select("cluster", F.size("vector").alias("width")).collect()}
    blocks: list[list[int]] = [[]]
    for cluster in sorted(sizes):  # k rows, a parameter
        if blocks[-1] and not below_broadcast_limit(spark, sum(sizes[c] for c in [*blocks[-1], cluster])):
            blocks.append([])
        blocks[-1].append(cluster)
    scaled = centroids.select("cluster", "vector", norm(F.col("vector")).alias("length"))
    unit = scaled.select("cluster", F.transform("vector", lambda x: F.try_divide(x, F.col("length"))).alias("unit"))
    none = F.lit(None).cast("struct<rounded:double,minus:bigint,similarity:double>").alias("best")
    rows = vectors.select(key, "vector", norm(F.col("vector")).alias("length"), none)
    for number, block in enumerate(blocks):
        some = unit if len(blocks) == 1 else unit.filter(F.col("cluster").isin(block))
        found = [(r.cluster, r.unit) for r in some.collect()]  # a block: below the broadcast limit
        rows = _best_dense(written(rows) if number else rows, sorted(found), key)
    return rows.select(
        key,
        F.coalesce(-F.col("best.minus"), F.lit(0)).cast("int").alias("cluster"),
        F.coalesce("best.similarity", F.lit(0.0)).alias("similarity"),
    )
