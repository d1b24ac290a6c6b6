"""Weights, vectors and K-means on small invented tables."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corpusflow import sinks, sources
from corpusflow.operators import clustering, scale, vectors, weights

TRIPLES = "term_id bigint, doc_id bigint, freq bigint"
WEIGHTS = "term_id bigint, doc_id bigint, weight double"
CENTROIDS = "cluster int, term_id bigint, weight double"
CLASSES = "doc_id bigint, cluster int"


def close(actual, expected, tolerance=1e-12):
    assert [r[:-1] for r in actual] == [r[:-1] for r in expected]
    for a, e in zip(actual, expected):
        assert a[-1] == pytest.approx(e[-1], abs=tolerance)


@pytest.fixture(scope="module")
def points(spark):
    """Sixty random documents over forty terms; document 0 has every term."""
    rng = random.Random(5)
    data = [(t, d, rng.random()) for d in range(60) for t in range(1, 41) if d == 0 or rng.random() < 0.2]
    return scale.written(spark.createDataFrame(data, WEIGHTS).repartition(4))


@pytest.fixture(scope="module")
def start(spark, points):
    return scale.written(clustering.initial_centroids(points.select("term_id").distinct(), 4))


class Brute:
    """The same definitions on Python dictionaries."""

    def __init__(self, points, k):
        self.docs = {}
        for t, d, w in points.collect():
            self.docs.setdefault(d, {})[t] = w
        self.k = k

    @staticmethod
    def cosine(a, b):
        dot = sum(w * b.get(t, 0.0) for t, w in a.items())
        size = math.sqrt(sum(w * w for w in a.values())) * math.sqrt(sum(w * w for w in b.values()))
        return dot / size if size else None

    def assign(self, centers):
        classes = {}
        for d, vector in self.docs.items():
            best, classes[d] = 0.0, 0
            for c in range(self.k):
                sim = self.cosine(vector, centers[c]) if c in centers else None
                if sim is not None and sim > best:
                    best, classes[d] = sim, c
        return classes

    def update(self, classes):
        centers = {}
        for c in set(classes.values()):
            members = [self.docs[d] for d in classes if classes[d] == c]
            found = {t for m in members for t in m}
            centers[c] = {t: sum(m.get(t, 0.0) for m in members) / len(members) for t in found}
        return centers

    def loss(self, classes, centers):
        return sum(1 - (self.cosine(v, centers[classes[d]]) or 0.0) for d, v in self.docs.items())


def as_centers(df):
    centers = {}
    for c, t, w in df.select("cluster", "term_id", "weight").collect():
        centers.setdefault(c, {})[t] = w
    return centers


def flat(centers):
    return sorted((c, t, w) for c, vector in centers.items() for t, w in vector.items())


def test_term_in_every_document_weighs_nothing(spark):
    triples = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (2, 1, 2)], TRIPLES)
    found = rows(weights.tf_idf(triples), "term_id", "doc_id", "weight")
    close(found, [(1, 1, 0.0), (1, 2, 0.0), (2, 1, 0.5 * math.log(2))])


def test_fewer_documents_than_df(spark):
    triples = spark.createDataFrame([(1, d, 1) for d in range(4)], TRIPLES)
    assert weights.idf(triples, n_docs=2).first()["idf"] == pytest.approx(math.log(0.5))


def test_repeated_triples(spark):
    """Two equal rows count twice in df and length, and their weights add up."""
    triples = spark.createDataFrame([(1, 1, 2), (1, 1, 2), (2, 1, 4), (3, 2, 1)], TRIPLES)
    expected = [(1, 1, 0.5 * math.log(2 / 2)), (2, 1, 0.5 * math.log(2)), (3, 2, math.log(2))]
    close(rows(weights.tf_idf(triples), "term_id", "doc_id", "weight"), expected)


def test_sum_weights(spark):
    data = spark.createDataFrame([(1, 1, 0.5), (1, 1, 0.25), (2, 1, 1.0)], WEIGHTS)
    assert rows(weights.sum_weights(data)) == [(1, 1, 0.75), (2, 1, 1.0)]


def test_term_shares_sum_to_one(spark, sf_dir):
    from corpusflow.plans.queries import _kept

    kept = _kept(spark, sf_dir)[0].rows
    shares = kept.join(weights.doc_length(kept), "doc_id").selectExpr("doc_id", "freq / n_terms AS share")
    worst = shares.groupBy("doc_id").sum("share").selectExpr("max(abs(1 - `sum(share)`)) AS e").first()["e"]
    assert worst < 1e-9


def test_tf_idf_with_salted_joins(spark, settings):
    rng = random.Random(3)
    data = [(t, d, rng.randint(1, 5)) for t in range(1, 30) for d in range(40) if t < 3 or d < 2 or rng.random() < 0.1]
    triples = scale.written(spark.createDataFrame(data, TRIPLES))
    wide = rows(weights.tf_idf(triples, unique_input=True), "term_id", "doc_id", "weight")
    settings(broadcastBytes=0, hotRows=8)
    for unique in (True, False):
        close(rows(weights.tf_idf(triples, unique_input=unique), "term_id", "doc_id", "weight"), wide)


@pytest.mark.parametrize("block_terms", [1, 2, 3, 100])
@pytest.mark.parametrize("limit", [0, 10**6])
def test_dense_vectors(spark, settings, block_terms, limit):
    settings(broadcastBytes=limit)
    data = [(5, 1, 0.5), (9, 1, 0.25), (2, 2, 1.0), (7, 2, 2.0), (3, 2, 8.0), (3, 11, 1.0)]
    points = scale.written(spark.createDataFrame(data, WEIGHTS))
    vocabulary = spark.createDataFrame([(t,) for t in (2, 5, 7, 9, 11)], "term_id bigint")
    dense = vectors.to_dense_vectors(points, vocabulary, block_terms)
    found = {}
    for r in sorted(dense.collect(), key=lambda r: r.block):
        assert len(r.vector) <= block_terms
        found.setdefault(r.doc_id, []).extend((e.term_id, e.weight) for e in r.vector)
    assert found == {
        1: [(2, 0.0), (5, 0.5), (7, 0.0), (9, 0.25), (11, 0.0)],
        2: [(2, 1.0), (5, 0.0), (7, 2.0), (9, 0.0), (11, 0.0)],
        11: [(t, 0.0) for t in (2, 5, 7, 9, 11)],  # without a term of the vocabulary
    }


def test_top_terms_for_any_number(spark):
    data = [(c, t, float((t * 7919) % 997)) for c in range(2) for t in range(3000)]
    centroids = spark.createDataFrame(data, "cluster int, term_id bigint, weight double")
    found = rows(clustering.cluster_top_terms(centroids, 1500), "cluster", "rank", "term_id")
    order = sorted(range(3000), key=lambda t: (-float((t * 7919) % 997), t))[:1500]
    assert found == [(c, r + 1, t) for c in range(2) for r, t in enumerate(order)]


def test_numbers_with_several_files_per_task(spark):
    words = spark.createDataFrame([(f"w{i:05d}",) for i in range(3000)], "term string")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        found = rows(scale.numbered(words, "term", "term_id"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert found == [(f"w{i:05d}", i + 1) for i in range(3000)]


def test_equal_rows_of_a_hot_key_are_dealt_out(spark, settings):
    settings(hotRows=100)
    tokens = scale.written(spark.createDataFrame([("the",)] * 900 + [(f"w{i}",) for i in range(100)], "term string"))
    stop = scale.written(spark.createDataFrame([("w3",)], "term string"))
    left = scale.salted_join(tokens, stop, ["term"], "left_anti")
    assert left.count() == 999
    parts = left.select("term", F.spark_partition_id().alias("p")).filter("term = 'the'").distinct().count()
    assert parts > 1


def test_vectors_over_several_lines(spark, tmp_path, start):
    path = str(tmp_path / "blocks")
    sinks.write_lines(sinks.centroid_lines(start, entries_per_line=1), path)
    assert spark.read.text(path).count() > start.select("cluster").distinct().count()
    assert rows(sources.read_centroids(spark, path)) == rows(start)


def test_vector_text_round_trip(spark, tmp_path, points, start):
    path = str(tmp_path / "v")
    sinks.write_lines(sinks.vector_lines(vectors.sparse_vectors(points)), path)
    assert rows(sources.read_vectors(spark, path)) == rows(points)
    path = str(tmp_path / "c")
    sinks.write_lines(sinks.centroid_lines(start), path)
    assert rows(sources.read_centroids(spark, path)) == rows(start)


def test_top_terms_text_round_trip(spark, tmp_path, start):
    path = str(tmp_path / "t")
    top = clustering.cluster_top_terms(start, 3)
    sinks.write_lines(sinks.top_term_lines(top), path)
    assert all(r.value.endswith(",") for r in spark.read.text(path).collect())
    assert rows(sources.read_top_terms(spark, path)) == rows(top, "cluster", "rank", "term_id")


@pytest.mark.parametrize("method", ["uniform", "hash"])
def test_initial_centroids(spark, method):
    terms = spark.createDataFrame([(t,) for t in (1, 2, 10**15, 9 * 10**18)], "term_id bigint")
    found = rows(clustering.initial_centroids(terms, 3, method, seed=4))
    assert len(found) == 12 and all(0 <= w < 1 for *_, w in found)
    assert rows(clustering.initial_centroids(terms.repartition(3), 3, method, seed=4)) == found
    runs = clustering.initial_centroids(terms, 3, method, seed=3, restarts=2)
    assert rows(runs.filter("restart = 1").drop("restart")) == found


def test_document_centroids(spark):
    """Copies of a document are skipped, also when they are in the majority."""
    data = [(t, d, w) for d in range(3, 30) for t, w in [(1, 0.5), (2, 0.25)]]
    data += [(1, 40, 0.25), (2, 40, 0.5), (1, 50, 0.5), (9, 60, 1.0)]
    found = rows(clustering.document_centroids(spark.createDataFrame(data, WEIGHTS), 3))
    assert found == [(0, 1, 0.5), (0, 2, 0.25), (1, 1, 0.25), (1, 2, 0.5), (2, 1, 0.5)]


def test_one_pass_against_brute_force(spark, points, start):
    brute = Brute(points, 4)
    classes = clustering.assign(points, start, 4)
    expected = brute.assign(as_centers(start))
    assert dict(rows(classes)) == expected
    centers = scale.written(clustering.update(points, scale.written(classes)))
    close(rows(centers), flat(brute.update(expected)))
    found = clustering.loss(points, classes, centers, 4).first()["loss"]
    assert found == pytest.approx(brute.loss(expected, brute.update(expected)), abs=1e-9)
    assert found >= 0


@pytest.mark.parametrize("limits", [{}, {"broadcastBytes": 0, "hotRows": 10}])
def test_fit_against_brute_force(spark, settings, points, start, limits):
    """Also with every lookup shuffled and the larger documents cut into parts."""
    settings(**limits)
    brute, centers = Brute(points, 4), as_centers(start)
    run = clustering.kmeans_fit(points, start, 4, iterations=3)
    for i in range(3):
        classes = brute.assign(centers)
        centers = brute.update(classes)
        this = f"iteration = {i}"
        assert dict(rows(run.classes.filter(this), "doc_id", "cluster")) == classes
        close(rows(run.centroids.filter(this), "cluster", "term_id", "weight"), flat(centers))
        loss = run.loss.filter(this).first()["loss"]
        assert loss == pytest.approx(brute.loss(classes, centers), abs=1e-9)


def test_hot_document_is_cut(spark, settings, points):
    settings(hotRows=10)
    laid = clustering.lay_out(points)
    assert rows(laid.filter("doc_id = 0").select("part").distinct()) == [(0,), (1,), (2,), (3,)]
    assert rows(laid, "term_id", "doc_id", "weight") == rows(points)


def test_laid_out_passes_do_not_shuffle_weights(spark, points, start, capsys):
    laid = clustering.lay_out(points, points)
    slots = start.withColumnRenamed("cluster", "slot")
    scores = scale.written(clustering._score(laid, slots, 4))
    means = clustering._means(laid, clustering._choose(scores, 4))
    capsys.readouterr()
    means.explain()
    plan = capsys.readouterr().out.splitlines()
    at = next(i for i, line in enumerate(plan) if "ShuffledHashJoin" in line)
    left = plan[at + 1 : next(i for i, line in enumerate(plan) if i > at and "Exchange" in line)]
    assert any("Bucketed: true" in line for line in left)


def test_restarts_against_brute_force(spark, points):
    terms = points.select("term_id").distinct()
    run = clustering.kmeans_restarts(points, terms, k=3, restarts=3, method="hash", seed=11)
    brute = Brute(points, 3)
    for r in range(3):
        begin = as_centers(clustering.initial_centroids(terms, 3, "hash", seed=11 + r))
        classes = brute.assign(begin)
        centers = brute.update(classes)
        this = f"iteration = {r}"
        assert dict(rows(run.classes.filter(this), "doc_id", "cluster")) == classes
        close(rows(run.centroids.filter(this), "cluster", "term_id", "weight"), flat(centers))
        assert run.loss.filter(this).first()["loss"] == pytest.approx(brute.loss(classes, centers), abs=1e-9)


def test_assign_edge_cases(spark):
    """No shared term, opposite direction, zero vector and a tie."""
    data = [(1, 1, 1.0), (9, 2, 1.0), (2, 3, -1.0), (1, 4, 0.0), (2, 5, 2.0), (3, 5, 2.0)]
    points = spark.createDataFrame(data, WEIGHTS)
    centers = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.0), (2, 2, 3.0), (3, 3, 5.0)], CENTROIDS)
    assert rows(clustering.assign(points, centers, 5)) == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 2)]


def test_zero_document_and_empty_cluster(spark):
    points = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.0)], WEIGHTS)
    classes = spark.createDataFrame([(1, 2), (2, 0)], CLASSES)
    centers = clustering.update(points, classes)
    assert rows(centers) == [(0, 1, 0.0), (2, 1, 1.0)]  # 1, 3 and 4 have no documents
    assert clustering.loss(points, classes, centers).first()["loss"] == pytest.approx(1.0)


def test_zeros_count_in_the_mean(spark):
    points = spark.createDataFrame([(1, 1, 1.0), (2, 2, 4.0)], WEIGHTS)
    classes = spark.createDataFrame([(1, 0), (2, 0)], CLASSES)
    assert rows(clustering.update(points, classes)) == [(0, 1, 0.5), (0, 2, 2.0)]


def test_top_terms_variants(spark):
    data = [(0, 1, 5.0), (0, 2, 5.0), (0, 3, 1.0), (1, 4, 5.0), (1, 5, 3.0), (10, 6, 4.0)]
    centers = spark.createDataFrame(data, CENTROIDS)

    def listed(top):
        found = {}
        for c, _, t in rows(top, "cluster", "rank", "term_id"):
            found.setdefault(c, []).append(t)
        return found

    assert listed(clustering.cluster_top_terms(centers, 2)) == {0: [1, 2], 1: [4, 5], 10: [6]}
    assert listed(clustering.collapsed_top_terms(centers, 2)) == {0: [2, 3], 1: [4, 5], 10: [6]}
    # text order of the clusters: 0, 1, 10
    cumulative = clustering.collapsed_top_terms(centers, 3, cumulative=True)
    assert listed(cumulative) == {0: [2, 3], 1: [4, 5, 3], 10: [4, 6, 5]}


def test_dense_assignment_equals_sparse(spark, points):
    dense = vectors.to_dense_vectors(points)
    arrays = dense.selectExpr("doc_id", "transform(vector, e -> e.weight) AS vector")
    begin = clustering.initial_centroids(points.select("term_id").distinct(), 4)
    table = vectors.sparse_vectors(begin, "cluster").selectExpr("cluster", "transform(vector, e -> e.weight) AS vector")
    found = clustering.assign_dense(arrays, table)
    assert rows(found, "doc_id", "cluster") == rows(clustering.assign(points, begin, 4))
    sims = clustering.similarities(points, begin, 4).groupBy("doc_id").agg({"similarity": "max"})
    close(rows(found, "doc_id", "similarity"), rows(sims))


def test_dense_edge_cases(spark, settings):
    """Opposite direction, zero vector and a tie of equal directions."""
    data = [(1, [-1.0, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 2.0])]
    arrays = spark.createDataFrame(data, "doc_id bigint, vector array<double>")
    centers = [(1, [1.0, 0.0]), (2, [3.0, 3.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])]
    table = spark.createDataFrame(centers, "cluster int, vector array<double>")
    close(rows(clustering.assign_dense(arrays, table)), [(1, 0, 0.0), (2, 0, 0.0), (3, 2, 1.0)])
    settings(broadcastBytes=0)  # a block for each cluster
    close(rows(clustering.assign_dense(arrays, table)), [(1, 0, 0.0), (2, 0, 0.0), (3, 2, 1.0)])


def test_iterations_sink(spark, tmp_path, points, start):
    run = clustering.kmeans_fit(points, start, 4, iterations=2)
    path = str(tmp_path / "run")
    tables = {"classes": run.classes, "loss": run.loss, "top_terms": run.top_terms}
    sinks.write_iterations(tables, path)
    sinks.write_iterations(tables, path)
    back = spark.read.parquet(f"{path}/classes")
    assert rows(back, "iteration", "doc_id", "cluster") == rows(run.classes)


def test_partition_count_does_not_matter(spark, points, start):
    """One task or eight: the same classes and the same centers up to rounding."""
    one = clustering.kmeans_fit(points.coalesce(1), start, 4)
    many = clustering.kmeans_fit(points.repartition(8), start, 4)
    assert rows(one.classes) == rows(many.classes)
    close(rows(one.centroids), rows(many.centroids))
