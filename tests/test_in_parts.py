"""Lookups beyond one broadcast meet stored rows part by part, and counts move once."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from corpusflow import sinks, sources
from corpusflow.operators import clustering, layout, scale, terms, vectors, weights
from corpusflow.plans.pipeline import weigh


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    texts = [(d, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for d in range(80)]
    texts += [(3, "w1 w2 w2"), (None, "w1 w1 w3 w3")]
    return scale.written(spark.createDataFrame(texts, "doc_id bigint, value string"))


@pytest.fixture
def triples(spark, corpus):
    return scale.written(terms.term_frequency(corpus).filter("doc_id IS NOT NULL"))


@pytest.fixture
def plan(spark, settings):
    """Text of a plan; Spark itself broadcasts nothing."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def near(found, digits=9):
    return [tuple(round(v, digits) if isinstance(v, float) else v for v in row) for row in found]


#: Lookups of these tests take 1 to 4 KB: two to seven parts.
LIMIT = 700


def test_counts_move_once(spark, corpus):
    made = terms.counts_by_document(corpus)
    # every bucket is written by one task; where rows are dealt out twice, a task writes many of them
    assert len(made.rows.inputFiles()) <= made.buckets
    wanted = rows(terms.term_frequency(corpus).filter("doc_id = 3"), "term", "freq")
    assert rows(made.rows.filter("doc_id = 3"), "term", "freq") == wanted


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joined_in_parts(spark, triples, how, settings):
    some = scale.written_lookup(terms.term_totals(triples, "term").filter("total % 4 > 0"))
    wanted = rows(triples.join(some, "term", how).fillna(-1))
    settings(broadcastBytes=LIMIT)
    assert not scale.fits_broadcast(some)
    parts = scale.in_parts(triples, some, "term", how)
    assert len(parts) > 1 and rows(scale.written_parts(parts).fillna(-1)) == wanted
    settings(broadcastBytes=1)
    assert scale.in_parts(triples, some, "term", how) is None


def test_weights_in_parts_do_not_move(spark, corpus, settings, plan):
    whole = weigh(corpus)
    wanted = near(rows(whole.weights, "term_id", "doc_id", "weight"))
    settings(broadcastBytes=LIMIT)
    found = weigh(corpus)
    assert near(rows(found.weights, "term_id", "doc_id", "weight")) == wanted
    assert rows(found.triples.fillna(-1)) == rows(whole.triples.fillna(-1)) and rows(found.vocabulary) == rows(whole.vocabulary)
    assert "Exchange" not in plan(found.points())


@pytest.mark.parametrize("limits", [{}, {"hotRows": 8}])
def test_centroids_in_parts(spark, corpus, settings, limits):
    settings(**limits)
    results = []
    for limit in (10**6, LIMIT):
        settings(broadcastBytes=limit)
        made = weigh(corpus)
        start = clustering.initial_centroids(made.vocabulary, 3)
        fit = clustering.kmeans_fit(made.points(), start, 3)
        tries = clustering.kmeans_restarts(made.points(), made.vocabulary, 3)
        classes = scale.written(clustering.assign(made.points(), start, 3))
        centers = scale.written(clustering.update(made.points(), classes))
        tables = [fit.classes, fit.centroids, fit.loss, tries.classes, tries.loss, clustering.loss(made.points(), classes, centers, 3)]
        results.append([near(rows(t)) for t in tables])
    assert results[0] == results[1]


def test_copies_in_place(spark, corpus, settings, plan):
    made = terms.counts_by_document(corpus).rows.filter("doc_id IS NOT NULL")
    twice = made.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    suitable = scale.written_lookup(terms.suitable_terms(made, 25, "term"))
    kept = rows(terms.eliminate_terms(made, suitable, "term"))
    weighed = near(rows(weights.tf_idf(made.unionByName(made).drop("part"), term="term")))
    for limit in (10**6, LIMIT):
        settings(broadcastBytes=limit)
        assert rows(terms.eliminate_terms(twice, suitable, "term", stored=True, in_place=True)) == kept
        assert near(rows(weights.tf_idf(twice, term="term", in_place=True))) == weighed
    text = plan(weights.sum_weights(twice.withColumnRenamed("freq", "weight"), "term", in_place=True))
    assert "Exchange" not in text


def test_vectors_are_packed_in_place(spark, corpus, plan):
    points = weigh(corpus).points()
    packed = vectors.sparse_vectors(points)
    assert "Exchange" not in plan(packed)
    plain = scale.written(points.select("term_id", "doc_id", "weight"))
    assert rows(packed) == rows(vectors.sparse_vectors(plain))


def test_centroid_lines_are_bounded(spark, tmp_path):
    centers = scale.written(spark.range(400).selectExpr("int(id % 2) AS cluster", "id AS term_id", "id / 7.0D AS weight"))
    sinks.write_lines(sinks.centroid_lines(centers, 20), str(tmp_path / "c"))
    lines = spark.read.text(str(tmp_path / "c"))
    assert lines.count() >= 20
    assert rows(sources.read_centroids(spark, str(tmp_path / "c")), "cluster", "term_id", "weight") == rows(centers)


def test_counting_moves_lines_and_sorts_no_bucket(spark, monkeypatch):
    """F3 to F7, F13 to F17: the text moves in place of its tokens, and a task with one bucket does not sort it."""
    from collections import Counter

    from pyspark.sql.readwriter import DataFrameWriter

    from corpusflow.operators import layout, terms

    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen, plans = spark.conf.get(name), [], []
    save, write = DataFrameWriter.saveAsTable, layout.bucketed

    def saved(writer, *args, **known):
        seen.append(int(spark.conf.get(name)))
        return save(writer, *args, **known)

    def laid_out(rows, *args, **known):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write(rows, *args, **known)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", saved)
    monkeypatch.setattr(layout, "bucketed", laid_out)
    lines = [(1, "a b a"), (1, "b c"), (2, None), (None, "a The a"), (3, ""), (1, "a b a")]
    stop = spark.createDataFrame([("the",)], "term string")
    counts = terms.counts_by_document(spark.createDataFrame(lines, "doc_id bigint, value string"), stop)
    wanted = Counter((w, d) for d, text in lines for w in (text or "").lower().split() if w != "the")
    assert {(r.term, r.doc_id): r.freq for r in counts.rows.collect()} == wanted
    assert counts.rows.count() == len(wanted)
    assert seen and min(seen) >= 1 and spark.conf.get(name) == before
    assert plans[0].index("Generate") < plans[0].index("RepartitionByExpression"), plans[0]


def test_buckets_of_counts_follow_the_text(spark, settings):
    """So that a task's counts do not grow with the corpus."""
    settings(hotRows=1000, bucketTextBytes=2000)
    texts = [(d, " ".join(f"w{(d * i) % 97}" for i in range(60))) for d in range(300)]
    corpus = scale.written(spark.createDataFrame(texts, "doc_id bigint, value string"))
    size = sum(len(t) for _, t in texts)
    made = terms.counts_by_document(corpus)
    assert made.hot is None and made.buckets == -(-size // 2000) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows(made.rows, "term", "doc_id", "freq") == rows(terms.term_frequency(corpus), "term", "doc_id", "freq")


def test_a_layout_is_written_bucket_by_bucket(spark, corpus, plan):
    """Not by tasks with many buckets, which sort their rows by bucket, and at size spill them."""
    counts = terms.counts_by_document(corpus)
    names = scale.written_lookup(counts.rows.select("term").distinct().withColumn("term_id", F.hash("term").cast("bigint")))
    scans = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(scans)
    joined = layout.look_up(counts, names, "term", columns=["term_id", "doc_id", "freq", "part"])
    with layout._files_at_once(spark):
        assert "Bucketed: true" in plan(joined.rows.select("*"))
    assert spark.conf.get(scans) == before
    stored, made = (at.rows.filter("doc_id IS NOT NULL").select("term_id", "doc_id", "freq") for at in (layout.store(joined), joined))
    assert rows(stored) == rows(made)
