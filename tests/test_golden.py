"""Recompute published result files from their published inputs.

Classes come from a random start, so clustering is checked from given classes on.
"""

import pytest
from conftest import rows

from corpusflow import sources
from corpusflow.operators import clustering, scale, terms, vectors, weights


@pytest.fixture(scope="module")
def counted(spark, golden):
    counts = terms.term_frequency(
        sources.read_corpus(spark, f"{golden}/corpus"),
        sources.read_stop_words(spark, f"{golden}/stop_words.txt"),
        sources.read_term_dictionary(spark, f"{golden}/terms.txt", skip_first=True),
        sources.read_doc_dictionary(spark, f"{golden}/docs.txt", skip_first=True),
    )
    return scale.written(counts)


@pytest.fixture(scope="module")
def eliminated(counted):
    return scale.written(terms.eliminate_terms(counted, scale.written(terms.suitable_terms(counted))))


def close(actual, expected, tolerance=1e-12):
    assert [r[:-1] for r in actual] == [r[:-1] for r in expected]
    assert max(abs(a[-1] - e[-1]) for a, e in zip(actual, expected)) <= tolerance


def test_term_frequency(spark, golden, counted):
    expected = rows(sources.read_triples(spark, f"{golden}/term_frequency.txt"))
    assert rows(counted, "term_id", "doc_id", "freq") == expected
    assert len(expected) == 2950


def test_suitable_terms(spark, golden, counted):
    expected = rows(sources.read_pairs(spark, f"{golden}/suitable_terms.txt", "term_id", "total"))
    assert rows(terms.suitable_terms(counted)) == expected


def test_eliminated(spark, golden, eliminated):
    expected = rows(sources.read_triples(spark, f"{golden}/eliminated.txt"))
    assert rows(eliminated, "term_id", "doc_id", "freq") == expected
    assert len(expected) == 1830


def test_top_terms(spark, golden, counted):
    expected = rows(sources.read_pairs(spark, f"{golden}/top_terms.txt", "term_id", "total"))
    assert rows(terms.top_terms(terms.term_totals(counted))) == expected


def test_idf(spark, golden, eliminated):
    expected = rows(sources.read_pairs(spark, f"{golden}/idf.txt", "term_id", "idf", "double"))
    close(rows(weights.idf(eliminated, n_docs=50)), expected)


def test_doc_length(spark, golden, eliminated):
    expected = rows(sources.read_pairs(spark, f"{golden}/doc_length.txt", "doc_id", "n_terms"))
    assert rows(weights.doc_length(eliminated)) == expected


def test_tf_idf(spark, golden, eliminated):
    expected = rows(sources.read_weights(spark, f"{golden}/tf_idf.txt"))
    close(rows(weights.tf_idf(eliminated, n_docs=50), "term_id", "doc_id", "weight"), expected)


def test_dense_vectors(spark, golden, eliminated):
    """The published sample is the weights of five documents with zeros filled in."""
    points = sources.read_vectors(spark, f"{golden}/vectors.txt")
    dense = vectors.from_vectors(vectors.to_dense_vectors(weights.tf_idf(eliminated, n_docs=50)))
    sample = dense.join(points.select("doc_id").distinct(), "doc_id").select("doc_id", "term_id", "weight")
    expected = rows(points, "doc_id", "term_id", "weight")
    assert len(expected) == 5 * 464
    close(rows(sample), expected)


@pytest.mark.parametrize("i", [0, 1])
def test_clustering_pass(spark, golden, i):
    points = scale.written(sources.read_vectors(spark, f"{golden}/vectors.txt"))
    classes = sources.read_pairs(spark, f"{golden}/classes_{i}.txt", "doc_id", "cluster", "int")
    centers = scale.written(clustering.update(points, classes))
    expected = rows(sources.read_centroids(spark, f"{golden}/centers_{i}.txt"))
    close(rows(centers, "cluster", "term_id", "weight"), expected)

    wanted = sources.read_pairs(spark, f"{golden}/loss_{i}.txt", "name", "loss", "double", "string").first()["loss"]
    assert clustering.loss(points, classes, centers).first()["loss"] == pytest.approx(wanted, abs=1e-12)

    top = clustering.collapsed_top_terms(centers, cumulative=True)
    listed = rows(sources.read_top_terms(spark, f"{golden}/top10_{i}.txt"))
    assert rows(top, "cluster", "rank", "term_id") == listed
