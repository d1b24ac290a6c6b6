"""Shapes of the physical plans that large inputs depend on."""

import pytest

from pyspark.sql import functions as F

from corpusflow.operators import clustering, layout, scale, terms, vectors, weights
from corpusflow.plans import queries

TRIPLES = "term_id bigint, doc_id bigint, freq bigint"


@pytest.fixture
def plan(capsys):
    def of(df):
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out

    return of


@pytest.fixture(scope="module")
def triples(spark):
    data = [(t, d, 1 + (t * d) % 3) for t in range(20) for d in range(30) if (t + d) % 3]
    return scale.written(spark.createDataFrame(data, TRIPLES))


def test_small_lists_filter_before_the_only_key_shuffle(spark, sf_dir, plan):
    text = plan(queries.open_counts(spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") < text.index("LeftAnti")  # nearer to the result
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_large_lists_meet_counts_not_tokens(spark, sf_dir, plan, settings):
    settings(broadcastBytes=0)
    text = plan(queries.term_frequency(spark, sf_dir))
    assert "Generate" not in text  # the tokens were counted and written before the joins


def test_top_terms_needs_no_global_sort(triples, plan):
    text = plan(terms.top_terms(terms.term_totals(triples)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
    assert "ReadSchema: struct<term_id:bigint,freq:bigint>" in text


def test_tf_idf_shuffles_nothing_with_small_lookups(triples, plan):
    text = plan(weights.tf_idf(triples, unique_input=True))
    assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text


def test_tf_idf_does_not_broadcast_large_lookups(spark, triples, plan, settings):
    settings(broadcastBytes=0, hotRows=5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(weights.tf_idf(triples, unique_input=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joined_on_parts = [line for line in text.splitlines() if "SortMergeJoin" in line and "_part" in line]
    assert joined_on_parts
    # the only broadcasts left are the bounded lists of hot keys
    assert text.count("BroadcastHashJoin") == text.count("LeftOuter")


@pytest.fixture
def no_broadcast(spark, settings):
    settings(broadcastBytes=0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counts_are_laid_out_by_the_shuffle_that_counts(spark, sf_dir, plan, no_broadcast, settings):
    settings(broadcastBytes=1 << 26)
    counts = terms.counts_by_document(queries.corpus(spark, sf_dir), queries.stop_words(spark))
    text = plan(counts.join_sums(F.sum("freq").alias("n_terms")))
    assert "Exchange" not in text and text.count("Bucketed: true") == 2 and "ShuffledHashJoin" in text
    frequency = plan(weights.document_frequency(counts.rows, "term"))
    assert frequency.count("Exchange") == 1


def test_tf_idf_by_document_both_ways(spark, triples, plan, settings):
    wanted = {(r.term_id, r.doc_id): round(r.weight, 9) for r in weights.tf_idf(triples, unique_input=True).collect()}
    for limits in ({}, {"broadcastBytes": 0}, {"broadcastBytes": 0, "hotRows": 5}):
        settings(**limits)
        made = weights.tf_idf_by_document(layout.by_document(triples))
        assert {(r.term_id, r.doc_id): round(r.weight, 9) for r in made.rows.collect()} == wanted
        points = clustering.lay_out(made)
        assert points.count() == len(wanted)
        if not limits:
            # nothing but the n_docs of the idf and the idf itself moves
            assert "hashpartitioning(doc_id" not in plan(made.rows)


def test_rare_words_do_not_reach_the_count_shuffle(spark, sf_dir, plan, no_broadcast):
    lines, _ = terms._document_lines(queries.corpus(spark, sf_dir), None, "value")
    dictionary = scale.written(queries.term_dictionary(spark, sf_dir))
    tokens, _, left = terms._early(terms.tokenize(lines), None, dictionary)
    assert left is dictionary
    every = terms.tokenize(lines).select("term").distinct()
    known = {r.term for r in dictionary.collect()}
    passed = {r.term for r in tokens.select("term").distinct().collect()}
    assert known & {r.term for r in every.collect()} <= passed
    assert len(passed - known) < 0.02 * every.count()
    text = plan(tokens.groupBy("term").count())
    assert text.index("Exchange hashpartitioning(term") < text.index("_marks")  # nearer to the result


def test_eliminate_moves_the_triples_once(spark, triples, plan, no_broadcast, settings):
    suitable = scale.written(terms.suitable_terms(triples, 25))
    copies = triples.unionByName(triples)
    wanted = sorted(tuple(r) for r in terms.eliminate_terms(triples, suitable, unique_input=True).collect())
    assert 0 < len(wanted) < triples.count()
    for limits in ({}, {"hotRows": 5}):
        settings(**limits)
        kept = terms.eliminate_terms(copies, suitable)
        assert sorted(tuple(r) for r in kept.collect()) == wanted
        text = plan(terms.eliminate_terms(copies, suitable))
        # the triples, and the suitable terms
        assert text.count("Exchange hashpartitioning(term_id") == 2


def test_dense_vectors_compute_the_weights_once(spark, triples, plan):
    weighted = weights.tf_idf(triples, unique_input=True)
    text = plan(vectors.to_dense_vectors(weighted))
    assert "n_terms" not in text and "freq" not in text


def test_cluster_top_terms_limits_before_the_shuffle(triples, plan):
    centers = scale.written(clustering.initial_centroids(triples.select("term_id").distinct(), 3))
    text = plan(clustering.cluster_top_terms(centers, 2))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning(cluster")
    assert "Partial" in text and "SinglePartition" not in text


def test_assignment_sums_all_clusters_in_one_row(triples, plan):
    points = scale.written(weights.tf_idf(triples, unique_input=True))
    start = clustering.initial_centroids(points.select("term_id").distinct(), 3)
    text = plan(clustering.assign(points, start, 3))
    assert text.count("Exchange hashpartitioning") == 1
    assert "NestedLoop" not in text and "Cartesian" not in text and "Generate" not in text


def test_large_centroids_move_no_weights(spark, triples, plan, settings):
    settings(broadcastBytes=0, hotRows=25)
    points = clustering.lay_out(triples.selectExpr("term_id", "doc_id", "double(freq) AS weight"))
    start = clustering.initial_centroids(points.select("term_id").distinct(), 3)
    by_term = clustering.TermLayout(points)
    scores = clustering._score(points, start.withColumnRenamed("cluster", "slot"), 3, by_term)
    text = plan(scores)
    scan = text[: text.index("ReadSchema: struct<term_id:bigint,doc_id:bigint,weight:double,part:int>")]
    assert "Bucketed: true" in text
    # from the scan of the weights up to the join with the centroids nothing is shuffled
    join = scan.rindex("ShuffledHashJoin")
    assert "Exchange" not in scan[join:]
    table, hot = by_term.table, by_term.hot
    clustering._score(points, start.withColumnRenamed("cluster", "slot"), 3, by_term)
    assert by_term.table is table and by_term.hot is hot and hot is not None
