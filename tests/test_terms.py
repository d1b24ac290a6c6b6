"""Text, lists and term counts on small invented tables."""

import pytest
from conftest import rows

from pyspark.sql import functions as F

from corpusflow import sinks, sources
from corpusflow.operators import layout, scale, terms
from corpusflow.plans.queries import STOP_WORDS, corpus


def words(spark, *items):
    return spark.createDataFrame([(w,) for w in items], "term string")


def test_delimiters(spark):
    text = "Don't stop: re-start\t(now)! a/b £5.50\r\n\"x\"&y;\f[z]?,"
    lines = spark.createDataFrame([(1, text)], "doc_id bigint, value string")
    found = [r.term for r in terms.tokenize(lines).collect()]
    assert found == "don t stop re-start now a/b £5 50 x y z".split()


def test_null_and_empty_text(spark):
    lines = spark.createDataFrame([(1, None), (2, ""), (3, " .;"), (4, "a")], "doc_id bigint, value string")
    assert rows(terms.tokenize(lines)) == [(4, "a")]


def test_stop_words_win_over_dictionary(spark):
    corpus = spark.createDataFrame([("s.1", "the cat saw the dog"), ("s.9", "cat")], "doc_name string, value string")
    dictionary = spark.createDataFrame([("the", 1), ("cat", 2), ("dog", 3)], "term string, term_id bigint")
    docs = spark.createDataFrame([("s.1", 7)], "doc_name string, doc_id bigint")
    counts = terms.term_frequency(corpus, words(spark, "the"), dictionary, docs)
    assert rows(counts, "term_id", "doc_id", "freq") == [(2, 7, 1), (3, 7, 1)]  # unknown: saw, s.9


def test_lines_of_one_document_add_up(spark):
    corpus = spark.createDataFrame([(1, "a b"), (1, "a"), (2, "a")], "doc_id bigint, value string").repartition(3)
    assert rows(terms.term_frequency(corpus)) == [("a", 1, 2), ("a", 2, 1), ("b", 1, 1)]


def test_threshold_is_global(spark):
    triples = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (2, 1, 2)], "term_id bigint, doc_id bigint, freq bigint")
    assert rows(terms.suitable_terms(triples.repartition(3))) == [(1, 4)]


@pytest.mark.parametrize("limit", [None, 0])
def test_repeated_triples_are_kept_once(spark, settings, limit):
    if limit is not None:
        settings(broadcastBytes=limit)
    data = [(1, 1, 2), (1, 1, 2), (1, 2, 1), (2, 1, 1)]
    triples = spark.createDataFrame(data, "term_id bigint, doc_id bigint, freq bigint")
    kept = terms.eliminate_terms(triples, scale.written(terms.suitable_terms(triples)))
    assert rows(kept) == [(1, 1, 2), (1, 2, 1)]


def test_top_terms_tie(spark):
    totals = spark.createDataFrame([(5, 3), (4, 3), (9, 8), (1, 3)], "term_id bigint, total bigint")
    assert [tuple(r) for r in terms.top_terms(totals, 3).collect()] == [(9, 8), (1, 3), (4, 3)]


def test_vocabulary_ids(spark):
    data = [f"w{i:04d}" for i in range(3000)]
    found = rows(terms.vocabulary(words(spark, *data, *data).repartition(5)), "term_id", "term")
    assert found == list(enumerate(data, 1))


def test_empty_vocabulary(spark):
    assert terms.vocabulary(words(spark, "x").limit(0)).count() == 0


def test_dictionary_first_line_and_repeats(spark, tmp_path):
    file = tmp_path / "terms.txt"
    file.write_text(" Alpha\t\nbeta\n\x01gamma \nbeta\nNULL\n")
    full = sources.read_term_dictionary(spark, str(file))
    assert rows(full) == [("alpha", 1), ("beta", 4), ("gamma", 3), ("null", 5)]
    shifted = sources.read_term_dictionary(spark, str(file), skip_first=True)
    assert rows(shifted) == [("beta", 3), ("gamma", 2), ("null", 4)]


def test_dictionary_over_many_splits(spark, tmp_path):
    """Line numbers go on across the splits of a file and across files."""
    (tmp_path / "a.txt").write_text("".join(f"x{i}\n" for i in range(5000)))
    (tmp_path / "b.txt").write_text("".join(f"y{i}\n" for i in range(7)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        found = dict(rows(sources.read_doc_dictionary(spark, str(tmp_path))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {**{f"x{i}": i + 1 for i in range(5000)}, **{f"y{i}": i + 5001 for i in range(7)}}


def test_stop_word_file(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("The\n a \nthe\n")
    assert rows(sources.read_stop_words(spark, str(tmp_path / "stop.txt"))) == [("a",), ("the",)]


def test_corpus_names(spark, tmp_path):
    for folder, name in [("sport", "001.txt"), ("a b+c", "x%y.txt.txt"), ("sub/Tech", "ü 2.txt")]:
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / name).write_text("one\ntwo\n")
    found = rows(sources.read_corpus(spark, str(tmp_path)))
    names = ["Tech.ü 2", "a b+c.x%y", "sport.001"]
    assert found == sorted((n, v) for n in names for v in ("one", "two"))


def test_bad_number_raises(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1 2 x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources.read_triples(spark, str(tmp_path / "t.txt")).collect()


def test_pairs_and_triples_round_trip(spark, tmp_path):
    triples = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], "term_id bigint, doc_id bigint, freq bigint")
    for write, name in [(sinks.write_pairs, "tab"), (sinks.write_triples, "space")]:
        path = str(tmp_path / name)
        write(triples, path)
        write(triples, path)  # replaces
        assert rows(sources.read_triples(spark, path)) == [(1, 2, 3), (4, 5, 6)]
    assert rows(spark.read.text(str(tmp_path / "tab"))) == [("1 2\t3",), ("4 5\t6",)]


@pytest.mark.parametrize("name", ["term_frequency", "term_frequency_open", "eliminated_terms", "doc_length"])
def test_salted_counts_equal_broadcast_counts(spark, settings, sf_dir, name):
    """The same counts when no list may be broadcast and every frequent key is cut."""
    from corpusflow.plans.queries import QUERIES

    wide = rows(QUERIES[name](spark, sf_dir))
    settings(broadcastBytes=0, hotRows=20)
    assert rows(QUERIES[name](spark, sf_dir)) == wide


def test_hot_keys(spark, settings):
    settings(hotRows=10)
    data = spark.range(100).selectExpr("if(id < 65, 0, id) AS key", "id")
    assert rows(scale.hot_keys(data, ["key"])) == [(0, 7)]
    assert scale.hot_keys(data.limit(10), ["key"]) is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_kinds(spark, settings, how):
    settings(hotRows=5)
    left = scale.written(spark.range(60).selectExpr("if(id < 40, 1, id) AS key", "id"))
    right = scale.written(spark.range(50).selectExpr("id AS key", "id * 2 AS double").filter("key % 2 = 1"))
    expected = sorted(tuple(r) for r in left.join(right, "key", how).collect())
    settings(broadcastBytes=0)
    joined = scale.lookup_join(left, right, "key", how, stored=True)
    assert sorted(tuple(r) for r in joined.collect()) == expected


def test_shuffle_size_follows_the_input(spark, tmp_path, monkeypatch):
    (tmp_path / "d" / "e").mkdir(parents=True)
    for name in ("a.txt", "d/b.txt", "d/e/c.txt"):
        (tmp_path / name).write_text("x" * 1000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    scan = spark.read.option("recursiveFileLookup", True).text(str(tmp_path))
    try:
        assert scale.size_shuffles(scan) == int(before)
        monkeypatch.setattr(scale, "SHUFFLE_BYTES", 100)
        assert scale.size_shuffles(scan) == 30
        assert spark.conf.get("spark.sql.shuffle.partitions") == "30"
        spark.conf.set("spark.sql.shuffle.partitions", before)
        sources.read_corpus(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "30"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_registered_queries_size_their_shuffles(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(scale, "SHUFFLE_BYTES", 2000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        corpus(spark, sf_dir)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 3 * int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_corpus_is_listed_once(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("one two")
    reads = []
    monkeypatch.setattr(type(spark.read), "load", lambda *a, **b: reads.append(a))
    found = sources.read_corpus(spark, str(tmp_path))
    assert found.count() == 1 and not reads


def test_metrics_of_written_tables(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "k bigint, v string")
    for some, rows, size in ((df, 2, 2 * (16 + 8 + 16) + 2), (df.limit(0), 0, 0), (df.filter("k > 5"), 0, 0)):
        table = scale.written_lookup(some)
        assert (table.observed["rows"], table.observed["bytes"]) == (rows, size)
        assert scale.fits_broadcast(table) and table.count() == rows


def test_marks(spark, monkeypatch):
    keys = spark.range(0, 3000, 3).selectExpr("id", "string(id) AS name")
    rows = spark.range(3000).selectExpr("string(id) AS name", "id AS _bits", "id AS n")
    found = {r.n for r in scale.marked(rows, scale.marks(keys, "name"), "name").collect()}
    assert set(range(0, 3000, 3)) <= found and len(found) < 1010
    assert scale.marked(rows, scale.marks(keys.limit(0), "name"), "name").count() == 0
    monkeypatch.setattr(scale, "MARK_ROWS", 1)  # crowded: more rows pass, none is lost
    crowded = {r.n for r in scale.marked(rows, scale.marks(keys, "id"), "n").collect()}
    assert set(range(0, 3000, 3)) <= crowded and len(crowded) < 1100


@pytest.mark.parametrize("limits", [{}, {"broadcastBytes": 0}, {"hotRows": 3}, {"broadcastBytes": 0, "hotRows": 3}])
def test_counts_by_document_equal_counts(spark, settings, monkeypatch, limits):
    monkeypatch.setattr(terms, "hot_documents", lambda lines, text: layout.hot_documents(lines, text))
    monkeypatch.setattr(layout, "TEXT_BYTES_PER_ROW", 2)
    settings(**limits)
    data = [(d, " ".join(f"w{(d * i) % 11}" for i in range(3 + d * 7 % 30))) for d in range(12)] + [(3, "w1 again"), (50, None)]
    corpus = spark.createDataFrame([(*r, f"n{r[0]}") for r in data], "doc_id bigint, value string, doc_name string").repartition(3)
    dictionary = scale.written(spark.createDataFrame([(f"w{i}", i) for i in range(8)], "term string, term_id bigint"))
    names = spark.createDataFrame([(f"n{i}", 100 + i) for i in range(9)], "doc_name string, doc_id bigint")
    for lists in ({}, {"stop_words": words(spark, "w1")}, {"term_dict": dictionary}, {"term_dict": dictionary, "doc_dict": names}):
        docs = corpus.drop("doc_id") if "doc_dict" in lists else corpus.drop("doc_name")
        wanted = terms.term_frequency(docs, **lists)
        made = terms.counts_by_document(docs, **lists)
        assert rows(made.rows, *wanted.columns) == rows(wanted)
        if "hotRows" in limits and not lists:
            assert made.hot is not None and made.rows.filter("part > 0").count()
        lengths = made.sums(F.sum("freq").alias("n")).select("doc_id", "n").distinct()
        assert rows(lengths) == rows(wanted.groupBy("doc_id").agg(F.sum("freq").alias("n")))
        assert rows(made.documents()) == rows(wanted.select("doc_id").distinct())


def test_stop_list_is_clean():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) and all(w == w.lower().strip() for w in STOP_WORDS)
