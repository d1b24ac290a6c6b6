"""The command-line programs chained over an invented corpus."""

import math

import pytest
from conftest import rows

from corpusflow import sources
from corpusflow.plans.programs import main

TEXTS = {
    "fruit/1.txt": "Apple, apple; pear.\nThe pear and the apple\n",
    "fruit/2.txt": "pear pear (plum) plum\n",
    "metal/1.txt": "iron 'iron' gold gold\nthe iron\n",
    "metal/2.txt": "gold gold iron rust\n",
    "metal/9.txt": "iron iron iron\n",  # not in the dictionary
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("programs")
    for name, text in TEXTS.items():
        file = root / "corpus" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)
    (root / "stop.txt").write_text("the\nand\n")
    (root / "terms.txt").write_text("apple\ngold\niron\npear\nplum\nrust\nthe\n")
    (root / "docs.txt").write_text("fruit.1\nfruit.2\nmetal.1\nmetal.2\n")
    return root


@pytest.fixture(scope="module")
def lists(folder):
    return [f"--{n}={folder}/{f}" for n, f in [("stop-words", "stop.txt"), ("terms", "terms.txt"), ("docs", "docs.txt")]]


@pytest.fixture(scope="module")
def chain(spark, folder, lists):
    main(["term-frequency", f"{folder}/corpus", f"{folder}/tf", *lists])
    main(["eliminate", f"{folder}/tf", f"{folder}/kept", f"--suitable-output={folder}/suitable"])
    main(["top-terms", f"{folder}/tf", f"{folder}/top", "--k=2", f"--totals-output={folder}/totals"])
    outputs = [f"--idf-output={folder}/idf", f"--length-output={folder}/length"]
    main(["tf-idf", f"{folder}/kept", f"{folder}/weights", *outputs])
    main(["dense-vectors", f"{folder}/weights", f"{folder}/vectors"])
    return folder


def test_counts(spark, chain):
    found = rows(sources.read_triples(spark, f"{chain}/tf"))
    apple, gold, iron, pear, plum, rust = range(1, 7)
    assert found == sorted(
        [(apple, 1, 3), (pear, 1, 2), (pear, 2, 2), (plum, 2, 2)]
        + [(iron, 3, 3), (gold, 3, 2), (gold, 4, 2), (iron, 4, 1), (rust, 4, 1)]
    )
    assert rows(sources.read_pairs(spark, f"{chain}/suitable", "t", "n")) == [(1, 3), (2, 4), (3, 4), (4, 4)]
    assert rows(sources.read_pairs(spark, f"{chain}/top", "t", "n")) == [(2, 4), (3, 4)]
    assert len(rows(sources.read_pairs(spark, f"{chain}/totals", "t", "n"))) == 6


def test_weights(spark, chain):
    assert rows(sources.read_pairs(spark, f"{chain}/length", "d", "n")) == [(1, 5), (2, 2), (3, 5), (4, 3)]
    idf = dict(rows(sources.read_pairs(spark, f"{chain}/idf", "t", "x", "double")))
    assert idf[1] == pytest.approx(math.log(4)) and idf[4] == pytest.approx(math.log(2))
    found = {(t, d): w for t, d, w in sources.read_weights(spark, f"{chain}/weights").collect()}
    assert found[(1, 1)] == pytest.approx(3 / 5 * math.log(4))
    assert found[(4, 2)] == pytest.approx(math.log(2))
    assert len(rows(sources.read_vectors(spark, f"{chain}/vectors"))) == 4 * 4


@pytest.mark.parametrize("mode", [[], ["--independent"]])
def test_kmeans(spark, chain, mode):
    out = f"{chain}/run{len(mode)}"
    main(["kmeans", f"{chain}/vectors", out, "--k=2", "--iterations=2", *mode])
    for i in range(2):
        classes = dict(rows(sources.read_pairs(spark, f"{out}/classes_{i}", "d", "c", "int")))
        assert sorted(classes) == [1, 2, 3, 4]
        centers = sources.read_centroids(spark, f"{out}/centers_{i}")
        assert {c for (c,) in rows(centers.select("cluster").distinct())} == set(classes.values())
        loss = sources.read_pairs(spark, f"{out}/loss_{i}", "name", "loss", "double", "string").collect()
        assert len(loss) == 1 and loss[0].name == "Loss" and 0 <= loss[0].loss <= 4
        top = sources.read_top_terms(spark, f"{out}/top10_{i}")
        assert {c for (c,) in rows(top.select("cluster").distinct())} == set(classes.values())


def test_pipeline_equals_chain(spark, chain, lists):
    main(["kmeans", f"{chain}/weights", f"{chain}/a", "--sparse", "--k=3", "--seed=2"])
    main(["pipeline", f"{chain}/corpus", f"{chain}/b", *lists, "--k=3", "--seed=2"])
    for name in ("classes_1", "top10_1"):
        assert rows(spark.read.text(f"{chain}/a/{name}")) == rows(spark.read.text(f"{chain}/b/{name}"))


def test_a_shorter_run_replaces_a_longer_one(spark, chain):
    out = f"{chain}/again"
    main(["kmeans", f"{chain}/vectors", out, "--k=2", "--iterations=3"])
    main(["kmeans", f"{chain}/vectors", out, "--k=2", "--iterations=1"])
    assert {p.name for p in (chain / "again").iterdir()} == {"classes_0", "centers_0", "loss_0", "top10_0"}


def test_given_start(spark, chain):
    main(["kmeans", f"{chain}/vectors", f"{chain}/docs", "--k=2", "--iterations=1", "--method=docs"])
    main(["kmeans", f"{chain}/vectors", f"{chain}/first", "--k=2", "--iterations=1"])
    main(["kmeans", f"{chain}/vectors", f"{chain}/more", "--k=2", "--iterations=1", f"--centroids={chain}/first/centers_0"])
    main(["kmeans", f"{chain}/vectors", f"{chain}/both", "--k=2", "--iterations=2"])
    assert rows(spark.read.text(f"{chain}/more/classes_0")) == rows(spark.read.text(f"{chain}/both/classes_1"))
    assert rows(spark.read.text(f"{chain}/docs/loss_0"))
    with pytest.raises(SystemExit):
        main(["kmeans", f"{chain}/vectors", f"{chain}/no", "--independent", "--method=docs"])


def test_packed_corpus_and_no_lists(spark, chain, lists):
    sources.read_corpus(spark, f"{chain}/corpus").write.parquet(f"{chain}/packed")
    main(["term-frequency", f"{chain}/packed", f"{chain}/tf_packed", "--packed", *lists])
    assert rows(spark.read.text(f"{chain}/tf_packed")) == rows(spark.read.text(f"{chain}/tf"))
    main(["pipeline", f"{chain}/packed", f"{chain}/free", "--packed", "--k=2", "--min-total=1"])
    assert len(rows(spark.read.text(f"{chain}/free/classes_1"))) == 5
