"""Text to weights against plain Python on random corpora."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import rows

from corpusflow.operators import terms
from corpusflow.plans.pipeline import weigh

LETTERS = "abXYé ß漢-/$£%0"
# Fixed value: the characters that separate tokens, as in corpusflow.functions.text.
DELIMITERS = "\t\n\r\f,.:;?![]'\"()& "


def python_tokens(text):
    return [t for t in re.split("[" + re.escape(DELIMITERS) + "]+", text.lower()) if t]


def random_text(rng, length):
    return "".join(rng.choice(LETTERS if rng.random() < 0.7 else DELIMITERS) for _ in range(length))


def test_tokens(spark):
    rng = random.Random(1)
    texts = [(i, random_text(rng, rng.randint(0, 60))) for i in range(500)]
    found = terms.tokenize(spark.createDataFrame(texts, "doc_id bigint, value string").repartition(4))
    expected = sorted((i, t) for i, text in texts for t in python_tokens(text))
    assert rows(found) == expected


@pytest.mark.parametrize("limits", [{}, {"broadcastBytes": 0, "hotRows": 15}])
@pytest.mark.parametrize("named", [False, True])
def test_weights(spark, settings, limits, named):
    """Half of the lines belong to one document, and one word is in nearly every line."""
    rng = random.Random(3 + named)
    words = [f"w{i}" for i in range(60)]
    lines = []
    for _ in range(150):
        doc = 0 if rng.random() < 0.5 else rng.randint(1, 40)
        text = " ".join(["all", *(words[int(rng.paretovariate(0.7)) % 60] for _ in range(rng.randint(0, 12)))])
        lines.append((doc, text))
    stop = ["w1", "w7"]

    counts = Counter((t, d) for d, text in lines for t in python_tokens(text) if t not in stop)
    totals = Counter()
    for (t, _), n in counts.items():
        totals[t] += n
    kept = {key: n for key, n in counts.items() if totals[key[0]] >= 3}
    ids = {t: i for i, t in enumerate(sorted({t for t, _ in kept}), 1)}
    df = Counter(t for t, _ in kept)
    length = Counter()
    for (_, d), n in kept.items():
        length[d] += n
    expected = sorted((ids[t], d, n / length[d] * math.log(len(length) / df[t])) for (t, d), n in kept.items())

    settings(**limits)
    corpus = spark.createDataFrame(lines, "doc_id bigint, value string").repartition(5)
    docs = None
    if named:  # with a document dictionary, and lines of documents that are not in it
        docs = spark.createDataFrame([(f"d.{i}", i) for i in range(41)], "doc_name string, doc_id bigint")
        other = [("d.99", "w1 w2 w3 rare rare rare")] * 20
        corpus = corpus.selectExpr("concat('d.', doc_id) AS doc_name", "value").union(
            spark.createDataFrame(other, "doc_name string, value string")
        )
    weighted = weigh(corpus, spark.createDataFrame([(w,) for w in stop], "term string"), doc_dict=docs)
    assert rows(weighted.vocabulary, "term_id", "term") == sorted((i, t) for t, i in ids.items())
    assert rows(weighted.triples, "term_id", "doc_id", "freq") == sorted((ids[t], d, n) for (t, d), n in kept.items())
    found = rows(weighted.weights, "term_id", "doc_id", "weight")
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert all(a[2] == pytest.approx(e[2], abs=1e-12) for a, e in zip(found, expected))
