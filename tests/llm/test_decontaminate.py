"""Benchmark decontamination against a table of all windows."""

import hashlib
import random
import re

import pytest

from corpusflow.llm import decontaminate, queries

from .conftest import TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    """Per row of docs: (doc_id, n_words, hit places, items)."""
    windows = {}
    for item, text in items:
        found = words(text)
        size = min(window, len(found))
        for at in range(len(found) - size + 1 if found else 0):
            windows.setdefault(tuple(found[at : at + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    answers = []
    for doc, text in docs:
        found = words(text)
        hit, named = set(), set()
        for size in sizes:
            for at in range(len(found) - size + 1):
                some = windows.get(tuple(found[at : at + size]))
                if some:
                    hit.update(range(at, at + size))
                    named |= some
        answers.append((doc, len(found), tuple(sorted(hit)), tuple(sorted(named))))
    return sorted(answers, key=str)


def answers(df):
    return sorted(
        (
            (r.doc_id, r.n_words, tuple(i for s in r.spans for i in range(s.begin, s.end)), tuple(r["items"]))
            for r in df.collect()
        ),
        key=str,
    )


def invented(seed):
    """Texts and items of few words, so that they share strings of any length."""
    draw = random.Random(seed)
    some = lambda n, of: " ".join(draw.choice(of) for _ in range(n))
    items = [(i, some(draw.randrange(0, 30), "abcd")) for i in range(25)]
    items += [(i % 20, t) for i, t in items[:5]] + [(None, "Solo-WORD é1 a"), (77, None), (78, "...!"), (79, "zz")]
    docs = [(i, some(draw.randrange(0, 80), "abcde")) for i in range(60)]
    for i in range(30):
        spliced = [some(5, "ex"), *(draw.choice(items)[1] or "" for _ in range(3)), some(3, "q")]
        docs.append((100 + i, draw.choice([" ", ", ", "\n", ". X "]).join(spliced).upper()))
    return docs + [(i, t) for i, t in enumerate(TEXTS)] + docs[:3] + [(None, "zz solo word É1 a"), (5, "solo word é1 a zz")], items


@pytest.mark.parametrize(("window", "shard"), [(10, 200_000), (3, 200_000), (4, 40), (10, 60)])
def test_invented_texts(spark, window, shard):
    """Also with many automata, and with items cut into parts."""
    docs, items = invented(window)
    df = spark.createDataFrame([(*r, "a", 1) for r in docs], "doc_id bigint, text string, _n_words string, _row int")
    item_df = spark.createDataFrame([(*r, 0) for r in items], "item_id bigint, text string, n int")
    found = decontaminate.matches(df.repartition(4), item_df, window=window, shard_words=shard)
    assert answers(found) == brute(docs, items, window)


def test_states_stand_for_all_strings():
    draw = random.Random(1)
    for _ in range(200):
        texts = [[draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randrange(1, 9))] for _ in range(3)]
        automaton = decontaminate.Automaton([(str(i), t) for i, t in enumerate(texts)], 3)
        strings = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        held = sum(automaton.length[s] - automaton.length[automaton.link[s]] for s in range(1, len(automaton.next)))
        assert held == len(strings)
        assert len(automaton.next) <= 2 * sum(map(len, texts)) + 1


@pytest.mark.parametrize("shard", [200_000, 60])
def test_cut(spark, shard):
    items = [(1, "one two three four five"), (2, "six seven")]
    docs = [
        (1, "Keep this. ONE two, three\nfour five! And this here is kept, too, of course", "x"),
        (2, "one two three four five", "y"),
        (3, None, None),
        (4, "nothing — to see", "z"),
        (5, "ä; six  seven? ö ü and a few more words", "z"),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, _spans string")
    item_df = spark.createDataFrame(items * 10, "item_id bigint, text string")
    made = decontaminate.decontaminate(df, item_df, window=5, shard_words=shard if shard > 60 else 6)
    assert made.schema == df.schema
    assert sorted((tuple(r) for r in made.collect()), key=lambda r: r[0]) == [
        (1, "Keep this. ! And this here is kept, too, of course", "x"),
        (3, None, None),
        (4, "nothing — to see", "z"),
        (5, "ä; ? ö ü and a few more words", "z"),
    ]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert answers(decontaminate.matches(docs, items.limit(0))) == [(1, 2, (), ())]
    assert answers(decontaminate.matches(docs.limit(0), items)) == []
    assert decontaminate.decontaminate(docs.limit(0), items).collect() == []
    assert [tuple(r) for r in decontaminate.decontaminate(docs, items.limit(0)).collect()] == [(1, "a b")]


def test_query_on_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.op12_decontaminate(spark, sf_dir).collect()
    wanted = [
        (d, n, len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit))
        for d, n, hit, named in brute(docs, items, 10)
    ]
    assert any(w[5] for w in wanted)
    assert sorted((tuple(r) for r in found), key=str) == sorted(wanted, key=str)
