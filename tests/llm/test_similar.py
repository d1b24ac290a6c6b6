"""Jaccard join, components and suffix-array dedup against brute force."""

import random
import re

import numpy as np
import pytest

from corpusflow.llm import components, jaccard, suffix_dedup

from .conftest import by_id


def merged(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    draw = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(draw.randrange(100, 160), draw.randrange(100, 160)) for _ in range(40)]
    pairs += [(500, i) for i in range(501, 560)] + [(7, 7), (500, 501)]
    found = components.components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert dict(by_id(found, "node", "component")) == merged(pairs, nodes)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(text):
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def wanted_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    top = merged(pairs, ids)
    return pairs, sorted(((i, len(sets[i]), top[i]) for i, _ in rows), key=str)


def edited(words, edits, draw):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def near_copies(seed):
    """Groups of copies with few edits, chains, texts around one passage, texts of all lengths."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for size, copies in ((130, 40), (400, 12), (30, 10), (12, 6)):
        base = [word() for _ in range(size)]
        texts += [edited(base, draw.randrange(5), draw) for _ in range(copies)]
    for _ in range(40):
        texts.append(" ".join([word() for _ in range(draw.randrange(1, 60))] + passage))
    chain = [word() for _ in range(200)]
    for step in range(25):
        chain = edited(chain, 1, draw).split()
        texts.append(" ".join(chain))
    texts += ["a", "A", "a b", "A  B\n", "a b c", "", None, "  ", "x " * 500, "X " * 300]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("place_bits", [27, 17])
def test_similar_groups(spark, place_bits):
    rows = near_copies(place_bits)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, n string").repartition(5)
    pairs, wanted = wanted_groups([(i, t or "") for i, t in rows])
    assert len(pairs) > 200
    assert by_id(jaccard.similar_groups(docs, place_bits=place_bits), "doc_id", "n_shingles", "component_id") == wanted
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {w[2] for w in wanted}


def test_similar_groups_of_edge_texts(edge, texts, empty):
    _, wanted = wanted_groups(dict(texts).items())
    found = jaccard.similar_groups(edge)
    assert found.count() == len(texts)
    assert sorted({tuple(r) for r in found.collect()}, key=str) == wanted
    assert jaccard.similar_groups(empty).count() == 0


def test_sliding_minimum():
    draw = np.random.default_rng(1)
    for n, width in ((5, 5), (17, 4), (100, 7), (21, 7), (3, 1)):
        values = draw.integers(0, 50, n).astype(np.uint64)
        wanted = [min(values[i : i + width]) for i in range(n - width + 1)]
        assert suffix_dedup.sliding_minimum(values, width).tolist() == wanted


def repeated_texts(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefé") for _ in range(5))
    passages = [" ".join(word() for _ in range(n)) for n in (20, 33, 34, 35, 60, 300)]
    texts = [None, "", "short", "ab" * 400, "x" * 199, "x" * 200, "x" * 201, "y" * 200]
    for _ in range(40):
        parts = [" ".join(word() for _ in range(draw.randrange(40)))]
        for _ in range(draw.randrange(3)):
            p = draw.choice(passages)
            cut = draw.randrange(len(p) // 4)
            parts += [p[cut:], " ".join(word() for _ in range(draw.randrange(40)))]
        texts.append(" ".join(parts))
    texts += [texts[-1], texts[-2], texts[-2] + "!", "?" + texts[-3]]
    return texts


@pytest.mark.parametrize("length", [200, 64])
def test_suffix_dedup(spark, length):
    texts = repeated_texts(length)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, start int").repartition(4)
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, length).collect()}
    wanted = suffix_dedup.brute_force([(t or "").encode() for t in texts], length)
    for i, kept in enumerate(wanted):
        row = found[i]
        assert bytes(row.kept) == kept, i
        assert row.n_removed == len((texts[i] or "").encode()) - len(kept)
        assert row.n_bytes == len((texts[i] or "").encode())
    assert sum(r.n_removed for r in found.values()) > 5000
    assert found[5].n_spans == found[6].n_spans == (1 if length == 200 else 1)


def test_suffix_dedup_of_edge_texts(edge, texts, empty):
    found = suffix_dedup.remove_repeats(edge).collect()
    wanted = suffix_dedup.brute_force([t.encode() for _, t in texts], 200)
    assert sorted((r.doc_id, bytes(r.kept)) for r in found) == sorted((i, k) for (i, _), k in zip(texts, wanted, strict=True))
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_sets_of_numbered_rows_do_not_move_to_be_told_apart(spark, monkeypatch):
    """The rows of ``one_of_each`` have numbers of their own: none is repeated, though ids and texts are."""
    text = "one two three four five six"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (1, "seven eight nine"), (None, text)], "doc_id bigint, text string")
    wanted = [(1, "seven eight nine"), (1, text)]
    dropped, drop = [], type(docs).dropDuplicates
    monkeypatch.setattr(type(docs), "dropDuplicates", lambda df, *a: dropped.append(df.columns) or drop(df, *a))
    assert sorted(tuple(r) for r in jaccard.one_of_each(docs).collect()) == sorted(wanted)
    assert not [c for c in dropped if "tokens" in c]
