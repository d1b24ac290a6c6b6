"""Collocations against counting every phrase by itself."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusflow.llm import collocations

from .conftest import TEXTS


def brute(rows, min_count, top, most=5):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for at in range(len(words)):
                for size in range(1, min(most, len(words) - at) + 1):
                    counts[lang][tuple(words[at : at + size])] += 1
    answers = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if len(p) > 1 and a >= min_count}
        held = defaultdict(int)
        for p, a in often.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    held[p[at : at + size]] = max(held[p[at : at + size]], a)
        scores = []
        for p, a in often.items():
            if held[p] >= a:
                continue
            score, k = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            scores.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scores)[:top], 1):
            answers.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(answers)


def invented(seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(150):
        text = ""
        for _ in range(draw.randrange(40)):
            text += draw.choice(["a", "B", "é", "d-e", "the", "the end of", "\x00z", "<>", "漢"]) + draw.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\x1c "])
        rows.append((draw.choice(["en", "de", None, "und", ""]), text))
    return rows + rows[:10] + [("en", t) for t in TEXTS] + [(None, None)]


@pytest.mark.parametrize(("min_count", "top", "block"), [(2, 10_000, 6_000_000), (3, 25, 400), (5, 3, 50), (100, 2000, 3000)])
def test_invented_texts(spark, min_count, top, block):
    """Also with blocks shorter than the texts."""
    rows = invented(min_count)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string").repartition(4)
    found = collocations.collocations(df, min_count=min_count, top=top, block=block)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    wanted = brute(rows, min_count, top)
    assert len(wanted) > 5
    assert sorted(tuple(r) for r in found.collect()) == wanted


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_bitmap", lambda places: np.full(1 << 23, 255, np.uint8))
    rows = invented(9)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(df, min_count=4).collect()) == brute(rows, 4, 2000)


def test_shuffled_lookups(spark, settings):
    settings(broadcastBytes=0, hotRows=20)
    rows = invented(8)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(df, min_count=4).collect()) == brute(rows, 4, 2000)


def test_scores_past_64_bits(spark):
    n, a, left, right = 9 * 10**15, 4 * 10**12 + 7, 5 * 10**12 + 1, 4 * 10**12 + 9
    phrases = spark.createDataFrame(
        [("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right)], "lang string, phrase string, size int, f bigint"
    )
    totals = spark.createDataFrame([("en", n)], "lang string, n bigint")
    assert collocations.scored(phrases, totals).first()["score"] == 1000 * a * n // (left * right)


def test_windows_with_many_words():
    """Numbers too large to combine in one integer are made dense between."""
    draw = np.random.default_rng(1)
    ids = draw.integers(0, 1 << 22, 300)
    ids = np.concatenate([ids, ids])
    columns, counts = collocations.count_windows(ids, len(ids), 5, draw.random(len(ids)) < 2)
    wanted = Counter()
    for at in range(len(ids)):
        window = []
        for i in range(at, at + 5):
            window.append(int(ids[i]) if i < len(ids) and (not window or window[-1]) else 0)
        if window[0]:
            wanted[tuple(window)] += 1
    assert dict(zip(zip(*(c.tolist() for c in columns)), counts.tolist())) == wanted


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df).collect() == []


def test_pairs_move_in_four_bytes(spark):
    """Pairs are counted for the marks only, so half of their hash will do."""
    texts = collocations._texts(spark.createDataFrame([("en", "a b c a b")], "lang string, text string"), "text", "lang")
    marked = spark.sparkContext.broadcast(np.full(1 << (collocations.BITMAP_BITS - 3), 255, np.uint8))
    found = collocations._pair_counts(texts, marked, 1000)
    assert dict(found.dtypes)["pair"] == "int" and sorted(r.n for r in found.collect()) == [1, 1, 2]


def test_triples_and_windows_move_in_few_rows(spark):
    """Triples have a row for each group of places, windows for each bucket, and rare triples end a window."""
    draw = random.Random(3)
    rows = [("en", " ".join(draw.choice("abcdefgh") for _ in range(3000))) for _ in range(8)]
    texts = collocations._texts(spark.createDataFrame(rows, "lang string, text string").repartition(2), "text", "lang")
    send = spark.sparkContext.broadcast
    full, none = (send(np.full(1 << (collocations.BITMAP_BITS - 3), b, np.uint8)) for b in (255, 0))
    counts = collocations._triple_counts(texts, full, full, 30, 6_000_000).collect()
    assert sum(len(r.low) // 2 for r in counts) <= 2 * 8**3 and max(max(r.n) for r in counts) == 30
    windows = collocations._windows(texts, full, full, none, 5, 6_000_000).collect()
    assert len(windows) <= 2 * 64
    found = Counter()
    for r in windows:
        found.update(dict(zip(r.phrases.split("\n"), np.frombuffer(r.counts, "<i8").tolist(), strict=True)))
    wanted = Counter(f"{a} {b}" for _, t in rows for a, b in zip(t[::2], t[2::2]))
    assert found == wanted
    merged = collocations._summed(collocations._windows(texts, full, full, full, 5, 6_000_000)).collect()
    assert len({r.phrase for r in merged}) == len(merged)
