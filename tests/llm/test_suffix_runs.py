"""Suffix-array dedup: what moves, anchors too common for one task, lists beyond a broadcast."""

import random

import numpy as np
import pytest

from corpusflow.llm import suffix_dedup

from .test_similar import repeated_texts


def kept_and_spans(found):
    return {r.doc_id: (bytes(r.kept), r.n_spans) for r in found.collect()}


def expected(texts, length=200):
    """The bytes that stay and the stretches that go, by brute force."""
    coded = [(t or "").encode() for t in texts]
    seen = {}
    for text in coded:
        for at in range(len(text) - length + 1):
            seen[text[at : at + length]] = seen.get(text[at : at + length], 0) + 1
    spans = []
    for text in coded:
        gone = np.zeros(len(text) + 1, bool)
        for at in range(len(text) - length + 1):
            if seen[text[at : at + length]] > 1:
                gone[at : at + length] = True
        spans.append(int((gone[:-1] & ~gone[1:]).sum()))
    return dict(enumerate(zip(suffix_dedup.brute_force(coded, length), spans, strict=True)))


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)


def test_repeated_starts():
    draw = np.random.default_rng(4)
    for length, letters, n in ((9, 2, 400), (32, 2, 300), (200, 1, 500), (40, 3, 900), (200, 2, 150)):
        data = draw.integers(97, 97 + letters, n).astype(np.uint8)
        data[n // 2 : n // 2 + n // 4] = data[: n // 4]
        ends = np.array([n // 3, n // 2 + n // 4, n])  # three pieces; strings do not cross them
        left = ends[np.searchsorted(ends, np.arange(n), side="right")] - np.arange(n)
        strings = [data[p : p + length].tobytes() if left[p] >= length else None for p in range(n)]
        wanted = [p for p in range(n) if strings[p] is not None and strings.count(strings[p]) > 1]
        assert suffix_dedup.repeated_starts(data, left, length).tolist() == wanted


def test_only_runs_at_the_ends_of_copies_move(spark, monkeypatch):
    """No row for each byte, no text of runs that occur again as a whole or nowhere else."""
    draw = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz .,"
    drawn = lambda n: "".join(draw.choices(letters, k=n))
    passages = [drawn(3000) for _ in range(5)]
    texts = [drawn(2000) + passages[i % 5] + drawn(2000) for i in range(40)]
    moved = []

    def watched(found, length, act=suffix_dedup.group_matches):
        moved.append(found.selectExpr("count(*)", "sum(length(bytes))").first())
        return act(found, length)

    def forbidden(frags):
        raise AssertionError("a row for each byte")

    monkeypatch.setattr(suffix_dedup, "group_matches", watched)
    monkeypatch.setattr(suffix_dedup, "first_keys", forbidden)
    assert kept_and_spans(suffix_dedup.remove_repeats(table(spark, texts))) == expected(texts)
    (rows, size), total = moved[0], sum(map(len, texts))
    assert 0 < rows <= 40 * 2 * 3 and size < total / 3


@pytest.mark.parametrize(("group_runs", "length"), [(1, 200), (4, 200), (1, 64), (1, 32)])
def test_anchors_too_common_for_one_task(spark, monkeypatch, group_runs, length):
    """Their runs are cut into slices; what is common still goes to the suffix array of all tasks."""
    texts = repeated_texts(group_runs)
    seen = {"slices": [], "partial_matches": []}
    for name in seen:
        def watched(rows, length, act=getattr(suffix_dedup, name), calls=seen[name]):
            calls.append(rows.count())
            return act(rows, length)

        monkeypatch.setattr(suffix_dedup, name, watched)
    found = suffix_dedup.remove_repeats(table(spark, texts), length, group_runs=group_runs)
    assert kept_and_spans(found) == expected(texts, length)
    if length == 32:
        assert not seen["slices"]  # runs of one string have no others
    else:
        assert seen["slices"][0] > group_runs
    if (group_runs, length) == (1, 200):
        assert seen["partial_matches"]


def test_slices_leave_little_of_a_common_passage(spark, monkeypatch):
    """A passage in all texts: of the pieces around its ends one slice each reaches the suffix array of all tasks."""
    draw = random.Random(9)
    drawn = lambda n: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz .,", k=n))
    passage = drawn(900)
    texts = [drawn(500) + passage + drawn(500) for _ in range(60)]
    seen = {}
    for name in ("slices", "partial_matches"):
        def watched(rows, length, act=getattr(suffix_dedup, name), name=name):
            seen[name] = rows.selectExpr("count(*)", "sum(length(bytes))").first()
            return act(rows, length)

        monkeypatch.setattr(suffix_dedup, name, watched)
    assert kept_and_spans(suffix_dedup.remove_repeats(table(spark, texts), group_runs=20)) == expected(texts)
    assert seen["slices"][0] >= 2 * 60
    assert seen.get("partial_matches", (0, 0))[0] <= 2 * 60


@pytest.mark.parametrize("limit", [800, 1])
def test_lists_beyond_a_broadcast(spark, settings, monkeypatch, limit):
    """Texts meet the lists part by part; at the least limit they move."""
    texts = repeated_texts(77)
    parts = []

    def watched(rows, lookup, key, act=suffix_dedup.in_parts):
        parts.append(act(rows, lookup, key))
        return parts[-1]

    monkeypatch.setattr(suffix_dedup, "in_parts", watched)
    settings(broadcastBytes=limit)
    assert kept_and_spans(suffix_dedup.remove_repeats(table(spark, texts))) == expected(texts)
    assert parts[0] is None if limit == 1 else len(parts[0]) > 1


def test_equal_runs_in_one_block_and_in_others(spark):
    """Copies that only one block has, that several have, and periodic bytes, whose every string is a run."""
    draw = random.Random(3)
    a, b = ("".join(draw.choices("abcdefgh", k=600)) for _ in range(2))
    texts = [a, a + "!", "?" + b, b, "z" * 700, a[:350] + "z" * 450, None, b[100:350]]
    wanted = expected(texts)
    for rows in (table(spark, texts), table(spark, texts).coalesce(1), table(spark, texts).repartition(8)):
        for block in (250, 1 << 21):
            assert kept_and_spans(suffix_dedup.remove_repeats(rows, 200, block)) == wanted


def test_ids_that_repeat_or_are_null(spark):
    draw = random.Random(5)
    a, b, c = ("".join(draw.choices("abcdefgh", k=500)) for _ in range(3))
    rows = [(None, a), (None, b + a), (1, c), (1, c), (1, b[:100]), (None, None)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    kept = sorted(((r.doc_id, bytes(r.kept)) for r in found.collect()), key=str)
    assert kept == sorted([(None, b""), (None, b.encode()), (1, b""), (1, b""), (1, b[:100].encode()), (None, b"")], key=str)
