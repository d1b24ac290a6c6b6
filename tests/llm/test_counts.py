"""Token counts and repetition rules against the library and brute force."""

import random

import public_tokenizers
import pytest

from corpusflow.llm import queries, repetition, tokencount

from .conftest import TEXTS, by_id
from .test_texts import documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    return tokencount.Counter(tokencount.Vocabulary.from_model(MODEL))


@pytest.mark.parametrize("chunk", [1, 7, 1 << 15])
def test_edge_texts(counter, library, chunk):
    for text in TEXTS:
        if chunk > 1 or len(text or "") < 2000:
            assert counter.count(text or "", chunk) == len(library.encode(text or "")), text


def test_random_texts(counter, library):
    draw = random.Random(5)
    letters = "aabbeett  ▁\n\tiion.,'🙂漢字é\x00thréer1 2<>/s"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(60)))
        assert counter.count(text, draw.choice([3, 10, 1000])) == len(library.encode(text)), repr(text)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED_STATES", 5)
    counter = tokencount.Counter(tokencount.Vocabulary.from_model(MODEL))
    for text in TEXTS:
        assert counter.count(text or "") == len(library.encode(text or ""))


def test_maps_compose_associatively(counter):
    chunks = ["▁the▁qu", "ick", "brown.", "▁▁fox\n", "jumps▁", "▁over"]
    maps = [counter.state_map(c) for c in chunks]
    left = maps[0]
    for m in maps[1:]:
        left = counter.compose(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = counter.compose(m, right)
    assert left == right == counter.scan(maps)[-1]


def test_token_counts(edge, texts, library):
    found = by_id(tokencount.token_counts(edge, MODEL), "doc_id", "n_bytes", "n_tokens", "over_limit")
    counts = [(i, len(t.encode()), len(library.encode(t))) for i, t in texts]
    assert found == sorted(((*c, c[2] > 4096) for c in counts), key=str)


def test_token_counts_of_documents(spark, sf_dir, library):
    found = {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, sf_dir).collect()}
    assert found == {i: len(library.encode(t)) for i, t in documents(spark, sf_dir)}


def brute_repeats(text, least=8):
    words = repetition.WORD.findall(text)
    places = {}
    for i in range(len(words) - least + 1):
        places.setdefault(tuple(words[i : i + least]), []).append(i)
    covered = {i + j for found in places.values() if len(found) > 1 for i in found for j in range(least)}
    longest = 0
    if covered:
        rows = [[0] * (len(words) + 1)]
        for i in range(len(words)):
            rows.append([0] * (len(words) + 1))
            for j in range(i):
                if words[i] == words[j]:
                    rows[-1][j + 1] = rows[-2][j] + 1
                    longest = max(longest, rows[-1][j + 1])
            rows = rows[-1:]
    return words, len(covered), longest


def wanted_measures(text):
    words, covered, longest = brute_repeats(text)
    lines = [line for line in text.split("\n") if repetition.WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in repetition.SYMBOLS),
        len(lines) - len(set(lines)),
        covered,
        longest,
    )


NAMES = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat"


@pytest.mark.parametrize("block", [1, 3_000_000])
def test_repetition(spark, block):
    draw = random.Random(2)
    texts = [t for t in TEXTS if len(t or "") < 6000]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randrange(120))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: tuple(r[n] for n in NAMES) for r in repetition.measure(docs, block_chars=block).collect()}
    assert found == {i: wanted_measures(t or "") for i, t in enumerate(texts)}


def test_quality_of_documents(spark, sf_dir):
    found = {r.doc_id: r for r in queries.op2_quality_rules(spark, sf_dir).collect()}
    for doc_id, text in documents(spark, sf_dir):
        words, row = repetition.WORD.findall(text), found[doc_id]
        covered = [len(repeated_places(words, least)) for least in (8, 20, 101)]
        failed = len(words) < 20 or 100 * covered[0] > 30 * len(words)
        assert (row.n_words, row.n_repeat_words, row.base_failed) == (len(words), covered[0], failed)
        assert row.kept == (not failed and covered[1] <= 0.20 * len(words) and not covered[2])


def repeated_places(words, least):
    places = {}
    for i in range(len(words) - least + 1):
        places.setdefault(tuple(words[i : i + least]), []).append(i)
    return {i + j for found in places.values() if len(found) > 1 for i in found for j in range(least)}


def test_reject(edge):
    kept = repetition.reject(edge)
    assert kept.columns == edge.columns == repetition.reject(edge).columns
    ids = {r.doc_id for r in repetition.judge(repetition.measure(edge)).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids
    assert 11 not in ids and 5 not in ids  # too short; one sentence again and again


def test_coverage_rejects_what_the_base_keeps(spark):
    """A passage of 40 words twice in 300 words; phrases of 10 words as often cover as much and stay."""
    words = [f"w{i}" for i in range(300)]
    passage = words[:110] + words[:40] + words[110:260]
    phrases = []
    for at in range(0, 40, 10):
        phrases += words[at : at + 10] + words[200 + at : 203 + at]
    phrases = words[:200] + phrases + words[250:300]
    rows = [(1, " ".join(passage)), (2, " ".join(phrases)), (3, " ".join(words))]
    measured = repetition.measure(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = {r.doc_id: r for r in repetition.judge(measured).collect()}
    assert (found[1].n_repeat_words, found[1].n_long_words, found[1].base_failed, found[1].kept) == (80, 80, False, False)
    assert (found[2].n_repeat_words, found[2].n_long_words, found[2].base_failed, found[2].kept) == (80, 0, False, True)
    assert found[3].kept


def test_a_long_repeat_is_rejected(spark):
    words = [f"w{i}" for i in range(1000)]
    docs = spark.createDataFrame([(1, " ".join(words + words[:101])), (2, " ".join(words + words[:100]))], "doc_id bigint, text string")
    assert by_id(repetition.judge(repetition.measure(docs)), "doc_id", "base_failed", "kept") == [(1, False, False), (2, False, True)]


def test_empty(empty):
    assert tokencount.token_counts(empty, MODEL).count() == 0
    assert repetition.reject(empty).count() == 0
    assert repetition.measure(empty).count() == 0
