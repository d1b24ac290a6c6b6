"""Words and marks against the tokenizer's own library, and texts that share an id."""

import random

import public_tokenizers
import pytest

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from corpusflow.llm import exact_dedup, jaccard, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_every_letter_before_a_mark():
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    for mark in ".!":
        encoder = packing.WordEncoder(PATH)
        texts = [letter + mark for letter in letters]
        found = [ids.tolist() for ids in encoder.encode(texts)]
        assert found == [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("remembered", [20, 400_000])
def test_random_words(remembered):
    """Also when words are forgotten all the time."""
    draw = random.Random(3)
    odd = "İक़ড়א́ẞ가가ßſΣς'’.,;:!?1²½_- \n\t "
    encoder = packing.WordEncoder(PATH, remembered)
    for _ in range(40):
        texts = ["".join(draw.choice(odd + "abcab  ") for _ in range(draw.randrange(60))) for _ in range(50)]
        wanted = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
        assert [ids.tolist() for ids in encoder.encode(texts)] == wanted


def test_words_that_differ_in_case_are_encoded_once():
    """op9_pack: the library lower-cases them; control words and letters under a mark keep their case."""
    encoder = packing.WordEncoder(PATH)
    texts = ["The the THE thE's DON'T", "<|ENDOFTEXT|> <|endoftext|> x<|EndOfText|>y A<|startoftext|>B", "J\u030c j\u030c H\u0331 İ I\u0307 \u212a K ẞ", ""]
    wanted = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == wanted
    assert "the" in encoder.words and not {"The", "THE", "DON'T"} & set(encoder.words)


def test_a_triple_uses_its_longest_once():
    assert packing.plan({5: 1, 4: 1, 3: 1, 2: 1, 8: 1}, 20)[0] == ((8, 5, 4, 3), 1)
    counts = {5: 1, 4: 1, 3: 1, 2: 1}
    index = packing.ComplementIndex(packing.np.array([counts.get(n, 0) for n in range(13)]))
    assert index.triple(12) == (5, 4, 3)
    assert index.counts.tolist() == [counts.get(n, 0) for n in range(13)]


LONG = " ".join(f"w{i}" for i in range(60))
SHARED = [
    (1, "same words here", "a"),
    (2, "same  words here", "b"),
    (2, "a unique other text", "c"),
    (3, "dup", "d"),
    (3, "dup", "d"),
    (None, "dup", "e"),
    (None, "null id alone", "f"),
    (4, None, "g"),
    (4, "", "h"),
    (5, LONG, "i"),
    (6, LONG + " more", "j"),
    (6, "quite another text", "k"),
    (6, LONG + " more", "j"),
]
SCHEMA = "doc_id bigint, text string, _number string"


@pytest.mark.parametrize("stored", [False, True])
def test_rows_go_by_row_not_by_id(spark, tmp_path, stored):
    docs = spark.createDataFrame(SHARED, SCHEMA).repartition(4)
    if stored:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    exact = exact_dedup.deduplicate(docs)
    assert exact.columns == docs.columns
    kept = sorted((tuple(r) for r in exact.collect()), key=str)
    assert len(kept) == len(SHARED) - 5
    texts = [" ".join((t or "").split()) for _, t, _ in kept]
    assert len(set(texts)) == len(texts)
    assert {(i, " ".join((t or "").split())) for i, t, _ in kept} >= {(1, "same words here"), (2, "a unique other text"), (3, "dup")}

    near = jaccard.one_of_each(docs, percent=80, shingle=5)
    assert near.columns == docs.columns
    kept = [tuple(r) for r in near.collect()]
    # both empty texts stay: they are linked with nothing
    assert sorted(i for i, t, _ in kept if t and t.startswith("w0")) == [5]
    assert {(i, t) for i, t, _ in kept} >= {(2, "a unique other text"), (6, "quite another text"), (None, "null id alone")}
    assert sum(t == "dup" for _, t, _ in kept) == 1 and sum(not t for _, t, _ in kept) == 2
    assert len(kept) == len(SHARED) - 1 - 2 - 2


def test_lookups_by_shuffle_give_the_same(spark, settings):
    docs = spark.createDataFrame(SHARED, SCHEMA).repartition(3)
    wanted = sorted((tuple(r) for r in exact_dedup.deduplicate(docs).collect()), key=str)
    near = sorted((tuple(r) for r in jaccard.one_of_each(docs).collect()), key=str)
    settings(broadcastBytes=0)
    assert [r[:1] for r in sorted((tuple(r) for r in exact_dedup.deduplicate(docs).collect()), key=str)] == [w[:1] for w in wanted]
    assert [r[:1] for r in sorted((tuple(r) for r in jaccard.one_of_each(docs).collect()), key=str)] == [w[:1] for w in near]


def test_empty_tables_stay_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for stage in (corpus_pipeline.exact_copies, corpus_pipeline.near_copies):
        assert stage(spark, docs, "").collect() == []
