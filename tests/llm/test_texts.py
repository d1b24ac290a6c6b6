"""Exact dedup, secrets, BPE and packing against brute force."""

import base64
import hashlib
import random as random_numbers
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import bpe, exact_dedup, packing, queries, secrets

from .conftest import TEXTS, by_id


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text or "") for r in rows]


def brute_groups(texts):
    groups = {}
    for doc_id, text in texts:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), []).append(doc_id)
    return sorted(
        ((i, min(ids), len(ids), i == min(ids), sha(t)) for t, ids in groups.items() for i in ids), key=str
    )


def test_exact_groups(edge, texts):
    found = exact_dedup.exact_groups(edge, digest=True)
    assert by_id(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_groups(texts)
    plain = exact_dedup.exact_groups(edge)
    assert by_id(plain, "doc_id", "keep_id", "group_size", "kept") == sorted((r[:4] for r in brute_groups(texts)), key=str)


def test_exact_groups_of_documents(spark, sf_dir):
    found = queries.op4_exact_dedup(spark, sf_dir)
    columns = "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    assert by_id(found, *columns) == brute_groups(documents(spark, sf_dir))


def test_full_bitmap_changes_nothing(edge, texts, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BITMAP_ROWS", 1)
    monkeypatch.setattr(exact_dedup, "PREFIX_CHARS", 1)
    found = exact_dedup.exact_groups(edge)
    assert by_id(found, "doc_id", "keep_id", "group_size", "kept") == sorted((r[:4] for r in brute_groups(texts)), key=str)


def test_deduplicate_keeps_columns(edge):
    kept = exact_dedup.deduplicate(edge)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} == {r[1] for r in brute_groups([(r.doc_id, r.text or "") for r in edge.collect()])}


def brute_base(text):
    spans = []
    for kind, (name, pattern, least) in enumerate(secrets.BASE):
        for m in re.finditer(pattern.replace("(?i)", ""), text, re.I if name == "assign" else 0):
            if len(m[2 if name == "assign" else 0]) >= least:
                spans.append((m.start(), kind, m.end()))
    return [(secrets.KINDS[k], s, e) for s, k, e in sorted(spans)]


def check_secrets(found, texts):
    got = {r.doc_id: r for r in found.collect()}
    for doc_id, text in dict(texts).items():
        base = brute_base(text)
        row = got[doc_id]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(b[0] == k for b in base) for k in secrets.KINDS[:3]]
        assert row.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in base))
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(row.spans.split(","))| {""}
    return got


def test_secrets_of_documents(spark, sf_dir):
    check_secrets(queries.op5_secret_scan(spark, sf_dir), documents(spark, sf_dir))


def test_redact(edge):
    clean = {r.doc_id: r.text for r in secrets.redact(edge).collect()}
    assert clean[0] is None and clean[1] == "" and clean[8] == TEXTS[8]
    assert clean[12] == "[SECRET]' and [SECRET], [SECRET]"
    assert secrets.redact(edge).columns == edge.columns


def test_model_tells_random_strings_from_identifiers(spark):
    """Held-out accuracy: trained on one half of labelled tokens, tested on the other."""
    random = [hashlib.sha256(str(i).encode()).hexdigest()[: 20 + i % 20] for i in range(400)]
    parts = "cust om er ord tot al ind ex val ue in put out fer con ten name list size text".split()
    draw = random_numbers.Random(3)
    plain = ["".join(draw.choice(parts) for _ in range(6)) + f"_{i}" for i in range(400)]
    rows = [([r], re.sub(r"[\d_]", "", p)) for r, p in zip(random[:200], plain[:200])]
    model = secrets.train(spark.createDataFrame(rows, "random array<string>, ordinary string"))
    coded = [base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode()[:32] for i in range(200)]
    held = [(r, True) for r in random[200:] + coded] + [(p, False) for p in plain[200:] if len(p) >= 16]
    table = spark.createDataFrame(held, "value string, label boolean")
    said = table.select("label", (secrets.score(F.col("value"), model) >= secrets.THRESHOLD).alias("found")).collect()
    assert sum(r.label == r.found for r in said) / len(said) > 0.95


def tiktoken_of(name):
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path(name))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check_bpe(found, texts, name):
    import numpy as np

    library = tiktoken_of(name)
    got = {r.doc_id: r for r in found.collect()}
    for doc_id, text in dict(texts).items():
        ids = library.encode_ordinary(text)
        row = got[doc_id]
        assert row.n_tokens == len(ids), (doc_id, text[:100])
        assert row.ids_sha256 == sha(np.array(ids, "<u4").tobytes())
        assert row.decoded_sha256 == sha(text)


@pytest.mark.parametrize("slice_chars", [1, 10**6])
@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe(edge, texts, name, slice_chars):
    found = bpe.digests(edge, public_tokenizers.path(name), public_tokenizers.PATTERN, slice_chars=slice_chars)
    assert found.count() == len(texts)
    check_bpe(found, texts, name)


def test_bpe_of_documents(spark, sf_dir):
    check_bpe(queries.op10_byte_bpe(spark, sf_dir), documents(spark, sf_dir), "byte_bpe_multi_50k.tiktoken")


def test_bpe_ids(edge, texts):
    name = "byte_bpe_50k.tiktoken"
    found = bpe.encode(edge, public_tokenizers.path(name), public_tokenizers.PATTERN)
    library = tiktoken_of(name)
    assert all(r.ids == library.encode_ordinary(dict(texts)[r.doc_id]) for r in found.collect())


def brute_pieces(texts, capacity=2048):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            yield doc_id, n, start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))


def check_packed(packed, texts, capacity=2048):
    rows = packed.collect()
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == sorted(brute_pieces(texts, capacity))
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in rows) // capacity)
    assert len(filled) <= least * 1.02 + 1
    return filled


def test_packing(edge, texts):
    check_packed(packing.pack(packing.pieces(edge, public_tokenizers.path("word_bpe_49k.json"))), texts)


def test_packing_small_capacity_and_parts(edge, texts, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 3)
    found = packing.pieces(edge, public_tokenizers.path("word_bpe_49k.json"), capacity=64)
    check_packed(packing.pack(found, capacity=64), texts, 64)


def test_packing_of_documents(spark, sf_dir):
    check_packed(queries.op9_pack(spark, sf_dir), documents(spark, sf_dir))


def test_sequences(edge, texts):
    packed = packing.pack(packing.pieces(edge, public_tokenizers.path("word_bpe_49k.json"), with_ids=True))
    made = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in made) == sum(p[3] for p in brute_pieces(texts))


@pytest.mark.parametrize("counts", [{5: 3}, {3: 2, 7: 1, 10: 4, 4: 4, 2: 7, 1: 3}, {n: n % 5 + 1 for n in range(1, 11)}])
def test_plan_uses_every_piece_once(counts):
    made = packing.plan(counts, 10)
    used = {}
    for lengths, times in made:
        assert sum(lengths) <= 10 and times > 0
        for n in lengths:
            used[n] = used.get(n, 0) + times
    assert used == counts


def test_exact_complements():
    assert packing.plan({6: 1, 4: 1, 3: 2}, 10)[0] == ((6, 4), 1)
    assert packing.plan({5: 1, 3: 1, 2: 1, 4: 1}, 10)[0] == ((5, 3, 2), 1)
    assert packing.plan({4: 1, 3: 1, 2: 1, 1: 1}, 10)[0] == ((4, 3, 2, 1), 1)


def test_empty_tables(empty):
    path = public_tokenizers.path
    assert exact_dedup.exact_groups(empty, digest=True).count() == 0
    assert exact_dedup.deduplicate(empty).count() == 0
    assert secrets.find_secrets(empty).count() == 0
    assert secrets.redact(empty).count() == 0
    assert bpe.digests(empty, path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
    assert packing.pack(packing.pieces(empty, path("word_bpe_49k.json"))).count() == 0
