"""Queries over whole tables against brute force."""

import hashlib
import re

from corpusflow.llm import queries, suffix_dedup

from .test_similar import merged
from .test_texts import documents


def test_ngram_jaccard_of_documents(spark, sf_dir):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_ngram_jaccard(spark, sf_dir).collect()}
    sets = {}
    for i, text in documents(spark, sf_dir):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets[i] = {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()
    ids = sorted(sets)
    pairs = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    assert pairs
    groups = merged(pairs, ids)
    assert found == {i: (len(sets[i]), groups[i]) for i in ids}


def test_suffix_dedup_of_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    coded = [text.encode() for _, text in docs]
    kept = suffix_dedup.brute_force(coded, 200)
    found = {r.doc_id: r for r in queries.op7_suffix_dedup(spark, sf_dir).collect()}
    assert len(found) == len(docs) and sum(len(c) - len(k) for c, k in zip(coded, kept)) > 1000
    for (i, _), before, after in zip(docs, coded, kept):
        row = found[i]
        assert (row.n_bytes, row.n_removed) == (len(before), len(before) - len(after))
        assert row.kept_sha256 == hashlib.sha256(after).hexdigest()
