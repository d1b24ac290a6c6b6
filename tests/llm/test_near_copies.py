"""The near-copy stage of the pipeline against brute force at its own thresholds."""

import random
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from .test_similar import edited, merged, near_copies  # noqa: E402


def brute_near(rows, percent, shingle):
    """The smallest id of each group of texts similar in their shingles."""
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        sets[i] = {tuple(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))} if words else set()
    ids = sorted(sets)
    pairs = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return set(merged(pairs, ids).values())


def test_near_copies_at_five_words(spark):
    """Copies with a block added, a block changed and scattered edits, between 3 words at 0.9 and 5 words at 0.8."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    texts = [t or "" for _, t in near_copies(3)]
    for size in (900, 300, 60):
        base = [word() for _ in range(size)]
        texts.append(" ".join(base))
        for share in (0.05, 0.09, 0.14, 0.2, 0.24, 0.26, 0.3):
            block = [word() for _ in range(int(share * size))]
            texts.append(" ".join(base + block))
            texts.append(" ".join(base[: -len(block) // 2] + block[: len(block) // 2]))
        texts += [edited(base, edits, draw) for edits in (size // 60, size // 45, size // 40, size // 30)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    wanted = brute_near(rows, 80, 5)
    assert wanted != brute_near(rows, 90, 3)
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == wanted
