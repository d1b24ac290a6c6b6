"""Secret scans: random strings of letters only, and what stands beside a pattern in one token."""

import base64
import hashlib
import random as random_numbers

import pytest

from corpusflow.llm import secrets

LOWER = "abcdefghijklmnopqrstuvwxyz"
WORDS = """customer order total index value input output container name list size text account address
    manager service request response handler factory builder context session message number""".split()


def corpus():
    """Identifiers, rules, numbers and labelled secrets in prose."""
    draw = random_numbers.Random(9)
    rows = []
    for i in range(600):
        name = "_".join(draw.choice(WORDS) for _ in range(4))
        camel = "".join(draw.choice(WORDS).title() for _ in range(4))
        digest = hashlib.sha256(str(i).encode()).hexdigest()
        rows.append(f"see {name} and {camel} of {i}. token={digest[:12]}Q{i} {digest}")
    return rows


def keys():
    draw = random_numbers.Random(10)
    made = ["".join(draw.choice(LOWER) for _ in range(16 + i % 9)) for i in range(30)]
    return made + ["".join(draw.choice(LOWER + LOWER.upper()) for _ in range(16 + i % 9)) for i in range(30)]


@pytest.fixture(scope="module")
def clean(spark):
    """Redacted texts by name."""
    hexes = hashlib.md5(b"x").hexdigest()
    long_key = base64.b64encode(hashlib.sha512(b"k").digest()).decode()[:40]
    access = "AKIA" + "Q7" * 8
    rows = [("corpus", t) for t in corpus()] + [("key", " ".join(keys()[n : n + 10])) for n in range(0, 60, 10)]
    rows += [("plain", t) for t in ("customerAddressManager", "request_response_handler", "=" * 40, "x" * 60, "-" * 30)]
    rows += [("plain", t) for t in ("1234567890123456", "/service/account/session/", "20240131235959123456")]
    rows += [("around", f"{long_key[:20]}{hexes}{long_key[20:]}"), ("around", f"{long_key[:11]}x{access}z{long_key[11:]}")]
    table = spark.createDataFrame(rows, "name string, text string").repartition(3)
    found = {}
    for r in secrets.redact(table).collect():
        found.setdefault(r.name, []).append(r.text)
    return found


def test_letters_only(clean):
    assert sum(t.split().count("[SECRET]") for t in clean["key"]) >= 57


def test_ordinary_stays(clean):
    assert [t for t in clean["plain"] if "[SECRET]" in t] == []
    assert all("see " in t and t.count("[SECRET]") == 2 for t in clean["corpus"])


def test_parts_beside_a_pattern(clean):
    assert all(set(t.replace("[SECRET]", "")) == set() for t in clean["around"]), clean["around"]


def test_spans_of_parts(spark):
    hexes = "0123456789abcdef" * 2
    rows = [(0, f"QzX{hexes}+Kp9 x")] + [(i, t) for i, t in enumerate(corpus(), 1)]
    row = secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("doc_id = 0").first()
    text = rows[0][1]
    assert [(s.start, s.end) for s in row.spans] == [(0, 3), (3, 35), (35, 39)]
    assert all(text[s.start : s.end] == s.value for s in row.spans)


def test_best_threshold():
    assert secrets.best_threshold([]) == secrets.best_threshold([(3, True, 5)]) == 0.0
    assert secrets.best_threshold([(-50, False, 9), (10, True, 4)]) == -0.2
    assert secrets.best_threshold([(-50, False, 9), (-10, True, 1), (0, False, 1), (10, True, 9)]) in (-0.3, 0.05)
