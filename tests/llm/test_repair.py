"""Conversation repair against exhaustive search."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from corpusflow.llm import queries, repair

SHAPE = re.compile(r"(s?(ua)+)?\Z")
NEXT = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, must go, truncated): all edits, state by state."""

    @lru_cache(maxsize=None)
    def best(at, state, inserts):
        found = []
        if at == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            role = {"u": "assistant"}.get(state, "user")
            cost, audit, made = best(at, role[0], inserts + 1)
            found.append((cost + 3, "I" + audit, ((role, ""), *made)))
        if at < len(rows):
            role, text, gone, cut = rows[at]
            cost, audit, made = best(at + 1, state, 0)
            found.append((cost + 4, "D" + audit, made))
            if not gone:
                for new, price, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    behind = NEXT.get((state, new[:1]))
                    if behind:
                        cost, audit, made = best(at + 1, behind, 0)
                        found.append((cost + price + 3 * cut, letter + audit, ((new, text), *made)))
        return min(found) if found else (10**9, "~", ())

    for at in range(len(rows), -1, -1):  # from behind, so that calls stay shallow
        for state in ("a", "u", "s", ""):
            found = best(at, state, 0)
    return found


def brute(rows):
    """The report on the rows (turn, role, text) of one conversation."""
    key = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], key(r)))
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    seen, marked = set(), []
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, made = cheapest(tuple(marked))
    assert SHAPE.match("".join(r[0] for r, _ in made))
    text = "\n".join(f"{r}:{t}" for r, t in made)
    return (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += [
            (turn, "user" if how == 4 else role, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text)
        ] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def answers(df):
    found = df.collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found}


def invented(seed, n, longest):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "", None, "usher"]
    texts = ["Yes.", "no", "", " \n", "Why? ", "Go!\t", None, "a", "b."]
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(longest)):
            spot = draw.choice([turn, turn, turn, None, turn * 2])
            role = draw.choice(roles) if draw.random() < 0.5 else roles[turn % 2]
            text = draw.choice(texts) if draw.random() < 0.4 else f"{turn}{draw.choice(['.', '', '!'])}"
            rows.append((conv if conv % 7 else None, spot, role, text))
    return rows


@pytest.mark.parametrize("kinds_from", ["suaoSUAO-", "ua", "uUaA", "s-o"])
def test_divide_and_conquer(kinds_from):
    """Every way to cut rows into blocks gives the cheapest, least audit."""
    draw = random.Random(3)
    for _ in range(300):
        kinds = "".join(draw.choice(kinds_from) for _ in range(draw.randrange(1, 10)))
        role = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "-": "user"}
        rows = tuple((role[k.lower()], "", k == "-", k.isupper()) for k in kinds)
        cost, wanted, _ = cheapest(rows)
        size = draw.randrange(1, len(kinds) + 1)
        blocks = [kinds[i : i + size] for i in range(0, len(kinds), size)]
        states = repair.crossings([repair.summed(b) for b in blocks], repair.START, repair._FINISH)
        found = [repair.audit(b, p, q) for b, p, q in zip(blocks, [repair.START, *states], states)]
        ending = repair.ENDING[states[-1]]
        assert "".join(found) + ending == wanted
        assert sum(map(repair.total_cost, blocks, found)) + 3 * len(ending) == cost


@pytest.mark.parametrize("bits", [repair.BLOCK_BITS, 1])
def test_invented_conversations(spark, monkeypatch, bits):
    """Nulls in every column, equal turns, repeated rows, unknown roles; also with blocks of two rows."""
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = invented(1, 120, 14) + [(5, 0, "user", "twice.")] * 3 + [(900, 4, None, None), (901, None, "user", "x" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    df = df.withColumn("pos", df.turn).withColumn("Conv", df.conv_id).withColumn("kind", df.role)
    plain = defaultdict(list)
    for conv, turn, role, text in rows:
        plain[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert answers(repair.report(df)) == {c: brute(r) for c, r in plain.items()}
    broken = damaged(rows)
    assert any(not r for r in broken.values()) or set(broken) == set(plain)
    assert answers(repair.report(repair.damage(df), df)) == {c: brute(broken[c]) for c in plain}


def test_one_conversation_over_many_blocks(spark, monkeypatch):
    """One conversation with most rows, cut into many blocks over several tasks."""
    monkeypatch.setattr(repair, "BLOCK_BITS", 4)
    draw = random.Random(2)
    rows = [(1, t, draw.choice(["user", "assistant", "system"]), f"{t} {draw.choice('.!x')}") for t in range(250)]
    rows += [(c, t, ["user", "assistant"][t % 2], f"{t}.") for c in range(2, 20) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(6)
    found = answers(repair.report(df))
    assert found[1] == brute([r[1:] for r in rows if r[0] == 1])
    assert {found[c][5:7] for c in range(2, 20)} == {(0, "KKKK")}


def test_repaired_turns(spark):
    rows = invented(4, 40, 9)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = defaultdict(list)
    for r in repair.repair(df).orderBy("turn").collect():
        made[r.conv_id].append((r.turn, r.role, r.text))
    digests = {}
    for conv, turns in made.items():
        assert [t for t, _, _ in turns] == list(range(len(turns)))
        assert SHAPE.match("".join(r[0] for _, r, _ in turns))
        digests[conv] = hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in turns).encode()).hexdigest()
    nothing = hashlib.sha256(b"").hexdigest()
    assert {c: digests.get(c, nothing) for c in {r[0] for r in rows}} == {c: a[7] for c, a in answers(repair.report(df)).items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.report(repair.damage(df), df).collect() == []


def test_query_on_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    broken = damaged(rows)
    found = queries.op11_conversation_repair(spark, sf_dir)
    assert found.columns == ["conv_id", *COLUMNS]
    assert answers(found) == {c: brute(broken[c]) for c in {r[0] for r in rows}}
