"""Chat formatting and WARC archives against brute force."""

import base64
import hashlib
import random

from corpusflow.llm import chat, queries, warc

from .conftest import by_id

TURNS = [
    (1, 0, "system", "Be & <b>brief</b>"),
    (1, 1, "user", None),
    (1, 2, "assistant", "<|end|> [INST] &lt; | &amp;"),
    (1, 3, "user", "more?"),
    (1, 4, "assistant", ""),
    (1, 5, "user", "bye"),
    (2, 1, "assistant", "b"),
    (2, 1, "assistant", "a"),
    (2, 0, "user", "x" * 20000),
    (2, 0, "user", "x" * 20000),
    (3, 0, None, "no role"),
    (None, None, "a|>b", "<|user|>"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string"


def conversations(turns):
    found = {}
    for conv, turn, role, text in turns:
        found.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(rows)] for c, rows in found.items()}


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*t, "clash") for t in TURNS], SCHEMA)
    formatted = chat.format_conversations(turns)
    back = {r.conv_id: [tuple(x) for x in r.t] for r in formatted.select("conv_id", chat.parse(formatted.formatted).alias("t")).collect()}
    wanted = conversations(TURNS)
    assert back == wanted

    texts = chat.example_texts(formatted).collect()
    assert len(texts) == sum(r == "assistant" for rows in wanted.values() for r, _ in rows)
    targets = {(r.conv_id, r.turn, r.loss_start): r for r in chat.expand(formatted).collect()}
    plain = dict(reversed(pair) for pair in chat.ESCAPES)
    for example in texts:
        assert example.text.endswith(chat.END)
        target = targets[example.conv_id, example.turn, example.loss_start]
        assert target.text_end == len(example.text)
        assert example.text[example.loss_start : example.loss_end] == target.target
        reply = target.target
        for coded in reversed([c for _, c in chat.ESCAPES]):
            reply = reply.replace(coded, plain[coded])
        assert ("assistant", reply) in wanted[example.conv_id]


def test_chat_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    extra = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    wanted = []
    for conv, turns in conversations([*map(tuple, rows), *extra]).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        everything = "".join(f"{r}\n{t}\n" for r, t in turns)
        wanted.append((conv, len(turns), *(hashlib.sha256(x.encode()).hexdigest() for x in (everything, loss)), len(loss)))
    found = by_id(queries.op6_chat_format(spark, sf_dir), "conv_id", "n_turns", "turns_sha256", "loss_sha256", "loss_chars")
    assert found == sorted(wanted, key=str)


PAGES = [
    (5, "http://www.b.org:80/x?b=2&a=1#f", "same"),
    (2, "https://b.org/x/?a=1&b=2", "same"),
    (9, "not a url [", "same"),
    (7, None, None),
    (8, "http://a.org/", ""),
    (3, "http://a.org/\r\nX: y", "WARC/1.0\r\n\r\n\r\n\r\nContent-Length: 5\r\n\r\n"),
    (1, "http://ü.org/é", "漢字 " * 5000),
    (5, "http://www.b.org:80/x?b=2&a=1#f", "same"),
]


def wanted_captures(pages, least):
    payloads = [(p, (h or "").encode()) for p, _, h in pages]
    first = {}
    for page, payload in payloads:
        first[payload] = min(page, first.get(payload, page))
    rows = []
    for page, payload in payloads:
        revisit = len(payload) >= least and first[payload] < page
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        rows.append((page, len(payload), digest, "revisit" if revisit else "response", first[payload] if revisit else None))
    return sorted(rows, key=str)


COLUMNS = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"


def test_warc(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id bigint, url string, html string, digest string")
    for least in (0, 3, 100):
        assert by_id(warc.archive_index(pages, least), *COLUMNS) == wanted_captures(PAGES, least)


def test_warc_global_order(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(warc, "FILE_CLASSES", ((None, 7),))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = warc.archive_index(pages.unionByName(pages)).collect()
    rows.sort(key=lambda r: (r.merge_part, r.merge_place))
    keys = [(r.url_key, r.captured, r.page_id) for r in rows]
    assert keys == sorted(keys)
    assert len({r.run for r in rows}) > 8


def test_warc_query(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert by_id(queries.op8_warc(spark, sf_dir), *COLUMNS) == wanted_captures(pages, 0)


def test_loser_tree():
    draw = random.Random(1)
    for k in range(9):
        runs = [sorted((draw.randrange(20), i) for _ in range(draw.randrange(6))) for i in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_url_key():
    assert warc.url_key("http://www.B.org:80/x?b=2&a=1#f") == warc.url_key("https://b.org/x/?a=1&b=2") == "org,b)/x?a=1&b=2"


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.archive_index(pages).count() == 0
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_pages_in_small_files(spark, tmp_path):
    """Pages of 2 MB: a file has few records, of large pages one; ranges of few rows keep the order."""
    draw = random.Random(1)
    pages = [(i, f"http://a.org/{i % 7}", "x" * draw.choice([0, 5, 900, 40_000])) for i in range(60)]
    pages += [(100 + i, "http://b.org/", chr(65 + i % 3) * 2_000_000) for i in range(6)]
    pages += [(None, "http://c.org/", "alone"), (None, "http://c.org/", None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    classes = ((1000, 10), (50_000, 4), (None, 1))
    warc.write_archives(df, str(tmp_path / "w"), 0, classes)
    sizes = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert max(sizes) < 2_100_000 and len(sizes) >= 6 + 4
    runs = warc.written(warc.sorted_runs(spark, str(tmp_path / "w")))
    by_page = {r.page_id: r for r in runs.filter("page_id IS NOT NULL").collect()}
    assert len(by_page) == 66 and runs.count() == 68
    assert sum(r.record_type == "response" for i, r in by_page.items() if i >= 100) == 3
    assert all(r.refers_to == i - 3 for i, r in by_page.items() if i > 102)
    for range_rows in (7, warc.RANGE_ROWS):
        merged = sorted(warc.merge_runs(runs, range_rows).collect(), key=lambda r: (r.merge_part, r.merge_place))
        order = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in merged]
        assert order == sorted(order) and len(merged) == 68
    nulls = runs.filter("page_id IS NULL").collect()
    assert sorted(r.payload_bytes for r in nulls) == [0, 5] and all(r.record_type == "response" for r in nulls)
