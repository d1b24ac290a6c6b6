"""WARC archives and their capture index, merged from locally sorted runs.

Pages are written as WARC records by Spark's text writer: the two empty lines
that end a record are its line separator, so a file is a valid archive on any
file system that Spark reaches. Equal payloads are archived once, later copies
as revisit records. Reading back, every archive yields one run of captures,
sorted by URL key and timestamp where it was read. The runs are stored, dealt
out by ranges of (URL key, timestamp, page), and each range merges its k slices
with a loser tree: capture histories in global order. A URL with very many
captures is cut by its timestamps, so no task holds it whole.

Cases: null html is an empty payload, a null URL an empty one. Payloads of at
least ``min_revisit_bytes`` are deduplicated, empty ones too if it is 0. Rows
that repeat a page id are captures of their own; those with the smallest id of
their payload are all responses. A null page id is a response of its own and
sorts before the others of its URL and time. An empty table gives no captures.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import table_path, written

#: Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

#: Records of an archive file by the bytes of their payloads: up to 32 KB, up to 1 MB, beyond. A file is read
#: back by one task, whole, and takes some 64 MB at most, or one record.
FILE_CLASSES = ((32 * 1024, 2000), (1024 * 1024, 64), (None, 1))
#: Index rows that a task merges, about.
RANGE_ROWS = 1_000_000
#: Capture time of page 0 in seconds since 1970; page n follows n seconds later.
FIRST_CAPTURE = 1_704_067_200


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 5 hex digits are 20 bits are 4 letters."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def captures(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, digest, record type and the page a revisit refers to.

    A page without an id is never referred to, unless none of its payload has one, and never a revisit.
    """
    rows = pages.select(
        "page_id",
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("bigint")).withColumn("digest", base32_sha1(F.col("payload")))
    # counted before anything is joined; only payloads that several pages share are left
    groups = rows.filter(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("copies")
    )
    groups = written(groups.filter("copies > 1").select("digest", "first_page"))
    # one row stands against all copies of a payload: AQE splits a payload with very many
    joined = rows.join(groups, "digest", "left")
    revisit = F.coalesce(F.col("first_page") < F.col("page_id"), F.lit(False))
    return joined.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).otherwise("").alias("payload"),
        "bytes",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_page")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame, path: str, min_revisit_bytes: int = 0, classes: tuple[tuple[int | None, int], ...] | None = None
) -> None:
    """Write WARC files below ``path``, one write for each class of payload sizes that there is."""
    classes = classes or FILE_CLASSES
    rows, above = captures(pages, min_revisit_bytes), -1
    size = F.octet_length(F.coalesce("html", F.lit("")))
    limits = [limit for limit, _ in classes]
    inside = [
        F.max((size > low) & (F.lit(True) if high is None else size <= high))
        for low, high in zip([-1, *limits[:-1]], limits, strict=True)
    ]
    for (limit, records), some in zip(classes, pages.agg(*inside).first(), strict=True):
        # the bytes of the payload, whatever the record holds of it
        part = rows.filter(F.col("bytes") > above)
        part = part if limit is None else part.filter(F.col("bytes") <= limit)
        if some or above < 0:
            _write_records(part, path, records)
        above = limit


def _write_records(rows: DataFrame, path: str, records: int) -> None:
    seconds = F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + FIRST_CAPTURE)
    date = F.date_format(F.to_utc_timestamp(seconds, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    is_revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(HTTP_HEAD), F.col("payload"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.0\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Date", date),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            is_revisit,
            F.concat(
                _header("WARC-Profile", F.lit(REVISIT_PROFILE)),
                _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
            ),
        ).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    writer = rows.select(record.alias("value")).write.option("lineSep", RECORD_END)
    writer.option("maxRecordsPerFile", records).mode("append").text(path)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, no scheme, port, ``www`` or fragment, query sorted."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    path = parts.path.rstrip("/") or "/"
    return ",".join(reversed(host.split("."))) + ")" + path + ("?" + query if query else "")


def parse_archive(content: bytes) -> Iterator[dict]:
    """The captures of one archive; lengths and digests of responses come from their bytes."""
    at, http = 0, len(HTTP_HEAD.encode())
    while at < len(content):
        head_end = content.index(b"\r\n\r\n", at)
        lines = content[at:head_end].decode("utf-8").split("\r\n")[1:]
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(": "), "") for line in lines)
        begin = head_end + 4
        end = begin + int(fields["Content-Length"])
        payload = content[begin + http : end]
        page = lambda name: fields[name][len("<urn:page:") : -1]  # noqa: B023, E731
        response = fields["WARC-Type"] == "response"
        yield {
            "url_key": url_key(fields["WARC-Target-URI"]),
            "captured": fields["WARC-Date"],
            "page_id": int(page("WARC-Record-ID")) if page("WARC-Record-ID") else None,
            "payload_bytes": len(payload) if response else int(fields["WARC-Payload-Length"]),
            "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if response
            else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": fields["WARC-Type"],
            "refers_to": None if response else int(page("WARC-Refers-To")),
            "record_offset": at,
            "record_bytes": end - at,
        }
        at = end + len(RECORD_END)


def _order(capture: dict) -> tuple:
    page = capture["page_id"]
    return (capture["url_key"], capture["captured"], page is not None, page or 0)


_CAPTURE = (
    "url_key string, captured string, page_id bigint, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint, record_offset bigint, record_bytes bigint"
)
_RUN = f"run string, place bigint, {_CAPTURE}"
_NULLABLE = ("page_id", "refers_to")


def sorted_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of every archive below ``path`` in sorted order: (run, place, capture...)."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"], strict=True):
                found = sorted(parse_archive(bytes(content)), key=_order)
                if found:
                    table = pd.DataFrame(found).astype({c: "Int64" for c in _NULLABLE})
                    table.insert(0, "place", range(len(found)))
                    table.insert(0, "run", name.rsplit("/", 1)[-1])
                    yield table

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(runs, _RUN)


class LoserTree:
    """Merges k sorted lists: inner nodes keep the loser of their match, the root the winner."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.tree = [-1] * self.k  # tree[0]: the winner
        for run in range(self.k):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        """Whether the head of run a comes before that of run b; a run that has ended comes last."""
        left, right = self.runs[a], self.runs[b]
        if self.at[a] >= len(left):
            return False
        if self.at[b] >= len(right):
            return True
        x, y = left[self.at[a]], right[self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            rival = self.tree[node]
            if rival < 0:  # first round: wait here for the other side
                self.tree[node] = run
                return
            if self._beats(rival, run):
                self.tree[node], run = run, rival
            node //= 2
        self.tree[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            run = self.tree[0]
            if self.at[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self._play(run)


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in global order: (merge_part, merge_place, run, capture...).

    ``runs`` is a written result of ``sorted_runs``. Order by merge_part and
    merge_place is order by URL key, timestamp and page. A task holds the index
    rows of one range, no payloads; there are as many ranges as it takes to keep
    them at about ``range_rows``. Equal captures are told apart by run and place,
    so they may be cut, too.
    """
    columns = runs.columns
    parts = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(runs.count() / range_rows))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[str, list[tuple]] = {}
        tables, base = [], 0
        for table in batches:
            tables.append(table)
            keys = zip(table["run"], table["url_key"], table["captured"], table["page_id"], strict=True)
            for row, (run, url, captured, page) in enumerate(keys, base):
                known = not pd.isna(page)
                slices.setdefault(run, []).append((url, captured, known, int(page) if known else 0, row))
            base += len(table)
        if not tables:
            return
        order = [head[-1] for head in LoserTree([slices[run] for run in sorted(slices)])]
        merged = pd.concat(tables, ignore_index=True).iloc[order]
        merged.insert(0, "merge_place", range(len(merged)))
        merged.insert(0, "merge_part", TaskContext.get().partitionId())
        merged[list(_NULLABLE)] = merged[list(_NULLABLE)].astype("Int64")
        yield merged

    dealt = runs.repartitionByRange(parts, "url_key", "captured", "page_id", "run", "place").sortWithinPartitions("run", "place")
    schema = f"merge_part int, merge_place bigint, {_RUN}"
    return dealt.select(*columns).mapInPandas(merge, schema)


def archive_index(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write archives for ``pages``, read them back, and merge their capture index."""
    path = table_path(pages.sparkSession)
    write_archives(pages, path, min_revisit_bytes)
    return merge_runs(written(sorted_runs(pages.sparkSession, path)))
