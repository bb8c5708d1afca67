"""WARC archives written and read by Spark, and a merged capture index.

Writing: records are built as strings by DataFrame functions and written by
Spark's text writer, whose line separator is the blank lines that end a WARC
record; so files are committed atomically on whatever store the path names.
Of records with equal payloads of at least ``least`` bytes, the largest
page_id holds the payload and the others are revisit records.

A task begins a new archive where the bytes written would pass a bound, so an
archive has at most that size and one record more, however large the pages.

Reading: archives are read by Spark as binary files; a task parses each file by
its Content-Length headers, checks the digests and sorts the file's index
entries, which are few.  A loser tree merges the files of a task into runs of
bounded length.

Index: the runs go to the shared folder and are cut into ranges of (URL key,
timestamp, page_id).  The pieces of runs that meet in a range are told apart by
their order alone: a piece ends where the next entry is smaller.  They are
merged by loser trees, over several levels if there are more of them than the
fan-in; nothing is sorted again.  Partition order is global order, so all
captures of a URL stand together in time order, however many there are.

Defined results for odd rows: a null html is an empty payload; a null page_id
keeps an empty record id, holds no payload for others and refers to them; a
null url is empty; repeated rows are repeated records (of the largest
page_id, each is a response); white space and control characters in a URL are
percent-encoded; an empty table writes an empty archive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.session import scratch_path

from .common import lean, materialize

_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = ("url_key string, captured_at string, page_id long, url string, payload_bytes long, "
         "payload_digest string, record_type string, refers_to long, file string, at long, "
         "length long, run long")
_ORDER = ("url_key", "captured_at", "page_id")


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def roles(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``digest, holder`` of payloads that several records share."""
    body = F.encode(_payload(F.col("html")), "UTF-8")
    return (pages.where(F.octet_length(_payload(F.col("html"))) >= least)
            .select("page_id", F.sha1(body).alias("digest")).groupBy("digest")
            .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) & F.col("holder").isNotNull()).select("digest", "holder"))


def records(pages: DataFrame, least: int = 1000, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One WARC record per row of ``page_id, url, html, captured_at``."""
    shared = materialize(roles(pages, least), "warc-roles")
    small = shared.count() <= broadcast_rows  # about 50 bytes a row
    html = _payload(F.col("html"))
    rows = pages.select(
        "page_id", "captured_at", html.alias("html"),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.octet_length(html).alias("size"), F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    rows = rows.join(F.broadcast(shared) if small else shared, "digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder")) \
        & (F.col("size") >= least)
    http = F.concat(F.lit(_HTTP), F.col("size").cast("string"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))

    def urn(c: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)),
                                 line("WARC-Refers-To", urn("holder")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return rows.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, least: int = 1000,
                   archive_bytes: int = 64 << 20) -> None:
    """Write ``page_id, url, html, captured_at`` as WARC files below ``path``,
    each of ``archive_bytes`` and one record at most."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, held = 0, 0
        for b in batches:
            numbers = []
            for size in pc.binary_length(b.column("record")).to_pylist():
                if held and held + size + len(_END) > archive_bytes:
                    archive, held = archive + 1, 0
                held += size + len(_END)
                numbers.append(archive)
            yield pa.record_batch({"record": b.column("record"), "archive": pa.array(numbers, pa.int32())})

    (records(pages, least).mapInArrow(lean(number), "record string, archive int")
     .write.partitionBy("archive").option("lineSep", _END).text(path))


def url_key(url: str) -> str:
    """Sortable key: reversed host, then path and query, without scheme,
    ``www.``, default port and fragment."""
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return url
    if not host:
        return url
    host = re.sub(r"^www\d*\.", "", host)
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{where}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def parse_archive(data: memoryview, file: str) -> Iterator[dict]:
    """Index entries of one archive; raises on a broken record."""
    raw = bytes(data)
    at = 0
    while at < len(raw):
        body = raw.index(b"\r\n\r\n", at) + 4
        lines = raw[at:body - 4].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{file}: no WARC record at byte {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(": "), "") for x in lines[1:])
        end = body + int(head["Content-Length"])
        payload = raw.index(b"\r\n\r\n", body) + 4
        size = int(re.search(rb"Content-Length: (\d+)", raw[body:payload]).group(1))
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = head["WARC-Type"]
        if end > len(raw) or raw[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"{file}: record at byte {at} has a wrong length")
        if kind == "response" and (end - payload != size
                                   or hashlib.sha1(raw[payload:end]).hexdigest() != digest):
            raise ValueError(f"{file}: payload at byte {at} does not match its digest")
        yield {"url_key": url_key(head["WARC-Target-URI"]), "captured_at": head.get("WARC-Date", ""),
               "page_id": _page(head["WARC-Record-ID"]), "url": head["WARC-Target-URI"],
               "payload_bytes": size, "payload_digest": digest, "record_type": kind,
               "refers_to": _page(head.get("WARC-Refers-To", "")), "file": file, "at": at,
               "length": end + 4 - at}
        at = end + 4


def _page(urn: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn)
    return int(m[1]) if m else None


def _rank(e: dict) -> tuple:
    """Sort key of an entry; a missing page_id comes first."""
    p = e["page_id"]
    return e["url_key"].encode(), e["captured_at"], p is not None, p or 0


def capture_runs(spark: SparkSession, path: str, run_entries: int = 200_000,
                 fan_in: int = 64) -> DataFrame:
    """Index entries of all archives below ``path``: sorted runs of about
    ``run_entries``, each from the files that one task reads after one another."""
    schema = _arrow()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list[pa.Table] = []
        number = 0

        def merged() -> Iterator[pa.RecordBatch]:
            for t in merge_pieces(files, fan_in):
                yield from t.append_column("run", pa.array([number] * len(t), pa.int64())).to_batches()
            files.clear()

        for b in batches:
            for file, data in zip(b.column("path").to_pylist(), b.column("content")):
                entries = sorted(parse_archive(data.as_buffer(), file), key=_rank)
                if not files:
                    number = int.from_bytes(hashlib.sha1(file.encode()).digest()[:7], "big")
                files.append(pa.Table.from_pylist(entries, schema.remove(len(schema) - 1)))
                if sum(map(len, files)) >= run_entries:
                    yield from merged()
        if files:
            yield from merged()

    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "content").mapInArrow(lean(run), ENTRY))


def _arrow() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ENTRY.split(", "))])


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so the next
    winner takes one match per level."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads: list[tuple | None] = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            held = self.losers[node]
            if held < 0:  # first match of this node: wait for the other side
                self.losers[node] = winner
                return
            if self._beats(held, winner):
                self.losers[node], winner = winner, held
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while True:
            w = self.losers[0]
            head = self.heads[w]
            if head is None:
                return
            yield head[1]
            self.heads[w] = next(self.runs[w], None)
            self._play(w)


def _ranks(t: pa.Table) -> list[tuple]:
    """Sort keys of the entries; a missing page_id comes first."""
    return [(u.encode(), c, p is not None, p or 0) for u, c, p in zip(
        *(t.column(name).to_pylist() for name in _ORDER))]


def ascending(ranks: list[tuple]) -> list[int]:
    """Where the ascending pieces of a list of keys begin, and its end."""
    return [0, *(i for i in range(1, len(ranks)) if ranks[i] < ranks[i - 1]), len(ranks)]


def merge_pieces(pieces: list[pa.Table], fan_in: int, rows: int = 10_000) -> Iterator[pa.Table]:
    """Sorted tables as one, by loser trees of at most ``fan_in`` runs."""
    if not pieces:
        return
    every = pa.concat_tables(pieces)
    ranks = _ranks(every)
    ends = np.cumsum([0, *map(len, pieces)]).tolist()
    runs: list[list[int] | range] = [range(a, b) for a, b in zip(ends, ends[1:])]

    def merged(some: list) -> Iterator[int]:
        return iter(LoserTree([((ranks[i], i) for i in r) for r in some]))

    while len(runs) > fan_in:  # a level: runs in turn become fewer, longer ones
        runs = [list(merged(runs[k:k + fan_in])) for k in range(0, len(runs), fan_in)]
    order = merged(runs)
    while at := list(islice(order, rows)):
        yield every.take(pa.array(at, pa.int64()))


def merge_runs(runs: DataFrame, per_range: int = 100_000, fan_in: int = 64) -> DataFrame:
    """Capture index in global order of URL key, timestamp and page_id.

    Ranges hold about ``per_range`` entries, as page_id splits even a URL
    with any number of captures; a range is merged from its pieces of runs.
    """
    n = max(1, -(-runs.count() // per_range))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [b for b in batches if b.num_rows]
        if not seen:
            return
        every = pa.Table.from_batches(seen)
        cuts = ascending(_ranks(every))
        for t in merge_pieces([every.slice(a, b - a) for a, b in zip(cuts, cuts[1:])], fan_in):
            yield from t.combine_chunks().to_batches()

    return runs.repartitionByRange(n, *_ORDER).mapInArrow(lean(merge), ENTRY)


def archive_and_index(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and
    return the merged index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least)
    return merge_runs(materialize(capture_runs(spark, path), "warc-runs"))
