import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratelens.llm import queries, warc

SCHEMA = "page_id long, url string, html string, captured_at timestamp"


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "a" * 1200, "é" * 600
    rows = [(1, "http://a.com/ x", big), (2, "http://www.a.com/", big), (2, "http://www.a.com/", big),
            (None, None, big), (5, "u", None), (6, "u", "b"), (7, "u", "b"),
            (8, "http://b.org:8080/q?x=1#f", "\r\n\r\nWARC/1.1\r\n\r\n"), (9, "http://c.de/ü", other), (10, "", other)]
    rows += [(100 + i, f"http://hot.com/{i % 3}", big if i % 2 else f"own {i}") for i in range(60)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "captured_at", F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) % 7))


def test_round_trip_and_revisits(pages):
    source = {(r["page_id"], r["html"]): r for r in pages.collect()}
    holder = {}
    for p, h in source:
        if h and len(h.encode()) >= 1000 and p is not None:
            holder[h] = max(holder.get(h, p), p)
    rows = warc.archive_and_index(pages).collect()
    assert len(rows) == pages.count()
    by = {}
    for r in rows:
        by.setdefault(r["payload_digest"], []).append(r)
    for (p, h) in source:
        data = (h or "").encode()
        mine = [r for r in by[hashlib.sha1(data).hexdigest()] if r["page_id"] == p]
        assert mine and all(r["payload_bytes"] == len(data) for r in mine)
        revisit = h in holder and holder[h] != p
        assert all(r["record_type"] == ("revisit" if revisit else "response") for r in mine)
        assert all(r["refers_to"] == (holder[h] if revisit else None) for r in mine)


def test_index_is_in_global_order(pages):
    rows = warc.archive_and_index(pages).collect()
    key = [(r["url_key"].encode(), r["captured_at"], r["page_id"] is not None, r["page_id"] or 0) for r in rows]
    assert key == sorted(key)


def _keys(rows):
    return [(r["url_key"].encode(), r["captured_at"], r["page_id"] is not None, r["page_id"] or 0) for r in rows]


def test_more_runs_than_the_fan_in(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, archive_bytes=3000)
    runs = warc.capture_runs(spark, path, run_entries=3, fan_in=2)
    assert runs.select("run").distinct().count() > 10
    for rows in (warc.merge_runs(runs, per_range=5, fan_in=2).collect(), warc.merge_runs(runs, fan_in=3).collect()):
        assert len(rows) == pages.count() and _keys(rows) == sorted(_keys(rows))


def test_runs_are_sorted(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, archive_bytes=3000)
    by = {}
    for r in warc.capture_runs(spark, path, run_entries=20).collect():
        by.setdefault(r["run"], []).append(r)
    assert all(_keys(rows) == sorted(_keys(rows)) for rows in by.values())


def test_large_pages_and_bounded_archives(spark, tmp_path):
    import os

    path = str(tmp_path / "w")
    texts = {i: chr(97 + i) * (3_000_000 + i) for i in range(8)} | {100 + i: f"small {i}" for i in range(50)}
    df = spark.createDataFrame([(i, f"http://x.org/{i}", t, "clash") for i, t in texts.items()],
                               "page_id long, url string, html string, archive string").withColumn(
        "captured_at", F.timestamp_seconds(F.lit(0))).coalesce(1)
    warc.write_archives(df, path, archive_bytes=5_000_000)
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".txt")]
    assert len(sizes) >= 5 and max(sizes) <= 5_000_000 + 3_010_000
    rows = warc.merge_runs(warc.capture_runs(spark, path)).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in rows} == {
        i: (len(t), hashlib.sha1(t.encode()).hexdigest()) for i, t in texts.items()}


def test_records_can_be_read_at_their_offsets(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    for r in warc.capture_runs(spark, path).collect():
        assert r["file"].startswith("file:")
        with open(r["file"].removeprefix("file:"), "rb") as f:
            f.seek(r["at"])
            record = f.read(r["length"])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def test_broken_archives_are_refused():
    good = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: u\r\n"
            b"WARC-Payload-Digest: sha1:" + hashlib.sha1(b"hi").hexdigest().encode()
            + b"\r\nContent-Length: 40\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n")
    good = good.replace(b"Content-Length: 40", b"Content-Length: %d" % len(
        b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi"))
    assert [e["page_id"] for e in warc.parse_archive(memoryview(good), "f")] == [1]
    for bad in (good.replace(b"hi", b"ho"), good[:-3], b"junk\r\n\r\n" + good):
        with pytest.raises((ValueError, KeyError)):
            list(warc.parse_archive(memoryview(bad), "f"))


def test_merged_pieces():
    rng = random.Random(1)
    schema = warc._arrow()
    for fan_in in (2, 3, 64):
        pieces = []
        for k in range(rng.randint(0, 12)):
            own = sorted((rng.choice("ab"), str(rng.randint(0, 3)), rng.randint(0, 9)) for _ in range(rng.randint(0, 9)))
            pieces.append(pa.Table.from_pylist([{"url_key": u, "captured_at": c, "page_id": p} for u, c, p in own], schema))
        rows = [r for t in warc.merge_pieces(pieces, fan_in, rows=4) for r in t.to_pylist()]
        assert len(rows) == sum(map(len, pieces)) and _keys(rows) == sorted(_keys(rows))


def test_loser_tree():
    rng = random.Random(0)
    for k in range(14):
        runs = [sorted(rng.choices(range(40), k=rng.randint(0, 15))) for _ in range(k)]
        assert list(warc.LoserTree([iter([((v,), v) for v in r]) for r in runs])) == sorted(sum(runs, []))


def test_url_keys():
    assert warc.url_key("https://WWW.Example.com:443/a?b=1#c") == "com,example)/a?b=1"
    assert warc.url_key("http://x.org:8080") == "org,x:8080)/"
    assert warc.url_key("no url") == "no url" and warc.url_key("http://[bad") == "http://[bad"


def test_empty_table(spark):
    assert warc.archive_and_index(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, sf_dir):
    rows = queries.op6_warc_index(spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"].encode() for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    last = {}
    for p, h in pages.items():
        last[h] = max(p, last.get(h, p))
    assert len(rows) == len(pages)
    for r in rows:
        h = pages[r["page_id"]]
        revisit = len(h) >= 1000 and last[h] != r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(h), hashlib.sha1(h).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (
            ("revisit", last[h]) if revisit else ("response", None))
