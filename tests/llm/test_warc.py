"""Archives and their index: round trips, the file format, lookups, rows of all kinds."""

import base64
import gzip
import hashlib
import json
import zlib
from collections import Counter

import pytest
from helpers import CLASHING, LONG, SMALL, table
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from marketloom.llm import warc

PAGES = [
    (1, "http://a.example.com/x", "<p>same</p>"), (2, "http://A.example.com/x", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "http://b.org", None),
    (5, "no scheme", ""), (6, "https://b.org/\r\nInjected: 1 x", "é\x00\U0001f600"), (None, "http://c.net/", "<p>same</p>"), (None, "http://c.net/", "alone"),
    (7, "http://c.net/?q#f", LONG), (8, "http://" + "long" * 500 + ".com/", "once"), (8, "http://twice.com/", "once"), (9, "http://twice.com/", "\r\n\r\nWARC/1.1\r\n"),
    (10, "http://twice.com/", "x" * 300_000), (11, "", "")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("mine") for c in (*CLASHING, "digest", "response", "archive", "offset")})


def plain(rows, least=0):
    out = Counter()
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    for i, p in payloads:
        same = [j for j, q in payloads if q == p and j is not None]
        first = max(same, default=None) if len(p) >= least else i
        revisit = first is not None and first != i
        out[i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", first if revisit else None] += 1
    return out


@pytest.mark.parametrize("least", [0, 5, 10 ** 9])
def test_edges(spark, least):
    assert Counter(map(tuple, warc.warc_digest(pages(spark), least).collect())) == plain(PAGES, least)
    assert warc.warc_digest(pages(spark, [])).collect() == []


def test_archives_are_warc_files_and_give_the_pages_back(spark, tmp_path):
    df = table(spark, SMALL, "pages")
    folder, files = warc.archive_pages(df.repartition(3), f"file://{tmp_path}/w")
    names = sorted(p.name for p in (tmp_path / "w").glob("*.warc.gz"))
    n = 0
    for name in names:
        data = gzip.decompress((tmp_path / "w" / name).read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and rest[int(fields["Content-Length"]):][:4] == b"\r\n\r\n"
            data = rest[int(fields["Content-Length"]) + 4:]
            n += fields["WARC-Type"] != "warcinfo"
    assert n == df.count() == files.agg(F.sum("captures")).first()[0]
    back = warc.read_records(warc.lookup(df.select("url"), files, folder), folder)
    assert back.select("page_id", "url", "html").exceptAll(df.select("page_id", "url", "html")).isEmpty() and back.count() == n


def test_small_archives_blocks_and_index_files(spark, tmp_path, monkeypatch):
    """Keys that span blocks and files are found whole; others aren't found."""
    rows = [(i, f"http://h{i % 7}.com/p{i % 3}", f"body {i % 50}") for i in range(500)] + [(1000 + i, "http://hot.com/", "hot") for i in range(400)]
    df, folder = spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w"
    captures = warc.write_archives(warc.plan_records(df.repartition(4)), folder, archive_bytes=4000)
    assert captures.select("archive").distinct().count() > 8
    files = warc.write_index(captures, folder, file_captures=100, lines_per_block=7)
    assert files.count() > 4 and files.agg(F.max("blocks")).first()[0] > 5
    asked = spark.createDataFrame([("http://hot.com/",), ("http://hot.com/",), ("http://h3.com/p1",), ("http://none.com/",), ("http://zzz",), (None,)], "u string")
    found = warc.lookup(asked, files, folder)
    want = Counter(i for i, u, _ in rows if u in ("http://hot.com/", "http://h3.com/p1"))
    assert Counter(r["page_id"] for r in found.collect()) == want
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    out = warc.read_records(warc.lookup(df.select("url"), files, folder), folder)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out.collect()) == plain(rows)


def test_index_is_sorted_and_sparse(spark, tmp_path):
    rows = [(i, f"http://x{i:04d}.com/", "b") for i in range(1000)]
    folder = f"{tmp_path}/w"
    files = warc.write_index(warc.write_archives(warc.plan_records(spark.createDataFrame(rows, "page_id long, url string, html string")), folder), folder,
                             lines_per_block=100).collect()
    assert len(files) == 1 and files[0]["blocks"] == 10
    store, path = pafs.FileSystem.from_uri(folder)
    directory = [json.loads(x) for x in store.open_input_stream(f"{path}/{files[0]['file']}.directory", compression=None).read().decode().split("\n")]
    blocks = store.open_input_file(f"{path}/{files[0]['file']}.blocks")
    lines = [json.loads(x) for _, at, n in directory for x in zlib.decompress(blocks.read_at(n, at)).decode().split("\n")]
    assert [x[0] for x in lines] == sorted(x[0] for x in lines) and len(lines) == 1000 and [x[0] for x in directory] == [lines[i][0] for i in range(0, 1000, 100)]


def test_hot_payloads_are_joined_from_a_bounded_broadcast(spark):
    rows = [(i, f"http://h/{i}", "hot" if i % 3 == 0 else f"pair {i // 2}") for i in range(3000)]
    assert Counter(map(tuple, warc.warc_digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())) == plain(rows)


def test_url_keys():
    assert warc.url_key("HTTP://User.Example.COM:80/Path?Q") == "com:80,example,user)/Path?Q"
    assert warc.url_key(None) == "" and warc.url_key("plain text") == "plain%20text" and warc.url_key("http://") == ")"


def test_a_damaged_payload_is_noticed():
    kind, record = warc._record(1, "http://a/", "text", warc.digest_of(b"text"), None)
    assert kind == "response" and warc.parse_record(warc._member(record))["payload"] == b"text"
    with pytest.raises(ValueError):
        warc.parse_record(warc._member(record.replace(b"\r\n\r\ntext", b"\r\n\r\ntaxt")))
