"""WARC archives of pages, with a two-level capture index for range reads.

Archives are gzip files with one member per record, so any record can be read by its offset and
length. Equal payloads are stored once: the capture with the largest page_id is a response, the
others are revisits that refer to it.

The index has two levels. Captures are sorted by their reversed-host URL key; lines of a few
thousand captures form a compressed block, the blocks of a key range form an index file, and a
sparse directory beside the file names the first key of every block. A lookup is sent to the index
files whose key range holds its key, binary-searches the directory, reads the one or two blocks
with the key by their ranges, binary-searches their lines, and then reads the records by range.

Archives and index are plain files in the shared folder. Their names are new for every attempt of a
task and only rows of finished attempts name them, so a lost executor leaves unused files at most.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.store import stored
from marketloom.session import new_folder

MIN_BYTES = 0  # smaller payloads are always stored
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 2000
FILE_CAPTURES = 200_000
MAX_FILES = 4096  # index files; with KEY_CHARS the bound of what a lookup broadcasts
KEY_CHARS = 256
HOT_SHARE = 256  # payloads of 1 / HOT_SHARE of all pages: at most that many
WINDOW = 16 << 20  # records of this range of an archive are read by one task
TASK_BYTES = 64 << 20  # archived bytes that a task reads
READ_BYTES = 1 << 20

# --- fixed values: names of the WARC 1.1 format -------------------------------------------------
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
# --- end of fixed values ------------------------------------------------------------------------

CAPTURES = "key string, page_id long, record_type string, archive string, offset long, length long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: str | None) -> str:
    """Host parts reversed, then the rest: ``http://a.b.com/x`` is ``com,b,a)/x``. A-Z of the host
    are lower-cased, blanks and control characters escaped; null is the empty key, and a URL
    without ``://`` is its own key."""
    if not url:
        return ""
    url = clean_url(url)
    head, found, rest = url.partition("://")
    if not found:
        return url
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:]


def clean_url(url: str) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1: ten digits are eight letters."""
    part = lambda i: F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(i) for i in range(4)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, html, digest, and the response (page_id, url) that a revisit refers to.

    Payloads are grouped by their digests only. A payload that many pages share is joined from a
    broadcast of at most HOT_SHARE rows, the other shared ones by a join of its own size.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32(F.sha1(F.col("html").cast("binary"))))
    slim = rows.filter(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url")).alias("response"))
    shared = stored(slim.filter("n > 1 and response.page_id is not null"), "shared-payloads")
    total = F.lit(pages.count())
    hot, rest = (shared.filter(c).select(F.col("digest").alias("shared"), "response") for c in
                 (F.col("n") * HOT_SHARE >= total, F.col("n") * HOT_SHARE < total))
    first = rows.join(F.broadcast(hot), F.col("digest") == F.col("shared"), "left").select("page_id", "url", "html", "digest", F.col("response").alias("hot"))
    # Rows that are joined already get keys of their own, which meet nothing and lie anywhere.
    key = F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    response = F.coalesce("hot", "response")
    revisit = ~F.col("page_id").eqNullSafe(response["page_id"])
    return first.withColumn("_key", key).join(rest, F.col("_key") == F.col("shared"), "left").select(
        "page_id", "url", "html", "digest", F.when(response.isNotNull() & revisit, response).alias("response"))


# --- writing ------------------------------------------------------------------------------------

def _head(fields: Iterable[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def _record(page_id, url, html: str, digest: str, response) -> tuple[str, bytes]:
    payload = html.encode("utf-8", "replace")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if response is None else "revisit"
    target = clean_url(url) if url is not None else None
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"), ("WARC-Date", DATE),
              ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if response is None:
        return kind, _head(fields, http + payload)
    refers = response["url"]
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{response['page_id']}>"),
               ("WARC-Refers-To-Target-URI", clean_url(refers) if refers is not None else None), ("WARC-Refers-To-Date", DATE)]
    return kind, _head(fields, http)


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _write(folder: str, limit: int):
    """Writes the pages of a task to archives; a row per record says where it stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("archive", pa.string()),
                            ("offset", pa.int64()), ("length", pa.int64())])
        out, at, rows, name = None, 0, [], ""
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    store.create_dir(path, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                    info = _member(_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                          ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    out.write(info)
                    at = len(info)
                kind, record = _record(r["page_id"], r["url"], r["html"], r["digest"], r["response"])
                member = _member(record)
                out.write(member)
                rows.append((url_key(r["url"]), r["page_id"], kind, name, at, len(member)))
                at += len(member)
                if at >= limit:
                    out.close()
                    yield _rows(rows, schema)
                    out, rows = None, []
        if out is not None:
            out.close()
            yield _rows(rows, schema)
    return run


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes planned records as archives; returns the captures. Pages stay in their tasks."""
    plan = records.select("page_id", "url", "html", "digest", "response")
    return stored(plan.mapInArrow(_write(folder, archive_bytes), CAPTURES), "captures")


# --- index --------------------------------------------------------------------------------------

def _write_index(folder: str, lines_per_block: int):
    """Sorted captures of a key range as compressed blocks, and their directory in a file beside."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        name, directory, out, at, lines, n, last = f"index-{uuid.uuid4().hex}", [], None, 0, [], 0, ""

        def block():
            nonlocal at, lines
            data = zlib.compress("\n".join(lines).encode(), 6)
            out.write(data)
            directory.append((json.loads(lines[0])[0], at, len(data)))
            at, lines = at + len(data), []

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    store.create_dir(path, recursive=True)
                    out = store.open_output_stream(f"{path}/{name}.blocks", compression=None)
                last = r["key"]
                lines.append(json.dumps([last, r["page_id"], r["record_type"], r["archive"], r["offset"], r["length"]], ensure_ascii=False))
                n += 1
                if len(lines) == lines_per_block:
                    block()
        if out is not None:
            if lines:
                block()
            out.close()
            with store.open_output_stream(f"{path}/{name}.directory", compression=None) as f:
                f.write("\n".join(json.dumps(x, ensure_ascii=False) for x in directory).encode())
            yield pa.RecordBatch.from_pylist([{"file": name, "first": directory[0][0][:KEY_CHARS], "last": last[:KEY_CHARS],
                                               "blocks": len(directory), "captures": n}], pa.schema([
                ("file", pa.string()), ("first", pa.string()), ("last", pa.string()), ("blocks", pa.int64()), ("captures", pa.int64())]))
    return run


def write_index(captures: DataFrame, folder: str, file_captures: int = FILE_CAPTURES, lines_per_block: int = BLOCK_LINES) -> DataFrame:
    """Index files and directories in the folder; returns one row per file: its first and last
    key (KEY_CHARS characters of them), blocks and captures. Captures of one key may span files."""
    files = max(1, min(MAX_FILES, -(-captures.count() // file_captures)))
    order = ["key", "page_id", "archive", "offset"]
    ranged = captures.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(_write_index(folder, lines_per_block), "file string, first string, last string, blocks long, captures long"), "index-files")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())], ["key"])


def _route(files):
    """The index files whose range of keys can hold a key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, firsts, lasts = files.value
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                k = key[:KEY_CHARS]
                out += [(names[i], key) for i in range(bisect.bisect_left(lasts, k), bisect.bisect_right(firsts, k))]
            yield _rows(out, pa.schema([("file", pa.string()), ("key", pa.string())]))
    return run


class _IndexFile:
    """Directory and blocks of one index file; the last block read is kept."""

    def __init__(self, store, path: str, name: str):
        with store.open_input_stream(f"{path}/{name}.directory", compression=None) as f:
            self.directory = [json.loads(x) for x in f.read().decode().split("\n")]
        self.firsts = [x[0] for x in self.directory]
        self.blocks = store.open_input_file(f"{path}/{name}.blocks")
        self.at, self.lines, self.keys = -1, [], []

    def _load(self, i: int) -> None:
        if i != self.at:
            _, offset, length = self.directory[i]
            self.lines = [json.loads(x) for x in zlib.decompress(self.blocks.read_at(length, offset)).decode().split("\n")]
            self.at, self.keys = i, [x[0] for x in self.lines]

    def captures(self, key: str) -> Iterator[list]:
        """The block before the first one that begins with the key may end with it."""
        for i in range(max(0, bisect.bisect_left(self.firsts, key) - 1), bisect.bisect_right(self.firsts, key)):
            self._load(i)
            yield from self.lines[bisect.bisect_left(self.keys, key):bisect.bisect_right(self.keys, key)]


def _search(folder: str):
    """Captures of requested keys, from rows sorted by index file and key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("archive", pa.string()),
                            ("offset", pa.int64()), ("length", pa.int64())])
        name, index, found = None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["file"] != name:
                    name, index = r["file"], _IndexFile(store, path, r["file"])
                for capture in index.captures(r["key"]):
                    found.append(tuple(capture))
                    if len(found) == 10_000:
                        yield _rows(found, schema)
                        found = []
        yield _rows(found, schema)
    return run


def lookup(urls: DataFrame, index_files: DataFrame, folder: str) -> DataFrame:
    """All captures of the URLs in the first column: key, page_id, record_type, archive, offset,
    length. A URL that is asked for twice is answered once; null asks for captures without URL."""
    rows = sorted((r["first"], r["last"], r["file"]) for r in index_files.collect())  # MAX_FILES at most
    firsts, lasts, names = ([r[i] for r in rows] for i in range(3))
    files = urls.sparkSession.sparkContext.broadcast((names, firsts, lasts))
    keys = urls.select(F.col(urls.columns[0]).cast("string")).mapInArrow(_keys, "key string").distinct()
    asked = keys.mapInArrow(_route(files), "file string, key string")
    # A part of an index file per task: its requests, however many, are sent by ranges.
    asked = asked.repartitionByRange("file", "key").sortWithinPartitions("file", "key")
    return asked.mapInArrow(_search(folder), CAPTURES)


# --- reading ------------------------------------------------------------------------------------

def parse_record(member: bytes) -> dict:
    """Fields of a record, with its payload; the payload of a response is checked against its digest."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: payload does not match its digest")
    number = lambda x: None if x in (None, "<urn:page:null>") else int(x[10:-1])
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload if response else None}


def _read(folder: str, payload: bool):
    """Records of sorted captures; neighbours in an archive are read by one range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())])
        name, source = None, None
        for batch in batches:
            rows, i = batch.to_pylist(), 0
            while i < len(rows):
                if rows[i]["archive"] != name:
                    name = rows[i]["archive"]
                    source = store.open_input_file(f"{path}/{name}")
                j, start = i + 1, rows[i]["offset"]
                end = start + rows[i]["length"]
                while j < len(rows) and rows[j]["archive"] == name and rows[j]["offset"] == end and end - start < READ_BYTES:
                    end += rows[j]["length"]
                    j += 1
                data, out = source.read_at(end - start, start), []
                for r in rows[i:j]:
                    record = parse_record(data[r["offset"] - start:r["offset"] - start + r["length"]])
                    body = record.pop("payload")
                    out.append(record | {"html": body.decode() if payload and body is not None else None})
                yield pa.RecordBatch.from_pylist(out, schema)
                i = j
    return run


def read_records(captures: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Records of captures by range reads: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, html (of responses, if asked for; revisits have none of their own)."""
    captures = stored(captures, "captures-to-read")
    # Captures are small and the records behind them aren't: tasks are counted by the bytes they read.
    tasks = max(1, -(-(captures.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES), captures.sparkSession.sparkContext.defaultParallelism)
    part = F.expr(f"offset div {WINDOW}")
    dealt = captures.withColumn("part", part).repartition(tasks, "archive", "part").sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(_read(folder, payload), RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES, **names) -> tuple[str, DataFrame]:
    """Writes archives and index of all pages; returns their folder and the index files."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    captures = write_archives(plan_records(pages, min_bytes, **names), folder)
    return folder, write_index(captures, folder)


def warc_digest(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per page, read back from the archives through the index.

    Null html is an empty payload. Rows that repeat the largest page_id of a payload are responses
    all; pages without id revisit the others of their payload, and are responses where no page of it
    has one. URLs may be null, repeated or of any length; blanks and control characters in
    them are escaped. Other columns are not read; an empty table gives no rows.
    """
    folder, files = archive_pages(pages, None, min_bytes)
    found = lookup(pages.select("url"), files, folder)
    return read_records(found, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def digest_sql(min_bytes: int = MIN_BYTES) -> str:
    """DuckDB twin: SHA-1 in base32, the largest page_id of every payload."""
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS x FROM p),
d AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(x, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4)::INT)) & 31)::INT, 1)), 'string_agg', '') AS payload_digest FROM h),
r AS (SELECT payload_digest, max(page_id) AS response FROM d WHERE payload_bytes >= {min_bytes} GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest,
  CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM d LEFT JOIN r ON d.payload_digest = r.payload_digest AND payload_bytes >= {min_bytes}"""
