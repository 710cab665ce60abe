"""WARC archives with a two-level capture index.

Writing: payloads are compared by SHA-1; of equal ones the largest id is the response, the others
are revisits of it. Captures are range-partitioned and sorted by reversed-host URL key; each task
writes one archive (a gzip member per record), its capture lines in compressed blocks, and a sparse
directory with the first key of each block. File names carry the task attempt, and only files in the
committed block table count, so a repeated task does no harm.

Reading back: a look-up searches the list of archives (one row per writing task), then that archive's
directory, then the block, all by bisection, and reads only the ranges it needs. Keys are dealt out by
archive and looked up in order, so neighbours share a block, and a URL that was captured very often
is read by as many tasks as its captures fill archives. A whole archive can also be scanned by its
block table. Payloads are checked against their digests in the tasks and handed on only if asked for.

Archives are written and read through a file system that Python tasks reach, in the folder given.

Defined results: a null html is an empty payload, a null url has an empty key. Rows that repeat an
id and a payload are all responses where they are the largest.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.llm.common import arrow_fields, in_batches, ship_package, stored
from tillpanel.storage.shared import new_folder

#: Records of a block, which ends early when they are so many bytes.
BLOCK_LINES, BLOCK_BYTES = 1000, 1 << 23
CAPTURE_TIME = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCKS = (
    "archive string, captures string, directory string, block int, first_key string, last_key string, "
    "n_lines long, captures_offset long, captures_length long, archive_offset long, archive_length long"
)


def open_folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# ---- keys and revisits ---------------------------------------------------------------------------


def url_key(url: Column) -> Column:
    """``https://a.example.org/x?y`` -> ``org,example,a)/x?y``; the scheme and port are left out."""
    url = F.coalesce(url, F.lit(""))
    after = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(after, r"^([^/?#:]*)", 1))
    rest = F.regexp_replace(after, r"^[^/?#]*", "")
    key = F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), rest)
    return F.when(url == "", F.lit("")).otherwise(F.regexp_replace(key, r"[\s]", "%20"))


def packed_captures(pages: DataFrame) -> DataFrame:
    """Each page as a response record, compressed before it is moved, with its SHA-1 and size."""

    def start():
        def work(columns):
            out = {name: [] for name in ("page_id", "url", "sha1", "n_bytes", "member")}
            for page_id, url, html in zip(*(columns[n] for n in ("page_id", "url", "html")), strict=True):
                payload = (html or "").encode("utf-8")
                sha1 = hashlib.sha1(payload).hexdigest()
                raw = make_record(page_id, url, payload, base32(sha1), len(payload), None)
                row = (page_id, url, sha1, len(payload), gzip.compress(raw, 6, mtime=0))
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
            return out

        return work

    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return in_batches(slim, "page_id long, url string, sha1 string, n_bytes long, member binary", start)


def repeated_payloads(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, response): the largest id of each payload that several pages hold."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return (
        pages.select(F.col("page_id").cast("long").alias("page"), payload.alias("payload"))
        .filter(F.octet_length("payload") >= min_bytes)
        .groupBy(F.sha1("payload").alias("digest"))
        .agg(F.max("page").alias("response"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
    )


def with_revisits(captures: DataFrame, repeated: DataFrame) -> DataFrame:
    """``captures`` with ``refers_to``, the response that one repeats; its own record then goes."""
    refers = F.when(F.col("response") != F.col("page_id"), F.col("response"))
    return (
        captures.join(repeated, F.col("sha1") == F.col("digest"), "left")
        .withColumn("refers_to", refers)
        .withColumn("member", F.when(F.col("refers_to").isNull(), F.col("member")))
        .drop("response", "digest")
    )


# ---- records ------------------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id, url, payload: bytes | None, digest: str, n_bytes: int, refers_to) -> bytes:
    """One record; a revisit (``payload`` None) has HTTP headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + (f"Content-Length: {n_bytes}\r\n\r\n").encode() + (payload or b"")
    headers = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": CAPTURE_TIME,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if payload is None:
        headers |= {"WARC-Refers-To": record_id(refers_to), "WARC-Profile": REVISIT_PROFILE}
    headers |= {
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers, HTTP headers, and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    http_headers = dict(line.split(": ", 1) for line in http.decode("utf-8").split("\r\n")[1:])
    return {"headers": headers, "http": http_headers, "payload": payload}


def base32(sha1: str) -> str:
    """A hexadecimal digest in the form that archives use."""
    return base64.b32encode(bytes.fromhex(sha1)).decode("ascii")


def payload_digest(payload: bytes) -> str:
    return base32(hashlib.sha1(payload).hexdigest())


# ---- writing ------------------------------------------------------------------------------------


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, block_lines: int = BLOCK_LINES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to ``folder``; gives the block table."""
    ship_package(pages.sparkSession)
    # Records are moved in compressed form; payloads are compared by a reading of their own.
    captures = with_revisits(packed_captures(pages), repeated_payloads(pages, min_bytes))
    ready = captures.withColumn("urlkey", url_key(F.col("url")))
    fields = arrow_fields(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if batch.num_rows and writer is None:
                writer = _ArchiveWriter(folder, block_lines)
            for row in batch.to_pylist():
                writer.add(row)
        if writer is not None:
            rows = writer.close()
            yield pa.RecordBatch.from_pylist(rows, schema=fields)

    ordered = ready.repartitionByRange("urlkey", "page_id").sortWithinPartitions("urlkey", "page_id")
    return stored(ordered.mapInArrow(run, BLOCKS), "warc-blocks")


class _ArchiveWriter:
    """One archive with its capture blocks and directory."""

    def __init__(self, folder: str, block_lines: int):
        context = TaskContext.get()
        part, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, 0)
        name = f"{part:06d}-{attempt}-{uuid.uuid4().hex[:8]}"
        self.files, root = open_folder(folder)
        self.files.create_dir(root, recursive=True)
        self.names = {
            "archive": f"{name}.warc.gz", "captures": f"{name}.cdxj.gz", "directory": f"{name}.dir",
        }
        self.out = {k: self.files.open_output_stream(f"{root}/{n}", compression=None) for k, n in self.names.items()}
        self.archive_at = self.captures_at = self.block_start = 0
        self.block_lines, self.lines, self.keys, self.rows = block_lines, [], [], []

    def add(self, row: dict) -> None:
        member, digest = row["member"], base32(row["sha1"])
        revisit = member is None
        if revisit:
            raw = make_record(row["page_id"], row["url"], None, digest, row["n_bytes"], row["refers_to"])
            member = gzip.compress(raw, 6, mtime=0)
        fields = {
            "url": row["url"], "mime": "warc/revisit" if revisit else "text/html", "status": "200",
            "digest": digest, "offset": self.archive_at, "length": len(member),
            "filename": self.names["archive"],
        }
        time = "".join(c for c in CAPTURE_TIME if c.isdigit())
        self.lines.append(f"{row['urlkey']} {time} {json.dumps(fields, ensure_ascii=False)}\n")
        self.keys.append(row["urlkey"])
        self.out["archive"].write(member)
        self.archive_at += len(member)
        if len(self.lines) == self.block_lines or self.archive_at - self.block_start >= BLOCK_BYTES:
            self.end_block()

    def end_block(self) -> None:
        if not self.lines:
            return
        packed = gzip.compress("".join(self.lines).encode("utf-8"), 6, mtime=0)
        self.out["captures"].write(packed)
        self.out["directory"].write(
            f"{self.keys[0]}\t{self.captures_at}\t{len(packed)}\t{len(self.lines)}\n".encode()
        )
        self.rows.append(self.names | {
            "block": len(self.rows), "first_key": self.keys[0], "last_key": self.keys[-1],
            "n_lines": len(self.lines), "captures_offset": self.captures_at,
            "captures_length": len(packed), "archive_offset": self.block_start,
            "archive_length": self.archive_at - self.block_start,
        })
        self.captures_at += len(packed)
        self.block_start = self.archive_at
        self.lines, self.keys = [], []

    def close(self) -> list[dict]:
        self.end_block()
        for stream in self.out.values():
            stream.close()
        return self.rows


# ---- reading ------------------------------------------------------------------------------------


def read_range(files, path: str, offset: int, length: int) -> bytes:
    with files.open_input_file(path) as source:
        return source.read_at(length, offset)


def capture_lines(packed: bytes) -> list[tuple[str, dict]]:
    """(url key, fields) of a compressed block."""
    lines = gzip.decompress(packed).decode("utf-8").split("\n")[:-1]
    split = (line.split(" ", 2) for line in lines)
    return [(key, json.loads(fields)) for key, _, fields in split]


def _page_of(reference: str | None) -> int | None:
    inner = (reference or "").removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def _record_row(raw: bytes, payloads: bool = True) -> dict:
    record = parse_record(raw)
    headers = record["headers"]
    response = headers["WARC-Type"] == "response"
    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    digest = payload_digest(record["payload"]) if response else stated
    if digest != stated:
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    return {
        "page_id": _page_of(headers["WARC-Record-ID"]),
        "url": headers["WARC-Target-URI"],
        "record_type": headers["WARC-Type"],
        "refers_to": None if response else _page_of(headers["WARC-Refers-To"]),
        "payload_bytes": len(record["payload"]) if response else int(record["http"]["Content-Length"]),
        "payload_digest": digest,
        "payload": record["payload"] if response and payloads else None,
    }


def read_archives(blocks: DataFrame, folder: str) -> DataFrame:
    """Every record that the index lists: one range read of captures and one of the archive per block.

    The payload of a revisit is that of the record it refers to; here it is null, with its length and digest.
    """

    def start():
        files, root = open_folder(folder)

        def work(columns):
            rows = []
            for archive, captures, at, size, archive_at, archive_size in zip(
                *(columns[n] for n in ("archive", "captures", "captures_offset", "captures_length",
                                       "archive_offset", "archive_length")), strict=True,
            ):
                lines = capture_lines(read_range(files, f"{root}/{captures}", at, size))
                span = read_range(files, f"{root}/{archive}", archive_at, archive_size)
                for _, fields in lines:
                    first = fields["offset"] - archive_at
                    rows.append(_record_row(zlib.decompress(span[first : first + fields["length"]], 31)))
            return {n: [r[n] for r in rows] for n in (part.split()[0] for part in RECORDS.split(", "))}

        return work

    # A number of its own keeps the blocks apart however few bytes their table has.
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, F.col("archive"), F.col("block"))
    return in_batches(spread, RECORDS, start, chunk_rows=1)


class CaptureIndex:
    """Look-ups by URL in the archives of a block table."""

    def __init__(self, blocks: DataFrame, folder: str):
        self.spark: SparkSession = blocks.sparkSession
        self.folder = folder
        # One row per archive, and so per task that wrote.
        self.archives = sorted(
            tuple(r) for r in blocks.groupBy("archive", "captures", "directory")
            .agg(F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
            .select("first_key", "last_key", "archive", "captures", "directory").collect()
        )

    def _routed(self, keys: DataFrame) -> DataFrame:
        """Each key with the archives that may hold it; a frequent key fills several, one after the other."""
        shared = self.spark.sparkContext.broadcast([a[:2] for a in self.archives])

        def start():
            ranges = shared.value
            lasts = [last for _, last in ranges]

            def work(columns):
                found = []
                for key in columns["urlkey"]:
                    at = bisect.bisect_left(lasts, key)
                    while at < len(ranges) and ranges[at][0] <= key:
                        found.append((at, key))
                        at += 1
                return {"archive_no": [at for at, _ in found], "urlkey": [key for _, key in found]}

            return work

        return in_batches(keys, "archive_no int, urlkey string", start)

    def lookup(self, urls: DataFrame, payloads: bool = True) -> DataFrame:
        """The records captured under the URLs (a column ``url``); a URL never captured gives no row."""
        shared = self.spark.sparkContext.broadcast(self.archives)
        folder = self.folder

        def start():
            reader = _IndexReader(folder)

            def work(columns):
                names = [part.split()[0] for part in RECORDS.split(", ")]
                rows = [
                    _record_row(raw, payloads)
                    for number, key in zip(columns["archive_no"], columns["urlkey"], strict=True)
                    for raw in reader.records(shared.value[number][2:], key)
                ]
                return {n: [r[n] for r in rows] for n in names}

            return work

        keys = urls.select(url_key(F.col("url")).alias("urlkey")).distinct()
        dealt = self._routed(keys).repartitionByRange("archive_no", "urlkey")
        return in_batches(dealt.sortWithinPartitions("archive_no", "urlkey"), RECORDS, start, chunk_rows=64)


class _IndexReader:
    """Bisection in directories and blocks; the directory and block at hand are kept."""

    def __init__(self, folder: str):
        self.files, self.root = open_folder(folder)
        self.listing = self.block = None
        self.directory: tuple[list[str], list[tuple[int, int]]] = ([], [])
        self.lines: tuple[list[str], list[dict]] = ([], [])

    def open_directory(self, name: str) -> None:
        if name == self.listing:
            return
        size = self.files.get_file_info(f"{self.root}/{name}").size
        text = read_range(self.files, f"{self.root}/{name}", 0, size).decode("utf-8")
        parts = [line.split("\t") for line in text.split("\n")[:-1]]
        self.directory = [p[0] for p in parts], [(int(p[1]), int(p[2])) for p in parts]
        self.listing, self.block = name, None

    def open_block(self, captures: str, number: int) -> None:
        if number == self.block:
            return
        found = capture_lines(read_range(self.files, f"{self.root}/{captures}", *self.directory[1][number]))
        self.lines, self.block = ([k for k, _ in found], [fields for _, fields in found]), number

    def records(self, names: tuple[str, str, str], key: str) -> Iterator[bytes]:
        """The records of a key in one archive."""
        archive, captures, listing = names
        self.open_directory(listing)
        firsts = self.directory[0]
        block = max(0, bisect.bisect_left(firsts, key) - 1)
        while block < len(firsts) and firsts[block] <= key:
            self.open_block(captures, block)
            keys, fields = self.lines
            for i in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key)):
                raw = read_range(self.files, f"{self.root}/{archive}", fields[i]["offset"], fields[i]["length"])
                yield zlib.decompress(raw, 31)
            block += 1


def warc_query(pages: DataFrame) -> DataFrame:
    folder = new_folder(pages.sparkSession, "warc")
    index = CaptureIndex(write_archives(pages, folder), folder)
    return index.lookup(pages.select("url"), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def warc_sql() -> str:
    """The same in DuckDB SQL; five hexadecimal digits are four letters of base32."""
    return r"""
WITH captures AS (
  SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS sha1
  FROM pages
), named AS (SELECT *, max(page_id) OVER (PARTITION BY sha1) AS response FROM captures)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((('0x' || substr(sha1, 1 + 5 * (i // 4)::INTEGER, 5))::BIGINT)
            >> (5 * (3 - i % 4))::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to, url
FROM named"""
