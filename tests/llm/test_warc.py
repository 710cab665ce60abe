import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tillpanel.llm import warc
from tillpanel.llm.warc import (
    CaptureIndex,
    open_folder,
    parse_record,
    read_archives,
    url_key,
    warc_query,
    write_archives,
)
from tillpanel.storage.shared import new_folder

SCHEMA = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def pages(n=60, seed=2):
    pick = random.Random(seed)
    rows = [
        (i, f"https://{pick.choice(['www', 'a.b', 'm'])}.example{pick.randrange(4)}.org:8080/p/{pick.randrange(30)}?q={i % 7}",
         f"<p>päge {pick.randrange(n // 3)} " + "x" * pick.randrange(2000))
        for i in range(n)
    ]
    rows += [(n + i, f"http://copy.org/{i}", "<b>copied</b>") for i in range(25)]
    rows += [(n + 50, None, None), (n + 51, "", ""), (n + 52, "no scheme", "a\r\n\r\nb"), (n + 53, "http://copy.org/3", "3")]
    return rows + [(None, "http://none.org/", "<i>")]


def test_query_matches_brute_force(spark):
    rows = pages()
    largest = {}
    for page_id, _, html in rows:
        key = digest(html)
        largest[key] = max(largest.get(key, -1), -1 if page_id is None else page_id)
    expected = set()
    for page_id, _, html in rows:
        first = largest[digest(html)]
        revisit = page_id is not None and page_id != first
        expected.add((page_id, len((html or "").encode()), digest(html),
                      "revisit" if revisit else "response", first if revisit else None))
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("sha1", F.lit("clash")).repartition(4)
    found = warc_query(frame).collect()
    assert {tuple(r)[:5] for r in found} == expected
    assert len(found) == len(rows)
    assert warc_query(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def archive(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    folder = new_folder(spark, "warc-test")
    blocks = write_archives(spark.createDataFrame(pages(), SCHEMA), folder, block_lines=4)
    yield blocks, folder
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_archives_are_plain_warc_files(archive):
    blocks, folder = archive
    files, root = open_folder(folder)
    seen = 0
    for row in blocks.select("archive").distinct().collect():
        with files.open_input_file(f"{root}/{row.archive}") as source:
            data = gzip.decompress(source.read())  # all members in turn
        while data:
            record = parse_record(data)
            size = data.index(b"\r\n\r\n") + 4 + int(record["headers"]["Content-Length"]) + 4
            assert data[size - 4 : size] == b"\r\n\r\n"
            data, seen = data[size:], seen + 1
    assert seen == len(pages())


def test_payloads_come_back(spark, archive):
    blocks, folder = archive
    by_digest = {digest(html): (html or "").encode() for _, _, html in pages()}
    rows = read_archives(blocks, folder).collect()
    assert len(rows) == len(pages())
    for r in rows:
        whole = by_digest[r.payload_digest]
        assert r.payload_bytes == len(whole)
        assert r.payload == (whole if r.record_type == "response" else None)


def test_index_is_sorted_and_sparse(archive):
    blocks, _ = archive
    rows = sorted(blocks.collect(), key=lambda r: (r.archive, r.block))
    assert all(r.first_key <= r.last_key and r.n_lines <= 4 for r in rows)
    for a, b in zip(rows, rows[1:]):
        if a.archive == b.archive:
            assert a.last_key <= b.first_key
            assert a.archive_offset + a.archive_length == b.archive_offset


def test_look_ups_find_every_capture(spark, archive):
    blocks, folder = archive
    index = CaptureIndex(blocks, folder)
    rows = pages()
    urls = sorted({u for _, u, _ in rows if u}) + ["http://absent.org/", "http://copy.org/9999"]
    found = index.lookup(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    keys = {u: k for u, k in spark.createDataFrame([(u,) for u in urls], "url string")
            .select("url", url_key(F.col("url"))).collect()}
    expected = sorted((str(p), u) for p, u, _ in rows if u)
    assert sorted((str(r.page_id), r.url) for r in found) == expected
    assert keys["http://copy.org/3"] == "org,copy)/3"


def test_smaller_payloads_can_be_left_as_responses(spark):
    rows = [(1, "http://a.org/", "ab"), (2, "http://b.org/", "ab"), (3, "http://c.org/", "abc"), (4, "http://d.org/", "abc")]
    folder = new_folder(spark, "warc-test")
    blocks = write_archives(spark.createDataFrame(rows, SCHEMA), folder, min_bytes=3)
    found = {r.page_id: (r.record_type, r.refers_to) for r in read_archives(blocks, folder).collect()}
    assert found == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_the_query_goes_through_the_index(spark, monkeypatch):
    """No block is scanned by the block table; directories are read, and blocks found by bisection."""
    monkeypatch.setattr(warc, "read_archives", lambda *a: pytest.fail("scanned"))
    rows = pages()
    assert warc_query(spark.createDataFrame(rows, SCHEMA).repartition(3)).count() == len(rows)


class Counting:
    """A file system that notes the ranges read."""

    def __init__(self, files, seen):
        self.files, self.seen = files, seen

    def get_file_info(self, path):
        return self.files.get_file_info(path)

    def open_input_file(self, path):
        self.seen.append(path.rsplit(".", 1)[1])
        return self.files.open_input_file(path)


def test_a_directory_is_read_once_and_few_blocks_are(spark, archive):
    blocks, folder = archive
    index = CaptureIndex(blocks, folder)
    first, last, *names = max(index.archives, key=lambda a: blocks.filter(blocks.archive == a[2]).count())
    keys = sorted({r.urlkey for r in spark.createDataFrame(pages(), SCHEMA).select(url_key(F.col("url")).alias("urlkey"))
                   .collect() if first <= r.urlkey <= last})
    reader, seen = warc._IndexReader(folder), []
    reader.files = Counting(reader.files, seen)
    found = [len(list(reader.records(tuple(names), key))) for key in keys]
    n_blocks = blocks.filter(blocks.archive == names[0]).count()
    assert seen.count("dir") == 1 and sum(found) == blocks.filter(blocks.archive == names[0]).agg(F.sum("n_lines")).first()[0]
    # In order, a block is opened again only where a key ends one block and begins the next.
    assert seen.count("gz") - sum(found) <= 2 * n_blocks


def test_a_url_captured_very_often_and_repeated_ids(spark):
    rows = [(k % 90, "http://hot.org/", f"<p>{k % 50}") for k in range(400)] + [(500 + k, f"http://x{k}.org/", "z") for k in range(9)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("member", "urlkey", "digest", "payload")})
    found = warc_query(frame.repartition(4)).collect()
    largest = {}
    for page_id, _, html in rows:
        largest[html] = max(largest.get(html, -1), page_id)
    expected = sorted((p, digest(h), None if largest[h] == p else largest[h], u) for p, u, h in rows)
    assert sorted(((r.page_id, r.payload_digest, r.refers_to, r.url) for r in found), key=str) == sorted(expected, key=str)


def test_blocks_are_cut_by_bytes_too(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 600)
    writer = warc._ArchiveWriter(str(tmp_path), 1000)
    for k in range(30):
        member = gzip.compress(warc.make_record(k, "http://a.org/", b"x", digest("x"), 1, None), 6, mtime=0)
        writer.add({"page_id": k, "url": "http://a.org/", "sha1": hashlib.sha1(b"x").hexdigest(), "n_bytes": 1,
                    "member": member, "refers_to": None, "urlkey": "org,a)/"})
    rows = writer.close()
    assert len(rows) > 5 and sum(r["n_lines"] for r in rows) == 30
    assert max(r["archive_length"] for r in rows) < 1200
