import base64
import hashlib
import re
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from dailybars.llm import warc_index as W
from dailybars.session import scratch_dir


@pytest.fixture(scope="module")
def make_pages(spark):
    return lambda rows: spark.createDataFrame(
        [(*r, "x", 5) for r in rows], "page_id long, url string, html string, uri string, offset int")


def pages():
    rows = [(k, f"http://h{k % 7}.example.com/p/{k}?q#f", f"<p>WARC/1.1\r\n\r\n page {k % 11}</p>") for k in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "no scheme", "ä€🙂\r\n\r\n"), (103, "http://x/ y\r\nWARC-Type: z", "é"),
             (104, "HTTP://Big.Host/", "x" * 200_000), (5, "http://again/", "own"), (5, "http://again/", "own"),
             (None, "http://none/", "é"), (None, "http://none/", "only without id")]
    return rows


def brute(rows, min_bytes=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(same, default=None) if len(data) >= min_bytes else None
        again = first is not None and i != first
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", first if again else None))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_round_trip_matches_brute_force(make_pages, min_bytes):
    found = W.archive_round_trip(make_pages(pages()), min_bytes)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows_of(found) == sorted(brute(pages(), min_bytes), key=str)


def test_empty_table(make_pages):
    assert W.archive_round_trip(make_pages([])).collect() == []


@pytest.fixture(scope="module")
def indexed(spark, make_pages):
    path = scratch_dir(spark, "archives")
    W.write_archives(make_pages(pages()), path, classes=((30, 9), (1 << 14, 5), (None, 1)))
    return W.build_index(W.index_lines(W.read_archives(spark, path)), per_block=5), path


def test_blocks_are_sorted_and_directory_is_sparse(indexed):
    index, _ = indexed
    blocks = index.orderBy("block").collect()
    keys = [x.split("\t")[0] for b in blocks for x in
            W.zlib.decompress(bytes(b.data)).decode().split("\n")]
    assert keys == sorted(keys) and len(keys) == len(pages())
    entries = W.directory(index)
    assert [b.block for b in blocks] == [k for _, k in entries] and len(blocks) < len(keys)
    for k, (b, (separator, _)) in enumerate(zip(blocks, entries)):
        assert b.first_key.startswith(separator)
        assert not k or blocks[k - 1].last_key <= separator
    assert sum(len(s) for s, _ in entries) < sum(len(b.first_key) for b in blocks)


def test_separators_are_shortest():
    assert W.separating("org,a)/x 1", "org,b)/y 2") == "org,b"
    assert W.separating("ab", "abc") == "abc" and W.separating("abc", "abd") == "abd"
    assert W.separating("same", "same") == "same" and W.separating(None, "key") == "key"


def test_archives_are_bounded_by_bytes(spark, make_pages):
    """Pages of very different sizes: no archive beyond the bound of its class."""
    rows = [(k, f"http://h/{k}", "x" * size) for k, size in enumerate(
        [10] * 300 + [9_000] * 60 + [50_000] * 30 + [3_000_000] * 3)]
    path = scratch_dir(spark, "archives")
    classes = ((100, 64), (10_000, 8), (100_000, 2), (None, 1))
    W.write_archives(make_pages(rows).coalesce(2), path, classes=classes)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        "path", "length").collect()
    for r in files:
        most, count = classes[int(re.search(r"/class-(\d)/", r.path)[1])]
        assert r.length <= (count * (most + 1000) if most else 3_001_000), r
    found = W.archive_round_trip(make_pages(rows)).count()
    assert found == len(rows)


def test_search_key_spread_over_blocks():
    first = ["a", "c", "c", "e"]
    assert list(W.candidate_blocks(first, "c")) == [0, 1, 2]
    assert list(W.candidate_blocks(first, "d")) == [2]
    assert list(W.candidate_blocks(first, "0")) == []
    assert bisect_left(first, "c") == 1


def test_fetch_reads_one_byte_range(spark, indexed):
    index, _ = indexed
    record, = W.fetch(spark, index, "http://h3.example.com/p/3?q#f", 3)
    fields, start, end = W.parse_record(record, 0)
    assert end == len(record) and fields["warc-type"] == "response"
    assert fields["warc-target-uri"] == "http://h3.example.com/p/3?q#f"
    assert record[start:].endswith(b"page 3</p>")
    assert W.fetch(spark, index, "http://unknown/", 3) == []


def test_keys_reverse_the_host(spark):
    row = spark.createDataFrame([("http://A.b.Org/x?y", 7), (None, None)], "uri string, page long")
    keys = [r.k for r in row.select(W.capture_key().alias("k")).collect()]
    assert keys == ["org,b,a)/x?y " + "7".zfill(20), "- -"]


def test_archives_hold_valid_records(spark, indexed):
    _, path = indexed
    text = W.read_archives(spark, path).select(F.col("content").cast("string").alias("c")).collect()
    heads = sum(len(re.findall(r"(?m)^WARC-Record-ID: ", r.c)) for r in text)
    assert heads == len(pages()) and len(text) > 3
