"""WARC archives with a two-level capture index.

*Writing.* Every page becomes one WARC/1.1 record. Of records with equal
payloads the one with the smallest page_id is a ``response``, the others are
``revisit`` records that refer to it. Records are laid out by DataFrame
expressions; Spark's text sink, with the records' end mark as line separator,
writes them as archives. Records of like size share archives, so that a bounded
number of records is a bounded number of bytes.

*Indexing.* The archives are read back and every record yields one index line
(key, archive, offset, length). Lines are range-partitioned and sorted by
reversed-host URL key and cut into compressed blocks; a sparse directory holds
for each block the shortest beginning of its first key that separates it from
the block before. Blocks grow with the corpus, so the directory never
has more than ``MAX_DIRECTORY`` entries; it is what lookups broadcast.

*Lookup.* A key is searched in the directory by bisection, its block is
unpacked and searched, and the record is taken from its byte range. ``fetch``
does this for one URL with a seek in the archive; ``lookup`` does it for a
whole table of keys, grouped by block and by archive.

Defined results: a NULL html is an empty payload; a NULL URL has no target URI
and the key ``-``; white space and line ends in a URL are percent-encoded in
the archive; rows without a page_id are revisits if their payload has a
response with an id, else responses; repeated rows are written one by one and
those with the smallest id are all responses; payloads shorter than
``min_bytes`` are all responses; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import column_of, materialise

CRLF = "\r\n"
RECORD_END = CRLF * 2
CAPTURED = "1970-01-01T00:00:00Z"   # the pages carry no capture time
# Payload bytes up to which a record belongs to a class, and the records that an
# archive of the class holds: at most 64 MB of payload, but for a larger record,
# which has an archive to itself.
ARCHIVE_CLASSES = ((1 << 14, 4096), (1 << 20, 64), (None, 1))
LINES_PER_BLOCK = 1024
MAX_DIRECTORY = 100_000
PACK_LEVEL = 9
_HEX, _B32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: str) -> F.Column:
    """Bare upper-case base32 of the SHA-1 of a column."""
    digest = F.sha1(F.col(payload))
    parts = [F.lpad(F.conv(F.substring(digest, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _HEX, _B32)


def _clean_uri(url: F.Column) -> F.Column:
    for char in "\r\n\t ":
        url = F.replace(url, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return url


def capture_key(uri: str = "uri", page: str = "page") -> F.Column:
    """Reversed-host key of a (cleaned) URI, then the page's id."""
    at = F.instr(F.col(uri), "://")
    rest = F.when(at > 0, F.substring(F.col(uri), at + 3, F.length(F.col(uri))))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    surt = F.concat(F.array_join(F.reverse(F.split(F.lower(host), "[.]")), ","), F.lit(")"), path)
    ident = F.coalesce(F.lpad(F.col(page).cast("string"), 20, "0"), F.lit("-"))
    return F.concat(F.coalesce(surt, F.col(uri), F.lit("-")), F.lit(" "), ident)


def first_captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(payload_digest, first) of the payloads that several pages have. Written,
    so that the join with it sees two plain shuffles and adaptive execution can
    split a frequent digest."""
    return materialise(
        pages.select("page_id", F.coalesce("html", F.lit("")).alias("payload"))
        .where(F.octet_length("payload") >= min_bytes)
        .groupBy(base32_sha1("payload").alias("payload_digest"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL").select("payload_digest", "first"), "first-captures")


def plan_records(pages: DataFrame, min_bytes: int, firsts: DataFrame) -> DataFrame:
    """page_id, uri, payload, payload_bytes, payload_digest, record_type and
    refers_to of every page."""
    rows = pages.select("page_id", _clean_uri(F.col("url")).alias("uri"),
                        F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": base32_sha1("payload")})
    found = rows.join(firsts, "payload_digest", "left")
    again = (F.col("first").isNotNull() & (F.col("payload_bytes") >= min_bytes)
             & ~F.col("page_id").eqNullSafe(F.col("first")))
    return (found.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("first"))).drop("first"))


def _record() -> F.Column:
    """The WARC record without its end mark."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                          "Content-Length: "), F.col("payload_bytes").cast("string"),
                    F.lit(RECORD_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))

    def urn(column):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("-")),
                        F.lit(">"))

    fields = [("WARC-Type", F.col("record_type")), ("WARC-Record-ID", urn("page_id")),
              ("WARC-Target-URI", F.col("uri")), ("WARC-Date", F.lit(CAPTURED)),
              ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
              ("WARC-Refers-To", F.when(revisit, urn("refers_to"))),
              ("WARC-Profile", F.when(revisit, F.lit(
                  "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
              ("Content-Type", F.lit("application/http;msgtype=response")),
              ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.coalesce(F.concat(F.lit(f"{n}: "), v, F.lit(CRLF)), F.lit("")) for n, v in fields]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), *lines, F.lit(CRLF), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0,
                   classes=ARCHIVE_CLASSES) -> None:
    """Write the pages' records below ``path``, each size class by itself, so
    that archives are bounded by bytes and not only by records."""
    firsts, least = first_captures(pages, min_bytes), -1
    size = F.octet_length(F.coalesce("html", F.lit("")))
    for k, (most, per_archive) in enumerate(classes):
        mine = (size > least) if most is None else (size > least) & (size <= most)
        records = plan_records(pages.where(mine), min_bytes, firsts)
        (records.select(_record().alias("value")).write.option("lineSep", RECORD_END)
         .option("maxRecordsPerFile", per_archive).text(f"{path}/class-{k}"))
        least = most


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .where("length > 0")).select(
        F.col("path").alias("archive"), "content")


def parse_record(data: bytes, start: int) -> tuple[dict[str, str], int, int]:
    """Header fields, and the start and end of the block, of the record at
    ``start``."""
    head = data.index(b"\r\n\r\n", start)
    lines = data[start:head].decode("utf-8").split(CRLF)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {start}")
    fields = {n.lower(): v for n, _, v in (x.partition(": ") for x in lines[1:])}
    return fields, head + 4, head + 4 + int(fields["content-length"])


def _urn(value: str | None) -> int | None:
    ident = value[len("<urn:page:"):-1] if value else "-"
    return None if ident == "-" else int(ident)


def index_lines(archives: DataFrame) -> DataFrame:
    """(key, archive, offset, length) of every record of the archives."""
    def run(batches):
        for batch in batches:
            for archive, content in zip(column_of(batch, "archive").to_pylist(),
                                        column_of(batch, "content")):
                data, at = content.as_buffer().to_pybytes(), 0
                rows = []
                while at < len(data):
                    fields, _, end = parse_record(data, at)
                    rows.append((fields.get("warc-target-uri"), _urn(fields["warc-record-id"]),
                                 archive, at, end - at))
                    at = end + len(RECORD_END)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                        names=["uri", "page", "archive", "offset", "length"])

    rows = archives.mapInArrow(
        run, "uri string, page bigint, archive string, offset bigint, length bigint")
    return rows.select(capture_key().alias("key"), "archive", "offset", "length")


def separating(before: str | None, key: str) -> str:
    """The shortest beginning of a key that is greater than the key before (the
    whole key, if that is equal or not known)."""
    if before is None or before >= key:
        return key
    same = next((k for k, (a, b) in enumerate(zip(before, key)) if a != b),
                min(len(before), len(key)))
    return key[: same + 1]


def build_index(lines: DataFrame, per_block: int = LINES_PER_BLOCK) -> DataFrame:
    """(block, separator, first_key, last_key, lines, data): the compressed
    blocks in key order. The directory is their ``block`` and ``separator``."""
    lines = materialise(lines, "index-lines")
    per_block = max(per_block, -(-lines.count() // MAX_DIRECTORY))

    def run(batches):
        held: list[tuple] = []
        before = None          # the last key of the task's block before

        def block(rows):
            nonlocal before
            separator, before = separating(before, rows[0][0]), rows[-1][0]
            text = "\n".join("\t".join(map(str, r)) for r in rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([separator]), pa.array([rows[0][0]]), pa.array([rows[-1][0]]),
                 pa.array([len(rows)], pa.int64()),
                 pa.array([zlib.compress(text.encode("utf-8"))], pa.binary())],
                names=["separator", "first_key", "last_key", "lines", "data"])

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= per_block:
                yield block(held[:per_block])
                del held[:per_block]
        if held:
            yield block(held)

    order = ["key", "archive", "offset"]
    blocks = lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "separator string, first_key string, last_key string, lines bigint, data binary")
    return materialise(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "index")


def directory(index: DataFrame) -> list[tuple[str, int]]:
    """(separator, block) in key order, at most ``MAX_DIRECTORY`` entries and
    one per partition that the range partitioning left short."""
    return sorted((r.separator, r.block) for r in index.select("separator", "block").collect())


def candidate_blocks(first_keys: list[str], key: str) -> range:
    """Places in the directory whose blocks can hold the key."""
    return range(max(bisect_left(first_keys, key) - 1, 0), bisect_right(first_keys, key))


def _search(data: bytes, wanted: list[str]) -> list[list[str]]:
    """The lines of an unpacked block whose key is wanted."""
    lines = [x.split("\t") for x in zlib.decompress(data).decode("utf-8").split("\n")]
    keys = [x[0] for x in lines]
    found = []
    for key in wanted:
        found += lines[bisect_left(keys, key): bisect_right(keys, key)]
    return found


def locate(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(archive, offset, length) of all records with one of the (distinct)
    keys, by bisection in the broadcast directory and in the blocks."""
    entries = directory(index)
    shared = keys.sparkSession.sparkContext.broadcast(
        ([k for k, _ in entries], [b for _, b in entries]))

    def to_blocks(batches):
        first_keys, blocks = shared.value
        for batch in batches:
            wanted = column_of(batch, "key").to_pylist()
            spans = [candidate_blocks(first_keys, k) for k in wanted]
            yield pa.RecordBatch.from_arrays(
                [pa.array([blocks[p] for s in spans for p in s], pa.int64()),
                 pa.array([k for k, s in zip(wanted, spans) for _ in s], pa.string())],
                names=["block", "key"])

    def to_lines(batches):
        for batch in batches:
            for data, wanted in zip(column_of(batch, "data").to_pylist(),
                                    column_of(batch, "keys").to_pylist()):
                found = _search(data, wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[1] for x in found], pa.string()),
                     pa.array([int(x[2]) for x in found], pa.int64()),
                     pa.array([int(x[3]) for x in found], pa.int64())],
                    names=["archive", "offset", "length"])

    asked = (keys.select("key").distinct().mapInArrow(to_blocks, "block bigint, key string")
             .groupBy("block").agg(F.collect_list("key").alias("keys")))
    return asked.join(index.select("block", "data"), "block").select("data", "keys").mapInArrow(
        to_lines, "archive string, offset bigint, length bigint")


def read_records(locations: DataFrame, archives: DataFrame) -> DataFrame:
    """The records in the byte ranges: page_id, payload_bytes, payload_digest,
    record_type, refers_to, uri. A response's size and digest are computed
    from its payload."""
    def pack(batches):
        # An archive meets its ranges in a shuffle; it goes there compressed.
        for batch in batches:
            for archive, content in zip(column_of(batch, "archive").to_pylist(),
                                        column_of(batch, "content")):
                data = zstandard.compress(content.as_buffer(), PACK_LEVEL)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([archive]), pa.array([data], pa.binary())],
                    names=["archive", "content"])

    def run(batches):
        for batch in batches:
            for content, ranges in zip(column_of(batch, "content"),
                                       column_of(batch, "ranges").to_pylist()):
                data, rows = memoryview(zstandard.decompress(content.as_buffer())), []
                for r in sorted(ranges, key=lambda r: r["offset"]):
                    record = bytes(data[r["offset"]: r["offset"] + r["length"]])
                    fields, start, _ = parse_record(record, 0)
                    http = record.index(b"\r\n\r\n", start)
                    if fields["warc-type"] == "response":
                        payload = record[http + 4:]
                        size = len(payload)
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    else:
                        size = int(record[start:http].rpartition(b"Content-Length: ")[2])
                        digest = fields["warc-payload-digest"].partition(":")[2]
                    rows.append((_urn(fields["warc-record-id"]), size, digest,
                                 fields["warc-type"], _urn(fields.get("warc-refers-to")),
                                 fields.get("warc-target-uri")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                        pa.string()))],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type",
                           "refers_to", "uri"])

    ranges = locations.groupBy("archive").agg(
        F.collect_list(F.struct("offset", "length")).alias("ranges"))
    packed = archives.mapInArrow(pack, "archive string, content binary")
    return packed.join(ranges, "archive").select("content", "ranges").mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, "
             "record_type string, refers_to bigint, uri string")


def fetch(spark: SparkSession, index: DataFrame, url: str, page_id: int | None) -> list[bytes]:
    """The records of one capture: directory, block, then a seek and a read of
    the byte range."""
    row = spark.range(1).select(_clean_uri(F.lit(url)).alias("uri"),
                                F.lit(page_id).cast("long").alias("page"))
    key = row.select(capture_key().alias("key")).first().key
    entries = directory(index)
    places = candidate_blocks([k for k, _ in entries], key)
    blocks = index.where(F.col("block").isin([entries[p][1] for p in places])).select("data")
    records = []
    for block in blocks.collect():
        for _, archive, offset, length in _search(bytes(block.data), [key]):
            path = spark._jvm.org.apache.hadoop.fs.Path(archive)
            stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
            try:
                stream.seek(int(offset))
                records.append(bytes(stream.readNBytes(int(length))))
            finally:
                stream.close()
    return records


def lookup(spark: SparkSession, keys: DataFrame, index: DataFrame, path: str) -> DataFrame:
    return read_records(locate(keys, index), read_archives(spark, path))


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives, index these, and look every page up."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "archives")
    write_archives(pages, path, min_bytes)
    index = build_index(index_lines(read_archives(spark, path)))
    keys = pages.select(_clean_uri(F.col("url")).alias("uri"),
                        F.col("page_id").alias("page")).select(capture_key().alias("key"))
    return lookup(spark, keys, index, path).drop("uri")
