"""WARC archives with a two-level capture index.

``write_archives`` makes one gzip member per page, a ``response`` or, for a repeated payload, a ``revisit``, and strings
them together to archives of about ARCHIVE_BYTES, each stored as one row of bytes with the list of its captures (offset
and length); ``export_files`` writes the same bytes as ``.warc.gz`` files. ``build_index`` sorts the captures by
reversed-host URL key into compressed blocks of lines and keeps, as a sparse directory, a key that parts each block from
the one before. ``lookup`` binary-searches the directory for the blocks of the URLs, binary-searches their lines, and
cuts the byte ranges they name out of the archives. ``read_all`` cuts out those of every index line; ``read_records``
says what records hold.

Of records with equal payloads of at least MIN_REVISIT bytes the one with the smallest page id is the response.

Defined cases: null html is an empty payload; a null URL has the empty key; rows sharing the smallest page id of a
payload are all responses; a row without page id is never the first of its payload unless all are without; repeated
rows are captures of their own; an empty table gives empty archives and an empty index; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from os.path import commonprefix
from urllib.parse import quote, unquote
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orderflow.llm.words import blocks
from orderflow.session import materialize, scratch_path

MIN_REVISIT = 100
BLOCK_LINES = 3000
#: The directory holds at most this many blocks and one more per partition: beyond, blocks have more lines.
MAX_BLOCKS = 1 << 20
KEY_LENGTH = 256  # characters of a key in the directory
READ_BYTES = 4 << 20
ARCHIVE_BYTES = 1 << 20
#: An empty gzip member, which a reader of concatenated members passes over.
EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
EMPTY = EMPTY_MEMBER.encode("latin-1")

ARCHIVE = "archive string, data binary, captures array<struct<page_id:bigint,url_key:string,offset:bigint,length:bigint>>"
RANGE = "url_key string, archive string, offset bigint, length bigint"
#: Few archives to a row group, so that a reader holds few of them.
FEW_ROWS = {"compression": "uncompressed", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1}


def url_key(url: str | None) -> str:
    """Host labels in reverse order, then the rest of the URL."""
    m = re.match(r"(?:[^/?#]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?(.*)", url or "", re.S)
    host = ",".join(reversed(m[1].lower().split("."))) if m[1] else ""
    return f"{host}{m[2] or ''}){m[3] or '/'}" if host else ""


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    """A WARC record; ``revisit`` of page ``first`` keeps the HTTP head, which states the payload's length."""
    name = lambda page: f"<urn:uuid:{uuid5(NAMESPACE_URL, f'page:{page}')}>"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    fields += [f"WARC-Date: {date}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        fields.append(f"Page-ID: {page_id}")
    if revisit:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        fields += [f"WARC-Refers-To: {name(first)}", f"Refers-To-Page-ID: {first}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(fields, HTTP head, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def write_archives(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """The stored archives."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("_page"), F.col(url).alias("_url"), payload.alias("_html"))
    rows = rows.withColumns({"_digest": F.sha2("_html", 256), "_bytes": F.octet_length("_html")})
    large = rows.where(F.col("_bytes") >= MIN_REVISIT).groupBy("_digest", "_bytes")
    again = large.agg(F.min("_page").alias("_first"), F.count("*").alias("_copies")).where("_copies > 1").drop("_copies")
    again = materialize(again, "warc-repeated")  # its size is known now, so Spark sends it whole only if small
    rows = rows.join(again, ["_digest", "_bytes"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("_page"))
    rows = rows.select("_page", "_url", "_html", "_digest", "_first", revisit.alias("_revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, members, captures, offset = TaskContext.get().partitionId(), 0, [], [], 0
        capture = pa.struct([("page_id", pa.int64()), ("url_key", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "archive": [f"{part:05d}-{number:06d}"], "data": pa.array([EMPTY.join(members)], pa.binary()),
                "captures": pa.array([captures], pa.list_(capture)),
            })

        for batch in blocks(batches, "_html", READ_BYTES):
            for page, link, text, digest, first, again in zip(*(c.to_pylist() for c in batch.columns)):
                data = _gzip(record(page, link, text.encode(), digest, first, again, date))
                members.append(data)
                captures.append({"page_id": page, "url_key": url_key(link), "offset": offset, "length": len(data)})
                offset += len(data) + len(EMPTY)
                if offset >= ARCHIVE_BYTES:
                    yield archive()
                    number, members, captures, offset = number + 1, [], [], 0
        if members:
            yield archive()

    path = scratch_path(spark, "archives")
    rows.mapInArrow(write, ARCHIVE).write.options(**FEW_ROWS).parquet(path)
    return spark.read.schema(ARCHIVE).parquet(path)


def export_files(archives: DataFrame, path: str) -> None:
    """The archives as ``.warc.gz`` files, about one per task that wrote them: all members in order, an empty one after each."""
    parts = archives.select(F.substring_index("archive", "-", 1)).distinct().count()
    rows = archives.repartitionByRange(max(1, parts), "archive").sortWithinPartitions("archive")
    rows = rows.select(F.col("data").cast("string").alias("value"))
    rows.write.option("lineSep", EMPTY_MEMBER).option("encoding", "ISO-8859-1").text(path)


def build_index(archives: DataFrame, lines: int = BLOCK_LINES) -> DataFrame:
    """The stored index: (part, block, first_key, n, data); without ``data`` it is the directory.

    ``first_key`` is the beginning of a block's first key that tells it from the last key of the block before.
    """
    captures = archives.select("archive", F.inline("captures"))
    lines = max(lines, -(-captures.count() // MAX_BLOCKS))
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["url_key", "page_id", "archive", "offset"]
    dealt = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, waiting, last = TaskContext.get().partitionId(), 0, [], None

        def block(rows: list[dict]) -> pa.RecordBatch:
            first = rows[0]["url_key"]
            first = first if last is None else first[: len(commonprefix([last, first])) + 1]
            text = "\n".join("\t".join((quote(r["url_key"], safe=",():/?&=+"), r["archive"], str(r["offset"]), str(r["length"]))) for r in rows)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([number], pa.int32()),
                "first_key": [first[:KEY_LENGTH]], "n": pa.array([len(rows)], pa.int64()),
                "data": pa.array([_gzip(text.encode())], pa.binary()),
            })

        for batch in batches:
            waiting += batch.to_pylist()
            while len(waiting) >= lines:
                yield block(waiting[:lines])
                last, waiting, number = waiting[lines - 1]["url_key"], waiting[lines:], number + 1
        if waiting:
            yield block(waiting)

    return materialize(dealt.mapInArrow(pack, "part int, block int, first_key string, n bigint, data binary"), "captures")


def _lines(data: bytes) -> list[list[str]]:
    return [line.split("\t") for line in zlib.decompress(data, 31).decode().split("\n")]


def index_lines(index: DataFrame) -> DataFrame:
    """(url_key, archive, offset, length) of every capture, in key order within a block."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                yield _ranges([(unquote(key), *place) for key, *place in _lines(data.as_py())])

    return index.select("data").mapInArrow(read, RANGE)


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    keys, archives, offsets, lengths = zip(*rows) if rows else [()] * 4
    columns = [pa.array(keys, pa.string()), pa.array(archives, pa.string())]
    columns += [pa.array(map(int, x), pa.int64()) for x in (offsets, lengths)]
    return pa.RecordBatch.from_arrays(columns, ["url_key", "archive", "offset", "length"])


def read_ranges(archives: DataFrame, ranges: DataFrame) -> DataFrame:
    """(url_key, archive, offset, length, record): the bytes of the given ranges of the archives."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data, asked in zip(*map(batch.column, ("archive", "data", "ranges"))):
                archive, data, asked = archive.as_py(), memoryview(data.as_buffer()), asked.as_py()
                found = _ranges([(r["url_key"], archive, r["offset"], r["length"]) for r in asked])
                records = pa.array([bytes(data[r["offset"] : r["offset"] + r["length"]]) for r in asked], pa.binary())
                yield pa.RecordBatch.from_arrays([*found.columns, records], [*found.schema.names, "record"])

    # an archive's ranges are no more than its captures
    asked = ranges.groupBy("archive").agg(F.collect_list(F.struct("url_key", "offset", "length")).alias("ranges"))
    return asked.join(archives.select("archive", "data"), "archive").mapInArrow(cut, f"{RANGE}, record binary")


def read_records(records: DataFrame) -> DataFrame:
    """What each record says: (archive, offset, page_id, payload_bytes, payload_digest, record_type, refers_to)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for data in batch.column("record"):
                fields, http, payload = parse(zlib.decompress(data.as_py(), 31))
                size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                if fields["WARC-Type"] == "revisit":
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                page, refers = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                for k, v in zip(out, (page and int(page), size, digest, fields["WARC-Type"], refers and int(refers))):
                    out[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("archive"), batch.column("offset"), *columns], ["archive", "offset", *out])

    return records.select("archive", "offset", "record").mapInArrow(
        read,
        "archive string, offset bigint, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    )


def read_all(archives: DataFrame, index: DataFrame) -> DataFrame:
    """Every capture of the index with what its record says."""
    return read_records(read_ranges(archives, index_lines(index)))


def lookup(archives: DataFrame, index: DataFrame, urls: DataFrame, url: str = "url") -> DataFrame:
    """(url_key, archive, offset, length, record) of the captures of the given URLs, as keys see them."""
    spark = index.sparkSession
    rows = index.select("first_key", "part", "block").orderBy("part", "block").collect()  # at most MAX_BLOCKS and one per part
    firsts, places = [r["first_key"] for r in rows], [(r["part"], r["block"]) for r in rows]
    directory = spark.sparkContext.broadcast((firsts, places))

    def to_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array({url_key(link) for link in batch.column(0).to_pylist()}, pa.string())], ["key"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks that may hold the keys of a batch, each with these keys."""
        firsts, places = directory.value
        for batch in batches:
            out = {}
            for key in batch.column("key").to_pylist():
                low = max(0, bisect_left(firsts, key[:KEY_LENGTH]) - 1)
                for i in range(low, bisect_right(firsts, key[:KEY_LENGTH])):
                    out.setdefault(i, []).append(key)
            part, block = zip(*(places[i] for i in out)) if out else ((), ())
            columns = [pa.array(part, pa.int32()), pa.array(block, pa.int32()), pa.array(out.values(), pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "block", "keys"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked, data in zip(batch.column("keys"), batch.column("data")):
                lines = _lines(data.as_py())
                keys = [unquote(x[0]) for x in lines]
                found = []
                for key in asked.as_py():
                    found += [(key, *x[1:]) for x in lines[bisect_left(keys, key) : bisect_right(keys, key)]]
                yield _ranges(found)

    # in key order, so that a block meets its keys in few rows
    wanted = urls.select(url).mapInArrow(to_keys, "key string").distinct().repartitionByRange("key").sortWithinPartitions("key")
    wanted = wanted.mapInArrow(find, "part int, block int, keys array<string>")
    return read_ranges(archives, materialize(wanted.join(index, ["part", "block"]).mapInArrow(search, RANGE), "ranges"))
