"""WARC archives in seekable Zstandard bundles: written, read back, and single records fetched by identifier.

Pages become WARC/1.1 records.  Payloads of LEAST_BYTES or more are stored once: the record with the
smallest page id is the response, records with an equal payload are revisits that refer to it and
keep the HTTP header only, as the standard's identical-payload profile has it.  Records are gathered
into frames of about FRAME_BYTES, each compressed on its own; a bundle is a run of frames and, as its
last frame, the seek table of the seekable format (sizes and a checksum for each frame), which plain
decompressors skip.  The index maps a record's identifier to bundle, frame and the offset within the
decompressed frame, so that one record costs one read of one frame.

Tasks write bundles of their own, under names that no other attempt uses; the index is a table that
Spark commits.  A bundle counts only if the index names it: what lost tasks left is never read.  Memory
is bounded by a frame, a record and the index rows of one bundle.  Bundles are written through
Arrow's file systems: the folder is a path or URI of shared storage that Arrow knows (local or
mounted, s3, gs, abfs, hdfs, viewfs).

Payloads are grouped by digest with a partial aggregation before the shuffle, so a payload that a
third of all pages have is one row per task; their revisits carry no payload.

Defined results: a null html is an empty payload; the page without id comes last, so it is the
response of its payload only if no other page has it; of rows with equal ids the one with the
smallest url (null first) is the response, of equal rows any; a null url has no target header; control
characters and spaces in a url are percent-encoded; an empty table gives no bundle and empty results;
other columns of the table are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LEAST_BYTES = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80
FOOTER, ENTRY = struct.Struct("<IBI"), struct.Struct("<III")

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "record_type string, page_id long, url string, digest string, payload_bytes long, payload string, refers_to long, refers_to_url string"
INDEX = "record_id string, page_id long, bundle string, frame_start long, frame_bytes long, offset long, length long"
READ = ("record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, "
        "refers_to_id string, intact boolean, payload string")


# ------------------------------------------------------------------------------------ which records
def archive_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page, of columns RECORDS: responses with their payload, revisits without."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("digest"))
    large = F.col("payload_bytes") >= LEAST_BYTES
    # Without the large payloads, and with a number that stays as it is stored.
    narrow = Scratch(pages.sparkSession).table(rows.withColumn("payload", F.when(~large, F.col("payload")))
                                               .withColumn("row", F.monotonically_increasing_id()))
    place = [F.col("page_id").isNull().alias("missing"), F.col("page_id"), F.col("url")]
    firsts = narrow.where(large).groupBy("digest").agg(F.min(F.struct(*place, "row")).alias("first"), F.count(F.lit(1)).alias("n"))
    none = [F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_to_url")]
    columns = ["page_id", "url", "digest", "payload_bytes", "payload"]

    small = narrow.where(~large).select(F.lit("response").alias("record_type"), *columns, *none)
    responses = rows.where(large).groupBy("digest").agg(F.min(F.struct(*place)).alias("at"), F.first("payload").alias("payload"),
                                                        F.first("payload_bytes").alias("payload_bytes"))
    responses = responses.select(F.lit("response").alias("record_type"), "at.page_id", "at.url", "digest", "payload_bytes", "payload", *none)
    revisits = narrow.where(large).join(firsts.where("n > 1"), "digest").where(F.col("row") != F.col("first.row"))
    revisits = revisits.select(F.lit("revisit").alias("record_type"), *columns, F.col("first.page_id").alias("refers_to"),
                               F.col("first.url").alias("refers_to_url"))
    return responses.unionByName(small).unionByName(revisits)


# ---------------------------------------------------------------------------------- bytes of a record
def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m.group()), url)


def payload_id(digest: str) -> str:
    """The identifier of the one response that stores a large payload."""
    return f"<urn:uuid:{uuid.UUID(digest[:32])}>"


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def page_record(row: dict, own_id: str, date: str) -> tuple[str, bytes]:
    """Identifier and bytes of one record."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit else row["payload"].encode()
    size = row["payload_bytes"]
    record_id = payload_id(row["digest"]) if not revisit and size >= LEAST_BYTES else own_id
    number = {k: None if row[k] is None else str(row[k]) for k in ("page_id", "refers_to")}
    headers = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id), ("WARC-Date", date),
               ("WARC-Target-URI", None if row["url"] is None else _uri(row["url"])),
               ("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Page-ID", number["page_id"])]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", payload_id(row["digest"])),
                    ("WARC-Refers-To-Target-URI", None if row["refers_to_url"] is None else _uri(row["refers_to_url"])),
                    ("WARC-Refers-To-Date", date), ("Refers-To-Page-ID", number["refers_to"])]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return record_id, _record(headers, http + payload)


def _headers(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split("\r\n")[1:])


def parse_records(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of each record in a decompressed frame."""
    at = 0
    while at < len(raw):
        start, end = at, raw.index(b"\r\n\r\n", at)
        headers = _headers(raw[at:end])
        at = end + 4 + int(headers["Content-Length"])
        yield start, headers, raw[end + 4:at]
        at += 4


# ------------------------------------------------------------------------------------------ bundles
def _open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The last frame of a bundle: compressed size, size and checksum of each frame, and the footer."""
    body = b"".join(ENTRY.pack(*f) for f in frames) + FOOTER.pack(len(frames), WITH_CHECKSUMS, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int, int]] | int:
    """The entries of a seek table at the end of ``tail``, or how many bytes are needed for it."""
    n, flags, magic = FOOTER.unpack(tail[-FOOTER.size:])
    if magic != SEEKABLE_MAGIC or not flags & WITH_CHECKSUMS:
        raise ValueError("not a bundle with a seek table and checksums")
    size = n * ENTRY.size + FOOTER.size
    if len(tail) < size:
        return size
    return list(ENTRY.iter_unpack(tail[len(tail) - size:len(tail) - FOOTER.size]))


@dataclass
class _Bundle:
    """A bundle in the making: the frame that is filled, and the index rows of the bundle."""

    path: str
    out: pa.NativeFile
    level: int

    def __post_init__(self):
        self.pack = zstandard.ZstdCompressor(level=self.level, write_checksum=True)
        self.name, self.count = uuid.uuid4(), 0
        self.frames, self.rows, self.size = [], [], 0
        self.parts, self.filled, self.waiting = [], 0, []

    def own_id(self) -> str:
        self.count += 1
        return f"<urn:uuid:{uuid.uuid5(self.name, str(self.count))}>"

    def add(self, record_id: str, page_id: int | None, record: bytes, listed: bool = True) -> None:
        if listed:
            self.waiting.append((record_id, page_id, self.filled, len(record)))
        self.parts.append(record)
        self.filled += len(record)

    def flush(self) -> None:
        if not self.parts:
            return
        raw = b"".join(self.parts)
        frame = self.pack.compress(raw)
        self.out.write(frame)
        self.rows += [(r, p, self.path, self.size, len(frame), offset, length) for r, p, offset, length in self.waiting]
        self.frames.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.size += len(frame)
        self.parts, self.filled, self.waiting = [], 0, []

    def close(self) -> list[tuple]:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return self.rows


def _table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_INDEX_SCHEMA = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()), ("frame_start", pa.int64()),
                           ("frame_bytes", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
_READ_SCHEMA = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                          ("refers_to_id", pa.string()), ("intact", pa.bool_()), ("payload", pa.string())])


def write_bundles(records: DataFrame, folder: str, date: str = DATE, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes rows of RECORDS as bundles under ``folder`` and returns the index (columns INDEX), a table there."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_folder(folder)
        bundle = None
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                row = {c: v[i].as_py() for c, v in columns.items()}
                if bundle is None:
                    fs.create_dir(f"{root}/bundles", recursive=True)
                    name = f"bundles/{uuid.uuid4().hex}.warc.zst"
                    bundle = _Bundle(name, fs.open_output_stream(f"{root}/{name}", compression=None), level)
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", bundle.own_id()), ("WARC-Date", date),
                            ("WARC-Filename", name.split("/")[1]), ("Content-Type", "application/warc-fields")]
                    bundle.add("", None, _record(info, b"format: WARC File Format 1.1\r\n"), listed=False)
                record_id, data = page_record(row, bundle.own_id(), date)
                bundle.add(record_id, row["page_id"], data)
                if bundle.filled >= frame_bytes:
                    bundle.flush()
                if bundle.size >= bundle_bytes:
                    yield _table_of(bundle.close(), _INDEX_SCHEMA)
                    bundle = None
        if bundle is not None:
            yield _table_of(bundle.close(), _INDEX_SCHEMA)

    spark, path = records.sparkSession, f"{folder}/index"
    records.mapInArrow(write, INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def bundles(index: DataFrame) -> DataFrame:
    """The bundles that count."""
    return index.select("bundle").distinct()


def bundle_frames(found: DataFrame, folder: str) -> DataFrame:
    """One row per frame of the given bundles, from their seek tables: bundle, frame, start, size, raw_size, checksum."""
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_folder(folder)
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with fs.open_input_file(f"{root}/{name}") as f:
                    size = f.size()
                    need: list | int = min(size, 1 << 16)
                    while isinstance(need, int):
                        f.seek(size - need)
                        need = read_seek_table(f.read())
                rows, at = [], 0
                for k, (packed, raw, checksum) in enumerate(need):
                    rows.append((name, k, at, packed, raw, checksum))
                    at += packed
                yield _table_of(rows, pa.schema([("bundle", pa.string()), ("frame", pa.int64()), ("start", pa.int64()),
                                                 ("size", pa.int64()), ("raw_size", pa.int64()), ("checksum", pa.int64())]))

    return found.mapInArrow(frames, "bundle string, frame long, start long, size long, raw_size long, checksum long")


def _read_row(headers: dict[str, str], block: bytes, sound: bool, with_payload: bool) -> tuple:
    end = block.index(b"\r\n\r\n")
    http, payload = _headers(block[:end]), block[end + 4:]
    told = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = headers["WARC-Type"] == "revisit"
    size, digest = (int(http["Content-Length"]), told) if revisit else (len(payload), hashlib.sha256(payload).hexdigest())
    number = [None if headers.get(k) is None else int(headers[k]) for k in ("Page-ID", "Refers-To-Page-ID")]
    intact = sound and digest == told and size == int(http["Content-Length"])
    return (headers["WARC-Record-ID"], headers["WARC-Type"], number[0], headers.get("WARC-Target-URI"), size, digest, number[1],
            headers.get("WARC-Refers-To"), intact, payload.decode() if with_payload and not revisit else None)


#: Records in one Arrow batch of the reader; their payloads are no more than a frame's, or one record's.
READ_ROWS = 1000


def read_bundles(found: DataFrame, folder: str, payloads: bool = False, partitions: int | None = None) -> DataFrame:
    """The page records of the given bundles, of columns READ: payload size and digest are those of the bytes read (of a revisit,
    those its header states), ``intact`` if they and the frame's checksum are right."""
    n = partitions or int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_folder(folder)
        unpack, name, f = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    if f is not None:
                        f.close()
                    name = row["bundle"]
                    f = fs.open_input_file(f"{root}/{name}")
                f.seek(row["start"])
                raw = unpack.decompress(f.read(row["size"]), max_output_size=row["raw_size"])
                sound = xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF == row["checksum"]
                rows = [_read_row(h, block, sound, payloads) for _, h, block in parse_records(raw) if h["WARC-Type"] != "warcinfo"]
                for i in range(0, len(rows), READ_ROWS):
                    yield _table_of(rows[i:i + READ_ROWS], _READ_SCHEMA)
        if f is not None:
            f.close()

    frames = bundle_frames(found, folder).repartition(n, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return frames.mapInArrow(read, READ)


def fetch_records(index: DataFrame, ids: DataFrame, folder: str) -> DataFrame:
    """The records with the given identifiers (a column record_id), each from its frame alone; columns READ."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_folder(folder)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            last, raw = None, b""
            for row in batch.to_pylist():
                frame = row["bundle"], row["frame_start"]
                if frame != last:
                    with fs.open_input_file(f"{root}/{row['bundle']}") as f:
                        f.seek(row["frame_start"])
                        raw, last = unpack.decompress(f.read(row["frame_bytes"])), frame
                (_, headers, block), = parse_records(raw[row["offset"]:row["offset"] + row["length"]])
                yield _table_of([_read_row(headers, block, True, True)], _READ_SCHEMA)

    wanted = index.join(ids.select("record_id").distinct(), "record_id", "left_semi")
    return wanted.sortWithinPartitions("bundle", "frame_start").mapInArrow(fetch, READ)


def resolved(records: DataFrame) -> DataFrame:
    """Records read with their payloads, those of revisits taken from the response that they refer to."""
    stored = records.where("record_type = 'response'").select(F.col("record_id").alias("_to"), F.col("payload").alias("_payload"))
    out = records.join(stored, records["refers_to_id"] == stored["_to"], "left")
    payload: Column = F.coalesce("payload", "_payload")
    return out.withColumn("payload", payload).drop("_to", "_payload")
