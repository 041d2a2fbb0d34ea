"""WARC archives in Zstandard form: a dictionary in a leading skippable frame, then one frame per record."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.session import materialize, shared_dir

# Fixed values of the formats.
SKIPPABLE_DICTIONARY = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

#: Payloads from this size on are stored once.
LEAST_SHARED = 1000
#: An archive is closed when it holds so many bytes of records.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is trained on the first records of its archive, this many bytes at most.
DICTIONARY_BYTES, SAMPLE_BYTES = 16 << 10, 1 << 20
DATE = "2000-01-01T00:00:00Z"


def name_of(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", name)
    if not found:
        raise ValueError(f"not the name of a page's record: {name}")
    return int(found[1]) if found[1] else None


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers.items()], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool,
                date: str = DATE) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone; both name length and digest of the payload."""
    headers = {
        "WARC-Record-ID": name_of(page_id), "WARC-Date": date,
        "WARC-Target-URI": quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else name_of(page_id)[1:-1],
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()}
    if revisit:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": name_of(refers_to)}
    block = HTTP_HEAD.format(len(payload)).encode() + (b"" if revisit else payload)
    headers |= {"WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
                "Content-Type": "application/http;msgtype=response"}
    return record("revisit" if revisit else "response", headers, block)


class ArchiveWriter:
    """One archive. Records wait until there are enough to train the dictionary on."""

    def __init__(self, filesystem, path: str):
        self.path, self.stream = path, filesystem.open_output_stream(path, compression=None)
        self.waiting: list[bytes] = []
        self.held, self.records, self.compressor = 0, 0, None

    def add(self, data: bytes) -> None:
        self.held += len(data)
        self.records += 1
        if self.compressor:
            self.stream.write(self.compressor.compress(data))
        else:
            self.waiting.append(data)
            if self.held >= SAMPLE_BYTES:
                self._begin()

    def _begin(self) -> None:
        import zstandard

        dictionary = None
        if len(self.waiting) >= 16:
            try:
                dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, [w[:65536] for w in self.waiting], k=200, d=8)
            except zstandard.ZstdError:  # too little to learn from: the frame stays empty
                pass
        content = dictionary.as_bytes() if dictionary else b""
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        self.stream.write(struct.pack("<II", SKIPPABLE_DICTIONARY, len(content)) + content)
        for data in self.waiting:
            self.stream.write(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> tuple[str, int, int]:
        if not self.compressor:
            self._begin()
        self.stream.close()
        return self.path, self.records, self.held


def archive_frames(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of each frame, one at a time, with the dictionary that the archive begins with."""
    import zstandard

    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE_DICTIONARY:
        raise ValueError("the archive does not begin with a dictionary frame")
    length = struct.unpack("<I", head[4:])[0]
    content = stream.read(length)
    if len(content) != length:
        raise ValueError("the dictionary frame is cut off")
    if content[:4] == ZSTD_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    dictionary = zstandard.ZstdCompressionDict(content) if content else None
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    data = stream.read(step)
    while data:
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("the last frame is cut off")
            parts.append(frame.decompress(data))
            data = frame.unused_data or (b"" if frame.eof else stream.read(step))
        yield b"".join(parts)
        data = data or stream.read(step)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a frame that must be exactly one record: version, headers that every record has, no
    header twice, the stated length, the end mark, and the digest of the block if there is one."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError(f"not a record: {data[:40]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(": ")
        if not colon or name in headers:
            raise ValueError(f"bad header: {line!r}")
        headers[name] = value
    missing = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} - headers.keys()
    if missing or not headers["Content-Length"].isdigit():
        raise ValueError(f"headers missing or bad: {sorted(missing)}")
    length = int(headers["Content-Length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError(f"{headers['WARC-Record-ID']}: the length {length} does not fit")
    if "WARC-Block-Digest" in headers:
        if headers["WARC-Block-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
            raise ValueError(f"{headers['WARC-Record-ID']}: the block differs from its digest")
    return headers, block


def page_facts(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to; the payload itself for responses."""
    kind, name = headers["WARC-Type"], headers["WARC-Record-ID"]
    http, mark, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"\r\nContent-Length: (\d+)(?:\r\n|\Z)", http)
    digest = headers["WARC-Payload-Digest"]
    if not mark or not stated or not digest.startswith("sha1:"):
        raise ValueError(f"{name}: bad HTTP head or payload digest")
    length, digest = int(stated[1]), base64.b32decode(digest[5:]).hex()
    refers_to = None
    if kind == "response":
        if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{name}: the payload differs from its length or digest")
    elif kind == "revisit":
        if payload or headers.get("WARC-Profile") != REVISIT_PROFILE:
            raise ValueError(f"{name}: not a revisit by digest")
        refers_to = page_of(headers["WARC-Refers-To"])
    else:
        raise ValueError(f"{name}: unknown type {kind}")
    return page_of(name), headers["WARC-Target-URI"], length, digest, kind, refers_to, payload if kind == "response" else None


def _opened(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def with_originals(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, payload, digest, revisit, refers_to: of equal payloads from ``least`` bytes on the one with
    the largest page_id is the original. Only digests are compared, pre-counted before the shuffle; a group
    of copies of any size is one row of the side that is looked up."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copies = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(
        F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1").select("digest", "original")
    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    return rows.join(copies, "digest", "left").select(
        "page_id", "url", "payload", "digest", revisit.alias("revisit"),
        F.when(revisit, F.col("original")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``records`` (see :func:`with_originals`) below ``folder`` and returns the stored list of
    archives: path, records, bytes.

    Every task writes its own archives under new names and only those of tasks that succeed get into the
    list, so a task that is run again leaves an unlisted file and no record twice. ``folder`` must be one
    that all executors share; it is opened by pyarrow, so a cluster's store works as well as a folder.
    """
    folder = folder or shared_dir(records.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _opened(folder)
        filesystem.create_dir(base, recursive=True)
        done, writer = [], None
        for batch in batches:
            for page_id, url, payload, digest, revisit, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if writer is None:
                    writer = ArchiveWriter(filesystem, f"{base}/{uuid.uuid4().hex}.warc.zst")
                    writer.add(record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE,
                                                   "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                writer.add(page_record(page_id, url, payload, digest, refers_to, revisit))
                if writer.held >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        paths, counts, sizes = zip(*done) if done else ([], [], [])
        paths = [f"{folder.rstrip('/')}/{p.rsplit('/', 1)[1]}" for p in paths]
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    slim = records.select("page_id", "url", "payload", "digest", "revisit", "refers_to")
    return materialize(slim.mapInArrow(run, "path string, records long, bytes long"), "warc-list")


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records of listed archives (path): page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, if asked for, payload (null for revisits). An archive is read by one task as a stream, a
    record at a time; one that is not whole or not valid is an error that names it."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, own = _opened(path)
                rows, held = [], 0
                with filesystem.open_input_stream(own, compression=None) as stream:
                    try:
                        for data in archive_frames(stream):
                            headers, block = parse_record(data)
                            if headers["WARC-Type"] == "warcinfo":
                                continue
                            rows.append(page_facts(headers, block)[:len(names)])
                            held += len(data)
                            if held > 8 << 20:
                                yield table(rows)
                                rows, held = [], 0
                    except ValueError as wrong:
                        raise ValueError(f"{path}: {wrong}") from wrong
                yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # a task for each archive, which Spark would otherwise read as rows of one small list
    slots = max(archives.count(), 1)
    dealt = archives.select("path").repartition(slots, "path")
    return dealt.mapInArrow(run, schema + ", payload binary" * payloads)
