"""WARC archives of Zstandard frames.

An archive starts with a skippable frame that holds the dictionary (absent if
the archive has none), then has one frame per record. Tasks write and read
archives as streams through ``pyarrow.fs``, in a folder that all executors see; an
archive appears under its name only when it is complete, so a repeated task
replaces its own file and never leaves half of one.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import HEAVY_SHARE, join_by_size, stage

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20  # of an archive's first payloads, for its dictionary
ARCHIVE_BYTES = 256 << 20
RECORD_BYTES = (1 << 31) - (1 << 20)  # Spark holds no larger value
READ_BYTES = 256 << 10
RECORD = pa.schema([
    ("archive", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("refers_to", pa.string()), ("uri", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string()),
])


class Damaged(ValueError):
    """A frame or record that breaks the format."""


def as_uri(path: str) -> str:
    """Spark writes local paths as file:/folder, which is no full URI."""
    return re.sub(r"^file:/(?=[^/])", "file:///", path)


def digest_of(payload: bytes) -> str:
    """Base32 SHA-1, without the algorithm's name."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ----------------------------------------------------------------


def dictionary_of(samples: list[bytes]) -> bytes:
    """A trained dictionary, or none where the samples are too few to train one."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if len(samples) < 8 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, f=18, accel=4).as_bytes()
    except zstandard.ZstdError:
        return b""


def record_bytes(kind: str, record_id: str, refers_to: str | None, uri: str, date: str, payload: bytes,
                 digest: str) -> bytes:
    """One record: version line, headers, HTTP head and, for a response, the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (payload if kind == "response" else b"")
    head = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date),
        ("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
    ]
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def header_safe(value: str | None) -> str:
    """Line ends cannot stand in a header; the percent sign keeps this reversible."""
    value = value or ""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if any(
        c in value for c in "\r\n") else value


class ArchiveWriter:
    """One archive at a time; a new one is begun at ``ARCHIVE_BYTES``."""

    def __init__(self, folder: str, stem: str):
        self.store, self.root = fs.FileSystem.from_uri(as_uri(folder))
        self.stem, self.count, self.out = stem, 0, None

    def begin(self, samples: list[bytes]) -> None:
        raw = dictionary_of(samples)
        self.path = f"{self.root}/{self.stem}-{self.count:05d}.warc.zst"
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.count += 1
        self.out, self.size = self.store.open_output_stream(self.part), 0
        options = {"level": 3, "write_checksum": True}
        if raw:
            self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
            options["dict_data"] = zstandard.ZstdCompressionDict(raw)
        self.frames = zstandard.ZstdCompressor(**options)

    def add(self, record: bytes) -> None:
        frame = self.frames.compress(record)
        self.out.write(frame)
        self.size += len(frame)

    def end(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.part, self.path)
            self.out = None


def write_partition(folder: str, date: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        writer = ArchiveWriter(folder, f"part-{task.partitionId():06d}")
        held, held_bytes, written = [], 0, 0

        def flush():
            if writer.out is None:
                writer.begin([r["payload"] for r in held if r["record_type"] == "response" and r["payload"]])
            for r in held:
                writer.add(record_bytes(
                    r["record_type"], r["record_id"], r["refers_to"], header_safe(r["uri"]), date,
                    r["payload"], digest_of(r["payload"])))
            if writer.size >= ARCHIVE_BYTES:
                writer.end()

        for pdf in batches:
            for r in pdf.to_dict("records"):
                held.append(r)
                held_bytes += len(r["payload"])
                if held_bytes >= SAMPLE_BYTES:
                    flush()
                    written += len(held)
                    held, held_bytes = [], 0
        if held:
            flush()
        writer.end()
        yield pd.DataFrame({"written": [written + len(held)]})

    return run


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> int:
    """Write one record per page under ``folder`` and return how many.

    The payload is the html in UTF-8, a null one is empty. Of equal payloads of at
    least ``min_revisit_bytes`` bytes the page with the largest page_id is a
    response and the others revisit it; smaller payloads are all responses.
    Rows that repeat the largest page_id are responses too. A null page_id comes
    after all others; pages without one are responses if no equal payload has one.
    Null urls are empty. Other columns are not written.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.encode(F.col(html).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("string").alias("name"), F.col(page_id).alias("page_id"),
                        F.col(url).alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = stage(
        rows.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")), "payloads"
    )
    # single payloads need no partner: only groups of several rows are joined to their pages,
    # from a table of their own, which is broadcast by its size if it is small
    total = int(groups.agg(F.sum("n")).first()[0] or 0)
    several = stage(groups.where("n > 1"), "repeated_payloads")
    heavy = several.where(F.col("n") > total * HEAVY_SHARE).select("digest")  # not shuffled, see join_by_size
    lone = rows.join(F.broadcast(heavy), "digest", "left_anti").join(several.select("digest"), "digest", "left_anti")
    lone = lone.withColumn("first", F.col("page_id"))
    met = join_by_size(rows, several, "digest", "n", total).drop("n")
    ready = lone.unionByName(met)
    revisit = (
        (F.length("payload") >= min_revisit_bytes) & F.col("first").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("first"))
    )
    ready = ready.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:page:"), F.coalesce("name", F.lit(""))).alias("record_id"),
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
        "uri", "payload",
    )
    store, root = fs.FileSystem.from_uri(as_uri(folder))
    store.create_dir(root, recursive=True)
    done = ready.mapInPandas(write_partition(folder, date), "written long")
    return int(done.agg(F.sum("written")).first()[0] or 0)


# --- reading ----------------------------------------------------------------


def frames_of(stream) -> Iterator[bytes | None]:
    """The decoded frames of an archive, one record each, read as a stream.

    The dictionary is loaded from the leading skippable frame, which may hold it
    compressed. Other skippable frames are passed over. A record that no Spark value
    can hold is decoded to its end without being kept, and gives None.
    """
    buffer, ended = b"", False

    def need(n: int) -> bool:
        nonlocal buffer, ended
        while len(buffer) < n and not ended:
            more = stream.read(max(READ_BYTES, n - len(buffer)))
            ended = not more
            buffer += more
        return len(buffer) >= n

    decoder = zstandard.ZstdDecompressor()
    leading = True
    while need(1):
        if not need(4):
            raise Damaged("the archive ends inside a frame")
        magic = struct.unpack_from("<I", buffer)[0]
        if magic in SKIPPABLE_MAGICS:
            if not need(8) or not need(8 + struct.unpack_from("<I", buffer, 4)[0]):
                raise Damaged("the archive ends inside a skippable frame")
            size = struct.unpack_from("<I", buffer, 4)[0]
            if leading and magic == DICTIONARY_MAGIC:
                raw = buffer[8 : 8 + size]
                if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                    raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=RECORD_BYTES)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
            buffer, leading = buffer[8 + size :], False
            continue
        if magic != FRAME_MAGIC:
            raise Damaged(f"no frame begins with {magic:08x}")
        leading = False
        frame = decoder.decompressobj()
        out: io.BytesIO | None = io.BytesIO()
        try:
            while not frame.eof:
                if not need(1):
                    raise Damaged("the archive ends inside a frame")
                more = frame.decompress(buffer)
                buffer = frame.unused_data if frame.eof else b""
                if out is not None and out.tell() + len(more) > RECORD_BYTES:
                    out = None
                if out is not None:
                    out.write(more)
        except zstandard.ZstdError as error:
            raise Damaged(f"a frame cannot be decoded: {error}") from error
        yield None if out is None else out.getvalue()


def parse_record(raw: bytes | None) -> dict:
    """One record's fields; Damaged where headers, lengths or digests are wrong, or the record is too large."""
    if raw is None:
        raise Damaged(f"the record is larger than {RECORD_BYTES} bytes")
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", VERSION):
        raise Damaged("no WARC version line and header block")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("a header line has no name")
        fields[name.strip().decode().lower()] = value.strip().decode("utf-8", "replace")
    for name in NEEDED:
        if name.lower() not in fields:
            raise Damaged(f"{name} is missing")
    length = fields["content-length"]
    if not length.isdigit() or int(length) + 4 != len(rest):
        raise Damaged("Content-Length does not match the frame")
    block, end = rest[:-4], rest[-4:]
    if end != b"\r\n\r\n":
        raise Damaged("the record does not end with two line ends")
    if (want := fields.get("warc-block-digest")) and want != "sha1:" + digest_of(block):
        raise Damaged("the block digest differs")
    out = {
        "record_type": fields["warc-type"], "record_id": fields["warc-record-id"].strip("<>"),
        "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
        "uri": fields.get("warc-target-uri"), "payload_bytes": len(block), "payload": block,
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
    }
    if fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            raise Damaged("no HTTP header block")
        sizes = [v for k, _, v in (h.partition(b":") for h in http.split(b"\r\n")[1:])
                 if k.strip().lower() == b"content-length"]
        if not sizes or not sizes[0].strip().isdigit():
            raise Damaged("no HTTP Content-Length")
        out |= {"payload": payload, "payload_bytes": int(sizes[0])}
        if out["record_type"] == "response":
            if len(payload) != out["payload_bytes"]:
                raise Damaged("the HTTP Content-Length differs")
            if out["payload_digest"] not in (None, digest_of(payload)):
                raise Damaged("the payload digest differs")
        elif payload:
            raise Damaged("a revisit has a payload")
        else:
            out["payload"] = None
    return out


def read_partition(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            yield from records(path)

    def records(path: str) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        try:
            store, name = fs.FileSystem.from_uri(as_uri(path))
            with store.open_input_stream(name, compression=None) as stream:
                for raw in frames_of(stream):
                    try:
                        row = parse_record(raw) | {"error": None}
                    except Damaged as error:
                        row = {"error": str(error)}
                    if not payloads:
                        row["payload"] = None
                    rows.append(row | {"archive": path})
                    held += len(raw or b"")
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, RECORD)
                        rows, held = [], 0
        except Damaged as error:  # the rest of this archive cannot be found
            rows.append({"error": str(error), "archive": path})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, RECORD)

    return run


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of all ``*.warc.zst`` under ``folder``.

    A record that fails a check, or is too large for a Spark value (2 GiB), has only
    ``archive`` and ``error`` and reading goes on behind it; where a frame
    cannot be decoded the archive's remaining frames are given up with one such
    row. A folder without archives gives an empty result. Payloads are checked in
    any case; with ``payloads=False`` they are not returned.
    """
    paths = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path")
    )
    many = spark.sparkContext.defaultParallelism * 4
    return paths.repartition(many, "path").mapInArrow(read_partition(payloads), from_arrow_schema(RECORD))
