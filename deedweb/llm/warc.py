"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames, so a reader can start at any of them; a footer (a skippable frame)
tables the frames' sizes, and an index maps each record identifier to its frame and its place inside the frame. A bundle is
one binary value of a Parquet table, which any store that Spark writes to can hold; its bytes are a whole .warc.zst file.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedweb.llm.rows import small_batches
from deedweb.scratch import written

#: Bytes of records after which a frame ends, and of compressed frames after which a bundle ends.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 8 << 20
#: Payloads below this size are stored again rather than referred to.
MIN_REVISIT = 100
#: Fixed values of the seekable format: a skippable frame's magic number, the footer's, and the profile of a revisit.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    value = (name or "none").removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record. The block is an HTTP response; that of a revisit has the header only, which states the full length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + " ".join((url or "urn:none").split()),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if is_revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    split = data.index(b"\r\n\r\n", at)
    lines = data[at:split].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    end = split + 4 + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end at {end}")
    return headers, data[split + 4 : end], end + 4


def payload_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """The HTTP headers and the payload of a block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}, body


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for frames of (compressed, plain) sizes: a skippable frame with both sizes of each, and at its end the
    number of frames, a descriptor byte (no checksums) and a magic number."""
    rows = b"".join(struct.pack("<II", a, b) for a, b in frames)
    body = rows + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame of a bundle."""
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    out, at = [], 0
    for size, plain in struct.iter_unpack("<II", bundle[-9 - 8 * n : -9]):
        out.append((at, size, plain))
        at += size
    return out


def resolve_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """The rows ``id, url, payload`` plus ``digest`` (hex SHA-256 of the payload in UTF-8), ``first`` (the page that a revisit
    refers to) and ``revisit``. Only digests that occur again are joined back; unique payloads meet nothing."""
    payload = F.coalesce("payload", F.lit(""))
    digest = F.sha2(payload, 256)
    again = (
        pages.select("id", digest.alias("same"), F.octet_length(payload).alias("size"))
        .where(F.col("size") >= min_bytes)
        .groupBy("same")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("same", "first")
    )
    again = written(again, "payloads")
    joined = pages.withColumn("digest", digest).join(again, F.col("digest") == F.col("same"), "left").drop("same")
    return joined.withColumn("revisit", F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))


def write_bundles(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3,
) -> None:
    """A record for each row, in bundles at ``path``: a Parquet table ``bundle_id, content, records`` where ``records`` has
    ``record_id, frame_offset, frame_size, start, length`` (start and length are in the plain frame).

    Payloads are UTF-8; null counts as empty. Of records with equal payloads of ``MIN_REVISIT`` bytes or more, that with
    the smallest id is a response and the others are revisits that refer to it, also those without an id; rows that repeat
    the smallest id are responses too, and a group without any id has responses only. Ids need not differ. An empty table
    gives a table without bundles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        squeeze = zstandard.ZstdCompressor(level=level)
        frame, places, content, frames, records = bytearray(), [], bytearray(), [], []

        def end_frame() -> None:
            if frame:
                data = squeeze.compress(bytes(frame))
                records.extend({"record_id": i, "frame_offset": len(content), "frame_size": len(data), "start": a, "length": n} for i, a, n in places)
                frames.append((len(data), len(frame)))
                content.extend(data)
                frame.clear()
                places.clear()

        def bundle() -> pa.RecordBatch:
            nonlocal made
            out = pa.RecordBatch.from_arrays(
                [pa.array([base + made]), pa.array([bytes(content) + seek_table(frames)], pa.binary()), pa.array([list(records)], kind)],
                ["bundle_id", "content", "records"],
            )
            made += 1
            content.clear(), frames.clear(), records.clear()
            return out

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, payload, digest, refers_to, is_revisit = (x.as_py() for x in row)
                data = record(page_id, url, (payload or "").encode(), digest, refers_to, is_revisit)
                places.append((record_id(page_id), len(frame), len(data)))
                frame.extend(data)
                if len(frame) >= frame_bytes:
                    end_frame()
                    if len(content) >= bundle_bytes:
                        yield bundle()
        end_frame()
        if frames:
            yield bundle()

    numbers = ("frame_offset", "frame_size", "start", "length")
    kind = pa.list_(pa.struct([("record_id", pa.string()), *((n, pa.int64()) for n in numbers)]))
    records_type = f"array<struct<record_id: string, {', '.join(f'{n}: long' for n in numbers)}>>"
    slim = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].alias("url"), pages[payload_col].alias("payload"))
    rows = resolve_revisits(slim).select("id", "url", "payload", "digest", "first", "revisit")
    small_batches(rows).mapInArrow(run, f"bundle_id long, content binary, records {records_type}").write.parquet(path)


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the rows ``content``: ``page_id, record_type, url, payload_digest`` (hex), ``payload_bytes`` (of the
    full payload), ``refers_to``, ``payload`` (null for a revisit). Frames are found by the footer, and a response whose
    payload does not have the digest that its header states raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for content in batch.column(0):
                bundle = content.as_py()
                for offset, size, plain in read_seek_table(bundle):
                    yield _records(expand.decompress(bundle[offset : offset + size], max_output_size=plain))

    kinds = "page_id long, record_type string, url string, payload_digest string, payload_bytes long, refers_to long, payload string"
    return bundles.select("content").mapInArrow(run, kinds)


def _records(data: bytes) -> pa.RecordBatch:
    names = ("page_id", "record_type", "url", "payload_digest", "payload_bytes", "refers_to", "payload")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    rows, at = [], 0
    while at < len(data):
        headers, block, at = parse_record(data, at)
        http, body = payload_of(block)
        digest, is_revisit = headers["warc-payload-digest"].removeprefix("sha256:"), headers["warc-type"] == "revisit"
        if not is_revisit and hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"{headers['warc-record-id']} does not have the digest that it states")
        uri = headers["warc-target-uri"]
        rows.append(
            (
                page_of(headers["warc-record-id"]), headers["warc-type"], None if uri == "urn:none" else uri, digest,
                int(http["content-length"]), page_of(headers["warc-refers-to"]) if is_revisit else None,
                None if is_revisit else body.decode(),
            )
        )
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


def read_at(bundles: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records ``record_id`` asked for, like ``read_bundles``: the index says in which frame each is, and only those
    frames are cut from the bundles and expanded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for frame, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plain = expand.decompressobj().decompress(frame)
                yield _records(plain[start : start + length])

    places = bundles.select("content", F.explode("records").alias("at"))
    asked = places.join(record_ids.select("record_id").distinct(), F.col("at.record_id") == F.col("record_id"), "left_semi")
    frames = asked.select(
        F.substring("content", F.col("at.frame_offset").cast("int") + 1, F.col("at.frame_size").cast("int")).alias("frame"), "at.start", "at.length"
    )
    kinds = "page_id long, record_type string, url string, payload_digest string, payload_bytes long, refers_to long, payload string"
    return frames.mapInArrow(run, kinds)
