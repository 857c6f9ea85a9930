"""WARC archives compressed record by record with Zstandard.

An archive is a skippable frame (magic 0x184D2A5D) with the dictionary,
followed by one frame per record, each compressed with that dictionary.  The
reader finds a frame's end from its block headers, decodes one frame at a
time and validates versions, required headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, map_arrow, publish, saved
from ledgerline.session import scratch_path

DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")      # the RFC's URL namespace
# An archive is closed at this size; the dictionary is trained on at most so
# many records, of at most so many bytes each.
ARCHIVE_BYTES = 8_000_000
DICT_RECORDS, DICT_RECORD_BYTES, DICT_BYTES = 256, 16_384, 16_384


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record; a revisit carries the HTTP head alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    uri = "".join((url or "about:blank").split())
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
            ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                 ("X-Refers-To-Page-ID", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" \
        + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        k, sep, v = line.partition(b":")
        if not sep or not k.strip():
            raise WarcError(f"bad header line {line[:60]!r}")
        out[k.strip().decode().lower()] = v.strip().decode()
    return out


def parse_record(data: bytes) -> dict:
    """A record's fields after validation."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not sep or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"not a WARC record: {version[:40]!r}")
    h = _headers(lines)
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if k not in h:
            raise WarcError(f"missing header {k}")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4 \
            or not rest.endswith(b"\r\n\r\n"):
        raise WarcError("Content-Length does not match the record")
    block = rest[:-4]
    http, sep, payload = block.partition(b"\r\n\r\n")
    if not sep or not http.startswith(b"HTTP/"):
        raise WarcError("no HTTP head in the block")
    length = int(_headers(http.partition(b"\r\n")[2])["content-length"])
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = h["warc-type"]
    if kind == "response":
        if len(payload) != length:
            raise WarcError("payload length does not match the HTTP head")
        if sha1_base32(payload) != digest:
            raise WarcError("payload digest does not match")
    elif kind != "revisit" or payload or "warc-refers-to" not in h:
        raise WarcError(f"bad {kind} record")
    page, refers = h.get("x-page-id"), h.get("x-refers-to-page-id")
    return {"page_id": None if page is None else int(page), "url": h.get("warc-target-uri"),
            "record_type": kind, "payload": payload if kind == "response" else None,
            "payload_bytes": length, "payload_digest": digest,
            "refers_to": None if refers is None else int(refers)}


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary if dictionary else b""


def frame_end(data: memoryview, at: int) -> int:
    """Offset behind the frame at ``at``, from its header and block headers."""
    if len(data) < at + 6 or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise WarcError(f"no Zstandard frame at byte {at}")
    try:
        pos = at + zstandard.frame_header_size(data[at:at + 18])
    except zstandard.ZstdError as e:
        raise WarcError(f"bad frame header at byte {at}: {e}") from e
    checksum = 4 if data[at + 4] & 4 else 0
    while True:
        if len(data) < pos + 3:
            raise WarcError(f"truncated frame at byte {at}")
        head = int.from_bytes(data[pos:pos + 3], "little")
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    if len(data) < pos + checksum:
        raise WarcError(f"truncated frame at byte {at}")
    return pos + checksum


def read_archive(content: bytes) -> Iterator[dict]:
    """Records of one archive, decoded one frame at a time."""
    data, at = memoryview(content), 0
    dictionary = None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICT_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if len(data) < 8 + size:
            raise WarcError("truncated dictionary frame")
        raw = bytes(data[8:8 + size])
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):       # the dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    decode = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        end = frame_end(data, at)
        try:
            record = decode.decompress(data[at:end])
        except zstandard.ZstdError as e:
            raise WarcError(f"frame at byte {at}: {e}") from e
        yield parse_record(record) | {"offset": at}
        at = end


def train_dictionary(pages: DataFrame, date: str) -> bytes:
    """A dictionary from a bounded sample of records; empty where the sample
    is too small to train on."""
    rows = pages.select("page_id", "url", F.left(F.col("html"), F.lit(DICT_RECORD_BYTES)).alias("html")) \
        .limit(DICT_RECORDS).collect()
    samples = []
    for r in rows:
        p = (r.html or "").encode()
        samples.append(build_record(r.page_id, r.url, p, sha1_base32(p), None, False, date))
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes() if len(samples) > 15 else b""
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, refers_to, revisit): of rows with equal
    payloads of at least ``min_payload_bytes`` the largest page_id responds,
    the others revisit it.  Digests are counted narrow and combined before
    their shuffle; only contents that occur more than once come back to the
    pages."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")) \
        .withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    groups = rows.filter(F.octet_length("html") >= min_payload_bytes).groupBy("digest") \
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to")
    return rows.join(groups, "digest", "left") \
        .withColumn("revisit", F.col("refers_to").isNotNull()
                    & ~F.col("page_id").eqNullSafe(F.col("refers_to")))


def write_archives(pages: DataFrame, folder: str | None = None, min_payload_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES, date: str = "2024-01-01T00:00:00Z",
                   level: int = 3) -> tuple[str, DataFrame]:
    """Write one record per row of ``pages`` (page_id, url, html) as archives
    under ``folder``; returns it and a manifest (file, n_records, n_bytes).

    Rows are sorted within a task and archives named by its partition, so a
    repeated task writes the same files again.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    shipped = pages.sparkSession.sparkContext.broadcast(train_dictionary(pages, date))
    schema = pa.schema([("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, part, seq = shipped.value, TaskContext.get().partitionId(), 0
        encode = zstandard.ZstdCompressor(
            level=level, write_checksum=True,
            dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        frames, size = [], 0

        def close():
            name = f"pages-{part:06d}-{seq:06d}.warc.zst"
            publish(folder, name, [dictionary_frame(raw), *frames])
            return batch_of(schema, file=[name], n_records=[len(frames)], n_bytes=[size])

        for b in batches:
            cols = (b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest",
                                                      "refers_to", "revisit"))
            for page, url, html, digest, refers, revisit in zip(*cols):
                payload = html.encode()
                f = encode.compress(build_record(page, url, payload, base64.b32encode(digest).decode(),
                                                 refers, revisit, date))
                if frames and size + len(f) > archive_bytes:
                    yield close()
                    frames, size, seq = [], 0, seq + 1
                frames.append(f)
                size += len(f)
        if frames:
            yield close()

    rows = with_revisits(pages, min_payload_bytes) \
        .select("page_id", "url", "html", "digest", "refers_to", "revisit") \
        .sortWithinPartitions("page_id", "digest", "url")
    return folder, saved(map_arrow(rows, run, "file string, n_records long, n_bytes long"),
                         "warc-manifest")


def read_archives(spark, folder: str, payloads: bool = True) -> DataFrame:
    """Validated records of the archives under ``folder``: file, offset,
    page_id, url, record_type, payload_bytes, payload_digest, refers_to and,
    if asked for, payload (NULL for revisits).  A broken archive is an error."""
    names = ["offset", "page_id", "url", "record_type", "payload_bytes", "payload_digest",
             "refers_to"] + ["payload"] * payloads
    kinds = {"url": pa.string(), "record_type": pa.string(), "payload_digest": pa.string(),
             "payload": pa.binary()}
    schema = pa.schema([("file", pa.string())] + [(n, kinds.get(n, pa.int64())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                held, size = [], 0
                for r in read_archive(content.as_buffer().to_pybytes()):
                    held.append(r)
                    size += len(r["payload"] or b"") if payloads else 64
                    if size > 8_000_000:
                        yield batch_of(schema, file=[path] * len(held),
                                       **{n: [x[n] for x in held] for n in names})
                        held, size = [], 0
                if held:
                    yield batch_of(schema, file=[path] * len(held),
                                   **{n: [x[n] for x in held] for n in names})

    sql = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return map_arrow(files.select("path", "content"), run,
                     ", ".join(f"{f.name} {sql[f.type]}" for f in schema))


def warc_round_trip(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives and read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to per row.

    NULL html is the empty payload; NULL url becomes about:blank; equal rows
    with the responding page_id are all responses; NULL page_ids never
    respond for others.  Empty input gives no rows.
    """
    spark = pages.sparkSession
    folder, manifest = write_archives(pages, min_payload_bytes=min_payload_bytes)
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, "
                                         "record_type string, refers_to long")
    return read_archives(spark, folder, payloads=False) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
