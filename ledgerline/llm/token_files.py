"""Token-id files: one concatenated id array per file, its document
boundaries as an Elias-Fano sequence.

File layout (little-endian):

    magic b"LTOK1\\0", id width in bytes (u1), pad (u1)
    range bucket (i8), sequence number in the bucket (i8), documents n (u8), tokens (u8)
    validity of the document ids, one byte each; the ids, n * i8
    Elias-Fano sequence of the n + 1 boundaries 0 .. tokens
    the id array

Files hold documents in ascending ``doc_id`` (NULL ids first, ties by their
ids' bytes); (bucket, sequence) orders the files, so the position of a
document in the whole array is its file's offset plus its boundary.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.chunked_tokenizer import read_spec
from ledgerline.llm.common import batch_of, map_arrow, publish, saved, shuffle_partitions, texts_of
from ledgerline.llm.elias_fano import EliasFano
from ledgerline.llm.word_encoder import encoder_for
from ledgerline.session import scratch_path

MAGIC = b"LTOK1\0"
HEAD = struct.Struct("<6sBxqqQQ")
# A file is closed when it holds this many tokens; one longer document is a
# file of its own.
FILE_TOKENS = 4_000_000
RANGE_BUCKETS_PER_PARTITION = 2
READ_DOCS = 4096                  # slices looked up together


def pack_file(bucket: int, seq: int, doc_ids: list, ids: list[bytes], dtype) -> list[bytes]:
    ends = np.cumsum([0] + [len(x) // dtype.itemsize for x in ids], dtype=np.int64)
    return [HEAD.pack(MAGIC, dtype.itemsize, bucket, seq, len(doc_ids), int(ends[-1])),
            bytes(d is not None for d in doc_ids),
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            EliasFano.encode(ends).to_bytes(), *ids]


class TokenFile:
    """A token file's content: ``ids(i)`` is document i's slice, found by
    the boundaries' select structure."""

    def __init__(self, data: bytes):
        if len(data) < HEAD.size:
            raise ValueError("truncated token file")
        magic, width, self.bucket, self.seq, n, self.n_tokens = HEAD.unpack_from(data)
        if magic != MAGIC or width not in (2, 4):
            raise ValueError("not a token file")
        at = HEAD.size
        valid, at = data[at:at + n], at + n
        raw, at = np.frombuffer(data, "<i8", n, at), at + 8 * n
        self.doc_ids = [int(d) if v else None for d, v in zip(raw, valid)]
        self.bounds, at = EliasFano.from_bytes(data, at)
        if len(data) != at + width * self.n_tokens or self.bounds.n != n + 1 \
                or self.bounds.u != self.n_tokens:
            raise ValueError("token file length does not match its header")
        self._ids = np.frombuffer(data, f"<u{width}", self.n_tokens, at)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.bounds.select_many(np.array([i, i + 1]))
        return self._ids[a:b]

    def slices(self, index: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Offsets in the file and ids of the documents at ``index``."""
        i = np.asarray(index, dtype=np.int64)
        start, stop = self.bounds.select_many(i), self.bounds.select_many(i + 1)
        return start, [self._ids[a:b] for a, b in zip(start.tolist(), stop.tolist())]


def tokenised(docs: DataFrame, spec: str, end_id: int, bounds: list[float]) -> DataFrame:
    """(bucket, doc_id, ids): the packed ids of every whole text, ``end_id``
    behind each; NULL is the empty text.  The bucket is the place of doc_id
    among ``bounds`` (a list as long as the shuffle has buckets); NULL ids are
    in bucket 0."""
    shipped = docs.sparkSession.sparkContext.broadcast(spec)
    schema = pa.schema([("bucket", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])
    cuts = np.array(bounds, dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_for(shipped.value)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for b in batches:
            d = b.column("doc_id")
            place = np.searchsorted(cuts, np.array([float("-inf") if x is None else x
                                                    for x in d.to_pylist()], dtype=np.float64),
                                    side="right")
            yield batch_of(schema, bucket=place, doc_id=d,
                           ids=[x + end for x in enc.encode(texts_of(b))])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "bucket long, doc_id long, ids binary")


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
                      file_tokens: int = FILE_TOKENS) -> tuple[str, DataFrame]:
    """Write ``docs`` (doc_id, text) as token files under ``folder`` (by
    default a fresh one in the shared scratch folder).  Returns the folder and
    the manifest (bucket, seq, file, n_docs, n_tokens).

    Documents are dealt into ranges of doc_id whose bounds come from the id
    column's quantiles, so the tokens move once; a task sorts its ranges and
    streams them out, holding one file at a time.  Empty input gives no file.
    """
    spark = docs.sparkSession
    spec = read_spec(tokenizer_path)
    folder = folder or scratch_path(spark, "tokens")
    dtype = encoder_for(spec).dtype
    parts = shuffle_partitions(spark)
    k = parts * RANGE_BUCKETS_PER_PARTITION
    bounds = docs.select(F.col("doc_id").cast("double").alias("d")) \
        .approxQuantile("d", [i / k for i in range(1, k)], min(0.001, 0.2 / k))
    dealt = tokenised(docs, spec, end_id, sorted(set(bounds))) \
        .repartition(parts, "bucket").sortWithinPartitions("bucket", "doc_id", "ids")
    schema = pa.schema([("bucket", pa.int64()), ("seq", pa.int64()), ("file", pa.string()),
                        ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"bucket": None, "seq": 0, "docs": [], "ids": [], "size": 0}

        def close():
            name = f"tokens-{state['bucket']:08d}-{state['seq']:08d}.ltok"
            publish(folder, name, pack_file(state["bucket"], state["seq"], state["docs"],
                                            state["ids"], dtype))
            row = batch_of(schema, bucket=[state["bucket"]], seq=[state["seq"]], file=[name],
                           n_docs=[len(state["docs"])], n_tokens=[state["size"]])
            state.update(seq=state["seq"] + 1, docs=[], ids=[], size=0)
            return row

        for b in batches:
            for bk, d, x in zip(*(b.column(c).to_pylist() for c in ("bucket", "doc_id", "ids"))):
                n = len(x) // dtype.itemsize
                if state["docs"] and (bk != state["bucket"] or state["size"] + n > file_tokens):
                    yield close()
                if bk != state["bucket"]:
                    state.update(bucket=bk, seq=0)
                state["docs"].append(d)
                state["ids"].append(x)
                state["size"] += n
        if state["docs"]:
            yield close()

    manifest = saved(map_arrow(dealt, run, "bucket long, seq long, file string, n_docs long, "
                                           "n_tokens long"), "token-manifest")
    return folder, manifest


def read_token_files(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents read back from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 of the ids as little-endian
    unsigned 32-bit integers."""
    schema = pa.schema([("bucket", pa.int64()), ("seq", pa.int64()), ("doc_id", pa.int64()),
                        ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                f = TokenFile(content.as_buffer().to_pybytes())
                for first in range(0, len(f), READ_DOCS):
                    index = np.arange(first, min(first + READ_DOCS, len(f)))
                    at, ids = f.slices(index)
                    n = len(index)
                    yield batch_of(schema, bucket=[f.bucket] * n, seq=[f.seq] * n,
                                   doc_id=f.doc_ids[first:first + n], at=at,
                                   n_tokens=[len(x) for x in ids],
                                   ids_crc32=[zlib.crc32(x.astype("<u4").tobytes()) for x in ids])

    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if manifest.isEmpty():
        return spark.createDataFrame([], out)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ltok").load(folder)
    rows = map_arrow(files.select("content"), run,
                     "bucket long, seq long, doc_id long, at long, n_tokens long, ids_crc32 long")
    # offsets of the files: totals per bucket first (as many rows as the
    # shuffle has buckets), then within each bucket
    per = manifest.groupBy("bucket").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("bucket").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    offs = manifest.select("bucket", "seq",
                           F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)).alias("inside")) \
        .join(per, "bucket").select("bucket", "seq", (F.col("base") + F.col("inside")).alias("offset"))
    return rows.join(offs, ["bucket", "seq"]) \
        .select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int,
                 folder: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and read them back.

    NULL and empty texts are the end id alone; equal rows are written as
    often as they occur; a NULL doc_id sorts first.
    """
    folder, manifest = write_token_files(docs, tokenizer_path, end_id, folder)
    return read_token_files(docs.sparkSession, folder, manifest)
