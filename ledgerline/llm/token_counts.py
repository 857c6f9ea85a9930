"""Token counts through a digest cache.

The cache is a Parquet table (content digest, tokenizer digest, n_tokens).
Documents are joined to it by the digest of their content and of the
tokenizer's definition and version; only distinct contents that it lacks are
encoded, and their counts are appended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.chunked_tokenizer import ChunkEncoder, read_spec, spec_digest
from ledgerline.llm.common import batch_of, map_arrow, texts_of
from ledgerline.session import scratch_path

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"


def normalised():
    """The content that is counted: NULL is the empty text; nothing else may
    change, or the counts would."""
    return F.coalesce(F.col("text"), F.lit(""))


def content_digest():
    return F.unhex(F.sha2(normalised().cast("binary"), 256))


def open_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored counts, or None where nothing has been stored yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _distinct_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First row of each digest in a task: copies are thinned before the
    shuffle, so a content that a third of all rows share crosses it at most
    once per task."""
    seen: set[bytes] = set()
    for b in batches:
        keep = []
        for i, d in enumerate(b.column("content_digest").to_pylist()):
            if d not in seen:
                seen.add(d)
                keep.append(i)
        if keep:
            yield b.take(pa.array(keep))


def missing_texts(docs: DataFrame, cache: DataFrame | None, tokenizer_digest: str) -> DataFrame:
    """(content_digest, text) of contents without a stored count, dealt by
    digest; one digest may come from several tasks."""
    texts = map_arrow(docs.select(content_digest().alias("content_digest"),
                                  normalised().alias("text")),
                      _distinct_in_task, "content_digest binary, text string")
    if cache is None:
        return texts.repartition("content_digest")
    known = cache.filter(F.col("tokenizer_digest") == tokenizer_digest) \
        .select("content_digest").distinct()
    return texts.join(known, "content_digest", "left_anti") \
        .repartition("content_digest")


def fill_cache(docs: DataFrame, tokenizer_path: str, cache_path: str) -> str:
    """Encode the distinct misses of ``docs`` and append them to the cache;
    returns the tokenizer's digest."""
    spark = docs.sparkSession
    spec = read_spec(tokenizer_path)
    key = spec_digest(spec)
    shipped = spark.sparkContext.broadcast(spec)
    schema = pa.schema([("content_digest", pa.binary()), ("tokenizer_digest", pa.string()),
                        ("n_tokens", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = ChunkEncoder(shipped.value)
        for b in _distinct_in_task(batches):
            n = [len(x) // enc.dtype.itemsize for x in enc.encode(texts_of(b))]
            yield batch_of(schema, content_digest=b.column("content_digest"),
                           tokenizer_digest=[key] * len(n), n_tokens=n)

    misses = missing_texts(docs, open_cache(spark, cache_path), key)
    map_arrow(misses, encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    return key


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None,
                 limit: int = 1024) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes of its
    UTF-8, n_tokens, over_limit (n_tokens > limit).

    Texts are encoded whole, without added special tokens, truncation or
    padding; special strings inside them are handled as the library does by
    default.  NULL counts as the empty text (0 tokens); repeated rows and NULL
    ids keep their rows; empty input gives no rows.  ``cache_path`` names a
    cache that outlives the call; by default it is a fresh one.
    """
    spark = docs.sparkSession
    cache_path = cache_path or scratch_path(spark, "token-cache")
    key = fill_cache(docs, tokenizer_path, cache_path)
    counts = open_cache(spark, cache_path).filter(F.col("tokenizer_digest") == key) \
        .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows = docs.select(F.col("doc_id"), F.octet_length(normalised()).cast("long").alias("n_bytes"),
                       content_digest().alias("content_digest"))
    return rows.join(counts, "content_digest") \
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
