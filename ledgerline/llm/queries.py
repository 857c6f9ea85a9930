"""The operators bound to the supplied tables, with production parameters.

REGISTRY: name -> (callable (spark, sf_dir) -> DataFrame, DuckDB SQL or None).
"""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from ledgerline.llm import (
    conversation_repair,
    crf,
    decontaminate,
    jaccard_join,
    katz,
    language_id,
    mixing,
    packing,
    periodic_runs,
    token_counts,
    token_files,
    topk,
    warc,
)
from ledgerline.llm.common import held_out, read

TOXIC_FROM = 0.5
MIX = mixing.Mix(
    weights={"domain": {"web": 50, "books": 20, "code": 20, "forum": 10},
             "lang": {"en": 60, "de": 20, "fr": 15, "es": 5}},
    domains={"0": "web", "1": "books", "2": "books", "3": "code", "4": "code", "5": "forum", "6": "forum"})


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark, sf_dir):
    """Component of every document under links of 4-word shingle sets."""
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), size=4, percent=85)


def op2_warc(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    return warc.warc_round_trip(read(spark, sf_dir, "pages"), min_payload_bytes=0)


def toxicity_model(docs, labels):
    """The field, fitted on the labelled rows that are not held out."""
    return crf.train(docs.filter(~held_out("doc_id", 5, 0)), labels)


def op3_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    return crf.score(docs, model, spans=False).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC_FROM).cast("int").alias("predicted"))


def op4_topk(spark, sf_dir):
    """The ten best vectors of every query vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), k=10, every=100)


def op5_mixing(spark, sf_dir):
    """Documents of the mixture, one row per epoch that takes them."""
    docs = read(spark, sf_dir, "documents")
    none = F.lit("")
    return mixing.mixed(docs, MIX).select(
        "doc_id", mixing.domain_of(MIX).alias("domain"), F.coalesce("lang", none).alias("lang"),
        F.coalesce("source", none).alias("source"), F.col("mix_epoch").alias("epoch"))


def op6_language_id(spark, sf_dir):
    """Language of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(~held_out("doc_id", 4, 2)))
    return language_id.predict(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op7_katz_backoff(spark, sf_dir):
    """Log probability of every document."""
    return katz.katz_scores(read(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))


def op8_decontamination(spark, sf_dir):
    """Benchmark windows found in every document."""
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


def op9_token_output(spark, sf_dir):
    """Token ids of every document in the file format, read back."""
    return token_files.token_output(read(spark, sf_dir, "documents"),
                                    tokenizer_file("word_bpe_49k.json"), end_id=1)


def op10_token_counts(spark, sf_dir):
    """Token counts of every document through the digest cache."""
    return token_counts.token_counts(read(spark, sf_dir, "documents"),
                                     tokenizer_file("byte_bpe_50k.json"), limit=1024)


def planted_repeats(doc_id, words):
    """The words of a document in ten repeat with a period from some place
    on, as a function of the id; without an id they stay."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark, sf_dir):
    """Repeated stretches of every document's words."""
    found = periodic_runs.periodic_runs(read(spark, sf_dir, "documents"), least=6, times=4, prepare=planted_repeats)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def op12_packing(spark, sf_dir):
    """Every document's ids in sequences of at most 4096."""
    return packing.piece_rows(packing.pack(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"),
                                           end_id=2, window=4096))


def damaged(rows):
    """Conversation rows with planted faults, each a function of the row's
    id and turn; ``alive`` is false for a row that is lost."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                      F.coalesce(F.col("turn").cast("string"), space))
    k = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn", (k != 0).alias("alive"),
        F.when(k == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(k == 1, F.lit("")).when(k == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))


def op13_conversation_repair(spark, sf_dir):
    """Faults and cheapest repair of every damaged conversation."""
    return conversation_repair.repair(damaged(read(spark, sf_dir, "conversations")), alive="alive")


REGISTRY = {
    "op1_ngram_jaccard_join": (op1_ngram_jaccard_join, None),
    "op2_warc": (op2_warc, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_topk": (op4_topk, None),
    "op5_mixing": (op5_mixing, mixing.oracle_sql(MIX)),
    "op6_language_id": (op6_language_id, None),
    "op7_katz_backoff": (op7_katz_backoff, None),
    "op8_decontamination": (op8_decontamination, None),
    "op9_token_output": (op9_token_output, None),
    "op10_token_counts": (op10_token_counts, None),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_packing": (op12_packing, None),
    "op13_conversation_repair": (op13_conversation_repair, None),
}
