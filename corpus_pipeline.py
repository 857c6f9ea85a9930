"""The corpus pipeline: documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that it
keeps, with the columns of ``documents``; the last returns the layout of the
token files.  Every stage's result is a written table, read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import crf, decontaminate, jaccard_join, mixing, token_files
from ledgerline.llm.common import read, saved
from ledgerline.llm.queries import MIX, TOXIC_FROM, tokenizer_file, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field scores below the rejection
    threshold."""
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    return crf.score(docs, model, spans=False).filter(F.col("toxicity") < TOXIC_FROM) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, a
    similarity of 0.8 or more."""
    return jaccard_join.keep_one_per_component(docs, size=5, percent=80)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur in the benchmark."""
    return decontaminate.cut(docs, read(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a document comes once per epoch that takes it."""
    return mixing.mixed(docs, MIX).drop("mix_epoch")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, read back."""
    return token_files.token_output(docs, tokenizer_file("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

# the toxicity model and the tokenizer cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
