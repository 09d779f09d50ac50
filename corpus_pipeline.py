"""The corpus pipeline: toxicity, near duplicates, repeated passages, mixing and tokens, each stage on all that the one before kept.

Every stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's documents.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from mendstream.llm import bpe, mixing, ngramjoin, suffix, toxicity
from mendstream.llm.common import TABLES, release, reuse

MADE: list[str] = []  # shared tables of the stage that ran last
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(fn: Callable) -> Callable:
    """A stage that first deletes the shared tables of the one before, whose result has been written by now."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        used = [t for t in MADE if t in TABLES and not any(t in f for f in docs.inputFiles()[:1])]
        release(spark, used)
        MADE.clear()
        n = len(TABLES)
        out = fn(spark, docs, sf_dir)
        MADE.extend(TABLES[n:])
        return out

    return run_stage


@stage
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject. The model is fitted on labelled documents of the whole table."""
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(whole, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out=toxicity.HELD_OUT)
    return toxicity.score(docs.select(*COLUMNS), model, out_col="_score").where(F.col("_score") < toxicity.THRESHOLD).select(*COLUMNS)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8 or more), the one with the least id."""
    return ngramjoin.keep_one(docs.select(*COLUMNS), words=5, num=80, den=100)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 200 bytes that occur more than once; a character that is cut goes whole.
    Documents of which nothing is left go."""
    cut = F.col("_n_removed") > 0
    kept = suffix.remove_repeats(docs.select(*COLUMNS), as_text=True).where(~cut | (F.col("_kept") != ""))
    text = F.when(cut, F.col("_kept")).otherwise(F.col("text"))
    size = F.when(cut, F.length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", size.alias("n_chars"))


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: whole documents as often as the mix takes most of their words, so sources near their targets."""
    return mixing.mix_documents(docs.select(*COLUMNS))


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text, one row per document of the mix."""
    return bpe.round_trip(docs, bpe.default_vocabulary(), keep=["doc_id", "source"])


STAGES = [("toxicity", toxic), ("ngram_join", near_duplicates), ("suffix_dedup", repeated_passages), ("mix", mixed), ("bpe", tokens)]
ORACLE_SQL = None  # the toxicity model and the draws of the mix are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = reuse(docs)
    return docs
