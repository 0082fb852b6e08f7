"""A training corpus from `documents`: language, toxicity, near-duplicates, mixing, token ids.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written and read again as the next one's docs.
Stages take rows with nulls in any column, empty and very long texts, ties, repeated rows, empty tables and further columns
under any name that doesn't begin with two underscores; each docstring says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bpe, langid, mixing, simhash, toxicity
from quillspark.llm.common import materialize, table
from quillspark.storage import release, scope


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those learnt from the documents' own lang.

    Null, empty and letterless texts go, and where no row has a lang, all do. Equal texts share their fate: repeated rows stay
    or go together. Rows keep all of their columns.
    """
    return langid.keep(docs)


def toxic_rejection(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity isn't above the cut that the labels give; those at the cut stay.

    Null and empty texts stay, as do all rows where labels don't have both classes. Repeated rows stay or go together. Rows
    keep all of their columns.
    """
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links: the one of the smallest doc_id, nulls last, then by a hash of the row.

    Null and empty texts are copies of each other. Of repeated rows one stays, with all of its columns.
    """
    return simhash.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them, each copy with all of its columns.

    A null source is a source. Null and empty texts are taken in whole epochs of their source only; where no text has a
    word, nothing is taken.
    """
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns, the number of ids, the ids, and whether decoding gives the text back.

    A null text counts as empty and has no ids. Columns of docs that are named ids, n_tokens or round_trip are replaced.
    """
    rows = docs.drop("ids", "n_tokens", "round_trip")
    both = bpe.decode(bpe.encode(rows), decoded="__back")
    same = F.col("__back") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return both.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long")).withColumn("round_trip", same).drop("__back")


STAGES = [("language_id", language_id), ("toxicity", toxic_rejection), ("simhash_dedup", near_dedup), ("mixing", source_mixing), ("bpe", bpe_encoding)]

#: Language models, fingerprints and token ids can't be had from SQL; tests/llm/test_pipeline.py holds all stages and run()
#: against plain Python written apart from them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote is deleted once the next one is written."""
    docs, written = table(spark, sf_dir, "documents"), False
    for _, stage in STAGES:
        before = docs
        with scope() as keep:
            docs = keep(materialize(stage(spark, before, sf_dir)))
        if written:
            release(before)
        written = True
    return docs
