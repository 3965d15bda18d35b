"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is to be written as Parquet and
reread as the next stage's docs; ``run`` does so.  A stage sees all columns of ``documents`` and
returns them, but for the last, which returns the packed pieces.  Rows may be null in any column,
empty or repeated; a stage on an empty table returns an empty table.

A stage's own intermediate tables are deleted when the next stage starts, as its result has
been written by then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm import langid
from forgeline.llm.common import table
from forgeline.llm.exact_dedup import exact_dedup
from forgeline.llm.packing import pack_documents
from forgeline.llm.simhash import simhash_dedup
from forgeline.llm.suffix_dedup import suffix_dedup
from forgeline.session import materialize, release, scratch_tables

_before: list[DataFrame] = []      # tables of the stage that ran last


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised; those without a letter, or below the calibrated threshold, go."""
    model = langid.fit(docs.where(~langid.held_out()))
    rows = docs.select(F.struct("*").alias("src"), "text")
    return langid.predict(rows, model, "src").where("NOT rejected").select("src.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts."""
    return exact_dedup(docs).where("kept").select("src.*")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component."""
    return simhash_dedup(docs).where("kept").select("src.*")


# A passage that repeats is cut if it has over 50 words.  Repeats are searched by bytes, from a length that
# 51 words hardly stay under, and runs of fewer words are left alone.
PASSAGE_BYTES = 150
PASSAGE_WORDS = 51


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of over 50 words that occur elsewhere out of the texts (n_chars follows); no row goes, a text may become empty.

    A passage is a run of bytes covered by repeated strings of ``PASSAGE_BYTES``; all its occurrences
    go.  A null text stays null, the other columns come back unchanged.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(F.struct(*others).alias("src"), F.col("text").isNull().alias("no_text")).alias("row"), "text")
    cut = suffix_dedup(rows, "row", length=PASSAGE_BYTES, least_words=PASSAGE_WORDS, whole=True)
    changed = F.col("n_removed") > 0
    return cut.select(*[
        F.when(~F.col("id.no_text"), F.col("kept_text")).alias(c) if c == "text" else
        F.when(changed, F.char_length("kept_text").cast(docs.schema[c].dataType)).otherwise(F.col("id.src.n_chars")).alias(c) if c == "n_chars" else
        F.col(f"id.src.`{c}`").alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences: the rows of ``pack_documents``."""
    return pack_documents(docs)


def _stage(function: Callable) -> Callable:
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(*_before)
        _before.clear()
        with scratch_tables(_before):
            return function(spark, docs, sf_dir)
    call.__name__, call.__doc__ = function.__name__, function.__doc__
    return call


STAGES = [
    ("language_id", _stage(language_stage)),
    ("exact_dedup", _stage(exact_stage)),
    ("simhash_dedup", _stage(simhash_stage)),
    ("suffix_dedup", _stage(suffix_stage)),
    ("packing", _stage(packing_stage)),
]

# language ID and both token and suffix work have no SQL restatement; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "corpus-stage")
    return docs
