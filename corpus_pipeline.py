"""A training corpus out of the documents: language identification, line dedup, SimHash
near-dedup, mixing to target weights, packing. Each stage works on what the one before it
kept; all but the last return the columns of ``documents``.

Null texts and texts without a letter have no language and go in the first stage. Nulls in
the other columns, repeated rows and further columns pass through the stages as their
operators say. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.llm.common import table, written
from fleetwarden.llm.langid import keep_identified
from fleetwarden.llm.line_dedup import dedup_lines
from fleetwarden.llm.mixing import take_mix
from fleetwarden.llm.packing import pack_documents
from fleetwarden.llm.simhash import drop_near_copies
from fleetwarden.session import clear_scratch, scratch_folders


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the table's own labels."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat elsewhere; ``n_chars`` follows the text. A
    document of which nothing but blanks is left goes; one that was blank before stays."""
    cut = dedup_lines(docs)
    left = cut.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs, shingle_words=3, max_distance=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, none to twice."""
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return pack_documents(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: Learned centroids, fingerprints and a tokenizer are beyond SQL; tests/llm holds run()
#: against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage by stage, each written and read again. What a stage wrote on its way, and the
    stage before it, is deleted once its own rows are written."""
    docs = table(spark, sf_dir, "documents")
    begun = scratch_folders(spark)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        clear_scratch(spark, keep=(f"{name}-",), but=begun)
    return docs
