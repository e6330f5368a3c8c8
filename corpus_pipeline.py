"""A corpus pipeline of five of the operators, from ``documents`` to packed sequences.

Every stage takes the table its predecessor left and returns the columns of ``documents``,
the last one a row for each piece of a document in its bin. An empty table stays empty.
Documents without id go through every stage; a group of near-duplicates keeps one row,
that of its least id, also where ids are tied or missing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.llm import decontaminate, linededup, packing, simhash, toxicity
from lethe.llm.common import drop_paths, shelf, table
from lethe.llm.tokens import default_vocabulary
from lethe.scratch import scratch_path


#: Scratch tables of the stage that ran last: its result reads them until it is written, then they can go.
_left: list[str] = []


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Drop what the stage before has left, which is written by now, and note what this one leaves."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_paths(spark, _left)
        _left.clear()
        with shelf() as paths:
            result = function(spark, docs, sf_dir)
        _left.extend(paths)
        return result

    return run_stage


def _columns(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.select(*(F.col(f"`{name}`") for name in like.columns))


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` again the length of the text, which the stage before may have cut."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts are scored like others; a null id, ties and further columns change nothing."""
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"), keep_text=True)
    return _columns(scored.where("NOT toxic"), docs)


@_stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut out; a text of which nothing is left goes.

    A null or empty text has no lines and stays. Rows alike in id and text count as one document and all stay.
    """
    deduped = linededup.dedup(docs, min_words=linededup.MIN_WORDS)
    emptied = (F.col("n_deleted") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _measured(_columns(deduped.where(~emptied), docs))


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the least by id (none last), then by text. Texts without words are one group.

    Groups are those of SimHash fingerprints, as in ``op10_simhash``, joined where sets of 5-word shingles are similar at 0.8.
    """
    return simhash.keep_one(docs)


@_stage
def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; the document stays. Null texts stay null; further columns pass through."""
    return _measured(_columns(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")), docs))


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in its bin. A null text is empty; ties of ids are documents of their own."""
    return packing.run(docs, default_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]
#: A trained classifier and XXH64 are beyond SQL: the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
