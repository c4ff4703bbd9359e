"""Corpus pipeline: the stages that turn ``documents`` into packed training sequences.

Each stage works on all rows that the one before kept:

1. toxicity: documents that the trained model calls toxic go;
2. exact dedup: of equal texts one row stays;
3. Jaccard join: of every component of near copies the row with the least doc_id stays;
4. decontamination: documents that hold a benchmark window go;
5. packing: the rest in sequences of 2048 tokens, one row per piece.

The filters return the columns of ``documents``.  A row that repeats a doc_id
is a document of its own; where a decision names a doc_id, rows are told
apart by a hash of their text, and of wholly repeated rows one stays after
the exact stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from groundstop.llm import count_rtree, curve_pack, fuse_dedup, toxicity, winnow
from groundstop.llm.queries import BYTE_BPE
from groundstop.session import remove_scratch, scratch_path, scratch_scope

#: Scores of a trained model cannot be written in SQL.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts."""
    return fuse_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of near copies: that with the least doc_id."""
    return count_rtree.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return winnow.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return curve_pack.pack(docs, BYTE_BPE, end_id=1)


#: (name, function) in order; each function takes (spark, docs, sf_dir).
STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and read again as the next stage's input.

    What a stage stored on its way, and its input, go when its result is complete.
    """
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_scratch(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
