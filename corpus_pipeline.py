"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which
:func:`run` writes as Parquet and reads back as the next stage's ``docs``.  All
but the last return the columns of ``docs``; the last returns pieces of
sequences.  Nulls in any column, empty texts, repeated rows and further columns
pass through as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsift.llm import jaccard_join, line_dedup, mixing, packing, quality_fm
from chatsift.llm.queries import tokenizer_file, training_labels
from chatsift.session import read_table, work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the factorisation machine scores below 0.5."""
    model = quality_fm.train(docs, training_labels(read_table(spark, sf_dir, "labels")))
    return quality_fm.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes recurring lines out of all documents but the first that holds them.

    A document that loses every line with a word goes; one that had none stays.
    """
    words = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0
    had = "_had_words"
    while had in docs.columns:
        had = "_" + had
    out = line_dedup.dedup_lines(docs.withColumn(had, words))
    return out.where(words | ~F.col(had)).drop(had)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_texts(docs, tokenizer_file)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram jaccard join", near_duplicates),
          ("mixing sources", mix), ("packing", pack)]

#: The classifier and the tokenizer cannot be expressed in SQL.  The tests hold run() against its stages called one by
#: one, and the operators against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
