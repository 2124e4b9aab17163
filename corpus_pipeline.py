"""A training corpus from raw documents, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm import hyperminhash, mixing, packing, secrets, toxicity
from riffle.llm.common import scratch_table, table, unique_name
from riffle.llm.queries import CAP, CAPACITY, SHARE, WEIGHTS, tokenizer_path

#: Five-word shingles, similarity of 0.8 or more.
PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labels of the documents here.

    Every row is judged by its own text: null and empty ones stay, rows that
    repeat an id are judged one by one, very long ones as a whole; equal texts
    have equal scores, so ties go together.  An empty table stays empty;
    further columns, whatever their names, are handed through.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays.

    Rows are told apart by a number of their own, so null and repeated ids are
    compared like all others and no row goes for another row's sake.  The first
    row of a group in the table's order stays, ties included; texts without
    words are copies of nothing and stay; long texts are compared whole; an
    empty table stays empty; further columns are handed through.
    """
    (row,) = unique_name(docs, "copy_row")
    numbered = scratch_table(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    judged = scratch_table(hyperminhash.near_duplicates(numbered, PERCENT, id_col=row), "pipeline-copies")
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias(row))
    return numbered.join(gone, row, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to the name of their kind; ``n_chars`` follows.

    No row goes.  Null and empty texts stay as they are (``n_chars`` too where
    the text is null), rows that repeat an id or a text are cleaned alike, long
    texts whole; of overlapping secrets the earlier names the place.  An empty
    table stays empty; further columns are handed through.
    """
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                            .otherwise(F.length("text")).cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Each row counts by itself: rows that repeat an id, or have a null one, are
    documents of their own, ties broken by a hash.  A null source is a source,
    documents without words are taken as often as their place says, long texts
    count all their words.  An empty table stays empty; further columns are
    handed through.
    """
    return mixing.mixed_documents(docs, WEIGHTS, SHARE, CAP)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most CAPACITY tokens with their places in sequences.

    Null and empty texts are the end token alone, long ones are cut into
    pieces, rows that repeat an id are packed one by one; equal lengths are
    packed in any order.  An empty table gives no piece; other columns are not
    read.
    """
    return packing.pack_documents(docs, tokenizer_path(), CAPACITY)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("secrets", redact_secrets),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Models, sketches and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
