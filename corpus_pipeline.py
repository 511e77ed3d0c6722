"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes what its predecessor kept.  All but the last return the columns of documents;
the last returns the pieces of the packed sequences.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.llm import decontamination, near_duplicates, packing, quality_model, toxicity
from tripstats.llm.common import stored, table

LEAST_QUALITY = 0.3

_ROW = "_row_number"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the limit."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade(docs, model).where(~F.col("toxic")).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches LEAST_QUALITY."""
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs, model, column="_score")
    return scored.where(F.col("_score") >= LEAST_QUALITY).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, 0.8 or more.

    Every row is decided by its own text, also if its id is null or repeated: of rows that
    repeat one stays, and texts without words have no copies.
    """
    rows = _numbered(docs)
    found = near_duplicates.near_duplicates(
        rows, near_duplicates.Settings(words=5, percent=80), doc_id=_ROW
    )
    copies = found.where(~F.col("kept")).select(F.col("doc_id").alias(_ROW))
    return rows.join(copies, _ROW, "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Every row is decided by its own text."""
    rows = _numbered(docs)
    found = decontamination.leaks(rows, table(spark, sf_dir, "benchmark"), doc_id=_ROW)
    return decontamination.clean(rows, found, doc_id=_ROW).select(*docs.columns)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own, stored, so that it stays theirs."""
    return stored(docs.withColumn(_ROW, F.monotonically_increasing_id()), "rows")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

# Models, MinHash and packing have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
