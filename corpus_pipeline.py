"""The corpus pipeline: quality, repeated lines, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents the stage before has kept. All but the last return
the columns of `documents`. `run` writes every stage's result to the shared folder and reads it again.

Defined cases, in every stage: a null text is an empty one and, as long as the classifier keeps it, stays; a null id is
an id like any other, but the last choice among near copies; rows of one id with different texts are judged by their
texts; of rows with equal id and text the near-copy stage keeps one (of empty ones, all); texts of any length are read
whole; empty tables give empty tables; further columns go through unchanged, whatever their names (lower-case letters
as in `doc_id`, `text` and `n_chars` are the documents' own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letbook.llm import linedup, neardup, packing, quality, winnow
from letbook.llm.frames import keep, table

#: Documents below this quality go.
QUALITY = 0.3


def _free(name: str, docs: DataFrame) -> str:
    """The name, or a longer one that no column of the documents has."""
    while name in docs.columns:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labeller rejects go."""
    chain = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    name = _free("quality score", docs)
    return quality.score(docs, chain, *docs.columns, name=name).where(F.col(f"`{name}`") >= QUALITY).drop(name)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines seen before go; a document of which nothing but white space is left goes with them."""
    name = _free("removed lines", docs)
    done = linedup.deduplicate(docs, removed=name)
    removed = F.col(f"`{name}`")
    left = removed.isNull() | F.col("text").rlike(r"\S")
    changed = F.when(removed.isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return done.where(left).withColumn("n_chars", changed).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity 0.8."""
    return neardup.without_near_duplicates(docs, size=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    found = winnow.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    gone = found.select(F.col("doc_id").alias("gone id"), F.col("name").alias("gone name"))
    same = F.col("doc_id").eqNullSafe(F.col("gone id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("gone name"))
    return docs.join(gone, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=0)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The fitted classifier, the tokenizer and connected groups are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
