"""A training-data pipeline over ``documents``, built from the operators of ``marketlake.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages
the documents are written as Parquet and read again, so a lost executor costs at
most one stage.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marketlake.llm import lines, mixing, neardup, pieces, toxicity
from marketlake.llm.common import saved, table
from marketlake.llm.queries import PIECE_MODEL

TOXIC = 0.7
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, ``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC`` stay; the score is learnt from the labels that are not held out."""
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    return _columns(scored.where(F.col("score") < TOXIC))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 5 documents stay in the one with the largest id only."""
    return _columns(lines.drop_repeated_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8) stays: the one with the smallest id."""
    found = neardup.near_duplicates(docs, shingle_words=5, threshold=(80, 100))
    # where rows share an id, the id goes only if none of its rows is kept
    kept = found.groupBy(F.col("doc_id").alias("_id")).agg(F.max("kept").alias("_kept"))
    gone = kept.where(~F.col("_kept"))
    return _columns(docs.join(gone, F.col("doc_id") == F.col("_id"), "left_anti"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    units = docs.select(F.col("doc_id").alias("id"), "source", mixing.word_count().alias("size"))
    # rows with the same id are told apart by their place among them
    place = Window.partitionBy("id").orderBy("size", F.col("source").asc_nulls_last())
    ranked = mixing.mix(units).withColumn("_at", F.row_number().over(place))
    chosen = ranked.where(F.col("copies") > 0).select(F.col("id").alias("_id"), "_at", F.col("copies").alias("_copies"))
    own = Window.partitionBy("doc_id").orderBy(mixing.word_count(), F.col("source").asc_nulls_last())
    placed = docs.withColumn("_place", F.row_number().over(own))
    joined = placed.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_place") == F.col("_at")))
    return _columns(joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it."""
    found = pieces.add_pieces(docs, PIECE_MODEL)
    return found.select(
        "doc_id",
        "source",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

# Scores of a learnt model, balanced sampling and subword ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
