"""Corpus pipeline: toxicity, quality rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes its result as Parquet and reads it again for the next one.
All stages but the last return the columns of ``documents``.

Edge cases, for all stages: a null text is an empty one; null and repeated ids are
rows like all others (only the near-duplicate stage looks at them, to say which row
of a group stays); an empty table gives an empty table; further columns are carried
along, whatever their names (those of what a stage computes and those that begin
with an underscore stay the caller's own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import neardup, packing, quality, repeats, toxicity
from tidewatch.llm.scratch import Scratch


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _apart(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns in one, so that their names clash with none."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))


def _together(docs: DataFrame) -> list[F.Column]:
    return [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half; empty texts stay."""
    own = _apart(docs)
    scored = toxicity.score(own, toxicity.train(docs, _labels(spark, sf_dir)))
    return scored.where("predicted = 0").select(*_together(docs))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; empty texts, which have no words, go."""
    own = _apart(docs)
    return quality.judge(own, quality.train(docs, _labels(spark, sf_dir))).where("kept").select(*_together(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest id (rows without one come last), whatever ids repeat; empty texts are in no group."""
    scratch = Scratch(spark, "pipeline-rows")
    # numbers are written down, as a second computation could deal them otherwise
    own = _apart(docs)
    rows = scratch.keep(own.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = neardup.near_duplicates(rows, key="_row").select(F.col("doc_id").alias("_row"), "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("content"), "_row")
    groups = scratch.keep(groups.join(rows.select("_row", place.alias("place")), "_row"), "groups")
    first = groups.groupBy("component_id").agg(F.min("place").alias("place")).select("place._row")
    gone = groups.select("_row").join(first, "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select(*_together(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated passages cut from their texts, ``n_chars`` (where there is one) counted anew."""
    cut = repeats.remove_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece and its place."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near-duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("packing", pack_sequences),
]

#: Trained models and tokenizers are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
