"""The corpus pipeline: five stages over `documents`, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import linechunks, neardup, packing, quality, toxicity
from weftline.llm.common import collecting, durable, fresh, release, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = toxicity.scorer(model)(F.coalesce("text", F.lit("")))
    return docs.where(score < 0.5)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the quantile cut."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = quality.scorer(model)(F.coalesce("text", F.lit("")))["score"]
    return docs.where(score >= quality.CUT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the chunks of lines that stand elsewhere; texts of which nothing is left go."""
    done = linechunks.dedup(docs).where((F.size("removed") == 0) | (F.trim(F.col("text")) != ""))
    chars = F.when(F.size("removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id.

    Near copies share 0.8 of their five-word shingles; two words are the contract of op5 alone. Rows that
    repeat id and text are one document, of which one row stays; a document without an id is known by its
    text, and stays only where its group has no member with an id. Documents without a word have no copies.
    """
    key, twin, kept = fresh(docs, "__key", "__twin", "__kept")
    text = F.coalesce("text", F.lit(""))
    # ids of documents without one: the text's hash, above all real ids that a count could reach
    named = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 61))))
    found = neardup.find(named.select(key, "text"), percent=80, width=5, id_col=key)
    keys = durable(found.where("kept").groupBy(F.col("doc_id").alias(kept)).agg(F.count("*").alias(twin)), "kept")
    rows = named.join(keys, F.col(key) == F.col(kept), "left_semi").select(*docs.columns, key)
    # rows of a key that has several: one of each text
    several = keys.where(F.col(twin) > 1).select(kept)
    alone = rows.join(several, F.col(key) == F.col(kept), "left_anti")
    once = rows.join(several, F.col(key) == F.col(kept), "left_semi").dropDuplicates([key, "text"])
    return alone.unionByName(once).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence and offset of every piece of every document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: Classifiers and content-defined chunks can't be said in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the rows of the last one."""
    docs, before = table(spark, sf_dir, "documents"), []
    for i, (_, stage) in enumerate(STAGES):
        with collecting() as paths:
            docs = durable(stage(spark, docs, sf_dir), f"stage{i}")
        release(spark, before + paths[:-1])  # the stage's input, and what it wrote on its way
        before = paths[-1:]
    return docs
