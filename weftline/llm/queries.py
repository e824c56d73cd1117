"""The opN_ queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import ann, bpe, flac, kdshards, linechunks, neardup, oracles, packing, quality, toxicity, urltree
from weftline.llm.common import held_out, read_in_small_batches, table


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest neighbours of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, their offsets and what they decode to, as digests."""
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), offsets=True))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of every document."""
    read_in_small_batches(spark)
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return neardup.find(table(spark, sf_dir, "documents"))


def op6_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    evidence = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("document"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return urltree.judge(table(spark, sf_dir, "pages"), evidence)


def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    done = kdshards.shard(table(spark, sf_dir, "documents"), 40)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as FLAC and read back, as digests; the last one is of the sample offsets of its blocks."""
    read_in_small_batches(spark)
    done = flac.round_trip(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes",
        F.octet_length("pcm").cast("long").alias("payload_bytes"),
        F.sha2("pcm", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(pcm, -16)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        F.sha2(F.array_join(F.col("offsets").cast("array<string>"), " "), 256).alias("offsets_sha256"),
    )


def op9_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the chunks and runs of lines that stand elsewhere; lines of several count once."""
    done = linechunks.dedup(table(spark, sf_dir, "documents"))
    # ranges are in order, so a line counts where it is beyond all ranges before
    gone = F.aggregate("removed", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda x, s: F.struct((x["n"] + F.greatest(s["b"] - F.greatest(s["a"], x["to"]), F.lit(0))).alias("n"), F.greatest(s["b"], x["to"]).alias("to")), lambda x: x["n"])
    return done.select("doc_id", "text", F.size("removed").alias("removed_chunks"), gone.alias("removed_lines"))


def op10_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"), "preference")


QUERIES = {f.__name__: f for f in (
    op1_adaptive_scan, op2_byte_bpe, op3_best_fit_packing, op4_toxicity, op5_hyperminhash, op6_path_templates,
    op7_kd_shards, op8_flac, op9_line_chunks, op10_bradley_terry,
)}
ORACLES = oracles.ORACLES
