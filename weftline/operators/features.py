"""Node features: hashed character n-grams, geometry and tag, 146 numbers in all."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import strip

#: Known tags in the order of their places; other tags take the place after the last.
TAGS = ("div", "span", "a", "img", "p", "h1", "h2", "li", "ul", "table", "form", "input", "button")
#: Buckets of the text hash, and the page that geometry is measured by.
BUCKETS = 128
#: Characters hashed at once.
STRETCH = 1 << 20
WIDTH, HEIGHT = 1200.0, 2400.0


def text_buckets(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, bucket, n): how many 2- and 3-grams of the lower-cased, stripped text fall into each bucket.

    A gram's hash is h * 31 + code point from left to right; the bucket is that modulo 128, and since
    128 divides the word size of the hash, the sum can be reduced at once.
    """
    counted = rows.select(F.col(key), F.posexplode(F.pandas_udf(_histograms, "array<long>")(_cleaned(text))).alias("bucket", "n")).where("n > 0")
    return counted.groupBy(key, "bucket").agg(F.sum("n").alias("n"))


def _cleaned(text: str) -> Column:
    return strip(F.lower(F.coalesce(F.col(text), F.lit(""))))


def _buckets(text: str) -> np.ndarray:
    """How many 2- and 3-grams fall into each bucket, a stretch of the text at a time."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(0, len(text) - 1), STRETCH):
        c = np.frombuffer(text[at : at + STRETCH + 2].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        two = c[:-1] * 31 + c[1:]
        total += np.bincount(two[:STRETCH] % BUCKETS, minlength=BUCKETS)
        total += np.bincount((two[:-1] * 31 + c[2:])[:STRETCH] % BUCKETS, minlength=BUCKETS)
    return total


def _histograms(texts: pd.Series) -> pd.Series:
    return pd.Series([_buckets(t) for t in texts], dtype=object)


def _unit(texts: pd.Series) -> pd.Series:
    """Histograms of norm 1, all zero for texts without a gram."""
    found = [_buckets(t).astype(float) for t in texts]
    return pd.Series([v / (np.linalg.norm(v) or 1.0) for v in found], dtype=object)


def with_text_vector(rows: DataFrame, text: str = "text") -> DataFrame:
    """`rows` with `text_vector`: the 128 bucket counts scaled to norm 1, all zero for blank text."""
    return rows.withColumn("text_vector", F.pandas_udf(_unit, "array<double>")(_cleaned(text)))


def visual() -> Column:
    """Box by the reference page; a box with a missing side is all zero."""
    whole = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("w").isNotNull() & F.col("h").isNotNull()
    side = lambda c, by: F.when(whole, F.col(c) / by).otherwise(0.0)
    return F.array(side("x", WIDTH), side("y", HEIGHT), side("w", WIDTH), side("h", HEIGHT))


def tag_place(tag: Column) -> Column:
    """Place of the tag, 13 for unknown ones."""
    at = F.array_position(F.array(*map(F.lit, TAGS)), F.lower(F.coalesce(tag, F.lit(""))))
    return F.when(at > 0, (at - 1).cast("int")).otherwise(len(TAGS))


def tag_onehot(tag: Column) -> Column:
    place = tag_place(tag)
    return F.transform(F.sequence(F.lit(0), F.lit(len(TAGS))), lambda i: F.when(i == place, 1.0).otherwise(0.0))


def vectors(nodes: DataFrame) -> DataFrame:
    """(page_id, node_idx, features): text, geometry and tag side by side."""
    rows = with_text_vector(nodes.select("page_id", "node_idx", "text", "tag", "x", "y", "w", "h"))
    return rows.select("page_id", "node_idx", F.concat("text_vector", visual(), tag_onehot(F.col("tag"))).alias("features"))
