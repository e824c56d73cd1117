"""Accuracy, violations, labels and splits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import matches, price_format

#: Class of a label; others count as `other`.
LABELS = {"price": 0, "title": 1, "other": 2, "none": 2}
#: The fixed footer line of the evaluators, in pixels.
FOOTER_LINE = 0.8 * 1080


def class_of(label: Column) -> Column:
    out = F.lit(2)
    for name, k in LABELS.items():
        out = F.when(label == name, k).otherwise(out)
    return out


def judge(expected: DataFrame, got: DataFrame, title: int = 8, price: int = 8) -> DataFrame:
    """(page_id, title_ok, price_ok, both_ok, violations) for expected and extracted titles and prices.

    `got` has title, price and the y of each; a violation is a node below the footer line or a price
    without the strict format. Pages that were extracted but not labelled don't appear.
    """
    e = expected.select("page_id", F.col("title").alias("want_title"), F.col("price").alias("want_price"))
    both = e.join(got, "page_id", "left")
    t, p = matches(F.col("want_title"), F.col("title"), title), matches(F.col("want_price"), F.col("price"), price)
    below = lambda c: F.coalesce(F.col(c) > FOOTER_LINE, F.lit(False)).cast("int")
    odd = (F.col("price").isNotNull() & ~price_format(F.col("price"))).cast("int")
    return both.select("page_id", t.alias("title_ok"), p.alias("price_ok"), (t & p).alias("both_ok"), (below("title_y") + below("price_y") + odd).alias("violations"))


def metrics(judged: DataFrame, pages: int | None = None) -> DataFrame:
    """(title_ok, price_ok, both_ok, violations, pages): counts; the denominator is all test pages."""
    n = F.count("*") if pages is None else F.lit(pages).cast("long")
    return judged.agg(F.count_if(F.col("title_ok")).alias("title_ok"), F.count_if(F.col("price_ok")).alias("price_ok"), F.count_if(F.col("both_ok")).alias("both_ok"), F.sum("violations").cast("long").alias("violations"), n.alias("pages"))


def recalls(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    """(class, support, hits, recall): per class; recall is 0 without support."""
    return rows.groupBy(F.col(truth).alias("class")).agg(F.count("*").alias("support"), F.count_if(F.col(truth) == F.col(guess)).alias("hits")).withColumn("recall", F.coalesce(F.try_divide(F.col("hits").cast("double"), "support"), F.lit(0.0)))


def first_predicted(nodes: DataFrame, predicted: str = "predicted") -> DataFrame:
    """(page_id, title_ok, price_ok, both_ok) of a classifier alone, without priors or constraints.

    A page's title and price are its first nodes of that class (of `predicted`, as LABELS numbers them);
    they hold if they contain the first 15 or 6 characters of the labelled one. Pages without a label for a
    field don't hold it.
    """
    first = lambda ok: F.coalesce(F.min(F.when(ok, F.struct("node_idx", "text")))["text"], F.lit(""))
    found = nodes.groupBy("page_id").agg(*(first(F.col(predicted) == LABELS[k]).alias(f"got_{k}") for k in ("title", "price")), *(first(F.col("label") == k).alias(f"want_{k}") for k in ("title", "price")))
    t = matches(F.col("want_title"), F.col("got_title"), 15, drop_currency=False)
    p = matches(F.col("want_price"), F.col("got_price"), 6, lower=False, drop_currency=False)
    return found.select("page_id", t.alias("title_ok"), p.alias("price_ok"), (t & p).alias("both_ok"))


def label_counts(nodes: DataFrame) -> DataFrame:
    """(page_id, titles, prices, others, saveable): a page is saved with one title and one price."""
    counted = nodes.groupBy("page_id").agg(F.count_if(F.col("label") == "title").alias("titles"), F.count_if(F.col("label") == "price").alias("prices"), F.count_if(~F.col("label").isin("title", "price")).alias("others"))
    return counted.withColumn("saveable", (F.col("titles") == 1) & (F.col("prices") == 1))


def progress(pages: DataFrame, goal: int = 50) -> DataFrame:
    """(pages, progress): how many pages are labelled, and the share of the goal, 1 at most."""
    return pages.agg(F.countDistinct("page_id").alias("pages")).withColumn("progress", F.least(F.col("pages") / goal, F.lit(1.0)))


def with_labels(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes with the label they were given (page_id, id, label), `other` without one."""
    known = labels.select(F.col("page_id").alias("l_page"), F.col("id").alias("l_id"), "label")
    return nodes.join(known, (F.col("page_id") == F.col("l_page")) & (F.col("id") == F.col("l_id")), "left").drop("l_page", "l_id").withColumn("label", F.coalesce("label", F.lit("other")))


def visible(nodes: DataFrame, search: str = "") -> DataFrame:
    """Nodes that a labeller is shown: two characters at least, with the search text, cut for display."""
    text = F.coalesce("text", F.lit(""))
    return nodes.where((F.char_length(F.trim(text)) >= 2) & F.lower(text).contains(search.lower())).withColumn("shown", F.substring(text, 1, 130))


def protocol_split(spark: SparkSession, pages: int, train: int = 40, valid: int = 11, test: int = 30, seed: int = 42) -> DataFrame:
    """(position, part) of the evaluation protocol; needs at least train + valid + test pages."""
    if pages < train + valid + test:
        raise ValueError(f"the protocol needs {train + valid + test} pages")
    order = np.arange(pages)
    np.random.default_rng(seed).shuffle(order)
    parts = [*["train"] * train, *["valid"] * valid, *["test"] * test]
    return spark.createDataFrame([(int(i), p) for i, p in zip(order, parts)], "position int, part string")


def page_split(spark: SparkSession, pages: int, share: float = 0.2, seed: int = 42) -> DataFrame:
    """(position, part): the first ceil(share * n) of a seeded permutation are the test part."""
    order = np.random.RandomState(seed).permutation(pages)
    cut = int(np.ceil(share * pages))
    return spark.createDataFrame([(int(p), "test" if i < cut else "train") for i, p in enumerate(order)], "position int, part string")
