"""The stability monitor in batch: history, running means, alerts, the relabelling queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.reason import STABLE

#: Values that a history file keeps.
KEPT = 1000
#: Fixed value: why a page is queued.
REASON = "DRIFT_DETECTED: σ below threshold (preliminary signal)."


def history(values: DataFrame, key: str | None = None) -> DataFrame:
    """`values` (seq, sigma) with the mean up to each, itself included, and the alert flag.

    One history is one sequence: it is as sequential as its definition. With `key` there is one for each
    key, which is what scales out.
    """
    w = (Window.partitionBy(key) if key else Window.partitionBy(F.lit(0))).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return values.withColumn("running_mean", F.avg("sigma").over(w)).withColumn("alert", F.col("sigma") < STABLE)


def tail(values: DataFrame, keep: int = KEPT) -> DataFrame:
    """The last `keep` values, as a history file holds them."""
    return values.orderBy(F.desc("seq")).limit(keep)


def queue(values: DataFrame, at: str | None = None) -> DataFrame:
    """One relabelling request for each alert; `at` is the clock, given for repeatable runs."""
    clock = F.lit(at) if at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return values.where(F.col("sigma") < STABLE).select("page_url", F.col("sigma").alias("stability_score"), F.lit(REASON).alias("reason"), clock.alias("timestamp_utc"))
