"""The stability monitor as a stream: state by template, alerts as rows, a queue as a sink."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.drift import queue
from weftline.operators.reason import STABLE

OUTPUT = "template string, seq long, page_url string, sigma double, running_mean double, alert boolean"


def monitored(values: DataFrame) -> DataFrame:
    """(template, seq, page_url, sigma, running_mean, alert) of a stream of (template, seq, page_url, sigma).

    State is a count and a sum for each template. Values of one micro-batch are taken in order of `seq`.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        rows = pd.concat([*frames]).sort_values("seq", kind="stable")
        counts = n + pd.Series(range(1, len(rows) + 1), index=rows.index)
        sums = total + rows["sigma"].cumsum()
        state.update((int(counts.iloc[-1]), float(sums.iloc[-1])))
        yield pd.DataFrame({"template": key[0], "seq": rows["seq"], "page_url": rows["page_url"], "sigma": rows["sigma"], "running_mean": sums / counts, "alert": rows["sigma"] < STABLE})

    return values.groupBy("template").applyInPandasWithState(update, OUTPUT, "n long, total double", "append", "NoTimeout")


def windowed(values: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, template, sigma, n) by event time, with a watermark; `ts` must be a timestamp."""
    grouped = values.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "template")
    return grouped.agg(F.avg("sigma").alias("sigma"), F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "template", "sigma", "n")


def enqueue(values: DataFrame, path: str, checkpoint: str, at: str | None = None):
    """Start a query that adds a relabelling request for each alert of the stream.

    Each micro-batch has a folder of its number, so one that is played again replaces what it wrote.
    """

    def keep(batch: DataFrame, number: int) -> None:
        queue(batch, at).write.mode("overwrite").json(f"{path}/batch={number}")

    return values.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
