"""A two-layer graph convolution over page graphs, and its linear, distributed twin for training.

Scoring groups a page's nodes and edges and runs in numpy; weights are a few thousand numbers. Training on
many pages propagates features twice in Spark and fits a weighted multinomial regression on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import features, graph

INPUT, HIDDEN, MIDDLE, CLASSES = 146, 64, 32, 3


@dataclass(frozen=True)
class Weights:
    """Two graph convolutions and a linear layer."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    w3: np.ndarray
    b3: np.ndarray

    @classmethod
    def random(cls, seed: int = 0) -> Weights:
        g = np.random.default_rng(seed)
        layer = lambda a, b: g.standard_normal((a, b)) * np.sqrt(2 / (a + b))
        return cls(layer(INPUT, HIDDEN), np.zeros(HIDDEN), layer(HIDDEN, MIDDLE), np.zeros(MIDDLE), layer(MIDDLE, CLASSES), np.zeros(CLASSES))

    def save(self, path: str) -> None:
        np.savez(path, **self.__dict__)

    @classmethod
    def load(cls, path: str) -> Weights | None:
        """None where there is no checkpoint: scores are then uniform."""
        try:
            with np.load(path) as z:
                return cls(**{k: z[k] for k in z})
        except FileNotFoundError:
            return None

    def probabilities(self, x: np.ndarray, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
        a = Adjacency(len(x), src, dst)
        h = np.maximum(a.times(x @ self.w1) + self.b1, 0)
        h = np.maximum(a.times(h @ self.w2) + self.b2, 0)
        return _softmax(h @ self.w3 + self.b3)


class Adjacency:
    """The normalised adjacency of a graph with one loop a node, as lists of edges: memory grows with these."""

    def __init__(self, n: int, src: np.ndarray, dst: np.ndarray):
        every = np.arange(n)
        pairs = np.unique(np.concatenate([dst, every]).astype(np.int64) * max(n, 1) + np.concatenate([src, every]))
        self.dst, self.src = pairs // max(n, 1), pairs % max(n, 1)
        degree = np.bincount(self.dst, minlength=n)
        self.weight = 1 / np.sqrt(degree[self.dst] * degree[self.src].astype(float))
        self.starts = np.searchsorted(self.dst, every)

    def times(self, h: np.ndarray) -> np.ndarray:
        return np.add.reduceat(h[self.src] * self.weight[:, None], self.starts, axis=0) if len(self.starts) else h

    def back(self, g: np.ndarray) -> np.ndarray:
        """The product with the transpose."""
        out = np.zeros_like(g)
        np.add.at(out, self.src, g[self.dst] * self.weight[:, None])
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit_network(pages: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], held: list[int], class_weights=(5.0, 5.0, 1.0), epochs: int = 100, rate: float = 1e-3, decay: float = 1e-4, seed: int = 42, every: int = 10) -> tuple[Weights, float]:
    """(weights, score): both graph layers trained on labelled pages (x, src, dst, class), a page a step.

    Adam on the class-weighted log loss. Every few epochs the pages numbered in `held`, which aren't
    learnt from, are scored by the mean recall of title and price; the best weights so far are kept. Pages
    labelled by hand are few, so they are on the driver; many pages are for `fit_linear`.
    """
    weights, cw = Weights.random(seed), np.array(class_weights)
    names = [f.name for f in fields(Weights)]
    value = {k: getattr(weights, k).copy() for k in names}
    first, second = ({k: np.zeros_like(v) for k, v in value.items()} for _ in range(2))
    graphs = [Adjacency(len(x), src, dst) for x, src, dst, _ in pages]
    best, best_score, t = weights, -1.0, 0
    for epoch in range(1, epochs + 1):
        for i, (x, _, _, y) in enumerate(pages):
            if i in held or not len(x):
                continue
            a, t = graphs[i], t + 1
            h1 = np.maximum(a.times(x @ value["w1"]) + value["b1"], 0)
            h2 = np.maximum(a.times(h1 @ value["w2"]) + value["b2"], 0)
            share = cw[y] / cw[y].sum()
            dz = _softmax(h2 @ value["w3"] + value["b3"])
            dz[np.arange(len(y)), y] -= 1
            dz *= share[:, None]
            d2 = (dz @ value["w3"].T) * (h2 > 0)
            m2 = a.back(d2)
            d1 = (m2 @ value["w2"].T) * (h1 > 0)
            grad = {"w3": h2.T @ dz, "b3": dz.sum(0), "w2": h1.T @ m2, "b2": d2.sum(0), "w1": x.T @ a.back(d1), "b1": d1.sum(0)}
            for k in names:
                g = grad[k] + decay * value[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                value[k] -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
        if epoch % every == 0 or epoch == epochs:
            now = Weights(**{k: v.copy() for k, v in value.items()})
            hits, support = np.zeros(CLASSES), np.zeros(CLASSES)
            for i in held:
                x, src, dst, y = pages[i]
                guess = now.probabilities(x, src, dst).argmax(axis=1)
                support += np.bincount(y, minlength=CLASSES)
                hits += np.bincount(y[guess == y], minlength=CLASSES)
            score = float((hits[:2] / np.maximum(support[:2], 1)).mean())
            if score > best_score:
                best, best_score = now, score
    return best, best_score


def score(vectors: DataFrame, edges: DataFrame, weights: Weights | None) -> DataFrame:
    """(page_id, node_idx, p_price, p_title, p_other); uniform without weights."""
    if weights is None:
        third = F.lit(1 / 3)
        return vectors.select("page_id", "node_idx", third.alias("p_price"), third.alias("p_title"), third.alias("p_other"))
    kind = dict(vectors.dtypes)["page_id"]
    # one row a page, whose size the layout bounds; many pages to an Arrow batch
    flat = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("node_idx", "features"))), lambda s: s["features"]))
    ids = F.array_sort(F.collect_list("node_idx"))
    pages = vectors.groupBy("page_id").agg(ids.alias("ids"), flat.alias("x"))
    ends = edges.groupBy(F.col("page_id").alias("e_page")).agg(F.collect_list("src").alias("src"), F.collect_list("dst").alias("dst"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {c: (batch.column(c).flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(c)).to_numpy())])) for c in ("ids", "x", "src", "dst")}
            cut = lambda c, i: lists[c][0][lists[c][1][i] : lists[c][1][i + 1]]
            out = []
            for i in range(batch.num_rows):
                own = cut("ids", i)
                out.append(weights.probabilities(cut("x", i).reshape(len(own), -1), np.searchsorted(own, cut("src", i)), np.searchsorted(own, cut("dst", i))))
            p = np.concatenate(out) if out else np.zeros((0, CLASSES))
            take = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(lists["ids"][1])), type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id").take(take), pa.array(lists["ids"][0]), *(pa.array(np.ascontiguousarray(p[:, k])) for k in range(CLASSES))], names=["page_id", "node_idx", "p_price", "p_title", "p_other"])

    both = pages.join(ends, F.col("page_id") == F.col("e_page")).select("page_id", "ids", "x", "src", "dst")
    return both.mapInArrow(run, f"page_id {kind}, node_idx int, p_price double, p_title double, p_other double")


def propagated(nodes: DataFrame, edges: DataFrame, steps: int = 2) -> DataFrame:
    """(page_id, node_idx, features) after `steps` of normalised message passing, set-based."""
    weights = graph.normalized(nodes, edges)
    long = features.vectors(nodes).select("page_id", "node_idx", F.posexplode("features").alias("dim", "value")).where("value <> 0")  # sparse
    for _ in range(steps):
        long = graph.propagate(long, weights)
    back = long.groupBy("page_id", "node_idx").agg(F.map_from_entries(F.collect_list(F.struct("dim", "value"))).alias("m"))
    return back.select("page_id", "node_idx", F.transform(F.sequence(F.lit(0), F.lit(INPUT - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("features"))


def fit_linear(nodes: DataFrame, edges: DataFrame, labels: DataFrame, weights=(5.0, 5.0, 1.0)):
    """A `pyspark.ml` model on propagated features; rare classes weigh more."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    by = F.element_at(F.array(*map(F.lit, weights)), F.col("label") + 1)
    rows = propagated(nodes, edges).join(labels, ["page_id", "node_idx"]).select("page_id", "node_idx", array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"), by.alias("weight"))
    return LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-4, maxIter=50).fit(rows), rows
