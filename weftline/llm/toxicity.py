"""Toxicity: a counterfactual-regularised linear classifier over words and word beginnings.

Training takes a bounded, labelled sample. Where a sampled text names a group of people, its
counterfactual swaps every identity term for another one of the same list; the loss adds the squared
change of the logit, so that the mention itself carries no weight. An L1 term leaves a small table of
weights, which is all that scoring needs. The minimum is found to a tolerance on its gradient.
"""

from __future__ import annotations

import copy
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import SAMPLE_PER_CLASS, handed_back, labelled_sample, slices
from weftline.llm.linear import Rows, sparse

#: Terms for groups of people that are swapped for one another within a list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("old", "young", "disabled", "deaf", "blind"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christen", "muslime", "juden", "hindus"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "hindous"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("cristianos", "musulmanes", "judíos", "hindúes"),
)
WORD = re.compile(r"\w+")
#: A word's beginnings of these lengths are features, which reaches inflected forms.
BEGINNINGS = (3, 4, 5)
#: Features are hashed to so many places.
PLACES = 1 << 20


def _swap_table() -> dict[str, str]:
    return {w: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, w in enumerate(group)}


def words_of(text: str) -> set[str]:
    """The distinct lower-case words of the whole text."""
    return set(WORD.findall(text.lower()))


def places_of(word: str) -> list[int]:
    """Hashed features of one word: itself and its beginnings."""
    parts = ["=" + word, *("^" + word[:n] for n in BEGINNINGS if len(word) > n)]
    return [zlib.crc32(p.encode()) % PLACES for p in parts]


def features(text: str, swapped: bool = False) -> list[int]:
    """Places of all features of the text, or of its counterfactual, sorted."""
    words = words_of(text)
    if swapped:
        table = _swap_table()
        words = {table.get(w, w) for w in words}
    return sorted({p for w in words for p in places_of(w)})


@dataclass(frozen=True)
class Model:
    """Weights by place; a score is the logistic of `bias` plus the weights of the places present."""

    weights: dict[int, float]
    bias: float

    def logit(self, places) -> float:
        known = self.weights
        return self.bias + sum(known[p] for p in places if p in known)


def _rows(lists: list[np.ndarray], places: np.ndarray) -> Rows:
    """The binary matrix of `lists` whose columns are the sorted `places`; others are left out."""
    flat = np.concatenate([np.zeros(0, np.int32), *lists])
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    cols = np.searchsorted(places, flat)
    known = (cols < len(places)) & (places[np.minimum(cols, len(places) - 1)] == flat) if len(places) else np.zeros(len(flat), bool)
    return Rows(np.bincount(row[known], minlength=len(lists)), cols[known], None, len(places))


#: Weights of the terms of the loss.
L1, L2, COUNTERFACTUAL = 3e-4, 5e-3, 1.0


class Loss:
    """Class-balanced logistic loss + l2/2 |w|^2 + counterfactual * mean of (w.x - w.x')^2, and its bounds.

    The last coordinate is the bias, which no term but the first holds.
    """

    def __init__(self, sample: list[tuple[np.ndarray, np.ndarray | None, int]], places: np.ndarray, l2: float, counterfactual: float):
        self.y = np.array([s[2] for s in sample], dtype=float)
        self.x = _rows([np.asarray(s[0], dtype=np.int32) for s in sample], places)
        pairs = [(np.setdiff1d(s[0], s[1]), np.setdiff1d(s[1], s[0])) for s in sample if s[1] is not None]
        self.gone = _rows([np.asarray(a, dtype=np.int32) for a, _ in pairs], places)
        self.new = _rows([np.asarray(b, dtype=np.int32) for _, b in pairs], places)
        self.balance = np.where(self.y == 1, 0.5 / self.y.sum(), 0.5 / (1 - self.y).sum())
        self.l2, self.pull, self.width = l2, 2 * counterfactual / max(1, len(pairs)), len(places)

    def restrict(self, columns: np.ndarray) -> Loss:
        """The loss of these columns and the bias only."""
        out = copy.copy(self)
        out.x, out.gone, out.new, out.width = (*(m.restrict(columns) for m in (self.x, self.gone, self.new)), len(columns))
        return out

    def change(self, w: np.ndarray) -> np.ndarray:
        """By how much each counterfactual moves its text's logit."""
        return self.gone.times(w) - self.new.times(w)

    def value(self, wb: np.ndarray) -> float:
        w, z = wb[:-1], self.x.times(wb[:-1]) + wb[-1]
        return float((self.balance * (np.logaddexp(0, z) - self.y * z)).sum() + self.l2 / 2 * (w @ w) + self.pull / 2 * (self.change(w) ** 2).sum())

    def _gather(self, w: np.ndarray, by_row: np.ndarray) -> np.ndarray:
        pull = self.change(w) * self.pull
        return np.append(self.x.back(by_row) + self.l2 * w + self.gone.back(pull) - self.new.back(pull), by_row.sum())

    def gradient(self, wb: np.ndarray) -> np.ndarray:
        z = self.x.times(wb[:-1]) + wb[-1]
        return self._gather(wb[:-1], self.balance * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - self.y))

    def curvature(self, v: np.ndarray) -> np.ndarray:
        """The second derivative with the logistic's slope at its largest, a quarter, times `v`."""
        return self._gather(v[:-1], 0.25 * self.balance * (self.x.times(v[:-1]) + v[-1]))

    def diagonal(self) -> np.ndarray:
        both = np.full(self.gone.height, self.pull)
        return np.append(0.25 * self.x.back(self.balance) + self.l2 + self.gone.back(both) + self.new.back(both), 0.25)


def fit(sample: list[tuple[np.ndarray, np.ndarray | None, int]], l1: float = L1, l2: float = L2, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fit on (places, places of the counterfactual or None, label): the minimum of Loss plus l1 |w|_1.

    With one class only, or no row, the score is that class's smoothed share.
    """
    y = np.array([s[2] for s in sample], dtype=float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model({}, float(np.log(share / (1 - share))))
    places, seen = np.unique(np.concatenate([np.asarray(s[0], dtype=np.int32) for s in sample]), return_counts=True)
    places = places[seen >= 2]  # a feature of one row only can't generalise
    loss = Loss(sample, places, l2, counterfactual)
    wb = sparse(loss, l1)
    w = wb[:-1]
    b = wb[-1] + _centre(loss.x.times(w) + wb[-1], y)
    return Model({int(places[i]): float(w[i]) for i in np.flatnonzero(w)}, float(b))


def _centre(z: np.ndarray, y: np.ndarray) -> float:
    """The shift that puts the logit of the best-separating threshold at 0."""
    order = np.argsort(z, kind="stable")
    zs, ys = z[order], y[order]
    below = np.cumsum(ys) / ys.sum()
    clean = np.cumsum(1 - ys) / (1 - ys).sum()
    good = clean - below
    good[np.append(zs[1:] == zs[:-1], False)] = -np.inf  # no threshold within a tie
    at = int(np.argmax(good))
    above = zs[at + 1] if at + 1 < len(zs) else zs[at] + 1
    return -float((zs[at] + above) / 2)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn `labels.toxic` from at most `per_class` rows of each class outside the held-out fold.

    Features are computed where the texts are; the driver gets the sample's hashed places only, which the
    sample's bound of rows and bytes bounds. Null texts are empty; without labels, or with labels of one
    class, the model is a constant; how often an id is repeated doesn't matter.
    """
    terms = {w for group in IDENTITY_TERMS for w in group}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own, other = [], []
            for text in batch.column(1).to_pylist():
                own.append(features(text))
                other.append(features(text, swapped=True) if words_of(text) & terms else None)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, type=kind), pa.array(other, type=kind), batch.column(2)], names=["doc_id", "own", "other", "y"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = labelled_sample(docs, labels, "toxic", per_class).select("doc_id", "text", "y").mapInArrow(run, f"doc_id {kind}, own array<int>, other array<int>, y int").toArrow()
    rows = rows.sort_by([("y", "ascending"), ("doc_id", "ascending")]).combine_chunks()  # the sums don't depend on the order of tasks
    return fit([(own, other, y) for own, other, y in zip(_lists(rows["own"]), _lists(rows["other"]), rows["y"].to_pylist(), strict=True)])


def _lists(column: pa.ChunkedArray) -> Iterator[np.ndarray | None]:
    """The lists of a column as views of its values."""
    for chunk in column.chunks:
        values, at, known = chunk.values.to_numpy(), chunk.offsets.to_numpy(), chunk.is_valid().to_numpy(zero_copy_only=False)
        for a, b, ok in zip(at, at[1:], known):
            yield values[a:b] if ok else None


def scorer(model: Model):
    """A vectorised function from whole texts to scores from 0 to 1."""
    weights, bias = model.weights, model.bias

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[int, ...]] = {}
        for texts in handed_back(batches):
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                found: set[int] = set()
                for w in words_of(text):
                    hit = known.get(w)
                    if hit is None:
                        hit = tuple(p for p in places_of(w) if p in weights)
                        if len(known) < 100_000:  # bounded: words beyond are looked up each time
                            known[w] = hit
                    if hit:
                        found.update(hit)
                out[i] = bias + sum(sorted(weights[p] for p in found))
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -40, 40))))

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the whole text, null as empty; rows stay one to one.

    Labels, language, source and id are no inputs, so repeated texts tie exactly. Columns of other names
    are left behind.
    """
    return docs.select(F.col(id_col).alias("doc_id"), scorer(model)(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))
