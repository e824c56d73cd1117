"""Quality: Bradley-Terry scores learnt from preference pairs, cut at a quantile of the scores.

Each pair holds a text labelled good and one labelled bad; P(good preferred) is the logistic of the
difference of their scores, and a score is linear in the text's features: figures of the whole text with
hinges, its hashed words and its hashed character trigrams. The cut is the quantile of the labelled texts'
scores that separates best; a monotone logistic map puts it at a fixed probability.
"""

from __future__ import annotations

import functools
import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import durable, handed_back, held_out, slices
from weftline.llm.linear import Rows, proximal

#: What the quantile cut maps to.
CUT = 0.3
#: Where the cut lies in the range of equally good quantiles: nearer to the bad texts, as good ones vary more.
LEAN = 0.25
#: Preference pairs in a block, or the rows of its larger class if these are more.
PAIRS = 60_000
#: Rows of the larger class in a block, about, entries of hashed features of all rows in one, and rows of
#: the smaller class at least, if there are so many.
BLOCK_ROWS, BLOCK_ENTRIES, LEAST_ROWS = 8000, 6_000_000, 1000
#: Shares of good texts below the knots, quantiles among which the cut is sought, and the accuracy of quantiles.
BENDS, GRID, ACCURACY = (0.05, 0.5, 0.95), 401, 10_000
#: Places of hashed words and of hashed character trigrams.
GRAM_BITS = 11
WORD_PLACES, GRAM_PLACES = 1 << 14, 1 << GRAM_BITS
#: Penalties on the weights of figures and of hashed features.
FIGURE_L2, HASHED_L2 = 1e-4, 2e-2
#: Characters of a text hashed at once.
CHUNK = 1 << 16

_LETTERS = re.compile(r"[^\W\d_]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKS = re.compile(r"[^\w\s]")
_ODD = re.compile(r"[^\w\s.,;:'\"()?-]")
_DIGITS = re.compile(r"\d")
_ENDS = re.compile(r"[.?](?=\s|$)")

@functools.cache
def _classes() -> np.ndarray:
    """For each code point a bit for each of letters, capitals, marks, odd ones and digits."""
    points = [i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    every, at = "".join(map(chr, points)), np.array(points)
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for bit, kind in enumerate((_LETTERS, _UPPER, _MARKS, _ODD, _DIGITS)):
        out[at[np.fromiter((m.start() for m in kind.finditer(every)), np.int64)]] |= 1 << bit
    return out


def _counts(text: str) -> list[int]:
    """How many letters, capitals, marks, odd characters and digits the whole text has."""
    total = np.zeros(32, dtype=np.int64)
    for at in range(0, len(text), CHUNK):
        points = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        total += np.bincount(_classes()[points], minlength=32)
    return [int(total[_HAS[bit]].sum()) for bit in range(5)]


#: The combinations of classes that have each of them.
_HAS = [[k for k in range(32) if k >> bit & 1] for bit in range(5)]

NAMES = (
    "log_words", "word_length", "distinct", "top_share", "stutter", "upper", "marks", "odd", "odd_words",
    "digits", "shouted", "sentence_words", "bare_lines", "long_words", "line_repeats", "short_words",
)


def features(text: str) -> list[float]:
    """Sixteen figures of the whole text, in the order of NAMES; all zero for one without words."""
    words = text.split()
    return _figures(text, words, Counter(words))


def _figures(text: str, words: list[str], counts: Counter) -> list[float]:
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    chars = max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    letters, capitals, marks, odd, digits = _counts(text)
    sizes = [len(w) for w in words]
    # a word or two come again in any short text: only what is beyond counts
    stutter = max(0, sum(map(str.__eq__, words, words[1:])) - 1) / n
    return [
        math.log1p(n),
        sum(sizes) / n,
        len(counts) / n ** 0.8,
        max(0, max(counts.values()) - 2) / n,
        stutter,
        capitals / (letters or 1),
        marks / chars,
        odd / chars,
        sum(1 for w in words if not w[-1].isalnum() and _ODD.match(w[-1])) / n,
        digits / chars,
        sum(1 for w in words if len(w) > 1 and w.isupper()) / n,
        min(60.0, n / (1 + len(_ENDS.findall(text)))),
        sum(1 for x in lines if x.rstrip()[-1] not in ".?!:\"')") / len(lines),
        sum(1 for s in sizes if s > 14) / n,
        1 - len(set(lines)) / len(lines),
        sum(1 for s in sizes if s < 4) / n,
    ]


class _Places(dict):
    """The place of each word, kept for a bounded number of them."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        place = self[word] = zlib.crc32(word.encode()) % WORD_PLACES
        return place


def _grams(text: str) -> np.ndarray:
    """How many character trigrams of the whole text fall into each place."""
    total = np.zeros(GRAM_PLACES, dtype=np.int64)
    for at in range(0, max(0, len(text) - 2), CHUNK):
        c = np.frombuffer(text[at : at + CHUNK + 2].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        h = (c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA6B) + c[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(32 - GRAM_BITS)
        total += np.bincount(h, minlength=GRAM_PLACES)
    return total


def hashed(text: str, counts: Counter, known: _Places) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): words as the logarithm of their counts, trigrams as the root of their share.

    Words come first, then trigrams; either part has norm one unless it is empty.
    """
    at = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
    words = np.bincount(at, np.log1p(np.fromiter(counts.values(), float, len(counts)))) if len(at) else np.zeros(0)
    place = np.flatnonzero(words)
    value = words[place] / (np.linalg.norm(words) or 1.0)
    grams = _grams(text)
    gram = np.flatnonzero(grams)
    return np.concatenate([place, WORD_PLACES + gram]).astype(np.int32), np.concatenate([value, np.sqrt(grams[gram] / max(1, grams.sum()))])


def evidence(texts) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Figures and hashed features of some texts."""
    figures, sparse, known = [], [], _Places()
    for text in texts:
        words = text.split()
        counts = Counter(words)
        figures.append(_figures(text, words, counts))
        sparse.append(hashed(text, counts, known))
    return np.array(figures, dtype=float).reshape(len(figures), len(NAMES)), sparse


@dataclass(frozen=True)
class Model:
    """score = logistic(slope * (weights . expanded figures + hashed weights . hashed features - cut) + logit(CUT))."""

    knots: np.ndarray  # (figures, knots per figure): where the hinges bend
    scale: np.ndarray
    weights: np.ndarray
    hashed: np.ndarray  # a weight for each place of words and trigrams
    cut: float
    slope: float

    def preference(self, figures: np.ndarray, sparse: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Bradley-Terry scores of rows of evidence."""
        more = [float(self.hashed[place] @ value) for place, value in sparse]
        return ((_hinges(figures, self.knots) / self.scale) * self.weights).sum(axis=1) + np.array(more, dtype=float)

    def probability(self, preference: np.ndarray) -> np.ndarray:
        z = self.slope * (preference - self.cut) + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _hinges(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Each figure and its excess over each of its knots: scores may bend where a figure is normal."""
    parts = [x] + [np.maximum(0, x - knots[:, k]) for k in range(knots.shape[1])]
    return np.concatenate(parts, axis=1)


class _Evidence:
    """Hashed features of some rows: words sparse, trigrams, of which a text has a good part, dense."""

    def __init__(self, sparse: list[tuple[np.ndarray, np.ndarray]]):
        words = [int(np.searchsorted(p, WORD_PLACES)) for p, _ in sparse]  # words' places come first, in order
        self.grams = np.zeros((len(sparse), GRAM_PLACES), dtype=np.float32)
        for row, ((p, v), n) in enumerate(zip(sparse, words, strict=True)):
            self.grams[row, p[n:] - WORD_PLACES] = v[n:]
        cols = np.concatenate([p[:n] for (p, _), n in zip(sparse, words)]).astype(np.intp)
        self.words = Rows(np.array(words), cols, np.concatenate([v[:n] for (_, v), n in zip(sparse, words)]).astype(float), WORD_PLACES)

    def times(self, w: np.ndarray) -> np.ndarray:
        return self.words.times(w[:WORD_PLACES]) + self.grams @ w[WORD_PLACES:].astype(np.float32)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.concatenate([self.words.back(g), g.astype(np.float32) @ self.grams])


def _weights(h: np.ndarray, sparse: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, pairs: int = PAIRS, rounds: int = 300, seed: int = 7) -> np.ndarray:
    """Weights of standard hinges and of places, by the logistic loss of score differences over pairs.

    Every row is in a pair: both classes are dealt in turn to `pairs` pairs, or to as many as the larger has rows.
    """
    places = WORD_PLACES + GRAM_PLACES
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rows = _Evidence(sparse)
    rng = np.random.default_rng(seed)
    pairs = max(pairs, len(good), len(bad))
    deal = lambda x: np.concatenate([rng.permutation(x) for _ in range(-(-pairs // len(x)))])[:pairs]
    a, b = deal(good), deal(bad)
    l2 = np.concatenate([np.full(h.shape[1], FIGURE_L2), np.full(places, HASHED_L2)])

    def scores(w: np.ndarray) -> np.ndarray:
        return h @ w[: h.shape[1]] + rows.times(w[h.shape[1] :])

    def gather(w: np.ndarray, by_pair: np.ndarray) -> np.ndarray:
        """A pair's term is a difference of two rows, so what pairs add up to is a number for each row."""
        by_row = np.bincount(a, by_pair, len(y)) - np.bincount(b, by_pair, len(y))
        return np.concatenate([by_row @ h, rows.back(by_row)]) + l2 * w

    def gradient(w: np.ndarray) -> np.ndarray:
        s = scores(w)
        return gather(w, -1 / (1 + np.exp(np.clip(s[a] - s[b], -40, 40))) / pairs)

    def curvature(w: np.ndarray) -> np.ndarray:
        s = scores(w)
        return gather(w, 0.25 * (s[a] - s[b]) / pairs)

    return proximal(gradient, curvature, np.ones(len(l2)), np.zeros(len(l2)), rounds=rounds, tolerance=5e-4)


def _standard(figures: np.ndarray, knots: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((_hinges(figures, knots) - mean) / scale, -8, 8)


def _constant(good: int, rows: int) -> Model:
    """Every text scores the smoothed share of good ones."""
    share = (good + 0.5) / (rows + 1)
    flat = math.log(share / (1 - share)) - math.log(CUT / (1 - CUT))
    width = len(NAMES)
    return Model(np.zeros((width, 0)), np.ones(width), np.zeros(width), np.zeros(WORD_PLACES + GRAM_PLACES), -flat, 1.0)


def _cut(model: Model, grid: np.ndarray, kept: np.ndarray, caught: np.ndarray, spread: float) -> Model:
    """`model` with the cut at a score of `grid` from which on most good texts are kept and bad ones caught."""
    gain = kept + caught
    best = np.flatnonzero(gain >= gain.max() - 1e-9)
    cut = float(grid[best[0]] + LEAN * (grid[best[-1]] - grid[best[0]]))
    return Model(model.knots, model.scale, model.weights, model.hashed, cut, 8 / max(1e-6, spread))


def fit(figures: np.ndarray, sparse: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, pairs: int = PAIRS, rounds: int = 300, seed: int = 7) -> Model:
    """Fit on all of some evidence and its labels, which are held at once; `train` does so by blocks.

    With one class only, every text scores that class's smoothed share.
    """
    if not len(y) or y.min() == y.max():
        return _constant(int(np.sum(y)), len(y))
    knots = np.stack([np.quantile(figures[y == 1], q, axis=0) for q in BENDS], axis=1)
    h = _hinges(figures, knots)
    scale = np.maximum(h.std(axis=0), 1e-6)
    w = _weights(_standard(figures, knots, h.mean(axis=0), scale), sparse, y, pairs, rounds, seed)
    model = Model(knots, scale, w[: h.shape[1]], w[h.shape[1] :], 0.0, 1.0)
    s = model.preference(figures, sparse)
    grid = np.quantile(s, np.linspace(0, 1, GRID))
    sg, sb = np.sort(s[y == 1]), np.sort(s[y == 0])
    kept, caught = 1 - np.searchsorted(sg, grid) / len(sg), np.searchsorted(sb, grid) / len(sb)
    return _cut(model, grid, kept, caught, float(np.median(sg) - np.median(sb)))


def packed(place: np.ndarray, value: np.ndarray) -> bytes:
    """Hashed features in few bytes: steps between places, and which of a text's few values each has (float32)."""
    known, which = np.unique(value.astype(np.float32), return_inverse=True)
    step = np.diff(place, prepend=0).astype(np.uint16)  # places are in order, and below 2 ** 16
    raw = step.tobytes() + which.astype(np.uint16).tobytes() + known.tobytes()
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes, entries: int) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)
    step, which = np.frombuffer(raw, np.uint16, 2 * entries).reshape(2, entries)
    return np.cumsum(step, dtype=np.int32), np.frombuffer(raw, np.float32, offset=4 * entries)[which]


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Figures, hashed features and labels of a batch with the columns figures, entries, hashed and y."""
    figures = batch.column("figures").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(NAMES))
    sparse = [*map(unpacked, batch.column("hashed").to_pylist(), batch.column("entries").to_pylist())]
    return figures, sparse, batch.column("y").to_numpy(zero_copy_only=False)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, y, figures, entries, hashed) of every labelled text outside the held-out fold.

    Rows without an id or without the label take no part; several labels of one id count as their maximum,
    and of several rows of one id the shortest text counts (the smallest of these). Null texts are empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            figures, sparse = evidence(batch.column(2).to_pylist())
            columns = [
                batch.column(0), batch.column(1), pa.array(list(figures), type=pa.list_(pa.float64())),
                pa.array([len(p) for p, _ in sparse], type=pa.int32()), pa.array([packed(p, v) for p, v in sparse], type=pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "figures", "entries", "hashed"])

    usable = F.col("doc_id").isNotNull() & ~held_out()
    known = labels.where(usable & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("y")).where(F.col("y").isin(0, 1))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.where(usable).select("doc_id", F.struct(F.octet_length(text).alias("bytes"), text.alias("text")).alias("t")).join(known, "doc_id")
    one = rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("t").alias("t")).select("doc_id", "y", "t.text")
    return one.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, y int, figures array<double>, entries int, hashed binary")


def train(docs: DataFrame, labels: DataFrame, block_rows: int = BLOCK_ROWS) -> Model:
    """Learn `labels.quality` from all labelled rows outside the held-out fold.

    Knots, means and scales are those of all these rows. Weights are fitted on blocks of rows, each with
    about `block_rows` of the larger class and its share of the smaller one, and averaged by the rows of
    the blocks; every row is in one block, but those of a small class, of which a block has at least
    about LEAST_ROWS or all, can be in several. The cut is the best quantile of all rows' scores. Quantiles
    are off by one in 10,000 of the ranks at most. The driver gets a model for each block, one at a time.

    Null texts are empty; without labels, or with labels of one class, the model is a constant; how often
    an id is repeated doesn't matter.
    """
    rows = durable(labelled(docs, labels), "evidence")
    found = {r["y"]: r for r in rows.groupBy("y").agg(F.count("*").alias("n"), F.sum(F.col("entries").cast("long")).alias("entries")).collect()}
    if len(found) < 2:
        return _constant(sum(r["n"] for y, r in found.items() if y == 1), sum(r["n"] for r in found.values()))
    width = len(NAMES)
    asked = F.array(*map(F.lit, BENDS))
    near = rows.where("y = 1").agg(*(F.percentile_approx(F.col("figures")[i], asked, ACCURACY).alias(f"f{i}") for i in range(width))).first()
    knots = np.array([list(near[i]) for i in range(width)], dtype=float)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(width * (1 + len(BENDS))), np.zeros(width * (1 + len(BENDS)))
        for batch in handed_back(batches):
            h = _hinges(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, width), knots)
            n, one, two = n + len(h), one + h.sum(axis=0), two + (h * h).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([list(one)]), pa.array([list(two)])], names=["n", "one", "two"])

    sums = rows.select("figures").mapInArrow(moments, "n long, one array<double>, two array<double>").collect()
    total = sum(r["n"] for r in sums)
    mean = np.sum([r["one"] for r in sums], axis=0) / total
    scale = np.maximum(np.sqrt(np.maximum(np.sum([r["two"] for r in sums], axis=0) / total - mean * mean, 0)), 1e-6)

    many, few = sorted((0, 1), key=lambda y: -found[y]["n"])
    blocks = max(-(-found[many]["n"] // block_rows), -(-(found[many]["entries"] + found[few]["entries"]) // BLOCK_ENTRIES))
    groups = max(1, min(blocks, found[few]["n"] // LEAST_ROWS))
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")
    at = F.when(F.col("y") == many, F.array(own(blocks))).otherwise(F.sequence(own(groups), F.lit(blocks - 1), F.lit(groups)))

    def weigh(block: pa.Table) -> pa.Table:
        block = block.sort_by([("y", "ascending"), ("doc_id", "ascending")]).combine_chunks()  # sums don't depend on the order of tasks
        figures, sparse, y = _lists(block.to_batches()[0])
        # a class can be missing by chance of the hash, in blocks of very few rows only
        w = _weights(_standard(figures, knots, mean, scale), sparse, y) if 0 < y.sum() < len(y) else np.zeros(0)
        return pa.table({"n": pa.array([len(y) if len(w) else 0]), "w": pa.array([list(w)], type=pa.list_(pa.float64()))})

    fits = durable(rows.withColumn("block", F.explode(at)).groupBy("block").applyInArrow(weigh, "n long, w array<double>"), "fits")
    n, w = 0, np.zeros(len(mean) + WORD_PLACES + GRAM_PLACES)
    for r in fits.where("n > 0").toLocalIterator():
        n, w = n + r["n"], w + r["n"] * np.array(r["w"])
    if not n:
        return _constant(found[1]["n"], total)
    model = Model(knots, scale, w[: len(mean)] / n, w[len(mean) :] / n, 0.0, 1.0)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            figures, sparse, _ = _lists(batch)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(model.preference(figures, sparse))], names=["y", "s"])

    scores = durable(rows.select("y", "figures", "entries", "hashed").mapInArrow(rated, "y int, s double"), "scores")
    grid = np.array(scores.agg(F.percentile_approx("s", F.array(*map(F.lit, np.linspace(0, 1, GRID).tolist())), ACCURACY)).first()[0])
    middle = {r["y"]: r["m"] for r in scores.groupBy("y").agg(F.percentile_approx("s", 0.5, ACCURACY).alias("m")).collect()}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each class how many scores lie below each of the grid's."""
        below = np.zeros((2, GRID), dtype=np.int64)
        for batch in handed_back(batches):
            y, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for k in (0, 1):
                below[k] += np.searchsorted(np.sort(s[y == k]), grid)
        yield pa.RecordBatch.from_arrays([pa.array([list(below[0])]), pa.array([list(below[1])])], names=["bad", "good"])

    below = scores.mapInArrow(counted, "bad array<long>, good array<long>").collect()
    bad, good = (np.sum([r[k] for r in below], axis=0) for k in ("bad", "good"))
    return _cut(model, grid, 1 - good / found[1]["n"], bad / found[0]["n"], float(middle[1] - middle[0]))


def scorer(model: Model):
    """A vectorised function from whole texts to (preference, score)."""

    @F.pandas_udf("preference double, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in handed_back(batches):
            found = []
            for at in range(0, len(texts), 500):
                found.append(model.preference(*evidence(texts[at : at + 500])))
            preference = np.concatenate([np.zeros(0), *found])
            yield pd.DataFrame({"preference": preference, "score": model.probability(preference)})

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, preference, score) of every row: the whole text, null as empty; rows stay one to one.

    `preference` is the Bradley-Terry score, `score` its probability form; both tie exactly on repeated
    texts. Labels, language, source and id are no inputs. Columns of other names are left behind.
    """
    scored = docs.select(F.col(id_col).alias("doc_id"), scorer(model)(F.coalesce(F.col(text_col), F.lit(""))).alias("found"))
    return scored.select("doc_id", "found.preference", "found.score")
