"""Nearest neighbours by inner product with an adaptive scan over dimensions.

Vectors are dealt to inverted lists by k-means centroids that a bounded sample gives; every vector is
indexed. One dimension is added that makes all norms equal, which turns the largest inner product into
the smallest distance, and a fixed random rotation spreads each vector's energy evenly over its columns.
Within a probed list the rotated columns are scanned block by block: after d of D columns a candidate is
abandoned when its partial distance, scaled to D columns, exceeds the current k-th distance by more than
chance allows. Those left are scored exactly on the original vectors.

Lists lie side by side in blocks of bounded size, near ones together, and a query goes once to a block in
which it probes a list; a list too large for a block is cut. A query's nearest lists are scanned first, and
what they give bounds the scan of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import durable

#: Vectors that the centroids are fitted on, about, and centroids, at most: what the driver holds.
SAMPLE = 20_000
CENTROIDS = 1024
#: Bytes of vectors in a block, and of queries in a group, at most: what a task holds of either.
CELL_BYTES = 64_000_000
#: A block isn't cut below so many vectors for the sake of parallel work.
LEAST_BLOCK = 4096
#: Lists that give a query its first answers, which bound the scan of the others.
HOME = 3
#: Share of the lists that a query probes, nearest first; the measured recall decides it (see README).
PROBE = 0.8
#: Columns scanned between two tests, and the test's confidence in deviations of a partial distance.
COLUMNS = 16
CONFIDENCE = 2.1
ROUNDS = 8
_SEED = 11


def rotation(width: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every run and worker."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(_SEED)).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of Lloyd's algorithm; starts are spread over the sorted sample."""
    lists = max(1, min(lists, len(sample)))
    c = sample[np.linspace(0, len(sample) - 1, lists).astype(int)].copy()
    for _ in range(ROUNDS):
        near = nearest(sample, c, 1)[:, 0]
        total, n = np.zeros_like(c), np.bincount(near, minlength=lists)
        np.add.at(total, near, sample)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centroids of each row, nearest first; ties to the smaller number."""
    d = (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)
    return d.argmin(axis=1)[:, None] if k == 1 else np.argsort(d, axis=1, kind="stable")[:, :k]


def layout(means: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, blocks) of each list: near lists share a block of about `most` vectors, large ones have several."""
    first, parts = np.zeros(len(sizes), dtype=np.int64), np.maximum(1, -(-sizes // most))
    left, at, block, held = set(range(len(sizes))), 0, 0, 0
    while left:
        if parts[at] > 1 or held + sizes[at] > most:  # a block of its own, or the next one
            block, held = block + bool(held), 0
        first[at] = block
        held += sizes[at]
        if parts[at] > 1:
            block, held = block + parts[at], 0
        left.discard(at)
        if left:  # on to the nearest list without a place
            rest = np.fromiter(sorted(left), dtype=np.int64)
            at = int(rest[((means[rest] - means[at]) ** 2).sum(axis=1).argmin()])
    return first, parts


def scan(ids: np.ndarray, x: np.ndarray, norm2: float, q_ids: np.ndarray, q: np.ndarray, k: int, turn: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate position, inner product) of each query's best k ids in one block.

    `norm2` is the square of the common norm after the added dimension, `floor` a score that a query's
    k-th answer reaches: what is further away than that isn't returned. Column blocks are taken as matrix
    products while most pairs are alive, and pair by pair once the tests have left few.
    """
    width = x.shape[1] + 1
    lift = np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0))
    xr = (np.concatenate([x, lift[:, None]], axis=1) @ turn).astype(np.float32)
    qr = (np.concatenate([q, np.zeros((len(q), 1))], axis=1) @ turn).astype(np.float32)
    edges = [*range(0, width, COLUMNS), width]
    size = (q * q).sum(axis=1) + norm2
    # distances are scanned in single precision, so the bound leaves room for its rounding
    bound = (size - 2 * floor + 1e-5 * size).astype(np.float32)
    several = len(np.unique(ids)) < len(ids)  # an id with several vectors answers once, by the best
    out = []
    for at in range(0, len(q), 128):
        some = slice(at, min(at + 128, len(q)))
        y, limit = qr[some], bound[some]
        dense, row, col, part = np.zeros((len(y), len(x)), dtype=np.float32), None, None, None
        for a, b in zip(edges, edges[1:]):
            reach = limit * np.float32((1 + CONFIDENCE / np.sqrt(b)) ** 2 * (b / width)) if b < width else limit
            if row is None:
                dense += (y[:, a:b] ** 2).sum(axis=1)[:, None] + (xr[:, a:b] ** 2).sum(axis=1)[None, :] - 2 * (y[:, a:b] @ xr[:, a:b].T)
                alive = dense <= reach[:, None]
                dense[~alive] = np.inf
                if b == width or alive.mean() < 0.2:
                    row, col = np.nonzero(alive)
                    part = dense[row, col]
            else:
                step = xr[col, a:b] - y[row, a:b]
                part = part + np.einsum("ij,ij->i", step, step)
                keep = part <= reach[row]
                row, col, part = row[keep], col[keep], part[keep]
        row = row + at
        own = ids[col] == q_ids[row]
        row, col = row[~own], col[~own]
        if not several and len(row) > k * len(y):  # the best k by distance, with room for ties, before exact scores
            part = part[~own]
            order = np.lexsort((part, row))
            first = np.searchsorted(row[order], np.arange(at, at + len(y)))
            last = np.minimum(first + k, np.append(first[1:], len(row))) - 1
            worst = np.full(len(y), -np.inf)
            has = last >= first
            worst[has] = part[order][last[has]]
            keep = part <= worst[row - at] + 2e-5 * size[row]
            row, col = row[keep], col[keep]
        score = np.empty(len(row))
        for c in range(0, len(row), 65_536):
            score[c : c + 65_536] = (x[col[c : c + 65_536]] * q[row[c : c + 65_536]]).sum(axis=1)
        order = np.lexsort((ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        if several:
            pair = np.stack([row, ids[col]], axis=1)
            once = np.sort(np.unique(pair, axis=0, return_index=True)[1])
            row, col, score = row[once], col[once], score[once]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        out.append((row[rank < k], col[rank < k], score[rank < k]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def answers(lists: np.ndarray, ids: np.ndarray, x: np.ndarray, norm2: float, q_ids: np.ndarray, q: np.ndarray, probes: list[np.ndarray], floor: np.ndarray, k: int, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate position, inner product): each query's best in the lists it probes here.

    List after list is scanned by the queries that probe it; a query's k-th answer so far bounds the next.
    """
    top = np.full((len(q), k), -np.inf)
    several = len(np.unique(ids)) < len(ids)  # an id's vectors in two lists count as one answer: no bound from both
    order = np.argsort(lists, kind="stable")
    asked = np.repeat(np.arange(len(q)), [len(p) for p in probes])
    by_list = np.concatenate([np.zeros(0, np.int64), *probes])
    asked = asked[np.argsort(by_list, kind="stable")]
    by_list = np.sort(by_list)
    found = []
    for one in np.unique(by_list):
        some = order[slice(*np.searchsorted(lists[order], [one, one + 1]))]
        who = asked[slice(*np.searchsorted(by_list, [one, one + 1]))]
        if not len(some):
            continue
        row, col, score = scan(ids[some], x[some], norm2, q_ids[who], q[who], k, turn, np.maximum(floor[who], top[who, 0]))
        found.append((who[row], some[col], score))
        if not several:
            new = np.full((len(who), k), -np.inf)
            new[row, np.arange(len(row)) - np.searchsorted(row, row)] = score
            top[who] = np.sort(np.concatenate([top[who], new], axis=1), axis=1)[:, k:]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, col, score = (np.concatenate(c) for c in zip(*found, strict=True))
    keep = score >= top[row, 0]
    return row[keep], col[keep], score[keep]


def _array(packed, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=kind).reshape(len(packed), width).astype(np.float64)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of those that take part: not null, not zero, all components finite."""
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    fine = F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda e: e != 0)
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, probe: float = PROBE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products among the other vectors.

    Scores are computed in double precision on the original vectors; ties go to the smaller vec_id. Rows
    whose vector or id is null, and vectors that are zero or not finite, take no part, on either side. A
    row never answers its own id; rows that repeat an id and its vector count once, and of several vectors
    of one id the best is that id's answer. A vector shorter than the longest counts as zero beyond its
    end. Tables without a vector give no rows.
    """
    spark = vectors.sparkSession
    table, asked = valid(vectors, id_col, vector_col), valid(queries, id_col, vector_col)
    square = F.aggregate("vector", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    figures = table.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.max(square).alias("norm2")).first()
    wide = asked.agg(F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).first()
    if not figures["n"] or not wide["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, width, norm2 = figures["n"], max(figures["width"], wide["width"]), float(figures["norm2"]) * (1 + 1e-12)
    kind = "f4" if dict(table.dtypes)["vector"] == dict(asked.dtypes)["vector"] == "array<float>" else "f8"

    def matrix(column: pd.Series) -> np.ndarray:
        out = np.zeros((len(column), width))
        for i, v in enumerate(column):
            out[i, : len(v)] = v
        return out

    def lifted(v: np.ndarray) -> np.ndarray:
        return np.concatenate([v, np.sqrt(np.maximum(norm2 - (v * v).sum(axis=1), 0))[:, None]], axis=1)

    # ids by a hash, so many that SAMPLE are expected; the limit only holds off a freak of the hash
    chance = F.pmod(F.xxhash64("vec_id", F.lit(_SEED)), F.lit(1 << 30)) < F.lit(min(1 << 30, -(-SAMPLE * (1 << 30) // n)))
    sample = table.where(chance).groupBy("vec_id").agg(F.min("vector").alias("vector")).limit(2 * SAMPLE).toPandas().sort_values("vec_id")
    if not len(sample):  # few ids with many rows each
        sample = table.limit(1).toPandas()
    means = centroids(lifted(matrix(sample["vector"])), int(min(CENTROIDS, max(1, round(n**0.5 / 3)))))
    lists = len(means)
    means_at = spark.sparkContext.broadcast(means)  # CENTROIDS rows at most

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each vector's list; rows that repeat one another within a batch are one."""
        for f in frames:
            if len(f):
                v = matrix(f["vector"])
                out = pd.DataFrame({"vec_id": f["vec_id"], "list": nearest(lifted(v), means_at.value, 1)[:, 0].astype(np.int32), "data": [a.tobytes() for a in v.astype(kind)]})
                yield out.drop_duplicates(["vec_id", "data"])

    index = durable(table.mapInPandas(place, "vec_id long, list int, data binary"), "index")
    sizes = np.zeros(lists, dtype=np.int64)
    for r in index.groupBy("list").count().collect():  # CENTROIDS rows at most
        sizes[r["list"]] = r["count"]
    each = max(1, CELL_BYTES // (width * np.dtype(kind).itemsize))
    parallel = max(LEAST_BLOCK, -(-n // (2 * spark.sparkContext.defaultParallelism)))
    first, parts = layout(means, sizes, min(each, parallel))
    groups = -(-wide["n"] // each)
    probes = max(1, int(np.ceil(probe * lists)))
    turn = rotation(width + 1)

    def go(frames: Iterator[pd.DataFrame], since: int, upto: int) -> Iterator[pd.DataFrame]:
        """A row for each block in which a query probes a list; a list that is cut is probed in each part."""
        for f in frames:
            if not len(f):
                continue
            v = matrix(f["vector"])
            near = nearest(np.concatenate([v, np.zeros((len(v), 1))], axis=1), means_at.value, probes)[:, since:upto]
            rows = []
            for i, (own, data) in enumerate(zip(near, v.astype(kind))):
                own = own[sizes[own] > 0]
                for block in np.unique(first[own]):
                    here = own[first[own] == block].astype(np.int64)
                    for part in range(int(parts[here].max())):
                        rows.append((i, int(block) + part, data.tobytes(), here.tobytes()))
            at = [r[0] for r in rows]
            yield pd.DataFrame({"block": [r[1] for r in rows], "vec_id": f["vec_id"].to_numpy()[at], "data": [r[2] for r in rows], "floor": f["floor"].to_numpy(dtype=float)[at], "lists": [r[3] for r in rows]})

    def cell(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(ask):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, q_ids = have["vec_id"].to_numpy(), ask["vec_id"].to_numpy()
        own = [np.frombuffer(b, dtype=np.int64) for b in ask["lists"]]
        row, col, score = answers(have["list"].to_numpy(), ids, _array(have["data"], kind, width), norm2, q_ids, _array(ask["data"], kind, width), own, ask["floor"].to_numpy(), k, turn)
        return pd.DataFrame({"query_id": q_ids[row], "vec_id": ids[col], "score": score})

    homes = F.broadcast(spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(first, parts))], "list int, at int, parts int"))  # CENTROIDS rows at most
    copies = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = index.join(homes, "list").select((F.col("at") + F.pmod(F.xxhash64("vec_id", "data"), F.col("parts"))).cast("int").alias("block"), copies.alias("grp"), "vec_id", "list", "data")

    def probed(asking: DataFrame, since: int, upto: int, label: str) -> DataFrame:
        """(query_id, vec_id, score): the best k of every block in which `asking` probes lists from `since` on."""
        sent = asking.select("vec_id", "vector", "floor").mapInPandas(lambda f: go(f, since, upto), "block int, vec_id long, data binary, floor double, lists binary")
        sent = sent.select("block", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("grp"), "vec_id", "data", "floor", "lists")
        key = ["block", "grp"]
        return durable(dealt.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(cell, "query_id long, vec_id long, score double"), label)

    best = lambda rows: rows.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # noqa: E731  repeated rows
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows from each probed block at most
    top = lambda rows: best(rows).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    asked = asked.dropDuplicates(["vec_id", "vector"])
    home = durable(top(probed(asked.withColumn("floor", F.lit(float("-inf"))), 0, HOME, "home")).drop("rank"), "first-answers")
    found = home
    if probes > HOME:
        reached = home.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("reached"))
        rest = asked.join(reached, F.col("vec_id") == F.col("query_id"), "left").withColumn("floor", F.coalesce("reached", F.lit(float("-inf"))))
        found = home.unionByName(probed(rest, HOME, probes, "others"))
    return top(found).select("query_id", "rank", "vec_id", "score")
