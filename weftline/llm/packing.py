"""Best-fit packing of documents into sequences of several permitted lengths.

A document has the tokens of the byte-level BPE and one end mark; a longer one than the largest permitted
length is cut into pieces, which are ranges of tokens (a cut can fall inside a character, as a token's end
can). Packing depends on the lengths alone, so the plan is made from the histogram of lengths, which the
largest length bounds, whatever the number of documents: best-fit decreasing over runs of equal pieces and
of equal bins. A second pass gives each piece its place by its rank among the pieces of its length.

Each new bin opens with the permitted length of the least cost a token, as far as the pieces that are left
can fill it; bins end at the smallest permitted length that holds their contents. As later pieces may go
elsewhere, choices are then revised jointly: a range of lengths at a time, every permitted length is tried
for the bins that these pieces open, and what lowers the total cost stays.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm import bpe
from weftline.llm.common import durable, slices

#: Permitted sequence lengths, in tokens.
CAPACITIES = (1024, 2048, 4096, 8192)
#: Cost of a sequence of c tokens: c, plus attention that grows with c * c, plus a share of a step.
ATTENTION = 1 / 65536
STEP = 16.0


def cost(capacity: int) -> float:
    return STEP + capacity + ATTENTION * capacity * capacity


@dataclass
class Run:
    """`bins` equal bins that hold the pieces `parts` (length, how many), with room for `left` more."""

    bins: int
    left: int
    size: int
    parts: list[tuple[int, int]] = field(default_factory=list)


#: What a new bin opens with, given a piece and the counts of the pieces that are left, it among them.
Opening = Callable[[int, dict[int, int]], int]


def at_least(least: int, sizes: list[int]) -> Opening:
    """The smallest capacity from `least` on that holds the piece."""
    return lambda length, _: next(s for s in sizes if s >= max(length, least))


def plan(histogram: dict[int, int], capacities=CAPACITIES, least: int | Opening | None = None) -> list[Run]:
    """Best-fit decreasing: each piece goes where the least room stays, else into a new bin.

    A new bin opens with the smallest capacity that is at least `least` and holds the piece, or with what
    `least` returns. Runs of equal bins are handled together: each length splits at most one run, so there
    are at most twice as many runs as lengths.
    """
    sizes = sorted(capacities)
    opens = least if callable(least) else at_least(least or 0, sizes)
    left = {k: n for k, n in histogram.items() if n}
    runs: dict[int, list[Run]] = {}
    rooms: list[int] = []  # sorted keys of `runs`
    done: list[Run] = []

    def put(run: Run) -> None:
        if not run.left:
            done.append(run)
            return
        if run.left not in runs:
            runs[run.left] = []
            bisect.insort(rooms, run.left)
        runs[run.left].append(run)

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        todo = histogram[length]
        while todo:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                run = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                left[length] = todo
                size = opens(length, left)
                run = Run(-(-todo // (size // length)), size, size)
            each = run.left // length  # best fit stays with a bin: it has less room after each piece
            full = min(run.bins, todo // each)
            if full:
                put(Run(full, run.left - each * length, run.size, [*run.parts, (length, each)]))
                todo -= full * each
            rest = run.bins - full
            if rest and todo and full < run.bins and todo < each:
                put(Run(1, run.left - todo * length, run.size, [*run.parts, (length, todo)]))
                todo, rest = 0, rest - 1
            if rest:
                if run.parts:
                    put(Run(rest, run.left, run.size, run.parts))
        del left[length]
    return done + [r for room in rooms for r in runs[room]]


def shrink(runs: list[Run], capacities=CAPACITIES) -> list[Run]:
    """Each bin at the smallest permitted length that holds its contents."""
    sizes = sorted(capacities)
    out = []
    for r in runs:
        used = r.size - r.left
        size = next(s for s in sizes if s >= used)
        out.append(Run(r.bins, size - used, size, r.parts))
    return out


def filled(length: int, size: int, lengths: list[int], left: dict[int, int]) -> int:
    """Tokens in a bin of `size` that opens with a piece of `length` and takes the largest that fits again and again.

    `lengths` are those of `left`, sorted.
    """
    room, at = size, bisect.bisect_right(lengths, length)
    while at:
        n = lengths[at - 1]
        if n > room:
            at = bisect.bisect_right(lengths, room, 0, at)
            continue
        room -= n * min(left[n], room // n)
        at -= 1
    return size - room


def least_cost(histogram: dict[int, int], sizes: list[int]) -> Opening:
    """The capacity whose bin, filled and shrunk, costs the least a token; ties to the smaller."""
    lengths = sorted(k for k, n in histogram.items() if n)

    def choose(length: int, left: dict[int, int]) -> int:
        def each(size: int) -> float:
            held = filled(length, size, lengths, left)
            return cost(next(s for s in sizes if s >= held)) / held

        return min((s for s in sizes if s >= length), key=lambda s: (each(s), s))

    return choose


def total_cost(runs: list[Run]) -> float:
    return sum(r.bins * cost(r.size) for r in runs)


#: Ranges of lengths whose openings are revised together, and rounds of it at most; up to so many choices
#: of an opening for each length are simply all tried.
RANGES, SWEEPS, ALL = 8, 3, 1024


def best_plan(histogram: dict[int, int], capacities=CAPACITIES) -> list[Run]:
    """The shrunk plan of the least total cost that is found; ties to the earlier one.

    Plans are those of the least cost a token as each bin opens, of every capacity as the least one to
    open, and, where few lengths make it possible, of every choice of a capacity for each length. The best
    is then revised, range of lengths after range, until no capacity of a range lowers the cost.
    """
    sizes = sorted(capacities)
    lengths = sorted(k for k, n in histogram.items() if n)
    made = lambda opens: shrink(plan(histogram, capacities, opens), capacities)
    tried = [(opens, made(opens)) for opens in (least_cost(histogram, sizes), *(at_least(s, sizes) for s in sizes))]
    fits = [[s for s in sizes if s >= n] for n in lengths]
    if math.prod(map(len, fits)) <= ALL:
        return min([runs for _, runs in tried] + [made(lambda n, _, c=dict(zip(lengths, c)): c[n]) for c in itertools.product(*fits)], key=total_cost)
    opens, best = min(tried, key=lambda t: total_cost(t[1]))
    total = sum(n * histogram[n] for n in lengths)
    edges, held = [0], 0  # ranges of about equal tokens
    for n in lengths:
        held += n * histogram[n]
        if held * RANGES >= total * len(edges):
            edges.append(n)
    for _ in range(SWEEPS):
        before = total_cost(best)
        for low, high in reversed([*zip(edges, edges[1:])]):
            for s in sizes:
                rule = lambda n, left, low=low, high=high, s=s, other=opens: max(s, next(c for c in sizes if c >= n)) if low < n <= high else other(n, left)
                runs = made(rule)
                if total_cost(runs) < total_cost(best):
                    opens, best = rule, runs
        if total_cost(best) >= before:
            break
    return best


@dataclass(frozen=True)
class Places:
    """For each length: where its ranks start in each run, and what they get there."""

    start: dict[int, np.ndarray]  # first rank of the part
    bin0: dict[int, np.ndarray]  # first bin of the part's run
    each: dict[int, np.ndarray]  # pieces of this length in each bin of the run
    offset: dict[int, np.ndarray]  # token where the first of them starts
    size: dict[int, np.ndarray]

    @classmethod
    def of(cls, runs: list[Run]) -> Places:
        found: dict[int, list[tuple[int, int, int, int, int]]] = {}
        ranks: dict[int, int] = {}
        first = 0
        for r in runs:
            at = 0
            for length, each in r.parts:
                rank = ranks.get(length, 0)
                found.setdefault(length, []).append((rank, first, each, at, r.size))
                ranks[length] = rank + each * r.bins
                at += length * each
            first += r.bins
        col = lambda k: {n: np.array([x[k] for x in rows], dtype=np.int64) for n, rows in found.items()}
        return cls(col(0), col(1), col(2), col(3), col(4))

    def look_up(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """(bin, offset, size) of pieces given by length and rank."""
        out = tuple(np.empty(len(length), dtype=np.int64) for _ in range(3))
        order = np.argsort(length, kind="stable")
        edges = np.flatnonzero(np.diff(length[order])) + 1
        for part in np.split(order, edges):
            if len(part):
                n = int(length[part[0]])
                k = np.searchsorted(self.start[n], rank[part], side="right") - 1
                inside = rank[part] - self.start[n][k]
                out[0][part] = self.bin0[n][k] + inside // self.each[n][k]
                out[1][part] = self.offset[n][k] + inside % self.each[n][k] * n
                out[2][part] = self.size[n][k]
        return out


def counted(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tokens): the tokens of every row's whole text, null as empty, and its end mark."""
    kind = dict(docs.dtypes)[id_col]
    path = vocabulary or bpe.default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bpe.ranked(path)
        for batch in slices(batches, 200):
            sizes = [len(words.encode_ordinary(t)) + 1 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, type=pa.int64())], names=["doc_id", "tokens"])

    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, tokens long")


def pack(docs: DataFrame, capacities=CAPACITIES, id_col: str = "doc_id", text_col: str = "text", tokens: str | None = None) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bin_id, bin_size, bin_offset): one row for each piece.

    Texts are counted with the ranks of `bpe`, unless `tokens` names a column of counts, end mark included
    (1 at least). A null or empty text has one piece, its end mark. `start` is the token of the document
    where the piece begins. Every row is packed, repeated ones and those without an id too; pieces of one
    length are ranked by a hash of their id, so ties are settled alike at each run, and equal (id, piece,
    length) rows can stand for one another. An empty table gives no rows.
    """
    spark = docs.sparkSession
    most = max(capacities)
    kind = dict(docs.dtypes)[id_col]
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(tokens).cast("long").alias("tokens")) if tokens else counted(docs, None, id_col, text_col)
    pieces = sized.select("doc_id", "tokens", F.explode(F.expr(f"sequence(0L, (tokens - 1) div {most})")).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * most).alias("start"), F.least(F.lit(most), F.col("tokens") - F.col("piece") * most).alias("n_tokens")
    )
    # ranks: of a piece among those of its length and bucket, after the buckets before
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = durable(pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))), "pieces")
    counts = pieces.groupBy("n_tokens", "bucket").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    histogram = {int(r[0]): int(r[1]) for r in counts.groupBy("n_tokens").agg(F.sum("n")).collect()}  # at most `most` rows
    places = spark.sparkContext.broadcast(Places.of(best_plan(histogram, capacities)))  # grows with `most` only
    within = F.row_number().over(Window.partitionBy("n_tokens", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = (
        pieces.withColumn("within", within)
        .join(before.select("n_tokens", "bucket", F.coalesce("before", F.lit(0)).alias("before")), ["n_tokens", "bucket"])
        .select("doc_id", "piece", "start", "n_tokens", (F.col("within") + F.col("before")).alias("rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = places.value.look_up(batch.column(3).to_numpy(), batch.column(4).to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *map(pa.array, got)], names=["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_offset", "bin_size"])

    return ranked.mapInArrow(place, f"doc_id {kind}, piece long, start long, n_tokens long, bin_id long, bin_offset long, bin_size long").select("doc_id", "piece", "start", "n_tokens", "bin_id", "bin_size", "bin_offset")
