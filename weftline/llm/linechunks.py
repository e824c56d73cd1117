"""Line dedup by content-defined chunks of lines and by runs of lines of fifty words.

A rolling hash over the hashes of the last lines ends a chunk wherever it falls into one of DIVISOR
classes, so the same passage is cut alike wherever it stands; chunks of several lines that occur again go,
of whatever length. Where a passage is cut first depends on what stands before it, so the shortest runs of
lines that reach PASSAGE_WORDS words are taken too, one from every line on and one up to every line: any
repeated passage of so many words is the union of such runs, whatever surrounds it and however it is
broken into lines, be it one line or many.

Chunks and runs that occur again anywhere are removed after comparing their bytes with those of the
occurrence that stays, the one of the smallest (doc_id, text hash, position). The lines of a run that
stays stay though other runs over them may go, so no passage is lost; those of a chunk too, unless it lies
within a longer repeated passage, whose runs stay elsewhere. Within a text, what overlaps the first of
equal runs there is no further occurrence.

Copies of a whole text (of equal SHA-256) lose all their chunks and runs without a comparison of bytes, as
those of the copy with the smallest id stay or go for all of them: the work grows with different texts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import durable, fresh, handed_back, slices

#: Lines that the rolling hash spans.
WINDOW = 2
#: A chunk ends after a line with this chance.
DIVISOR = 2
#: Lines in a chunk at least, unless the end of the text stops it.
LEAST_LINES = 2
#: Words that make a run of lines a passage, wherever it stands.
PASSAGE_WORDS = 50
#: A hash is hot with more than one in HOT_SHARE of all rows, and with HOT_ROWS at least: so there are fewer
#: than HOT_SHARE hot ones. Its rows are dealt to SALTS tasks.
HOT_SHARE, HOT_ROWS, SALTS = 10_000, 1000, 64

_FACTOR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def chunks(lines: list[bytes]) -> list[tuple[int, int, bool]]:
    """(first line, line after the last, removable) of consecutive chunks that cover all lines.

    Removable are chunks with at least two lines that aren't blank. How long a line is makes no difference.
    """
    out: list[tuple[int, int, bool]] = []
    start, filled, recent = 0, 0, []

    def end(at: int) -> None:
        nonlocal start, filled
        if at > start:
            out.append((start, at, filled >= 2))
        start, filled = at, 0

    for i, line in enumerate(lines):
        recent = [*recent[-WINDOW + 1 :], xxhash.xxh64_intdigest(line)]
        filled += bool(line.strip())
        rolled = 0
        for h in recent:
            rolled = (rolled * _FACTOR + h) & _MASK
        rolled ^= rolled >> 32
        if rolled % DIVISOR == 0 and i + 1 - start >= LEAST_LINES:
            end(i + 1)
    end(len(lines))
    return out


def runs(lines: list[bytes]) -> set[tuple[int, int]]:
    """(first line, line after the last) of the shortest runs of PASSAGE_WORDS words from and up to each line.

    They begin and end with a line that isn't blank.
    """
    words = [len(line.split()) for line in lines]
    out: set[tuple[int, int]] = set()
    end = total = 0
    for start, n in enumerate(words):
        while end < len(words) and total < PASSAGE_WORDS:
            total += words[end]
            end += 1
        if total < PASSAGE_WORDS:
            break
        if n:
            out.add((start, end))
        total -= n
    start, total = len(words), 0
    for end in range(len(words), 0, -1):
        while start > 0 and total < PASSAGE_WORDS:
            start -= 1
            total += words[start]
        if total < PASSAGE_WORDS:
            break
        if words[end - 1]:
            out.add((start, end))
        total -= words[end - 1]
    return out


def removable(text: str) -> Iterator[tuple[int, int, bytes]]:
    """(first line, line after the last, bytes) of the chunks and runs that may go if they occur elsewhere."""
    lines = text.encode().split(b"\n")
    first: dict[bytes, int] = {}  # where the first of equal ones ends: what overlaps it is no further occurrence
    for a, b in sorted({(a, b) for a, b, ok in chunks(lines) if ok} | runs(lines)):
        data = b"\n".join(lines[a:b])
        if first.setdefault(xxhash.xxh3_128_digest(data), b) in range(a + 1, b):
            continue
        yield a, b, data


def spared(gone: list[tuple[int, int, int]], stays: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges of `gone` (first line, line after the last, source) less the lines of `stays`.

    Ranges of one source that overlap stand there side by side as here, so they are one longer range. A
    range of `stays` that lies within such a one stands whole at the source and isn't held here.
    """
    longer: list[tuple[int, int]] = []
    last: dict[int, tuple[int, int]] = {}
    for a, b, source in sorted(set(gone)):
        if source in last and a < last[source][1]:
            a, b = last[source][0], max(b, last[source][1])
        last[source] = (a, b)
        longer.append((a, b))
    longer.sort()
    gone = sorted({(a, b) for a, b, _ in gone})
    starts, reach = [a for a, _ in longer], list(accumulate((b for _, b in longer), max))
    size = max((b for _, b in [*gone, *stays]), default=0)
    edge = [0] * (size + 1)
    for a, b in set(stays):
        at = bisect_right(starts, a)
        if not at or reach[at - 1] < b:
            edge[a] += 1
            edge[b] -= 1
    free = [n == 0 for n in accumulate(edge)]
    held = [0, *accumulate(not f for f in free)]  # lines that stay before each line
    out: set[tuple[int, int]] = set()
    for a, b in gone:
        if held[a] == held[b]:
            out.add((a, b))
            continue
        for i in range(a, b):
            if free[i] and (i == a or not free[i - 1]):
                end = i
                while end < b and free[end]:
                    end += 1
                out.add((i, end))
    return sorted(out)


def _halves(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        take, cols = [], ([], [], [], [])
        for row, text in enumerate(batch.column(2).to_pylist()):
            for a, b, data in removable(text):
                take.append(row)
                for col, v in zip(cols, (a, b, *_halves(data)), strict=True):
                    col.append(v)
        rows = pa.array(take, type=pa.int32())
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True))], names=["id", "tk", "a", "b", "h1", "h2"])


def _fetch_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the chunks that `wanted` lists for each text; a few megabytes at a time."""
    names = ["id", "tk", "a", "b", "h1", "h2", "keeper", "source", "data"]

    def made(batch, take, found):
        rows = pa.array(take, type=pa.int32())
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array([f[k] for f in found], type=t) for k, t in enumerate(kinds))], names=names)

    for batch in handed_back(batches):
        take, found, size = [], [], 0
        for row in range(batch.num_rows):
            lines = batch.column(2)[row].as_py().encode().split(b"\n")
            for w in batch.column(3)[row].as_py():
                data = b"\n".join(lines[w["a"] : w["b"]])
                take.append(row)
                found.append((w["a"], w["b"], w["h1"], w["h2"], w["keeper"], w["source"], data))
                size += len(data)
                if size > 8_000_000:
                    yield made(batch, take, found)
                    take, found, size = [], [], 0
        yield made(batch, take, found)


def _spare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`spans` less the lines that stay, and `cut`: what they cover, as ranges that don't touch."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    for batch in slices(batches):
        spans, cut = [], []
        for gone, stays in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            left = spared([(s["a"], s["b"], s["source"]) for s in gone], [(s["a"], s["b"]) for s in stays])
            whole: list[list[int]] = []
            for a, b in left:
                if whole and a <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], b)
                else:
                    whole.append([a, b])
            spans.append([{"a": a, "b": b} for a, b in left])
            cut.append([{"a": a, "b": b} for a, b in whole])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, type=kind), pa.array(cut, type=kind)], names=["id", "tk", "spans", "cut"])


def _salted(rows: DataFrame, each: DataFrame, hot: DataFrame, by: list[str]) -> DataFrame:
    """`rows` joined with `each`, which has one row for each hash, on (h1, h2).

    The rows of a hot hash are dealt to SALTS tasks by the columns `by`, and its row of `each` is there in all.
    """
    hot = F.broadcast(hot.select("h1", "h2", F.lit(True).alias("hot")))  # HOT_SHARE rows at most
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(*by), F.lit(SALTS))).otherwise(0).cast("int")
    left = rows.join(hot, ["h1", "h2"], "left").withColumn("salt", salt).drop("hot")
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = each.join(hot, ["h1", "h2"], "left").withColumn("salt", F.explode(salts)).drop("hot")
    return left.join(right, ["h1", "h2", "salt"]).drop("salt")


def _twins(texts: DataFrame) -> DataFrame:
    """(cid, ctk, head) of the texts that stand whole under another id too; `head` is true for the smallest (id, tk).

    Whole texts are told apart by their SHA-256. Every chunk and run of a copy stands in its head, so a copy
    loses all of them, and neither its rows nor its bytes need to meet those of other texts.
    """
    name = F.struct("id", "tk")
    whole = texts.where("text != ''").select("id", "tk", F.unhex(F.sha2("text", 256)).alias("whole"))
    groups = whole.groupBy("whole").agg(F.min(name).alias("least"), F.max(name).alias("most")).where("NOT least <=> most").select("whole", "least")
    groups = durable(groups, "copied")  # so that the join can split a text with very many copies
    return whole.join(groups, "whole").select(F.col("id").alias("cid"), F.col("tk").alias("ctk"), name.eqNullSafe(F.col("least")).alias("head")).distinct()


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tk, spans, cut): for each text with chunks or runs that occur before, their ranges of lines.

    Ranges of `spans` can overlap; `cut` has the same lines in ranges that don't.

    `tk` is the hash of the text; id and tk name a text, so rows that repeat both are one text. A null text
    counts as empty, which has no chunk; an empty table gives no rows.
    """
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select("id", F.xxhash64("text").alias("tk"), "text")
    twins = _twins(texts)
    chunk = texts.mapInArrow(_hash_chunks, f"id {kind}, tk long, a int, b int, h1 long, h2 long")
    chunk = chunk.join(twins, F.col("id").eqNullSafe(F.col("cid")) & (F.col("tk") == F.col("ctk")), "left").select(*chunk.columns, "head")
    chunk = durable(chunk, "chunks")
    found, copied = chunk.where("head IS NULL OR head"), chunk.where("NOT head")
    place = F.struct("id", "tk", "a")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n"), F.bool_or(F.col("head").isNotNull()).alias("twin"))
    first = durable(first.where("twin OR NOT first <=> last").drop("last", "twin"), "repeats")
    floor = max(HOT_ROWS, found.count() // HOT_SHARE)
    hot = durable(first.where(F.col("n") > floor).select("h1", "h2"), "hot")
    met = _salted(found.drop("head"), first.drop("n"), hot, ["id", "tk", "a"])
    wanted = (
        met.select("id", "tk", "a", "b", "h1", "h2", place.eqNullSafe(F.col("first")).alias("keeper"), F.xxhash64("first.id", "first.tk", F.col("first.a") - F.col("a")).alias("source"))
        .groupBy("id", "tk").agg(F.collect_set(F.struct("a", "b", "h1", "h2", "keeper", "source")).alias("wanted"))  # a text's own chunks
    )
    w = wanted.select(F.col("id").alias("wid"), F.col("tk").alias("wtk"), "wanted")
    sides = texts.join(w, F.col("id").eqNullSafe(F.col("wid")) & (F.col("tk") == F.col("wtk"))).select("id", "tk", "text", "wanted")
    data = durable(sides.mapInArrow(_fetch_chunks, f"id {kind}, tk long, a int, b int, h1 long, h2 long, keeper boolean, source long, data binary"), "chunk-bytes")
    kept = durable(data.where("keeper").groupBy("h1", "h2").agg(F.min("data").alias("kept")), "kept-bytes")
    same = _salted(data.where("NOT keeper"), kept, hot, ["id", "tk", "a"]).where(F.col("data") == F.col("kept"))
    ranges = same.select("id", "tk", "a", "b", "source", F.lit(False).alias("keeper")).union(data.where("keeper").select("id", "tk", "a", "b", "source", "keeper"))
    ranges = ranges.union(copied.select("id", "tk", "a", "b", F.lit(0).cast("long"), F.lit(False)))
    of = lambda keeper: F.collect_set(F.when(F.col("keeper") == keeper, F.struct("a", "b", "source")))
    both = ranges.groupBy("id", "tk").agg(of(False).alias("spans"), of(True).alias("stays")).where(F.size("spans") > 0)
    span = "array<struct<a:int,b:int>>"
    return both.mapInArrow(_spare, f"id {kind}, tk long, spans {span}, cut {span}").where(F.size("spans") > 0)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `text` less its repeated chunks and runs, and `removed`: their ranges of lines (never null).

    Of equal chunks or runs the first by (id, text hash, line) stays, also within one text. Ranges of
    `removed` can overlap. A null text stays
    null; texts without repeated chunks stay as they are; rows are neither added nor dropped, and rows
    that repeat id and text fare alike. A column already called `removed` is replaced; columns of any
    other name stay. An empty table gives no rows.
    """
    own, id_, tk, spans_, cut = fresh(docs, "__own", "__id", "__tk", "__spans", "__cut")
    spans = repeated(docs, id_col, text_col).select(F.col("id").alias(id_), F.col("tk").alias(tk), F.col("spans").alias(spans_), F.col("cut").alias(cut))
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = keyed.join(spans, F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(tk)), "left")
    # what stays lies between one range's end and the next one's begin: a slice each, so linear in the lines
    lines = F.split(F.col(text_col), "\n")
    since = F.concat(F.array(F.lit(0)), F.col(cut)["b"])
    upto = F.concat(F.col(cut)["a"], F.array(F.size(lines)))
    left = F.flatten(F.zip_with(since, upto, lambda i, j: F.slice(lines, i + 1, j - i)))
    text = F.when(F.col(spans_).isNotNull(), F.array_join(left, "\n")).otherwise(F.col(text_col))
    none = F.array().cast("array<struct<a:int,b:int>>")
    kept = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "removed"]
    return joined.select(*kept, F.coalesce(F.array_sort(spans_), none).alias("removed"))
