"""Sharding by a k-d tree of metadata: equal bytes in every shard. DataFrame operations only.

A node that stands for several shards is split along the dimension that is widest in it, at the point
where its bytes divide in proportion to the shards on either side (the weighted median for two equal
halves), until each leaf holds the target bytes of one shard. The point is found exactly by narrowing a
range of keys: each pass sums bytes in bins of all open nodes, and only one row for each node, so never
more than there are shards, comes to the driver.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import durable

#: Bins of a pass, for each open node.
BINS = 4096
#: A key has the dimension's place in its high bits and a hash of id and text that breaks ties in its low 32.
PLACES = 1 << 20

#: The dimensions: size and length on log scales, id, source and language in the order of their values. Each is
#: scaled to the table's own range, so that widths compare.
DIMENSIONS = ("by_size", "by_source", "by_id", "by_lang", "by_chars")
#: Bytes of a text, after those that all of its column share, that its place comes from.
TEXT_BYTES = 6


@dataclass
class Node:
    """Rows with shards first to last-1; `lead` of them go left of `cut` along `dimension`."""

    first: int
    last: int
    dimension: str | None = None
    cut: int | None = None
    left: Node | None = None
    right: Node | None = None

    @property
    def lead(self) -> int:
        return (self.last - self.first) // 2


def _leaf(node: Node) -> Column:
    """The first shard of the leaf that a row falls into."""
    if node.left is None:
        return F.lit(node.first)
    return F.when(F.col(node.dimension) <= node.cut, _leaf(node.left)).otherwise(_leaf(node.right))


def _scaled(value: Column, low: int | None, high: int | None) -> Column:
    """The place of a number in the range from `low` to `high`; null takes the first."""
    if low is None or low == high:
        return F.lit(0).cast("long")
    share = (value.cast("double") - float(low)) / (float(high) - float(low))
    return F.coalesce(F.least(F.greatest(F.floor(share * (PLACES - 1)), F.lit(0)), F.lit(PLACES - 1)).cast("long"), F.lit(0).cast("long"))


def _octaves(n: Column) -> Column:
    """A whole number above 0 on a log scale: its octave and the place within it."""
    bits = F.length(F.bin(n))
    return (bits * (1 << 14)).cast("long") + F.floor(n.cast("double") * (1 << 14) / F.pow(F.lit(2.0), bits)).cast("long")


def _text_number(raw: Column, shared: int) -> Column:
    """Bytes of a text after the first `shared`, as a number in the texts' order."""
    return F.conv(F.rpad(F.hex(F.substring(raw, shared + 1, TEXT_BYTES)), 2 * TEXT_BYTES, "0"), 16, 10).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32 and a 52-bit key for each dimension) of every row.

    Null texts, sources and languages count as empty, null ids and lengths as the least; a column of
    metadata that `docs` lacks is null. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    have = lambda c, kind: (F.col(c) if c in docs.columns else F.lit(None)).cast(kind)
    raw = lambda c: F.encode(F.coalesce(have(c, "string"), F.lit("")), "UTF-8")
    size = (F.octet_length(text) + 16).cast("long")
    tie = F.crc32(F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.crc32(text).cast("string"), F.lit("kd")))
    chars = F.greatest(F.coalesce(have("n_chars", "long"), F.lit(0)), F.lit(0)) + 1
    rows = docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), tie.alias("tie"), raw("source").alias("source"), raw("lang").alias("lang"), _octaves(size).alias("octave"), _octaves(chars).alias("chars"))
    rows = durable(rows, "metadata")
    number = F.col("doc_id").try_cast("double")
    span = {"octave": "octave", "chars": "chars", "id": number, "source": "source", "lang": "lang"}
    ends = rows.agg(*(f(c).alias(f"{name}_{k}") for k, c in span.items() for name, f in (("min", F.min), ("max", F.max)))).first()  # one row
    place = {"by_size": _scaled(F.col("octave"), ends["min_octave"], ends["max_octave"]), "by_chars": _scaled(F.col("chars"), ends["min_chars"], ends["max_chars"]), "by_id": _scaled(number, ends["min_id"], ends["max_id"])}
    for k in ("source", "lang"):
        low, high = (bytes(ends[f"{name}_{k}"] or b"") for name in ("min", "max"))
        shared = len(os.path.commonprefix([low, high]))
        edge = lambda b: int.from_bytes(b[shared : shared + TEXT_BYTES].ljust(TEXT_BYTES, b"\0"), "big")
        place[f"by_{k}"] = _scaled(_text_number(F.col(k), shared), edge(low), edge(high))
    return durable(rows.select("doc_id", "size", "text_crc32", *((place[d] * (1 << 32) + F.col("tie")).cast("long").alias(d) for d in DIMENSIONS)), "keyed")


def build(rows: DataFrame, shards: int) -> Node:
    """The tree over `rows` (size and the dimensions' keys); a node without rows is cut anywhere.

    Rows that agree in all keys stay together, so a node of one key can leave one side empty.
    """
    root = Node(0, shards)
    open_ = [root] if shards > 1 else []
    while open_:
        at = rows.withColumn("node", _leaf(root)).where(F.col("node").isin([n.first for n in open_]))
        stats = at.groupBy("node").agg(F.sum("size").alias("bytes"), *(f(d).alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("min", F.min), ("max", F.max))))
        found = {r["node"]: r for r in stats.collect()}  # a row for each open node
        todo = []
        for n in open_:
            if n.first not in found:  # nothing fell here: any cut will do
                n.dimension, n.cut = DIMENSIONS[0], 0
                continue
            r = found[n.first]
            n.dimension = max(DIMENSIONS, key=lambda d: ((r[f"max_{d}"] >> 32) - (r[f"min_{d}"] >> 32), -DIMENSIONS.index(d)))
            todo.append((n, r["bytes"], 0, r[f"min_{n.dimension}"], r[f"max_{n.dimension}"]))
        _cut(at, todo)
        grown = []
        for n in open_:
            n.left, n.right = Node(n.first, n.first + n.lead), Node(n.first + n.lead, n.last)
            grown += [x for x in (n.left, n.right) if x.last - x.first > 1]
        open_ = grown
    return root


def _cut(rows: DataFrame, todo: list[tuple[Node, int, int, int, int]]) -> None:
    """Set each node's cut: the largest key up to which at most its share of the bytes lies.

    Of each node are known its bytes, the bytes below a range of keys, and that range, where the share
    is passed.
    """
    while todo:
        # a few numbers for each open node, written out in the plan as arrays by node
        def of(value, todo=todo) -> Column:
            known = {t[0].first: value(*t) for t in todo}
            return F.get(F.array(*(F.lit(known.get(i)).cast("long") for i in range(max(known) + 1))), F.col("node"))

        places = {"dimension": of(lambda n, *_: DIMENSIONS.index(n.dimension)), "lo": of(lambda n, total, below, lo, hi: lo), "width": of(lambda n, total, below, lo, hi: -(-(hi - lo + 1) // BINS))}
        inside = rows.select("node", "size", *(c.alias(k) for k, c in places.items()), F.array(*DIMENSIONS).alias("keys")).withColumn("key", F.get("keys", F.col("dimension").cast("int")))
        inside = inside.withColumn("bin", F.expr("(key - lo) div width")).where((F.col("key") >= F.col("lo")) & F.col("bin").between(0, BINS - 1))
        bins = inside.groupBy("node", "bin").agg(F.sum("size").alias("bytes"), F.min("key").alias("least"), F.max("key").alias("most"))
        running = bins.withColumn("upto", of(lambda n, total, below, *_: below) + F.sum("bytes").over(Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))  # BINS rows a node
        passed = running.where(F.col("upto") * of(lambda n, *_: n.last - n.first) > of(lambda n, total, *_: total * n.lead))
        first = passed.groupBy("node").agg(F.min_by(F.struct("least", "most", (F.col("upto") - F.col("bytes")).alias("below")), "bin").alias("bin"))
        found = {r["node"]: r["bin"] for r in first.collect()}  # a row for each open node
        again = []
        for n, total, _, _, _ in todo:
            b = found[n.first]
            if b["least"] == b["most"]:  # one key holds the point: it goes right
                n.cut = b["least"] - 1
            else:
                again.append((n, total, b["below"], b["least"], b["most"]))
        todo = again


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; size is the text's bytes plus 16.

    A null text is empty; null metadata counts as empty. Rows that agree in all that is returned share a
    key and so a shard. Rows of equal texts with different ids need not: a group of copies can outweigh a
    shard, and shards of near equal bytes come first. Slots count from 0 without gaps in each shard, by bucket of the id's hash, id and
    checksum. An empty table gives no rows. Further columns are left behind.
    """
    rows = keyed(docs)
    tree = build(rows, shards)
    buckets = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.select("doc_id", "size", "text_crc32", _leaf(tree).alias("shard"), F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int").alias("bucket"))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    return placed.withColumn("within", within).join(before, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"))
