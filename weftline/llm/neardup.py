"""Near-duplicate documents by HyperMinHash registers, banding and exact confirmation.

A document's set holds the hashes of its distinct word shingles. One hash pass fills 256 buckets; each
keeps its minimum as a leading-zero count and ten mantissa bits, 16 bits in all, and an empty bucket
borrows from a bucket drawn by a fixed table. Bands of five registers propose candidates; candidates
whose Jaccard estimate, corrected for chance collisions of registers, can't reach the threshold go, and
the rest are confirmed on the full sets of shingles.

Documents with equal sets are one node. Nobody lists all pairs of a bucket: its members are held against
one hub, which makes most of them one component, and only members that are still in different components
are compared on their sets, in cells of bounded size, each of which returns spanning links only.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import durable, slices

#: Registers of a signature, and registers in a band.
REGISTERS = 256
BAND = 5
BANDS = REGISTERS // BAND
#: Mantissa bits of a register.
MANTISSA = 10
#: A candidate whose corrected estimate is this far below the threshold goes: six deviations and more.
SLACK = 0.2
#: Bytes of text on either side of a cell in which guests of a group are compared.
CELL = 4_000_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def words(text: str) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space: bytes' own lower() and split() do just that."""
    return text.encode().lower().split()


def shingles(text: str, width: int = 2) -> set[tuple[bytes, ...]]:
    """The full set: distinct runs of `width` words, or all words as one if there are fewer."""
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(width)), strict=False))


def shingle_hashes(text: str, known: _WordHashes, width: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
    size = min(width, len(w))
    out = np.full(len(w) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = _mixed(out * _MIX[0] + h[i : len(h) - size + 1 + i])
    return np.unique(out)


def _donors() -> np.ndarray:
    """Row t, column j: the bucket that an empty bucket j asks at its t-th try. Fixed for all documents."""
    return np.random.Generator(np.random.PCG64(20)).integers(0, REGISTERS, size=(1024, REGISTERS))


def registers(sets: list[np.ndarray], donors: np.ndarray) -> np.ndarray:
    """One row of 16-bit registers for each sorted set; an empty set's row is all zero."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    full = np.zeros((len(sets), REGISTERS), dtype=bool)
    for i, u in enumerate(sets):
        if len(u):
            bucket = (u >> np.uint64(56)).astype(np.int64)
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))  # sets are sorted: the minimum
            value = (u[first] & np.uint64((1 << 56) - 1)) | np.uint64(1 << 10)
            top = np.frexp(value.astype(np.float64))[1] - 1
            mantissa = (value >> (top - MANTISSA).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
            out[i, bucket[first]] = ((56 - top).astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
            full[i, bucket[first]] = True
    row, col = np.nonzero(~full & full.any(axis=1)[:, None])
    for t in range(len(donors)):
        if not len(row):
            break
        donor = donors[t, col]
        hit = full[row, donor]
        out[row[hit], col[hit]] = out[row[hit], donor[hit]]
        row, col = row[~hit], col[~hit]
    for i, j in zip(row, col, strict=True):  # as good as never
        out[i, j] = out[i, next(k % REGISTERS for k in range(j, j + REGISTERS) if full[i, k % REGISTERS])]
    return out


def chance(n_a, n_b):
    """Expected share of registers that agree though the minima differ (mantissa collisions).

    Two different minima fall on one leading-zero count with about one chance in two to three, and then
    on one mantissa out of 2^10; sizes further apart agree less often.
    """
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (small / np.maximum(large, 1)) / (3 * (1 << MANTISSA))


def estimate(sig_a: np.ndarray, sig_b: np.ndarray, n_a, n_b) -> np.ndarray:
    """Collision-corrected Jaccard estimates of rows of registers."""
    share = (sig_a == sig_b).mean(axis=1)
    by_chance = chance(n_a, n_b)
    return np.clip((share - by_chance) / (1 - by_chance), 0, 1)


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    known, donors = _WordHashes(), _donors()
    for batch in slices(batches):
        sets = [shingle_hashes(t, known, width) for t in batch.column(1).to_pylist()]
        sigs = registers(sets, donors)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], type=pa.binary()), pa.array([len(s) for s in sets], type=pa.int64()), pa.array([r.tobytes() for r in sigs], type=pa.binary())],
            names=["doc_id", "node", "n", "sig"],
        )


def _likely(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 4000):
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, REGISTERS) for c in ("sig_a", "sig_b"))
            keep = estimate(a, b, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()) >= threshold - SLACK
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _confirm(batches: Iterator[pa.RecordBatch], percent: int, width: int) -> Iterator[pa.RecordBatch]:
    recent: OrderedDict[bytes, set] = OrderedDict()  # hubs come again and again

    def full(node: bytes, text: str) -> set:
        if node in recent:
            recent.move_to_end(node)
            return recent[node]
        recent[node] = found = shingles(text, width)
        if len(recent) > 8:
            recent.popitem(last=False)
        return found

    for batch in slices(batches, 500):
        keep = []
        for a, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")), strict=True):
            x, y = full(a, text_a), shingles(text_b, width)
            both = len(x & y)
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over `links` (a, b), for each node that has a link.

    Every round takes the smallest root among a node's neighbours and jumps to that root's own; each is
    written before the next, so lineage stays short. Nothing but a count comes to the driver.
    """
    both = durable(links.select("a", "b").union(links.select("b", "a")).distinct(), label)
    roots = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), label)
    while True:
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lowered = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        jump = roots.select(F.col("node").alias("low"), F.col("root").alias("beyond"))
        new = durable(lowered.join(jump, "low", "left").select("node", "root", F.least("low", F.coalesce("beyond", "low")).alias("new")), label)
        if new.where("new <> root").isEmpty():
            return new.select("node", F.col("new").alias("root"))
        roots = new.select("node", F.col("new").alias("root"))


def find(docs: DataFrame, percent: int = 80, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Texts of Jaccard similarity of at least percent/100 over their full sets are linked; component_id is
    the smallest id reachable. Null and empty texts, and texts without a word, have an empty set and no
    link. Rows that repeat an id and its text fare alike; a row without an id can be linked but names no
    component. An empty table gives no rows. Columns of other names are left behind.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = durable(source.mapInArrow(lambda b: _sign(b, width), "doc_id long, node binary, n long, sig binary"), "signatures")
    # the sets are equal where the fingerprint is: one node, whatever the number of copies
    nodes = durable(signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")
    links = _links(source, nodes, percent, width)
    named = signed.select("doc_id", "node", "n")
    if links is None:
        own = nodes.select("node", F.col("first_id").alias("component_id"))
    else:
        at = nodes.select("node", "first_id").join(components(links), "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
        own = durable(at.join(at.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("node", "component_id"), "own")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.join(own, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(source: DataFrame, nodes: DataFrame, percent: int, width: int) -> DataFrame | None:
    """(a, b): confirmed links whose components are those of all links; None without any bucket."""
    # two different sets of sizes k-1 and k share (k-1)/k at most: smaller sets can only equal another
    least = next((k - 1 for k in range(2, 101) if 100 * (k - 1) >= percent * k), 100)
    size = 2 * BAND
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.substring(F.col("sig"), i * size + 1, F.lit(size)), i))
    banded = nodes.where(F.col("n") >= least).select("node", F.explode(keys).alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    members = durable(banded.join(shared, "key").select("key", "node", "times"), "buckets")
    # the hub of a bucket is its member that meets most others in all its buckets: the original of a group
    # of edited copies is nearer to each of them than they are to one another
    met = durable(members.groupBy("node").agg(F.sum("times").alias("met")), "met")
    hubs = members.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node"))["node"].alias("hub"))
    members, hubs = members.select("key", "node"), durable(hubs, "hubs")
    pairs = members.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    sigs = nodes.select("node", "n", "sig")
    a = sigs.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    b = sigs.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    likely = durable(pairs.join(b, "b").join(a, "a").where(sized).mapInArrow(lambda x: _likely(x, percent / 100), "a binary, b binary"), "likely")
    if met.isEmpty():
        return None
    texts = _texts(source, nodes, met.select("node"), width)
    ta, tb = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    links = durable(likely.join(tb, "b").join(ta, "a").mapInArrow(lambda x: _confirm(x, percent, width), "a binary, b binary"), "links")
    roots = components(links)
    return links.union(_across(members, hubs, roots, texts, percent, width))


def _across(members: DataFrame, hubs: DataFrame, roots: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links between members of one bucket that the hubs left in different components.

    The component of a bucket's hub is a group; the bucket's members outside of it are its guests, those
    inside its residents. Every pair of a bucket that isn't in one component is a guest and a resident, or
    two guests, of one group. Buckets without a guest are done. Of the others, guests are held against the
    members of their own buckets, in cells of bounded size, on full sets; a cell returns links that join
    components, so fewer than it has nodes.
    """
    root_of = lambda df, c, name: df.join(roots.select(F.col("node").alias(c), F.col("root").alias(name)), c, "left").withColumn(name, F.coalesce(name, c))
    at = durable(root_of(members, "node", "root").join(durable(root_of(hubs, "hub", "grp"), "groups").select("key", "grp"), "key"), "met-in")
    unsettled = at.where("root <> grp").select("key").distinct()
    # a node's buckets that aren't settled: BANDS numbers at most
    everyone = at.join(unsettled, "key", "left_semi").groupBy("grp", "node").agg(F.first("root").alias("root"), F.collect_set("key").alias("keys"))
    everyone = everyone.withColumn("guest", F.col("root") != F.col("grp"))
    # a cell holds about CELL bytes of text on either side, so a group of any size is many cells
    everyone = durable(everyone.join(texts, "node").withColumn("bytes", F.octet_length("text")), "held")
    sizes = everyone.groupBy("grp").agg(
        F.ceil(F.sum("bytes") / CELL).cast("int").alias("wide"), F.ceil(F.sum(F.when(F.col("guest"), F.col("bytes"))) / CELL).cast("int").alias("high")
    )
    dealt = everyone.join(durable(sizes, "sizes"), "grp")
    spread = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    right = dealt.select("grp", spread("wide", 1).alias("col"), F.explode(F.sequence(F.lit(0), F.col("high") - 1)).alias("row"), "node", "root", "keys", "text")
    left = dealt.where("guest").select("grp", F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("col"), spread("high", 2).alias("row"), "node", "root", "keys", "text")

    def meet(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        found = _first_links(ask, have, percent, width)
        return pd.DataFrame(found, columns=["a", "b"])

    key = ["grp", "col", "row"]
    left = left.select(*(F.col(c).alias(c) for c in left.columns))  # columns of its own, not those of `right`
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, "a binary, b binary")


def _first_links(ask: pd.DataFrame, have: pd.DataFrame, percent: int, width: int) -> list[tuple[bytes, bytes]]:
    """Links between `ask` and `have` that join components not joined yet: fewer than there are nodes.

    Held against one another are nodes of different components that share a bucket (an element of
    `keys`). Hashes of shingles choose, the full sets confirm.
    """
    if not len(ask) or not len(have):
        return []
    known = _WordHashes()
    sets = [shingle_hashes(t, known, width) for t in have["text"]]
    sizes = np.array([len(s) for s in sets])
    ids, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    nodes, roots, texts = list(have["node"]), list(have["root"]), list(have["text"])
    up = {r: r for r in [*roots, *ask["root"]]}
    in_bucket: dict[int, list[int]] = {}
    for i, keys in enumerate(have["keys"]):
        for k in keys:
            in_bucket.setdefault(k, []).append(i)

    def top(r: bytes) -> bytes:
        while up[r] != r:
            up[r] = r = up[up[r]]
        return r

    out = []
    for node, root, keys, text in zip(ask["node"], ask["root"], ask["keys"], ask["text"]):
        met = np.unique(np.array([i for k in keys for i in in_bucket.get(k, ())], dtype=np.int64))
        own = shingle_hashes(text, known, width)
        met = met[100 * np.minimum(sizes[met], len(own)) >= percent * np.maximum(sizes[met], len(own))]
        met = met[[top(roots[i]) != top(root) for i in met]] if len(met) else met
        if not len(met):
            continue
        at = np.searchsorted(ids, own)
        at = at[(at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == own)]
        present = np.zeros(len(ids), dtype=np.int64)
        present[at] = 1
        both = np.array([present[flat[begin[i] : ends[i]]].sum() for i in met])
        full = None
        for i in met[100 * both >= percent * (len(own) + sizes[met] - both)]:
            a, b = top(root), top(roots[i])
            if a != b:
                full = shingles(text, width) if full is None else full
                other = shingles(texts[i], width)
                common = len(full & other)
                if 100 * common >= percent * (len(full) + len(other) - common):
                    up[b] = a
                    out.append((node, nodes[i]))
    return out


def _texts(source: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, text), one text for each wanted node; any text of a node has its set."""
    # found by the id of the node's first row, so that texts are hashed again only where an id has several
    rows = wanted.join(nodes.select("node", F.col("first_id").alias("first")), "node")
    return durable(
        source.join(rows, F.col("doc_id").eqNullSafe(F.col("first"))).select("node", "text")
        .mapInArrow(lambda x: _of_node(x, width), "node binary, text string")
        .groupBy("node").agg(F.min("text").alias("text")),
        "texts",
    )


def _of_node(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """An id can have several texts: keep those whose set is the node's."""
    known = _WordHashes()
    for batch in slices(batches):
        keep = [hashlib.md5(shingle_hashes(t, known, width).tobytes()).digest() == n for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield batch.filter(pa.array(keep, type=pa.bool_()))
