"""Operators against brute force, exact round trips and held-out labels, with awkward rows."""

import base64
import collections
import hashlib
import itertools
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import ann, bpe, flac, kdshards, linechunks, neardup, oracles, packing, quality, queries, toxicity, urltree
from weftline.llm.common import READ_ROWS, labelled_sample
from weftline.llm.linear import sparse

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, removed string, node string"


def awkward(spark, rows=None):
    """Null ids and texts, an empty, a blank and a very long text, repeated rows, clashing columns."""
    if rows is None:
        line = " ".join(f"w{i}" for i in range(60))
        rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "a null id\nhas two lines\nor three"), (6, line), (7, f"before\n{line}\nafter"), (8, "word " * 60_000), (9, "é日本🎉 <|endoftext|> don't\n\n x")]
    return spark.createDataFrame([(i, t, None, None, None, 0.5, True, "x", "y") for i, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_bpe_by_ranks_equals_the_vocabulary_on_very_long_white_space(spark):
    texts = ["a " + " " * 1_000_000, "\n" * 1_000_000 + "b <|endoftext|> é", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(bpe.Vocabulary.load(bpe.default_vocabulary()).encode(texts)))
    assert {r["doc_id"]: r["ids"] for r in bpe.encode(docs).collect()} == want
    assert {r["doc_id"]: r["ids"] for r in bpe.encode(docs, bpe.default_vocabulary()).collect()} == want
    assert {r["doc_id"]: r["tokens"] for r in packing.counted(docs).collect()} == {i: len(x) + 1 for i, x in want.items()}


def test_bpe_agrees_with_ranks_and_decodes(spark):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = awkward(spark)
    rows = bpe.encode(docs, offsets=True).collect()
    texts = [r["text"] or "" for r in docs.collect()]
    assert sorted(map(str, (r["ids"] for r in rows))) == sorted(str(known.encode_ordinary(t)) for t in texts)
    vocabulary = bpe.Vocabulary.load(bpe.default_vocabulary())
    for r in rows:
        text = next(t for t in texts if known.encode_ordinary(t) == r["ids"])
        assert vocabulary.decode_bytes(r["ids"]) == text.encode()
        for i, b, a, e in zip(r["ids"], r["byte_start"], r["char_start"], r["char_end"]):
            piece = vocabulary.bytes_of[i]
            assert text.encode()[b : b + len(piece)] == piece and piece in text[a:e].encode()
        assert "".join(bpe.split_stream(vocabulary.bytes_of[i] for i in r["ids"])) == text
    digests = {r["ids_sha256"] for r in bpe.digests(bpe.encode(docs)).collect()}
    assert hashlib.sha256(" ".join(map(str, known.encode_ordinary("one"))).encode()).hexdigest() in digests
    assert bpe.encode(empty(spark)).count() == 0


def test_decoding_odd_ids(spark):
    rows = spark.createDataFrame([(1, [15496, None, 99, 10**6, -5]), (2, None), (3, []), (4, [447, 119])], "doc_id int, ids array<int>").coalesce(1)
    known = bpe.Vocabulary.load(bpe.default_vocabulary()).bytes_of
    raw = {r["doc_id"]: bytes(r["raw"]) for r in bpe.decode(rows).collect()}
    assert raw == {1: known[15496] + known[99], 2: b"", 3: b"", 4: known[447] + known[119]}
    assert list(bpe.split_stream([b"\xe6\x97", b"\xa5x", b"\xff"])) == ["", "日x", "\ufffd", ""]


def test_byte_table_is_a_bijection():
    assert sorted(bpe.byte_of_char().values()) == list(range(256))


@pytest.mark.parametrize("seed", range(30))
def test_packing_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    sizes = (8, 16, 32) if seed % 2 else packing.CAPACITIES
    histogram = {r.randint(1, max(sizes)): r.randint(1, 40) for _ in range(r.randint(0, 40))}
    runs = packing.best_plan(histogram, sizes)
    length = np.array([n for n, k in histogram.items() for _ in range(k)], dtype=np.int64)
    rank = np.array([i for k in histogram.values() for i in range(k)], dtype=np.int64)
    held = collections.defaultdict(list)
    for n, b, o, s in zip(length, *packing.Places.of(runs).look_up(length, rank)):
        held[b].append((o, n, s))
    for pieces in held.values():
        at = 0
        for o, n, s in sorted(pieces):
            assert o == at
            at += n
        assert s == next(c for c in sizes if c >= at)  # downsized


@pytest.mark.parametrize("seed", range(20))
def test_packing_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    histogram = {r.randint(1, 32): r.randint(1, 20) for _ in range(12)}
    rooms = []
    for n in sorted((n for n, k in histogram.items() for _ in range(k)), reverse=True):
        at = min((i for i, room in enumerate(rooms) if room >= n), key=lambda i: rooms[i], default=None)
        if at is None:
            rooms.append(32 - n)
        else:
            rooms[at] -= n
    assert sorted(x.left for x in packing.plan(histogram, (8, 16, 32), 32) for _ in range(x.bins)) == sorted(rooms)


def token_counts(texts):
    """Tokens of each text by the public ranks, and an end mark."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [len(known.encode_ordinary(t or "")) + 1 for t in texts]


def test_packing_covers_documents(spark):
    docs = awkward(spark)
    rows = packing.pack(docs).collect()
    got, want = collections.Counter(), collections.Counter()
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
    given = docs.collect()
    for r, n in zip(given, token_counts(r["text"] for r in given)):
        want[r["doc_id"]] += n
    assert got == want
    assert len({(r["bin_id"], r["bin_offset"]) for r in rows}) == len(rows)
    assert packing.pack(empty(spark)).count() == 0
    ready = packing.pack(docs.withColumn("n", F.lit(10_000)), tokens="n").collect()
    assert collections.Counter(r["n_tokens"] for r in ready) == {8192: docs.count(), 1808: docs.count()}


@pytest.mark.parametrize("seed", range(12))
def test_openings_are_the_best_of_all(seed):
    """Against every choice of an opening for each length, by a plain best fit over single pieces."""
    r = random.Random(seed)
    sizes = (8, 16, 32)
    histogram = {n: r.randint(1, 9) for n in r.sample(range(1, 33), 4)}
    pieces = sorted((n for n, k in histogram.items() for _ in range(k)), reverse=True)

    def cost_of(opens):
        rooms = []  # (room, size)
        for n in pieces:
            at = min((i for i, (room, _) in enumerate(rooms) if room >= n), key=lambda i: rooms[i][0], default=None)
            if at is None:
                rooms.append((opens[n] - n, opens[n]))
            else:
                rooms[at] = (rooms[at][0] - n, rooms[at][1])
        return sum(packing.cost(next(s for s in sizes if s >= size - room)) for room, size in rooms)

    choices = [[s for s in sizes if s >= n] for n in histogram]
    least = min(cost_of(dict(zip(histogram, c))) for c in itertools.product(*choices))
    assert packing.total_cost(packing.best_plan(histogram, sizes)) <= least * (1 + 1e-9)


def test_least_cost_opening_beats_one_floor():
    histogram = {1000: 700, 1100: 700}
    sizes = sorted(packing.CAPACITIES)
    floors = [packing.total_cost(packing.shrink(packing.plan(histogram, sizes, s))) for s in sizes]
    own = packing.plan(histogram, sizes, packing.least_cost(histogram, sizes))
    assert packing.total_cost(packing.shrink(own)) == 1_662_400 < min(floors)
    r = random.Random(2)
    wide = {n: r.randint(1, 30) for n in r.sample(range(1, 8193), 900)}
    floors = [packing.total_cost(packing.shrink(packing.plan(wide, sizes, s))) for s in sizes]
    assert packing.total_cost(packing.best_plan(wide)) <= min(floors)


def test_toxicity_swaps_and_scores(spark):
    insults, plain = ["idiot", "scum"], ["field", "river", "stone", "house"]
    r = random.Random(1)
    rows, marks = [], []
    for i in range(300):
        bad = i % 3 == 0
        who = r.choice(["women", "men", "muslims", "christians"])
        rows.append((i, f"the {who} " + " ".join(r.choices(plain, k=6)) + (f" {r.choice(insults)}" if bad else "")))
        marks.append((i, int(bad)))
    docs, labels = awkward(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    probe = awkward(spark, [(1, "women field"), (2, "men field"), (3, "muslims scum"), (4, None), (None, "x")])
    s = {x["doc_id"]: x["score"] for x in toxicity.score(probe, model).collect()}
    assert s[3] >= 0.5 > max(s[1], s[2], s[4]) and abs(s[1] - s[2]) < 0.1 and len(s) == 5
    assert toxicity.features("the women", swapped=True) == toxicity.features("the men")
    assert toxicity.score(empty(spark), model).count() == 0
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert all(0 <= x["score"] < 0.5 for x in toxicity.score(probe, none).collect())


@needs_data
def test_classifiers_on_held_out_labels(spark):
    at = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    tox = toxicity.score(known, toxicity.train(docs, labels)).join(labels, "doc_id").select((F.col("score") >= 0.5) == (F.col("toxic") == 1)).collect()
    assert sum(r[0] for r in tox) / len(tox) > 0.97
    good = quality.score(known, quality.train(docs, labels)).join(labels, "doc_id").select((F.col("score") >= 0.3) == (F.col("quality") == 1)).collect()
    assert sum(r[0] for r in good) / len(good) > 0.97


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    rng = random.Random(5)
    make = lambda good: " ".join(rng.choice(["plain", "words", "tell", "it", "well"] if good else ["xq", "zz", "!!", "buy", "##"]) for _ in range(30))
    rows = [(i, make(i % 3 > 0)) for i in range(1500)] + [(1500, "plain words " * 250_000), (1501, None)]
    docs = spark.createDataFrame([*rows, (3, "plain " * 90), (None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows] + [(3, None), (None, 1)], "doc_id long, quality int")
    mine = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5}
    got = quality.labelled(docs, labels).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(mine) and all(r["y"] == int(r["doc_id"] % 3 > 0) for r in got)
    assert 1500 in mine or 1501 in mine  # the long text or the missing one
    monkeypatch.setattr(quality, "LEAST_ROWS", 100)
    seen = []
    monkeypatch.setattr(quality, "_cut", lambda m, grid, kept, caught, spread, f=quality._cut: (seen.append((kept, caught)), f(m, grid, kept, caught, spread))[1])
    for block_rows in (8000, 200):
        model = quality.train(docs, labels, block_rows)
        known = [(r["doc_id"] % 3 > 0, r["score"] >= quality.CUT) for r in quality.score(docs.where("doc_id < 1500"), model).collect()]
        assert sum(a == b for a, b in known) / len(known) > 0.99
    for kept, caught in seen:  # shares of all rows of a class, not of some
        good = sum(i % 3 > 0 for i in mine)
        assert np.allclose(kept * good, np.round(kept * good)) and np.allclose(caught * (len(mine) - good), np.round(caught * (len(mine) - good)))


def test_packed_features_come_back():
    for text in ("", "one", "é日本🎉 " * 40_000, " ".join(str(i) for i in range(30_000)) + " a" * 999):
        place, value = quality.evidence([text])[1][0]
        got = quality.unpacked(quality.packed(place, value), len(place))
        assert (got[0] == place).all() and (got[1] == value.astype(np.float32)).all()


def test_quality_awkward_rows(spark):
    docs = awkward(spark)
    model = quality.fit(np.zeros((0, len(quality.NAMES))), [], np.zeros(0))
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(empty(spark), model).count() == 0


def closure(rows, percent=80, width=2):
    """Components by all pairs, for rows of (doc_id, text)."""
    sets = [(i, neardup.shingles(t or "", width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), (least.get(find(k)) if s else i)) for k, (i, s) in enumerate(sets) if i is not None)


def components_of(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect() if r["doc_id"] is not None)


def test_near_duplicates_awkward_rows(spark):
    docs = awkward(spark)
    assert components_of(neardup.find(docs)) == closure([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert neardup.find(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_against_all_pairs(spark, seed):
    """Chains of edits, at sizes where one shingle decides, whose ends aren't alike."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=3))
    rows = []
    for size in [4, 5, 6, 7, 10, 20, 40, 80, 200] * 4:
        base = [word() for _ in range(size)]
        for _ in range(6):
            rows.append((len(rows), " ".join(base)))
            base = list(base)
            for _ in range(max(1, size // 20)):
                base[r.randrange(size)] = word()
            if r.random() < 0.3:
                base = base[1:] + [word()]
    r.shuffle(rows)
    assert components_of(neardup.find(awkward(spark, rows))) == closure(rows)


@needs_data
def test_near_duplicates_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert components_of(neardup.find(docs)) == closure([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_registers_estimate_similarity():
    r = np.random.default_rng(3)
    both, donors = r.integers(0, 2**63, 4000, dtype=np.uint64), neardup._donors()
    for share in (0.2, 0.5, 0.8):
        n = int(1000 * 2 * share / (1 + share))
        a, b = np.unique(both[:1000]), np.unique(np.concatenate([both[:n], both[2000 : 3000 - n]]))
        sig = neardup.registers([a, b], donors)
        assert abs(neardup.estimate(sig[:1], sig[1:], len(a), len(b))[0] - share) < 0.12


def test_neighbours_with_repeated_ids(spark):
    """More ids than anchors; the nearest ids fill a block with copies and with other vectors of their own."""
    r = np.random.default_rng(6)
    x = r.standard_normal((1500, 8))
    near = np.array([9.0] + [0.0] * 7) + r.standard_normal((30, 8)) / 10
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, v.tolist()) for i, v in enumerate(near) for _ in range(25)]
    rows += [(2000 + i, (v * (1 - j / 1000)).tolist()) for i, v in enumerate(near) for j in range(1, 25)]
    query = [(-1, [1.0] + [0.0] * 7)]
    vectors, asked = (spark.createDataFrame(t, "vec_id long, embedding array<double>") for t in (rows, query))
    best = {}
    for i, v in rows:
        best[i] = max(best.get(i, -np.inf), v[0])
    want = sorted(best, key=lambda i: (-best[i], i))[:20]
    assert [n["vec_id"] for n in sorted(ann.search(vectors, asked, probe=1.0).collect(), key=lambda n: n["rank"])] == want
    ids, data = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    norm2 = float((data**2).sum(axis=1).max()) * (1 + 1e-12)
    _, col, _ = ann.scan(ids, data, norm2, np.array([-1]), np.array(query[0][1])[None, :], 20, ann.rotation(9), np.array([-np.inf]))
    assert list(ids[col]) == want


def expected_lines(rows):
    """Every removable chunk but the first of its bytes, by id, text hash and line."""
    return {c: n for c, n in collections.Counter(data for _, t in set(rows) for _, _, data in linechunks.removable(t or "")).items() if n > 1}


def test_line_chunks(spark):
    docs = awkward(spark)
    rows = linechunks.dedup(docs).collect()
    assert len(rows) == docs.count() and "removed" in docs.columns
    text = {r["doc_id"]: r["text"] for r in rows}
    assert text[1] is None and text[7] == "before\nafter" and text[6] and text[5] == "one" and text[None].startswith("a null id")
    assert linechunks.dedup(empty(spark)).count() == 0


@needs_data
def test_line_chunks_leave_one_of_each(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]
    repeats = expected_lines(before)
    assert repeats
    gone = 0
    texts = dict(before)
    found = collections.Counter()
    for r in linechunks.dedup(docs).collect():
        lines = texts[r["doc_id"]].split("\n")
        drop = {i for s in r["removed"] for i in range(s["a"], s["b"])}
        assert r["text"] == "\n".join(x for i, x in enumerate(lines) if i not in drop)
        for s in r["removed"]:
            found["\n".join(lines[s["a"] : s["b"]]).encode()] += 1
            gone += 1
    assert found == {c: n - 1 for c, n in repeats.items()} and gone


def test_line_runs_against_brute_force(spark):
    """Repeated runs of fifty words in short lines, between lines that stand nowhere else."""
    r = random.Random(8)
    line = lambda n: " ".join(f"{r.choice('abc')}{r.randrange(10**9)}" for _ in range(n))
    passages = [[line(r.choice([9, 20, 20, 30])) for _ in range(k)] + [line(25), line(25)] for k in (1, 1, 2, 3, 4, 8) for _ in range(6)]
    texts, own = [], []
    for _ in range(60):
        held = r.sample(passages, 3)
        alone = [[line(r.choice([1, 5, 20])) for _ in range(r.randrange(1, 4))] for _ in range(4)]
        own.append(sum(alone, []))
        texts.append(sum((a + p for a, p in zip(alone, held)), []) + alone[3])
    same = line(20)
    texts.append([same] * 7)
    rows = linechunks.dedup(awkward(spark, [(i, "\n".join(t)) for i, t in enumerate(texts)])).collect()
    left = {x["doc_id"]: x["text"].split("\n") for x in rows}
    seen = collections.Counter()
    for i, t in left.items():
        words = [len(x.split()) for x in t]
        seen.update("\n".join(t[a:b]) for a in range(len(t)) for b in range(a + 1, len(t) + 1) if sum(words[a:b]) >= 50)
    assert max(seen.values()) == 1
    for i, lines in enumerate(own):
        assert [x for x in left[i] if x in set(lines)] == lines
    for p in passages:
        holders = [i for i, t in enumerate(texts) if p[0] in t]
        assert [i for i in holders if p[0] in left[i] or p[-1] in left[i]] == holders[:1]
        assert not holders or "\n".join(p) in "\n".join(left[holders[0]])
    assert left[60] == [same] * 3


def test_lines_that_stay_are_spared():
    assert linechunks.spared([(1, 4, 7), (2, 5, 8)], [(0, 3)]) == [(3, 4), (3, 5)]
    assert linechunks.spared([(1, 4, 7)], [(2, 3), (8, 9)]) == [(1, 4)]  # within what goes: whole where that stays
    assert linechunks.spared([(1, 4, 7), (3, 6, 7)], [(2, 5)]) == [(1, 4), (3, 6)]  # the two are one at the source


def test_chunks_resist_shifts():
    r = random.Random(5)
    body = [f"line {r.random()}".encode() for _ in range(40)]
    cut = lambda lines: {b"\n".join(lines[a:b]) for a, b, _ in linechunks.chunks(lines)}
    assert len(cut(body) & cut([b"new", b"lines", *body])) >= len(cut(body)) - 2


def test_flac_round_trip_and_checksums():
    r = random.Random(2)
    texts = ["", "a", "x" * 191, "x" * 192, "x" * 193, "é" * 5000, "日本" * 40_000, *("".join(chr(r.randrange(1, 255)) for _ in range(r.randrange(1, 4000))) for _ in range(40))]
    payloads = [flac.payload(t) for t in texts]
    streams = flac.encode_streams(payloads)
    blocks = flac.decode_streams(streams)
    for p, own in zip(payloads, blocks):
        assert b"".join(b for _, b in own) == p
        assert all(p[o : o + len(b)] == b for o, b in own)  # seekable
    bare = [s[:4] + b"\x80" + s[5:42] + s[flac._metadata(s)[3] :] for s in streams]  # without a seek table
    assert flac.decode_streams(bare) == blocks
    for s in streams[-40:]:
        bad = bytearray(s)
        bad[r.randrange(flac._metadata(s)[3], len(s))] ^= 1 << r.randrange(8)
        with pytest.raises(flac.Corrupt):
            flac.decode_streams([bytes(bad)])


@pytest.mark.parametrize("order", range(5))
def test_flac_fixed_predictors(order):
    n = np.arange(1024)
    x = np.stack([(20 * np.sin(n / 30 + k)).astype(np.int32) for k in range(3)])
    frames = flac._encode_group(x, [flac._header(1024, k) for k in range(3)], flac._FIXED + order)
    data = np.frombuffer(b"".join(frames), dtype=np.uint8)
    starts = np.cumsum([0] + [len(f) for f in frames])
    out, ends = flac.decode_frames(data, starts[:-1], starts[1:])
    assert (np.stack(out).astype(int) - 128 == x).all() and list(ends) == list(starts[1:])


def test_flac_columns(spark):
    docs = awkward(spark)
    media = flac.encode(docs)
    rows = flac.decode(media).collect()
    assert sorted(str(bytes(r["pcm"])) for r in rows) == sorted(str(flac.payload(r["text"] or "")) for r in docs.collect())
    assert flac.blocks(media).where("doc_id = 8").count() == -(-len(flac.payload("word " * 60_000)) // flac.BLOCK)
    assert flac.decode(flac.encode(empty(spark))).count() == 0


def plain_url(url, rules=urltree.RULES):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(r, w) for w, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, *max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_url_rules_and_templates(spark):
    urls = [None, "", "no scheme", "http://A.ORG", "http://a.org/", "https://X.example.org/es/1", "http://example.org/en/12?q#f", "http://example.org/en/2", "http://notorg/x", "http://m.com/fr/", "http://com/de/x", "a://b://c.org/x", "http://É.ORG/É"]
    urls += [f"http://h.net/p/{i}.html" for i in range(40)] + [f"http://h.net/bad/{i}" for i in range(60)]
    pages = spark.createDataFrame([*enumerate(urls), (0, None)], "page_id long, url string").withColumn("host", F.lit("clash"))
    evidence = spark.createDataFrame([(i, int(i < 60)) for i in range(0, 60)], "document long, bad int")
    rows = urltree.judge(pages, evidence).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        host, path, rule, verdict = plain_url(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
    by = {r["page_id"]: r for r in rows}
    assert by[20]["template"] == "/p/*.html" and by[100]["template"] == "/bad/*" and by[100]["verdict"] == "block"
    assert urltree.judge(pages.limit(0), evidence).count() == 0
    assert {r["verdict"] for r in urltree.judge(pages, evidence.limit(0)).collect()} <= {"allow", "block"}


def test_shards_divide_bytes(spark):
    r = random.Random(4)
    rows = [(i, "x" * r.randrange(2000)) for i in range(3000)] + [(None, None), (7, "same"), (7, "same")]
    done = kdshards.shard(awkward(spark, rows), 13).collect()
    assert len(done) == len(rows)
    total, slots = collections.Counter(), collections.defaultdict(list)
    for x in done:
        total[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
    assert sorted(total) == list(range(13)) and max(total.values()) - min(total.values()) < 0.05 * sum(total.values()) / 13
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(x["text_crc32"] in (zlib.crc32((t or "").encode()) for i, t in rows if i == x["doc_id"]) for x in done[:50])
    assert kdshards.shard(empty(spark), 13).count() == 0
    assert kdshards.shard(awkward(spark), 40).count() == awkward(spark).count()


def test_k_d_tree_matches_sorted_cuts(spark):
    """Each cut is the largest key with at most its share of the bytes at or below it."""
    rows = kdshards.keyed(awkward(spark, [(i, "y" * (i * 37 % 501)) for i in range(500)])).cache()
    tree = kdshards.build(rows, 5)
    data = [r.asDict() for r in rows.collect()]

    def walk(node, held):
        if node.left is None:
            return
        total, upto, cut = sum(r["size"] for r in held), 0, None
        for r in sorted(held, key=lambda r: r[node.dimension]):
            upto += r["size"]
            if upto * (node.last - node.first) > total * node.lead:
                cut = r[node.dimension]
                break
        left = [r for r in held if r[node.dimension] <= node.cut]
        assert left == [r for r in held if r[node.dimension] < cut]
        walk(node.left, left)
        walk(node.right, [r for r in held if r[node.dimension] > node.cut])

    walk(tree, data)


def test_nearest_neighbours(spark):
    r = np.random.default_rng(0)
    x = (r.standard_normal((600, 16)) * r.uniform(0.2, 2, (600, 1))).astype(np.float32)
    x[50:90] = x[50]  # copies tie
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (None, x[0].tolist()), (3, x[3].tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = collections.defaultdict(list)
    for row in sorted(ann.search(vectors, vectors.where("vec_id % 20 = 0"), k=10).collect()):
        got[row["query_id"]].append((row["vec_id"], row["score"]))
    y, hits = x.astype(float), 0
    for q in range(0, 600, 20):
        s = (y * y[q]).sum(axis=1)
        best = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:10]
        hits += len({i for i, _ in got[q]} & set(best))
        assert len(got[q]) == 10 and all(abs(v - s[i]) < 1e-9 for i, v in got[q])
    assert sorted(got) == list(range(0, 600, 20)) and hits >= 0.9 * 300
    assert ann.search(vectors.limit(0), vectors, k=5).count() == 0
    few = vectors.where("vec_id in (0, 1, 2)")
    assert ann.search(few, few.where("vec_id = 0"), k=10).count() == 2


def test_sample_is_bounded_by_rows_and_bytes(spark):
    rows = [(1, f"copy {i % 7}") for i in range(100_000)] + [(i, "y" * 3000) for i in range(2, 60)] + [(60, "z" * 20_000_000), (61, None), (62, "")]
    docs = awkward(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 63)] + [(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    held = {i for i in range(1, 63) if zlib.crc32(str(i).encode()) % 5 == 0}
    got = labelled_sample(docs, labels, "toxic").collect()
    ids = [r["doc_id"] for r in got]
    assert len(ids) == len(set(ids)) and set(ids) == set(range(1, 63)) - held - {60}
    few = labelled_sample(docs, labels, "toxic", per_class=2).collect()
    assert collections.Counter(r["y"] for r in few) == {0: 2, 1: 2}
    small = labelled_sample(docs, labels, "toxic", most_bytes=50_000).collect()
    assert all(sum(len(r["text"]) for r in small if r["y"] == y) <= 50_000 for y in (0, 1)) and len(small) >= 30
    assert labelled_sample(empty(spark), labels, "toxic").count() == 0


def confounded(seed=5):
    """Neutral words and a group's name that goes with the label."""
    r = random.Random(seed)
    plain = ["field", "river", "stone", "house"]
    for i in range(300):
        bad = int(i % 3 == 0)
        who = r.choice(["muslims", "jews"]) if bad else r.choice(["christians", "hindus"])
        yield f"the {who} " + " ".join(r.choices(plain, k=6)), bad


def test_counterfactual_fit_is_the_minimum():
    """Against plain proximal gradient on dense matrices with a step of its own."""
    rows = list(confounded())
    sample = [(np.array(toxicity.features(t), np.int32), np.array(toxicity.features(t, swapped=True), np.int32), y) for t, y in rows]
    places, seen = np.unique(np.concatenate([s[0] for s in sample]), return_counts=True)
    places = places[seen >= 2]
    x = np.array([np.isin(places, s[0]) for s in sample], float)
    swapped = np.array([np.isin(places, s[1]) for s in sample], float)
    y = np.array([s[2] for s in sample], float)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for weight in (0.0, 1.0, 10.0):

        def value(w, b):
            z = x @ w + b
            return (share * (np.logaddexp(0, z) - y * z)).sum() + toxicity.L2 / 2 * w @ w + weight * (((x - swapped) @ w) ** 2).mean() + toxicity.L1 * np.abs(w).sum()

        both = np.hstack([x, np.ones((len(x), 1))])
        step = 1 / (0.25 * np.linalg.norm(both.T @ (both * share[:, None]), 2) + toxicity.L2 + 2 * weight * np.linalg.norm((x - swapped).T @ (x - swapped) / len(x), 2))
        w, b = np.zeros(len(places)), 0.0
        for _ in range(30_000):
            z = x @ w + b
            g = share * (1 / (1 + np.exp(-z)) - y)
            w = w - step * (x.T @ g + toxicity.L2 * w + 2 * weight * (x - swapped).T @ ((x - swapped) @ w) / len(x))
            w, b = np.sign(w) * np.maximum(np.abs(w) - step * toxicity.L1, 0), b - step * g.sum()
        loss = toxicity.Loss(sample, places, toxicity.L2, weight)
        own = sparse(loss, toxicity.L1)
        assert abs(value(own[:-1], own[-1]) - value(w, b)) < 1e-3
        assert abs(loss.value(own) + toxicity.L1 * np.abs(own[:-1]).sum() - value(own[:-1], own[-1])) < 1e-9


def test_counterfactuals_close_the_gap_between_groups():
    sample = [(np.array(toxicity.features(t), np.int32), np.array(toxicity.features(t, swapped=True), np.int32), y) for t, y in confounded()]
    gap = {}
    for weight in (0.0, toxicity.COUNTERFACTUAL):
        model = toxicity.fit(sample, counterfactual=weight)
        a, b = (1 / (1 + np.exp(-model.logit(toxicity.features(t)))) for t in ("muslims field", "christians field"))
        gap[weight] = abs(a - b)
    assert gap[0.0] > 0.5 and gap[toxicity.COUNTERFACTUAL] < 0.05


def test_ranker_fits_its_pairs():
    """The gradient of the pairwise loss vanishes, and hashed features alone can tell texts apart."""
    r = random.Random(3)
    good, bad = ["lorem", "ipsum", "dolor", "sit"], ["spamm", "winnn", "clikk", "freee"]
    texts = [" ".join(r.choices(good if i % 2 else bad, k=12)) for i in range(120)]
    y = np.array([i % 2 for i in range(120)])
    figures, hashed = quality.evidence(texts)
    model = quality.fit(np.zeros_like(figures), hashed, y, pairs=2000)
    scores = model.probability(model.preference(np.zeros_like(figures), hashed))
    assert ((scores >= quality.CUT) == (y == 1)).all()
    whole = quality._grams("é日本🎉" * 60_000)  # more than a chunk
    codes = [ord(c) for c in "é日本🎉" * 60_000]
    assert whole.sum() == len(codes) - 2 and (quality._grams("é日本🎉" * 3)[whole == 0] == 0).all()


@pytest.fixture(scope="module")
def cloud():
    """Vectors without structure, the hardest case of a search by lists, and their queries."""
    r = np.random.default_rng(12)
    x = r.standard_normal((6000, 32)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_recall_on_thousands_of_vectors(spark, cloud):
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(cloud)], "vec_id long, embedding array<float>")
    got = collections.defaultdict(set)
    for r in ann.search(vectors, vectors.where("vec_id % 20 = 0")).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in range(0, 6000, 20):
        s = cloud.astype(float) @ cloud[q].astype(float)
        s[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-s)[:20]))
    assert hits >= 0.9 * 20 * 300


def lists_of(x, count):
    means = ann.centroids(x.astype(float), count)
    return means, ann.nearest(x.astype(float), means, 1)[:, 0]


def test_answers_come_from_the_scan(cloud, monkeypatch):
    x = cloud.astype(float)
    _, lists = lists_of(cloud, 8)
    ids, q = np.arange(len(x)), x[:40]
    ask = lambda: ann.answers(lists, ids, x, 1.0, ids[:40], q, [np.array([1, 3, 5])] * 40, np.full(40, -np.inf), 20, ann.rotation(33))
    row, col, score = ask()
    inside = np.flatnonzero(np.isin(lists, [1, 3, 5]))
    hits = 0
    for i in range(40):
        s = x[inside] @ q[i]
        s[inside == i] = -np.inf
        hits += len(set(col[row == i]) & set(inside[np.argsort(-s)[:20]]))
        assert np.allclose(score[row == i], x[col[row == i]] @ q[i])
    assert hits >= 0.97 * 800  # what the tests abandon by chance
    monkeypatch.setattr(ann, "scan", lambda *a: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
    assert not len(ask()[0])


def test_scan_abandons_most_candidates_early(cloud, monkeypatch):
    """With a bound, exact scores are computed for few pairs only, and none within the bound is lost but by chance."""
    x, ids, q = cloud.astype(float), np.arange(6000), cloud[:50].astype(float)
    s = x @ q.T
    s[np.arange(50), np.arange(50)] = -np.inf
    floor = np.sort(s, axis=0)[-20]
    row, col, _ = ann.scan(ids, x, 1.0, ids[:50], q, 20, ann.rotation(33), floor)
    want = {(i, int(c)) for i in range(50) for c in np.argsort(-s[:, i])[:20]}
    assert len(want & set(zip(row.tolist(), col.tolist()))) >= 0.95 * len(want)


def test_layout_cuts_large_lists_and_fills_blocks():
    r = np.random.default_rng(1)
    sizes = np.array([0, 5, 9000, 100, 300, 999, 1, 2500, 700])
    first, parts = ann.layout(r.standard_normal((9, 4)), sizes, 1000)
    assert list(parts) == [1, 1, 9, 1, 1, 1, 1, 3, 1]
    held = collections.Counter()
    for a, n, size in zip(first, parts, sizes):
        for b in range(n):
            held[a + b] += size / n
    assert max(held.values()) <= 1000


def test_vectors_of_several_lengths(spark):
    rows = [(1, [1.0]), (2, [0.5, 2.0]), (3, [0.0, 0.0, 3.0]), (20, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in sorted(ann.search(vectors, vectors.where("vec_id = 20")).collect(), key=lambda r: r["rank"])]
    assert got == [(1, 2, 2.5), (2, 1, 1.0), (3, 3, 0.0)]


def test_chunk_boundaries_by_their_definition():
    """A chunk ends where the hash of the last two lines is even, after two lines at least, whatever their length."""
    r = random.Random(4)
    line = lambda: " ".join(f"w{r.randrange(10**6)}" for _ in range(r.choice([1, 5, 49, 50, 51, 300]))).encode()
    for _ in range(20):
        lines = [line() for _ in range(r.randrange(1, 60))]
        ends, start = [], 0
        for i in range(len(lines)):
            h = [xxhash.xxh64_intdigest(x) for x in lines[max(0, i - 1) : i + 1]]
            mixed = (h[0] * 0x9E3779B97F4A7C15 + h[1]) % 2**64 if len(h) == 2 else h[0]
            if (mixed ^ (mixed >> 32)) % 2 == 0 and i + 1 - start >= 2:
                ends.append(i + 1)
                start = i + 1
        if not ends or ends[-1] < len(lines):
            ends.append(len(lines))
        assert [b for _, b, _ in linechunks.chunks(lines)] == ends
        same = [b" ".join(x.split()[:1]) for x in lines]
        assert [ok for *_, ok in linechunks.chunks(same)] == [b - a >= 2 for a, b, _ in linechunks.chunks(same)]


def test_long_lines_are_chunked_as_others():
    """Lines of 49 and of 50 words in one place give chunks of one shape where their hashes agree on the cuts."""
    shapes = collections.Counter()
    for seed in range(400):
        r = random.Random(seed)
        around = [f"line {r.random()}".encode() for _ in range(6)]
        for n in (49, 50):
            lines = [*around[:3], " ".join(f"w{seed}.{i}" for i in range(n)).encode(), *around[3:]]
            shapes[n, sum(b - a for a, b, _ in linechunks.chunks(lines) if a <= 3 < b)] += 1
    assert all(shapes[49, k] and shapes[50, k] for k in (2, 3, 4)) and not shapes[50, 1]


def test_hot_passage_and_clashing_columns(spark):
    passage = "\n".join(" ".join(f"p{i}.{k}" for k in range(30)) for i in range(3))
    rows = [(i, f"own {i} before\n{passage}\nown {i} after") for i in range(linechunks.HOT_ROWS + 500)]
    docs = awkward(spark, rows).withColumns({c: F.lit(1) for c in ("__id", "__tk", "__spans", "__own", "__cut", "h1", "salt")})
    done = linechunks.dedup(docs)
    assert done.columns == [c for c in docs.columns if c != "removed"] + ["removed"]
    text = {r["doc_id"]: r["text"] for r in done.collect()}
    assert text[0] == rows[0][1] and all(text[i] == f"own {i} before\nown {i} after" for i in range(1, len(rows)))


def test_copies_of_a_text_are_compared_once(spark, monkeypatch):
    """Forty copies of a text cost the chunk bytes of two, and the first keeps what it keeps beside one copy."""
    lines = [" ".join(f"c{i}.{k}" for k in range(12)) for i in range(30)]
    write, sizes, first = linechunks.durable, {}, []

    def counted(df, label):
        out = write(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(linechunks, "durable", counted)
    for copies in (2, 40):
        part = "\n".join(["before", *lines[5:20], "after"])
        rows = [(None, part), *((i, "\n".join(lines)) for i in range(copies)), (100, part), (100, part)]
        text = sorted(((r["doc_id"], r["text"]) for r in linechunks.dedup(awkward(spark, rows)).collect()), key=repr)
        assert (None, part) in text and text.count((100, "")) == 2  # the null id comes first
        assert all(t == "" for i, t in text if i is not None and 0 < i < 100)
        first += [t.split("\n") for i, t in text if i == 0]
    assert first[0] == first[1] and {*lines[:5], *lines[20:]} <= {*first[0]} < {*lines}
    assert sizes["chunk-bytes"][0] == sizes["chunk-bytes"][1] > 0


def test_very_long_text_loses_its_lines(spark):
    lines = [f"line {i} of a text with very many lines" for i in range(40_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["first", *lines[100:39_000], "last"]))]
    text = {r["doc_id"]: r["text"] for r in linechunks.dedup(awkward(spark, rows)).collect()}
    assert text[1] == rows[0][1] and text[2] == "first\nlast"


def test_deep_paths_match_the_sql(spark):
    """Twelve levels and more, copies of a hot url, labels that are null, a very long url, blank segments."""
    import duckdb
    import pandas as pd

    r = random.Random(11)
    urls = [f"http://h.net/{'/'.join(r.choice('ab') for _ in range(r.randrange(10)))}/u{r.randrange(60)}/{r.choice(['x', 'y'])}/{i}.html" for i in range(400)]
    urls += [f"http://deep.net/{'/'.join(f's{k}' for k in range(12))}/{i}" for i in range(400, 460)] + ["http://h.net//a///b/7.html"] * 200
    urls += [f"http://long.net/{'/'.join(['very'] * 300)}/{i}" for i in range(460, 463)] + [None, "", "http://h.net", "http://h.net/"]
    pages = pd.DataFrame({"page_id": range(len(urls)), "url": urls})
    labels = pd.DataFrame([(i, *r.choice([(0, 0), (1, 0), (1, 1), (None, None), (1, None), (None, 1)])) for i in range(470)] + [(3, 0, 0)], columns=["doc_id", "quality", "toxic"]).astype("Int64")
    con = duckdb.connect()
    con.register("pages", pages)
    con.register("labels", labels)
    cursor = con.execute(oracles.ORACLES["op6_path_templates"])
    names = [c[0] for c in cursor.description]
    want = sorted(str([round(v, 9) if isinstance(v, float) else v for v in row]) for row in cursor.fetchall())
    known = spark.createDataFrame([(i, q, t) for i, q, t in labels.astype(object).where(labels.notna(), None).values.tolist()], "doc_id long, quality long, toxic long")
    evidence = known.select(F.col("doc_id").alias("document"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    rows = urltree.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), evidence).collect()
    got = sorted(str([round(row[c], 9) if isinstance(row[c], float) else row[c] for c in names]) for row in rows)
    assert got == want
    template = {row["page_id"]: row["template"] for row in rows}
    assert template[400] == "/" + "/".join(f"s{k}" for k in range(12)) + "/*" and template[470].endswith("/a/b/7.html")


def test_copies_leave_templates_alone(spark):
    """A url that is there a thousand times doesn't turn its siblings' wildcard off."""
    urls = [f"http://h.net/p/{i}" for i in range(20)]
    for rows in (urls, urls + urls[:1] * 1000, urls * 5):
        df = spark.createDataFrame([(u,) for u in rows], "url string").select(*(c.alias(n) for c, n in zip(urltree.host_and_path(F.col("url")), ("host", "path"))))
        assert {r["template"] for r in urltree.templates(df).collect()} == {"/p/*"}


def test_similar_branches_merge_at_every_level(spark):
    rows = [("h", f"/{a}/{b}", bad, 40) for a, bads in (("x", (2, 3)), ("y", (3, 2)), ("z", (38, 39))) for b, bad in zip("mn", bads)]
    got = {r["template"]: r for r in urltree.judged(spark.createDataFrame(rows, "host string, template string, bad long, seen long")).collect()}
    assert got["/z/m"]["branch"] == "/z/~" and got["/z/m"]["verdict"] == "block"
    merged = {got[t]["branch"] for t in ("/x/m", "/x/n", "/y/m", "/y/n")}
    assert all(got[t]["verdict"] == "allow" for t in ("/x/m", "/y/n")) and len(merged) <= 2
    assert urltree.judged(spark.createDataFrame([], "host string, template string, bad long, seen long")).count() == 0


def test_flac_examples_of_the_specification():
    """RFC 9639, appendix D: checksums of the first example, the third one read whole."""
    assert flac.crc8(np.frombuffer(bytes.fromhex("fff869180000"), np.uint8)[None, :]).tolist() == [0xBF]
    frame = np.frombuffer(bytes.fromhex("fff869180000bf0358fd03128b"), np.uint8)
    assert flac.crc16(frame, np.array([0]), np.array([len(frame)])).tolist() == [0xAA9A]
    stream = bytes.fromhex(
        "664c614380000022100010000000" "1f00001f07d0007000000018f8f9e396f5cbcfc6dc807f9977906b32"
        "fff868020017e944004f6f313d1047d227cb6d090831452bdc2822228057a3"
    )
    ((at, pcm),) = flac.decode_streams([stream])[0]
    samples = np.frombuffer(pcm, np.uint8).astype(int) - 128
    assert at == 0 and len(samples) == 24
    assert hashlib.md5(samples.astype(np.int8).tobytes()).digest() == bytes.fromhex("f8f9e396f5cbcfc6dc807f9977906b32")


def test_every_dimension_is_cut(spark):
    """The widest dimension is taken, so one whose values alone differ is."""
    base = {"doc_id": 1, "text": "x" * 100, "lang": "en", "source": "s", "n_chars": 100}
    vary = {
        "by_size": lambda i: {"text": "x" * (1 + i * 7)}, "by_chars": lambda i: {"n_chars": 1 + i * 5}, "by_id": lambda i: {"doc_id": i},
        "by_source": lambda i: {"source": f"https://host{i:05d}"}, "by_lang": lambda i: {"lang": f"l{i % 50:02d}"},
    }
    for want, change in vary.items():
        rows = [base | change(i) for i in range(400)]
        docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
        tree = kdshards.build(kdshards.keyed(docs), 4)
        assert tree.dimension == want and (want == "by_lang" or tree.left.dimension == want)
    r = random.Random(1)
    mixed = [(i, "x" * int(2 ** r.uniform(1, 9)), r.choice("abcdefgh"), r.choice("stuvwxyz"), int(2 ** r.uniform(1, 9))) for i in range(2000)]
    tree, seen = kdshards.build(kdshards.keyed(spark.createDataFrame(mixed, "doc_id long, text string, lang string, source string, n_chars long")), 40), set()

    def walk(node):
        if node.left is not None:
            seen.add(node.dimension)
            walk(node.left)
            walk(node.right)

    walk(tree)
    assert len(seen) >= 4


def test_one_huge_row_among_shards(spark):
    rows = [(i, "y" * 10) for i in range(300)] + [(300, "z" * 3_000_000)]
    done = kdshards.shard(awkward(spark, rows), 8).collect()
    by = collections.defaultdict(list)
    for x in done:
        by[x["shard"]].append(x["slot"])
    assert len(done) == 301 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_decoding_cuts_batches_by_ids():
    words = bpe.Vocabulary.load(bpe.default_vocabulary())
    r = np.random.default_rng(2)
    flat = r.integers(0, 50_000, size=3 * bpe.CHUNK_IDS + 17)
    ends = np.array([0, 5, bpe.CHUNK_IDS + 3, len(flat)])
    raw = words.decode_lists(flat, ends).to_pylist()
    assert raw == [b"".join(words.bytes_of[i] for i in flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
    batch = pa.RecordBatch.from_arrays([pa.array([[1] * n if n is not None else None for n in (3, bpe.BATCH_IDS + 1, None, 0, 2)], type=pa.list_(pa.int32()))], names=["ids"])
    parts = [(b.num_rows, len(i), e.tolist()) for b, i, e in bpe._by_ids([batch])]
    assert parts == [(1, 3, [3]), (1, bpe.BATCH_IDS + 1, [bpe.BATCH_IDS + 1]), (3, 2, [0, 0, 2])]


def test_offset_digests(spark):
    text = "é日本 don't"
    row = bpe.digests(bpe.encode(awkward(spark, [(1, text)]), offsets=True)).first()
    words = bpe.Vocabulary.load(bpe.default_vocabulary())
    spans = words.offsets(text, words.encode([text])[0])
    assert row["offsets_sha256"] == hashlib.sha256(b"".join(np.asarray(x, "<i4").tobytes() for x in spans)).hexdigest()
    assert bpe.digests(bpe.encode(awkward(spark, [(1, text)]))).first()["offsets_sha256"] is None


def test_guests_meet_members_of_their_buckets_only():
    import pandas as pd

    words = [f"w{i}" for i in range(50)]
    text = " ".join(words)
    near = " ".join(["other", *words[1:]])
    row = lambda node, root, keys, t: {"node": node, "root": root, "keys": keys, "text": t}
    have = pd.DataFrame([row(b"a", b"A", [1, 2], text), row(b"b", b"B", [3], text + " more"), row(b"c", b"A", [1], text + " end"), row(b"d", b"D", [1], "quite different words")])
    ask = pd.DataFrame([row(b"g", b"G", [1], near)])
    assert neardup._first_links(ask, have, 80, 2) == [(b"g", b"a")]  # b shares no bucket, c is joined by then
    assert neardup._first_links(ask.assign(keys=[[9]]), have, 80, 2) == []
    assert neardup._first_links(ask.iloc[:0], have, 80, 2) == []


def test_near_duplicates_of_a_template_group(spark):
    """Many texts of one template: the hub reaches some, the others are linked to one another only."""
    r = random.Random(9)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for family in range(12):
        mid = list(base)
        for k in r.sample(range(60), 9):
            mid[k] = f"f{family}.{k}"
        for _ in range(12):
            own = list(mid)
            own[r.randrange(60)] = f"x{r.random()}"
            rows.append((len(rows), " ".join(own)))
    r.shuffle(rows)
    assert components_of(neardup.find(awkward(spark, rows))) == closure(rows)


def test_components_of_long_chains(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = [(f"{order[i]:04d}".encode(), f"{order[i + 1]:04d}".encode()) for i in range(n - 1) if i % 100 != 99]
    got = {bytes(x["node"]): bytes(x["root"]) for x in neardup.components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    for start in range(0, n, 100):
        part = [f"{x:04d}".encode() for x in order[start : start + 100]]
        assert {got[x] for x in part} == {min(part)}


@needs_data
def test_packing_query_reads_in_small_batches(spark):
    setting = "spark.sql.parquet.columnarReaderBatchSize"
    own, given = spark.newSession(), spark.newSession()
    given.conf.set(setting, "300")
    rows = [sorted(map(tuple, queries.op3_best_fit_packing(s, SMALL).collect())) for s in (own, given)]
    assert rows[0] == rows[1] and len(rows[0]) >= own.read.parquet(f"{SMALL}/documents.parquet").count()
    assert own.conf.get(setting) == str(READ_ROWS) and given.conf.get(setting) == "300"


@needs_data
def test_flac_query_takes_one_worker_a_task(spark):
    docs = awkward(spark)
    both = flac.decode(flac.encode(docs))
    once = flac.round_trip(docs)
    assert once.schema == both.schema
    assert sorted(str(r) for r in once.collect()) == sorted(str(r) for r in both.collect())
    assert flac.round_trip(empty(spark)).count() == 0
    own = spark.newSession()
    done = queries.op8_flac(own, SMALL)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert own.conf.get("spark.sql.parquet.columnarReaderBatchSize") == str(READ_ROWS)
    want = {r["doc_id"]: flac.payload(r["text"] or "") for r in own.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r["doc_id"]: r["payload_sha256"] for r in done.collect()} == {i: hashlib.sha256(p).hexdigest() for i, p in want.items()}
