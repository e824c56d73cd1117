"""The pipeline's stages, each against plain Python over its own input."""

import collections
import math
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm import linechunks, neardup, packing, quality, toxicity

from .test_operators import awkward, closure, expected_lines, token_counts

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before and after each stage."""
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL).cache()
        found.append((name, docs, out))
        docs = out
    return found


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["doc_id"])


def test_stages_and_columns(steps):
    assert [n for n, *_ in steps] == ["toxicity", "quality", "line dedup", "near dedup", "packing"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_filters_keep_what_a_plain_loop_keeps(spark, steps):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    toxic = toxicity.train(docs, labels)
    (_, before, after), (_, _, good) = steps[0], steps[1]
    assert rows(after) == [r for r in rows(before) if 1 / (1 + math.exp(-toxic.logit(toxicity.features(r["text"])))) < 0.5]
    model = quality.train(docs, labels)
    score = lambda t: model.probability(model.preference(*quality.evidence([t])))[0]
    assert rows(good) == [r for r in rows(after) if score(r["text"]) >= quality.CUT]
    known = {r["doc_id"]: r for r in labels.collect()}
    lost = [r for r in rows(before) if r["doc_id"] in known and known[r["doc_id"]]["toxic"] == 0 and r["doc_id"] not in {x["doc_id"] for x in rows(after)}]
    assert len(lost) <= 0.05 * len(known)


def test_line_dedup_removes_all_but_one_of_each_chunk(steps):
    _, before, after = steps[2]
    texts = {r["doc_id"]: r["text"] for r in rows(before)}
    repeats = expected_lines(list(texts.items()))
    kept = {r["doc_id"]: r for r in rows(after)}
    for i, t in texts.items():
        chunks = [c for _, _, c in linechunks.removable(t)]
        if not any(c in repeats for c in chunks):
            assert kept[i]["text"] == t  # clean documents stay as they are
    left = collections.Counter(c for r in kept.values() for c in repeats if c in r["text"].encode())
    assert all(left[c] >= 1 for c in repeats)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())


def test_near_dedup_keeps_one_of_each_group(steps):
    _, before, after = steps[3]
    want = {c for i, n, c in closure([(r["doc_id"], r["text"]) for r in rows(before)], width=5)}
    assert {r["doc_id"] for r in rows(after)} == want and len(rows(after)) == len(want)


def test_near_dedup_takes_five_word_shingles(spark, steps):
    base = [f"w{i}" for i in range(40)]
    far = [*base[:20], "other", *base[21:]]  # 0.90 by two words, 0.76 by five
    long = [f"v{i}" for i in range(200)]
    near = [*long[:100], "other", *long[101:]]  # 0.95 by five words
    rows_in = [(i, " ".join(t)) for i, t in enumerate((base, far, long, near))]
    shape = steps[3][1].columns
    assert [r["doc_id"] for r in rows(corpus_pipeline.drop_near_copies(spark, awkward(spark, rows_in).select(*shape), SMALL))] == [0, 1, 2]
    _, before, after = steps[3]
    sets, root = {r["doc_id"]: neardup.shingles(r["text"] or "", 5) for r in rows(before)}, {}
    for i, own in sets.items():  # in the order of ids
        near = {root[j] for j in root if own and sets[j] and 100 * len(own & sets[j]) >= 80 * len(own | sets[j])}
        least = min({i, *near})
        root = {j: least if r in near else r for j, r in root.items()} | {i: least}
    assert {r["doc_id"] for r in rows(after)} == set(root.values())


def test_packing_places_every_token(steps):
    _, before, after = steps[4]
    got, used = collections.Counter(), collections.Counter()
    for r in after.collect():
        got[r["doc_id"]] += r["n_tokens"]
        used[r["bin_id"], r["bin_size"]] += r["n_tokens"]
    given = rows(before)
    assert got == dict(zip((r["doc_id"] for r in given), token_counts(r["text"] for r in given)))
    assert len({b for b, _ in used}) == len(used)
    assert all(size == min(c for c in packing.CAPACITIES if c >= n) for (_, size), n in used.items())


def test_stages_take_awkward_and_empty_tables(spark):
    shape = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    for docs in (awkward(spark).select(*shape), awkward(spark).select(*shape).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL).cache()
            assert docs.columns == shape or name == "packing"
        docs.count()


def test_run_is_the_stages_in_turn(spark, steps):
    done = corpus_pipeline.run(spark, SMALL)
    assert done.count() == steps[-1][2].count() and done.select(F.sum("n_tokens")).first() == steps[-1][2].select(F.sum("n_tokens")).first()


def test_near_dedup_knows_documents_without_an_id_by_their_text(spark, steps):
    long = " ".join(f"w{i}" for i in range(60))
    data = [(None, long)] * 4 + [(None, "quite another text of more than five words")] + [(7, "one text of seven words or so")] * 3 + [(7, "a text of its own with the same id")] + [(8, long + " end")] + [(None, None)] * 2
    shape = steps[3][1].columns
    kept = corpus_pipeline.drop_near_copies(spark, awkward(spark, data).select(*shape), SMALL).collect()
    got = collections.Counter((r["doc_id"], r["text"]) for r in kept)
    assert got == {(8, long + " end"): 1, (None, data[4][1]): 1, (7, data[5][1]): 1, (7, data[8][1]): 1, (None, None): 1}


def test_runs_side_by_side_keep_their_tables(spark):
    from weftline.llm.common import collecting, durable, release

    with collecting() as a:
        one = durable(spark.range(3), "one")
        with collecting() as b:
            two = durable(spark.range(5), "two")
    release(spark, a)
    assert len(a) == len(b) == 1 and two.count() == 5
    with pytest.raises(Exception):
        one.count()


def test_workers_get_texts_in_batches_of_bounded_bytes(spark):
    import pyarrow as pa

    from weftline.llm.common import BATCH_BYTES, bounded

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    bounded(spark)
    longest = 1_500_000  # and one row of more than a batch
    texts = spark.range(0, 9, 1, 1).select(F.repeat(F.lit("x"), F.when(F.col("id") == 4, 6_000_000).otherwise(longest).cast("int")).alias("text"))
    got = texts.mapInArrow(run, "n long, bytes long").collect()
    assert sum(r["n"] for r in got) == 9
    assert all(r["n"] == 1 or r["bytes"] < BATCH_BYTES + 6_000_100 for r in got) and len(got) >= 3
    assert max(r["n"] for r in got) <= -(-BATCH_BYTES // longest)
