"""Operators on pairs, the pipeline and the registration, against brute force."""

import random
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
from brute import roots, shingles
from pyspark.sql.types import LongType, StructField

from tenure.llm import common, components, embedding_dedup, near_dedup

WORDS = [f"w{k}" for k in range(400)]


def _texts():
    pick = random.Random(5)
    base = [[pick.choice(WORDS) for _ in range(pick.randint(30, 120))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for k in range(120):  # copies with edits of growing number: similarities on both sides of 0.8
        b = list(base[k % 8])
        for _ in range(k // 24):
            b[pick.randrange(len(b))] = pick.choice(WORDS)
        texts.append(" ".join(b))
    texts += [None, "", " \n", "a", "A", "a b c", "A  b\tc", "x é ÀB", "x é Àb"]
    return texts


def test_near_duplicates_equal_brute_force(spark):
    texts = _texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (0, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    for words in (4, 5):
        sets = [shingles(t, words) for t in texts]
        links = [
            (a, b)
            for a, b in combinations(range(len(texts)), 2)
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
        ]
        want = roots(range(len(texts)), links)
        got = near_dedup.near_duplicates(df, words=words).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
            else:
                assert r.kept
    one = near_dedup.keep_one(df)
    assert one.columns == df.columns
    ids = [r.doc_id for r in one.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({want[i] for i in range(len(texts))}) and ids.count(None) == 1


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_duplicates_move_neither_texts_nor_pairs_twice(spark, monkeypatch):
    """Without broadcasts texts are not shuffled for their sets, and no pair is compared on full sets twice."""
    plans, pairs, real = {}, [], near_dedup.save

    def save(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = real(df, name)
        if name == "near-counted":
            pairs.extend((r.a, r.b) for r in out.collect())
        return out

    monkeypatch.setattr(near_dedup, "save", save)
    base = [f"v{k}" for k in range(100)]  # far from the base, and from each other, at 0.75: tried in every round
    far = [" ".join([*base[:at], *(f"x{at}-{k}" for k in range(9)), *base[at + 9 :]]) for at in range(0, 90, 9)]
    df = spark.createDataFrame(list(enumerate(_texts() + far)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near_dedup.near_duplicates(df, words=4).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plans["near-sets"]
    assert pairs and len(pairs) == len(set(pairs))


def test_marks_miss_no_hash(spark):
    """Also with far more hashes than bits."""
    hashes = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 20_000)
    df = spark.createDataFrame([(int(h),) for h in hashes[:10_000]], "h long")
    for most in (1 << 26, 1 << 13):
        seen = common.marked(common.marks(df, most=most), hashes)
        assert seen[:10_000].all()
        assert seen[10_000:].mean() <= (0.05 if most > 1 << 20 else 1)


def test_prefixes_find_what_stars_leave(spark):
    """One round only, so that other links between the copies come from the full sets' prefixes."""
    texts = _texts()[:160]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a = near_dedup.near_duplicates(df, rounds=1).select("doc_id", "component_id").collect()
    b = near_dedup.near_duplicates(df, rounds=4).select("doc_id", "component_id").collect()
    assert sorted(a) == sorted(b)


def test_shingles_do_not_depend_on_blocks(spark):
    import pyarrow as pa

    texts = _texts()
    whole = list(near_dedup.shingle_sets(pa.array(texts), 5))
    real = near_dedup._word_blocks
    try:
        near_dedup._word_blocks = lambda data, breaks: real(data, breaks, 64)
        parts = list(near_dedup.shingle_sets(pa.array(texts), 5))
    finally:
        near_dedup._word_blocks = real
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(whole, parts))


def test_components(spark):
    pick = random.Random(1)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = roots({x for e in edges for x in e}, edges)
    assert {r.id: r.component for r in got} == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = [*base, *(base[k % 6] + rng.normal(size=16) * 0.1 * (1 + k % 5) for k in range(150)), *[base[0]] * 20]
    vectors = [[float(np.float32(x)) for x in v] for v in rows]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [1.0] * 3, [2.0] * 3, [1e38] * 16, [1e-40] * 16]
    data = [(i, v, 0) for i, v in enumerate(vectors + odd)] + [(None, vectors[0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, kept int")
    good = {i: np.array(v) / np.abs(v).max() for i, v, _ in data if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [
        (a, b)
        for a, b in combinations(sorted(good), 2)
        if len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.sqrt(good[a] @ good[a]) / np.sqrt(good[b] @ good[b]) >= 0.95
    ]
    want = roots(range(len(vectors) + len(odd)), links)
    got = embedding_dedup.near_vectors(df, block=32).collect()
    assert len(got) == len(data)
    for r in got:
        if r.vec_id is not None:
            assert r.n_links == sum(r.vec_id in e for e in links)
            assert r.component_id == want[r.vec_id] and r.kept == (want[r.vec_id] == r.vec_id)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_move_no_vector_once_a_block(spark, monkeypatch):
    """Every part against every other: the comparison shuffles nothing, and its panels give the whole result."""
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(400, 32))
    rows = [*rows, *(rows[k % 7] + rng.normal(size=32) * 0.02 for k in range(90))]
    df = spark.createDataFrame([(f"v{i:03}", [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id string, embedding array<double>")
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if unit[a] @ unit[b] >= 0.95]
    want = roots(range(len(rows)), links)
    panels, real = [], embedding_dedup._panels
    monkeypatch.setattr(embedding_dedup, "_panels", lambda *args: panels.extend(real(*args)) or panels)
    saved, save = {}, embedding_dedup.save

    def kept(frame, name):
        saved[name] = frame._jdf.queryExecution().executedPlan().toString()
        return save(frame, name)

    monkeypatch.setattr(embedding_dedup, "save", kept)
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, block=16, panel_bytes=8192).collect()}
    assert "vector-links" not in saved and len(panels) > 10  # many panels, none of them a shuffle of blocks
    assert saved["vector-cells"].count("Exchange") <= 4  # shown before and after AQE
    for i in range(len(rows)):
        r = got[f"v{i:03}"]
        assert (r.n_links, r.component_id) == (sum(i in e for e in links), f"v{want[i]:03}")


def test_tree_drops_only_far_pairs():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(80, 4))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    reach = rng.uniform(0, 0.2, 80)
    tree = embedding_dedup.Tree(points, 0.1)
    got = set(tree.pairs(reach, 0.3))
    need = {(a, b) for a in range(80) for b in range(a, 80) if tree.apart[a, b] <= 0.3 + reach[a] + reach[b]}
    assert need <= got and len(got) < 80 * 81 / 2


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.limit(3).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars")
    now = docs.unionByName(docs.limit(5)).unionByName(extra).unionByName(docs.limit(1).selectExpr("-1L doc_id", "cast(null as string) text", "lang", "source", "n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, sf).cache()
        if name != "packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
            assert after.count() <= now.count()
        now = after
    assert now.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_registration():
    import __spark_entry__ as E

    names = [k for k in E.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 11))
    assert "pipeline" in E.queries()


def test_hashing_takes_little_memory(spark):
    """Signatures and full sets of a batch of texts: beside the batch only a block's tables and a slice's sets."""

    class Rows:  # the functions as they run in a task
        def __init__(self):
            self.schema = {"id": StructField("id", LongType())}

        def select(self, *cols):
            return self

        def mapInArrow(self, run, kinds):
            return run

    pick = random.Random(9)
    texts = [" ".join(pick.choices(WORDS, k=500)) for _ in range(4_000)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array(texts), ids], ["id", "text", "h"])
    assert batch.nbytes > 8 << 20
    peaks = []
    near_dedup._POWERS.clear()
    for run in (near_dedup.signatures(Rows(), 5, 48), near_dedup.full_sets(Rows(), 5)):
        tracemalloc.start()
        assert sum(x.num_rows for x in run([batch])) == len(texts)
        peaks.append(tracemalloc.get_traced_memory()[1] >> 20)
        tracemalloc.stop()
    assert max(peaks) < 48, peaks
