"""Decontamination and nearest neighbours against brute force."""

import random

import numpy as np
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from fundscope.llm import ann, decontaminate, queries
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute, cases


class Most(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


MOST = Most()


def bench(rows, rng):
    texts = [r[1] for r in rows if r[1]]
    cut = lambda t, a, b: " ".join(brute.WORD.findall(t)[a:b])
    return [(1, cut(texts[0], 3, 30)), (2, cut(texts[1], 0, 4)), (3, ""), (4, None), (5, "..."), (6, "Same SAME same"),
            (7, cut(texts[2], 2, 40).upper()), (8, " ".join(cases.words(rng, 40))), (10, cut(texts[2], 2, 40)), (None, cut(texts[5], 0, 20)),
            (10, cut(texts[21], 1, 14)), (11, "same " * 13)]


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 8])
def test_decontaminate(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "CANDIDATES", 50)
    rows = cases.documents()
    items = bench(rows, random.Random(9))
    docs, tests = cases.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.build_index(docs)
    got = decontaminate.search(index, tests, block_words=block_words).collect()
    assert len(got) == len(rows)
    named = brute.decontaminate(cases.unique(rows), [x for x in items if x[0] is not None])
    every = brute.decontaminate(cases.unique(rows), items)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_hit) == every[r.doc_id][:2]
            assert (len(r.item_ids), brute.sha(",".join(r.item_ids))) == named[r.doc_id][2:4], r.doc_id
            assert sum(s.end - s.start for s in r.spans) == r.n_hit
    flagged = decontaminate.decontaminate(docs, tests).where("contaminated").select("doc_id").distinct().collect()
    assert {r.doc_id for r in flagged} >= {d for d, x in every.items() if x[4]}
    kept = decontaminate.drop_contaminated(docs, tests)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {d for d, x in every.items() if not x[4]}


def test_proximity(spark):
    rng = random.Random(2)
    w = cases.words(rng, 60)
    moved = w[10:16] + ["extra"] + w[16:23]
    docs = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(w[:10] + moved + w[23:])), (3, " ".join(w[30:]))], "doc_id long, text string")
    item = spark.createDataFrame([("x", " ".join(w[10:23]))], "item_id string, text string")
    index = decontaminate.build_index(docs)
    got = {r.doc_id: r for r in decontaminate.search(index, item, slop=1).collect()}
    assert [got[k].item_ids for k in (1, 2, 3)] == [["x"], [], []]
    assert [got[k].near_item_ids for k in (1, 2, 3)] == [["x"], ["x"], []]


def test_proximity_against_all_places(spark):
    rows = cases.documents()
    items = [x for x in bench(rows, random.Random(9)) if x[0] is not None]
    rng = random.Random(3)
    for k in range(8):                                   # passages with a word more, a word less, two words exchanged
        w = brute.WORD.findall(rows[20 + k][1])[2:30]
        w = [w[:9] + ["more"] + w[9:], w[:9] + w[10:], w[:9] + [w[10], w[9]] + w[11:], w[:5] + ["x", "y", "z"] + w[5:]][k % 4]
        items.append((50 + k, " ".join(w)))
    docs, tests = cases.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    for block_words in (decontaminate.BLOCK_WORDS, 40):
        got = decontaminate.search(decontaminate.build_index(docs), tests, slop=2, block_words=block_words).collect()
        want = brute.near_items(cases.unique(rows), items, 2)
        assert {r.doc_id: set(r.near_item_ids) for r in got if r.doc_id is not None} == want
    assert sum(map(len, want.values())) > 10 and rng


def test_only_one_job_s_blocks_are_held(spark, monkeypatch):
    """Many blocks: a broadcast holds the words of one job's, never the whole test set."""
    items = [(k, " ".join(cases.words(random.Random(k), 60))) for k in range(60)]
    docs = spark.createDataFrame([(k, f"{items[k][1]} tail {k}") for k in range(0, 60, 3)] + [(99, "none of it")], "doc_id long, text string")
    held = []
    real = decontaminate.Block.__init__
    monkeypatch.setattr(decontaminate.Block, "__init__", lambda self, names, n, hashes, window: (held.append(len(hashes)), real(self, names, n, hashes, window))[1])
    got = decontaminate.search(decontaminate.build_index(docs), spark.createDataFrame(items, "item_id long, text string").repartition(3), block_words=200).collect()
    assert len(held) >= 60 * 60 // 400 and max(held) <= 400 and sum(held) == 60 * 60
    assert {r.doc_id: r.item_ids for r in got} == {**{k: [str(k)] for k in range(0, 60, 3)}, 99: []}
    assert {r.n_hit for r in got if r.doc_id != 99} == {60}


def test_decontaminate_empty_tables(spark):
    docs, none = cases.frame(spark, cases.documents()), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none).where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.decontaminate(cases.frame(spark, []), none).collect() == []


def test_decontamination_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = queries.QUERIES["op5_decontamination"](spark, SF_SMALL).collect()
    assert {r[0]: tuple(r[1:6]) for r in rows} == brute.decontaminate(docs, items)
    near = brute.near_items(docs, items, 1)
    assert {r.doc_id: r.n_near_items for r in rows} == {d: len(x) for d, x in near.items()}
    assert all(r.n_near_items >= r.n_items for r in rows) and any(r.n_near_items for r in rows)


def exact(ids, vectors, query, k):
    order = sorted((i for i in range(len(ids)) if ids[i] != query), key=lambda i: (-scores(vectors, ids.index(query))[i], ids[i]))
    return [ids[i] for i in order[:k]]


def scores(vectors, q):
    return ann.exact_scores(np.broadcast_to(vectors[q], vectors.shape), vectors)


def test_hilbert_is_a_walk_through_every_cell():
    for m, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * m, indexing="ij"), axis=-1).reshape(-1, m)
        key = ann.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_nearest_recall_order_and_ties(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(600, 16))
    base[100:250] = base[100]                                       # a common vector
    base[300:310] = -0.0
    rows = [(int(k), [float(x) for x in v], "q", 0.0) for k, v in enumerate(base)]
    rows += [(900, None, "q", 0.0), (901, [float("nan")] * 16, "q", 0.0), (902, [None] * 16, "q", 0.0), (903, [1.0], "q", 0.0),
             (None, [1.0] * 16, "q", 0.0), (904, [float("inf")] + [0.0] * 15, "q", 0.0), (5, [float(x) for x in base[5]], "q", 0.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, vec string, score double")
    asked = F.col("id") % 20 == 0
    got = ann.nearest(df, 20, asked, block=32, curves=4).collect()
    ids = [k for k in range(600) if not 300 <= k < 310]
    vectors = base[ids]
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == [k for k in ids if k % 20 == 0]
    hit = 0
    for q, found in by.items():
        assert [r.rank for r in found] == list(range(1, 21)) and all(r.vec_id != q for r in found)
        assert [(r.score, r.vec_id) for r in found] == sorted(((r.score, r.vec_id) for r in found), key=lambda x: (-x[0], x[1]))
        s = scores(vectors, ids.index(q))
        assert all(r.score == s[ids.index(r.vec_id)] for r in found)
        hit += len({r.vec_id for r in found} & set(exact(ids, vectors, q, 20)))
    assert hit >= 0.9 * 20 * len(by)
    assert [r.vec_id for r in by[120]] == [k for k in range(100, 122) if k != 120][:20]     # copies: the smallest ids
    assert ann.measured_recall(df, spark.createDataFrame(got), 20, asked) >= 0.9


def test_fewer_candidates_and_empty(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (40, [0.5, 0.5]), (7, [0.0, 2.0])], "vec_id long, embedding array<float>")
    got = ann.nearest(df, 20, F.col("id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(20, 1, 40, 0.5), (20, 2, 7, 0.0), (40, 1, 7, 1.0), (40, 2, 20, 0.5)]
    assert ann.nearest(df.limit(0), 20, F.col("id") % 20 == 0).collect() == []
    assert ann.nearest(df.where("vec_id = 7"), 20, F.col("id") % 20 == 0).collect() == []


def test_every_vector_length_is_searched_among_its_own_kind(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 8))
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(base)]
    rows += [(1000, [1e6] * 9), (2000, [1.0, 0.0]), (2001, [0.5, 0.5]), (2020, [0.0, 2.0])]      # one vector too long, three short ones
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = F.col("id") % 20 == 0
    got = ann.nearest(df, 5, asked, block=16, curves=4).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(by) == [*range(0, 120, 20), 2000, 2020]           # 1000 has no vector of its length beside it
    assert by[2000] == [(2001, 0.5), (2020, 0.0)] and by[2020] == [(2001, 1.0), (2000, 0.0)]
    near = {q: exact(list(range(120)), base, q, 5) for q in range(0, 120, 20)}
    assert all(len(by[q]) == 5 and all(i < 120 for i, _ in by[q]) for q in near)
    assert sum(len({i for i, _ in by[q]} & set(near[q])) for q in near) >= 0.9 * 5 * len(near)
    assert ann.measured_recall(df, spark.createDataFrame(got), 5, asked) >= 0.9


def test_groups_are_bounded_and_a_full_reach_is_exact(spark, monkeypatch):
    sizes, plain = spark.sparkContext.accumulator(0, MOST), ann._nearest

    def counted(queries, q_ids, points, p_ids, k):
        sizes.add(len(queries))
        return plain(queries, q_ids, points, p_ids, k)

    monkeypatch.setattr(ann, "_nearest", counted)
    monkeypatch.setattr(ann, "BUNDLE", 2)
    base = np.random.default_rng(2).normal(size=(96, 6))
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(base)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, 4, F.lit(True), block=8, curves=1, reach=12).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {q: exact(list(range(96)), base, q, 4) for q in range(96)}
    assert 0 < sizes.value <= 2 * 8


def test_nearest_query(spark):
    found = queries.QUERIES["op7_nearest_neighbours"](spark, SF_MID).cache()
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    assert ann.measured_recall(df, found, 20, F.col("id") % 20 == 0) >= 0.9
    assert found.count() == 20 * df.where("vec_id % 20 = 0").count()
