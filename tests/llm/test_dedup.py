"""Substring, line and SimHash deduplication against row-by-row versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscope.llm import line_dedup, queries, simhash, substring_dedup
from fundscope.llm.graph import components
from fundscope.llm.storage import stored
from tests.conftest import SF_SMALL
from tests.llm import brute, cases


@pytest.mark.parametrize("span", [50, 5])
def test_substring_dedup(spark, span):
    rows = cases.documents()
    got = substring_dedup.dedup(cases.frame(spark, rows), span=span).collect()
    want = brute.substring_dedup(cases.unique(rows), span)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        assert (r.n_words, r.n_removed, brute.sha(r.kept_text)) == want[r.doc_id], r.doc_id
        texts = dict(cases.unique(rows))
        for p in r.paths:                                            # source coordinates hold
            mine, theirs = (brute.WORD.findall(texts[k]) for k in (r.doc_id, p.source_id))
            assert p.source_id < r.doc_id and p.end - p.start >= span
            assert mine[p.start: p.end] == theirs[p.source_start: p.source_start + p.end - p.start]


def test_substring_dedup_empty(spark):
    assert substring_dedup.dedup(cases.frame(spark, [])).collect() == []


def test_pieces_hold_every_edge_once_and_depend_on_the_words_only():
    rng = random.Random(4)
    a = " ".join(cases.words(rng, 300)).encode()
    for text in (a, b"x y z " + a):
        data = np.frombuffer(text, np.uint8)
        words = substring_dedup.Words(data, np.array([0, len(data)]), substring_dedup.NON_SPACE)
        p = substring_dedup.pieces(words, 50, 12)
        assert sorted(x for s, n in zip(p["start"], p["n"]) for x in range(s, s + n)) == list(range(len(words) - 49))
        inner = set(p["piece"][1:-1].tolist())
        if text is a:
            first = inner
        else:
            assert len(first & inner) >= len(first) - 1
        assert len(p["n"]) < (len(words) - 49) / 8                 # compacted


def line_brute(rows, k):
    texts = {d: (t or "").split("\n") for d, t in cases.unique(rows)}
    first, out = {}, {}
    for d in sorted(texts):
        for p in range(len(texts[d]) - k + 1):
            first.setdefault(tuple(texts[d][p: p + k]), (d, p))
    for d, lines in texts.items():
        gone = {i for p in range(len(lines) - k + 1) if first[tuple(lines[p: p + k])] != (d, p) for i in range(p, p + k)}
        out[d] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


@pytest.mark.parametrize("k", [1, 3, 4])
def test_line_dedup(spark, k):
    rows = cases.documents()
    got = line_dedup.dedup_lines(cases.frame(spark, rows), min_lines=k).collect()
    want = line_brute(rows, k)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0 and r.shared_depth is None
        else:
            assert (r.n_lines, r.n_removed, r.kept_text) == want[r.doc_id], r.doc_id
            assert sum(x.end - x.start for x in r.removed) == r.n_removed


def test_suffix_array_is_sorted_and_depths_hold(spark):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randint(1, 24))) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_dedup.lines_of(docs)
    name = {r.line_id: k for k, r in enumerate(sorted(lines.select("line_id").distinct().collect()))}
    ids = {(r.id, r.pos): name[r.line_id] for r in lines.collect()}
    got = line_dedup.suffix_array(lines, 2).suffixes.collect()
    suffix = {(r.id, r.pos): [ids[r.id, p] for p in range(r.pos, r.n_lines)] for r in got}
    assert len(got) == sum(t.count("\n") + 1 for t in texts)
    order = sorted(suffix.values())
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for r in got:
        mine = suffix[r.id, r.pos]
        assert r.rank == order.index(mine)
        longest = max(shared(mine, s) for k, s in suffix.items() if k != (r.id, r.pos))
        assert r.depth == (0 if not longest else 1 << (longest.bit_length() - 1)), (mine, longest, r.depth)


def test_whole_line_dedup_query_cuts_runs_of_one_and_two_lines(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op8_line_dedup_whole"](spark, SF_SMALL).collect()}
    want, cut = line_brute(docs, 1), line_brute(docs, line_dedup.MIN_LINES)
    assert {d: (r.n_lines, r.n_removed, r.kept_sha256) for d, r in got.items()} == {d: (*x[:2], brute.sha(x[2])) for d, x in want.items()}
    assert sum(x[1] for x in want.values()) > sum(x[1] for x in cut.values())


def test_line_dedup_empty(spark):
    assert line_dedup.dedup_lines(cases.frame(spark, [])).collect() == []


def test_golay_code_is_perfect_and_near_words_share_a_codeword():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 400)
    assert sorted(np.bitwise_count(simhash.PATTERNS[:, 0]).tolist()).count(3) == 1771
    listed = simhash.codewords(words)
    for w, near in zip(words, listed):
        for bit in range(23):
            assert simhash.codewords(np.array([w ^ (1 << bit)]))[0, 0] in near


def test_fingerprints_within_three_bits_share_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in a], np.uint64)
    mine, theirs = simhash.keys(a), simhash.keys(a ^ flips)
    for x, y in zip(mine, theirs):
        assert set(x[:, 0].tolist()) & set(y.ravel().tolist())


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 130)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    assert got == {x: r for x, r in parent.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rounds_of_components_read_few_tasks(spark):
    """A round's tasks go by the size of the edges, not by the partitions that they came in."""
    edges = spark.range(0, 400, 1, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = components(edges)
        assert found.groupBy("root").count().collect() == [(0, 401)]
        assert found.rdd.getNumPartitions() <= 16
        assert "ExistingRDD" not in found._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_simhash_documents(spark):
    rows = cases.documents()
    got = simhash.near_duplicates(cases.frame(spark, rows)).collect()
    fps = {d: brute.fingerprint(t) for d, t in cases.unique(rows)}
    want = brute.components(fps)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.fp % (1 << 64), r.component_id) == (fps[r.doc_id], want[r.doc_id])
    assert fps[13] == fps[14] == fps[15] == 0 and want[15] == 13
    kept = simhash.drop_near_duplicates(cases.frame(spark, rows))
    assert kept.columns == cases.frame(spark, []).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: -1 if x is None else x)
    twin = next(d for d, t in cases.unique(rows) if t == rows[-1][1])        # the row without id comes before its copy
    assert ids == [None, *sorted(set(want.values()) - {twin})]


@pytest.mark.parametrize("chunk", [3, 2048])
def test_links_of_dense_groups_connect_all_near_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 6)
    fps = sorted({int(c) ^ sum(1 << int(b) for b in rng.choice(63, k, replace=False)) for c in centres for k in (0, 1, 2, 3, 4, 6) for _ in range(6)})
    got = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long").select(F.col("fp"))).collect()
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in got:
        parent[max(root(r.a), root(r.b))] = min(root(r.a), root(r.b))
    assert {f: root(f) for f in fps} == brute.components({f: f for f in fps})


def test_simhash_empty(spark):
    assert simhash.near_duplicates(cases.frame(spark, [])).collect() == []
    assert simhash.drop_near_duplicates(cases.frame(spark, [])).collect() == []


def test_simhash_broadcasts_no_table_that_grows_with_the_documents(spark):
    """Few bytes of fingerprints become 42 entries each: such a join must not depend on the size that Spark reckons."""
    distinct = stored(spark.createDataFrame([(k * 0x9E3779B97F4A7C15 % (1 << 63),) for k in range(50)], "fp long"), "distinct")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 10 << 20
    assert "SortMergeJoin" in plan(simhash.links(distinct)) and "Broadcast" not in plan(simhash.links(distinct))
    docs = spark.createDataFrame([(k, "some words of a text " * k) for k in range(4)], "doc_id long, text string")
    by_fp = plan(simhash.near_duplicates(docs))
    assert by_fp[by_fp.index("Join"):].startswith("Join [fp") and "SortMergeJoin" in by_fp[: by_fp.index("Join") + 4]
