"""MinHash near-duplicates against set comparisons of all pairs."""

import random

import numpy as np
import pytest

from fundscope.llm import minhash, queries
from tests.conftest import SF_SMALL
from tests.llm import brute, cases


def shingles(text, n=5):
    w = brute.WORD.findall((text or "").translate(brute.UPPER))
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def components(texts, percent=85):
    """{id: (n_shingles, component_id)}"""
    sets = {d: shingles(t) for d, t in texts}
    ids = sorted(sets)
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if 100 * min(len(sets[a]), len(sets[b])) < percent * max(len(sets[a]), len(sets[b])):
                continue
            if sets[a] and root(a) != root(b) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: (len(sets[d]), root(d)) for d in ids}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "".join(rng.choice("abcdefgh") for _ in range(9))
    return " ".join(words)


def families(rng):
    """Stars (copies of one text, further from each other than from it), chains, pairs at the very threshold, one passage in many."""
    out = []
    for size, edits in ((60, 4), (25, 2), (8, 7)):
        base = cases.words(rng, 300)
        out += [" ".join(base)] + [edited(rng, base, edits) for _ in range(size)]
    step = cases.words(rng, 240)
    for _ in range(30):
        out.append(" ".join(step))
        step = edited(rng, step, 3).split(" ")
    for n in (10, 21, 104):                                 # n shared shingles and as many others as the threshold allows, or one more
        shared = cases.words(rng, n + 4)
        more = n * 15 // 85
        out += [" ".join(shared), " ".join(shared + cases.words(rng, more)), " ".join(cases.words(rng, more + 1) + shared)]
    passage = cases.words(rng, 120)
    out += [" ".join(cases.words(rng, 70) + passage + cases.words(rng, 70)) for _ in range(40)]
    out += ["a b c d e f g h", "A  b c d e\nf g h", "a b c d e f g h h", "a b", "A B", "b a"]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("chunk", [minhash.CHUNK, 7])
def test_near_duplicates(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rows = cases.documents()
    rows += [(100 + k, t, "en", *[None] * 8) for k, t in enumerate(families(random.Random(8)))]
    got = minhash.near_duplicates(cases.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = components(cases.unique(rows))
    for r in got:
        if r.doc_id is None:
            assert not r.kept and r.component_id == want[20][1]          # its text is a copy of 20's
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
            assert r.kept == (r.component_id == r.doc_id)
    assert [want[d] for d in (13, 14, 15)] == [(0, 13), (0, 14), (0, 15)]
    sizes = [list(x[1] for x in want.values()).count(c) for c in {x[1] for x in want.values()}]
    assert max(sizes) > 55 and sizes.count(1) > 60


@pytest.mark.parametrize("chunk", [minhash.CHUNK, 5])
def test_candidates_and_links_join_what_is_similar(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    texts = list(enumerate(families(random.Random(9))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    signed = minhash.signed(docs)
    classes = signed.where("n_shingles > 0").groupBy("key", "n_shingles", "tokens").agg({"row_id": "min"})
    names = {bytes(r.key): r["min(row_id)"] for r in classes.collect()}
    pairs = [(names[bytes(r.a)], names[bytes(r.b)]) for r in minhash.candidates(minhash.prefixes(classes)).collect()]
    assert len(pairs) < 40 * len(texts)                     # forests, not all pairs
    sets = {d: shingles(t) for d, t in texts if d in names.values()}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    similar = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert similar and all(root(a) == root(b) for a, b in similar)

    found = docs.sparkSession.createDataFrame([(bytearray(k), bytearray(b"x")) for k in names], "key binary, bundle binary")
    listed = minhash.full_sets(docs.join(signed.select("row_id", "key"), docs["doc_id"] == signed["row_id"]).where("key is not null")
                               .select("key", "text").dropDuplicates(["key"]))
    want, parent = components([(d, t) for d, t in texts if d in sets]), {d: d for d in sets}
    for r in minhash.links(found, listed).collect():         # of all classes as one bundle
        a, b = (root(names[bytes(x)]) for x in (r.a, r.b))
        parent[max(a, b)] = min(a, b)
    assert {d: root(d) for d in sets} == {d: c for d, (_, c) in want.items()}


def test_signatures_estimate_similarity():
    rng = random.Random(3)
    base = cases.words(rng, 2000)
    other = base[:1500] + cases.words(rng, 500)
    texts = [" ".join(x).encode() for x in (base, other)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    sets, bounds = minhash.shingle_sets(data, offsets)
    assert np.diff(bounds).tolist() == [len(shingles(t.decode())) for t in texts]
    tokens, key = minhash.signatures(sets, bounds)
    assert abs((tokens[0] == tokens[1]).mean() - 1496 / 2496) < 0.2 and (key[0] != key[1]).all()


def test_empty(spark):
    assert minhash.near_duplicates(cases.frame(spark, [])).collect() == []
    only = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert {tuple(r) for r in minhash.near_duplicates(only).collect()} == {(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, False)}


def test_query_on_the_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = components(docs)
    got = queries.QUERIES["op11_minhash"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) < len(want)
