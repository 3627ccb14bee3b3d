"""Collocations against counts of all phrases in a dictionary."""

import random
import re
from collections import Counter, defaultdict

import pytest

from fundscope.llm import collocations, queries
from tests.llm import brute, cases


def mined(rows, max_words=4, min_count=30, percent=80, top=2000):
    """{(lang, rank): (phrase, a, l, r, n, score)} from (text, lang)"""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.UPPER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(w[i: i + k] for i in range(len(w) - k + 1))
    out = {}
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        longer = Counter()
        for p, c in often.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer[p[i:j]], c)
        found = []
        for p, a in often.items():
            if 100 * longer[p] >= percent * a:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out[lang, rank] = (phrase.decode(), -a, left, right, n[lang], -score)
    return out


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(k, t, lang, "x", "y") for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n string")
    got = collocations.collocations(docs, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = got.collect()
    assert len({(r.lang, r.rank) for r in found}) == len(found)
    return {(r.lang, r["rank"]): tuple(r)[2:] for r in found}


def texts(seed=6):
    rng = random.Random(seed)
    few = cases.words(rng, 12)
    out = [(r[1], r[2]) for r in cases.documents()]
    out += [(" ".join(rng.choice(few) for _ in range(120)), rng.choice(["en", "de", None])) for _ in range(40)]
    out += [("Of The. of\tthe,OF the\x1cnow of the; a b c d e a b c d", "en")] * 9
    out += [("hot pair " + " ".join(cases.words(rng, 2)), "en") for _ in range(200)] + [("x\n" * 50 + "\x00 \x01 \x00 \x01", "")] * 4
    out += [("fo o\x01a fo o", "fr"), ("fo\x01 o fo", "fr")] * 3
    return out


@pytest.fixture(params=["many partitions", "as it comes"])
def settings(request, spark):
    """Streams cut into many partitions and small batches, or as the session has it."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "13",
            "spark.sql.shuffle.partitions": "23"} if request.param == "many partitions" else {}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("kw", [{"min_count": 3}, {"min_count": 2, "max_words": 3, "top": 40, "covered_percent": 50}, {"min_count": 1, "top": 10**6}])
def test_collocations(spark, settings, monkeypatch, kw):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 2000)
    rows = texts()
    names = {"covered_percent": "percent"}
    want = mined(rows, **{names.get(k, k): v for k, v in kw.items()})
    assert len({k[0] for k in want}) >= 4 and len(want) > 100
    assert run(spark, rows, **kw) == want


def test_empty(spark):
    assert run(spark, []) == {}
    assert run(spark, [(None, "en"), ("", None), (" .\n", "en"), ("one two", "en")]) == {}


def test_scores_are_exact_beyond_64_bits(spark):
    """Counts of some 10^13 in the streams: their products with 2,000,000 pass 64 bits."""
    big = 9_000_000_000_001
    phrases = spark.createDataFrame([("en", "a\n", 1, 3 * big), ("en", "b\n", 1, 3 * big + 1), ("en", "a\nb\n", 2, big), ("en", "", 0, 10 * big)],
                                    "lang string, phrase string, words int, n long")
    collocations_of = collocations.frequent_phrases
    try:
        collocations.frequent_phrases = lambda *a: phrases
        got = collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    finally:
        collocations.frequent_phrases = collocations_of
    assert [tuple(r) for r in got] == [("en", 1, "a b", big, 3 * big, 3 * big + 1, 10 * big, 2_000_000 * big // (6 * big + 1))]


def test_sql_of_the_query_counts_as_the_plain_version_does(duck):
    rows = duck.execute("select text, lang from documents").fetchall()
    found = duck.execute(queries.ORACLE_SQL["op12_collocations"]).fetchall()
    assert {(r[0], r[1]): r[2:] for r in found} == mined(rows)
