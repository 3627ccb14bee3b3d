"""The filter audit against a row-by-row version."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscope.llm import filter_audit, queries
from tests.llm import brute, cases

MARKS = [(2, 1, 0), (3, 0, 1), (3, 1, None), (11, 1, 1), (13, None, 1), (17, 1, 0), (None, 1, 1), (99, 1, 1)]


def fails(text):
    words = brute.WORD.findall(text)
    return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}


def audit(rows, marks):
    """{(part, order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)}"""
    first = {}
    for d, text, *_ in rows:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    seen = []
    for d, text, lang, *_ in rows:
        bad = {k for k, v in fails(text or "").items() if v} | ({"E"} if d is not None and first[text or ""] < d else set())
        mine = [m for m in marks if d is not None and m[0] == d]
        seen.append((lang or "", bad, any(m[1] == 1 for m in mine), any(m[2] == 1 for m in mine)))
    out = {}
    for part in {s[0] for s in seen}:
        here = [s for s in seen if s[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                alive = [s for s in here if not s[1] & set(order[:k])]
                gone = [s for s in alive if f in s[1]]
                total[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(alive) - len(gone), len(gone), sum(f in s[1] for s in here) - len(gone), sum(s[1] == {f} for s in here),
                    sum(s[2] for s in gone), sum(s[3] for s in gone), f]
        for key in out:
            if key[0] == part:
                out[key][-1] = total[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def run(spark, rows, marks):
    got = filter_audit.audit(cases.frame(spark, rows), queries.AUDIT_FILTERS, repeats="E", part=F.col("lang"),
                             marks=spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), lost=queries.AUDIT_LOST)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = got.collect()
    assert len({tuple(r)[:3] for r in found}) == len(found)
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}


def test_audit(spark):
    rows = cases.documents()
    rows += [(100 + k, "#A " + t, lang, *rows[0][3:]) for k, (t, lang) in enumerate([("UP CASE", ""), ("UP CASE", None), ("é" * 9, "en")])]
    got, want = run(spark, rows, MARKS), audit(rows, MARKS)
    assert len(want) == 3 * 600 and got == want
    assert any(v[4] for v in want.values()) and any(v[5] for v in want.values())


def test_one_text_in_all_rows(spark):
    rows = [(k, "same text " * 60, "en", *[None] * 8) for k in range(300)] + [(0, "same text " * 60, "de", *[None] * 8)]
    got = run(spark, rows, [])
    assert got == audit(rows, [])
    assert got["en", "EABCD", 1][:2] == (1, 299) and got["de", "EABCD", 1][1] == 0


def test_empty_tables(spark):
    assert run(spark, [], MARKS) == {}


def test_without_marks_or_parts(spark):
    rows = cases.documents()
    got = filter_audit.audit(cases.frame(spark, rows), {"x": "n_words < 50"}, repeats="y").collect()
    assert [(r.part, r.filter_order, r.step) for r in sorted(got)] == [("", "xy", 1), ("", "xy", 2), ("", "yx", 1), ("", "yx", 2)]
    with pytest.raises(ValueError):
        filter_audit.audit(cases.frame(spark, rows), {"E": "true"}, repeats="E")


def test_counts_of_single_texts():
    for text in ["", " ", "a", " a", "a ", "Ab\tAb\nab ab", "é É ß\x1c$", "\x00 \x00 \x01", "日本 語 日本", "x" * 5000 + " " + "x" * 5000]:
        data = np.frombuffer(text.encode(), np.uint8)
        words = brute.WORD.findall(text)
        assert [int(x[0]) for x in filter_audit.counts(data, np.array([0, len(data)]))] == [
            len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)), len(text)]


def test_hash_table_verifies_bytes():
    """Spans with one hash for all are still told apart."""
    words = ["ab", "cd", "ab", "abc", "cd", "", "ab", "ef"] * 5
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    owner = np.repeat(np.arange(2), 20)
    fresh = filter_audit.first_seen(data, start, end, owner, np.zeros(len(words), np.uint64))
    seen, want = set(), []
    for o, w in zip(owner.tolist(), words):
        want.append((o, w) not in seen)
        seen.add((o, w))
    assert fresh.tolist() == want
