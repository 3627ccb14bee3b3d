"""Mixing, token files and the pipeline."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fundscope.llm import mixing, queries, simhash, toxicity, token_files
from tests.conftest import SF_SMALL
from tests.llm import brute, cases

PATH = public_tokenizers.path("word_bpe_49k.json")


def fill(budget, children):
    """Shares of (capacity, weight) children: full ones first, the rest by weight, rounded down."""
    share, open_ = {}, dict(children)
    while open_:
        left = budget - sum(share.values())
        total = sum(w for _, w in open_.values())
        full = [k for k, (c, w) in open_.items() if c * total <= left * w]
        if not full:
            share |= {k: left * w // total for k, (c, w) in open_.items()}
            break
        for k in full:
            share[k] = open_.pop(k)[0]
    return share


def leaf_budgets(tokens, budget, weights, epochs, path=()):
    """{leaf: budget} for {leaf path: tokens}"""
    if path in tokens and len(path) == len(next(iter(tokens))):
        return {path: budget}
    kids = {}
    for leaf, n in tokens.items():
        if leaf[: len(path)] == path:
            kid = leaf[: len(path) + 1]
            kids[kid] = kids.get(kid, 0) + n * epochs
    out = {}
    for kid, b in fill(budget, {k: (c, weights.get(k, 1)) for k, c in kids.items() if c}).items():
        out |= leaf_budgets(tokens, b, weights, epochs, kid)
    return out


def mixed(rows, levels, budget, weights, epochs, seed=mixing.SEED):
    """sorted [(doc_id, epoch, tokens)] for rows (doc_id, text, *levels)"""
    n = {r[0]: len(brute.WORD.findall(r[1] or "")) for r in rows}
    leaves = {}
    for r in rows:
        leaves.setdefault(tuple(r[2:]), []).append(r[0])
    tokens = {leaf: sum(n[d] for d in docs) for leaf, docs in leaves.items()}
    out = []
    for leaf, b in leaf_budgets(tokens, budget, weights, epochs).items():
        whole, rest = divmod(b, tokens[leaf])
        docs = [d for d in leaves[leaf] if n[d]]
        out += [(d, e, n[d]) for e in range(whole) for d in docs]
        for d in sorted(docs, key=lambda d: (hashlib.md5(f"{seed}:{whole}:{d}".encode()).hexdigest(), str(d))):
            if rest <= 0:
                break
            out.append((d, whole, min(rest, n[d])))
            rest -= n[d]
    return sorted(out)


@pytest.mark.parametrize("budget, epochs", [(0, 1), (500, 1), (40_000, 2), (10**6, 3)])
def test_mixing(spark, budget, epochs):
    rows = [r for r in cases.documents()[:-2]]
    weights = {("en",): 5, ("de",): 2, ("en", "src1"): 7}
    df = cases.frame(spark, rows)
    got = mixing.mix(df, ["lang", "source"], budget, weights=weights, max_epochs=epochs)
    assert got.columns == df.columns + ["mix_epoch", "mix_tokens"]
    got = mixing.trim_to_taken(got, "text", "n_chars").collect()
    want = mixed([(r[0], r[1], r[2], r[3]) for r in rows], ["lang", "source"], budget, weights, epochs)
    assert sorted((r.doc_id, r.mix_epoch, r.mix_tokens) for r in got) == want
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert brute.WORD.findall(r.text) == brute.WORD.findall(texts[r.doc_id])[: r.mix_tokens]
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert sum(r.mix_tokens for r in got) <= budget


def test_mixing_awkward_rows(spark):
    df = cases.frame(spark, cases.documents())
    got = mixing.mix(df, ["lang", "source"], 10**9, max_epochs=2)
    assert got.where("doc_id is null").count() == 2                  # every epoch takes it
    assert got.where("doc_id = 2").count() == 4                      # a repeated row, twice in each epoch
    assert got.where("doc_id in (13, 14, 15)").count() == 0          # no tokens
    assert mixing.mix(cases.frame(spark, []), ["lang", "source"], 100).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(df, ["lang"], 10, weights={("en", "x"): 1})


def test_token_files(spark, tmp_path):
    rows = cases.documents()
    manifest = token_files.write_sequences(cases.frame(spark, rows), PATH, f"file://{tmp_path}/out", length=64)
    got = token_files.read_sequences(manifest, "long").collect()
    assert len(got) == len(rows)
    once = [(d, t) for d, t in cases.unique(rows)]
    want = brute.token_files(once, PATH)
    shift = {r.doc_id: r for r in got}
    assert shift[None].start == 0
    lead = shift[None].n_tokens
    for r in got:
        if r.doc_id is not None:
            assert (r.n_tokens, r.ids_crc32) == want[r.doc_id][1:]
        if r.doc_id is not None and r.doc_id < 2:
            assert r.start == lead + want[r.doc_id][0]
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    # random access, views of the mapped file
    for m in manifest.collect():
        file = token_files.SequenceFile(f"{m.path}.arrow")
        flat = np.concatenate([ids[: mask.true_count] for ids, mask in file.batches()])
        assert len(flat) == m.n_ids and len(file) == -(-m.n_ids // 64)
        for i in {0, len(file) // 2, len(file) - 1}:
            ids, mask = file[i]
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            assert ids[mask.to_numpy(zero_copy_only=False)].tolist() == flat[i * 64: i * 64 + mask.true_count].tolist()
        with pytest.raises(IndexError):
            file[len(file)]


def test_token_files_empty(spark):
    manifest = token_files.write_sequences(cases.frame(spark, []), PATH)
    assert manifest.collect() == [] and token_files.read_sequences(manifest, "long").collect() == []


def test_token_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op10_token_files"](spark, SF_SMALL).collect()}
    assert got == brute.token_files(docs, PATH)


def test_a_text_has_the_ids_of_its_words():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["it's <|endoftext|> ok<|startoftext|>", "a\u0301 e \u0301x", "ΣΑΣ Σ", "x\x1cy\u00a0z\u3000w", "12 3a4", "don't'S", "漢字 ｆｕｌｌ", "\u2028 a", "!!\"\" \""]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    ids, count = token_files.Encoder(PATH)(np.frombuffer(b"".join(data), np.uint8), offsets, 1)
    for t, a, n in zip(texts, np.cumsum(count) - count, count):
        assert ids[a: a + n].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_pipeline_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, bench = docs.columns, [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    steps = dict(corpus_pipeline.STAGES)
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    model = queries.toxic_model(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = steps["toxicity"](spark, docs, SF_SMALL).cache()
    assert kept.columns == columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.5}
    one = steps["simhash_near_duplicates"](spark, kept, SF_SMALL).cache()
    fps = {d: brute.fingerprint(t) for d, t in pairs(kept)}
    assert {r.doc_id for r in one.collect()} == set(brute.components(fps).values()) and one.columns == columns
    clean = steps["decontamination"](spark, one, SF_SMALL).cache()
    found = brute.decontaminate(pairs(one), bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, x in found.items() if not x[4]} and clean.columns == columns
    mix = steps["mixing"](spark, clean, SF_SMALL).cache()
    rows = [(r.doc_id, r.text, f"domain{int(r.source[3:]) % 4}", r.lang, r.source) for r in clean.collect()]
    total = sum(len(brute.WORD.findall(r[1] or "")) for r in rows)
    want = mixed(rows, None, int(np.floor(total * queries.MIX_SHARE)), queries.MIX_WEIGHTS, mixing.MAX_EPOCHS)
    assert sorted((r.doc_id, len(brute.WORD.findall(r.text))) for r in mix.collect()) == sorted((d, n) for d, _, n in want)
    assert mix.columns == columns
    last = steps["token_files"](spark, mix, SF_SMALL).collect()
    assert sorted(r.doc_id for r in last) == sorted(d for d, _, _ in want)
    ran = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, last))


def test_pipeline_on_awkward_rows(spark, tmp_path):
    docs = cases.frame(spark, cases.documents())
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this kind is here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        step = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            step = stage(spark, step, str(tmp_path))
            assert step.columns == docs.columns and [f.dataType for f in step.schema] == [f.dataType for f in docs.schema], name
        done = corpus_pipeline.STAGES[-1][1](spark, step, str(tmp_path))
        assert done.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and done.count() == step.count()
