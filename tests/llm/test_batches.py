"""What a Python task holds of its texts at a time."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundscope.llm import decontaminate, mixing, simhash, token_files, toxicity
from fundscope.llm.arrays import chunks
from fundscope.llm.batches import BATCH_BYTES, BATCH_BYTES_CONF, map_texts

ROWS, WORDS = 3000, 500


def batch_sizes(rows):
    def size(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])
    return [tuple(r) for r in rows.mapInArrow(size, "n long, bytes long").collect()]


@pytest.fixture
def texts(spark):
    """9 MB of texts in one partition, in a session without a bound."""
    before = spark.conf.getAll.get(BATCH_BYTES_CONF)
    spark.conf.unset(BATCH_BYTES_CONF)
    word = F.concat(F.lit("w"), F.lpad(F.col("id").cast("string"), 4, "0"), F.lit(" "))
    yield spark.range(0, ROWS, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(word, WORDS).alias("text"))
    spark.conf.unset(BATCH_BYTES_CONF)
    if before is not None:
        spark.conf.set(BATCH_BYTES_CONF, before)


OPERATORS = {
    "toxicity": lambda docs, folder: toxicity.score(docs, toxicity.Model(np.zeros(1 << toxicity.BITS, np.float32), 0.0)),
    "simhash": lambda docs, folder: simhash.fingerprints(docs),
    "decontamination": lambda docs, folder: decontaminate.build_index(docs),
    "token_files": lambda docs, folder: token_files.write_sequences(
        docs.limit(3), public_tokenizers.path("word_bpe_49k.json"), folder),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_take_texts_in_bounded_batches(texts, tmp_path, name):
    assert batch_sizes(texts)[0][0] == ROWS
    OPERATORS[name](texts, f"file:{tmp_path}/files")
    sizes = batch_sizes(texts)
    assert sum(n for n, _ in sizes) == ROWS and max(b for _, b in sizes) < 1.5 * BATCH_BYTES


def test_a_bound_of_the_session_is_kept(spark, texts):
    spark.conf.set(BATCH_BYTES_CONF, str(100 << 10))
    found = map_texts(texts, lambda batches: batches, texts.schema)
    assert spark.conf.get(BATCH_BYTES_CONF) == str(100 << 10)
    assert found.count() == ROWS and found.exceptAll(texts).isEmpty()


def test_ids_are_the_same_for_any_run_and_cache_size(monkeypatch):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh'.,7é"), rng.integers(1, 9))) for _ in range(900)]
    column = pa.array([" ".join(rng.choice(words, rng.integers(0, 200))) for _ in range(60)] + [None, ""])

    def ids(limit):
        encode = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
        return [np.concatenate(x).tolist() for x in zip(*(encode(data, offsets, 1) for _, _, data, offsets in chunks(column, limit)))]

    whole = ids(1 << 20)
    monkeypatch.setattr(token_files, "CACHED_PARTS", 50)
    monkeypatch.setattr(token_files, "ENCODED_AT_ONCE", 7)
    assert ids(500) == whole


def test_runs_of_texts_take_little_memory():
    rng = np.random.default_rng(6)
    column = pa.array(["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(1000)])
    tracemalloc.start()
    for _, _, data, offsets in chunks(column, toxicity.CHUNK_BYTES):
        toxicity.buckets(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_a_fit_takes_little_memory_of_the_driver(spark, monkeypatch):
    """The regression's arrays do not grow with the features of all documents (900,000 here)."""
    monkeypatch.setattr(toxicity, "STEPS", 2)
    n = 1500
    letters = F.concat_ws("", *[F.substring(F.md5(F.concat_ws(":", (F.col("id") % 2).cast("string"), F.lit(k).cast("string"))), 1, 30)
                                for k in range(12)])
    docs = spark.range(0, n, 1, 4).select(F.col("id").alias("doc_id"), letters.alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"))
    tracemalloc.start()
    model = toxicity.fit(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    score = {r.doc_id % 2: r.score for r in toxicity.score(docs, model).collect()}
    assert score[0] < 0.5 < score[1]
    assert peak < 24 << 20


def test_weights_of_a_mix_need_no_python_workers(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", None, 10), (None, "x", 10)], "top string, low string, tokens long")
    leaves = leaves.groupBy("top", "low").agg(F.sum("tokens").alias("tokens")).checkpoint()
    found = mixing.budgets(leaves, ["top", "low"], 12, {("a",): 2, (None,): 1, ("a", None): 3})
    assert {(r.top, r.low): r.budget for r in found.collect()} == {("a", "x"): 2, ("a", None): 6, (None, "x"): 4}
    plan = found._jdf.queryExecution().toString()
    assert "LocalRelation" in plan and plan.count("Scan ExistingRDD") == plan.count("Scan ExistingRDD[top")
