"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A document is the set of its character n-grams (4 to 7 characters, case
folded, hashed into 2**20 buckets).  ``fit`` counts, with Spark, in how many
toxic and other labelled documents each bucket occurs; the smoothed log ratio
of the two shares is the bucket's value.  Buckets whose ratio is not clearly
away from zero (z below ``MIN_Z``) carry nearly no weight after the scaling
and are left out, and so are buckets of fewer than ``MIN_DOCS`` labelled
documents, whose ratio is chance; of the rest the ``max_features`` clearest ones
are the model's features, which bounds what a scoring task holds.  A logistic regression on the scaled features is then
fitted by numpy on the labelled documents.

Bound: the fit reads at most ``max_train`` labelled documents (chosen by the
hash of their id, so the same ones for any partitioning).  Scoring reads every
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.arrays import characters, chunks, distinct
from fundscope.llm.batches import map_texts

SIZES = (4, 5, 6, 7)
BITS = 20
MAX_TRAIN = 10_000
MAX_FEATURES = 1 << 15
MIN_Z = 4.0
MIN_DOCS = 3
L2 = 1e-3
STEPS = 150
CHUNK_BYTES = 128 << 10    # the n-grams of a run of texts take 300 times its bytes
STEP_BYTES = 256 << 10     # of features, of which a step of the regression takes 20 times the bytes


@dataclass
class Model:
    weight: np.ndarray     # float32 per bucket; zero where the bucket is not a feature
    bias: float


def buckets(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) pairs of a run of documents, each pair once, sorted; only wanted buckets if given."""
    value, bound = characters(data, offsets, lower=True)
    owner = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
    h = value * np.uint32(0x9E3779B1)
    keys = []
    for n in range(2, max(SIZES) + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint32(0x01000193) + value[n - 1:] * np.uint32(0x85EBCA6B)
        if n not in SIZES:
            continue
        b = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)) >> np.uint32(32 - BITS)
        at = np.arange(len(b)) if wanted is None else np.flatnonzero(wanted[b])
        doc = owner[at]
        inside = at + n <= bound[doc + 1]
        keys.append((doc[inside] << BITS) | b[at[inside]].astype(np.int64))
    key = distinct(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return key >> BITS, key & ((1 << BITS) - 1)


def sample(labelled: DataFrame, id_col: str, max_train: int) -> DataFrame:
    """At most ``max_train`` labelled rows, by the hash of the id."""
    return labelled.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(max_train)


def fit(docs: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "label", max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> Model:
    """Fit on the documents that ``labelled`` (id, 0/1 label) names.  Null labels and ids are left out.

    Without documents of both labels every document gets the share of label 1
    as its score (0 where nothing is labelled).
    """
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    chosen = sample(labelled.groupBy("id").agg(F.max("label").alias("label")), "id", max_train)
    train = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), "id").select("label", "text"))   # at most max_train small rows

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int64)
        for batch in batches:
            label = (np.asarray(batch.column(0)) != 0).astype(np.int64)
            total += np.bincount(label, minlength=2)
            for row, end, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                doc, bucket = buckets(data, offsets)
                for k in (0, 1):
                    seen[k] += np.bincount(bucket[label[row:end][doc] == k], minlength=1 << BITS).astype(np.int32)
        held = np.flatnonzero(seen.sum(axis=0))
        yield pa.record_batch([pa.array(np.append(held, -1)), pa.array(np.append(seen[0][held], total[0]).astype(np.int64)),
                               pa.array(np.append(seen[1][held], total[1]).astype(np.int64))], names=["bucket", "n0", "n1"])

    counts = map_texts(train, counted, "bucket long, n0 long, n1 long").groupBy("bucket").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    n0, n1 = next(((int(r.n0), int(r.n1)) for r in counts.where("bucket = -1").collect()), (0, 0))
    bias = float(np.log((n1 + 0.5) / (n0 + 0.5))) if n0 + n1 else -50.0
    if not n0 or not n1:
        return Model(np.zeros(1 << BITS, np.float32), bias)
    ratio = F.log((F.col("n1") + 1) / F.lit(n1 + 2.0)) - F.log((F.col("n0") + 1) / F.lit(n0 + 2.0))
    spread = F.sqrt(1 / (F.col("n1") + 1) + 1 / (F.col("n0") + 1))
    kept = (counts.where((F.col("bucket") >= 0) & (F.col("n0") + F.col("n1") >= MIN_DOCS))
            .select("bucket", ratio.alias("ratio"), F.abs(ratio / spread).alias("z"))
            .where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "bucket").limit(max_features).collect())
    feature, scale = np.array([r.bucket for r in kept], np.int64), np.array([r.ratio for r in kept], np.float64)
    del kept
    feature, scale = feature[order := np.argsort(feature)], scale[order]
    kind = np.uint16 if len(feature) <= 1 << 16 else np.int32     # of the features that reach the driver
    number = np.full(1 << BITS, -1, np.int32)
    number[feature] = np.arange(len(feature))
    shared = train.sparkSession.sparkContext.broadcast(number)             # 4 MB whatever the data

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0)
            for row, end, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                doc, bucket = buckets(data, offsets, shared.value >= 0)
                bounds = np.searchsorted(doc, np.arange(end - row + 1))
                ids = shared.value[bucket].astype(kind)
                yield pa.record_batch([label.slice(row, end - row), pa.array(
                    [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], names=["label", "ids"])

    rows = map_texts(train, featured, "label int, ids binary").toArrow()    # at most max_train rows of features
    weight, bias = logistic(rows, kind, scale, bias)
    table = np.zeros(1 << BITS, np.float32)
    table[feature] = weight * scale
    return Model(table, bias)


def logistic(rows: pa.Table, kind: type, scale: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """L2 logistic regression by accelerated gradient steps; features are ``scale`` where present.

    ``rows`` has the label and the features (``ids``, the bytes of numbers of
    ``kind``) of each document.  A step takes some documents at a time.
    """
    order = pc.sort_indices(rows, sort_keys=[("ids", "ascending"), ("label", "ascending")])   # the same sums for any row order
    label = np.asarray(rows.column("label").combine_chunks().take(order)).astype(np.float64)
    ids = rows.column("ids").combine_chunks().take(order)
    n, width = max(1, len(label)), np.dtype(kind).itemsize

    def parts() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for row, end, data, offsets in chunks(ids, STEP_BYTES):
            yield slice(row, end), data.view(kind), np.repeat(np.arange(end - row), np.diff(offsets) // width)

    held, squares, most = np.zeros(len(scale)), 0.0, 0
    for at, flat, doc in parts():
        held += np.bincount(flat, minlength=len(scale))
        squares = max(squares, np.bincount(doc, scale[flat] ** 2).max(initial=0))
        most = max(most, np.bincount(doc).max(initial=0))
    bound = squares + 1
    w = np.zeros(len(scale) + 1)
    w[-1] = bias
    look, momentum = w.copy(), 1.0
    # Steps follow each feature's own curvature, bounded by the documents that hold it.
    step = 1.0 / np.append(0.25 * held * scale ** 2 / n * min(most + 1, 64) + L2 + 1e-3 * bound / n, 0.25)
    error = np.zeros(len(label))
    for _ in range(STEPS):
        scaled, total = look[:-1] * scale, np.zeros(len(scale))
        for at, flat, doc in parts():
            margin = np.bincount(doc, scaled[flat], minlength=at.stop - at.start) + look[-1]
            error[at] = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label[at]
            total += np.bincount(flat, error[at][doc], minlength=len(scale))
        grad = np.append(total * scale / n + L2 * look[:-1], error.mean())
        new = look - 0.5 * step * grad
        if (new - w) @ grad > 0:
            momentum = 1.0
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        look = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """``keep`` (the id column unless given) and the score of each whole text, row by row.

    Null and empty texts have no n-grams; their score is that of the bias.
    """
    keep = keep or [id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)                 # 4 MB whatever the data
    rest = [c for c in keep if c != text_col]
    schema = docs.select(*[docs[c] for c in rest], docs[text_col]).schema.add(score_col, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = shared.value.weight, shared.value.bias
        wanted = weight != 0
        for batch in batches:
            out = np.full(batch.num_rows, bias)
            for row, end, data, offsets in chunks(batch.column(len(rest)), CHUNK_BYTES):
                doc, bucket = buckets(data, offsets, wanted)
                out[row:end] += np.bincount(doc, weight[bucket], minlength=end - row)
            yield pa.record_batch([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(out, -40, 40))))], names=schema.names)

    found = map_texts(docs.select(*rest, text_col), scored, schema)
    return found.select(*keep, score_col)


def drop_toxic(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, columns unchanged."""
    scored = score(docs, model, id_col=id_col, text_col=text_col, keep=docs.columns, score_col="_toxic_score")
    return scored.where(F.col("_toxic_score") < threshold).select(docs.columns)
