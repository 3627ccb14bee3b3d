"""Quality classifier: supervised subword embeddings.

Every word and every character n-gram of a word (3 and 4 characters, with the
spaces around the word as its ends) has a learned vector, kept in 2**18 hash
buckets.  Every occurrence of a word also has the vectors of its frequency: how
often the word is in the document, what share of the document's words it is, and
both together, in steps of powers of two.  (Which frequencies speak for or
against a document is learned like everything else; hashed words alone cannot
tell a text that is one word over and over from others with that word.)  A
document is the average of the vectors of all its words and n-grams; a softmax over the classes reads that average.  Vectors and softmax
are trained together by stochastic gradient descent in numpy, one document a
step.

Bound: the fit reads at most ``max_train`` labelled documents (by the hash of
their id).  For scoring, the softmax is folded into the vectors: the average
is linear, so each bucket needs only its share of the margin between the two
classes.  Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.arrays import NON_SPACE, Words, characters, chunks, heads, ranges

SIZES = (3, 4)
BITS = 18
DIM = 8
EPOCHS = 5
RATE = 0.5
MAX_TRAIN = 3_000
FREQUENCIES = 1024         # the first buckets are for frequencies


@dataclass
class Model:
    margin: np.ndarray     # float32 per bucket: (vector of class 1 - vector of class 0) . bucket's vector
    bias: float


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word, its frequency and every n-gram of a run of documents, with multiplicity."""
    words = Words(data, offsets, NON_SPACE)
    h, doc = words.hashes(), words.doc_of()
    docs, out = [doc] * 4, [(h >> np.uint64(64 - BITS)).astype(np.int32), *frequencies(h, doc, words.counts)]
    value, bound = characters(data, offsets, lower=False)
    # each document gets a space before and after it; every white space counts as a space
    n_docs = len(offsets) - 1
    space = (value < 0x80) & ~NON_SPACE[np.minimum(value, 0x7F)]
    value = np.where(space, np.uint32(0x20), value)
    size = np.diff(bound)
    text = np.full(len(value) + 2 * n_docs, 0x20, np.uint32)
    text[ranges(bound[:-1] + 2 * np.arange(n_docs) + 1, size)] = value
    gap = np.concatenate([[0], np.cumsum(text == 0x20)])
    doc = np.repeat(np.arange(n_docs), size + 2)
    h = text * np.uint32(0x9E3779B1)
    for n in range(2, max(SIZES) + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint32(0x01000193) + text[n - 1:] * np.uint32(0x85EBCA6B)
        if n in SIZES:
            at = np.flatnonzero(gap[n - 1: len(text)] == gap[1: len(text) - n + 2])   # no space between first and last
            b = ((h[at] ^ (h[at] >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)) >> np.uint32(32 - BITS)
            docs.append(doc[at])
            out.append(b.astype(np.int32))
    for k in (0, *range(4, len(out))):
        out[k] = np.maximum(out[k], FREQUENCIES)
    return np.concatenate(docs), np.concatenate(out)


def frequencies(h: np.ndarray, doc: np.ndarray, n_words: np.ndarray) -> list[np.ndarray]:
    """Three buckets below ``FREQUENCIES`` for each word: by its count in the document, by its share, by both."""
    order = np.argsort(h)
    order = order[np.argsort(doc[order], kind="stable")]
    head = np.flatnonzero(np.append(True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1]))[: len(h)])
    size = np.diff(np.append(head, len(h)))
    count = np.empty(len(h), np.int64)
    count[order] = np.repeat(size, size)
    n = n_words[doc]
    times, length = np.log2(count).astype(np.int32), np.log2(np.maximum(n, 1)).astype(np.int32)
    share = (2 * np.log2(n / np.maximum(count, 1))).astype(np.int32)        # half powers of two
    both = 600 + np.minimum(times, 12) * 8 + np.clip(length - times, 0, 7)
    return [times, 512 + share, both]


def fit(docs: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "label", max_train: int = MAX_TRAIN, seed: int = 7) -> Model:
    """Train on the documents that ``labelled`` (id, 0/1 label) names; null labels and ids are left out.

    With one label only, or none, every score is the share of label 1 (0 where nothing is labelled).
    """
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    chosen = labelled.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_train)
    train = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), "id").select("id", "label", "text"))   # at most max_train small rows

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(2)):
                doc, bucket = subwords(data, offsets)
                key = np.sort((doc.astype(np.int64) << BITS) | bucket)
                head = heads(key)
                key, many = key[head], np.diff(np.append(head, len(key)))
                at = np.searchsorted(key >> BITS, np.arange(end - row + 1))
                ids = (key & ((1 << BITS) - 1)).astype(np.int32)
                many = many.astype(np.float32)
                yield pa.record_batch([batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row),
                                       pa.array([ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                                       pa.array([many[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                                      names=["id", "label", "ids", "many"])

    schema = train.select("id", "label").schema.add("ids", "binary").add("many", "binary")
    rows = train.mapInArrow(bags, schema).toArrow().to_pylist()             # at most max_train rows
    rows.sort(key=lambda r: (str(r["id"]), r["ids"]))
    return train_bags([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["many"], np.float32)) for r in rows],
                      np.array([int(r["label"] != 0) for r in rows], np.int64), seed)


def train_bags(bags: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, seed: int = 7) -> Model:
    """Stochastic gradient descent over the documents, in a seeded order, with a falling rate."""
    rng = np.random.default_rng(seed)
    share = np.bincount(label, minlength=2) + 0.5
    prior = np.log(share / share.sum()) if len(label) else np.array([0.0, -50.0])
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    softmax, offset = rng.normal(0, 0.1, (2, DIM)), prior.copy()
    met = np.zeros(1 << BITS, bool)
    if len(np.unique(label)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), float(prior[1] - prior[0]))
    steps = EPOCHS * len(bags)
    for epoch in range(EPOCHS):
        for k, i in enumerate(rng.permutation(len(bags))):
            ids, many = bags[i]
            if not len(ids):
                continue
            rate = RATE * (1 - (epoch * len(bags) + k) / steps)
            part = (many / many.sum())[:, None]
            mean = (vectors[ids] * part).sum(axis=0)
            z = softmax @ mean + offset
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[label[i]] -= 1
            back = error @ softmax
            softmax -= rate * np.outer(error, mean)
            offset -= 0.1 * rate * error
            # fastText's step: the whole gradient of the average goes to each of its vectors
            vectors[ids] -= (rate * np.minimum(1.0, part * len(ids)) * back).astype(np.float32)
            met[ids] = True
    margin = (vectors @ (softmax[1] - softmax[0])) * met                    # a bucket never trained on says nothing
    return Model(margin.astype(np.float32), float(offset[1] - offset[0]))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """Id and score of each whole text, row by row; null and empty texts get the softmax of the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)                # 1 MB whatever the data
    schema = docs.select(id_col).schema.add(score_col, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin, bias = shared.value.margin, shared.value.bias
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for row, end, data, offsets in chunks(batch.column(1)):
                doc, bucket = subwords(data, offsets)
                total = np.bincount(doc, margin[bucket], minlength=end - row)
                out[row:end] = total / np.maximum(1, np.bincount(doc, minlength=end - row))
            yield pa.record_batch([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(out + bias, -40, 40))))],
                                  names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(scored, schema)
