"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

Fingerprint: a document's bit is 1 where over half of its 3-word shingles have
that bit in their XXH64.  Two fingerprints link at ``max_bits`` (3) or fewer
differing bits; links join documents into components.

Links are found without comparing all pairs.  Fingerprints are first reduced
to the distinct ones.  Of four 16-bit blocks, at least one is equal in a
linked pair (pigeonhole); of the two 23-bit segments cut from the other 48
bits, at least one then has at most one error.  The binary Golay code [23, 12]
maps a segment to its nearest codeword (at most 3 bits away) and to all
codewords within 4 bits (one or six in all): a segment and one with a single
bit changed always share the nearest codeword of the one among the near
codewords of the other.  So each fingerprint gets keys (block, segment, block
value, codeword index), about 42 of them, and only fingerprints that share a
key are compared, bit by bit.

Fingerprints of a key are compared inside sorted partitions with numpy, and a
key gives a spanning forest of its links, not all pairs.  A key with more than
``CHUNK`` fingerprints is split into chunks whose pairs are dealt out as
separate groups, so nothing is left out and no group grows beyond two chunks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.batches import map_texts
from fundscope.llm.graph import components
from fundscope.llm.storage import stored

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CHUNK = 2048
HELD_PAIRS = 1 << 20
SHINGLES_AT_ONCE = 1 << 18

# ------------------------------------------------------------------ Golay code

GENERATOR = 0xC75        # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
LENGTH, CHECKS = 23, 11


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


def _linear(bits: range) -> np.ndarray:
    table = np.zeros(1 << len(bits), np.int64)
    for k, bit in enumerate(bits):
        table[1 << k: 2 << k] = table[: 1 << k] ^ _remainder(1 << bit)
    return table


LOW, HIGH = _linear(range(12)), _linear(range(12, 23))


def syndrome(word: np.ndarray) -> np.ndarray:
    return LOW[word & 0xFFF] ^ HIGH[word >> 12]


def _patterns() -> np.ndarray:
    """For each syndrome the error patterns of weight up to 4, the lightest first, padded with it to six."""
    table: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        for bits in itertools.combinations(range(LENGTH), weight):
            pattern = sum(1 << b for b in bits)
            table[_remainder(pattern)].append(pattern)
    return np.array([x + x[:1] * (6 - len(x)) for x in table], np.int64)


def codewords(word: np.ndarray) -> np.ndarray:
    """Indices of the codewords near each 23-bit word: the nearest in column 0, all within 4 bits in the six."""
    return (word[:, None] ^ PATTERNS[syndrome(word)]) >> CHECKS


PATTERNS = _patterns()


def keys(fingerprint: np.ndarray) -> np.ndarray:
    """(n, 8, 6) keys: column 0 of the last axis is the nearest codeword's."""
    blocks = [((fingerprint >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]
    out = []
    for b in range(4):
        rest = [blocks[k] for k in range(4) if k != b]
        wide = rest[0] | rest[1] << 16 | rest[2] << 32
        for s in range(2):
            segment = (wide >> (24 * s)) & 0x7FFFFF
            out.append(((2 * b + s) << 28 | blocks[b][:, None] << 12) | codewords(segment))
    return np.stack(out, axis=1)


# ------------------------------------------------------------------ fingerprints

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _bit_counts(h: np.ndarray) -> np.ndarray:
    part = h.view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(part[:, k], minlength=256) @ _BITS for k in range(8)])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one whole text (its bytes); no words: zero."""
    text = b" ".join(text.lower().split())        # bytes: A-Z and ASCII white space only
    if not text:
        return 0
    gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    start = np.concatenate([[0], gaps + 1])
    end = np.concatenate([gaps, [len(text)]])
    if len(start) > shingle:
        start, end = start[: -(shingle - 1) or None], end[shingle - 1:]
    else:
        start, end = start[:1], end[-1:]
    digest, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(start), SHINGLES_AT_ONCE):
        spans = zip(start[k: k + SHINGLES_AT_ONCE].tolist(), end[k: k + SHINGLES_AT_ONCE].tolist())
        count += _bit_counts(np.array([digest(text[s:e], SEED) for s, e in spans], np.uint64))
    return int(np.packbits(2 * count > len(start), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Id and ``fp`` (the 64 bits as a long) of every row; null texts have no words."""
    schema = docs.select(id_col).schema.add("fp", "long")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            fp = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(fp.view(np.int64))], names=schema.names)

    return map_texts(docs.select(id_col, text_col), hashed, schema)


# ------------------------------------------------------------------ links

def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.asarray(batch.column(0))
        for at in range(0, len(fp), 8192):
            part = fp[at: at + 8192]
            k = keys(part.view(np.uint64))
            fresh = np.ones(k.shape, bool)
            fresh[:, :, 1:] = k[:, :, 1:] != k[:, :, :1]        # padding repeats the nearest
            nearest = np.zeros(k.shape, bool)
            nearest[:, :, 0] = True
            yield pa.record_batch([pa.array(k[fresh]), pa.array(np.broadcast_to(part[:, None, None], k.shape)[fresh]),
                                   pa.array(nearest[fresh])], names=["key", "fp", "nearest"])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each of n nodes' components under the links a-b."""
    parent = np.arange(n)
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        open_ = low != high
        if not open_.any():
            return parent
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def forest(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within max_bits inside each group; rows are sorted by group."""
    found_a, found_b, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    live, d = np.arange(len(fp)), 1

    def joined():
        root = roots(len(fp), np.concatenate(found_a), np.concatenate(found_b))
        other = np.flatnonzero(root != np.arange(len(fp)))
        return root[other], other

    while True:
        live = live[live + d < len(fp)]
        live = live[group[live] == group[live + d]]
        if not len(live):
            break
        close = live[np.bitwise_count((fp[live] ^ fp[live + d]).view(np.uint64)) <= max_bits]
        found_a.append(close)
        found_b.append(close + d)
        held += len(close)
        if held > HELD_PAIRS:
            a, b = joined()
            found_a, found_b, held = [a], [b], len(a)
        d += 1
    a, b = joined()
    return fp[a], fp[b]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) that connect all pairs within ``max_bits`` (3 at most)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys hold for up to 3 differing bits")
    # A fingerprint becomes 42 entries: dealt out by a hash and a number, so that few small partitions are not merged before that.
    spread = distinct.select("fp").repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    entries = spread.mapInArrow(_keyed, "key long, fp long, nearest boolean")
    shared = (entries.groupBy("key")
              .agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"), F.max("nearest").alias("any"))
              .where("low <> high and any").select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts")))
    chunk = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # Spark sizes the entries as the fingerprints they are made of, 42 times too low, and would send them to the driver for a broadcast.
    pairs = (entries.join(shared.hint("merge"), "key")
             .select("key", "fp", chunk.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
             .select("key", F.least("mine", "other").alias("c1"), F.greatest("mine", "other").alias("c2"), "fp"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((4, 0), np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rest = np.concatenate([rest, np.stack([np.asarray(c).astype(np.int64) for c in batch.columns])], axis=1)
            new = np.append(True, (np.diff(rest[:3]) != 0).any(axis=0)) if rest.shape[1] else np.zeros(0, bool)
            cut = rest.shape[1] if batch is None else int(np.flatnonzero(new)[-1]) if len(new) else 0   # the last group may go on
            a, b = forest(np.cumsum(new[:cut]), rest[3, :cut], max_bits)
            rest = rest[:, cut:]
            yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return (pairs.repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2", "fp")
            .mapInArrow(linked, "a long, b long"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Id, ``fp`` and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included.  Rows that repeat an id stay, each by its own text.  A row
    without id takes part, but its component takes the id of another member
    (null if there is none).  Texts without words share fingerprint zero.
    """
    marked = stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    found = components(links(distinct, max_bits)).select(F.col("node").alias("fp"), "root")
    owner = distinct.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least_id")
    named = owner.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = owner.join(named, "root").select("fp", "component_id")
    # As many rows as documents, and small files: no broadcast here either.
    return marked.join(by_fp.hint("merge"), "fp").select(id_col, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without the later members of each component; columns unchanged.

    Rows are told apart by id and text.  The member with the smallest id stays
    (of one id, the text with the smallest hash; a row without id comes before
    all ids); of rows that repeat both, one stays.
    """
    rows = docs.withColumn("_row", F.struct(F.col(id_col), F.xxhash64(text_col)))
    found = near_duplicates(rows.select("_row", F.col(text_col).alias("_text")), id_col="_row", text_col="_text", **options)
    later = found.where(F.col("_row") != F.col("component_id")).select("_row").distinct()
    one = Window.partitionBy("_row").orderBy(F.lit(0))
    return (rows.join(later, "_row", "left_anti").withColumn("_copy", F.row_number().over(one))
            .where("_copy = 1").select(docs.columns))
