"""MinHash near-duplicates by an inverted join over signature coordinates.

A document's set is its distinct 5-word shingles; two sets link when their
Jaccard similarity is at least ``percent`` of 100.  Documents with one and the same
set are one class from the start.  A class is posted under its signature: the
pairs (coordinate, least hash in it) of ``COORDINATES`` hash functions, one
64-bit token each.  Linked sets agree in a coordinate with probability 0.85 or
more, so they collide in fewer than ``MATCHES`` of 64 coordinates about seven
times in 10^9 pairs at the very threshold, and far more rarely above it.

Collisions are counted with prefix and skip merging.  Tokens are ordered by
how many classes share them, rarest first; a pair of ``MATCHES`` collisions
collides in the prefix of both that leaves out the last ``MATCHES - 1`` tokens,
so only prefixes are posted, and classes that share fewer than ``MATCHES``
tokens with anything are not posted at all.  Inside a posting list classes are
merged in the order of their set sizes, and a pair is skipped, uncounted, when
its sizes rule a link out or its classes are joined already: a list gives a
spanning forest of its pairs with ``MATCHES`` collisions, not all of them.

Whatever is linked lies in one component of these forests, so the components
are bundles that can be confirmed one by one: each set goes to its bundle, and
there one merge of the inverted lists of all shingles counts how many shingles
any two sets share -- exactly, without a comparison per pair.  Again a forest of
the links comes out, and its components are the result.  Lists and bundles of
more than ``CHUNK`` classes are dealt out as pairs of chunks, each a group of
its own, so nothing is left out and no group grows with the list or bundle; the
sets of a bundle of n classes are then sent n / CHUNK times.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.llm.arrays import LOWER, NON_SPACE, U64, Sums, Words, _spread, chunks, mix, ranges
from fundscope.llm.graph import components
from fundscope.llm.simhash import roots
from fundscope.llm.storage import stored

SHINGLE = 5
PERCENT = 85
COORDINATES = 64
MATCHES = 36
CHUNK = 1024

MULTIPLIERS = _spread(COORDINATES, 71) | U64(1)
MASKS, MARKERS = _spread(COORDINATES, 72), _spread(COORDINATES, 73)
KEY_SEEDS = _spread(2, 74)


# ------------------------------------------------------------------ sets and signatures

def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, end to end; bounds of the texts in them)."""
    words = Words(LOWER[data], offsets, NON_SPACE)
    n = words.counts
    count = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
    start = ranges(words.doc[:-1], count)
    owner = np.repeat(np.arange(len(n)), count)
    h = Sums(words.hashes())(start, np.minimum(start + shingle, words.doc[1:][owner]))
    order = np.argsort(h)
    order = order[np.argsort(owner[order], kind="stable")]
    h, owner = h[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[first], np.searchsorted(owner[first], np.arange(len(n) + 1))


def signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((texts, COORDINATES) tokens, (texts, 2) digests of the sets) of the texts that have shingles."""
    at = bounds[:-1][np.diff(bounds) > 0]
    tokens = np.zeros((len(at), COORDINATES), U64)
    key = np.zeros((len(at), 2), U64)
    if len(at):
        for k in range(COORDINATES):
            tokens[:, k] = mix(np.minimum.reduceat((sets ^ MASKS[k]) * MULTIPLIERS[k], at) ^ MARKERS[k])
        for k in range(2):
            key[:, k] = mix(np.add.reduceat(mix(sets ^ KEY_SEEDS[k]), at))
    return tokens, key


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a contiguous 2-d array."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _row_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def signed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``row_id``, ``mark`` (hash of the text), ``n_shingles`` of every row; ``key`` (16 bytes, of the set) and ``tokens`` where the set is not empty."""
    rows = docs.select(F.col(id_col).alias("row_id"), _row_hash(text_col).alias("mark"), F.col(text_col).alias("text"))
    schema = rows.drop("text").schema.add("n_shingles", "long").add("key", "binary").add("tokens", T.ArrayType(T.LongType()))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(2)):
                sets, bounds = shingle_sets(data, offsets, shingle)
                tokens, key = signatures(sets, bounds)
                n = np.diff(bounds)
                place = pa.array(np.cumsum(n > 0) - 1, mask=n == 0)         # null: an empty set
                listed = pa.ListArray.from_arrays(np.arange(len(tokens) + 1, dtype=np.int32) * np.int32(COORDINATES),
                                                  pa.array(tokens.ravel().view(np.int64)))
                yield pa.record_batch([batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row),
                                       pa.array(n), _binary(key).take(place), listed.take(place)], names=schema.names)

    return rows.mapInArrow(sign, schema)


def full_sets(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(key, shingles) from (key, text)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                sets, bounds = shingle_sets(data, offsets, shingle)
                yield pa.record_batch([batch.column(0).slice(row, end - row),
                                       pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(sets.view(np.int64)))],
                                      names=["key", "shingles"])

    return texts.select("key", "text").mapInArrow(cut, "key binary, shingles array<bigint>")


# ------------------------------------------------------------------ candidates

def prefixes(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """``key``, ``n_shingles``, ``sketch`` (a byte per coordinate) and ``prefix`` of the classes that share enough tokens to
    be linked with anything."""
    entries = classes.select("key", F.explode("tokens").alias("token"))
    shared = stored(entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "shared_tokens")
    ranked = (entries.join(shared, "token").groupBy("key")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
              .where(F.size("ranked") >= matches))
    prefix = F.slice("ranked", F.lit(1), F.size("ranked") - (matches - 1))
    sketch = F.unhex(F.array_join(F.transform("tokens", lambda t: F.lpad(F.hex(t.bitwiseAND(0xFF)), 2, "0")), ""))
    return (ranked.select("key", F.transform(prefix, lambda x: x["token"]).alias("prefix"))
            .join(classes.select("key", "n_shingles", sketch.alias("sketch")), "key"))


def in_chunks(members: DataFrame, group: str) -> DataFrame:
    """Members of groups of two or more, dealt out for all pairs: ``c1`` <= ``c2`` name a pair of chunks, ``mine`` is the row's own."""
    sizes = stored(members.groupBy(group).agg(F.count("*").alias("n")).where("n > 1")
                   .select(group, F.ceil(F.col("n") / CHUNK).cast("int").alias("parts")), "group_sizes")
    dealt = members.join(sizes, group).withColumn("mine", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return other.withColumns({"c1": F.least("mine", "other"), "c2": F.greatest("mine", "other")}).drop("parts", "other")


def _fixed(column: pa.Array, kind, width: int) -> np.ndarray:
    """A column of binary values of one size as rows of ``width`` numbers."""
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]: ends[-1]].view(kind).reshape(-1, width)


def whole_groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """(number of the group of each row, rows): batches of whole groups, by their first ``columns``; rows are sorted by these."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None and not len(batch):
            continue
        if batch is not None:
            rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if rest is None:
            return
        new = np.ones(len(rest), bool)
        new[1:] = False
        for k in range(columns):
            new[1:] |= pc.not_equal(rest.column(k)[1:], rest.column(k)[:-1]).to_numpy(zero_copy_only=False)
        cut = len(new) if batch is None else int(np.flatnonzero(new)[-1])       # the last group may go on
        if cut:
            yield np.cumsum(new[:cut]), rest.slice(0, cut)
        rest = rest.slice(cut)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    root = roots(n, a, b)
    other = np.flatnonzero(root != np.arange(n))
    return root[other], other


def colliding(group: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, matches: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs inside groups (rows ascend by group and size) that collide in enough coordinates."""
    n = len(group)
    a = b = np.zeros(0, np.int64)
    root, live, d = np.arange(n), np.arange(n), 1
    while True:
        live = live[live + d < n]
        live = live[(group[live] == group[live + d]) & (100 * sizes[live] >= percent * sizes[live + d])]   # skipped from here on
        if not len(live):
            return a, b
        apart = live[root[live] != root[live + d]]
        hits = [part[(sketches[part] == sketches[part + d]).sum(axis=1) >= matches]
                for part in np.array_split(apart, max(1, len(apart) >> 14))]
        if sum(map(len, hits)):
            hit = np.concatenate(hits)
            a, b = _forest(np.concatenate([a, hit]), np.concatenate([b, hit + d]), n)
            root[b] = a
        d += 1


def candidates(posted: DataFrame, matches: int = MATCHES, percent: int = PERCENT) -> DataFrame:
    """(a, b): pairs of classes that join all pairs with at least ``matches`` collisions."""
    lists = posted.select(F.explode("prefix").alias("token"), "key", "n_shingles", "sketch")
    dealt = in_chunks(lists, "token").select("token", "c1", "c2", "n_shingles", "key", "sketch")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in whole_groups(batches, 3):
            key = _fixed(rows.column(4), U64, 2)
            a, b = colliding(group, np.asarray(rows.column(3)), _fixed(rows.column(5), np.uint8, COORDINATES), matches, percent)
            yield pa.record_batch([_binary(key[a]), _binary(key[b])], names=["a", "b"])

    return (dealt.repartition("token", "c1", "c2").sortWithinPartitions("token", "c1", "c2", "n_shingles")
            .mapInArrow(merge, "a binary, b binary").distinct())


# ------------------------------------------------------------------ confirmation

def similar(group: np.ndarray, chunk: np.ndarray, bounds: np.ndarray, shingles: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs inside groups whose sets (sorted, end to end) reach the similarity.

    The shingles of a row meet those of the later rows of its group in inverted
    lists; a row adds up its lists once, which gives what it shares with each.
    In a group of two chunks only pairs across them count.
    """
    n, size = len(group), np.diff(bounds)
    owner = np.repeat(np.arange(n), size)
    _, name = np.unique(shingles ^ mix(group.astype(U64))[owner], return_inverse=True)
    order = np.argsort(name, kind="stable")
    held = owner[order]                                       # rows of each shingle, ascending
    start = np.searchsorted(name[order], np.arange(name.max(initial=-1) + 2))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))                      # where a posting stands in its list
    last = np.searchsorted(group, group, "right")
    first = np.searchsorted(group, group, "left")
    mixed = np.array([len(np.unique(chunk[f:t])) > 1 for f, t in zip(first[first == np.arange(n)], last[first == np.arange(n)])], bool)
    mixed = np.repeat(mixed, np.diff(np.append(np.flatnonzero(first == np.arange(n)), n)))
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(n):
        if last[a] - a < 2:
            continue
        mine = slice(bounds[a], bounds[a + 1])
        later = start[name[mine] + 1] - place[mine] - 1
        shared = np.bincount(held[ranges(place[mine] + 1, later)] - a, minlength=last[a] - a)[1:]
        near = 100 * shared >= percent * (size[a] + size[a + 1: last[a]] - shared)
        if mixed[a]:
            near &= chunk[a + 1: last[a]] != chunk[a]
        hits = np.flatnonzero(near) + a + 1
        out_a.append(np.full(len(hits), a))
        out_b.append(hits)
    return _forest(np.concatenate(out_a), np.concatenate(out_b), n)


def links(bundles: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): pairs of classes that join all pairs of one bundle (``key``, ``bundle``) with similar sets (``key``, ``shingles``)."""
    dealt = in_chunks(bundles, "bundle").join(sets, "key").select("bundle", "c1", "c2", "mine", "key", "shingles")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in whole_groups(batches, 3):
            key, listed = _fixed(rows.column(4), U64, 2), rows.column(5)
            bounds = np.asarray(listed.offsets).astype(np.int64)
            shingles = np.asarray(listed.values)[bounds[0]: bounds[-1]].view(U64)
            a, b = similar(group, np.asarray(rows.column(3)), bounds - bounds[0], shingles, percent)
            yield pa.record_batch([_binary(key[a]), _binary(key[b])], names=["a", "b"])

    return (dealt.repartition("bundle", "c1", "c2").sortWithinPartitions("bundle", "c1", "c2")
            .mapInArrow(confirm, "a binary, b binary").distinct())


# ------------------------------------------------------------------ operator

def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, matches: int = MATCHES) -> DataFrame:
    """Id, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included; ``kept``: the row's id is that id.  For a lower ``percent`` choose
    ``matches`` lower too.  Null texts and texts without words have no shingles and link
    with nothing.  Rows that repeat an id stay, each by its own text.  A row
    without id takes part, is never kept, and its component takes the id of
    another member (null if there is none).
    """
    rows = stored(signed(docs, id_col=id_col, text_col=text_col, shingle=shingle), "signatures")
    classes = stored(rows.where("n_shingles > 0").groupBy("key")
                     .agg(F.min("row_id").alias("least_id"), F.min(F.struct("row_id", "mark")).alias("one"),
                          F.any_value("n_shingles").alias("n_shingles"), F.any_value("tokens").alias("tokens")), "classes")
    posted = stored(prefixes(classes, matches), "posted")

    bundles = stored(components(candidates(posted, matches, percent)).select(F.col("node").alias("key"), F.col("root").alias("bundle")), "bundles")

    wanted = bundles.select("key").join(classes.select("key", "one"), "key").select("key", "one.row_id", "one.mark")
    texts = docs.select(F.col(id_col).alias("id"), _row_hash(text_col).alias("text_mark"), F.col(text_col).alias("text"))
    same = F.col("id").eqNullSafe(F.col("row_id")) & (F.col("text_mark") == F.col("mark"))
    sets = full_sets(texts.join(wanted, same).select("key", "text").dropDuplicates(["key"]), shingle)
    joined = components(links(bundles, sets, percent)).select(F.col("node").alias("key"), "root")

    owner = classes.select("key", "least_id").join(joined, "key", "left").select("key", F.coalesce("root", "key").alias("root"), "least_id")
    named = owner.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_key = stored(owner.join(named, "root").select("key", "component_id"), "components")
    found = rows.join(by_key, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("row_id"))
    return found.select(F.col("row_id").alias(id_col), "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("row_id") == component, F.lit(False)).alias("kept"))
