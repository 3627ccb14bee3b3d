"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the token postings of the whole corpus: documents are
dealt into shards of some hundred thousand words, and each shard is one row that
holds its documents, its terms (sorted 64-bit hashes) and, term by term, the
sorted positions.  A shard is built inside one task and never shuffled, as in
a document-partitioned search engine; a frequent term is spread over all
shards.

``search`` runs every test passage against every shard.  In a shard a window
starts from its rarest term; the positions of that term, moved back by the
term's offset in the window, are the candidates, and the lists of the other
terms, each moved by its own offset, are intersected with them from rare to
frequent.  What is left are exact phrase matches.  With ``slop`` > 0 a second
pass accepts every term within ``slop`` words of its place (proximity).

The test passages are the stated query set.  They are hashed in tasks and stored
in blocks; a job searches blocks of about ``block_words`` words together (some 24
bytes a word), which is all that is collected and broadcast at a time, and its
broadcast is given up before the next job.  Each job reads the whole index once,
so a test set of many blocks costs as many passes; what it finds is stored and
put together by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.llm.arrays import ALNUM, LOWER, Words, chunks, heads, ranges, sums_by
from fundscope.llm.batches import map_texts
from fundscope.llm.storage import stored

WINDOW = 13
MIN_SHARE = 20            # contaminated: at least one word in 20 is hit
SHARD_BYTES = 1 << 20
BLOCK_WORDS = 1 << 18
CANDIDATES = 1 << 21      # candidates that are held at a time


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(LOWER[data], offsets, ALNUM)


# ------------------------------------------------------------------ index

def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard.  Null texts have no words; null ids and repeated ids stay, row by row."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("n_words", T.ArrayType(T.IntegerType())),
        T.StructField("terms", T.BinaryType()),
        T.StructField("first", T.BinaryType()),
        T.StructField("positions", T.BinaryType()),
    ])                                          # and the number of the shard

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1), SHARD_BYTES):
                words = _words(data, offsets)
                h = words.hashes()
                order = np.argsort(h, kind="stable")
                first = heads(h[order])
                terms = h[order[first]]
                ids = batch.column(0).slice(row, end - row)
                yield pa.record_batch([
                    pa.ListArray.from_arrays(pa.array([0, end - row], pa.int32()), ids),
                    pa.array([words.counts.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([terms.tobytes()], pa.binary()),
                    pa.array([np.append(first, len(h)).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([order.astype(np.int32).tobytes()], pa.binary()),
                ], names=schema.names)

    return map_texts(docs.select(id_col, text_col), shards, schema).withColumn("shard", F.monotonically_increasing_id())


class Shard:
    def __init__(self, n_words: np.ndarray, terms: np.ndarray, first: np.ndarray, positions: np.ndarray):
        self.bounds = np.concatenate([[0], np.cumsum(n_words)])   # of the documents, in words
        self.size = max(1, int(self.bounds[-1]))
        self.terms, self.first, self.positions = terms, first, positions
        term = np.repeat(np.arange(len(terms)), np.diff(first))
        self.postings = term * self.size + positions              # sorted by term, then position

    def term_of(self, h: np.ndarray) -> np.ndarray:
        """Number of the term in this shard, -1 where it does not occur."""
        if not len(self.terms):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, position, "right") - 1

    def near(self, term: np.ndarray, position: np.ndarray, low: np.ndarray, high: np.ndarray, slop: int) -> np.ndarray:
        """Whether the term has a posting within slop of position, and from low up to high."""
        low, high = np.maximum(low, position - slop), np.minimum(high, position + slop + 1)
        at = np.searchsorted(self.postings, term * self.size + low)
        found = self.postings[np.minimum(at, len(self.postings) - 1)]
        return (at < len(self.postings)) & (low < high) & (found < term * self.size + high)


# ------------------------------------------------------------------ test passages

class Block:
    """Word hashes and windows of some test items."""

    def __init__(self, names: list[str | None], n_words: np.ndarray, hashes: np.ndarray, window: int):
        self.names, self.hashes = names, hashes
        first = np.concatenate([[0], np.cumsum(n_words)])
        per_item = np.where(n_words > 0, np.maximum(1, n_words - window + 1), 0)
        self.item = np.repeat(np.arange(len(names)), per_item)
        self.start = ranges(first[:-1], per_item)
        self.length = np.minimum(window, first[1:][self.item] - self.start)
        place = np.arange(int(self.length.max(initial=1)))
        #: a row of word numbers for each window, -1 beyond a short window's end
        self.grid = np.where(place < self.length[:, None], self.start[:, None] + place, -1).astype(np.int32)


def passages(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> DataFrame:
    """block, names, n_words, hashes, size: the test items in blocks, hashed where they are read."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1), 2 * block_words):         # a word has two bytes at least
                words = _words(data, offsets)
                yield pa.record_batch([
                    pa.ListArray.from_arrays(pa.array([0, end - row], pa.int32()), batch.column(0).slice(row, end - row).cast(pa.string())),
                    pa.array([words.counts.astype(np.int32)], pa.list_(pa.int32())), pa.array([words.hashes().tobytes()], pa.binary()),
                    pa.array([len(words)], pa.int64())], names=["names", "n_words", "hashes", "size"])

    return (map_texts(rows, hashed, "names array<string>, n_words array<int>, hashes binary, size long")
            .withColumn("block", F.monotonically_increasing_id()))


def searched_together(blocks: DataFrame, block_words: int) -> list[list[int]]:
    """Numbers of the blocks of each job: as many as make ``block_words`` words, one at least."""
    groups, size = [], 0
    for number, n in sorted(tuple(r) for r in blocks.select("block", "size").collect()):     # two numbers a block
        if not groups or size + n > block_words:
            groups.append([])
            size = 0
        groups[-1].append(number)
        size += n
    return groups


def collected(blocks: DataFrame, numbers: list[int], window: int) -> Block:
    """The blocks of one job, put together."""
    rows = sorted(blocks.where(F.col("block").isin(numbers)).collect(), key=lambda r: r["block"])
    return Block([x for r in rows for x in r["names"]], np.array([x for r in rows for x in r["n_words"]], np.int64),
                 np.frombuffer(b"".join(r["hashes"] for r in rows), np.uint64), window)


def phrase_matches(shard: Shard, block: Block, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(window, position of its first word) of every match."""
    grid = block.grid
    term = np.append(shard.term_of(block.hashes), -1)[grid]
    held = ((term >= 0) | (grid < 0)).all(axis=1) & (block.length > 0)
    windows = np.flatnonzero(held)
    if not len(windows):
        return windows, windows
    term = term[windows]
    count = np.where(term >= 0, np.diff(shard.first)[term], np.iinfo(np.int64).max)
    order = np.argsort(count, axis=1, kind="stable")      # rarest first; places beyond a short window last
    rare = order[:, 0]
    seed = term[np.arange(len(windows)), rare]
    many = np.diff(shard.first)[seed]
    out = []
    upto = np.cumsum(many)
    low = 0
    while low < len(windows):                              # so many windows that their candidates fit
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + CANDIDATES, "right")))
        w = np.repeat(np.arange(low, high), many[low:high])
        base = shard.positions[ranges(shard.first[seed[low:high]], many[low:high])] - rare[w]
        length = block.length[windows[w]]
        keep = base >= -slop
        doc = shard.doc_of(np.maximum(base + rare[w], 0))
        begin, end = shard.bounds[doc], shard.bounds[doc + 1]
        if not slop:
            keep &= (base >= begin) & (base + length <= end)
        w, base, begin, end = w[keep], base[keep], begin[keep], end[keep]
        for k in range(1, grid.shape[1]):
            place = order[w, k]
            t = term[w, place]
            ok = (t < 0) | shard.near(t, base + place, begin, end, slop)
            w, base, begin, end = w[ok], base[ok], begin[ok], end[ok]
        out.append((windows[w], base))
        low = high
    return tuple(np.concatenate(x) for x in zip(*out))


# ------------------------------------------------------------------ search

def search(index: DataFrame, benchmark: DataFrame, *, item_col: str = "item_id", text_col: str = "text",
           window: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per indexed document: its words, the words inside exact matches, and the items that match.

    ``spans`` are the hit word ranges, merged; ``near_item_ids`` are the items
    with a window whose every term lies within ``slop`` words of its place
    (empty without slop).  An item of fewer words than the window is one
    window; without words it has none.  Windows of an item without id count as
    hits, and the item is not listed.
    """
    id_type = index.schema["ids"].dataType.elementType
    sc = index.sparkSession.sparkContext
    blocks = stored(passages(benchmark, item_col, text_col, block_words), "passages")
    groups = searched_together(blocks, block_words)
    if len(groups) <= 1:
        shared = sc.broadcast(collected(blocks, groups[0] if groups else [], window))
        return _matched(index, shared, slop, id_type, sparse=False).drop("shard", "place")
    found = None
    for numbers in groups:
        shared = sc.broadcast(collected(blocks, numbers, window))
        part = stored(_matched(index, shared, slop, id_type, sparse=True).drop("doc_id", "n_words", "n_hit"), "matches")
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    together = found.groupBy("shard", "place").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("item_ids", "near_item_ids", "spans")))
    docs = index.select("shard", F.posexplode(F.arrays_zip("ids", "n_words")).alias("place", "d"))
    joined = docs.join(together, ["shard", "place"], "left").select(
        F.col("d.ids").alias("doc_id"), F.col("d.n_words").cast("long").alias("n_words"),
        *(F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c) for c in ("item_ids", "near_item_ids", "spans")))
    # Spans of different blocks may overlap: they are joined from left to right.
    ordered = joined.withColumn("spans", F.array_sort("spans"))
    merged = F.expr("""aggregate(spans, cast(array() as array<struct<start: int, end: int>>), (done, s) ->
        case when size(done) > 0 and element_at(done, -1).end >= s.start
             then concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start,
                         'end', greatest(element_at(done, -1).end, s.end))))
             else concat(done, array(s)) end)""")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    lists = {c: F.array_sort(F.array_distinct(c)) for c in ("item_ids", "near_item_ids")}
    return (ordered.withColumns({"spans": merged, **lists}).withColumn("n_hit", n_hit)
            .select("doc_id", "n_words", "n_hit", "item_ids", "near_item_ids", "spans"))


def _matched(index: DataFrame, shared, slop: int, id_type: T.DataType, sparse: bool) -> DataFrame:
    """The matches of one block of test items, by document; ``sparse``: only documents that have any."""
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    names = T.ArrayType(T.StringType())
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", names), T.StructField("near_item_ids", names), T.StructField("spans", T.ArrayType(span)),
        T.StructField("shard", T.LongType()), T.StructField("place", T.IntegerType()),
    ])
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def listed(shard: Shard, block: Block, w: np.ndarray, position: np.ndarray, into: list[set]) -> None:
        doc = shard.doc_of(np.maximum(position, 0))
        for d, i in np.unique(np.stack([doc, block.item[w]]), axis=1).T.tolist():
            if block.names[i] is not None:
                into[d].add(block.names[i])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                ids, n_words = batch.column(0)[r].values, np.array(batch.column(1)[r].values, np.int64)
                terms, first, positions = (np.frombuffer(batch.column(k)[r].as_buffer(), kind)
                                           for k, kind in ((2, np.uint64), (3, np.int32), (4, np.int32)))
                shard = Shard(n_words, terms, first.astype(np.int64), positions.astype(np.int64))
                cover = np.zeros(shard.size + 1, np.int64)
                found, near = ([set() for _ in range(len(n_words))] for _ in range(2))
                if len(terms) and len(block.item):
                    w, at = phrase_matches(shard, block)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + block.length[w], -1)
                    listed(shard, block, w, at, found)
                    if slop:
                        listed(shard, block, *phrase_matches(shard, block, slop), near)
                hit = np.cumsum(cover)[:-1] > 0
                n_hit = sums_by(hit[: shard.bounds[-1]], shard.bounds)
                spans = [_runs(hit[a:b]) if k else [] for a, b, k in zip(shard.bounds[:-1], shard.bounds[1:], n_hit)]
                out = pa.record_batch([
                    ids, pa.array(n_words), pa.array(n_hit),
                    pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                    pa.array([sorted(x) for x in near], pa.list_(pa.string())),
                    pa.array(spans, arrow_span), pa.array(np.full(len(n_words), batch.column(5)[r].as_py())),
                    pa.array(np.arange(len(n_words), dtype=np.int32)),
                ], names=schema.names)
                if sparse:
                    out = out.filter(pa.array([bool(n or x) for n, x in zip(n_hit.tolist(), near)], pa.bool_()))
                yield out

    return map_texts(index, match, schema)


def _runs(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Index ``docs``, store the index, search it; one row per row of ``docs``, with ``contaminated``.

    A document is contaminated when it has hit words and at least one word in
    ``MIN_SHARE`` is hit.  Empty tables give empty results.
    """
    index = stored(build_index(docs, id_col, text_col), "index")
    found = search(index, benchmark, item_col=item_col, text_col=item_text_col, window=window, slop=slop)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (MIN_SHARE * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, columns unchanged; rows are told apart by id and text."""
    rows = docs.withColumn("_row", F.struct(F.col(id_col), F.xxhash64(text_col)))
    found = decontaminate(rows.select("_row", F.col(text_col).alias("_text")), benchmark, id_col="_row", text_col="_text", **options)
    bad = found.where("contaminated").select(F.col("doc_id").alias("_row")).distinct()
    return rows.join(bad, "_row", "left_anti").select(docs.columns)
