"""Substring deduplication on a compacted De Bruijn graph of word k-mers.

The edges of the graph are the ``span``-word windows (50) of the documents,
its nodes their overlaps of ``span`` - 1 words; a document is a path.  A word
goes when a window over it also starts in a document with a smaller id.

Writing down every edge would be one row per word.  Instead, paths are
compacted before anything is shuffled: each edge has a minimizer (the
``SEED_WORDS``-word piece inside it with the smallest hash), and consecutive
edges over the same minimizer are one path piece, about one row for 20 words.
Equal edges have equal minimizers, so

1. one aggregation by minimizer keeps those that occur in several documents
   (pre-aggregated: a passage in a third of all documents is one row a task),
   and a join brings back their pieces;
2. equal pieces of a minimizer are one nonbranching path: its first source
   (smallest document, position) covers it in all later documents whole;
3. where a minimizer has different pieces the graph branches.  Only the first
   source of each such piece is taken apart into single edges; an aggregation
   and a join on the edge find the source of each edge;
4. pieces and edges that follow each other, in the document and in the same
   source, are joined to maximal repeated paths, and cut out.

Pieces are equal if the 64-bit hashes of the minimizer and of all their words
are; edges are held against their source coordinates by a 64-bit hash and a
second 32-bit digest of their words.  Texts are shuffled twice (to take apart, and to cut), k-mers
only where the graph branches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.llm.arrays import NON_SPACE, Sums, U64, Words, chunks, mix, ranges
from fundscope.llm.storage import stored

SPAN = 50
SEED_WORDS = 8
PLACE = U64((1 << 28) - 1)      # bits of a word's number in a run of documents
_SECOND = U64(0xA0761D6478BD642F)


def _digests(words: Words) -> tuple[Sums, Sums]:
    h = words.hashes()
    return Sums(h), Sums(mix(h ^ _SECOND))


def pieces(words: Words, span: int, seed_words: int) -> dict[str, np.ndarray]:
    """Path pieces of a run of documents: doc, start (word of the document), n (edges), anchor, piece."""
    first = Sums(words.hashes())
    n_seeds = len(words) - seed_words + 1
    count = np.maximum(0, words.counts - span + 1)
    if not count.sum():
        return {k: np.zeros(0, np.int64) for k in ("doc", "start", "n", "anchor", "piece")}
    at = np.arange(n_seeds)
    seed = first(at, at + seed_words)
    low = (seed & ~PLACE) | at.astype(U64)                      # the smallest: by hash, then the leftmost
    width, reach = span - seed_words + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    if reach < width:
        rest = width - reach
        low = np.minimum(low[: len(low) - rest], low[rest:])
    edge = ranges(words.doc[:-1], count)
    doc = np.repeat(np.arange(len(count)), count)
    where = (low[edge] & PLACE).astype(np.int64)
    head = np.flatnonzero(np.append(True, (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])))
    n = np.diff(np.append(head, len(edge)))
    begin = edge[head]
    end = begin + n + span - 1
    return {"doc": doc[head], "start": begin - words.doc[doc[head]], "n": n, "anchor": seed[where[head]].view(np.int64),
            "piece": first(begin, end).view(np.int64)}


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
            seed_words: int | None = None) -> DataFrame:
    """Repeated stretches: id, mark (hash of the row's text), start, n (edges), source_id, source_start.

    ``start`` and ``source_start`` count words; a stretch covers n + span - 1
    words and is equal to the words at its source, which has a smaller id.
    Rows without id have no place in the order: they take no part.
    """
    seed_words = seed_words or min(SEED_WORDS, span)
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"),
                       F.col(text_col).alias("text")).where("id is not null")
    schema = T.StructType([
        T.StructField("anchor", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("id", id_type),
        T.StructField("mark", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("n", T.IntegerType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(2)):
                p = pieces(Words(data, offsets, NON_SPACE), span, seed_words)
                doc = pa.array(p["doc"] + row)
                yield pa.record_batch([
                    pa.array(p["anchor"]), pa.array(p["piece"]), batch.column(0).take(doc), batch.column(1).take(doc),
                    pa.array(p["start"].astype(np.int32)), pa.array(p["n"].astype(np.int32))], names=schema.names)

    all_pieces = rows.mapInArrow(cut, schema)
    # The small sides of the joins are tables of their own, so that adaptive execution can split a
    # hot minimizer, piece or edge on the other side.
    several = all_pieces.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    found = stored(all_pieces.join(stored(several.select("anchor"), "anchors"), "anchor"), "repeated")

    kinds = found.groupBy("anchor", "piece").agg(F.min(F.struct("id", "start")).alias("source"))
    forks = kinds.groupBy("anchor").agg((F.count("*") > 1).alias("branching"))
    traced = found.join(stored(kinds.join(forks, "anchor"), "kinds"), ["anchor", "piece"])
    plain = traced.where("id > source.id").select("id", "mark", "start", "n", F.col("source.id").alias("source_id"),
                                                  F.col("source.start").alias("source_start"))

    # the first sources of branching pieces, taken apart
    parts = (traced.where("branching and id = source.id").groupBy("id", "mark")
             .agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("parts")))
    edge_schema = T.StructType([
        T.StructField("edge", T.LongType()), T.StructField("proof", T.IntegerType()), T.StructField("id", id_type),
        T.StructField("mark", T.LongType()), T.StructField("start", T.IntegerType())])

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(3)
            bounds, flat = np.asarray(listed.offsets), listed.values
            starts, sizes = (np.asarray(flat.field(k)) for k in (0, 1))
            for row, end, data, offsets in chunks(batch.column(2)):
                words = Words(data, offsets, NON_SPACE)
                first, second = _digests(words)
                doc = np.repeat(np.arange(row, end), np.diff(bounds[row: end + 1]))
                size = sizes[bounds[row]: bounds[end]]
                start = ranges(starts[bounds[row]: bounds[end]], size)
                doc = np.repeat(doc, size)
                begin = words.doc[doc - row] + start
                doc = pa.array(doc)
                yield pa.record_batch([
                    pa.array(first(begin, begin + span).view(np.int64)), pa.array((second(begin, begin + span) >> U64(32)).astype(np.uint32).view(np.int32)),
                    batch.column(0).take(doc), batch.column(1).take(doc), pa.array(start.astype(np.int32))],
                    names=edge_schema.names)

    edges = stored(rows.join(parts, ["id", "mark"]).select("id", "mark", "text", "parts").mapInArrow(take_apart, edge_schema), "edges")
    known = edges.groupBy("edge").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    again = stored(edges.join(stored(known.select("edge"), "repeated_edges"), "edge"), "edge_sources")
    sources = stored(again.groupBy("edge").agg(F.min(F.struct("id", "start", "proof")).alias("source")), "first_edges")
    single = (again.join(sources, "edge").where("id > source.id and proof = source.proof")
              .select("id", "mark", "start", F.lit(1).alias("n"), F.col("source.id").alias("source_id"),
                      F.col("source.start").alias("source_start")))
    return plain.unionByName(single)


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, kept_text (its words, one space between them), paths.

    ``paths`` are the maximal repeated paths: start and end (words), source_id
    and source_start.  Null and empty texts have no words.  Rows that repeat an
    id are each judged by their own text, against smaller ids only.
    """
    found = repeats(docs, id_col=id_col, text_col=text_col, span=span)
    per_row = found.groupBy("id", "mark").agg(F.sort_array(F.collect_set(
        F.struct("start", "n", "source_id", "source_start"))).alias("parts"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType
    path = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("source_id", id_type), T.StructField("source_start", T.LongType())])
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()), T.StructField("paths", T.ArrayType(path))])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            texts, parts = batch.column(1).cast(pa.large_binary()), batch.column(2)
            for text, listed in zip(texts, parts):
                words = (text.as_py() or b"").split()
                paths = _paths(listed.as_py() or [], span)
                gone = np.zeros(len(words) + 1, np.int64)
                for p in paths:
                    gone[p["start"]] += 1
                    gone[p["end"]] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                kept = b" ".join(words if stay.all() else [w for w, s in zip(words, stay.tolist()) if s])
                for into, value in zip(out, (len(words), len(words) - int(stay.sum()), kept, paths)):
                    into.append(value)
            kinds = [pa.int64(), pa.int64(), pa.binary(), path_arrow(batch.schema.field(0).type)]
            columns = [pa.array(values, kind) for values, kind in zip(out, kinds)]
            columns[2] = pa.Array.from_buffers(pa.string(), len(columns[2]), columns[2].buffers())
            yield pa.record_batch([batch.column(0), *columns], names=schema.names)

    joined = rows.join(per_row, ["id", "mark"], "left").select("id", "text", "parts")
    return joined.mapInArrow(clean, schema).withColumnRenamed("id", id_col)


def path_arrow(id_type: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("source_id", id_type), ("source_start", pa.int64())]))


def _paths(parts: list[dict], span: int) -> list[dict]:
    """Sorted parts, joined where one goes on where the last ended, here and at the source."""
    out: list[dict] = []
    for p in parts:
        end = p["start"] + p["n"] + span - 1
        last = out[-1] if out else None
        if (last and last["source_id"] == p["source_id"] and p["start"] <= last["end"] - span + 1
                and p["start"] - last["start"] == p["source_start"] - last["source_start"]):
            last["end"] = max(last["end"], end)
        else:
            out.append({"start": p["start"], "end": end, "source_id": p["source_id"], "source_start": p["source_start"]})
    return out
