"""Line deduplication with a suffix array over lines, built by distributed prefix doubling.

Every document is a sequence of line IDs.  The suffixes (all positions of all
documents) are sorted by doubling: after a round their order is known by the
first 2h lines, from the pair (rank by h lines here, rank by h lines h
positions further on).  The rank of a suffix is the number of smaller
suffixes, and suffixes with equal rank form an interval of the suffix array
whose longest common prefix is at least the current depth.  Intervals of one
suffix, and of suffixes that are all compared to their ends, are closed and
take no part in later rounds; it ends when all are closed.  A document's end sorts before every line, so a suffix never runs
into the next document; suffixes that are equal to their ends share a rank.

The intervals at depth ``min_lines`` name the repeated runs: every member but
the first (by id, then position) starts a later copy of ``min_lines`` lines,
and later copies that overlap or touch make up maximal runs.  Their lines go.

Ranks come from counts, never from one sorted group: pairs are counted first
(a line in a third of all documents is one row a task), counts are summed
over 4,096 slices of the order, and only inside a slice is anything sorted.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.llm.arrays import chunks
from fundscope.llm.storage import stored

MIN_LINES = 3
SLICES = 4096
DOC = ("id", "mark")


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, mark (xxhash64 of the text), pos, n_lines, line_id (md5 of the line); a row that repeats id and text counts once."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"),
                       F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"))
    return (rows.select(*DOC, F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
            .where("id is not null").groupBy(*DOC, "pos", "n_lines").agg(F.min(F.md5("line")).alias("line_id")))


def _ranked(counts: DataFrame, group: list[str], key: str, piece: Column, base: Column) -> DataFrame:
    """``counts`` (group, key, n, longest) with rank: base plus the n of the smaller keys of the group."""
    cut = counts.withColumn("slice", piece)
    sums = cut.groupBy(*group, "slice").agg(F.sum("n").alias("slice_n"))
    by = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    below = F.coalesce(F.sum("slice_n").over(by.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    names = [*group, "slice"]
    starts = sums.select(*[F.col(c).alias(f"s_{c}") for c in names], below.alias("below"))
    on = F.lit(True)
    for c in names:
        on = on & (F.col(c) == F.col(f"s_{c}"))
    inner = Window.partitionBy(*names).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (cut.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(starts, on)
            .select(*group, key, "n", "longest", (base + F.col("below") + F.col("inside")).cast("long").alias("rank")))


@dataclass
class SuffixArray:
    suffixes: DataFrame     # id, mark, pos, n_lines, rank, depth
    runs: DataFrame         # id, mark, pos, first (id, mark, pos): later copies of min_lines lines


def suffix_array(lines: DataFrame, min_lines: int = MIN_LINES) -> SuffixArray:
    """The suffix array of all documents' lines, and the repeated runs of ``min_lines`` lines.

    ``depth`` is the last doubling depth at which the suffix shared its
    interval (0: its first line occurs once); its longest common prefix with
    another suffix has at least so many lines, and less than twice as many.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    lines = stored(lines, "lines")
    total = lines.count()
    members = [F.count("*").alias("n"), F.max(F.col("n_lines") - F.col("pos")).alias("longest")]
    counts = lines.groupBy("line_id").agg(*members)
    hexes = len(f"{SLICES - 1:x}")
    ids = _ranked(counts, [], "line_id", F.substring("line_id", 1, hexes), F.lit(0))
    by_doc = Window.partitionBy(*DOC).orderBy("pos")
    columns = [*DOC, "pos", "n_lines", "rank", "open", "depth"]
    with_live = lambda s: stored(s.select(*columns, F.max("open").over(Window.partitionBy(*DOC)).alias("live")), "suffixes")
    state = with_live(lines.join(ids, "line_id").withColumn("open", (F.col("n") > 1) & (F.col("longest") > 1))
                      .withColumn("depth", F.when(F.col("n") > 1, 1).otherwise(0)))
    depth, runs, done = 1, None, []
    while True:
        if runs is None and 2 * depth > min_lines:
            runs = _runs(state, min_lines, depth)
        done.append(state.where("not live"))       # documents whose suffixes are all closed
        state = state.where("live")
        if state.isEmpty():
            whole = functools.reduce(DataFrame.unionByName, done)
            return SuffixArray(whole.drop("open", "live"), runs if runs is not None else _runs(state, min_lines, min_lines))
        seen = state.withColumn("next", F.coalesce(F.lead("rank", depth).over(by_doc), F.lit(-1).cast("long")))
        pairs = seen.where("open").groupBy(F.col("rank").alias("old"), "next").agg(*members)
        piece = F.expr(f"cast((next + 1) * {SLICES} div {total + 1} as int)")
        fresh = _ranked(pairs, ["old"], "next", piece, F.col("old"))
        moved = (seen.where("open").withColumnRenamed("rank", "old").join(fresh, ["old", "next"])
                 .withColumn("depth", F.when((F.col("n") > 1) & (F.col("pos") + 2 * depth <= F.col("n_lines")), 2 * depth)
                             .otherwise(F.col("depth")))
                 .withColumn("open", (F.col("n") > 1) & (F.col("longest") > 2 * depth)))
        state = with_live(state.where("not open").select(columns).unionByName(moved.select(columns)))
        depth *= 2


def _runs(state: DataFrame, min_lines: int, depth: int) -> DataFrame:
    """Later members of the intervals of ``min_lines`` lines, from ranks by ``depth`` <= min_lines lines.

    The first min_lines lines of two suffixes are equal if their first depth
    lines are, and the depth lines that end with the min_lines-th.  Documents
    that left earlier share no ``depth`` lines with any other suffix.
    """
    by_doc = Window.partitionBy(*DOC).orderBy("pos")
    pair = state.withColumn("last", F.lead("rank", min_lines - depth).over(by_doc))
    pair = pair.where((F.col("pos") + min_lines <= F.col("n_lines")) & (F.col("depth") > 0))
    # A table of its own: the join can then split the copies of a very common line over several tasks.
    first = stored(pair.groupBy("rank", "last").agg(F.min(F.struct(*DOC, "pos")).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    return (pair.join(first.drop("n"), ["rank", "last"]).where(F.struct(*DOC, "pos") != F.col("first"))
            .select(*DOC, "pos", "first"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """Per row of ``docs``: id, n_lines, n_removed, kept_text (lines joined by line feeds), shared_depth, removed.

    ``removed`` lists the maximal removed runs (start, end, in lines);
    ``shared_depth`` is the largest depth of the document's suffixes.  A null
    text is one empty line; an empty line is a line like any other, so without
    a minimum later blank lines go too.  Rows without id stay whole, with depth null.  Rows
    that repeat id and text are one document to the search, and all are cut alike.
    """
    array = suffix_array(lines_of(docs, id_col, text_col), min_lines)
    depth = array.suffixes.groupBy(*DOC).agg(F.max("depth").alias("shared_depth"))
    starts = array.runs.groupBy(*DOC).agg(F.sort_array(F.collect_list("pos")).alias("starts"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    joined = (rows.join(depth.join(starts, list(DOC), "left"), list(DOC), "left")
              .select("id", "text", F.col("shared_depth").cast("long").alias("shared_depth"), "starts"))
    schema = (joined.select("id").schema.add("n_lines", "long").add("n_removed", "long").add("kept_text", "string")
              .add("shared_depth", "long").add("removed", T.ArrayType(T.StructType().add("start", "integer").add("end", "integer"))))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                raw, n_lines, n_removed, kept, runs = data.tobytes(), [], [], [], []
                for a, b, listed in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column(3).slice(row, end - row)):
                    lines = raw[a:b].split(b"\n")
                    gone = np.zeros(len(lines) + 1, np.int64)
                    if listed.is_valid:
                        at = np.asarray(listed.values)
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + min_lines, -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
                    n_lines.append(len(lines))
                    n_removed.append(int(gone.sum()))
                    kept.append(b"\n".join([x for x, g in zip(lines, gone.tolist()) if not g] if edge else lines))
                    runs.append([{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])])
                text = pa.array(kept, pa.binary())
                yield pa.record_batch([
                    batch.column(0).slice(row, end - row), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.Array.from_buffers(pa.string(), len(text), text.buffers()),
                    batch.column(2).slice(row, end - row), pa.array(runs, span)], names=schema.names)

    return joined.mapInArrow(clean, schema).withColumnRenamed("id", id_col)
