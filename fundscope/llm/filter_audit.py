"""How quality filters interact: what each removes in every order they can be applied in.

One pass over a text's bytes (``measure``) drives a finite-state transducer by
two tables: a byte has a class (white space, capital, symbol, other ASCII, lead
or continuation byte of UTF-8), and (state, class) gives the marks that the
byte sets off -- a word begins, a word has ended, a capital, a symbol, a code
point.  The state after a byte (inside a word or not) is a function of its
class alone, so the states of a whole run of text are one table look-up,
shifted by a byte.  The spans of words go into an open-addressing hash table
whose every hit is verified byte by byte, so the count of distinct words does
not rest on a hash.

``audit`` turns the counts into failure masks, adds the filter "same text as a
row with a smaller id" and counts rows by (part, mask).  Every figure of every
order follows from these few counts: nothing is filtered more than once.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.arrays import BYTE_VALUE, U64, Sums, chunks, mix, ranges, sums_by

# ------------------------------------------------------------------ transducer

SPACE, CAPITAL, SYMBOL, PLAIN, LEAD, GOES_ON = range(6)
CLASSES = np.full(256, PLAIN, np.uint8)
CLASSES[[0x20, *range(0x09, 0x0E)]] = SPACE
CLASSES[0x41:0x5B] = CAPITAL
CLASSES[list(b"#$%&*|")] = SYMBOL
CLASSES[0x80:0xC0] = GOES_ON
CLASSES[0xC0:] = LEAD

OUTSIDE, INSIDE = 0, 1
NEXT = np.full(6, INSIDE, np.uint8)          # the state after a byte of each class, from either state
NEXT[SPACE] = OUTSIDE

BEGINS, ENDED, IS_CAPITAL, IS_SYMBOL, IS_CODE_POINT = 1, 2, 4, 8, 16
MARKS = np.zeros((2, 6), np.uint8)           # marks by (state before the byte, class)
MARKS[OUTSIDE, [CAPITAL, SYMBOL, PLAIN, LEAD, GOES_ON]] |= BEGINS
MARKS[INSIDE, SPACE] |= ENDED
MARKS[:, CAPITAL] |= IS_CAPITAL
MARKS[:, SYMBOL] |= IS_SYMBOL
MARKS[:, [SPACE, CAPITAL, SYMBOL, PLAIN, LEAD]] |= IS_CODE_POINT


def transduce(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marks of each byte, starts of the words, ends of the words) of texts that lie end to end."""
    classes = CLASSES[data]
    state = np.zeros(len(data), np.uint8)
    state[1:] = NEXT[classes[:-1]]
    full = offsets[1:] > offsets[:-1]
    state[offsets[:-1][full]] = OUTSIDE                                     # each text starts anew
    marks = MARKS[state, classes]
    open_ = offsets[1:][full][NEXT[classes[offsets[1:][full] - 1]] == INSIDE]   # words that end with their text
    ends = np.concatenate([np.flatnonzero(marks & ENDED), open_])
    return marks, np.flatnonzero(marks & BEGINS), np.sort(ends)


# ------------------------------------------------------------------ verified hash table

def first_seen(data: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray,
               hashes: np.ndarray | None = None) -> np.ndarray:
    """Which spans are the first of their owner (ascending) with their bytes.

    All spans go into one open-addressing table, in rounds: a span whose slot is
    free takes it (the earliest of them), a span whose slot holds the same owner
    and the same bytes is a repeat, any other moves on to the next slot.
    """
    if hashes is None:
        hashes = Sums(BYTE_VALUE[data])(start, end)
    hashes = mix(hashes ^ mix(owner.astype(U64)))
    size = 1 << max(3, int(2 * len(start)).bit_length())
    slot = (hashes & U64(size - 1)).astype(np.int64)
    table = np.full(size, -1, np.int64)
    fresh = np.zeros(len(start), bool)
    length = end - start
    going = np.arange(len(start))
    while len(going):
        at = slot[going]
        free = table[at] < 0
        table[at[free][::-1]] = going[free][::-1]                          # the last write wins: the earliest span
        held = table[at]
        mine = held == going
        fresh[going[mine]] = True
        alike = np.flatnonzero(~mine & (hashes[held] == hashes[going]) & (owner[held] == owner[going])
                               & (length[held] == length[going]))
        a, b = going[alike], held[alike]
        differ = data[ranges(start[a], length[a])] != data[ranges(start[b], length[b])]
        bounds = np.concatenate([[0], np.cumsum(length[a])])
        done = mine
        done[alike] = sums_by(differ, bounds) == 0
        going = going[~done]
        slot[going] = (slot[going] + 1) & (size - 1)
    return fresh


# ------------------------------------------------------------------ measures

COUNTS = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_code_points")


def counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The five counts of each text, in the order of ``COUNTS``."""
    marks, start, end = transduce(data, offsets)
    bounds = np.searchsorted(start, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    fresh = first_seen(data, start, end, owner)
    by_byte = [sums_by((marks & m) != 0, offsets) for m in (IS_CAPITAL, IS_SYMBOL, IS_CODE_POINT)]
    return [np.diff(bounds), sums_by(fresh, bounds), *by_byte]


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part: Column | None = None) -> DataFrame:
    """``row_id``, ``part`` (a string), the five counts and ``digest`` (SHA-256 of the text) of every row; null is the empty text."""
    rows = docs.select(F.col(id_col).alias("row_id"), (F.lit("") if part is None else part).cast("string").alias("part"),
                       F.col(text_col).alias("text"))
    schema = rows.drop("text").schema
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("digest", "binary")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(2)):
                whole = memoryview(np.ascontiguousarray(data))
                digests = [hashlib.sha256(whole[a:b]).digest() for a, b in itertools.pairwise(offsets.tolist())]
                yield pa.record_batch([batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row),
                                       *(pa.array(c.astype(np.int64)) for c in counts(data, offsets)),
                                       pa.array(digests, pa.binary())], names=schema.names)

    return rows.mapInArrow(measured, schema)


def masked(measured: DataFrame, filters: Mapping[str, str], lost: Mapping[str, Column]) -> DataFrame:
    """Counts ``n`` of rows by (part, mask, the columns of ``lost``).

    Bit k of the mask: the row fails filter k of ``filters``; the bit after them:
    its text has a row with a smaller id.  Copies of a text meet only as counts: rows of one text, part
    and marks are summed up before the text's smallest id is looked for, so a
    text that holds a third of all rows is a handful of rows by then.  Rows
    that repeat an id and a text are no copies of each other; a row without id
    is a copy of none, and makes none.
    """
    mask = sum((F.when(F.expr(c), 1 << k).otherwise(0) for k, c in enumerate(filters.values())), F.lit(0))
    kinds = ["digest", "part", "mask", *lost]
    rows = measured.select("row_id", "digest", "part", mask.cast("int").alias("mask"), *(c.alias(k) for k, c in lost.items()))
    ids = rows.groupBy("row_id", *kinds).agg(F.count("*").alias("n"))
    first = F.struct("row_id", "n")
    alike = ids.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min(F.when(F.col("row_id").isNotNull(), first)).alias("first"),
                                    F.sum(F.when(F.col("row_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    leader = F.min("first.row_id").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("first.row_id") == leader, F.col("first.n")).otherwise(0)
    split = alike.withColumn("apart", F.col("nameless") + firsts)
    both = F.array(F.struct(F.col("mask"), F.col("apart").alias("n")),
                   F.struct(F.col("mask").bitwiseOR(F.lit(1 << len(filters))).alias("mask"), (F.col("n") - F.col("apart")).alias("n")))
    return (split.select("part", *lost, F.explode(both).alias("c")).groupBy("part", "c.mask", *lost)
            .agg(F.sum("c.n").alias("n")))


def audit(docs: DataFrame, filters: Mapping[str, str], *, repeats: str, id_col: str = "doc_id", text_col: str = "text",
          part: Column | None = None, marks: DataFrame | None = None, lost: Mapping[str, str] | None = None) -> DataFrame:
    """One row per part, order of the filters and step: what the step's filter does there.

    ``filters``: name (one character) -> failure condition (SQL) over the columns of
    ``measure``; ``repeats``: the name of the filter that fails rows whose text
    a row with a smaller id has, whatever the other filters do.  ``lost``: name
    -> condition (SQL) over the columns of ``marks`` (which has ``id_col``): how many
    of such rows the step removes; a row without marks counts as not marked,
    repeated marks of an id count if any holds.

    Columns: part, filter_order, step (from 1), kept, removed, redundant (fail
    the step's filter but are gone before), unique_fails (fail this filter
    only), one column per ``lost``, shapley (what the step's filter removes,
    summed over all orders).  Null and empty texts are the same text, without
    words.  A null part is the part ``''``; an empty table has no parts.
    """
    lost = dict(lost or {})
    names = [*filters, repeats]
    if len(set(names)) < len(names) or any(len(x) != 1 for x in names):
        raise ValueError("each filter needs a name of its own, of one character")
    rows = measure(docs, id_col=id_col, text_col=text_col, part=part).withColumn("part", F.coalesce("part", F.lit("")))
    conditions = {f"_lost{k}": F.coalesce(F.col(f"_lost{k}"), F.lit(False)) for k in range(len(lost))}
    if lost:
        marked = (marks.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("row_id"))
                  .agg(*(F.max(F.expr(c)).alias(f"_lost{k}") for k, c in enumerate(lost.values()))))
        rows = rows.join(marked, "row_id", "left")
    cells = masked(rows, filters, conditions)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *conditions, "n")).alias("cells"))

    orders = list(itertools.permutations(range(len(names))))
    steps = [(o, k) for o in orders for k in range(len(names))]
    at = F.col("at")
    pick = lambda values: F.get(F.lit(values), at)
    table = parts.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))).select(
        "part", "cells", pick(["".join(names[f] for f in o) for o, _ in steps]).alias("filter_order"),
        pick([k + 1 for _, k in steps]).alias("step"), pick([names[o[k]] for o, k in steps]).alias("filter"),
        pick([1 << o[k] for o, k in steps]).alias("bit"), pick([sum(1 << f for f in o[:k]) for o, k in steps]).alias("before"))

    def total(condition) -> Column:
        return F.aggregate(F.filter("cells", condition), F.lit(0).cast("long"), lambda s, c: s + c["n"])

    has = lambda c, bits: c["mask"].bitwiseAND(F.col(bits)) != 0
    here = lambda c: ~has(c, "before") & has(c, "bit")            # noqa: E731
    marked_here = lambda k: lambda c: here(c) & c[f"_lost{k}"]
    removed = table.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "filter",
        total(lambda c: ~has(c, "before") & ~has(c, "bit")).alias("kept"), total(here).alias("removed"),
        total(lambda c: has(c, "before") & has(c, "bit")).alias("redundant"),
        total(lambda c: c["mask"] == F.col("bit")).alias("unique_fails"),
        *(total(marked_here(k)).alias(name) for k, name in enumerate(lost)))
    return removed.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")
