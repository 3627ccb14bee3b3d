"""Collocations from sorted count streams, without a lookup table anywhere.

Every position of a text gives one window: its next ``max_words`` words inside
the piece.  Windows are range-partitioned and sorted, so that all windows with
the same first k words lie together for every k, and one pass over the sorted
windows counts the phrases of all lengths as run lengths.  (Counts of a phrase
that a partition boundary cuts are marked and summed up: at most two a length
and partition.)  A language is the phrase of no words: its run counts all words.

The frequent phrases are kept as two count streams: one in prefix order (a
phrase comes before its extensions to the right), one in suffix order (words
reversed: before its extensions to the left).  The lengths of a stream advance
in lockstep: a phrase's first k words are the last phrase of k words that came
by, because a part of a frequent phrase is frequent and so in the stream.  So
one pass gives each phrase the counts of its left parts and the largest count
of an extension by a word; the other stream gives the right parts, and a merge
of the two on the phrase brings cuts and extensions together.  Partitions of a
stream are cut anywhere; what one has to know of its neighbours is three
numbers a length.

Sorting spreads windows and phrases evenly whatever word, pair or language is
common: equal windows are summed up inside a task before they are shuffled, and
different windows of a common word fall on as many partitions as they need.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.arrays import LOWER, U64, Sums, Words, chunks, mix, ranges
from fundscope.llm.storage import stored
from fundscope.session import ensure_checkpoint_dir

MAX_WORDS = 4
MIN_COUNT = 30
COVERED_PERCENT = 80
TOP = 2000
CHUNK_BYTES = 1 << 20            # windows are summed up within runs of texts of this size

END = 0x0A                       # ends each word of a phrase in the streams; no word holds it

# What ends a piece, what parts words inside it.
PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD_BYTE = ~PIECE_END
WORD_BYTE[[0x20, 0x09]] = False


# ------------------------------------------------------------------ windows

def _strings(data: np.ndarray, offsets: np.ndarray, kind=None) -> pa.Array:
    return pa.Array.from_buffers(kind or pa.string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def windows(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, width: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of the language, window, count): the distinct windows of a run of texts.

    A window is ``width`` words, each followed by END; missing words are empty.
    """
    data = LOWER[data]
    words = Words(data, offsets, WORD_BYTE)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    doc = words.doc_of()
    piece = np.concatenate([[0], np.cumsum(PIECE_END[data])])[words.start]
    opens = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])))
    closes = np.repeat(np.append(opens[1:], n), np.diff(np.append(opens, n)))
    count = np.minimum(closes - np.arange(n), width)

    size = words.end - words.start
    at = np.concatenate([[0], np.cumsum(size + 1)])                         # the words again, each with its END
    line = np.full(at[-1], END, np.uint8)
    line[ranges(at[:-1], size)] = data[ranges(words.start, size)]

    first, lang = np.arange(n), langs[doc]
    h = Sums(words.hashes())(first, first + count) ^ mix(lang.astype(U64) << U64(8) | count.astype(U64))
    order = np.argsort(h)
    begin, length, short = at[order], at[(first + count)[order]] - at[order], width - count[order]
    ends = np.concatenate([[0], np.cumsum(length + short)])
    text = np.full(ends[-1], END, np.uint8)
    text[ranges(ends[:-1], length)] = line[ranges(begin, length)]
    listed = _strings(text, ends)
    new = np.ones(n, bool)
    new[1:] = pc.not_equal(listed[1:], listed[:-1]).to_numpy(zero_copy_only=False) | (lang[order][1:] != lang[order][:-1])
    head = np.flatnonzero(new)
    return lang[order][head], listed.take(pa.array(head)), np.diff(np.append(head, n))


def window_counts(docs: DataFrame, lang: Column, text_col: str, width: int) -> DataFrame:
    """(lang, window, n), some windows in several rows; nothing for texts without words."""
    rows = docs.select(F.coalesce(lang.cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            code = np.asarray(names.indices)
            for row, end, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                which, listed, n = windows(data, offsets, code[row:end], width)
                yield pa.record_batch([names.dictionary.take(pa.array(which)), listed, pa.array(n)], names=["lang", "window", "n"])

    return rows.mapInArrow(cut, "lang string, window string, n long")


# ------------------------------------------------------------------ counts

def _tokens(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the words, ``width`` a row) of a column of windows."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[ends[0]: ends[-1]]
    return data, np.concatenate([[0], np.flatnonzero(data == END) + 1])


def phrase_counts(sorted_windows: DataFrame, width: int, min_count: int) -> DataFrame:
    """(lang, phrase, words, n, whole) from windows sorted inside each partition.

    ``whole`` rows are complete and reach ``min_count``; the others are the first
    and last phrases of a partition, to be summed up with those of other ones.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                      # last row, in the next batch the first, with a count of 0
        open_, begun = np.zeros(width + 1, np.int64), np.zeros(width + 1, bool)
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                if held is None:
                    return
                table = held
            else:
                if not len(batch):
                    continue
                batch = pa.record_batch([batch.column(0), batch.column(1), batch.column(2)], names=["lang", "window", "n"])
                table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n, rows = np.asarray(table.column(2)), len(table)
            data, at = _tokens(table.column(1), width)
            flat = _strings(data, at, pa.binary())
            new = np.ones((rows, width + 1), bool)
            new[1:, 0] = pc.not_equal(table.column(0)[1:], table.column(0)[:-1]).to_numpy(zero_copy_only=False)
            new[1:, 1:] = pc.not_equal(flat[width:], flat[:-width]).to_numpy(zero_copy_only=False).reshape(-1, width)
            new = np.logical_or.accumulate(new, axis=1)
            at = at[:-1].reshape(rows, width)
            ends = np.append(at[1:, 0], len(data))
            out = []
            for k in range(width + 1):
                head = np.flatnonzero(new[:, k])
                total = np.add.reduceat(n, head)
                total[0] += open_[k]
                whole = np.ones(len(head), bool)
                if batch is None:
                    whole[:] = False
                else:
                    whole[0] &= begun[k]
                    open_[k] = total[-1]
                    head, total, whole = head[:-1], total[:-1], whole[:-1]
                    begun[k] |= len(head) > 0
                if k:                                    # a phrase of k words: its last word is there
                    stop = at[head, k] if k < width else ends[head]
                    full = stop - at[head, k - 1] > 1
                    head, total, whole, stop = head[full], total[full], whole[full], stop[full]
                else:
                    stop = at[head, 0]
                keep = ~whole | (total >= (min_count if k else 0))
                head, total, whole, stop = head[keep], total[keep], whole[keep], stop[keep]
                size = stop - at[head, 0]
                phrase = _strings(data[ranges(at[head, 0], size)], np.concatenate([[0], np.cumsum(size)]))
                out.append(pa.record_batch([table.column(0).take(pa.array(head)), phrase, pa.array(np.full(len(head), k, np.int32)),
                                            pa.array(total), pa.array(whole)], names=["lang", "phrase", "words", "n", "whole"]))
            yield from out
            if batch is not None:
                last = table.slice(rows - 1)
                held = pa.record_batch([last.column(0), last.column(1), pa.array([0], pa.int64())], names=["lang", "window", "n"])

    return sorted_windows.mapInArrow(count, "lang string, phrase string, words int, n long, whole boolean")


def frequent_phrases(docs: DataFrame, lang: Column, text_col: str = "text", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, words, n) of all phrases of up to ``max_words`` words found ``min_count`` times, and each language as the phrase of no words."""
    ordered = window_counts(docs, lang, text_col, max_words).repartitionByRange("lang", "window").sortWithinPartitions("lang", "window")
    counted = stored(phrase_counts(ordered, max_words, min_count), "phrase_counts")
    cut = counted.where("not whole").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return counted.where("whole").drop("whole").unionByName(cut).where((F.col("words") == 0) | (F.col("n") >= min_count))


# ------------------------------------------------------------------ streams

class _Levels:
    """The lockstep of a partition's lengths."""

    def __init__(self, width: int, before: list[int | None]):
        self.width, self.last = width, before            # count of the last phrase of each length, from earlier partitions first

    def pass_by(self, words: np.ndarray, n: np.ndarray, extension: np.ndarray):
        """(counts of the parts by length, rows that may still grow); ``extension`` is raised where a longer phrase comes by."""
        rows = np.arange(len(words))
        parts, growing = np.zeros((len(words), self.width), np.int64), []
        for k in range(1, self.width):
            seen = np.maximum.accumulate(np.where(words == k, rows, -1))
            deeper = words > k
            inside = deeper & (seen >= 0)
            parts[inside, k] = n[seen[inside]]
            if (outside := deeper & (seen < 0)).any():
                parts[outside, k] = self.last[k] or 0
            child = words == k + 1
            np.maximum.at(extension, seen[child & inside], n[child & inside])
            if seen[-1] >= 0:
                growing.append(int(seen[-1]))
        return parts, sorted(growing)


def in_stream(phrases: DataFrame, key: Column, max_words: int = MAX_WORDS) -> DataFrame:
    """``phrases`` with ``parts`` (at k - 1 the count of the first k words in the order of ``key``, for k below the
    length) and ``extension`` (the largest count of a phrase that has one word more at the end of ``key``)."""
    ensure_checkpoint_dir(phrases.sparkSession)
    stream = (phrases.select("lang", key.alias("key"), "phrase", "words", "n").repartitionByRange("lang", "key")
              .sortWithinPartitions("lang", "key").checkpoint())             # partitions stay as they are for both passes

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ahead = [None] * max_words, [0] * max_words
        for batch in batches:
            words, n = (np.asarray(batch.column(k)) for k in (0, 1))
            for k in range(1, max_words):
                at = np.flatnonzero(words == k)
                if last[k] is None:
                    early = slice(0, at[0] if len(at) else None)
                    ahead[k] = max(ahead[k], int(n[early][words[early] == k + 1].max(initial=0)))
                if len(at):
                    last[k] = int(n[at[-1]])
        part = TaskContext.get().partitionId()
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([last], pa.list_(pa.int64())), pa.array([ahead], pa.list_(pa.int64()))],
                              names=["part", "last", "ahead"])

    # Three numbers for each length and partition, however many phrases there are.
    found = sorted(stream.select("words", "n").mapInArrow(summary, "part int, last array<bigint>, ahead array<bigint>").collect())
    before, after, state = {}, {}, [None] * max_words
    for r in found:
        before[r.part] = list(state)
        state = [s if x is None else x for s, x in zip(state, r.last)]
    state = [0] * max_words
    for r in reversed(found):
        after[r.part] = list(state)
        state = [max(s, a) if x is None else a for s, x, a in zip(state, r.last, r.ahead)]

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        levels, held, names = _Levels(max_words, before.get(part, [None] * max_words)), None, ["lang", "phrase", "words", "n", "parts", "extension"]

        def listed(values: np.ndarray, words: np.ndarray) -> pa.Array:
            size = words - 1
            flat = values[np.repeat(np.arange(len(words)), size), ranges(np.ones(len(words), np.int64), size)]
            return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), pa.array(flat))

        def rows(batch, extension, parts):
            return pa.record_batch([*batch.columns[:4], listed(parts, np.asarray(batch.column(2)).astype(np.int64)), pa.array(extension)], names=names)

        for batch in batches:
            if not len(batch):
                continue
            if held is None:
                extension, old = np.zeros(len(batch), np.int64), np.zeros((0, max_words), np.int64)
            else:
                rest, grown, old = held
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
                extension = np.concatenate([grown, np.zeros(len(batch) - len(grown), np.int64)])
            words, n = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            parts, growing = levels.pass_by(words, n, extension)
            parts[: len(old)] = old                                          # held rows have theirs
            stay = np.zeros(len(batch), bool)
            stay[growing] = True
            done, wait = pa.array(np.flatnonzero(~stay)), pa.array(np.flatnonzero(stay))
            yield rows(batch.take(done), extension[~stay], parts[~stay])
            held = batch.take(wait), extension[stay], parts[stay]
        if held is not None:
            batch, extension, parts = held
            words = np.asarray(batch.column(2)).astype(np.int64)
            for k in range(1, max_words):
                if len(at := np.flatnonzero(words == k)):
                    extension[at[-1]] = max(extension[at[-1]], after[part][k])
            yield rows(batch, extension, parts)

    return stream.select("lang", "phrase", "words", "n").mapInArrow(
        attach, "lang string, phrase string, words int, n long, parts array<bigint>, extension long")


# ------------------------------------------------------------------ operator

def collocations(docs: DataFrame, *, lang: Column | None = None, text_col: str = "text", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, covered_percent: int = COVERED_PERCENT, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` occurrences; cut where the score floor(2000000 a / (l + r)) is lowest
    (of equals after the fewest words), the left part occurs ``l`` and the right
    part ``r`` times; ``n`` words in the language.  A phrase goes if a longer
    frequent one that holds it occurs at least ``covered_percent`` of 100 times
    as often.  Ranked by score, then ``a``, then the phrase in byte order.

    A null language is ``und``; null and empty texts have no words; ids play no
    part, so a repeated row counts as often as it is there.  A language without
    a frequent phrase, and an empty table, give no rows.
    """
    lang = F.col("lang") if lang is None else lang
    phrases = stored(frequent_phrases(docs, lang, text_col, max_words, min_count), "phrases")
    spoken = phrases.where("words > 0")
    split = F.split("phrase", "\n")
    backwards = F.concat(F.array_join(F.reverse(F.slice(split, F.lit(1), F.col("words"))), "\n"), F.lit("\n"))
    left = in_stream(spoken, F.col("phrase"), max_words).where("words > 1")
    right = in_stream(spoken, backwards, max_words).where("words > 1").select(
        "lang", "phrase", F.col("parts").alias("ends"), F.col("extension").alias("left_extension"))

    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.get("parts", k - 1).alias("l"), F.get("ends", F.col("words") - k - 1).alias("r")))
    # Exact: products and sums may pass 64 bits, so they are decimals without a fraction.
    scored = F.expr("""transform(cuts, c -> struct(cast(n as decimal(19, 0)) * 2000000
        div (cast(c.l as decimal(19, 0)) + cast(c.r as decimal(19, 0))) as score, c.k as k, c.l as l, c.r as r))""")
    covered = (F.greatest("extension", "left_extension").cast("decimal(19,0)") * 100
               >= F.col("n").cast("decimal(19,0)") * covered_percent)
    found = (left.join(right, ["lang", "phrase"]).where(~covered).withColumn("cuts", cuts)
             .withColumn("cut", F.array_min(scored))
             .select("lang", F.array_join(F.slice(split, F.lit(1), F.col("words")), " ").alias("phrase"), F.col("n").alias("a"),
                     "cut.l", "cut.r", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    words = phrases.where("words = 0").select("lang", F.col("n").alias("words_of_lang"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                           F.col("words_of_lang").alias("n"), "score")
