"""Token ids as Arrow files of equal-length sequences.

``write_sequences`` sorts the documents by id with a range partitioning, so
every task writes the next stretch of the id order.  A task encodes its
documents, appends the end id to each, packs the ids into sequences of
``length`` ids, and writes them batch by batch to an Arrow IPC file: the
Arrow stream followed by a footer with the place of each batch.  Every batch
has a fixed-size-list column of ids (16 bits each where the vocabulary allows,
else 32) and one of the mask (one bit each: an id or padding, which is at the
end of a file only), so any sequence is reached without reading or
copying what lies before it (``SequenceFile``).  A second file holds the
documents' ids, starts and lengths.

Files go to a shared folder through ``pyarrow.fs`` (any URI it knows).  A
file's name holds the task attempt, and a file counts only if the manifest
lists it.  The manifest is written by Spark, which commits one attempt of each
task, so a lost executor or a repeated task leaves no wrong rows.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.arrays import LOWER, NON_SPACE, Words, chunks, heads, ranges, sums_by
from fundscope.llm.batches import map_texts
from fundscope.llm.storage import stored
from fundscope.session import scratch_path

LENGTH = 2048
SEQUENCES = 128            # per batch
END_ID = 1
CACHED_PARTS = 500_000     # per worker (some 15 MB); only saves time
ENCODED_AT_ONCE = 4096     # parts: an encoding takes about a kB
CHUNK_BYTES = 256 << 10    # a run of texts, encoded together


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(use_mmap=True), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(use_mmap=True), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


# Classes of bytes for cutting words into parts: 1 letter, 2 punctuation, 0 other (a part never ends beside those).
_PART = np.zeros(256, np.int8)
_PART[0x41:0x5B] = _PART[0x61:0x7B] = 1
for _low, _high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _PART[_low:_high] = 2
_PART[0x27] = 0


class Encoder:
    """Ids of whole texts.

    The vocabulary's rules work inside white-space bounds (white space itself
    is dropped), fold case, and end a unit where ASCII letters meet ASCII
    punctuation other than the apostrophe.  So a text's ids are those of its
    parts, one after the other, and a part that was met before needs no second
    encoding.  Texts with the start of a special token are cut at white space
    only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.uint16 if max(names.values()) < 1 << 16 else np.uint32
        self.ends = np.zeros(max(names.values()) + 1, bool)      # ids that end a unit
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.hash, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the parts, end to end; number of ids of each part)."""
        letters = np.array([p.isalpha() for p in parts], bool)
        lists: list = [None] * len(parts)
        plain = np.flatnonzero(letters)
        for at in range(0, len(plain), 256):
            some = plain[at: at + 256].tolist()
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([parts[k] for k in some])], add_special_tokens=False)[0].ids)
            end = np.flatnonzero(self.ends[ids]) + 1
            if len(end) == len(some) and end[-1] == len(ids):      # one unit each
                for k, a, b in zip(some, np.append(0, end[:-1]).tolist(), end.tolist()):
                    lists[k] = ids[a:b]
        alone = [k for k, x in enumerate(lists) if x is None]
        for at in range(0, len(alone), ENCODED_AT_ONCE):
            some = alone[at: at + ENCODED_AT_ONCE]
            for k, e in zip(some, self.tokenizer.encode_batch_fast([parts[k] for k in some], add_special_tokens=False)):
                lists[k] = np.array(e.ids, np.int64)
        return np.concatenate([np.zeros(0, np.int64), *lists]), np.array([len(x) for x in lists], np.int64)

    def learn(self, h: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> None:
        if len(self.hash) > CACHED_PARTS:
            self.forget()
        at = np.searchsorted(self.hash, h)
        new = np.flatnonzero(at == len(self.hash)) if not len(self.hash) else np.flatnonzero(
            self.hash[np.minimum(at, len(self.hash) - 1)] != h)
        if len(new):
            parts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[new].tolist(), end[new].tolist())]
            ids, size = self.encode(parts)
            merged = np.concatenate([self.hash, h[new]])
            order = np.argsort(merged, kind="stable")
            self.hash = merged[order]
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])[order]
            self.size = np.concatenate([self.size, size])[order]
            self.flat = np.concatenate([self.flat, ids.astype(self.dtype)])

    def __call__(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of a run of documents, each with the end id; number of ids of each)."""
        raw = data.tobytes()
        part = None
        if b"<|" not in raw:
            data = LOWER[data]
            raw, part = data.tobytes(), _PART
        words = Words(data, offsets, NON_SPACE, part)
        h = words.hashes()
        order = np.argsort(h)
        head = heads(h[order])
        first = order[head]
        self.learn(h[first], raw, words.start[first], words.end[first])
        at = np.searchsorted(self.hash, h[first])
        start, size = (np.empty(len(h), np.int64) for _ in range(2))
        many = np.diff(np.append(head, len(h)))
        start[order], size[order] = np.repeat(self.start[at], many), np.repeat(self.size[at], many)
        count = sums_by(size, words.doc) + 1
        out = np.empty(int(count.sum()), self.dtype)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(count) - 1] = False
        out[inner] = self.flat[ranges(start, size)]
        out[~inner] = end_id
        return out, count


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker: what it has met stays known."""
    return Encoder(path)


class _SequenceWriter:
    def __init__(self, sink, length: int, kind: np.dtype):
        self.kind = np.dtype(kind)
        ids, mask = pa.list_(pa.from_numpy_dtype(self.kind), length), pa.list_(pa.bool_(), length)
        self.schema = pa.schema([pa.field("input_ids", ids), pa.field("mask", mask)])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.length, self.held, self.n_held, self.total = length, [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.total += len(ids)
        size = self.length * SEQUENCES
        if self.n_held >= size:
            flat = np.concatenate(self.held)
            whole = len(flat) // size * size
            for at in range(0, whole, size):
                self._write(flat[at: at + size], size)
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def _write(self, flat: np.ndarray, n_ids: int) -> None:
        mask = np.arange(len(flat)) < n_ids
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.kind)
            padded[: len(flat)] = flat
            self._write(padded, len(flat))
        self.writer.close()


class SequenceFile:
    """Random access to the sequences of one file, as views of the mapped file."""

    def __init__(self, uri: str):
        fs, path = _open(uri)
        self.file = pa.ipc.open_file(fs.open_input_file(path))
        last = self.file.num_record_batches - 1
        self.size = last * SEQUENCES + self.file.get_batch(last).num_rows if last >= 0 else 0

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < self.size:
            raise IndexError(i)
        batch = self.file.get_batch(i // SEQUENCES)
        ids, mask = (batch.column(k)[i % SEQUENCES].values for k in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def batches(self) -> Iterator[tuple[np.ndarray, pa.BooleanArray]]:
        """All ids and masks, a batch at a time, sequences end to end."""
        for k in range(self.file.num_record_batches):
            batch = self.file.get_batch(k)
            ids, mask = (batch.column(c).flatten() for c in (0, 1))
            yield ids.to_numpy(zero_copy_only=True), mask


def write_sequences(docs: DataFrame, tokenizer_path: str, folder: str | None = None, *, id_col: str = "doc_id",
                    text_col: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Write the files and return the manifest: part, path, n_docs, n_ids, in the order of the ids.

    Null texts are empty: one end id.  Rows without id come first; rows that
    repeat an id follow each other, ordered by text.  An empty table gives no
    files.
    """
    folder = folder or scratch_path(docs.sparkSession, "sequences")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        start = next(batches, None)
        if start is None:
            return
        task = TaskContext.get()
        fs, at = _open(folder)
        fs.create_dir(at, recursive=True)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        encode, n_docs = encoder(tokenizer_path), 0
        fields = pa.schema([("doc_id", start.schema.field(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        with fs.open_output_stream(f"{at}/{name}.arrow") as sink, fs.open_output_stream(f"{at}/{name}.docs.arrow") as side:
            out, index = _SequenceWriter(sink, length, encode.dtype), pa.ipc.new_file(side, fields)
            for batch in itertools.chain([start], batches):
                for row, end, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                    ids, count = encode(data, offsets, end_id)
                    place = out.total + np.cumsum(count) - count
                    index.write_batch(pa.record_batch([batch.column(0).slice(row, end - row), pa.array(place),
                                                       pa.array(count)], schema=fields))
                    out.add(ids)
                    n_docs += end - row
            out.close()
            index.close()
        yield pa.record_batch([pa.array([task.partitionId()]), pa.array([f"{folder}/{name}"]), pa.array([n_docs]),
                               pa.array([out.total])], names=["part", "path", "n_docs", "n_ids"])

    tie = F.xxhash64(F.col(text_col))
    ordered = (docs.select(id_col, text_col).repartitionByRange(F.col(id_col), tie)
               .sortWithinPartitions(F.col(id_col), tie, F.col(text_col)))
    return stored(map_texts(ordered, write, "part long, path string, n_docs long, n_ids long"), "manifest")


def read_sequences(manifest: DataFrame, id_type) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it, over all files), n_tokens, ids_crc32."""
    files = manifest.count()                        # one row per file
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (manifest.select("part", "path", before.alias("before"))
              .repartitionByRange(max(1, files), "part"))
    schema = (manifest.select(F.lit(None).cast(id_type).alias("doc_id")).schema
              .add("start", "long").add("n_tokens", "long").add("ids_crc32", "long"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                stream, flat, base = SequenceFile(f"{path}.arrow").batches(), b"", 0
                fs, at = _open(f"{path}.docs.arrow")
                with pa.ipc.open_file(fs.open_input_file(at)) as index:
                    for k in range(index.num_record_batches):
                        docs = index.get_batch(k)
                        crcs = []
                        for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                            crc, end = 0, start + n
                            while True:
                                crc = zlib.crc32(flat[4 * (start - base): 4 * (end - base)], crc)
                                held = base + len(flat) // 4
                                if end <= held:
                                    break
                                start = base = held
                                ids, mask = next(stream)
                                flat = memoryview(ids[: mask.true_count].astype("<u4").tobytes())
                            crcs.append(crc)
                        yield pa.record_batch([docs.column(0), pa.array(np.asarray(docs.column(1)) + before),
                                               docs.column(2), pa.array(crcs, pa.int64())], names=schema.names)

    return placed.mapInArrow(read, schema)
