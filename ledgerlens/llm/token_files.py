"""Token ids as Arrow files of equal-length sequences and masks.

The documents' ids, in ascending doc_id order, form one long stream that is
cut into shards. A shard is two Arrow IPC files in the shared folder:

``*.tokens.arrow``  columns ``ids`` (fixed-size list of unsigned integers, the
    narrowest type that holds the vocabulary) and ``mask`` (fixed-size list of
    booleans, false where the last sequence is padded), in record batches of
    SEQUENCES_PER_BATCH rows. Any sequence is a slice of a memory-mapped
    buffer: row r is in batch r // SEQUENCES_PER_BATCH.
``*.docs.arrow``  columns ``doc_id``, ``start`` (place in the shard's stream)
    and ``n_tokens``.

A task writes under a new name and reports it in the manifest, which Spark
commits; files of failed or repeated attempts are never referred to.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, shared_path, store, text_slices, whole_text
from .vocabulary import DEFAULT_TOKENIZER, encoder

SEQUENCE_LENGTH = 1024
SEQUENCES_PER_BATCH = 256
#: Rows of the document index that are read or written at once.
DOCS_PER_BATCH = 4096
#: Characters of a text that count for the ranges of documents (the order is by whole texts).
BOUND_CHARS = 64
_NO_DOC = "doc_id long, start long, n_tokens long, ids_crc32 long"
_MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_sequences long"


def open_filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system behind ``uri`` (a local or shared path, HDFS or an
    object store that Arrow knows) and the path in it."""
    if "://" not in uri and ":" in uri.split("/", 1)[0]:  # file:/path
        scheme, path = uri.split(":", 1)
        uri = f"{scheme}://{path}"
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def id_type(vocabulary_size: int) -> pa.DataType:
    return pa.uint16() if vocabulary_size <= 1 << 16 else pa.uint32()


class ShardWriter:
    """Writes one shard; holds at most a batch of sequences and of documents."""

    def __init__(self, base: str, vocabulary_size: int, length: int = SEQUENCE_LENGTH):
        self.path, self._length = f"{base.rstrip('/')}/{uuid.uuid4().hex}", length
        self._type = id_type(vocabulary_size)
        self._dtype = np.dtype(self._type.to_pandas_dtype())
        self._fs, local = open_filesystem(self.path)
        self._fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
        tokens = pa.schema([("ids", pa.list_(self._type, length)),
                            ("mask", pa.list_(pa.bool_(), length))])
        index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self._sinks = [self._fs.open_output_stream(f"{local}.{kind}.arrow")
                       for kind in ("tokens", "docs")]
        self._tokens = pa.ipc.new_file(self._sinks[0], tokens)
        self._index = pa.ipc.new_file(self._sinks[1], index)
        self._pending: list[np.ndarray] = []
        self._held, self._docs = 0, []
        self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append((doc_id, self.n_tokens, len(ids)))
        self.n_docs += 1
        self.n_tokens += len(ids)
        self._pending.append(ids.astype(self._dtype))
        self._held += len(ids)
        if self._held >= SEQUENCES_PER_BATCH * self._length:
            self._flush_tokens()
        if len(self._docs) >= DOCS_PER_BATCH:
            self._flush_docs()

    def _flush_tokens(self, last: bool = False) -> None:
        flat, step = np.concatenate(self._pending), SEQUENCES_PER_BATCH * self._length
        whole = len(flat) if last else len(flat) // step * step
        for at in range(0, whole, step):
            self._write_sequences(flat[at:min(at + step, whole)])
        self._pending = [flat[whole:]]
        self._held = len(flat) - whole

    def _write_sequences(self, ids: np.ndarray) -> None:
        padded = -len(ids) % self._length
        mask = np.ones(len(ids) + padded, dtype=bool)
        mask[len(ids):] = False
        ids = np.concatenate([ids, np.zeros(padded, dtype=self._dtype)])
        self._tokens.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids, self._type), self._length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self._length)],
            schema=self._tokens_schema()))
        self.n_sequences += len(ids) // self._length

    def _tokens_schema(self) -> pa.Schema:
        return pa.schema([("ids", pa.list_(self._type, self._length)),
                          ("mask", pa.list_(pa.bool_(), self._length))])

    def _flush_docs(self) -> None:
        doc_id, start, n = (list(x) for x in zip(*self._docs))
        self._index.write_batch(pa.record_batch(
            [pa.array(x, pa.int64()) for x in (doc_id, start, n)],
            names=["doc_id", "start", "n_tokens"]))
        self._docs = []

    def close(self) -> None:
        if self._held:
            self._flush_tokens(last=True)
        if self._docs:
            self._flush_docs()
        for writer, sink in ((self._tokens, self._sinks[0]), (self._index, self._sinks[1])):
            writer.close()
            sink.close()


class ShardReader:
    """Random access to one shard; local files are memory-mapped."""

    def __init__(self, path: str):
        self._fs, local = open_filesystem(path)
        self._sources = [self._open(f"{local}.{kind}.arrow") for kind in ("tokens", "docs")]
        self._tokens, self._index = map(pa.ipc.open_file, self._sources)
        self.length = self._tokens.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def _open(self, path: str):
        if isinstance(self._fs, fs.LocalFileSystem):
            return pa.memory_map(path)
        return self._fs.open_input_file(path)

    def _sequences(self, batch: int) -> pa.RecordBatch:
        if batch != self._at:
            self._at, self._batch = batch, self._tokens.get_batch(batch)
        return self._batch

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view, not a copy) and mask of one sequence."""
        batch, at = self._sequences(row // SEQUENCES_PER_BATCH), row % SEQUENCES_PER_BATCH
        span = slice(at * self.length, (at + 1) * self.length)
        return (batch.column(0).values.to_numpy()[span],
                batch.column(1).values[span].to_numpy(zero_copy_only=False))

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids of ``n`` places from ``start`` of the shard's stream; what the
        mask rules out is never part of a document."""
        step, parts = SEQUENCES_PER_BATCH * self.length, []
        while n > 0:
            values = self._sequences(start // step).column(0).values.to_numpy()
            part = values[start % step:start % step + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        for i in range(self._index.num_record_batches):
            yield from zip(*(c.to_pylist() for c in self._index.get_batch(i).columns))

    def close(self) -> None:
        self._tokens = self._index = self._batch = None
        for source in self._sources:
            source.close()


def write_token_files(docs: DataFrame, base: str | None = None, end_id: int = 0,
                      tokenizer: str = DEFAULT_TOKENIZER,
                      length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Encode every text of ``docs`` (columns doc_id and text; others ignored),
    append ``end_id``, write the shards under ``base`` and return the manifest.

    A null text is empty: its document holds ``end_id`` only. Documents are in
    ascending doc_id order, a null doc_id first and equal doc_ids by text. An
    empty table gives no shard.
    """
    base = base or shared_path(docs.sparkSession, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer, added_tokens=True), np.array([end_id], dtype="<u4")
        writer = None
        for batch in batches:
            for at, texts in text_slices(batch):
                if writer is None:
                    writer = ShardWriter(base, max(own.vocabulary_size, end_id + 1), length)
                doc_ids = batch.column(0).slice(at, len(texts)).to_pylist()
                for doc_id, ids in zip(doc_ids, own.encode(texts)):
                    writer.add(doc_id, np.concatenate([np.frombuffer(ids, dtype="<u4"), end]))
        if writer is not None:
            writer.close()
            yield pa.record_batch(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([writer.path]),
                 *(pa.array([n], pa.int64()) for n in
                   (writer.n_docs, writer.n_tokens, writer.n_sequences))],
                ["shard", "path", "n_docs", "n_tokens", "n_sequences"])

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
               # a repeated doc_id is split by how its texts begin: the bounds hold no whole text
               .repartitionByRange("doc_id", F.substring("text", 1, BOUND_CHARS))
               .sortWithinPartitions("doc_id", "text"))
    return store(map_batches(ordered, run, _MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (in the stream of all shards), n_tokens and ids_crc32 of
    every document, all of them taken from the files: null doc_ids and repeated
    rows as they were written. A manifest without shards gives no rows."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    count = max(1, manifest.count())  # one task a shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader, rows = ShardReader(path), []
                for doc_id, start, n in reader.documents():
                    crc = zlib.crc32(reader.ids(start, n).astype("<u4"))
                    rows.append((doc_id, base + start, n, crc))
                    if len(rows) == DOCS_PER_BATCH:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)
                reader.close()

    return map_batches(shards.repartitionByRange(count, "shard").select("path", "base"),
                       run, _NO_DOC)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, pa.int64()) for x in map(list, zip(*rows))],
                           ["doc_id", "start", "n_tokens", "ids_crc32"])
