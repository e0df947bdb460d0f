"""Token ids in binary files: frequency ranks in a byte-aligned variable-length code with separate control bytes.

A data set is a folder of shards, in ascending order of document id. A shard is a sequence of blocks:

    header   3 unsigned 64-bit numbers: documents, control bytes, data bytes
    lengths  an unsigned 64-bit id count per document
    names    per document a signed 64-bit id, then per document a byte that is 1 if the id is null
    control  per document, for each four ids one byte of four 2-bit fields: bytes of the rank, less one
    data     the ranks in one to four bytes, lowest byte first

A document's ids are filled up to a multiple of four with rank 0. The commonest id has rank 0.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendmill.llm.common import numbered, open_store, stage
from trendmill.llm.tokens import encoder
from trendmill.session import fresh_path

# A shard is closed when it holds this many ids. Tasks aim at three quarters of it, so most write one shard.
SHARD_IDS = 8_000_000
# Tasks that write, and tasks that read: beyond this size of the data each has several shards.
MAX_TASKS = 10_000
BLOCK_IDS = 1 << 18
_HEADER = struct.Struct("<3Q")
# Of each control byte: which of the 16 bytes of its four ranks are written.
_WRITTEN = (np.arange(4) <= (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)[:, :, None]).reshape(256, 16)


def code_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of ranks whose number is a multiple of four."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).view(np.uint8) + (ranks > 0xFFFF).view(np.uint8) + (ranks > 0xFFFFFF).view(np.uint8)
    four = extra.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 16)[_WRITTEN[control]].tobytes()


def decode_ranks(control: bytes, data: bytes) -> np.ndarray:
    """The ranks again; which of their bytes the data holds comes from a table that is looked up by control byte."""
    written = _WRITTEN[np.frombuffer(control, np.uint8)]
    ranks = np.zeros(written.shape, np.uint8)
    ranks[written] = np.frombuffer(data, np.uint8)
    return ranks.view("<u4").ravel()


def _block(names: list, texts: list[np.ndarray], rank_of: np.ndarray) -> bytes:
    lengths = np.array([len(t) for t in texts], np.int64)
    padded = -(-lengths // 4) * 4
    ranks = np.zeros(int(padded.sum()), np.uint32)
    for at, ids in zip(np.cumsum(padded) - padded, texts):
        ranks[at:at + len(ids)] = rank_of[ids]
    control, data = code_ranks(ranks)
    return b"".join((
        _HEADER.pack(len(texts), len(control), len(data)), lengths.astype("<u8").tobytes(),
        np.array([n or 0 for n in names], "<i8").tobytes(), bytes(n is None for n in names), control, data))


def _blocks(stream) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(names, id counts, padded ranks) of each block of an open shard."""
    while head := stream.read(_HEADER.size):
        n, n_control, n_data = _HEADER.unpack(head)
        lengths = np.frombuffer(stream.read(8 * n), "<u8").astype(np.int64)
        names = np.frombuffer(stream.read(8 * n), "<i8").tolist()
        missing = stream.read(n)
        ranks = decode_ranks(stream.read(n_control), stream.read(n_data))
        yield [None if m else name for name, m in zip(names, missing)], lengths, ranks


def tokenized(docs: DataFrame, vocabulary: str, end: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, doc_id, ids) in the shared folder: ids of the whole text and the end id, in the encoder's width."""
    [row, name, t] = ["row", "doc_id", "t"]
    source = numbered(docs.select(F.col(f"`{doc_id}`").cast("long").alias(name),
                                  F.col(f"`{text}`").cast("binary").alias(t)), row)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        last = np.array([end], words.dtype).tobytes()
        for batch in batches:
            texts = (x.as_py() for x in batch.column(1))
            ids = pa.array((x.tobytes() + last for x in words.encode_all(texts)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), ids], [row, name, "ids"])

    return stage(source.select(name, t, row).mapInArrow(encode, "row long, doc_id long, ids binary"), "ids", "zstd")


def id_counts(ids: DataFrame, dtype: str, size: int) -> np.ndarray:
    """How often each id of the vocabulary occurs: counted in the tasks; one number per id comes to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = b"".join(x.as_py() for x in batch.column(0).slice(at, 256))
                total += np.bincount(np.frombuffer(some, dtype), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    for r in ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    return counts


class _Shard:
    """One file that is being written; its name is used once, by whichever attempt of the task writes it."""

    def __init__(self, store, folder: str, slot: int, part: int, rank_of: np.ndarray, block_ids: int):
        self.place, self.rank_of, self.block_ids = (slot, part), rank_of, block_ids
        self.file = f"shard-{slot:06d}-{part:06d}-{uuid.uuid4().hex}"
        self.out = store.open_output_stream(f"{folder}/{self.file}")
        self.documents = self.ids = 0
        self._empty()

    def _empty(self) -> None:
        self.names, self.texts, self.held = [], [], 0

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.names.append(name)
        self.texts.append(ids)
        self.held += len(ids)
        self.documents, self.ids = self.documents + 1, self.ids + len(ids)
        if self.held >= self.block_ids:
            self._write()

    def _write(self) -> None:
        self.out.write(_block(self.names, self.texts, self.rank_of))
        self._empty()

    def close(self) -> pa.RecordBatch:
        """The shard's row of the manifest."""
        if self.names:
            self._write()
        self.out.close()
        slot, part = self.place
        return pa.RecordBatch.from_pydict({
            "slot": [slot], "part": [part], "file": [self.file], "documents": [self.documents], "ids": [self.ids]})


def write(docs: DataFrame, vocabulary: str, end: int, path: str | None = None, text: str = "text",
          doc_id: str = "doc_id") -> tuple[str, DataFrame, np.ndarray]:
    """Encode ``docs`` into shards below ``path``: (path, manifest, ids by rank).

    The manifest has a row per shard: slot (the task's range of documents), part (the shard's place in it), file,
    documents, ids. Only files it names belong to the data set; a task that ran twice leaves files that nobody reads.
    A shard holds SHARD_IDS ids at most and the rest of its last document; a document is never cut.
    """
    spark = docs.sparkSession
    path = path or fresh_path(spark, "shards")
    words = encoder(vocabulary)
    dtype, size = words.dtype.str, max(words.size, end + 1)
    ids = tokenized(docs, vocabulary, end, text, doc_id)
    counts = id_counts(ids, dtype, size)
    by_rank = np.lexsort((np.arange(size), -counts)).astype(np.uint32)
    rank_of = np.zeros(size, np.uint32)
    rank_of[by_rank] = np.arange(size, dtype=np.uint32)
    store, folder = open_store(path)
    store.create_dir(folder, recursive=True)
    with store.open_output_stream(f"{folder}/by_rank.u32") as out:
        out.write(by_rank.astype("<u4").tobytes())

    shard_ids, block_ids = SHARD_IDS, BLOCK_IDS

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, part, shard = TaskContext.get().partitionId(), 0, None
        store, folder = open_store(path)
        for batch in batches:
            for name, some in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = shard or _Shard(store, folder, slot, part, rank_of, block_ids)
                shard.add(name, np.frombuffer(some.as_py(), dtype))
                if shard.ids >= shard_ids:
                    yield shard.close()
                    part, shard = part + 1, None
        if shard is not None:
            yield shard.close()

    # Rows of one doc_id are told apart by the staged row number, so that no doc_id makes a range too long.
    tasks = min(MAX_TASKS, max(1, -(-int(counts.sum()) * 4 // (SHARD_IDS * 3))))
    ranged = ids.repartitionByRange(tasks, "doc_id", "row").sortWithinPartitions("doc_id", "row")
    manifest = stage(ranged.select("doc_id", "ids").mapInArrow(
        save, "slot long, part long, file string, documents long, ids long"), "manifest")
    return path, manifest, by_rank


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids of all shards before: before in its slot, and in earlier slots.

    One window runs over all slots (MAX_TASKS rows at most), the other over the shards of one slot.
    """
    slots = manifest.groupBy("slot").agg(F.sum("ids").alias("slot_ids"))
    earlier = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    firsts = slots.select("slot", F.coalesce(F.sum("slot_ids").over(earlier), F.lit(0)).alias("first"))
    in_slot = Window.partitionBy("slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("ids").over(in_slot), F.lit(0))
    # A row of two numbers per slot.
    return manifest.withColumn("inside", inside).join(F.broadcast(firsts), "slot") \
        .withColumn("start", F.col("first") + F.col("inside")).drop("first", "inside")


def read(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian, 32 bits), from the files."""
    work = with_starts(manifest).select("file", "start")
    tasks = min(MAX_TASKS, max(1, manifest.count()))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        with store.open_input_stream(f"{folder}/by_rank.u32") as stream:
            by_rank = np.frombuffer(stream.read(), "<u4")
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{folder}/{file}") as stream:
                    for names, lengths, ranks in _blocks(stream):
                        ids, padded = by_rank[ranks], -(-lengths // 4) * 4
                        at = np.cumsum(padded) - padded
                        before = start + np.cumsum(lengths) - lengths
                        start += int(lengths.sum())
                        yield pa.RecordBatch.from_arrays([
                            pa.array(names, pa.int64()), pa.array(before), pa.array(lengths),
                            pa.array([ids[a:a + n].tobytes() for a, n in zip(at.tolist(), lengths.tolist())],
                                     pa.binary()),
                        ], ["doc_id", "start", "n_tokens", "ids"])

    return work.repartition(tasks, "file").mapInArrow(
        load, "doc_id long, start long, n_tokens long, ids binary")


def write_and_read(docs: DataFrame, vocabulary: str, end: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write ``docs`` as shards and return what the files hold.

    Null text counts as empty: only the end id. Rows with a null doc_id come first; rows that share a doc_id follow each
    other in any order and each keep their own start. An empty table makes no shards and no rows. Texts are encoded
    whole. Other columns are not read.
    """
    path, manifest, _ = write(docs, vocabulary, end, text=text, doc_id=doc_id)
    return read(docs.sparkSession, path, manifest)
