"""Token ids on disk: a table's texts, encoded in key order, in files of range-coded blocks, and those files read back.

A file holds, after the magic, its blocks one after another; then a footer with the block directory (ids, CRC-32, bytes), the document directory
(key or none, ids) and the table of its ids that every block starts from; then the footer's length and CRC-32 and the magic again. Blocks need
the footer's table and nothing of each other: see ``idcoder``. The manifest is a table with one row per file: part and seq order the files, and give the order of the ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm import idcoder
from trajlake.llm.common import fan_out, folder, fresh_folder, give_back, lean, publish, rows_of, small_batches, stage
from trajlake.llm.tokens import GROUP, SLICE, encoder, slices

MAGIC = b"TLIDS2\r\n"
#: Ids of a file, about: a task holds up to twice as many, so that its last files are halves of what is left and none is small. A file's blocks are decoded in two goes.
FILE_IDS = 2 * idcoder.READ_LANES * idcoder.BLOCK
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Held:
    """The documents that wait for their file, ids in pieces as they came: more are taken in without a copy of what there is, and each piece goes as it moves to a file."""

    def __init__(self, end_id: int) -> None:
        self.end_id, self.n_ids = end_id, 0
        self.keys: list[int | None] = []
        self.size, self.pieces = np.zeros(0, np.int64), []

    def add(self, keys: list[int | None], ids: np.ndarray, counts: np.ndarray) -> None:
        """Some more documents, to each of which the end is added."""
        self.keys += keys
        self.pieces.append(np.insert(ids, np.cumsum(counts), self.end_id))
        self.size = np.concatenate((self.size, counts + 1))
        self.n_ids += len(self.pieces[-1])

    def take(self, most: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Keys, sizes and ids of the first documents, up to that which reaches ``most`` ids; they are held no more."""
        n = min(int(np.searchsorted(np.cumsum(self.size), most)) + 1, len(self.size))
        keys, size = self.keys[:n], self.size[:n]
        ids, at = np.empty(int(size.sum()), "<u4"), 0
        self.pieces.reverse()
        while at < len(ids):
            piece = self.pieces.pop()
            own = piece[: len(ids) - at]
            ids[at : at + len(own)] = own
            at += len(own)
            if len(own) < len(piece):
                self.pieces.append(piece[len(own) :].copy())
        self.pieces.reverse()
        self.keys, self.size, self.n_ids = self.keys[n:], self.size[n:], self.n_ids - len(ids)
        return keys, size, ids


def pack(keys: list[int | None], counts: np.ndarray, ids: np.ndarray, block: int = idcoder.BLOCK) -> bytes:
    """One file's bytes."""
    table = idcoder.Table.of(ids)
    blocks = idcoder.encode(ids, table, block)
    directory = struct.pack("<QQ", len(blocks), len(keys))
    directory += np.array([(n, crc, len(code)) for n, crc, code in blocks], "<u4").tobytes()
    directory += np.array([k is not None for k in keys], "u1").tobytes()
    directory += np.array([k or 0 for k in keys], "<i8").tobytes() + np.asarray(counts, "<i8").tobytes()
    footer = zlib.compress(directory)
    footer = struct.pack("<I", len(footer)) + footer + table.to_bytes()
    return b"".join((MAGIC, *(code for _, _, code in blocks), footer, struct.pack("<II", len(footer), zlib.crc32(footer)), MAGIC))


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, id counts and ids of one file; ValueError if it is damaged."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a file of ids, or cut short")
    size, crc = struct.unpack("<II", data[-16:-8])
    footer = data[-16 - size : -16]
    if zlib.crc32(footer) != crc:
        raise ValueError("the footer's checksum doesn't hold")
    cut = 4 + struct.unpack_from("<I", footer)[0]
    directory, ids_table = zlib.decompress(footer[4:cut]), idcoder.Table.from_bytes(footer[cut:])
    n, docs = struct.unpack_from("<QQ", directory)
    table = np.frombuffer(directory, "<u4", 3 * n, 16).reshape(n, 3).tolist()
    at = 16 + 12 * n
    there = np.frombuffer(directory, "u1", docs, at)
    keys = np.frombuffer(directory, "<i8", docs, at + docs)
    counts = np.frombuffer(directory, "<i8", docs, at + 9 * docs)
    blocks, at = [], len(MAGIC)
    for ids, crc, size in table:
        blocks.append((ids, crc, memoryview(data)[at : at + size]))
        at += size
    return [int(k) if t else None for k, t in zip(keys, there, strict=True)], counts, idcoder.decode_row(blocks, ids_table)


def write_ids(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int, file_ids: int = FILE_IDS, block: int = idcoder.BLOCK) -> DataFrame:
    """Encodes the texts (null: empty) in ascending key order, null keys first, appends ``end_id`` to each, and writes the files.

    Returns the manifest. Rows with equal keys keep all their rows, ordered by text. A task holds the ids of two files at most;
    a repeated attempt writes files of its own, and the manifest names those of the attempt that Spark has committed.
    """
    spark = docs.sparkSession
    to = fresh_folder(spark, "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer)
        held = Held(end_id)

        def close(most: int) -> pa.RecordBatch:
            """A file of the first documents, up to that which reaches ``most`` ids."""
            nonlocal seq
            keys, size, ids = held.take(most)
            give_back()  # what texts have taken, before the coder takes its own
            path = publish(to, f"part-{part:05d}-{seq:05d}", pack(keys, size, ids, block))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path], "n_docs": [len(keys)], "n_tokens": [len(ids)]})
            seq += 1
            return row

        def encoded() -> Iterator[tuple[list[int | None], tuple[np.ndarray, np.ndarray]]]:
            """Keys, ids and how many each text has, of a slice each; the words known are looked through once for about ``GROUP`` of them."""
            own, splits, size = [], [], 0
            for batch in batches:
                for some in slices(batch, "t"):
                    own.append(some.column("k").to_pylist())
                    splits.append(coder.split(some.column("t")))
                    size += some.column("t").nbytes
                    if size >= GROUP * SLICE:
                        yield from zip(own, coder.encode_splits(splits), strict=True)
                        own, splits, size = [], [], 0
                        pa.default_memory_pool().release_unused()
            if splits:
                yield from zip(own, coder.encode_splits(splits), strict=True)

        for own, (new, n) in encoded():
            held.add(own, new, n)
            while held.n_ids >= 2 * file_ids:
                yield close(file_ids)
        if held.n_ids > file_ids:
            yield close(held.n_ids // 2)
        while held.keys:
            yield close(held.n_ids)

    ordered = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).repartitionByRange("k").sortWithinPartitions("k", "t")
    with small_batches(spark, SLICE):
        return stage(ordered.mapInArrow(lean(write), MANIFEST), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """Reads the manifest's files back, checks them, and returns per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    before = totals.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    placed = (
        manifest.join(before, "part")
        .withColumn("start", F.col("before") + F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens"))
        .select("path", "start")
        # By ranges of a unique number, so that each task has as many files as any other.
        .repartitionByRange(fan_out(manifest.sparkSession), "start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in rows_of(batch, ["path", "start"]):
                store, name = folder(path)
                with store.open_input_stream(name) as f:
                    keys, counts, ids = unpack(f.read())
                ends = np.cumsum(counts)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - counts, ends, strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, pa.int64()), "start": pa.array(start + ends - counts), "n_tokens": pa.array(counts), "ids_crc32": pa.array(crcs, pa.int64())})

    return placed.mapInArrow(lean(read), DOCS)
