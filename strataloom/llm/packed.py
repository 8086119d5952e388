"""Token ids in files of fixed-width bit packing, with block offsets for random access.

A file holds, little-endian: the mark, bits an id, ids a block, documents, ids (16-byte
mark and 4 longs), the document ids, the first id of each document and the end, the
byte offset of each block and the end, then the blocks. An id takes the fewest bits that
hold any id of the vocabulary; a block starts at a byte, so blocks unpack on their own.

Files come in ascending doc_id order (a null id first), cut by range over the tasks and
rolled at `FILE_IDS` ids. They lie in the shared folder; a task writes under a name of its
attempt and renames, so that a repeated task leaves the same files. Null texts are empty:
they hold the end id alone. Repeated ids keep all their rows, ordered by text.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.llm.bpe import VOCABULARY, Encoder
from strataloom.llm.common import cut, shared_dir, spread, table

MARK = b"packed ids 1\0\0\0\0"
BLOCK_IDS, FILE_IDS = 1 << 16, 1 << 24
KEPT = 500_000  # pretokens kept by a worker
NO_ID = -(2**63)  # stands for a null doc_id in a file


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2^bits, bits <= 32, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for i in range(0, len(ids), BLOCK_IDS):
        part = ids[i : i + BLOCK_IDS].astype(np.uint32)
        out.append(np.packbits((part[:, None] >> np.arange(bits, dtype=np.uint32)) & 1, bitorder="little", axis=None).tobytes())
    return b"".join(out)


def unpack(raw: bytes, count: int, bits: int, first: int = 0) -> np.ndarray:
    """`count` ids of a block from its id number `first` on."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", count, first * bits // 8).astype(np.uint32)
    place = np.arange(first, first + count, dtype=np.int64) * bits
    held = np.frombuffer(raw + b"\0" * 8, np.uint8)
    at, word = place >> 3, np.zeros(count, np.uint64)
    for k in range(5):
        word |= held[at + k].astype(np.uint64) << np.uint64(8 * k)
    return (word >> (place & 7).astype(np.uint64) & np.uint64(2**bits - 1)).astype(np.uint32)


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or a local path, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(path))


def write_file(path: str, doc_ids: np.ndarray, begin: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> None:
    """One file, complete or not there at all. begin: the first id of each document, and the end."""
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    head = MARK + np.array([bits, block, len(doc_ids), len(ids)], "<i8").tobytes()
    head += doc_ids.astype("<i8").tobytes() + begin.astype("<i8").tobytes()
    first = len(head) + 8 * (len(blocks) + 1)
    head += (first + np.concatenate([[0], np.cumsum([len(b) for b in blocks])])).astype("<i8").tobytes()
    where, path = store(path)
    own = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(own) as f:
        f.write(head)
        for b in blocks:
            f.write(b)
    where.move(own, path)


class PackedFile:
    """Reads a file by document or by range of ids; only the head and the blocks in question are read."""

    def __init__(self, path: str):
        where, path = store(path)
        self.file = where.open_input_file(path)
        if self.file.read_at(16, 0) != MARK:
            raise ValueError(f"{path} is not a file of packed ids")
        self.bits, self.block, n, self.n_ids = np.frombuffer(self.file.read_at(32, 16), "<i8").tolist()
        blocks = -(-self.n_ids // self.block)
        head = self.file.read_at(8 * (2 * n + blocks + 2), 48)
        self.doc_ids = np.frombuffer(head, "<i8", n)
        self.begin = np.frombuffer(head, "<i8", n + 1, 8 * n)
        self.offsets = np.frombuffer(head, "<i8", blocks + 1, 8 * (2 * n + 1))

    def ids(self, start: int, stop: int) -> np.ndarray:
        out = []
        for k in range(start // self.block, -(-stop // self.block)):
            raw = self.file.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k]))
            a, b = max(start - k * self.block, 0), min(stop - k * self.block, self.block)
            out.append(unpack(raw, b - a, self.bits, a))
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.begin[place]), int(self.begin[place + 1]))

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Document id, start in the file and ids of every document, a few blocks at a time."""
        a = 0
        while a < len(self.doc_ids):
            b = max(a + 1, int(np.searchsorted(self.begin, self.begin[a] + 4 * self.block, "right")) - 1)
            held = self.ids(int(self.begin[a]), int(self.begin[b]))
            for i in range(a, b):
                yield int(self.doc_ids[i]), int(self.begin[i]), held[self.begin[i] - self.begin[a] : self.begin[i + 1] - self.begin[a]]
            a = b


@lru_cache(2)
def library_encoder(path: str) -> tuple[Encoder, int]:
    """An encoder whose pretokens the tokenizers library encodes, and the size of the vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    added = [x.content for x in t.get_added_tokens_decoder().values()]
    return Encoder(added, lambda words: [x.ids for x in t.encode_batch_fast(words, add_special_tokens=False)], KEPT), t.get_vocab_size()


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, end_id: int = 0) -> DataFrame:
    """Encode and write all texts; rows (part, number, file, n_docs, n_ids), one for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = library_encoder(path)
        part, number = TaskContext.get().partitionId(), 0
        held_ids, held_docs, held_sizes = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids, sizes = np.concatenate(held_ids), np.concatenate(held_sizes)
            name = f"{folder}/part-{part:06d}-{number:04d}.bin"
            write_file(name, np.concatenate(held_docs), np.concatenate([[0], np.cumsum(sizes)]), ids, bits_for(size))
            row = pa.RecordBatch.from_pylist([{"part": part, "number": number, "file": name, "n_docs": len(sizes), "n_ids": len(ids)}], pa.schema({"part": pa.int32(), "number": pa.int32(), "file": pa.string(), "n_docs": pa.int64(), "n_ids": pa.int64()}))
            number += 1
            for x in (held_ids, held_docs, held_sizes):
                x.clear()
            return row

        for batch in batches:
            doc_ids = batch.column(0).fill_null(NO_ID).to_numpy()
            for a, b, ids, begin in encoder.texts(batch.column(1)):
                held_ids.append(np.insert(ids, begin[1:], end_id).astype(np.uint32))
                held_docs.append(doc_ids[a:b])
                held_sizes.append(np.diff(begin) + 1)
                if sum(map(len, held_ids)) >= FILE_IDS:
                    yield flush()
        if held_ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(spread(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return rows.mapInArrow(run, "part int, number int, file string, n_docs long, n_ids long")


def read_tokens(files: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of files (part, number, file, n_ids), read back in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for doc, start, ids in PackedFile(file).documents():
                    rows.append((doc, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                cols = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
                known = pa.array(np.array([r[0] for r in rows]) == NO_ID)
                yield pa.RecordBatch.from_arrays([pa.compute.if_else(known, pa.scalar(None, pa.int64()), cols[0]), *cols[1:]], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row a file: the running sum is over the files, not over documents.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return placed.repartition(spread(files.sparkSession)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids into files and read them back."""
    folder = f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    where, path = store(folder)
    where.create_dir(path)
    return read_tokens(cut(write_tokens(table(spark, sf_dir, "documents"), folder)))
