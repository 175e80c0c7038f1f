"""Operator 5: token ids in fixed-width bit-packed blocks.

A file is a run of blocks in ascending doc_id order. A block holds whole documents; each id
takes the fewest bits that hold every id of the vocabulary, least significant bit first, so
numpy unpacks any stretch of ids without a loop and a reader may start at any id:

    magic "LXTB" | u16 version | u16 bits | u32 documents | u64 ids | u64 first id of the
    block in its file | i64 doc_id each | u8 doc_id is null each | u64 end of each document
    in the block's ids | payload

Blocks are the cells of Parquet rows (file, block, first, ids, data), so every store that Spark
can write and read holds them; `write_file` and `read_file` handle the same bytes as plain files.

Nulls: a null text is an empty text; null doc_ids come first and are kept. Rows with equal
doc_ids stay separate, ordered by text. Empty tables give files without blocks. Further columns
are ignored. A text of any length is one document of one block.
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

from lexstrata.llm.kernels import batches, blocks
from lexstrata.llm.shared import only, partitions, stored

HEAD = struct.Struct("<4sHHIQQ")
MAGIC, VERSION = b"LXTB", 1
BLOCK_IDS, BLOCK_DOCS = 1 << 19, 4096


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids in `bits` bits each, least significant bit first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(each.ravel(), bitorder="little").tobytes()


def unpack(data, bits: int, start: int, count: int) -> np.ndarray:
    """Ids start to start + count of a payload, reading only their bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count, start * bits // 8).astype(np.uint32)
    low, high = start * bits // 8, -(-(start + count) * bits // 8)
    flat = np.unpackbits(np.frombuffer(data, np.uint8, high - low, low), bitorder="little")
    flat = flat[start * bits - 8 * low :][: count * bits].reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


class Block:
    """A view of one block's bytes."""

    def __init__(self, data):
        self.data = memoryview(data)
        magic, version, self.bits, self.docs, self.ids, self.first = HEAD.unpack_from(self.data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token block")
        at = HEAD.size
        self.doc_ids = np.frombuffer(self.data, "<i8", self.docs, at)
        self.null = np.frombuffer(self.data, np.uint8, self.docs, at := at + 8 * self.docs)
        self.ends = np.frombuffer(self.data, "<u8", self.docs, at := at + self.docs).astype(np.int64)
        self.payload = self.data[at + 8 * self.docs :]

    def read(self, start: int = 0, count: int | None = None) -> np.ndarray:
        return unpack(self.payload, self.bits, start, self.ids - start if count is None else count)

    def document(self, k: int) -> np.ndarray:
        low = int(self.ends[k - 1]) if k else 0
        return self.read(low, int(self.ends[k]) - low)


def make_block(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int, first: int) -> bytes:
    null = np.array([d is None for d in doc_ids], np.uint8)
    own = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = HEAD.pack(MAGIC, VERSION, bits, len(doc_ids), len(ids), first)
    return head + own.tobytes() + null.tobytes() + np.cumsum(counts).astype("<u8").tobytes() + pack(ids, bits)


FILES = "file int, block int, first long, ids long, data binary"
ROWS = "file int, doc_id long, start long, n_tokens long, ids_crc32 long"


def write_blocks(encoder, end_id: int | None, bits: int):
    """mapInArrow function: sorted (doc_id, text) of one partition to the blocks of one file.

    encoder() gives a function of (bytes, offsets) to (ids, ids in each row).
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        schema = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("ids", pa.int64()), ("data", pa.binary())])
        file, number, first = TaskContext.get().partitionId(), 0, 0
        docs, counts, ids = [], [], []

        def flush():
            nonlocal number, first, docs, counts, ids
            flat, each = np.concatenate(ids), np.concatenate(counts)
            out = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((file, number, first, len(flat), make_block(docs, each, flat, bits, first)), schema.types, strict=True)], schema=schema)
            number, first, docs, counts, ids = number + 1, first + len(flat), [], [], []
            return out

        for part in parts:
            own = part.column(0).to_pylist()
            for lo, hi, data, offs in blocks(part.column(1), 1 << 20):
                flat, count = encode(data, offs)
                if end_id is not None:
                    flat = np.insert(flat, np.cumsum(count), np.uint32(end_id))
                    count = count + 1
                docs += own[lo:hi]
                counts.append(count)
                ids.append(flat)
                if len(docs) >= BLOCK_DOCS or sum(map(len, ids)) >= BLOCK_IDS:
                    yield flush()
        if docs:
            yield flush()

    return run


def read_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: blocks to a row for each document, with its start in the file."""
    schema = pa.schema([("file", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for part in parts:
        for file, data in zip(part.column(0).to_pylist(), part.column(1), strict=True):
            b = Block(data.as_buffer())
            raw = memoryview(b.read().astype("<u4").tobytes())
            start = np.concatenate([[0], b.ends[:-1]])
            crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(start.tolist(), b.ends.tolist(), strict=True)]
            yield from batches(schema, [pa.array([file] * b.docs, pa.int32()), pa.array(b.doc_ids, pa.int64(), mask=b.null.astype(bool)), start + b.first, b.ends - start, crc])


def token_files(docs: DataFrame, encoder, bits: int, end_id: int | None = None) -> DataFrame:
    """Writes all texts as token files in the shared folder; returns them (FILES)."""
    docs = only(docs, "doc_id", "text")
    ordered = docs.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write_blocks(encoder, end_id, bits), FILES), "token_files")


def token_rows(files: DataFrame) -> DataFrame:
    """Reads token files: doc_id, start over all files, n_tokens, ids_crc32."""
    sums = files.groupBy("file").agg(F.sum("ids").alias("ids"))  # a row for each file
    before = sums.select("file", (F.sum("ids").over(Window.orderBy("file")) - F.col("ids")).alias("before"))
    rows = files.select("file", "data").mapInArrow(read_rows, ROWS)
    return rows.join(before, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def write_file(path: str, found: list[bytes]) -> None:
    """Blocks as one plain file, with a table of block places at its end."""
    with open(path, "wb") as f:
        places = []
        for b in found:
            places.append(f.tell())
            f.write(b)
        places.append(f.tell())
        f.write(np.array(places, "<u8").tobytes() + struct.pack("<Q", len(found)))


def read_file(path: str) -> list[Block]:
    """Blocks of a plain file, mapped rather than loaded."""
    data = np.memmap(path, np.uint8, "r")
    n = int(data[-8:].view("<u8")[0])
    places = np.frombuffer(data[-8 - 8 * (n + 1) : -8].tobytes(), "<u8").astype(int)
    return [Block(data[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)]


def library_encoder(path: str):
    """encoder() for token_files over a tokenizers file whose texts split at ASCII white space."""

    def make():
        from lexstrata.llm.token_cache import shared_cache

        return shared_cache(path).encode

    return make
