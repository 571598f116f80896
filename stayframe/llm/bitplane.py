"""Token ids in files of compressed byte or bit planes.

A file holds documents in ascending order as one run of unsigned 32-bit ids.
The run is cut into blocks of fixed size; a block is transposed into planes
(4 of bytes or 32 of bits), each plane is compressed by itself, and the
file's index says where every plane lies.

Layout (all integers little-endian):

    8 bytes   magic "BITPLN01"
    planes    zstandard frames, block after block, lowest plane first
    documents zstandard frame: int64 doc_id, int64 ids, uint8 null flag of each document
    index     for each block: int64 offset, uint32 ids, uint32 crc32 of its ids, uint32 bytes of each plane
    footer    int64 offset of documents, offset of index, documents, ids, blocks; uint32 planes, block size
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, shared_path, stage, text_of
from .tokens import WIDE_MEMO_BYTES, default_path, piece_encoder

MAGIC, FOOTER = b"BITPLN01", struct.Struct("<qqqqqII")
BLOCK_IDS, END_ID = 1 << 16, 1
PLANES = {"byte": 4, "bit": 32}
_MANIFEST = "part int, file string, n_docs long, n_ids long"


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Transpose a block of ids: plane k holds byte (or bit) k of each id."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [octets[:, k].tobytes() for k in range(4)]
    return [np.packbits(octets[:, k // 8] >> (k % 8) & 1).tobytes() for k in range(32)]


def from_planes(raw: list[bytes], n: int) -> np.ndarray:
    octets = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(raw):
        if len(raw) == 4:
            octets[:, k] = np.frombuffer(plane, np.uint8)
        else:
            octets[:, k // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << (k % 8)
    return octets.reshape(-1).view("<u4")


class PlaneWriter:
    """Append documents; holds one block of ids and the documents' lengths."""

    def __init__(self, sink, planes: int, block_ids: int):
        self.sink, self.planes, self.block_ids = sink, planes, block_ids
        self.pack = zstandard.ZstdCompressor(level=3)
        self.held: list[bytes] = []
        self.n_held = self.n_ids = 0
        self.docs: list[tuple[int, int, bool]] = []
        self.index: list[bytes] = []
        self.at = sink.write(MAGIC)

    def append(self, doc_id, ids: bytes) -> None:
        self.docs.append((doc_id or 0, len(ids) // 4, doc_id is None))
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= self.block_ids:
            run = b"".join(self.held)
            full = self.n_held // self.block_ids * self.block_ids
            for k in range(0, full, self.block_ids):
                self._block(run[4 * k:4 * (k + self.block_ids)])
            self.held, self.n_held = [run[4 * full:]], self.n_held - full

    def _block(self, raw: bytes) -> None:
        parts = [self.pack.compress(p) for p in to_planes(np.frombuffer(raw, "<u4"), self.planes)]
        self.index.append(struct.pack(f"<qII{self.planes}I", self.at, len(raw) // 4, zlib.crc32(raw), *map(len, parts)))
        self.sink.write(b"".join(parts))
        self.at += sum(map(len, parts))
        self.n_ids += len(raw) // 4

    def close(self) -> None:
        if self.n_held:
            self._block(b"".join(self.held))
        keys = np.array([d[0] for d in self.docs], "<i8").tobytes()
        sizes = np.array([d[1] for d in self.docs], "<i8").tobytes()
        nulls = np.array([d[2] for d in self.docs], np.uint8).tobytes()
        docs, index = self.pack.compress(keys + sizes + nulls), b"".join(self.index)
        self.sink.write(docs + index + FOOTER.pack(
            self.at, self.at + len(docs), len(self.docs), self.n_ids, len(self.index), self.planes, self.block_ids))


def read_file(source):
    """Yield (doc_id or None, ids as bytes) of one open file, block by block."""
    size = source.size()
    source.seek(size - FOOTER.size)
    docs_at, index_at, n_docs, _, n_blocks, planes, _ = FOOTER.unpack(source.read(FOOTER.size))
    source.seek(0)
    if source.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a plane file")
    unpack = zstandard.ZstdDecompressor()
    source.seek(docs_at)
    raw = unpack.decompress(source.read(index_at - docs_at))
    keys, sizes = np.frombuffer(raw[:8 * n_docs], "<i8").tolist(), np.frombuffer(raw[8 * n_docs:16 * n_docs], "<i8").tolist()
    nulls = raw[16 * n_docs:]
    entry = struct.Struct(f"<qII{planes}I")
    index = source.read(n_blocks * entry.size)
    held, block = bytearray(), 0
    for key, n, null in zip(keys, sizes, nulls):
        while len(held) < 4 * n:
            at, n_ids, crc, *parts = entry.unpack_from(index, block * entry.size)
            source.seek(at)
            ids = from_planes([unpack.decompress(source.read(p)) for p in parts], n_ids).tobytes()
            if zlib.crc32(ids) != crc:
                raise ValueError(f"block {block} is damaged")
            held += ids
            block += 1
        yield None if null else key, bytes(held[:4 * n])
        del held[:4 * n]


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = END_ID,
              planes: str = "byte", block_ids: int = BLOCK_IDS, files: int | None = None) -> DataFrame:
    """Encode every row of ``docs`` (doc_id, text), append ``end_id`` and write
    the ids in ascending doc_id (null first; ties by their ids) to plane
    files under ``folder``. Returns the manifest: part, file, n_docs, n_ids.

    Documents go to ``files`` ranges of doc_id with equal counts, so one
    shuffle of compressed ids orders them all. A task writes under a name of
    its own and reports it; a task that runs twice leaves a file that no
    manifest names. A null text is the end id alone, repeated rows are
    written each, an empty table gives an empty manifest.
    """
    path, n_planes = tokenizer_path or default_path(), PLANES[planes]
    end = int(end_id).to_bytes(4, "little")
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    files = files or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / files for k in range(1, files)] or [0.5], 10 * files)).first()[0] or []
    bounds = np.unique(np.array(cuts if files > 1 else [], np.int64))

    def encode(batches):
        encoder, pack = piece_encoder(path, WIDE_MEMO_BYTES), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            keys, blobs = batch.column(0).to_pylist(), []
            for text in batch.column(1):
                ids = np.frombuffer(encoder.encode(text.as_py()) + end, "<u4")
                narrow = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                blobs.append(bytes([narrow.itemsize]) + pack.compress(narrow.tobytes()))
            parts = [0 if k is None else int(np.searchsorted(bounds, k, "left")) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())],
                names=["part", "doc_id", "blob"])

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        unpack, made = zstandard.ZstdDecompressor(), []
        writer = sink = None
        for batch in batches:
            for part, key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if not made or made[-1][0] != part:
                    if writer:
                        writer.close()
                        sink.close()
                    name = f"part-{part:06d}-{task.taskAttemptId()}.bitplane"
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}")
                    writer = PlaneWriter(sink, n_planes, block_ids)
                    made.append([part, name, writer])
                raw = blob.as_py()
                ids = np.frombuffer(unpack.decompress(raw[1:]), "<u2" if raw[0] == 2 else "<u4").astype("<u4")
                writer.append(key, ids.tobytes())
        if writer:
            writer.close()
            sink.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.string()),
             pa.array([len(m[2].docs) for m in made], pa.int64()), pa.array([m[2].n_ids for m in made], pa.int64())],
            names=["part", "file", "n_docs", "n_ids"])

    encoded = rows.mapInArrow(frugal(encode), "part int, doc_id long, blob binary")
    ordered = encoded.repartitionById(files, F.col("part")).sortWithinPartitions("part", "doc_id", "blob")
    return stage(ordered.mapInArrow(frugal(write), _MANIFEST), "manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the files of a manifest back: doc_id, start (ids of all documents
    before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    before = F.sum("n_ids").over(Window.orderBy("part", "file")) - F.col("n_ids")
    files = manifest.select("part", "file", before.alias("before"))

    def read(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out, held = [], 0
                with fs.open_input_file(f"{root}/{name}") as source:
                    for key, ids in read_file(source):
                        out.append((key, start, len(ids) // 4, ids))
                        start += len(ids) // 4
                        held += len(ids)
                        if held > 1 << 23:
                            yield _documents(out)
                            out, held = [], 0
                if out:
                    yield _documents(out)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartitionById(n, F.pmod("part", F.lit(n))).mapInArrow(frugal(read), "doc_id long, start long, n_tokens long, ids binary")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids"])


def ids_folder(docs: DataFrame) -> str:
    return shared_path(docs.sparkSession, "ids")
