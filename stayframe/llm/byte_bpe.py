"""Byte-level BPE ids of whole texts, long ones in overlapping chunks.

The pre-token pattern only looks ahead, and at most a few characters beyond
a match. So two runs that start at different places of one text agree from
the first boundary they share: there they resynchronise. A long text is cut
into chunks that overlap; all chunks are pre-tokenised in parallel, and
neighbours are stitched at the first boundary both found in the overlap.
Pre-tokens are then encoded each by itself.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import frugal, stage, text_of

#: Code points of a chunk, of the overlap with the next one, and those before
#: the end of a run in which its boundaries may still be wrong.
CHUNK, OVERLAP, MARGIN = 1 << 15, 1 << 9, 4
#: Bytes of keys in a worker's memo before it starts afresh, and the longest piece kept.
MEMO_BYTES, MEMO_CHARS = 8 << 20, 48
OUT_BYTES = 4 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class ByteBpe:
    """Ids of pre-tokens (memoised) and bytes of ids."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def _piece(self, piece: str) -> bytes:
        ids = np.array(self.merges.encode_ordinary(piece), "<u4").tobytes()
        if len(piece) <= MEMO_CHARS:
            if self.held > MEMO_BYTES:
                self.memo.clear()
                self.held = 0
            self.memo[piece] = ids
            self.held += len(piece) + len(ids)
        return ids

    def encode_pieces(self, pieces: list[str]) -> bytes:
        """Ids of pre-tokens as little-endian unsigned 32-bit integers."""
        get, make = self.memo.get, self._piece
        return b"".join([get(p) or make(p) for p in pieces])

    def encode(self, text: str) -> bytes:
        return self.encode_pieces(self.pieces(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One for each Python worker, vocabulary and pattern."""
    return ByteBpe(path, pattern)


def edge_boundaries(pieces: list[str], size: int, overlap: int, first: bool, last: bool) -> tuple[list[int], list[int]]:
    """Pre-token boundaries (offsets in the chunk) near both ends of a chunk:
    those in the overlap with the chunk before it, and those in the overlap
    with the next, less the margin in which the cut may have moved them."""
    ends = np.cumsum([0, *map(len, pieces)])
    left = [] if first else ends[ends <= overlap].tolist()
    right = [] if last else ends[(ends >= size - overlap) & (ends <= size - MARGIN)].tolist()
    return left, right


def _chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """doc, k, n (chunks of the document), at (code points before it), part:
    text from ``at``, ``chunk`` code points and the overlap."""
    def cut(batches):
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                n = -(-len(text) // chunk)
                for k in range(0, n, 16):
                    own = range(k, min(k + 16, n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc] * len(own), pa.string()), pa.array(list(own), pa.int64()), pa.array([n] * len(own), pa.int64()),
                         pa.array([text[i * chunk:(i + 1) * chunk + overlap] for i in own], pa.string())], names=["doc", "k", "n", "part"])

    return rows.mapInArrow(frugal(cut), "doc string, k long, n long, part string")


def _edges(chunks: DataFrame, chunk: int, overlap: int, path: str, pattern: str) -> DataFrame:
    """doc, k, left and right boundaries by their place in the document."""
    def find(batches):
        coder = byte_bpe(path, pattern)
        for batch in batches:
            doc, ks, lefts, rights = batch.column(0), batch.column(1).to_pylist(), [], []
            for k, n, part in zip(ks, batch.column(2).to_pylist(), batch.column(3)):
                text = part.as_py()
                left, right = edge_boundaries(coder.pieces(text), len(text), overlap, k == 0, k == n - 1)
                lefts.append([k * chunk + b for b in left])
                rights.append([k * chunk + b for b in right])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([doc, pa.array(ks, pa.int64()), pa.array(lefts, kind), pa.array(rights, kind)],
                                             names=["doc", "k", "left", "right"])

    return chunks.mapInArrow(frugal(find), "doc string, k long, left array<long>, right array<long>")


def _stitched(edges: DataFrame) -> DataFrame:
    """doc, k, start: where the chunk's own pre-tokens begin (the first boundary
    that it shares with the chunk before it), stop: where the next one's do;
    loose: a chunk at or before it shares none with its predecessor, so its
    boundaries are not certain; open: the next chunk is loose (null stop)."""
    by = Window.partitionBy("doc").orderBy("k")
    met = edges.select("doc", "k", F.when(F.col("k") == 0, F.lit(0)).otherwise(
        F.array_min(F.array_intersect("left", F.lag("right").over(by)))).cast("long").alias("start"))
    sure = met.select("doc", "k", "start", F.max(F.col("start").isNull()).over(by).alias("loose"))
    return sure.select("doc", "k", "start", "loose", F.lead("start").over(by).alias("stop"), F.coalesce(F.lead("loose").over(by), F.lit(False)).alias("open"))


def _encode_chunks(chunks: DataFrame, spans: DataFrame, chunk: int, path: str, pattern: str) -> DataFrame:
    """doc, k, ids of the chunk's own pre-tokens; or text, where they are not
    certain: the rest of the document then goes as one run."""
    def encode(batches):
        coder, pack = byte_bpe(path, pattern), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, texts = [], []
            for k, part, start, stop, loose, open_ in zip(*(batch.column(c).to_pylist() for c in ("k", "part", "start", "stop", "loose", "open"))):
                if loose or open_:
                    ids.append(None)
                    texts.append(part[0 if loose else start - k * chunk:chunk])
                    continue
                pieces = coder.pieces(part[start - k * chunk:])
                if stop is not None:
                    ends = np.cumsum([*map(len, pieces)]) + start
                    pieces = pieces[:int(np.searchsorted(ends, stop, "right"))]
                ids.append(pack.compress(coder.encode_pieces(pieces)))
                texts.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                                             names=["doc", "k", "ids", "text"])

    joined = chunks.join(spans, ["doc", "k"]).select("doc", "k", "part", "start", "stop", "loose", "open")
    return joined.mapInArrow(frugal(encode), "doc string, k long, ids binary, text string")


def _encode_long(rows: DataFrame, chunk: int, overlap: int, path: str, pattern: str) -> DataFrame:
    """doc, ids of texts longer than a chunk (doc is unique)."""
    cut = _chunks(rows, chunk, overlap)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = stage(cut.repartition(n, "doc", "k"), "bpe-chunks")
    spans = stage(_stitched(_edges(chunks, chunk, overlap, path, pattern)), "bpe-spans")

    def assemble(batches):
        coder, unpack = byte_bpe(path, pattern), zstandard.ZstdDecompressor()
        parts = ((doc, ids, text) for b in batches for doc, ids, text in zip(b.column(0).to_pylist(), b.column(2), b.column(3)))
        for doc, own in groupby(parts, key=lambda p: p[0]):
            out, rest = [], []
            for _, ids, text in own:
                if ids.is_valid:
                    out.append(unpack.decompress(ids.as_py()))
                else:
                    rest.append(text.as_py())
            out.append(coder.encode("".join(rest)))
            yield pa.RecordBatch.from_arrays([pa.array([doc], pa.string()), pa.array([b"".join(out)], pa.binary())], names=["doc", "ids"])

    parts = _encode_chunks(chunks, spans, chunk, path, pattern)
    return parts.repartition(n, "doc").sortWithinPartitions("doc", "k").mapInArrow(frugal(assemble), "doc string, ids binary")


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, chunk: int = CHUNK,
                     overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of every row of
    ``docs`` (doc_id, text), as the library's ``encode_ordinary`` gives them
    for the whole text.

    A null text counts as empty and has no ids; every row is encoded, repeated
    ones each; doc_id may be null or repeat; other columns are not read. An
    empty table gives no rows. Texts longer than ``chunk`` code points are
    encoded in chunks, equal ones once, and joined to their rows by digest.
    Where two neighbouring chunks share no boundary in the overlap (a
    pre-token longer than it), the document's rest goes in one run, so the
    ids are exact for every text.
    """
    if not 2 * MARGIN < overlap <= chunk:
        raise ValueError("overlap must be above twice the margin and at most a chunk")
    path, pattern = path or default_path(), pattern or default_pattern()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def whole(batches):
        coder = byte_bpe(path, pattern)
        for batch in batches:
            keys, out, held, at = batch.column(0), [], 0, 0
            for i, text in enumerate(batch.column(1)):
                out.append(coder.encode(text.as_py()))
                held += len(out[-1])
                if held > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([keys.slice(at, len(out)), pa.array(out, pa.binary())], names=["doc_id", "ids"])
                    out, held, at = [], 0, i + 1
            yield pa.RecordBatch.from_arrays([keys.slice(at, len(out)), pa.array(out, pa.binary())], names=["doc_id", "ids"])

    long = F.length("text") > chunk
    short = rows.filter(~long).mapInArrow(frugal(whole), "doc_id long, ids binary")
    many = rows.filter(long).withColumn("doc", F.sha2("text", 256))
    distinct = many.groupBy("doc").agg(F.first("text").alias("text"))
    made = _encode_long(distinct, chunk, overlap, path, pattern)
    return short.unionByName(many.select("doc_id", "doc").join(made, "doc").select("doc_id", "ids"))


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Add ``decoded``: the bytes of every row's ``ids`` one after another.
    Null ids stay null."""
    path, pattern = path or default_path(), pattern or default_pattern()
    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])
    at = encoded.columns.index("ids")

    def decode(batches):
        coder = byte_bpe(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                raw = pa.array([coder.decode(x.as_py()) if x.is_valid else None for x in part.column(at)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, raw], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(frugal(decode), schema)
