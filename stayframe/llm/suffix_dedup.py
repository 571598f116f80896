"""Removal of byte strings that repeat across documents, by suffix sorting.

Every string of ``LENGTH`` bytes has one anchor: the 26 bytes inside it with
the least hash. Equal strings have equal anchors, so strings meet by anchor:

1. documents are gathered into chunks, compressed and staged;
2. each chunk sends the hashes of its anchors, once each; those that no other
   document has are dropped, the rest go back to their chunks;
3. each chunk sends, for every anchor left, the slices of text that hold the
   strings of that anchor, once each with the least doc_id; the suffixes of
   the slices of a bucket are ordered by deep-shallow sorting, equal strings
   lie side by side, and the least doc_id of each goes back;
4. each chunk marks the bytes that a smaller doc_id already has.

A group of copies or a common passage sends at most one entry from a chunk,
so hot groups are reduced before any shuffle.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blobs import pack, unpack
from .common import frugal, quoted, release, stage, text_of
from .suffix_sort import sort_suffixes

LENGTH, GRAM = 50, 26
#: Bytes of text in a chunk (a longer document is a chunk by itself) and in a step of hashing.
CHUNK_BYTES, STEP_BYTES = 2 << 20, 1 << 20
NO_ID = np.iinfo(np.int64).max  # a missing doc_id comes after all others

_FACTOR = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)

def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2^64."""
    tables = []
    for factor in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        table = np.full(n, factor, np.uint64)
        table[0] = 1
        tables.append(np.cumprod(table, dtype=np.uint64))
    return tables[0], tables[1]


def _window_hashes(buffer: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each position on."""
    powers, inverse = _power_tables(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTES[buffer] * powers, out=sums[1:])
    h = (sums[width:] - sums[:-width]) * inverse[:len(buffer) - width + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def anchors(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of strings with one anchor: (hash of the anchor, first start, last
    start). Strings lie inside one document [start, end)."""
    out = []
    for at in range(0, len(buffer), STEP_BYTES):
        part = buffer[at:at + STEP_BYTES + length - 1]
        if len(part) < length:
            break
        h = _window_hashes(part, gram)
        low = (h >> np.uint64(32)).astype(np.uint32)
        where = np.arange(len(low), dtype=np.int32)
        width, need = 1, length - gram + 1
        while width < need:  # the place of the least hash of the next ``width`` grams, leftmost if tied
            step = min(width, need - width)
            take = low[step:] < low[:-step]
            where = np.where(take, where[step:], where[:-step])
            low = np.where(take, low[step:], low[:-step])
            width += step
        inside = np.zeros(len(part) + 1, np.int32)
        s, e = np.maximum(starts - at, 0), np.minimum(ends - at, len(part)) - length + 1
        fits = e > s
        np.add.at(inside, s[fits], 1)
        np.add.at(inside, e[fits], -1)
        p = np.flatnonzero(np.cumsum(inside[:min(len(low), STEP_BYTES)]) > 0)
        anchor = where[p]
        first = np.ones(len(p), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)
        f = np.flatnonzero(first)
        out.append((h[anchor[f]], p[f] + at, p[np.append(f[1:], len(p)) - 1] + at))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


# -- blobs ------------------------------------------------------------------

def _five_bytes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).reshape(-1)


def _from_five(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = raw.reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def _rows(names: dict, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, names.values())], names=list(names))


_MESSAGE = {"bucket": pa.int32(), "chunk": pa.int64(), "kind": pa.int32(), "blob": pa.binary()}
_MESSAGE_SCHEMA = "bucket int, chunk long, kind int, blob binary"
_CHUNK_SCHEMA = "chunk long, kind int, blob binary, others binary"
_HELD, _ANSWER, _OWN = 0, 1, 2  # a chunk's texts; what a bucket answers it; what it told itself


def _messages(batches):
    """(bucket, chunk, kind, blob) of all rows of a partition."""
    for batch in batches:
        yield from zip(*(batch.column(k).to_pylist() for k in range(4)))


def _by_chunk(batches, others: bool):
    """Rows (part, chunk, kind, blob, file) in order; the first of a part names
    the file with its chunks. Yields each chunk, its texts, its other columns
    (if asked for) and {kind: [blobs]} of what it was told."""
    rows = (r for batch in batches for r in zip(*(batch.column(k).to_pylist() for k in range(5))))
    for _, own in groupby(rows, key=lambda r: r[0]):
        file = next(own)[4]
        told = groupby(own, key=lambda r: r[1])
        now = next(told, None)
        fs, path = pafs.FileSystem.from_uri(file)
        with fs.open_input_file(path) as source:
            columns = ["chunk", "blob", "others"] if others else ["chunk", "blob"]
            for batch in pq.ParquetFile(source).iter_batches(1, columns=columns):
                chunk, blob = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
                answers: dict[int, list[bytes]] = {}
                if now and now[0] == chunk:
                    for r in now[1]:
                        answers.setdefault(r[2], []).append(r[3])
                    now = next(told, None)
                yield chunk, blob, batch.column(2)[0].as_py() if others else None, answers


def _bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    return ends - sizes, ends


# -- 1. chunks --------------------------------------------------------------

def _chunks(docs: DataFrame, keep: list[str]) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"),
                       F.struct(F.lit(0).alias("_"), *[F.col(quoted(c)) for c in keep]).alias("row"))

    def gather(batches):
        made = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            sizes = np.array([len(t.as_buffer() or b"") for t in texts], np.int64) if len(texts) else np.zeros(0, np.int64)
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            first = 0
            while first < len(sizes):
                upto = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), CHUNK_BYTES, "right")))
                body = b"".join(texts.slice(first, upto - first).to_pylist())
                part = pa.RecordBatch.from_arrays([batch.column(2).slice(first, upto - first)], names=["row"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(part)
                chunk = (TaskContext.get().partitionId() << 32) + made
                yield _rows({"chunk": pa.int64(), "kind": pa.int32(), "blob": pa.binary(), "others": pa.binary()}, [
                    (chunk, _HELD, pack(ids[first:upto], sizes[first:upto], np.frombuffer(body, np.uint8)), sink.getvalue().to_pybytes())])
                first, made = upto, made + 1

    return rows.mapInArrow(frugal(gather), _CHUNK_SCHEMA)


def _with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """What the chunks of one file were answered, in one task behind the name of
    the file: the chunks themselves are not sent, the task opens them."""
    part = F.shiftright("chunk", 32).alias("part")
    none = F.lit(None).cast("long")
    files = chunks.select(part, F.input_file_name().alias("file")).distinct()
    held = files.select("part", none.alias("chunk"), F.lit(_HELD).alias("kind"), F.lit(None).cast("binary").alias("blob"), "file")
    told = answers.select(part, "chunk", "kind", "blob", F.lit(None).cast("string").alias("file"))
    return held.union(told).repartition(F.col("part")).sortWithinPartitions("part", F.col("chunk").asc_nulls_first(), "kind")


# -- 2. anchors that several documents have -----------------------------------

def _hashes_of(blob: bytes, length: int, gram: int, buckets: int):
    ids, sizes, buffer = unpack(blob, "<i8", "<i8", np.uint8)
    starts, ends = _bounds(sizes)
    h, low, high = anchors(buffer, starts, ends, length, gram)
    bucket = (h >> np.uint64(40)) % np.uint64(buckets)
    rest = h & np.uint64((1 << 40) - 1)
    return ids, buffer, ends, bucket.astype(np.int64), rest, low, high


def _send_hashes(length, gram, buckets):
    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, _, ends, bucket, rest, low, _ = _hashes_of(blob, length, gram, buckets)
                if not len(low):  # every document is shorter than a string
                    continue
                doc = np.searchsorted(ends, low, "right")
                by = np.lexsort((ids[doc], rest, bucket))
                bucket, rest, doc_id = bucket[by], rest[by], ids[doc][by]
                first = np.ones(len(by), bool)
                first[1:] = (bucket[1:] != bucket[:-1]) | (rest[1:] != rest[:-1])
                f = np.flatnonzero(first)
                last = np.append(f[1:], len(by)) - 1
                several = doc_id[f] != doc_id[last]
                cuts = np.flatnonzero(np.diff(bucket[f], prepend=-1, append=-1)).tolist()
                yield _rows(_MESSAGE, [
                    (int(bucket[f[a]]), chunk, _ANSWER, len(f[a:b]).to_bytes(8, "little") + _five_bytes(rest[f[a:b]]).tobytes() + np.packbits(several[a:b]).tobytes())
                    for a, b in zip(cuts, cuts[1:])])

    return run


def _answer_hashes(batches):
    """Of each bucket: the hashes that two chunks have, or one chunk in
    several documents, to every chunk that sent them."""
    held: dict[int, list] = {}
    for bucket, chunk, _, blob in _messages(batches):
        n = int.from_bytes(blob[:8], "little")
        held.setdefault(bucket, []).append((chunk, _from_five(np.frombuffer(blob, np.uint8, 5 * n, 8)),
                                            np.unpackbits(np.frombuffer(blob, np.uint8, offset=8 + 5 * n), count=n).astype(bool)))
    for bucket, sent in held.items():
        rest = np.concatenate([s[1] for s in sent])
        several = np.concatenate([s[2] for s in sent])
        order = np.argsort(rest, kind="stable")
        ordered = rest[order]
        shared = several[order]
        shared[1:] |= ordered[1:] == ordered[:-1]
        shared[:-1] |= ordered[1:] == ordered[:-1]
        back = np.empty(len(order), bool)
        back[order] = shared
        at, out = 0, []
        for chunk, own, _ in sent:
            mine = own[back[at:at + len(own)]]
            at += len(own)
            if len(mine):
                out.append((bucket, chunk, _ANSWER, bucket.to_bytes(8, "little") + _five_bytes(mine).tobytes()))
        yield _rows(_MESSAGE, out)


# -- 3. the strings of those anchors ------------------------------------------

def _send_slices(length, gram, buckets):
    def run(batches):
        for chunk, blob, _, told in _by_chunk(batches, False):
            if _ANSWER not in told:
                continue
            ids, buffer, ends, bucket, rest, low, high = _hashes_of(blob, length, gram, buckets)
            known = np.sort(np.concatenate([np.uint64(int.from_bytes(t[:8], "little") << 40) | _from_five(np.frombuffer(t, np.uint8, offset=8)) for t in told[_ANSWER]]))
            key = bucket.astype(np.uint64) << np.uint64(40) | rest
            found = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
            bucket, low, n = bucket[found], low[found], (high - low)[found] + 1
            doc = np.searchsorted(ends, low, "right")
            # equal slices of the chunk are sent once, with the least doc_id
            size = n + length - 1
            body, offset = _gather(buffer, low, size)
            digest = _slice_digests(body, offset, size)
            by = np.lexsort((ids[doc], digest, size, bucket))
            new = np.ones(len(by), bool)
            new[1:] = (bucket[by][1:] != bucket[by][:-1]) | (size[by][1:] != size[by][:-1]) | (digest[by][1:] != digest[by][:-1])
            pair = np.flatnonzero(~new)
            new[pair] |= ~_same_bytes(buffer, low[by[pair]], low[by[pair - 1]], size[by[pair]])
            number = np.cumsum(new) - 1
            f = by[new]
            out = []
            cuts = np.flatnonzero(np.diff(bucket[f], prepend=-1, append=-1)).tolist()
            for a, b in zip(cuts, cuts[1:]):
                part = f[a:b]
                out.append((int(bucket[part[0]]), chunk, _ANSWER, pack(
                    np.arange(a, b, dtype="<i4"), size[part].astype("<i4"), ids[doc[part]], _gather(buffer, low[part], size[part])[0])))
            own = np.empty(len(by), "<i4")
            own[by] = number
            out.append((int(chunk % buckets), chunk, _OWN, pack(low.astype("<i8"), n.astype("<i4"), own, ids[doc[f]])))
            yield _rows(_MESSAGE, out)

    return run


def _gather(buffer, low, size):
    """The bytes of slices one after another, and where each begins."""
    begin, ends = _bounds(size)
    index = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(begin - low, size)
    return buffer[index], begin


def _slice_digests(body, begin, size):
    if not len(size):
        return np.zeros(0, np.uint64)
    place = np.arange(len(body)) - np.repeat(begin, size)
    powers, _ = _power_tables(max(int(size.max()), 1))
    return np.add.reduceat(_BYTES[body] * powers[place], begin)


def _same_bytes(buffer, a, b, size):
    if not len(a):
        return np.zeros(0, bool)
    x, begin = _gather(buffer, a, size)
    return ~np.logical_or.reduceat(x != _gather(buffer, b, size)[0], begin)


def _answer_slices(length):
    """Of each bucket: order the strings of all slices; to each slice, the
    least doc_id of those of its strings that a smaller document has."""
    def run(batches):
        held: dict[int, list] = {}
        for bucket, chunk, kind, blob in _messages(batches):
            if kind == _OWN:
                yield _rows(_MESSAGE, [(bucket, chunk, kind, blob)])
            else:
                held.setdefault(bucket, []).append((chunk, *unpack(blob, "<i4", "<i4", "<i8", np.uint8)))
        for bucket, sent in held.items():
            size = np.concatenate([s[2] for s in sent]).astype(np.int64)
            doc_id = np.concatenate([s[3] for s in sent])
            body = np.concatenate([s[4] for s in sent])
            begin, _ = _bounds(size)
            # equal slices of several chunks are sorted once
            digest = _slice_digests(body, begin, size)
            by = np.lexsort((digest, size))
            new = np.ones(len(by), bool)
            new[1:] = (size[by][1:] != size[by][:-1]) | (digest[by][1:] != digest[by][:-1])
            pair = np.flatnonzero(~new)
            new[pair] |= ~_same_bytes(body, begin[by[pair]], begin[by[pair - 1]], size[by[pair]])
            f = np.flatnonzero(new)
            least = np.minimum.reduceat(doc_id[by], f)
            number = np.empty(len(by), np.int64)
            number[by] = np.cumsum(new) - 1
            n = size[by[f]] - length + 1
            first, _ = _bounds(n)
            starts = np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(begin[by[f]], n)
            order, group = sort_suffixes(body, starts, length)
            heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            lowest = np.minimum.reduceat(np.repeat(least, n)[order], heads)
            of = np.empty(len(order), np.int64)
            of[order] = np.repeat(lowest, np.diff(np.append(heads, len(order))))
            at, out = 0, []
            for chunk, own, own_size, own_id, _ in sent:
                mine = number[at:at + len(own)]
                at += len(own)
                count = n[mine]
                begins, _ = _bounds(count)
                place = np.arange(int(count.sum())) - np.repeat(begins, count)
                ids = of[np.repeat(first[mine], count) + place]
                smaller = ids < np.repeat(own_id, count)
                if smaller.any():
                    out.append((bucket, chunk, _ANSWER, pack(np.repeat(own, count)[smaller], place[smaller].astype("<u2"), ids[smaller])))
            yield _rows(_MESSAGE, out)

    return run


# -- 4. the bytes that remain --------------------------------------------------

def _cover(n_bytes, ids, ends, told, length):
    """Mark the bytes that a smaller document has."""
    if _OWN not in told:
        return np.zeros(n_bytes, bool)
    low, n, own, least = unpack(told[_OWN][0], "<i8", "<i4", "<i4", "<i8")
    known = np.repeat(least[:, None], int(n.max()), axis=1)
    for blob in told.get(_ANSWER, []):
        slice_, place, doc_id = unpack(blob, "<i4", "<u2", "<i8")
        known[slice_, place] = doc_id
    begin, _ = _bounds(n.astype(np.int64))
    place = np.arange(int(n.sum())) - np.repeat(begin, n)
    doc = np.repeat(ids[np.searchsorted(ends, low, "right")], n)
    starts = (np.repeat(low, n) + place)[known[np.repeat(own, n), place] < doc]
    change = np.zeros(n_bytes + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


def _finish(length):
    def run(batches):
        for _, blob, others, told in _by_chunk(batches, True):
            ids, sizes, buffer = unpack(blob, "<i8", "<i8", np.uint8)
            starts, ends = _bounds(sizes)
            gone = _cover(len(buffer), ids, ends, told, length)
            row = pa.ipc.open_stream(others).read_all().combine_chunks().column(0)
            row = row.chunk(0) if isinstance(row, pa.ChunkedArray) else row
            kept, removed, spans = [], [], []
            for a, b in zip(starts.tolist(), ends.tolist()):
                mask = gone[a:b]
                n = int(np.count_nonzero(mask))
                removed.append(n)
                spans.append(int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if n else 0)
                kept.append(buffer[a:b][~mask].tobytes() if n else buffer[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, keep: list[str], length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Remove from every text of ``docs`` (doc_id, text) each byte covered by
    a string of ``length`` bytes that also starts in a document with a
    smaller doc_id; strings are judged on the input.

    Returns row (a struct of the columns ``keep``), n_bytes, n_removed,
    n_spans and kept (the remaining bytes). A null text is empty; rows that
    share a doc_id do not remove from one another; a row without a doc_id
    counts as after all others; an empty table gives no rows. The columns of
    ``docs`` may have any names.
    """
    spark = docs.sparkSession
    chunks = stage(_chunks(docs, keep), "chunks")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chunks.select("chunk").count() // 8 + 1)

    def meet(messages, answer, name):  # every bucket in one task
        return stage(messages.repartitionById(buckets, F.col("bucket")).mapInArrow(frugal(answer), _MESSAGE_SCHEMA), name)

    hashes = chunks.select("chunk", "blob").mapInArrow(frugal(_send_hashes(length, gram, buckets)), _MESSAGE_SCHEMA)
    shared = meet(hashes, _answer_hashes, "anchors")
    slices = _with_answers(chunks, shared).mapInArrow(frugal(_send_slices(length, gram, buckets)), _MESSAGE_SCHEMA)
    found = meet(slices, _answer_slices(length), "strings")
    release(shared)
    row = T.StructType([T.StructField("_", T.IntegerType()), *[docs.schema[c] for c in keep]])
    schema = T.StructType([T.StructField("row", row), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept", T.BinaryType())])
    return _with_answers(chunks, found).mapInArrow(frugal(_finish(length)), schema)


def with_text(found: DataFrame) -> DataFrame:
    """Adds kept_text: the remaining bytes as text, where a character that
    lost some of its bytes is left out whole."""
    @F.pandas_udf("string")
    def decode(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: b.decode("utf-8", "ignore"))

    return found.withColumn("kept_text", decode("kept"))
