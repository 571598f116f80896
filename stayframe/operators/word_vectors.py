"""Word vectors from skip-gram pair counts, as jobs over sharded tables.

Skip-gram training with negative samples factorises the (shifted) pointwise
mutual information of words and their neighbours. Here that matrix is
counted exactly and factorised by block power iteration. The matrix lies in
compressed tiles of counts, a file for each group of rows, and the vectors in
files by group of words. A task has a group of rows: it reads their tiles and,
one group after another, the vectors of the columns, and sums the products
where they are made. Neither the vocabulary nor the vectors ever reach the
driver; it sees only (size x size) matrices.

Every sum has a fixed order (tiles by number, entries by place) and the start
comes from the words' MD5, so the vectors do not depend on how the input is
partitioned.
"""

from __future__ import annotations

import gc
import hashlib
import os
import struct
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from stayframe.session import materialize, shared_folder, stage

#: Words of a block, blocks of a group (of rows or columns of a tile), columns of a slab, batches of groups that are turned together.
BLOCK, GROUP_BLOCKS, SLAB, BATCHES = 2048, 8, 50, 4
#: Tokens and entries of a step of numpy, entries of a step of products, cells that are added up at once.
STEP_TOKENS, STEP_ENTRIES, PRODUCT_ENTRIES, MERGED = 1 << 18, 1 << 15, 1 << 12, 1 << 22
#: Shares of the rows whose pairs are shuffled one after another, so that only one share's shuffle files are on disk.
SHARES = 2
#: Notes, and tokens unless a note has more, that read the vectors of their words together.
NOTES_PER_COPY, TOKENS_PER_COPY = 1 << 14, 1 << 21
#: Gram matrices that the driver adds up; more are added in Spark first.
GRAMS = 64


@dataclass
class WordVectors:
    """``words`` (word, block, place, n) and ``blocks`` (block, size, vectors as
    little-endian float64), both tables. ``files`` are the blocks as
    ``vector_files`` writes them (folder, names), where they are already."""
    words: DataFrame
    blocks: DataFrame
    size: int
    files: tuple[str, list[str]] | None = None

    def vectors(self) -> DataFrame:
        """(word, vector) of the whole vocabulary."""
        size = self.size

        def unpack(batches):
            for block, blob in _rows(batches, 2):
                v = np.frombuffer(blob, "<f8").reshape(-1, size)
                for k in range(0, len(v), 1024):
                    part = v[k:k + 1024]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), block, np.int64)), pa.array(np.arange(k, k + len(part), dtype=np.int64)),
                         pa.ListArray.from_arrays(pa.array(np.arange(0, part.size + 1, size, dtype=np.int32)), pa.array(part.reshape(-1)))],
                        names=["block", "place", "vector"])

        rows = self.blocks.select("block", "blob").mapInArrow(unpack, "block long, place long, vector array<double>")
        return self.words.join(rows, ["block", "place"]).select("word", "vector")

    def save(self, path: str) -> None:
        self.words.write.mode("overwrite").parquet(os.path.join(path, "words"))
        self.blocks.write.mode("overwrite").parquet(os.path.join(path, "blocks"))
        self.blocks.sparkSession.range(1).select(F.lit(self.size).alias("size")).write.mode("overwrite").json(os.path.join(path, "meta"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> WordVectors:
        return WordVectors(spark.read.parquet(os.path.join(path, "words")), spark.read.parquet(os.path.join(path, "blocks")),
                           spark.read.json(os.path.join(path, "meta")).first()["size"])


def _rows(batches, n: int):
    for batch in batches:
        yield from zip(*(batch.column(k).to_pylist() for k in range(n)))


def _blocks_of(found: list[tuple], names: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), names.values())], names=list(names))


def word_counts(tokenised: DataFrame, min_count: int) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` tokens."""
    # a plain explode has Spark work out the tokens again for a filter on their number
    words = tokenised.select(F.explode_outer("tokens").alias("word")).where("word IS NOT NULL")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def vocabulary(tokenised: DataFrame, min_count: int) -> DataFrame:
    """word, id (64-bit hash), n, block, place: words with at least
    ``min_count`` tokens, dealt to blocks by hash and numbered within them."""
    words = materialize(word_counts(tokenised, min_count).select("word", "n", F.xxhash64("word").alias("id")))
    clash = words.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    if not clash.isEmpty():
        raise ValueError("two words of the vocabulary share a 64-bit hash")
    n_blocks = max(1, -(-words.count() // BLOCK))
    place = F.row_number().over(Window.partitionBy("block").orderBy("id")) - 1
    return materialize(words.withColumn("block", F.pmod("id", F.lit(n_blocks)).cast("long")).withColumn("place", place.cast("long")).withColumn("n_blocks", F.lit(n_blocks).cast("long")))


@dataclass
class Layout:
    """Where a fit's words stand: those of ``GROUP_BLOCKS`` blocks are a group, and a word's place in its group has at most
    ``bits`` bits. ``names`` (by group) are files under ``folder`` with the ids of the group's words in the order of their places;
    ``sizes`` are how many it has."""
    folder: str
    n_blocks: int
    per_group: int
    names: dict[int, str]
    sizes: dict[int, int]

    @property
    def groups(self) -> list[int]:
        return sorted(self.names)

    @property
    def bits(self) -> int:
        return max(1, int(max(self.sizes.values()) - 1).bit_length())

    @property
    def n_groups(self) -> int:
        return -(-self.n_blocks // self.per_group)

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """group << bits | place of each of the distinct ``ids``, -1 for those of no word."""
        out, group = np.full(len(ids), -1), ids % self.n_blocks // self.per_group
        by = np.argsort(group, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(group[by], prepend=-1)), len(by))
        for a, b in zip(cuts, cuts[1:]):
            mine = by[a:b]
            if (g := int(group[mine[0]])) in self.names:
                known = _read(f"{self.folder}/{self.names[g]}", "<i8")
                place = np.argsort(known)
                at = place[np.minimum(np.searchsorted(known, ids[mine], sorter=place), len(known) - 1)]
                out[mine] = np.where(known[at] == ids[mine], g << self.bits | at, -1)
        return out


def _read(path: str, kind: str) -> np.ndarray:
    fs, at = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(at) as source:
        return np.frombuffer(source.read(), kind)


def _write(path: str, *arrays: np.ndarray) -> None:
    fs, at = pafs.FileSystem.from_uri(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(at) as sink:
        for a in arrays:
            sink.write(np.ascontiguousarray(a).data)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _release(spark: SparkSession) -> None:
    """Shuffle files of frames that are gone stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _planes(x: np.ndarray) -> tuple[int, bytes]:
    """Bytes a number, and the numbers with their first bytes together, then their second, and so on."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(x.max()) < 1 << 8 * w)
    return width, x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def packed_cells(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending cells and their counts, compressed."""
    (a, steps), (b, n) = _planes(np.diff(cells, prepend=0)), _planes(counts)
    return struct.pack("<qBB", len(cells), a, b) + pa.compress(steps + n, codec="zstd", asbytes=True)


def unpacked_cells(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, a, b = struct.unpack_from("<qBB", blob)
    raw = np.frombuffer(pa.decompress(blob[10:], n * (a + b), codec="zstd", asbytes=True), np.uint8)
    steps, counts = (np.ascontiguousarray(part.reshape(w, n).T).view(f"<u{w}").ravel().astype(np.int64) for part, w in ((raw[:n * a], a), (raw[n * a:], b)))
    return np.cumsum(steps), counts


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of several lists of cells, added up."""
    cells, counts = (np.concatenate(x) for x in zip(*parts))
    by = np.argsort(cells, kind="stable")
    cells, counts = cells[by], counts[by]
    heads = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[heads], np.add.reduceat(counts, heads)


def _grouped(words: DataFrame, per_group: int, *columns: str) -> DataFrame:
    """(group, own): the words of each group in the order of their places."""
    own = F.array_sort(F.collect_list(F.struct("block", "place", *columns)))
    return words.groupBy(F.floor(F.col("block") / per_group).alias("group")).agg(own.alias("own"))


def write_ids(words: DataFrame, folder: str) -> Layout:
    """Write the ids of every group."""
    n_blocks = words.agg(F.max("n_blocks")).first()[0] or 1

    def write(batches):
        for group, own in _rows(batches, 2):
            name = f"ids/{group}-{TaskContext.get().taskAttemptId()}"
            _write(f"{folder}/{name}", np.array([e["id"] for e in own], "<i8"))
            yield _blocks_of([(group, name, len(own))], {"group": pa.int64(), "name": pa.string(), "n": pa.int64()})

    rows = _grouped(words, GROUP_BLOCKS, "id").mapInArrow(write, "group long, name string, n long").collect()
    return Layout(folder, n_blocks, GROUP_BLOCKS, {r["group"]: r["name"] for r in rows}, {r["group"]: r["n"] for r in rows})


def write_start(words: DataFrame, size: int, layout: Layout, slabs: list[tuple[int, int]]) -> dict[int, str]:
    """Write the words' first vectors, from the MD5 of each; their names by group."""
    folder, batch = layout.folder, _batch_of(layout.n_groups)

    def write(batches):
        for group, own in _rows(batches, 2):
            v = np.empty((len(own), size))
            for k, entry in enumerate(own):
                raw = b"".join(hashlib.md5(f"{entry['word']}/{part}".encode()).digest() for part in range(-(-size // 4)))
                v[k] = np.frombuffer(raw, "<u4")[:size] / 2.0**32 - 0.5
            name = f"{group}-{TaskContext.get().taskAttemptId()}"
            for s, (a, b) in enumerate(slabs):
                _write(f"{folder}/y0-{batch(group)}/{name}.{s}", v[:, a:b])
            yield _blocks_of([(group, name)], {"group": pa.int64(), "name": pa.string()})

    return {r["group"]: r["name"] for r in _grouped(words, layout.per_group, "word").mapInArrow(write, "group long, name string").collect()}


def pair_tiles(tokenised: DataFrame, window: int, layout: Layout, share: int, shares: int) -> DataFrame:
    """(row, col, blob) of unordered pairs of words at most ``window`` tokens
    apart, in tiles of row group x column group (row <= col); a pair ``d``
    apart weighs ``window + 1 - d`` (the mean of windows of every size up to
    ``window``), a pair of a word with itself counts from both ends. Pairs with
    a word outside the vocabulary count nowhere. Steps of tokens are counted in
    numpy before the shuffle; a note may be of any length. Of the row groups
    those are returned that leave ``share`` when divided by ``shares``."""
    bits, n_groups, low = layout.bits, layout.n_groups, window.bit_length()
    if 2 * bits + low + (n_groups * n_groups).bit_length() > 63:
        raise ValueError(f"{n_groups} groups of up to {1 << bits} words are too many")
    mask, step, most = (1 << bits) - 1, STEP_TOKENS, MERGED
    names = {"row": pa.int64(), "col": pa.int64(), "blob": pa.binary()}

    def count(batches):
        for batch in batches:
            column = batch.column(0)
            ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            ends = np.cumsum(np.diff(column.offsets.to_numpy()))
            for at in range(0, len(ids), step):
                own, local = np.unique(ids[at:at + step + window], return_inverse=True)
                code, of, keys = layout.codes(own)[local], np.searchsorted(ends, np.arange(at, at + len(local)), "right"), []
                for d in range(1, window + 1):
                    n = min(step, len(code) - d)
                    if n <= 0:
                        break
                    x, y = code[:n], code[d:n + d]
                    same = np.flatnonzero((of[:n] == of[d:n + d]) & (x >= 0) & (y >= 0))
                    x, y = np.minimum(x[same], y[same]), np.maximum(x[same], y[same])
                    if shares > 1:
                        mine = (x >> bits) % shares == share
                        x, y = x[mine], y[mine]
                    tile = (x >> bits) * n_groups + (y >> bits)
                    keys.append(((tile << bits | x & mask) << bits | y & mask) << low | window + 1 - d)
                if not sum(map(len, keys)):
                    continue
                key = np.concatenate(keys)
                key.sort()
                cells = key >> low
                heads = np.flatnonzero(np.diff(cells, prepend=-1))
                cells, counts = cells[heads], np.add.reduceat(key & (1 << low) - 1, heads)
                tile = cells >> 2 * bits
                cuts = np.append(np.flatnonzero(np.diff(tile, prepend=-1)), len(tile))
                yield _blocks_of([(*divmod(int(tile[a]), n_groups), packed_cells(cells[a:b] & (1 << 2 * bits) - 1, counts[a:b])) for a, b in zip(cuts, cuts[1:])], names)

    def add(batches):
        for (row, col), own in groupby(_rows(batches, 3), key=lambda r: r[:2]):
            held, n = [], 0
            for *_, blob in own:
                held.append(unpacked_cells(blob))
                n += len(held[-1][0])
                if n > most and len(held) > 1:
                    held = [_added(held)]
                    n = len(held[0][0])
            cells, counts = _added(held)
            if row == col:
                counts = np.where(cells >> bits == cells & mask, 2 * counts, counts)
            yield _blocks_of([(row, col, packed_cells(cells, counts))], names)

    schema = "row long, col long, blob binary"
    ids = tokenised.select(F.transform("tokens", lambda t: F.xxhash64(t)).alias("ids"))
    found = ids.mapInArrow(count, schema).repartition(F.col("row"), F.col("col")).sortWithinPartitions("row", "col")
    return stage(found.mapInArrow(add, schema), "pairs")


def write_rows(tiles: DataFrame, layout: Layout, share: int, shares: int) -> tuple[dict[int, str], int]:
    """Write a file for each row group of the share: all its tiles by column
    group, with those of the turned pairs; beside it the columns and lengths of
    the tiles, and the sum of each row. Returns the names by row, and the sum
    of all."""
    bits, mask, folder, sizes = layout.bits, (1 << layout.bits) - 1, layout.folder, layout.sizes
    names = {"row": pa.int64(), "col": pa.int64(), "blob": pa.binary()}

    def turn(batches):
        for row, col, blob in _rows(batches, 3):
            if row != col and row % shares == share:
                yield _blocks_of([(row, col, blob)], names)
            if col % shares == share:
                cells, counts = unpacked_cells(blob)
                turned = (cells & mask) << bits | cells >> bits
                by = np.argsort(turned, kind="stable")
                if row == col:
                    off = by[turned[by] != cells[by]]
                    yield _blocks_of([(row, col, packed_cells(*_added([(cells, counts), (turned[off], counts[off])])))], names)
                else:
                    yield _blocks_of([(col, row, packed_cells(turned[by], counts[by]))], names)

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(f"{root}/rows", recursive=True)
        for row, own in groupby(_rows(batches, 3), key=lambda r: r[0]):
            name, about, sums = f"{row}-{TaskContext.get().taskAttemptId()}", [], np.zeros(sizes[row], np.int64)
            with fs.open_output_stream(f"{root}/rows/{name}") as sink:
                for _, col, blob in own:
                    cells, counts = unpacked_cells(blob)
                    heads = np.flatnonzero(np.diff(cells >> bits, prepend=-1))
                    sums[cells[heads] >> bits] += np.add.reduceat(counts, heads)
                    about.append((col, len(blob)))
                    sink.write(blob)
            _write(f"{folder}/rows/{name}.tiles", np.array(about, "<i8"))
            _write(f"{folder}/rows/{name}.sums", sums)
            yield _blocks_of([(row, name, int(sums.sum()))], {"row": pa.int64(), "name": pa.string(), "n": pa.int64()})

    schema = "row long, col long, blob binary"
    dealt = tiles.mapInArrow(turn, schema).repartition(F.col("row")).sortWithinPartitions("row", "col")
    rows = dealt.mapInArrow(write, "row long, name string, n long").collect()
    return {r["row"]: r["name"] for r in rows}, sum(r["n"] for r in rows)


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """T with (V T)'(V T) = 1 on the range of V, where V'V = gram; columns
    beyond the rank are zero."""
    values, basis = np.linalg.eigh(gram)
    scale = np.where(values > 1e-10 * max(values[-1], 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    return basis * scale


def _in_order(rows: list[tuple[int, np.ndarray]]) -> np.ndarray:
    total = 0.0
    for _, m in sorted(rows, key=lambda r: r[0]):
        total = total + m
    return total


def _sum_of(matrices, n: int) -> np.ndarray:
    """The matrices of ``n`` groups, (group, matrix), added in the groups' order."""
    while n > GRAMS:
        each = GRAMS
        matrices = matrices.map(lambda r: (r[0] // each, r)).groupByKey().map(lambda r: (r[0], _in_order(list(r[1]))))
        n = -(-n // each)
    return _in_order(matrices.collect())


def _batch_of(n_groups: int):
    """Which of the ``BATCHES`` a group is turned with."""
    n = BATCHES
    return lambda group: group * n // n_groups


class Passes:
    """Block power iteration over the row files of a fit. The vectors lie in
    files by group and by slab of columns. A pass multiplies slab by slab and
    turns the products batch by batch, and what is used up is removed, so that
    there is little more than one copy of them at any time."""

    def __init__(self, spark: SparkSession, layout: Layout, rows: dict[int, str], total: float, size: int, slabs: list, names: dict[int, str]):
        self.spark, self.layout, self.rows, self.total, self.size, self.slabs = spark, layout, rows, total, size, slabs
        self.number, self.products, self.vectors = 0, [names] * len(slabs), {}

    def _jobs(self, groups: list[int], f):
        return self.spark.sparkContext.parallelize(groups, len(groups)).map(f)

    def _product(self):
        """Reads the products of a group, all columns."""
        folder, number, names, slabs, batch = self.layout.folder, self.number, self.products, self.slabs, _batch_of(self.layout.n_groups)
        return lambda g: np.hstack([_read(f"{folder}/y{number}-{batch(g)}/{names[s][g]}.{s}", "<f8").reshape(-1, b - a) for s, (a, b) in enumerate(slabs)])

    def gram(self) -> np.ndarray:
        read = self._product()

        def own(g):
            v = read(g)
            return g, v.T @ v

        return _sum_of(self._jobs(self.layout.groups, own), len(self.layout.groups))

    def _by_batch(self, f) -> list:
        """f(group, its products) for all groups, whose products are removed then."""
        read, batch, found = self._product(), _batch_of(self.layout.n_groups), []
        for k in sorted({batch(g) for g in self.layout.groups}):
            found += self._jobs([g for g in self.layout.groups if batch(g) == k], lambda g: f(g, read(g))).collect()
            _remove(self.spark, f"{self.layout.folder}/y{self.number}-{k}")
        return found

    def turn(self, by: np.ndarray) -> None:
        """Vectors are products x ``by``."""
        folder, number, slabs = self.layout.folder, self.number, self.slabs

        def write(g, v):
            name, out = f"{g}-{TaskContext.get().taskAttemptId()}", v @ by
            for s, (a, b) in enumerate(slabs):
                _write(f"{folder}/q{number}-{s}/{name}", out[:, a:b])
            return g, name

        self.vectors = dict(self._by_batch(write))

    def multiply(self, crossed: bool) -> np.ndarray | None:
        """Products are the matrix x vectors: the positive pointwise mutual
        information ln(n_ab N / (n_a n_b)) of the pairs. If ``crossed``, returns
        vectors' x products; it is symmetric, so each slab of products meets the
        vectors of its own and the later slabs, which are still there."""
        lay, rows, total, number, vectors, slabs = self.layout, self.rows, self.total, self.number, self.vectors, self.slabs
        folder, bits, mask, sizes, batch, step = lay.folder, lay.bits, (1 << lay.bits) - 1, lay.sizes, _batch_of(lay.n_groups), PRODUCT_ENTRIES
        products, cross = [], np.zeros((self.size, self.size))
        for s, (first, stop) in enumerate(slabs):
            def own(g, s=s, width=stop - first):
                out = np.zeros((sizes[g], width))
                if g in rows:
                    at, mine = 0, _read(f"{folder}/rows/{rows[g]}.sums", "<i8").astype(float)
                    fs, path = pafs.FileSystem.from_uri(f"{folder}/rows/{rows[g]}")
                    with fs.open_input_file(path) as source:
                        for col, length in _read(f"{folder}/rows/{rows[g]}.tiles", "<i8").reshape(-1, 2).tolist():
                            cells, counts = unpacked_cells(source.read_at(length, at))
                            at += length
                            i, j = cells >> bits, cells & mask
                            m = np.log(counts * total / (mine[i] * _read(f"{folder}/rows/{rows[col]}.sums", "<i8")[j]))
                            positive = m > 0
                            i, j, m = i[positive], j[positive], m[positive]
                            v = _read(f"{folder}/q{number}-{s}/{vectors[col]}", "<f8").reshape(-1, width)
                            for k in range(0, len(m), step):
                                part = slice(k, k + step)
                                heads = np.flatnonzero(np.diff(i[part], prepend=-1))
                                out[i[part][heads]] += np.add.reduceat(m[part, None] * v.take(j[part], axis=0), heads)
                name = f"{g}-{TaskContext.get().taskAttemptId()}"
                _write(f"{folder}/y{number + 1}-{batch(g)}/{name}.{s}", out)
                return g, name

            products.append(dict(self._jobs(lay.groups, own).collect()))
            if crossed:
                def met(g, s=s, width=stop - first, name=products[-1]):
                    out = _read(f"{folder}/y{number + 1}-{batch(g)}/{name[g]}.{s}", "<f8").reshape(-1, width)
                    return g, np.vstack([_read(f"{folder}/q{number}-{t}/{vectors[g]}", "<f8").reshape(-1, b - a).T @ out for t, (a, b) in enumerate(slabs) if t >= s])

                cross[first:, first:stop] = _sum_of(self._jobs(lay.groups, met), len(lay.groups))
                cross[first:stop, stop:] = cross[stop:, first:stop].T
            _remove(self.spark, f"{folder}/q{number}-{s}")
        self.number, self.products = number + 1, products
        return cross if crossed else None

    def finish(self, by: np.ndarray, to: str) -> list[tuple[int, str]]:
        """Write products x ``by`` as ``vector_files`` has them; (block, name)."""
        lay = self.layout

        def write(g, v):
            ids, v = _read(f"{lay.folder}/{lay.names[g]}", "<i8"), v @ by
            block = ids % lay.n_blocks
            cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
            found = [(int(block[a]), f"{block[a]}-{TaskContext.get().taskAttemptId()}") for a in cuts[:-1]]
            for (_, name), a, b in zip(found, cuts, cuts[1:]):
                _write(f"{to}/{name}", ids[a:b], v[a:b])
            return found

        return sorted(x for found in self._by_batch(write) for x in found)


def filed_blocks(spark: SparkSession, folder: str, names: list[tuple[int, str]], size: int) -> DataFrame:
    """(block, blob) of ``vector_files``."""
    def read(batches):
        for block, name in _rows(batches, 2):
            raw = _read(f"{folder}/{name}", np.uint8)
            yield _blocks_of([(block, raw[len(raw) // (8 + 8 * size) * 8:].tobytes())], {"block": pa.int64(), "blob": pa.binary()})

    return spark.createDataFrame(names, "block long, name string").mapInArrow(read, "block long, blob binary")


def train(tokenised: DataFrame, size: int = 200, window: int = 5, min_count: int = 5, passes: int = 5) -> WordVectors:
    """Vectors of all words with at least ``min_count`` tokens in ``tokenised``
    (tokens: array of strings), from ``passes`` passes over the pair counts.

    Rarer words keep their places in the windows but get no vector. Words
    without a neighbour that they meet more often than chance get zeros, as do
    dimensions beyond the matrix' positive eigenvalues. Null tokens lists
    count as empty; without words there are no vectors."""
    spark = tokenised.sparkSession
    words = vocabulary(tokenised, min_count)
    scratch, to = shared_folder(spark, "fit"), shared_folder(spark, "vectors")
    n_slabs = -(-size // SLAB)
    slabs = [(k * size // n_slabs, (k + 1) * size // n_slabs) for k in range(n_slabs)]
    layout = write_ids(words, scratch)
    found = []
    if layout.names:
        _release(spark)
        pairs, rows, total = [], {}, 0
        for k in range(SHARES):
            pairs.append(pair_tiles(tokenised, window, layout, k, SHARES))
            _release(spark)
        whole = reduce(DataFrame.unionByName, pairs)
        for k in range(SHARES):
            own, n = write_rows(whole, layout, k, SHARES)
            rows, total = rows | own, total + n
            _release(spark)
        for path in {f.rsplit("/", 1)[0] for f in whole.inputFiles()}:
            _remove(spark, path)
        run = Passes(spark, layout, rows, float(total), size, slabs, write_start(words, size, layout, slabs))
        for k in range(passes):
            run.turn(_orthonormal(run.gram()))
            cross = run.multiply(k + 1 == passes)
        # the eigenpairs of the matrix in the last subspace: vectors are M Q w / sqrt(value), close to Q w sqrt(value)
        values, basis = np.linalg.eigh((cross + cross.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, basis = values[order], basis[:, order]
        basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(size)] < 0, -1.0, 1.0)
        found = run.finish(basis * np.where(values > 1e-9 * max(values[0], 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0), to)
    _remove(spark, scratch)
    return WordVectors(words.select("word", "block", "place", "n"), filed_blocks(spark, to, found, size), size, (to, [name for _, name in found]))


def from_table(vectors: DataFrame, size: int) -> WordVectors:
    """Word vectors of a table (word, vector: array of ``size`` numbers)."""
    words = materialize(vectors.select("word", F.col("vector").cast("array<double>").alias("vector"), F.xxhash64("word").alias("id")))
    n_blocks = max(1, -(-words.count() // BLOCK))
    place = F.row_number().over(Window.partitionBy("block").orderBy("id", "word")) - 1
    dealt = materialize(words.withColumn("block", F.pmod("id", F.lit(n_blocks)).cast("long")).withColumn("place", place.cast("long")))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        v = np.array([x for row in table.column("vector").to_pylist() for x in row], "<f8")
        return pa.table({"block": table.column("block").slice(0, 1), "blob": pa.array([v.tobytes()], pa.binary())})

    blocks = materialize(dealt.select("block", "place", "vector").groupBy("block").applyInArrow(pack, "block long, blob binary"))
    return WordVectors(dealt.select("word", "block", "place", F.lit(None).cast("long").alias("n")), blocks, size)


def vector_files(model: WordVectors, folder: str) -> list[str]:
    """Write each block as a file under ``folder``: the ids of its words in
    ascending order, then their vectors in that order. Returns the names, one
    for each ``BLOCK`` words; a task that runs twice leaves a file that no name
    is returned for."""
    size = model.size

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        for block, blob, own in _rows(batches, 3):
            fs.create_dir(root, recursive=True)
            name = f"{block}-{TaskContext.get().taskAttemptId()}"
            v = np.frombuffer(blob, "<f8").reshape(-1, size)
            with fs.open_output_stream(f"{root}/{name}") as sink:
                sink.write(np.array([w["id"] for w in own], "<i8").tobytes())
                sink.write(v[[w["place"] for w in own]].tobytes())
            yield _blocks_of([(block, name)], {"block": pa.int64(), "name": pa.string()})

    own = model.words.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("word").alias("id"), "place"))).alias("own"))
    rows = model.blocks.select("block", "blob").join(own, "block").mapInArrow(write, "block long, name string").collect()
    return [r["name"] for r in sorted(rows, key=lambda r: r["block"])]


def row_sums(notes: DataFrame, model: WordVectors) -> DataFrame:
    """The rows of ``notes`` with ``n_in``, the tokens (column ``tokens``) that
    have a vector, and ``total``, the sum of their vectors, in place of the
    tokens. Words are told apart by their 64-bit hash.

    Nothing is shuffled: the vectors lie in files in the shared folder, and a
    batch of notes reads those of its own words, block by block; a block of
    which it needs few is read vector by vector. A note's sum is taken in the
    order of blocks and words, whatever notes are beside it."""
    size = model.size
    folder, names = model.files or ((to := shared_folder(notes.sparkSession, "vectors")), vector_files(model, to))

    def block_of(source, words: np.ndarray):
        """Of the sorted ``words``, the places of those in the block, and their vectors."""
        n = source.size() // (8 + 8 * size)
        ids = np.frombuffer(source.read_at(8 * n, 0), "<i8")
        at = np.searchsorted(words, ids)
        here = np.flatnonzero(words[np.minimum(at, len(words) - 1)] == ids)
        if 4 * len(here) >= n:
            v = np.frombuffer(source.read_at(8 * n * size, 8 * n), "<f8").reshape(-1, size)[here]
        else:
            v = np.frombuffer(b"".join(source.read_at(8 * size, 8 * (n + int(k) * size)) for k in here), "<f8").reshape(-1, size)
        return at[here], v

    def sums(fs, root, ids: np.ndarray, note: np.ndarray, n_notes: int):
        total, n_in = np.zeros((n_notes, size)), np.zeros(n_notes, np.int64)
        if not len(ids):
            return n_in, total
        words, which = np.unique(ids, return_inverse=True)
        entries, count = np.unique(which * n_notes + note, return_counts=True)
        first = np.searchsorted(entries, np.arange(len(words) + 1) * n_notes)
        for name in names:
            with fs.open_input_file(f"{root}/{name}") as source:
                places, v = block_of(source, words)
            long = first[places + 1] - first[places]
            row = np.repeat(np.arange(len(places)), long)
            mine = np.arange(len(row)) + np.repeat(first[places] - (np.cumsum(long) - long), long)
            of = entries[mine] % n_notes
            by = np.argsort(of, kind="stable")
            of, row, c = of[by], row[by], count[mine[by]]
            heads = np.flatnonzero(np.diff(of, prepend=-1))
            cuts = np.unique(np.append(heads[np.searchsorted(heads, np.arange(0, len(of), STEP_ENTRIES), "right") - 1], len(of)))
            for a, b in zip(cuts[:-1], cuts[1:]):
                own = heads[(heads >= a) & (heads < b)]
                total[of[own]] += np.add.reduceat(v[row[a:b]] * c[a:b, None], own - a)
            n_in += np.bincount(of, weights=c, minlength=n_notes).astype(np.int64)
        return n_in, total

    def add(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            ends = batch.column(batch.num_columns - 1).offsets.to_numpy()
            at = 0
            while at < batch.num_rows:
                stop = int(np.searchsorted(ends, ends[at] + TOKENS_PER_COPY, "right")) - 1
                n = max(1, min(stop - at, NOTES_PER_COPY, batch.num_rows - at))
                part = batch.slice(at, n)
                ids = part.column(part.num_columns - 1)
                n_in, total = sums(fs, root, ids.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(n), np.diff(ends[at:at + n + 1])), n)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, size, dtype=np.int32)), pa.array(total.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n_in), lists], names=[*part.schema.names[:-1], "n_in", "total"])
                at += n

    kept = [c for c in notes.columns if c != "tokens"]
    ids = F.transform(F.coalesce("tokens", F.array().cast("array<string>")), lambda t: F.xxhash64(t))
    schema = StructType([*notes.select(*kept).schema.fields]).add("n_in", LongType()).add("total", ArrayType(DoubleType()))
    return notes.select(*kept, ids.alias("__ids")).mapInArrow(add, schema)


def note_sums(notes: DataFrame, model: WordVectors) -> DataFrame:
    """(key, n_in, total): of each note of ``notes`` (key, tokens), the tokens
    that have a vector and the sum of their vectors; notes without any are left
    out."""
    return row_sums(notes.select("key", "tokens"), model).where("n_in > 0")
