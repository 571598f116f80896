"""SimHash near-duplicates with pivot distance tables.

A document's fingerprint is the bitwise majority of its shingles' hashes.
Distinct fingerprints are dealt to blocks that every linked pair must share
(of six groups of bits, at most ``distance`` = 4 differ, so two are equal).
Inside a block each fingerprint has a row of Hamming distances to fixed
reference fingerprints; by the triangle inequality a pair whose distances to
any reference differ by more than the limit is discarded, and only the
survivors are compared bit by bit. Large blocks are cut into tiles, and a
tile reports a spanning star of each group it finds, never all its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, quoted, stage, text_of
from .components import components

#: Shingle length in words and the most bits that linked fingerprints differ by.
SHINGLE, DISTANCE = 4, 4
#: Reference fingerprints: hashes of the numbers from 0 on.
PIVOTS = 24
#: Members of a tile; larger blocks are compared tile against tile.
TILE = 1024


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of the shingles of a text, repeats included."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:len(words) - shingle + 1].tolist()
    hash64 = xxhash.xxh64_intdigest
    return [hash64(joined[s:e], 42) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits: each is 1 if it is set in more than half of the hashes."""
    hashes = np.array(shingle_hashes(text, shingle), "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k:k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: bool = False) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row; with
    ``keep`` also row, a struct of all its columns."""
    @F.pandas_udf("long")
    def fp_of(texts: pd.Series) -> pd.Series:
        fps = np.fromiter((fingerprint(t.encode("utf-8"), shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(fps.view(np.int64))

    row = [F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")] if keep else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), fp_of(text_of()).alias("fp"), *row)


def _blocks(distance: int) -> list[tuple[int, int, int]]:
    """Two of distance + 2 groups of bits: (number, mask, mask), so that any
    two fingerprints within ``distance`` bits agree on one entry."""
    edges = np.linspace(0, 64, distance + 3).round().astype(int).tolist()
    groups = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [(k, x, y) for k, (x, y) in enumerate(combinations(groups, 2))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _block_key(fp: Column, distance: int) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(k).alias("block"), fp.bitwiseAND(F.lit(_signed(x | y))).alias("bits"))
                               for k, x, y in _blocks(distance)])).alias("key")


def linked_pairs(groups: np.ndarray, fps: np.ndarray, sides: np.ndarray, distance: int, pivots: np.ndarray):
    """Rows of a group are adjacent. Yields index arrays (i, j) of rows of
    one group, on different sides where the group has two, within distance."""
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    left = np.arange(len(fps))
    step = 1
    while True:
        left = left[left + step < len(fps)]
        left = left[groups[left] == groups[left + step]]
        if not len(left):
            return
        i, j = left, left + step
        two = (sides[i] < 0) | (sides[i] != sides[j])  # a tile of two parts compares across only
        i, j = i[two], j[two]
        for p in range(table.shape[1]):  # discard by the largest coordinate difference
            near = np.abs(table[i, p] - table[j, p]) <= distance
            i, j = i[near], j[near]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= distance
        yield i[near], j[near]
        step += 1


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index of each index's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links(fps: DataFrame, distance: int = DISTANCE, n_pivots: int = PIVOTS, tile: int = TILE) -> DataFrame:
    """fps (fp, distinct): returns links a, b whose components are those of
    all pairs within ``distance`` bits."""
    keyed = fps.select("fp", _block_key(F.col("fp"), distance)).select("fp", "key.block", "key.bits")
    large = (keyed.groupBy("block", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > tile)
             .withColumn("parts", F.ceil(F.col("n") / tile).cast("int")).drop("n"))
    part = F.pmod(F.xxhash64(F.col("fp")), F.col("parts")).cast("int")
    dealt = (keyed.join(large, ["block", "bits"], "left").withColumn("part", F.coalesce(part, F.lit(0)))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
             .select("block", "bits", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                     "part", "fp"))
    pivots = np.array([xxhash.xxh64_intdigest(str(k)) for k in range(n_pivots)], np.uint64)

    def solve(table: pa.Table) -> pa.RecordBatch:
        block, bits, low, high, side = (table.column(k).to_numpy() for k in range(5))
        fp = table.column(5).to_numpy().view(np.uint64)
        first = np.ones(len(fp), bool)
        first[1:] = (block[1:] != block[:-1]) | (bits[1:] != bits[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        group = np.cumsum(first)
        found = list(linked_pairs(group, fp, np.where(low == high, -1, side), distance, pivots))
        i = np.concatenate([f[0] for f in found]) if found else np.zeros(0, int)
        j = np.concatenate([f[1] for f in found]) if found else np.zeros(0, int)
        root = _stars(len(fp), i, j)
        off = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[off].view(np.int64)), pa.array(fp[root[off]].view(np.int64))], names=["a", "b"])

    def run(batches):  # sorted by group; the last group of a batch may go on in the next
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            n = table.num_rows
            if not n:
                continue
            cols = [table.column(k).to_numpy() for k in range(4)]
            last = np.logical_and.reduce([c == c[-1] for c in cols])
            cut = n - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield solve(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held)

    tile_key = ["block", "bits", "low", "high"]
    return dealt.repartition(*tile_key).sortWithinPartitions(*tile_key, "fp").mapInArrow(frugal(run), "a long, b long")


def classes(rows: DataFrame, distance: int = DISTANCE, n_pivots: int = PIVOTS) -> DataFrame:
    """rows (doc_id, fp): returns fp, class (the least fingerprint, as a signed
    long, of those reachable) and component_id (the smallest doc_id of the
    class; null if none of its rows has one), one row for each fp."""
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = components(links(fps.select("fp"), distance, n_pivots))
    found = (fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least", F.coalesce("label", "fp").alias("class")))
    least = found.groupBy("class").agg(F.min("least").alias("component_id"))
    return found.drop("least").join(least, "class").select("fp", "class", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, n_pivots: int = PIVOTS) -> DataFrame:
    """Near-duplicate classes of every row of ``docs`` (doc_id, text).

    Returns doc_id, fp, class and component_id (see ``classes``). Null and
    empty texts have fingerprint zero and are linked like any other; repeated
    rows get a row each; an empty table gives no rows; other columns are not
    read.
    """
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    return rows.join(classes(rows, distance, n_pivots), "fp").select("doc_id", "fp", "class", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, n_pivots: int = PIVOTS) -> DataFrame:
    """The columns of ``docs``, one row of each near-duplicate class: the one
    with the smallest doc_id, a row without one only where the class has no
    other. Of rows of a class that share that doc_id, the least text stays."""
    rows = stage(fingerprints(docs, shingle, keep=True), "fingerprints")
    found = rows.select("doc_id", "fp").join(classes(rows.select("doc_id", "fp"), distance, n_pivots), "fp")
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    n_rows = first.groupBy("class").agg(F.count("*").alias("n_rows"))
    kept = stage(first.distinct().join(n_rows, "class").select(
        F.col("fp").alias("k_fp"), F.col("doc_id").alias("k_id"), "class", "n_rows"), "kept")
    judged = rows.join(kept, (F.col("fp") == F.col("k_fp")) & F.col("doc_id").eqNullSafe(F.col("k_id")))
    several = (judged.filter("n_rows > 1").groupBy("class")
               .agg(F.min_by("row", F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("row")))
    return judged.filter("n_rows = 1").select("row").union(several.select("row")).select("row.*")
