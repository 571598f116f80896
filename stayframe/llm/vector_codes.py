"""Product codes of vectors, fitted and assigned in exact integers.

A component x becomes floor(scale * x). Vectors are cut into equal parts; each
part position has a codebook of integer entries. The nearest entry is found
from |a|^2 - 2 a.b + |b|^2, where every dot product is exact: integers are
broken into limbs so short that a float64 matrix product of two limb
matrices stays below 2^53, and the products are recombined in int64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Signed integers as float64 limbs, x = sum(limb[k] << (bits * k)); every
    limb but the last lies in [0, 2^bits), the last keeps the sign."""
    out = []
    while x.size and (x.min() < -(1 << bits) or x.max() >= 1 << bits):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return out + [x.astype(np.float64)]


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices by float64 products that are all exact; the
    true result must fit int64."""
    bits = (53 - max(1, a.shape[1]).bit_length()) // 2  # width * 2^bits * 2^bits < 2^53
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(a: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the first of equals) and its squared distance."""
    d = (entries * entries).sum(1) - 2 * exact_dot(a, entries)
    best = d.argmin(1)
    return best, (a * a).sum(1) + d[np.arange(len(a)), best]


def _matrix(column, dim: int) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, dim)


class Codebooks:
    """Entries by part: int64 array of (parts, entries, width)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def updated(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        return Codebooks(np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], self.entries))


def integer_vectors(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS) -> tuple[DataFrame, int]:
    """The rows whose vector is not null and has only finite components, with
    the integers as array column ``v``, staged; and the dimension.

    The dimension is the length of the kept vector with the smallest vec_id
    among those whose length is a positive multiple of ``parts``. Vectors of
    another length keep their row with a null ``v``. Raises ValueError where
    a squared distance could leave 64 bits.
    """
    x = F.col(vector)
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    finite = x.isNotNull() & F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c.cast("double")))
    kept = vectors.filter(finite)
    far = F.max(F.array_max(F.transform(x, lambda c: F.abs(c.cast("double")))))
    first = F.min(F.when((F.size(x) > 0) & (F.size(x) % parts == 0), F.struct(F.col("vec_id").isNull().alias("last"), "vec_id", F.size(x).alias("dim"))))
    found = kept.agg(first.alias("first"), far.alias("far")).first()
    dim = found["first"]["dim"] if found["first"] else 0
    if dim and dim * (2 * (found["far"] * scale + 1)) ** 2 >= 2**63:
        raise ValueError(f"components up to {found['far']} at scale {scale} give squared distances beyond 64 bits")
    rows = kept.select(F.struct("*").alias("row"), F.when(F.size(x) == dim, whole).alias("v"))
    return stage(rows, "integer-vectors"), dim


def start(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors with the smallest vec_ids (null last, ties by the vector)."""
    least = rows.filter("v IS NOT NULL").orderBy(F.col("row.vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    v = np.array([r["v"] for r in least], np.int64).reshape(len(least), parts, dim // parts if dim else 0)
    return Codebooks(np.ascontiguousarray(v.transpose(1, 0, 2)))


def one_round(rows: DataFrame, dim: int, books: Codebooks) -> Codebooks:
    """Assign every part and move each entry to the floor of its parts' mean.
    Tasks send sums and counts by entry, a bounded number each."""
    parts, n, width = books.entries.shape

    def sums(batches):
        total, count = np.zeros((parts, n, width), np.int64), np.zeros((parts, n), np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), dim)
            for p in range(parts):
                a = v[:, p * width:(p + 1) * width]
                best, _ = nearest(a, books.entries[p])
                np.add.at(total[p], best, a)
                count[p] += np.bincount(best, minlength=n)
        flat = np.concatenate([total.reshape(-1), count.reshape(-1)])
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(flat[used], pa.int64())], names=["slot", "value"])

    made = rows.filter("v IS NOT NULL").select("v").mapInArrow(sums, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(parts * n * (width + 1), np.int64)
    for r in made:
        flat[r["slot"]] = r["value"]
    return books.updated(flat[:parts * n * width].reshape(parts, n, width), flat[parts * n * width:].reshape(parts, n))


def fit(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    books = start(rows, dim, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        books = one_round(rows, dim, books)
    return books


def encode(rows: DataFrame, dim: int, books: Codebooks) -> DataFrame:
    """Add ``codes`` (binary, one byte for each part) and ``error`` (sum of the
    parts' squared distances); both null where ``v`` is."""
    parts, _, width = books.entries.shape

    def assign(batches):
        for batch in batches:
            v = batch.column(batch.schema.get_field_index("v"))
            has = np.array(v.is_valid(), bool)
            x = _matrix(v.filter(v.is_valid()), dim)
            codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                codes[:, p], d = nearest(x[:, p * width:(p + 1) * width], books.entries[p])
                error += d
            at = np.cumsum(has) - 1
            out = {"row": batch.column(batch.schema.get_field_index("row")),
                   "codes": pa.array([codes[k].tobytes() if h else None for k, h in zip(at, has)], pa.binary()),
                   "error": pa.array([int(error[k]) if h else None for k, h in zip(at, has)], pa.int64())}
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    schema = rows.select("row").schema.add("codes", "binary").add("error", "long")
    return rows.mapInArrow(assign, schema)


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """Fit codebooks on all vectors and code each: row (the input's columns),
    codes, error; and the codebooks.

    At most 256 entries. Rows with a null vector, a null component or one that
    is not finite are dropped; vec_id and label may be null; vectors of
    another length than the table's dimension stay, with null codes and
    error, and take no part in the fit. Repeated rows count each. With fewer
    vectors than ``entries`` there are as many entries as vectors; an empty
    table gives no rows. Results don't depend on the partitioning: all
    arithmetic is in whole numbers. A round reads the staged integers; only
    sums by entry reach the driver (parts x entries x (width + 1) numbers).
    """
    if entries > 256:
        raise ValueError("a code is one byte: at most 256 entries")
    rows, dim = integer_vectors(vectors, vector, scale, parts)
    books = fit(rows, dim, parts, entries, rounds)
    if not books.entries.size:
        return rows.select("row", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), books
    return encode(rows, dim, books), books


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
