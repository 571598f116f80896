"""Bounded-space online best-fit packing of token sequences.

Each task reads its documents once, a bounded number at a time, and keeps at
most ``open_bins`` unfinished sequences. A bitset with one bit for each amount of
free space finds the open sequence that a piece fills best; when a new one
must be opened beyond the bound, the fullest is closed. Nothing is shuffled
and a task's state does not grow with its input.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, text_of
from .tokens import default_path, piece_encoder

CAPACITY, END_ID, OPEN_BINS = 2048, 0, 512
#: Documents that wait together; of these the longest pieces are placed first.
LOOK_AHEAD = 1000

_SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


class BestFit:
    """place(length) -> (sequence number, offset) for lengths 1 to capacity."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity)]  # open sequences by free space
        self.bits = 0  # bit f: some open sequence has f free places
        self.n_open = self.n_made = 0

    def _take(self, free: int) -> int:
        sequence = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.n_open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1  # the least that is enough
            sequence = self._take(free)
        else:
            if self.n_open >= self.open_bins and length < self.capacity:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            sequence, free = self.n_made, self.capacity
            self.n_made += 1
        left = free - length
        if left:
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.n_open += 1
        return sequence, self.capacity - free


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                   open_bins: int = OPEN_BINS, end_id: int = END_ID) -> DataFrame:
    """Pack each row of ``docs`` (doc_id, text) into sequences of at most
    ``capacity`` ids; a document is its ids and ``end_id``. Only longer
    documents are cut, at multiples of ``capacity``.

    Returns doc_id, piece, start, length, ids (little-endian unsigned 32-bit),
    sequence_id, offset. A null or empty text is the end id alone, a null
    doc_id stays null, repeated rows are packed each by itself, an empty
    table gives no rows. Other columns of ``docs`` are not read.
    """
    path = tokenizer_path or default_path()
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder, bins = piece_encoder(path), BestFit(capacity, open_bins)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            waiting, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                waiting.append((doc_id, encoder.encode(text.as_py()) + end))
                held += len(waiting[-1][1])
                if len(waiting) == LOOK_AHEAD or held > 1 << 23:
                    yield _placed(waiting, bins, capacity, first)
                    waiting, held = [], 0
            if waiting:
                yield _placed(waiting, bins, capacity, first)

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(frugal(run), _SCHEMA)


def _placed(waiting: list[tuple], bins: BestFit, capacity: int, first: int) -> pa.RecordBatch:
    """Cut the documents (doc_id, ids) into pieces and place them."""
    pieces = [(doc_id, piece, at, ids[4 * at:4 * (at + capacity)])
              for doc_id, ids in waiting for piece, at in enumerate(range(0, len(ids) // 4, capacity))]
    pieces.sort(key=lambda p: -len(p[3]))  # stable: equal lengths in order of arrival
    places = [bins.place(len(p[3]) // 4) for p in pieces]
    columns = [*zip(*pieces), [len(p[3]) // 4 for p in pieces], [first + s for s, _ in places], [o for _, o in places]]
    names = ("doc_id", "piece", "start", "ids", "length", "sequence_id", "offset")
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    made = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}
    return pa.RecordBatch.from_pydict({n: made[n] for n in ("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")})
