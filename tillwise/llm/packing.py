"""Operator 10, packing by Karmarkar-Karp multiway differencing.

Documents become token ids with an end id.  Whole windows of a long document
are sequences of their own; what is left is cut into pieces of at most
PIECE_TOKENS and gathered, inside each task, to batches that fill BATCH_WINDOWS
windows but for a small slack (the piece at a batch's edge is cut there).  In a
batch each piece starts as a partial partition with one full and otherwise
empty windows; the two partial partitions of greatest imbalance are merged,
fullest with emptiest window, until one is left.  If a window of it exceeds the
capacity, the count of windows rises by one and the batch is packed anew.

Nothing is shuffled, and a task holds one batch of ids at a time.  A sequence
id is the task's number and a running number in it, the same when a lost task
is run again.

Defined cases: a null or empty text is the end id alone; null ids are kept;
repeated rows are packed each; ties go by the pieces' order; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import id_text
from tillwise.llm.tokens import default_path, encode

CAPACITY = 2048
END_ID = 1
PIECE_TOKENS = 512
BATCH_WINDOWS = 64
#: Tokens left open in each window of a batch on average: room for the differences that remain.
SLACK = 24
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Partition piece numbers into so many windows of near-equal sums."""
    # a partial partition: (- imbalance, number, sums in rising order, trees of pieces)
    heap = [(-s, i, [0] * (windows - 1) + [s], [None] * (windows - 1) + [i]) for i, s in enumerate(sizes)]
    if windows == 1:
        return [list(range(len(sizes)))]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a, held_a = heapq.heappop(heap)
        _, _, b, held_b = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b))]
        held = [x if y is None else y if x is None else (x, y) for x, y in zip(held_a, reversed(held_b))]
        order = sorted(range(windows), key=sums.__getitem__)
        sums = [sums[k] for k in order]
        heapq.heappush(heap, (sums[0] - sums[-1], number, sums, [held[k] for k in order]))
        number += 1
    return [_leaves(tree) for tree in heap[0][3]]


def _leaves(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        elif node is not None:
            out.append(node)
    return sorted(out)


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """As few windows as the sums allow; one more whenever a window exceeds the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        held = differencing(sizes, windows)
        if all(sum(sizes[i] for i in w) <= capacity for w in held):
            return [w for w in held if w]
        windows += 1


class _Packer:
    """Pieces of one task on their way into sequences."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id = capacity, first_id
        self.room = self.most = BATCH_WINDOWS * (capacity - SLACK * capacity // CAPACITY)
        self.waiting: list[tuple] = []
        self.rows: list[tuple] = []

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.capacity:
            self._sequence([(doc_id, at, ids[at: at + self.capacity], total)])
            at += self.capacity
        while at < total:
            n = min(total - at, PIECE_TOKENS, self.room)
            self.waiting.append((doc_id, at, ids[at: at + n], total))
            at += n
            self.room -= n
            if not self.room:
                self.close()

    def close(self) -> None:
        if self.waiting:
            for window in pack([len(p[2]) for p in self.waiting], self.capacity):
                self._sequence([self.waiting[i] for i in window])
        self.waiting, self.room = [], self.most

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _NAMES)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    path = tokenizer or default_path()
    read = id_text(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        packer = _Packer(capacity, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                packer.add(doc_id.as_py(), np.append(encode(text.as_py(), path), np.uint32(END_ID)))
                if len(packer.rows) >= 2000:
                    yield packer.batch()
        packer.close()
        if packer.rows:
            yield packer.batch()

    return read.mapInArrow(run, SCHEMA)
