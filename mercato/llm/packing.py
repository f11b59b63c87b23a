"""Operator 1: packing of documents into training sequences by multiway
differencing (Karmarkar and Karp).

Every document becomes its token ids plus one end id. Whole windows of a long
document are sequences of their own; what is left of each document is collected
until a group holds ``windows`` windows of ids. Differencing then spreads the
rests of the group over its windows: it starts with one partial partition per
rest (one part holds it, the others are empty), keeps them in a heap by
imbalance, and merges the two with the largest imbalances so that the heavy
parts of one meet the light parts of the other. The last partition has windows
of nearly equal length. Documents may be cut, so the few ids by which a window
exceeds its capacity are cut off its last rest and moved to windows with room;
the number of windows starts at the least that could do and rises whenever
capacity is exceeded still.

Everything happens in the task that has read the documents: texts and ids are
never shuffled, a task holds one group at a time, and no key can be hot. Only
the last group of a task has padding (under one window a task). The pieces are
checkpointed once, so that sequence ids can be made dense by the counts of the
partitions (one row a partition) and a lost executor cannot change them.

Defined results: null text is an empty document of one id (the end id); texts of
any length are packed whole; repeated rows and repeated or null doc_ids are
packed as documents of their own; other columns are ignored; an empty table
gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.bpe import TEXTS_AT_ONCE, stage_bpe, word_bpe
from mercato.llm.common import gives_back, id_and_text, materialize

CAPACITY = 2048
#: Windows of a group.
WINDOWS = 32
END_ID = 1

PIECES = "part int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, local_sequence long, offset long, ids binary"


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indexes of ``sizes`` in ``k`` parts of nearly equal sums."""
    if k == 1 or not sizes:
        return [list(range(len(sizes)))] + [[] for _ in range(k - 1)]
    heap = [(-x, n, [0] * (k - 1) + [x], [()] * (k - 1) + [(n,)]) for n, x in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        # sums ascend in both: the heaviest part of one meets the lightest of the other
        merged = sorted(zip(map(int.__add__, a, reversed(b)), zip(in_a, reversed(in_b))), key=lambda m: m[0])
        low = merged[0][0]
        heapq.heappush(heap, (low - merged[-1][0], made, [x - low for x, _ in merged], [m for _, m in merged]))
        made += 1
    return [list(_leaves(m)) for m in heap[0][3]]


def _leaves(tree) -> Iterator[int]:
    todo = [tree]
    while todo:
        t = todo.pop()
        if isinstance(t, tuple):
            todo.extend(t)
        else:
            yield t


def fill_windows(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (index, from, length) over the given rests."""
    total = sum(sizes)
    k = max(1, total // capacity)
    while True:
        windows = [[(i, 0, sizes[i]) for i in sorted(part)] for part in differencing(sizes, k)]
        room = [capacity - sum(n for _, _, n in w) for w in windows]
        free = [w for w in range(k) if room[w] > 0]
        for w in range(k):
            while room[w] < 0 and free:
                i, at, n = windows[w].pop()
                to = free[-1]
                moved = min(n, -room[w], room[to])
                windows[to].append((i, at + n - moved, moved))
                if n > moved:
                    windows[w].append((i, at, n - moved))
                room[w] += moved
                room[to] -= moved
                if not room[to]:
                    free.pop()
        if min(room) >= 0:
            return windows
        k += 1  # capacity is exceeded: one window more


class _Packer:
    """Pieces of one task."""

    def __init__(self, part: int, capacity: int, windows: int):
        self.part, self.capacity, self.full = part, capacity, windows * capacity
        self.sequences = 0
        self.rests: list[tuple] = []
        self.held = 0
        self.rows: list[tuple] = []

    def _emit(self, doc, ids: bytes, start: int, at: int, n: int, total: int, offset: int) -> None:
        own = ids[4 * at : 4 * (at + n)]
        self.rows.append((self.part, doc, start + at, n, zlib.crc32(own), total, self.sequences, offset, own))

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for at in range(0, whole, self.capacity):
            self._emit(doc, ids, 0, at, self.capacity, total, 0)
            self.sequences += 1
        at = whole
        while at < total:
            n = min(total - at, self.full - self.held)
            self.rests.append((doc, ids[4 * at : 4 * (at + n)], at, n, total))
            self.held += n
            at += n
            if self.held == self.full:
                self.flush()

    def flush(self) -> None:
        if not self.rests:
            return
        for window in fill_windows([r[3] for r in self.rests], self.capacity):
            offset = 0
            for i, at, n in window:
                doc, ids, start, _, total = self.rests[i]
                self._emit(doc, ids, start, at, n, total, offset)
                offset += n
            self.sequences += bool(window)
        self.rests, self.held = [], 0

    def taken(self, with_ids: bool) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [()] * 9
        self.rows = []
        kinds = [pa.int32(), *[pa.int64()] * 7, pa.binary()]
        if not with_ids:
            cols[8] = [None] * len(cols[0])
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[c.split()[0] for c in PIECES.split(", ")])


def pack(docs: DataFrame, vocab_path: str, capacity: int = CAPACITY, windows: int = WINDOWS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, most_words: int | None = None, rows_at_once: int = 4096, letters_at_once: int = TEXTS_AT_ONCE) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset) and, on request, the piece's ids as little-endian
    unsigned 32-bit integers. Sequence ids run from 0 without gaps. A worker encodes
    ``rows_at_once`` texts or some ``letters_at_once`` bytes of text at a time and keeps the
    ids of up to ``most_words`` words, if given, and only for this stage: fewer take
    less memory and more time."""
    end = END_ID.to_bytes(4, "little")

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(vocab_path) if most_words is None else stage_bpe(vocab_path, most_words)
        packer = _Packer(TaskContext.get().partitionId(), capacity, windows)
        for b in batches:
            for lo in range(0, b.num_rows, rows_at_once):
                part = b.slice(lo, rows_at_once)
                ids = bpe.encode_many(part.column(1), letters_at_once)
                for doc, own in zip(part.column(0).to_pylist(), ids):
                    packer.add(doc, own + end)
                yield packer.taken(with_ids)
        packer.flush()
        yield packer.taken(with_ids)

    pieces = id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES)
    pieces = materialize(pieces if with_ids else pieces.drop("ids"))
    counts = pieces.groupBy("part").agg((F.max("local_sequence") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition of the input: small whatever the data
    first = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    out = pieces.join(F.broadcast(first), "part").withColumn("sequence_id", F.col("first") + F.col("local_sequence"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
