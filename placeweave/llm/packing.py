"""Packing token pieces into fixed windows by Karmarkar-Karp multiway differencing.

Each task packs the documents of its own partition, so nothing is shuffled and memory holds one
group of about ``GROUP_WINDOWS`` windows.  A document gives as many full windows as it has; what is
left is one piece, or for a few documents small pieces, and a group's pieces are dealt into m windows: each
piece starts as a partial partition of its own, the two partial partitions with the largest
imbalance are merged by laying the fullest windows of one on the emptiest of the other, until one
is left.  m starts at the least number that can hold the group and rises while a window exceeds the
capacity.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import insort
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import encoder, strings
from .shared import small_batches

WINDOW, GROUP_WINDOWS = 2048, 256
#: Bytes of a generation of each of the encoder's caches, which idle workers hold while a later stage runs beside them.
CACHE_BYTES = 24 << 20
#: The remainder of every so many-th document is cut into pieces of at most FILLER ids, which even
#: out the windows; the other remainders stay whole.
FILLER, FILLER_EVERY = 64, 6
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """Deal items of the given sizes into m windows with near-equal sums; items by their positions.

    A partial partition is kept sparse, as its non-empty windows (minus fill, tie, items), the fullest
    first.  Items are leaves of a tree that a merge of two windows grows by one node.
    """
    if m <= 0 or not sizes:
        return [[] for _ in range(max(m, 0))]
    tick = len(sizes)
    heap = [(-s if m > 1 else 0, i, [(-s, i, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        if len(a) < len(b):
            a, b = b, a
        if len(b) == 1:  # one item onto an empty window, or onto the emptiest
            fill, _, items = b[0]
            if len(a) == m:
                least = a.pop()
                fill, items = fill + least[0], (least[2], items)
            insort(a, (fill, tick, items))
            merged = a
        else:
            # The fullest windows of one meet the emptiest of the other.
            over = max(0, len(a) + len(b) - m)
            tail = len(a) - over
            met = [(x[0] + y[0], tick, (x[2], y[2])) for x, y in zip(a[tail:], reversed(b[len(b) - over :]))]
            merged = a[:tail] + met + b[: len(b) - over]
            merged.sort(key=itemgetter(0))
        spread = (merged[-1][0] if len(merged) == m else 0) - merged[0][0]
        heapq.heapreplace(heap, (-spread, tick, merged))
        tick += 1
    out: list[list[int]] = []
    for _, _, node in heap[0][2]:
        items, stack = [], [node]
        while stack:
            node = stack.pop()
            if len(node) == 1:
                items.append(node[0])
            else:
                stack += node
        out.append(sorted(items))
    return out + [[] for _ in range(m - len(out))]


def windows(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """Items of at most ``capacity`` in as few near-equal windows as differencing can hold them in."""
    m = -(-sum(sizes) // capacity)
    while True:
        dealt = differencing(sizes, m)
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return [w for w in dealt if w]
        m += 1


class Packer:
    """Collects documents and gives back (document, start, length, sequence, offset) when a group is full."""

    def __init__(self, capacity: int = WINDOW, group_windows: int = GROUP_WINDOWS):
        self.capacity, self.room = capacity, group_windows * capacity
        self.sequence = self.documents = 0
        self.left: list[tuple[int, int, int]] = []
        self.held = 0

    def add(self, doc: int, tokens: int) -> list[tuple[int, int, int, int, int]]:
        out, at = [], 0
        while tokens - at >= self.capacity:
            out.append((doc, at, self.capacity, self.sequence, 0))
            self.sequence, at = self.sequence + 1, at + self.capacity
        self.documents += 1
        piece = FILLER if self.documents % FILLER_EVERY == 0 else self.capacity
        while at < tokens:
            n = min(piece, tokens - at)
            self.left.append((doc, at, n))
            self.held, at = self.held + n, at + n
        return out

    @property
    def full(self) -> bool:
        return self.held >= self.room

    def deal(self) -> list[tuple[int, int, int, int, int]]:
        out = []
        for window in windows([n for _, _, n in self.left], self.capacity):
            offset = 0
            for i in window:
                doc, start, n = self.left[i]
                out.append((doc, start, n, self.sequence, offset))
                offset += n
            self.sequence += 1
        self.left, self.held = [], 0
        return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): ``PIECES``, and with ``with_ids`` the ids (uint32 bytes).

    A null text is empty; every document ends with ``end_id``, so each has a piece.  Identifiers may
    be null or repeated: each row is a document of its own.  Sequence numbers are unique (partition
    number times 2**40 plus a count); an empty table gives no rows.
    """

    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")] + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, keeps_space=False, cache_bytes=CACHE_BYTES), np.array([end_id], dtype="<u4").tobytes()
        packer, base = Packer(capacity), TaskContext.get().partitionId() << 40
        held: dict[int, tuple] = {}
        number, ready = 0, []

        def rows(found: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
            out = []
            for doc, start, n, sequence, offset in found:
                doc_id, ids = held[doc]
                part = ids[4 * start : 4 * (start + n)]
                row = (doc_id, start, n, zlib.crc32(part), len(ids) // 4, base + sequence, offset)
                out.append((*row, part) if with_ids else row)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encode.encode(strings(batch.column("text")))):
                held[number] = (doc_id, found + end)
                ready += packer.add(number, len(found) // 4 + 1)
                number += 1
                if packer.full or len(ready) >= GROUP_WINDOWS:
                    yield rows(ready + packer.deal())
                    ready = []
                    held.clear()
        if ready or packer.left:
            yield rows(ready + packer.deal())

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)
