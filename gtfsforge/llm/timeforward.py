"""Time-forward processing of trees: totals travel from children to parents through a priority queue.

Nodes come in reverse level order (deepest first, then by key).  A node finds
the messages addressed to it at the head of the queue, as all of them come
from one level below; it adds them up and addresses its own total to its
parent.  The queue holds a fixed number of messages in memory; what is more
goes to sorted runs on disk that are merged as they are read, and are gone
when the task ends or dies.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa

#: Messages held in memory, runs open at once, and bytes read from a run at once.
IN_MEMORY, RUNS, READ = 200_000, 16, 1 << 16
_RECORD = struct.Struct("<6q")


class SpillingQueue:
    """A priority queue of tuples of six 64-bit integers, smallest first."""

    def __init__(self, limit: int = IN_MEMORY):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, record: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, record)
        if len(self.heap) > self.limit:
            run, self.heap = sorted(self.heap), []
            self.spilled += len(run)
            self._store(iter(run))
            if len(self.runs) > RUNS:
                old, self.runs = self.runs, []
                self._store(heapq.merge(*[self._rest(head, rest) for head, _, rest in old]))

    def _store(self, records: Iterator[tuple[int, ...]]) -> None:
        f = tempfile.TemporaryFile()  # has no name: nothing stays behind
        for r in records:
            f.write(_RECORD.pack(*r))
        f.seek(0)
        rest = self._read(f)
        heapq.heappush(self.runs, (next(rest), id(rest), rest))

    @staticmethod
    def _read(f) -> Iterator[tuple[int, ...]]:
        with f:
            while block := f.read(READ // _RECORD.size * _RECORD.size):
                yield from _RECORD.iter_unpack(block)

    @staticmethod
    def _rest(head: tuple[int, ...], rest: Iterator) -> Iterator[tuple[int, ...]]:
        yield head
        yield from rest

    def pop_for(self, address: tuple[int, int, int]) -> Iterator[tuple[int, ...]]:
        """Takes the messages whose first three numbers are the address; none before it may be left."""
        while self.heap and self.heap[0][:3] == address:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:3] == address:
            head, key, rest = self.runs[0]
            nxt = next(rest, None)
            if nxt is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (nxt, key, rest))
            yield head


TOTALS = pa.schema(
    [("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("pa", pa.int64()), ("pb", pa.int64()), ("conv_id", pa.int64()), ("n", pa.int64()),
     ("top", pa.bool_()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64())]
)


def subtree_totals(limit: int = IN_MEMORY):
    """Over Arrow batches of nodes in reverse level order: their children, and the leaves and gain of their subtrees.

    A node has its key (depth, ka, kb), its parent's (pa, pb), its own gain, and
    children, leaves and saved: what came from subtrees that are done.  `top`
    nodes address no message, their parents being elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for b in batches:
            names = ("depth", "ka", "kb", "pa", "pb", "top", "gain", "children", "leaves", "saved")
            children_, leaves_, saved_ = [], [], []
            for depth, ka, kb, up_a, up_b, top, gain, children, leaves, saved in zip(*(b.column(c).to_pylist() for c in names)):
                for _, _, _, n, below, total in queue.pop_for((-depth, ka, kb)):
                    children, leaves, saved = children + n, leaves + below, saved + total
                leaves, saved = leaves if children else 1, saved + gain
                if not top:
                    queue.push((1 - depth, up_a, up_b, 1, leaves, saved))
                children_.append(children), leaves_.append(leaves), saved_.append(saved)
            same = [b.column(c) for c in TOTALS.names[:8]]
            yield pa.RecordBatch.from_arrays([*same, *(pa.array(x, pa.int64()) for x in (children_, leaves_, saved_))], schema=TOTALS)

    return run
