"""Byte-pair merging with a heap of adjacent pairs over a linked list of symbols.

The pair of lowest rank merges first, of equal ranks the leftmost. A merge unlinks the right symbol and pushes the
two pairs that are new; heap entries whose pair is gone are skipped when they come up. A text of n symbols takes
O(n log n), however long it is.

A pair table maps `left << 16 | right` to `rank << 16 | merged`, with symbols below 2 ** 16.
"""

from __future__ import annotations

import ctypes
import gc
from heapq import heapify, heappop, heappush
from sys import getsizeof
from weakref import ref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NO_SYMBOL = 0xFFFF  # stands for characters that are in no vocabulary; it is in no pair
_PLACE = (1 << 32) - 1


def merge(symbols: list[int], pairs: dict[int, int]) -> int:
    """Merge in place and return the number of merges; merged-away places hold -1."""
    end = len(symbols)
    find = pairs.get
    heap = []
    left = symbols[0] if end else -1
    for place in range(end - 1):
        right = symbols[place + 1]
        found = find(left << 16 | right)
        if found is not None:
            heap.append((found >> 16) << 32 | place)
        left = right
    if not heap:
        return 0
    heapify(heap)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        place = entry & _PLACE
        symbol, gone = symbols[place], after[place]
        if symbol < 0 or gone >= end:
            continue
        found = find(symbol << 16 | symbols[gone])
        if found is None or found >> 16 != entry >> 32:
            continue
        merged = found & 0xFFFF
        symbols[place], symbols[gone] = merged, -1
        merges += 1
        following = after[place] = after[gone]
        if following < end:
            before[following] = place
            found = find(merged << 16 | symbols[following])
            if found is not None:
                heappush(heap, (found >> 16) << 32 | place)
        previous = before[place]
        if previous >= 0:
            found = find(symbols[previous] << 16 | merged)
            if found is not None:
                heappush(heap, (found >> 16) << 32 | previous)
    return merges


def merge_short(symbols: list[int], pairs: dict[int, int]) -> list[int]:
    """The symbols that are left, by searching the list of ranks for the lowest, leftmost pair before every merge.

    The same result as `merge`; faster for sequences of a few dozen symbols, where the search is one built-in call.
    """
    find, never = pairs.get, 1 << 62
    found = [find(left << 16 | right, never) for left, right in zip(symbols, symbols[1:])]
    ranks = [pair >> 16 for pair in found]
    while ranks:
        lowest = min(ranks)
        if lowest == never >> 16:
            break
        place = ranks.index(lowest)
        merged = symbols[place] = found[place] & 0xFFFF
        del symbols[place + 1], ranks[place], found[place]
        if place < len(ranks):
            pair = found[place] = find(merged << 16 | symbols[place + 1], never)
            ranks[place] = pair >> 16
        if place:
            pair = found[place - 1] = find(symbols[place - 1] << 16 | merged, never)
            ranks[place - 1] = pair >> 16
    return symbols


class Remembered(dict):
    """What `compute` gives for each key, until `trim` finds more than `most_bytes` held and begins anew.

    Between two calls of `trim` every distinct key is computed once, whatever its length. Results do not depend on what
    is held.
    """

    ENTRY = 110  # bytes of a dictionary entry, besides key and value
    _live: list[ref] = []

    def __init__(self, compute, most_bytes: int = 96 << 20):
        super().__init__()
        self.compute, self.most_bytes, self.bytes, self.left = compute, most_bytes, 0, False
        Remembered._live.append(ref(self))

    def __missing__(self, key):
        value = self.compute(key)
        self.hold(key, value)
        return value

    def hold(self, key, value) -> None:
        if key not in self:
            self.bytes += getsizeof(key) + getsizeof(value) + self.ENTRY
        self[key] = value

    def trim(self) -> None:
        if self.bytes > self.most_bytes:
            self.forget()

    def forget(self) -> None:
        self.clear()
        self.bytes = 0

    @classmethod
    def only(cls, *tables: Remembered) -> None:
        """Empties all other tables of this process: worker processes live on from one operator to the next.

        A table and the model that computes its values refer to each other. When an operator is left, what it held is
        collected at once: the collector would not come by itself, as few objects hold most of the memory.
        """
        others = [table for one in cls._live if (table := one()) is not None and not any(table is k for k in tables)]
        leaving = any(not table.left for table in others)
        for table in others:
            table.forget()
            table.left = True
        for table in tables:
            table.left = False
        if leaving:
            table = others = None
            gc.collect()
        cls._live = [one for one in cls._live if one() is not None]


def begin_task(*tables: Remembered) -> None:
    """At the start of a task in a worker process that has served other operators: only these tables stay, and memory
    that Arrow holds on to goes back to the system."""
    Remembered.only(*tables)
    give_back()


def give_back() -> None:
    """Hand memory that is free in this process back to the system; at the end of a task, as workers stay and wait."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps what was freed; others have no such call
    if trim is not None:
        trim(0)


PORTION_BYTES = 4 << 20


def portions(texts: list[str]):
    """The texts in turn, in lists of some PORTION_BYTES, or of one text that is longer."""
    start = held = 0
    for at, text in enumerate(texts):
        if held and held + len(text) > PORTION_BYTES:
            yield texts[start:at]
            start, held = at, 0
        held += len(text)
    if start < len(texts):
        yield texts[start:]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = PORTION_BYTES):
    """The rows of a batch in turn, in slices whose texts hold some `most_bytes`, or of one row that is longer. Unlike
    `portions` of a list, this needs no more texts as strings than those of a slice."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = held = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, held + most_bytes, "right")))
        yield batch.slice(start, end - start)
        start, held = end, int(ends[end - 1])
