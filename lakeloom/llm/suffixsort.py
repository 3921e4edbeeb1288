"""External induced sorting of the suffixes of many short strings, with common-prefix lengths.

Every string is ``left + CORE + right``: bytes around one symbol that stands for a long passage
(its name; strings that share a passage share the symbol). All suffixes that start ``t`` symbols
from a string's end form level ``t``. The order of a level is induced from the order of the level
before: tuples (preceding symbol, rank, string, common prefix) go through a queue that gives them
back by symbol, in arrival order. The common prefix of neighbours with the same preceding symbol
is that symbol's length plus the least common prefix seen between them, which the scan carries
per symbol. Levels follow each other from the right ends of the strings to their left ends.

Whatever grows with the strings lives in files beyond a share of ``budget`` bytes: the queue
spills sorted runs and merges them by symbol, level orders are read in chunks, strings, names and
the scan's state of each symbol are memory-mapped. The files lie where Spark spills and end with
the task, which can be run again anywhere.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np

FAR = np.int64(1) << 40
_TUPLE = np.dtype([("symbol", "i8"), ("item", "i8"), ("lcp", "i8")])


class RunQueue:
    """A priority queue of tuples: least symbol first, equal symbols in the order they came."""

    def __init__(self, folder: str, budget: int):
        self.folder, self.budget = folder, max(1, budget // _TUPLE.itemsize)
        self.held: list[np.ndarray] = []
        self.n = 0
        self.runs: list[str] = []

    def push(self, tuples: np.ndarray) -> None:
        """``tuples`` come sorted by symbol."""
        if len(tuples):
            self.held.append(tuples)
            self.n += len(tuples)
            if self.n > self.budget:
                self._spill()

    def _together(self) -> np.ndarray:
        out = np.concatenate(self.held) if self.held else np.empty(0, _TUPLE)
        return out if len(self.held) <= 1 else out[np.argsort(out["symbol"], kind="stable")]

    def _spill(self) -> None:
        handle, path = tempfile.mkstemp(dir=self.folder)
        with os.fdopen(handle, "wb") as out:
            self._together().tofile(out)
        self.runs.append(path)
        self.held, self.n = [], 0

    def drain(self) -> Iterator[np.ndarray]:
        """Chunks of at most about the budget, in queue order; empties the queue."""
        if not self.runs:
            whole = self._together()
            self.held, self.n = [], 0
            for at in range(0, len(whole), self.budget):
                yield whole[at : at + self.budget]
            return
        if self.n:
            self._spill()
        runs = [np.memmap(p, _TUPLE, "r") for p in self.runs]
        at = [0] * len(runs)
        share = max(1, self.budget // len(runs))
        while any(a < len(r) for a, r in zip(at, runs, strict=True)):
            # symbols up to the least of the runs' next limits fit the budget together
            limit = min(int(r["symbol"][min(len(r), a + share) - 1]) for a, r in zip(at, runs, strict=True) if a < len(r))
            below = [a + int(np.searchsorted(r["symbol"][a:], limit)) for a, r in zip(at, runs, strict=True)]
            if below != at:
                part = np.concatenate([r[a:b] for a, b, r in zip(at, below, runs, strict=True)])
                yield part[np.argsort(part["symbol"], kind="stable")]
                at = below
                continue
            for k, r in enumerate(runs):  # one symbol, perhaps larger than the budget: run after run
                end = at[k] + int(np.searchsorted(r["symbol"][at[k] :], limit, side="right"))
                for start in range(at[k], end, self.budget):
                    yield np.array(r[start : min(end, start + self.budget)])
                at[k] = end
        del runs
        for path in self.runs:
            os.unlink(path)
        self.runs = []


class _Column:
    """An append-only column of fixed-width records that moves to a file beyond the budget."""

    def __init__(self, folder: str, dtype, width: int, budget: int):
        self.folder, self.dtype, self.width, self.budget = folder, np.dtype(dtype), width, budget
        self.parts: list[np.ndarray] = []
        self.n, self.path = 0, None

    def append(self, block: np.ndarray) -> None:
        block = np.ascontiguousarray(block, self.dtype)
        self.n += len(block)
        if self.path is None and self.n * self.width * self.dtype.itemsize > self.budget:
            handle, self.path = tempfile.mkstemp(dir=self.folder)
            os.close(handle)
        if self.path is None:
            self.parts.append(block)
            return
        with open(self.path, "ab") as out:
            for part in [*self.parts, block]:
                part.tofile(out)
        self.parts = []

    def view(self) -> np.ndarray:
        shape = (self.n, self.width) if self.width > 1 else (self.n,)
        if self.path is not None:
            return np.memmap(self.path, self.dtype, "r+", shape=shape)
        return np.concatenate(self.parts).reshape(shape) if self.parts else np.empty(shape, self.dtype)

    def close(self) -> None:
        if self.path is not None:
            os.unlink(self.path)


def _filled(n: int, dtype, value: int) -> np.ndarray:
    return np.full(n, value, dtype)


def _induce(order: Iterator[np.ndarray], queue: RunQueue, symbol_of, symbols: int, weight: int, array=_filled) -> None:
    """Pushes the tuples of the next level: for each item its preceding symbol (none: below 0).

    Each symbol keeps the least common prefix since its last tuple up to the end of that tuple's
    chunk, and the chunk's number; the least of every later chunk is applied when it is met again.
    """
    carry = array(symbols, np.int64, -weight)  # nothing before a symbol's first tuple: common prefix 0
    seen = array(symbols, np.int32, -1)
    floors: list[int] = []
    for number, chunk in enumerate(order):
        item, lcp = chunk["item"], chunk["lcp"]
        symbol = symbol_of(item)
        by = np.argsort(symbol, kind="stable")
        by = by[np.searchsorted(symbol[by], 0) :]
        kind = symbol[by]
        since_then = np.append(np.minimum.accumulate(np.array(floors, np.int64)[::-1])[::-1], FAR)  # by the number of the chunk before
        floors.append(int(lcp.min()))
        if not len(by):
            continue
        first = np.ones(len(by), bool)
        first[1:] = kind[1:] != kind[:-1]
        since = np.where(first, 0, np.concatenate([[0], by[:-1] + 1]))
        spans = np.empty(2 * len(by), np.int64)
        spans[::2], spans[1::2] = since, by + 1
        least = np.minimum.reduceat(np.concatenate([lcp, [FAR]]), spans)[::2]
        own = kind[first]
        least[first] = np.minimum(least[first], np.minimum(carry[own], since_then[seen[own] + 1]))
        last = np.flatnonzero(np.concatenate([first[1:], [True]]))
        after = np.concatenate([np.minimum.accumulate(lcp[::-1])[::-1], [FAR]])  # least from here to the end
        carry[kind[last]] = after[by[last] + 1]
        seen[kind[last]] = number
        out = np.empty(len(by), _TUPLE)
        out["symbol"], out["item"], out["lcp"] = kind, item[by], least + weight
        queue.push(out)


class InducedSorter:
    """Collects strings, then tells for each string which of its windows another string has too."""

    def __init__(self, span: int, core: int, budget: int = 64 << 20):
        """``span``: most bytes on either side; ``core``: the symbol's length; windows have ``core + span`` bytes."""
        self.span, self.core, self.budget = span, core, budget
        spills = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]  # none outside Spark
        self.folder = tempfile.mkdtemp(prefix="induce-", dir=spills if spills and os.path.isdir(spills) else None)
        self.step = max(1, budget // 64)
        self.left, self.right = self.column(np.uint8, span), self.column(np.uint8, span)
        self.nleft, self.nright, self.name = self.column(np.int32), self.column(np.int32), self.column(np.int64)
        self.names, self._last = 0, None

    def column(self, dtype, width: int = 1) -> _Column:
        return _Column(self.folder, dtype, width, self.budget // 8)

    def array(self, n: int, dtype, value: int) -> np.ndarray:
        """``n`` times ``value``, in a file beyond a share of the budget."""
        if n * np.dtype(dtype).itemsize <= self.budget // 8:
            return _filled(n, dtype, value)
        handle, path = tempfile.mkstemp(dir=self.folder)
        os.close(handle)
        out = np.memmap(path, dtype, "w+", shape=(n,))
        os.unlink(path)  # the mapping holds it
        for at in range(0, n, self.step):
            out[at : at + self.step] = value
        return out

    def add(self, k1: np.ndarray, k2: np.ndarray, left: list[bytes], right: list[bytes]) -> None:
        """Strings of equal names (k1, k2) follow each other. ``left`` is stored from the symbol outwards, so that column ``d`` is the byte ``d + 1`` before it."""
        w = self.span
        pad = lambda b: b + bytes(w - len(b))
        self.left.append(np.frombuffer(b"".join(pad(b[::-1]) for b in left), np.uint8).reshape(-1, w))
        self.right.append(np.frombuffer(b"".join(map(pad, right)), np.uint8).reshape(-1, w))
        self.nleft.append(np.array([len(b) for b in left]))
        self.nright.append(np.array([len(b) for b in right]))
        fresh = np.ones(len(k1), bool)
        fresh[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        fresh[0] = self._last != (k1[0], k2[0])
        self.name.append(self.names - 1 + np.cumsum(fresh))
        self.names += int(fresh.sum())
        self._last = (k1[-1], k2[-1])

    def repeated(self) -> Iterator[tuple[int, np.ndarray]]:
        """For ``d`` = 0, 1, ...: strings whose window that starts ``d`` bytes before the symbol occurs in another string; one may be told twice."""
        n = self.name.n
        if not n:
            return
        left, right, nleft, nright, name = (c.view() for c in (self.left, self.right, self.nleft, self.nright, self.name))
        queue = RunQueue(self.folder, self.budget // 8)

        def fresh(t: int) -> Iterator[np.ndarray]:
            """The strings that end at level ``t``, in the order of their numbers."""
            for at in range(0, n, self.step):
                found = at + np.flatnonzero(nright[at : at + self.step] == t)
                if len(found):
                    out = np.zeros(len(found), _TUPLE)
                    out["item"] = found
                    yield out

        def level(t: int, order: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
            """The suffixes right[t:], the empty ones first."""
            head = False
            for chunk in fresh(t):
                head = True
                yield chunk
            for chunk in order:
                if head:
                    chunk = chunk.copy()
                    chunk["lcp"][0], head = 0, False
                yield chunk

        for t in range(self.span, 0, -1):
            after = RunQueue(self.folder, self.budget // 8)
            _induce(level(t, queue.drain()), after, lambda item, t=t: right[item, t - 1].astype(np.int64), 256, 1)
            queue = after
        after = RunQueue(self.folder, self.budget // 8)
        _induce(level(0, queue.drain()), after, lambda item: np.asarray(name[item]), self.names, self.core, self.array)
        queue, window = after, self.core + self.span
        for d in range(self.span + 1):
            after = RunQueue(self.folder, self.budget // 8)
            found = self.column(np.int64)

            def watched(order: Iterator[np.ndarray], found: _Column) -> Iterator[np.ndarray]:
                last = None  # the tuple before this chunk
                for chunk in order:
                    hit = chunk["lcp"] >= window
                    if last is not None and hit[0]:
                        found.append(last)
                    both = hit.copy()
                    both[:-1] |= hit[1:]
                    found.append(chunk["item"][both])
                    last = chunk["item"][-1:]
                    yield chunk

            column = min(d, self.span - 1)
            _induce(watched(queue.drain(), found), after, lambda item, d=d, column=column: np.where(nleft[item] > d, left[item, column].astype(np.int64), -1), 256, 1)
            queue = after
            told = found.view()
            for at in range(0, found.n, self.step):
                yield d, np.unique(told[at : at + self.step])
            found.close()

    def close(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)
