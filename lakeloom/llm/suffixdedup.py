"""Removal of long repeated byte strings, by external induced suffix sorting of content-cut shards.

The whole corpus is one string set, yet only places that can repeat need sorting. Every window
of ``length`` bytes is owned by the leftmost least-hashed 24-byte gram inside it, so equal windows
are owned alike wherever they stand. Windows of one owner are cut into cells by their offset to
it; all windows of a cell contain its core, and equal windows lie in cells of equal cores.

1. Each document emits its cells: a name of the core, a fingerprint of the cell's whole context
   (both of two 61-bit polynomials modulo a prime), and where it is. One pass, about one row for
   90 bytes.
2. Cells whose core occurs once hold no repeat. Cells whose whole context occurs again are
   repeats in all their windows. Both are settled by counting, which no hot passage can skew.
3. What is left are the edges of repeats: cores that recur between different neighbours. One
   string ``left + CORE + right`` for each different context goes to the shard of its core, and
   ``suffixsort`` sorts all their suffixes and finds the windows with a common prefix of
   ``length``. Shards are cut by content, so no repeat spans two of them, and a shard may be far
   larger than memory: what grows with it lies in files, beside Spark's own spills.
4. Ranges return to their documents, whose remaining bytes are hashed (or kept as a text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import Fingerprints, chunks, grams, mix, signed, text_buffers
from .common import Scratch, partitions, row_key
from .suffixsort import InducedSorter

LENGTH = 400
GRAM = 24
CHUNK = 1 << 20


def _sliding_least(h: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` neighbours, by running minima of blocks from both sides."""
    n = len(h)
    size = -(-n // w) * w
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def owned(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Runs of windows of one owner: owner, first and last window start; no run spans two texts."""
    size, w = len(data), length - GRAM + 1
    if size < length:
        return None
    valid = np.zeros(size - length + 2, np.int64)
    begin, end = offsets[:-1], offsets[1:] - length + 1
    some = end > begin
    if not some.any():
        return None
    np.add.at(valid, begin[some], 1)
    np.add.at(valid, end[some], -1)
    valid = np.cumsum(valid[:-1]) > 0
    h = grams(data, GRAM)
    least = _sliding_least(h, w)
    starts = valid.copy()
    starts[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    starts[begin[some]] = True
    s = np.flatnonzero(starts)
    stops = np.zeros_like(valid)
    stops[:-1] = starts[1:] | ~valid[1:]
    stops[-1] = True
    e = np.flatnonzero(stops & valid)
    p = np.empty(len(s), np.int64)
    for at in range(0, len(s), 4096):
        part = s[at : at + 4096]
        p[at : at + 4096] = part + (h[part[:, None] + np.arange(w)[None]] == least[part][:, None]).argmax(1)
    tied = np.flatnonzero(p < e)
    if len(tied):  # equal grams in one run: each owns the windows from behind the one before it
        keep = np.ones(len(s), bool)
        keep[tied] = False
        parts = [(p[keep], s[keep], e[keep])]
        for r in tied:
            places = s[r] + np.flatnonzero(h[s[r] : e[r] + w] == least[s[r]])
            places = places[: int(np.searchsorted(places, e[r])) + 1]
            lows = np.concatenate([[s[r]], places[:-1] + 1])
            parts.append((places, lows, np.minimum(places, e[r])))
        p, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
    return p, s, e


def cells(data: np.ndarray, offsets: np.ndarray, length: int, span: int) -> dict[str, np.ndarray] | None:
    """Cells with names (k1, k2), context fingerprints (c1, c2), window starts (lo, hi) and core starts (cs)."""
    found = owned(data, offsets, length)
    if found is None:
        return None
    p, s, e = found
    width = span + 1
    low, high = (p - e) // width, (p - s) // width
    count = high - low + 1
    at = np.repeat(np.arange(len(p)), count)
    cell = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + low[at]
    core = p[at] - cell * width
    lo, hi = np.maximum(s[at], core - span), np.minimum(e[at], core)
    end = core - span + length
    shape = mix(((hi - lo) * (1 << 20) + (core - lo)).astype(np.uint64))
    out = {"lo": lo, "hi": hi, "cs": core, "owner": np.searchsorted(offsets, lo, side="right") - 1}
    for family in (0, 1):
        prints = Fingerprints(data, family)
        out[f"k{family + 1}"] = mix(prints.ranges(core, end) + cell.astype(np.uint64))
        out[f"c{family + 1}"] = mix(prints.ranges(lo, hi + length) ^ shape)
    return out


_CELLS = "rk binary, k1 long, k2 long, c1 long, c2 long, lo int, hi int, cs int"


def _emit(length: int, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in chunks(offsets, CHUNK):
                at = offsets[a : b + 1] - offsets[a]
                got = cells(data[offsets[a] : offsets[b]], at, length, span)
                if got is not None:
                    row = got["owner"]
                    base = at[row]
                    yield pa.RecordBatch.from_arrays([batch.column("rk").slice(a, b - a).take(pa.array(row)), *(pa.array(signed(got[c])) for c in ("k1", "k2", "c1", "c2")), *(pa.array((got[c] - base).astype(np.int32)) for c in ("lo", "hi", "cs"))], names=[f.split()[0] for f in _CELLS.split(", ")])

    return run


_STRINGS = "k1 long, k2 long, rk binary, lo int, hi int, cs int, many boolean, left binary, right binary"


def _strings(length: int, span: int):
    """Cuts the bytes around the cores out of the texts that came with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rk, text, places in zip(batch.column("rk").to_pylist(), batch.column("text"), batch.column("places").to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes()
                for x in places:
                    end = x["cs"] - span + length
                    rows.append((x["k1"], x["k2"], rk, x["lo"], x["hi"], x["cs"], x["many"], raw[x["lo"] : x["cs"]], raw[end : x["hi"] + length]))
            kinds = [pa.int64()] * 2 + [pa.binary()] + [pa.int32()] * 3 + [pa.bool_()] + [pa.binary()] * 2
            columns = zip(*rows, strict=True) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in _STRINGS.split(", ")])

    return run


def _shard(length: int, span: int, budget: int):
    """Sorts one shard, whose strings come ordered by core; gives the repeated windows of contexts that occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorter = InducedSorter(span, length - span, budget)
        rk, cs, many = sorter.column(np.uint8, 16), sorter.column(np.int32), sorter.column(bool)
        try:
            for batch in batches:
                if batch.num_rows:
                    sorter.add(batch.column("k1").to_numpy(), batch.column("k2").to_numpy(), batch.column("left").to_pylist(), batch.column("right").to_pylist())
                    rk.append(np.frombuffer(b"".join(batch.column("rk").to_pylist()), np.uint8).reshape(-1, 16))
                    cs.append(batch.column("cs").to_numpy())
                    many.append(batch.column("many").to_numpy(zero_copy_only=False))
            keys, cores, skip = rk.view(), cs.view(), many.view()
            # windows come level by level; a string's run of neighbours goes out when it ends
            since, last = sorter.array(rk.n, np.int32, -1), sorter.array(rk.n, np.int32, -2)

            def ranges(items: np.ndarray) -> pa.RecordBatch:
                names = pa.array([k.tobytes() for k in keys[items]], pa.binary())
                return pa.RecordBatch.from_arrays([names, pa.array((cores[items] - last[items]).astype(np.int32)), pa.array((cores[items] - since[items]).astype(np.int32))], names=["rk", "lo", "hi"])

            for d, items in sorter.repeated():
                items = items[~skip[items] & (last[items] != d)]  # one may be told twice
                broken = items[last[items] != d - 1]
                ended = broken[since[broken] >= 0]
                if len(ended):
                    yield ranges(ended)
                since[broken] = d
                last[items] = d
            for at in range(0, rk.n, sorter.step):
                open_ = at + np.flatnonzero(since[at : at + sorter.step] >= 0)
                if len(open_):
                    yield ranges(open_)
        finally:
            sorter.close()

    return run


def _union(lo: list[int], hi: list[int], length: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(lo, hi, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, lo, hi in zip(batch.column("text"), batch.column("los").to_pylist(), batch.column("his").to_pylist(), strict=True):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                spans = _union(lo, hi, length) if lo else []
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                rows.append((len(raw), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True))], names=[f.split()[0] for f in _DIGEST.split(", ")])

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, budget: int = 64 << 20) -> DataFrame:
    """``rk, lo, hi``: for rows ``(rk, text)`` the starts ``lo`` to ``hi`` of windows that occur elsewhere too.

    ``rk`` (16 bytes) names a row's content; equal rows may share it and then repeat each other.
    """
    if length < 2 * GRAM:
        raise ValueError(f"windows of at least {2 * GRAM} bytes")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixdedup")
    span = (length - GRAM + 1) // 2  # two cells for each owner; the core has the rest of a window
    rows = scratch.save(docs.select("rk", "text").where("text is not null").mapInArrow(_emit(length, span), _CELLS), "cells")
    # tables of their own, so that the joins that follow stand on plain exchanges, whose hot partitions Spark can split
    twice = scratch.save(rows.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2"), "twice")
    live = scratch.save(rows.join(twice, ["k1", "k2"]), "live")
    scratch.drop("cells", "twice")
    place = F.struct("rk", "lo", "hi", "cs")
    contexts = scratch.save(live.groupBy("k1", "k2", "c1", "c2").agg(F.count("*").alias("n"), F.min(place).alias("place")), "contexts")
    full = live.join(contexts.where("n > 1").select("k1", "k2", "c1", "c2"), ["k1", "k2", "c1", "c2"], "left_semi").select("rk", "lo", "hi")
    mixed = scratch.save(contexts.groupBy("k1", "k2").agg(F.count("*").alias("v")).where("v > 1").select("k1", "k2"), "mixed")
    edges = contexts.join(mixed, ["k1", "k2"]).select("place.rk", F.struct("k1", "k2", "place.lo", "place.hi", "place.cs", (F.col("n") > 1).alias("many")).alias("at"))
    edges = scratch.save(edges.groupBy("rk").agg(F.collect_list("at").alias("places")), "edges")
    strings = docs.select("rk", "text").join(edges, "rk").select("rk", "text", "places").mapInArrow(_strings(length, span), _STRINGS)
    shards = strings.repartition(partitions(spark), "k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(_shard(length, span, budget), "rk binary, lo int, hi int")
    return full.unionByName(scratch.save(shards, "sorted"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, budget: int = 64 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs(doc_id, text, ...)``.

    Every byte is removed that lies in a string of ``length`` bytes starting anywhere else as well,
    in the same text or another; strings never cross texts and are judged on the input. A null text
    counts as empty; texts shorter than ``length`` keep all; repeated rows repeat each other and
    lose such strings alike; null ids are judged like others; further columns are ignored; no rows
    give no rows. ``budget``: bytes of memory for one shard's sort before it goes to disk.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("rk", row_key("doc_id", "text"))
    ranges = repeated_ranges(narrow, length, budget).groupBy("rk").agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
    ranges = ranges.withColumnRenamed("rk", "of")
    return narrow.join(ranges, F.col("rk") == F.col("of"), "left").select("doc_id", "text", "los", "his").mapInArrow(_digest(length), _DIGEST)
