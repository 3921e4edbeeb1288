"""Near-duplicate documents by SetSketch registers, joint likelihood and exact verification.

A document is the set of its distinct five-word shingles. Its sketch holds ``M`` registers: the
least of a hash over the set, seen as an exponential variate of the set's size and truncated to
an exponentially spaced grid (base ``B``). Registers of a union are the larger ones of the parts,
and two sets agree in a register with a probability that follows their Jaccard similarity.

1. Rows with equal sets form a class (128-bit key); its smallest id stands for it from here on, so
   a class of any number of copies is one node of the link graph.
2. Registers are banded by ``ROWS``; classes that share a band value are candidates. At a
   similarity of 0.8 a pair is missed with a probability of 4e-7, at 0.85 of 1e-9 (``BANDS`` bands).
3. A band value of at most ``SMALL`` classes gives its pairs, a larger one a star.
4. The joint likelihood of two sketches, with the exact set sizes, drops pairs whose best
   similarity from the threshold up is e**-18 times less likely than their best at all.
5. What is left is verified on the full sets, and components of verified links are taken.
6. Large band values that still hold several components go, in blocks of bounded rows and
   shingles, through an exact comparison of members of different components, so that no link is
   lost to the star.

Nothing is capped or sampled. Links, components and sketches stay in tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import chunks, mix, released, signed, text_buffers, word_hashes
from .common import Scratch
from .components import components

WORDS = 5
ROWS, BANDS = 4, 28
M = ROWS * BANDS
A, B, Q = 20.0, 1.001, 65534
SMALL, BLOCK = 16, 512
FEW, SLICE, MEMBERS = 32, 4096, 1 << 21
CHUNK = 1 << 20
MARGIN = 18.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_RNG = np.random.Generator(np.random.PCG64(8))
_STEPS = _RNG.integers(0, 1 << 64, WORDS, dtype=np.uint64) | np.uint64(1)
_SHORT = np.uint64(int(_RNG.integers(1, 1 << 62)))
_XOR = _RNG.integers(0, 1 << 64, M, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 64, M, dtype=np.uint64) | np.uint64(1)
_BAND_STEPS = _RNG.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_SEED = _RNG.integers(0, 1 << 64, BANDS, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text: n + 1 offsets and the values.

    Fewer than five words make one shingle of all of them; no words, an empty set.
    """
    n, size = len(offsets) - 1, len(data)
    if not size:
        return np.zeros(n + 1, np.int64), np.empty(0, np.uint64)
    low = _LOWER[data]
    white = _WHITE[low]
    apart = np.zeros(size, bool)
    apart[1:] = white[:-1]
    apart[offsets[:-1][offsets[:-1] < size]] = True
    begin = np.flatnonzero(~white & apart)
    apart[:-1] = white[1:]
    apart[-1] = False
    cut = offsets[1:][offsets[1:] > 0] - 1
    apart[cut] = True
    end = np.flatnonzero(~white & apart) + 1
    word = word_hashes(low, begin, end)
    bounds = np.searchsorted(begin, offsets)
    words, m = np.diff(bounds), len(begin)
    count = np.where(words >= WORDS, words - WORDS + 1, np.minimum(words, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    values = np.empty(at[-1], np.uint64)
    long = np.repeat(words >= WORDS, count)
    if m >= WORDS:
        owner, rest = np.repeat(np.arange(n), words), m - WORDS + 1
        rolled = word[:rest] * _STEPS[0]
        for k in range(1, WORDS):
            rolled += word[k : rest + k] * _STEPS[k]
        values[long] = mix(rolled[owner[:rest] == owner[WORDS - 1 :]])
    few = np.flatnonzero((words > 0) & (words < WORDS))
    if len(few):
        rolled = _SHORT * words[few].astype(np.uint64)
        for k in range(WORDS - 1):
            has = words[few] > k
            rolled[has] += word[bounds[few[has]] + k] * _STEPS[k]
        values[~long] = mix(rolled)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[at[:-1][at[:-1] < len(values)]] = True
    return np.concatenate([[0], np.cumsum(keep)])[at], values[keep]


def set_keys(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set; an empty set has zeros."""
    full = np.flatnonzero(np.diff(at))
    out = []
    for seed in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)):
        key = np.zeros(len(at) - 1, np.uint64)
        if len(full):
            key[full] = mix(np.add.reduceat(mix(values ^ seed), at[full]))
        out.append(key)
    return out[0], out[1]


def registers(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """SetSketch registers (rows by M) of the non-empty sets."""
    starts = at[:-1][np.diff(at) > 0]
    least = np.empty((len(starts), M), np.uint64)
    if len(starts):
        work = np.empty_like(values)
        for k in range(M):
            np.bitwise_xor(values, _XOR[k], out=work)
            np.multiply(work, _ODD[k], out=work)
            least[:, k] = np.minimum.reduceat(work, starts)
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) * 2.0**-64 * (1 - 2.0**-53)) / A
    return np.clip(np.floor(1 - np.log(variate) / np.log(B)), 0, Q + 1).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    cut = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix((cut * _BAND_STEPS).sum(axis=2, dtype=np.uint64) ^ _BAND_SEED)


def log_likelihood(up: np.ndarray, down: np.ndarray, nu: np.ndarray, nv: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of similarity ``j`` given how many registers of u are larger (``up``) and smaller (``down``)."""
    u, v = nu / (nu + nv), nv / (nu + nv)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1.0) * (B - 1) / B) / np.log(B)
    pu, pv = p(u - v * j), p(v - u * j)
    return up * np.log(pu) + down * np.log(pv) + (M - up - down) * np.log(np.maximum(1 - pu - pv, 1e-12))


def plausible(regs_u: np.ndarray, regs_v: np.ndarray, nu: np.ndarray, nv: np.ndarray, num: int, den: int) -> np.ndarray:
    """Pairs whose similarity may reach num / den, by set sizes (exactly) and joint likelihood."""
    up, down = (regs_u > regs_v).sum(axis=1), (regs_u < regs_v).sum(axis=1)
    most = np.minimum(nu, nv) / np.maximum(nu, nv)
    least = num / den
    best, above = np.full(len(nu), -np.inf), np.full(len(nu), -np.inf)
    for step in range(41):
        best = np.maximum(best, log_likelihood(up, down, nu, nv, most * (step / 40)))
        above = np.maximum(above, log_likelihood(up, down, nu, nv, np.minimum(most, least + (1 - least) * (step / 40))))
    return (den * np.minimum(nu, nv) >= num * np.maximum(nu, nv)) & (above >= np.maximum(best, above) - MARGIN)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for a, b in chunks(offsets, CHUNK):
            yield batch.column("doc_id").slice(a, b - a), *shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


_SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, regs binary"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, at, values in _batches(batches):
        size = np.diff(at)
        regs = registers(at, values)
        per = np.where(size > 0, BANDS, 0)
        bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)), pa.array(signed(band_keys(regs).ravel())))
        raw, each = regs.tobytes(), 2 * M
        place = np.cumsum(size > 0) - 1
        blobs = [raw[p * each : (p + 1) * each] if s else b"" for p, s in zip(place.tolist(), size.tolist(), strict=True)]
        k1, k2 = set_keys(at, values)
        yield pa.RecordBatch.from_arrays([ids, pa.array(size.astype(np.int64)), pa.array(signed(k1)), pa.array(signed(k2)), bands, pa.array(blobs, pa.binary())], names=["doc_id", "n_shingles", "k1", "k2", "bands", "regs"])


_SETS = "doc_id long, k1 long, k2 long, n long, members array<long>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, at, values in _batches(batches):
        k1, k2 = set_keys(at, values)
        members = pa.LargeListArray.from_arrays(pa.array(at.astype(np.int64)), pa.array(signed(values))).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array(signed(k1)), pa.array(signed(k2)), pa.array(np.diff(at).astype(np.int64)), members], names=["doc_id", "k1", "k2", "n", "members"])


def _screen(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, M) for c in ("ru", "rv")]
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("nu", "nv")]
            yield batch.select(["u", "v"]).filter(pa.array(plausible(*regs, *sizes, num, den)))

    return run


def common_counts(flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many members each two of ``n`` sets share (``owner``: the set of each member of ``flat``); exact.

    Members of few sets are told pair by pair, those of many by matrix products, a slice of members at a time.
    """
    both = np.zeros((n, n), np.int64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(flat)))
    few = np.repeat(count <= FEW, count) & np.repeat(count > 1, count)
    code, of = np.repeat(np.arange(len(first)), count)[few], owner[few]
    for lag in range(1, FEW):
        near = np.flatnonzero(code[lag:] == code[:-lag]) if lag < len(code) else ()
        if not len(near):
            break
        told, times = np.unique(of[near] * n + of[near + lag], return_counts=True)
        both.ravel()[told] += times
    both += both.T
    many = np.flatnonzero(count > FEW)
    for at in range(0, len(many), SLICE):
        part = many[at : at + SLICE]
        here = np.zeros((n, len(part)), np.float32)
        for k, m in enumerate(part):
            here[owner[first[m] : first[m] + count[m]], k] = 1
        both += (here @ here.T).astype(np.int64)
    return both


def _cross(num: int, den: int):
    """Components of one block pair between whose members there is an exact link."""

    def run(table: pa.Table) -> pa.Table:
        own = table.column("component").to_numpy()
        comp = own.copy()
        fresh = table.column("minor").to_numpy(zero_copy_only=False)
        members = table.column("members")
        size = np.concatenate([pc.list_value_length(c).to_numpy() for c in members.chunks]).astype(np.int64)
        both = common_counts(np.concatenate([c.flatten().to_numpy() for c in members.chunks]), np.repeat(np.arange(len(size)), size), len(size))
        linked = den * both >= num * (size[:, None] + size[None] - both)
        links = []
        for i in np.flatnonzero(fresh):
            while len(left := np.flatnonzero(linked[i] & (comp != comp[i]))):
                links.append((own[i], own[left[0]]))
                comp[comp == comp[left[0]]] = comp[i]
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``.

    Two documents are linked where ``den * |intersection| >= num * |union|`` of their shingle
    sets; ``component_id`` is the smallest ``doc_id`` that links reach, ``kept`` says that it is
    the row's own. Defined cases: a text that is null, empty or without words has an empty set
    and no link; repeated rows and rows of equal sets are one class and share the component;
    rows that share a ``doc_id`` are one document; a null ``doc_id`` is never linked, has a null
    component and is kept; further columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = scratch.save(narrow.mapInArrow(lambda b: released(_sketch(b)), _SKETCH), "sketch")
    able = sketch.where("doc_id is not null and n_shingles > 0")
    classes = able.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    classes = scratch.save(classes, "classes")
    # an id that stands in several classes joins them
    several = able.select("doc_id", "k1", "k2").distinct().groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    several = scratch.save(able.select("doc_id", "k1", "k2").join(several, "doc_id").join(classes, ["k1", "k2"]).select("doc_id", "rep").distinct(), "several")
    joined = several.join(several.groupBy("doc_id").agg(F.min("rep").alias("u")), "doc_id").select("u", F.col("rep").alias("v")).where("u <> v")
    joined = scratch.save(joined.distinct(), "joined")
    own = able.join(classes.select("k1", "k2", F.col("rep").alias("doc_id")), ["k1", "k2", "doc_id"])
    regs = own.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "regs").dropDuplicates(["id", "n"])
    rows = own.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("size"), F.explode("bands").alias("key"))
    buckets = (rows.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("key", "id").alias("h"), "id")).alias("hub"))
               .where("n > 1").select("key", "n", F.col("hub.id").alias("hub")))
    shared = scratch.save(rows.join(buckets, "key"), "shared")
    small = (shared.where(F.col("n") <= SMALL).groupBy("key").agg(F.collect_set("id").alias("ids"))
             .select(F.explode(F.expr("flatten(transform(ids, a -> transform(filter(ids, b -> b > a), b -> struct(a as u, b as v))))")).alias("p"))
             .select("p.u", "p.v"))
    large = shared.where((F.col("n") > SMALL) & (F.col("id") != F.col("hub"))).select(F.least("id", "hub").alias("u"), F.greatest("id", "hub").alias("v"))
    pairs = small.union(large).distinct()
    side = lambda c: regs.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("regs").alias(f"r{c}"))
    likely = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "nu", "nv", "ru", "rv").mapInArrow(_screen(num, den), "u long, v long")
    likely = scratch.save(likely.distinct(), "likely")

    crowd = shared.where(F.col("n") > SMALL).select("id").distinct()
    needed = likely.select(F.col("u").alias("id")).union(likely.select(F.col("v").alias("id"))).union(crowd).distinct()
    reps = classes.join(needed, classes["rep"] == needed["id"], "left_semi").select(F.col("rep").alias("doc_id"), "k1", "k2")
    texts = narrow.join(reps.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = texts.mapInArrow(lambda b: released(_sets(b)), _SETS).join(reps, ["doc_id", "k1", "k2"], "left_semi")
    sets = scratch.save(sets.select(F.col("doc_id").alias("id"), "k1", "k2", "n", "members").dropDuplicates(["id", "k1", "k2"]), "sets").select("id", "n", "members")
    end = lambda c: sets.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("members").alias(f"m{c}"))
    both = F.size(F.array_intersect("mu", "mv"))
    verified = (likely.join(end("u"), "u").join(end("v"), "v").withColumn("both", both)
                .where(f"{den} * both >= {num} * (nu + nv - both)").select("u", "v"))
    verified = scratch.save(verified.distinct(), "verified")
    found = components(scratch, joined.union(verified), "first")

    # large band values that still hold several components: an exact comparison, in blocks
    crowded = (shared.where(F.col("n") > SMALL).groupBy("key", "id").agg(F.max("size").alias("size"))
               .join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    crowded = scratch.save(crowded, "crowded")
    parts = crowded.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / MEMBERS)).cast("int")
    mixed = (parts.groupBy("key").agg(F.max(F.struct("n", "component", "size")).alias("top"), F.sum("n").alias("all"), F.sum("size").alias("size"), F.count("*").alias("parts")).where("parts > 1")
             .select("key", F.col("top.component").alias("main"), blocks(F.col("top.n"), F.col("top.size")).alias("nmain"),
                     blocks(F.col("all") - F.col("top.n"), F.col("size") - F.col("top.size")).alias("nrest")))
    mixed = scratch.save(mixed, "mixed")
    merged = None
    if not mixed.isEmpty():
        dealt = crowded.join(mixed, "key").withColumn("minor", F.col("component") != F.col("main"))
        dealt = dealt.withColumn("block", F.when(F.col("minor"), F.col("nmain") + F.pmod(F.xxhash64("id"), F.col("nrest"))).otherwise(F.pmod(F.xxhash64("id"), F.col("nmain"))))
        dealt = dealt.withColumn("other", F.explode(F.when(F.col("minor"), F.sequence(F.lit(0), F.col("nmain") + F.col("nrest") - 1)).otherwise(F.sequence("nmain", F.col("nmain") + F.col("nrest") - 1))))
        dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "component", "minor")
        crossed = dealt.join(sets, "id").groupBy("key", "i", "j").applyInArrow(_cross(num, den), "u long, v long")
        merged = components(scratch, scratch.save(crossed.distinct(), "crossed"), "last")
    named = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("k1"))
    of_class = classes.join(found, F.col("rep") == F.col("node"), "left").select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.coalesce("component", "rep").alias("class_component"))
    if merged is not None:
        merged = merged.withColumnRenamed("component", "whole")
        of_class = of_class.join(merged, F.col("class_component") == F.col("node"), "left").select("c1", "c2", F.coalesce("whole", "class_component").alias("class_component"))
    out = sketch.select("doc_id", "n_shingles", named.alias("k1"), "k2").join(of_class, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    component = F.coalesce("class_component", "doc_id")
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    out = scratch.save(out, "judged")
    scratch.drop("sketch", "shared", "likely", "sets", "crowded", "mixed", "verified", "crossed", "classes", "several", "joined", "first-components", "last-components")
    return out


def keep_one(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with all their columns.

    Rows that share a ``doc_id`` are one document: of those of a kept id the one with the smallest
    hash of its text stays; rows with a null id all stay.
    """
    judged = near_duplicates(docs, num, den)
    gone = judged.where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    twice = Scratch(docs.sparkSession, "neardup-ids").save(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return left
    single = left.join(twice, "doc_id", "left_anti")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text", *[F.col(c).cast("string") for c in docs.columns])
    one = left.join(twice, "doc_id", "left_semi").withColumn("__nth", F.row_number().over(order)).where("__nth = 1").drop("__nth")
    return single.unionByName(one).select(*docs.columns)
