"""URL filters: rules first, then a list of canonical URLs behind a blocked Bloom filter.

A listed entry ``host/path`` covers the host with its subdomains, and the path if it ends there
or, for an entry that ends in ``/``, everything below. A URL therefore equals an entry in one of
its expansions (host suffixes by path prefixes). All expansions of a URL are probed in the
filter; only URLs with a possible hit are exploded and joined exactly with the list, which
removes the filter's false positives. The filter has 512-bit blocks with one bit in each of
eight words, 16 bits for an entry however long the list. It is broadcast up to ``MAX_BLOCKS``
blocks; a larger one stays a table, dealt by the block's number, which the expansions meet by an
equi-join on their block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Blocks of 64 bytes: a filter that is broadcast has at most 8 MB; a larger one is joined.
MAX_BLOCKS = 1 << 17
BITS_PER_ENTRY = 16

# Fixed values of the contract: rules as (host and path, verdict).
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))

# Listed canonical URLs, site names by top-level domain.
LISTED = tuple(f"{name}.example.{top}/" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(%s, %s)" % ("__url", "instr(__url, '://') + 3"))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _by_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column, value: int) -> Column:
    """The longest fitting rule's text (0) or verdict (1); rules are few and given, so one CASE holds them."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, _, below = rule[0].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + below)
        out = F.when(fits, rule[value]) if out is None else out.when(fits, rule[value])
    return F.lit(None).cast("string") if out is None else out


def expansions(host: Column, path: Column) -> Column:
    """Every ``suffix of the host`` + ``prefix of the path`` that an entry could equal."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), r"\.+$", "")
    labels = F.split(bare, r"\.")
    hosts = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
    steps = F.split(F.when(path == "", "/").otherwise(path), "/")
    prefixes = F.transform(steps, lambda _, i: F.array_join(F.slice(steps, F.lit(1), i + 1), "/"))
    below = F.transform(F.slice(prefixes, F.lit(1), F.size(prefixes) - 1), lambda p: F.concat(p, F.lit("/")))
    paths = F.array_distinct(F.concat(below, F.array(F.when(path == "", "/").otherwise(path))))
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))


def canonical(entry: Column) -> Column:
    """An entry's canonical form: no scheme, lower-case host, at least the path ``/``."""
    bare = F.regexp_replace(F.trim(entry), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.translate(F.regexp_extract(bare, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(bare, "^[^/?#]*([^?#]*)", 1)
    return F.concat(host, F.when(path == "", "/").otherwise(path))


def _hashes(form: Column) -> tuple[Column, Column]:
    return F.xxhash64(form), F.xxhash64(form, F.lit(1))


def filter_blocks(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter as a table ``(at, w0 .. w7)``: its blocks that have a bit set."""
    h1, h2 = _hashes(F.col(column))
    word = lambda w: F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h2, {6 * w}) & 63 as int))")).alias(f"w{w}")
    return keys.select(h1.alias("h1"), h2.alias("h2")).withColumn("at", F.expr(f"h1 & {blocks - 1}")).groupBy("at").agg(*[word(w) for w in range(8)])


class BlockedBloom:
    """A filter in memory: ``blocks`` blocks of eight words."""

    def __init__(self, table: DataFrame, blocks: int):
        self.blocks = blocks
        self.words = np.zeros((blocks, 8), np.int64)
        for row in table.collect():  # at most ``blocks`` rows
            self.words[row["at"]] = [row[f"w{w}"] for w in range(8)]

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        block = self.words.view(np.uint64)[h1 & (self.blocks - 1)]
        hit = np.ones(len(h1), bool)
        for w in range(8):
            bit = (h2.view(np.uint64) >> np.uint64(6 * w)) & np.uint64(63)
            hit &= ((block[:, w] >> bit) & np.uint64(1)).astype(bool)
        return hit


def possible_hits(spread: DataFrame, entries: DataFrame, scratch: Scratch, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``(__key, form)`` of rows ``(__key, forms)`` and forms that pass the filter of ``entries(entry)``."""
    spark = spread.sparkSession
    want = max(1, -(-entries.count() * BITS_PER_ENTRY // 512))
    blocks = 1 << (want - 1).bit_length()
    table = filter_blocks(entries, "entry", blocks)
    if blocks <= max_blocks:
        bloom = spark.sparkContext.broadcast(BlockedBloom(table, blocks))
        hashed = [F.transform("forms", lambda f: _hashes(f)[0]).alias("h1"), F.transform("forms", lambda f: _hashes(f)[1]).alias("h2")]
        return spread.select("__key", "forms", *hashed).mapInArrow(_prober(bloom), "__key string, form string")
    table = scratch.save(table, "filter")
    h1, h2 = _hashes(F.col("form"))
    forms = spread.select("__key", F.explode("forms").alias("form")).withColumns({"h2": h2, "of": h1.bitwiseAND(F.lit(blocks - 1))})
    met = forms.join(table, F.col("of") == F.col("at"))
    for w in range(8):
        met = met.where(F.expr(f"shiftrightunsigned(w{w}, cast(shiftrightunsigned(h2, {6 * w}) & 63 as int)) & 1 = 1"))
    return met.select("__key", "form")


def _prober(bloom):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bloom.value
        for batch in batches:
            forms = batch.column("forms")
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (batch.column("h1"), batch.column("h2"))]
            hit = words.probe(*flat) if len(flat[0]) else np.empty(0, bool)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(forms.offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("__key").take(pa.array(owner[hit])), forms.flatten().filter(pa.array(hit))], names=["__key", "form"])

    return run


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row of ``pages(page_id, url, ...)``.

    ``listed(entry)`` holds the blocked URLs in any spelling; its nulls and repeats do not count.
    The verdict is that of the longest fitting rule, else ``block`` if an entry covers the URL and
    ``allow`` if none does; ``listed`` names the longest such entry. A null URL, or one without
    ``://``, has an empty host and path, no rule and the verdict ``allow``; repeated rows and null
    ids are judged each; further columns are ignored; an empty table or list is no special case.
    ``max_blocks``: beyond so many blocks the filter is joined instead of broadcast.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "urlfilter")
    entries = scratch.save(listed.where("entry is not null").select(canonical(F.col("entry")).alias("entry")).where("entry <> '/'").distinct(), "entries")
    judged = pages.select("page_id", F.col("url").cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    judged = judged.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    judged = judged.withColumns({"rule": _by_rule(rules, F.col("host"), F.col("path"), 0), "by_rule": _by_rule(rules, F.col("host"), F.col("path"), 1),
                                 "__key": F.concat("host", "path")})
    spread = judged.where("host <> ''").select("__key", expansions(F.col("host"), F.col("path")).alias("forms"))
    possible = possible_hits(spread, entries, scratch, max_blocks)
    hits = (possible.distinct().join(entries, F.col("form") == F.col("entry")).groupBy("__key")
            .agg(F.max(F.struct(F.length("entry").alias("n"), "entry")).alias("best")).select(F.col("__key").alias("hit_key"), F.col("best.entry").alias("listed")))
    # URLs without a host have no hit; they would all meet on one key
    out = judged.where("host <> ''").join(hits, F.col("__key") == F.col("hit_key"), "left")
    out = out.unionByName(judged.where("host = ''").withColumns({"hit_key": F.lit(None).cast("string"), "listed": F.lit(None).cast("string")}))
    verdict = F.coalesce("by_rule", F.when(F.col("listed").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
