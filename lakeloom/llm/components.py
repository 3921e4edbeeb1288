"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: At most so many links are followed to their end by one task (2 MB): a round of contraction costs several jobs, whatever it holds.
LAST = 1 << 17


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links and the smallest node that each reaches; a link's larger root goes below its smaller one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root, a, b = np.arange(len(nodes)), at[: len(u)], at[len(u) :]
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((up := root[root]) != root).any():
            root = up
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[root]


def _last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if links:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in least_nodes(*map(np.concatenate, zip(*links, strict=True)))], names=["node", "component"])


def components(scratch: Scratch, links: DataFrame, tag: str) -> DataFrame:
    """``(node, component)`` for every end of ``links(u, v)``; the component is its smallest node.

    Random-priority contraction: each round hooks a node to the neighbour (or itself) of least
    round-specific hash, then replaces the ends of every link by what they hooked to and drops
    loops and repeats. A constant share of the nodes vanishes in each round whatever the shape of
    the graph, so rounds grow with its logarithm. A hub's neighbours are reduced by partial
    minima, never gathered. Every round is written, so a lost executor repeats one round at most.
    When no more than ``LAST`` links are left, one task ends it. ``links`` is read twice and should
    be a written table. Nulls and loops are ignored; repeated links count once; no links give no rows.
    """
    last = lambda few: few.coalesce(1).mapInArrow(_last, "node long, component long")
    both = links.where("u is not null and v is not null and u <> v").select("u", "v")
    if both.count() <= LAST:
        return scratch.save(last(both), f"{tag}-components")
    edges = scratch.save(both.union(both.select("v", "u")).distinct(), f"{tag}-edges0")
    label = scratch.save(edges.select(F.col("u").alias("node")).distinct().withColumn("label", F.col("node")), f"{tag}-label0")
    turn = 0
    while (left := edges.count()) > LAST:
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id"))
        hook = edges.groupBy("u").agg(F.min(rank("v")).alias("best")).select(
            F.col("u").alias("at"), F.least("best", rank("u")).getField("id").alias("to"))
        hook = scratch.save(hook, f"{tag}-hook{turn}")
        label_next = label.join(hook, label["label"] == hook["at"], "left").select("node", F.coalesce("to", "label").alias("label"))
        edges_next = (edges.join(hook, edges["u"] == hook["at"]).select(F.col("to").alias("a"), "v")
                      .join(hook, F.col("v") == hook["at"]).select(F.col("a").alias("u"), F.col("to").alias("v"))
                      .where("u <> v").distinct())
        label_next, edges_next = scratch.save(label_next, f"{tag}-label{turn}"), scratch.save(edges_next, f"{tag}-edges{turn}")
        scratch.drop(f"{tag}-label{turn - 1}", f"{tag}-edges{turn - 1}", f"{tag}-hook{turn}")
        label, edges = label_next, edges_next
    if left:
        ends = last(edges).select(F.col("node").alias("at"), F.col("component").alias("to"))
        label = label.join(ends, label["label"] == ends["at"], "left").select("node", F.coalesce("to", "label").alias("label"))
    least = label.groupBy("label").agg(F.min("node").alias("component"))
    found = scratch.save(label.join(least, "label").select("node", "component"), f"{tag}-components")
    scratch.drop(f"{tag}-label{turn}", f"{tag}-edges{turn}")
    return found
