"""Mixing sources to target weights by Poisson replication.

A source with ``n`` characters and target share ``w`` of ``total`` characters is repeated
``rate = w * total / n`` times on average. Each document inverts the Poisson distribution of its
source's rate at a number hashed from seed and id, and is exploded by that count. A rate beyond
``MOST`` is the sum of equal parts, each a Poisson number of its own by a number hashed from seed,
id and part, so no table of the distribution grows with the rate; parts are dealt to all tasks
before they are exploded. Copies are dealt to partitions by a hash of seed, id and copy and ordered
by it inside, which is a global random order of the whole output; it is the same in every run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, md5_unit, partitions

#: Rates up to this are inverted at one number; larger ones are cut into parts.
MOST = 256.0
#: Copies of one part have numbers below this, so that numbers of parts do not meet.
STRIDE = 1024
#: Parts of a document are exploded in two levels of at most so many.
LEVEL = 1 << 16
#: Up to so many sources the table of rates (a few hundred bytes each) is broadcast.
MAX_BROADCAST_SOURCES = 10_000


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... far enough that the rest is below 1e-15; in logs, so no rate underflows."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.lit(0.0).alias("sum"), (-rate).alias("log"), F.array().cast("array<double>").alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        total = acc["sum"] + F.exp(acc["log"])
        return F.struct(total.alias("sum"), (acc["log"] + F.log(rate) - F.log(k + 1)).alias("log"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), last), start, step, lambda acc: acc["cdf"])).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, weights: Mapping[str, float] | None, epochs: float) -> DataFrame:
    """One row per source: ``of`` (its name), ``rate``, the number of its ``parts`` and the ``cdf`` of one. No weights: equal shares."""
    size = docs.groupBy(F.coalesce(F.col("source"), F.lit("")).alias("of")).agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("n"))
    if weights is not None:
        given = docs.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()] or [("", 0.0)], "name string, w double")
        size = size.join(given, F.col("of") == F.col("name"), "left").withColumn("w", F.coalesce("w", F.lit(0.0))).drop("name")
    else:
        size = size.withColumn("w", F.lit(1.0))
    size = Scratch(docs.sparkSession, "mixing").save(size, "sizes")
    total, weight = size.where("n > 0").agg(F.sum("n"), F.sum("w")).first()  # one row
    if not total or not weight:
        return size.select("of", F.lit(0.0).alias("rate"), F.lit(1).cast("long").alias("parts"), F.array(F.lit(1.0)).alias("cdf"))
    rate = F.when(F.col("n") > 0, F.lit(float(epochs) * total) * (F.col("w") / F.lit(weight)) / F.col("n")).otherwise(F.lit(0.0))
    cut = size.select("of", rate.alias("rate")).withColumn("parts", F.greatest(F.ceil(F.col("rate") / MOST), F.lit(1).cast("long")))
    return cut.withColumn("cdf", poisson_cdf(F.col("rate") / F.col("parts")))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0, seed: int = 17) -> DataFrame:
    """The copies of ``docs`` with all their columns, and ``copy`` (from 0) and ``mix_key``, in mixed order.

    ``weights`` gives each source's share of the output's characters (in any unit; absent sources
    get none), by default equal shares. A null source counts as the empty name; a source without
    text is not repeated; null and empty texts follow their source's rate; repeated rows get the
    same count each; a null id is hashed as such; columns named ``copy`` or ``mix_key`` give way.
    Copies are numbered from 0; beyond a rate of ``MOST`` each part has ``STRIDE`` numbers, not all used.
    """
    spark = docs.sparkSession
    table = Scratch(spark, "mixing").save(rates(docs, weights, epochs), "rates")
    if table.count() <= MAX_BROADCAST_SOURCES:
        table = F.broadcast(table)
    names = [c for c in docs.columns if c not in ("copy", "mix_key")]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    drawn = docs.select(*names).withColumn("__of", F.coalesce("source", F.lit(""))).join(table, F.col("__of") == F.col("of"), "left")
    drawn = drawn.withColumn("__parts", F.coalesce("parts", F.lit(1).cast("long")))
    count = F.aggregate("cdf", F.lit(0), lambda n, p: n + F.when(p <= F.col("__u"), 1).otherwise(0))

    def copied(rows: DataFrame, u: Column) -> DataFrame:
        rows = rows.withColumn("__u", u).withColumn("__n", F.coalesce(count, F.lit(0))).where("__n > 0")
        return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).withColumn("copy", F.col("copy") + F.col("__part") * STRIDE)

    copies = copied(drawn.where("__parts = 1").withColumn("__part", F.lit(0).cast("long")), md5_unit(F.lit(seed), F.lit("n"), key))
    if not table.where("parts > 1").isEmpty():
        many = drawn.where("__parts > 1").withColumn("__high", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__parts") - 1) / LEVEL))))
        many = many.withColumn("__part", F.explode(F.sequence(F.col("__high") * LEVEL, F.least(F.col("__high") * LEVEL + LEVEL, F.col("__parts")) - 1)))
        many = many.repartition(partitions(spark), F.xxhash64("__part", key)).drop("__high")
        copies = copies.unionByName(copied(many, md5_unit(F.lit(seed), F.lit("n"), key, F.col("__part"))))
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("o"), key, F.col("copy").cast("string"))), 1, 15), 16, 10).cast("long")
    copies = copies.select(*names, "copy", order.alias("mix_key"))
    n = partitions(spark)
    # the key is uniform by construction, so ranges need no sampling pass over the texts
    part = F.least(F.floor(F.col("mix_key") / F.lit(float(1 << 60)) * n), F.lit(n - 1)).cast("int")
    return copies.repartitionById(n, part).sortWithinPartitions("mix_key", "doc_id", "copy")
