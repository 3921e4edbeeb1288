"""Slowly changing dimension of type 1: append, replace or upsert the current state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import SYSTEM_COLUMNS, LoadContext, LoadResult, exception_rows
from ..functions.hashing import joined_hash

FAIL, KEEP_FIRST, DROP_ALL, KEEP_ALL = 1, 2, 3, 4


@dataclass(frozen=True)
class Scd1:
    """``load_type`` A, R or U; ``on_duplicates`` 1 to 4; ``partition`` limits which target rows are looked at.

    With a partition column, target rows outside the source's partitions (``=``) or before its first
    one (``>=``) do not match: such a key is inserted as a second version.
    """

    keys: tuple[str, ...]
    load_type: str = "U"
    compare: tuple[str, ...] = ()
    on_duplicates: int = FAIL
    partition: str | None = None
    partition_operator: str = "="

    def __post_init__(self):
        if self.load_type not in ("A", "R", "U") or self.on_duplicates not in (1, 2, 3, 4) or self.partition_operator not in ("=", ">=") or not self.keys:
            raise ValueError("load_type A, R or U; on_duplicates 1 to 4; operator = or >=; at least one key")


def deduplicate(source: DataFrame, cfg: Scd1) -> tuple[DataFrame, DataFrame]:
    """Rows that go on, and rows of repeated keys (``__n`` > 1). Ties are ordered by all columns."""
    every = Window.partitionBy(*cfg.keys)
    counted = source.withColumn("__n", F.count("*").over(every))
    repeated = counted.where("__n > 1")
    if cfg.on_duplicates == KEEP_FIRST:
        rest = [F.col(c).asc_nulls_last() for c in source.columns if c not in cfg.keys]
        kept = source.withColumn("__rn", F.row_number().over(every.orderBy(*(rest or [F.lit(1)])))).where("__rn = 1")
    elif cfg.on_duplicates == DROP_ALL:
        kept = counted.where("__n = 1")
    else:
        kept = source
    return kept.select(*source.columns), repeated


def load(target: DataFrame, source: DataFrame, cfg: Scd1, ctx: LoadContext, name: str = "target") -> LoadResult:
    """The target's next state. Null keys never match, so their rows are new; null and '' compare equal."""
    plain = sorted(c for c in target.columns if c not in SYSTEM_COLUMNS)
    if sorted(source.columns) != plain or not set(cfg.keys) <= set(plain):
        raise ValueError("source and target need the same columns, keys among them")
    if cfg.load_type == "R":
        fresh = ctx.stamped(source).select(*target.columns)
        return LoadResult(fresh, fresh)
    kept, repeated = deduplicate(source, cfg)
    if cfg.on_duplicates == FAIL and not source.groupBy(*cfg.keys).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated keys in the source of {name}")
    logged = exception_rows(repeated, "NUK", "scd1", name, ctx) if cfg.on_duplicates in (KEEP_FIRST, DROP_ALL) else None
    looked_at = target
    if cfg.partition and cfg.partition_operator == "=":
        looked_at = target.join(kept.select(cfg.partition).distinct(), cfg.partition, "left_semi")
    elif cfg.partition:
        first = kept.agg(F.min(cfg.partition)).first()[0]  # one value
        looked_at = target.where(F.col(cfg.partition) >= F.lit(first)) if first is not None else target.where("false")
    if cfg.load_type == "A":
        inserts = kept.join(looked_at.select(*cfg.keys), list(cfg.keys), "left_anti")
        changes = ctx.stamped(inserts).select(*target.columns)
        return LoadResult(target.unionByName(changes), changes, logged, insert_only=True)
    compare = cfg.compare or tuple(source.columns)
    old = looked_at.select(*[F.col(k).alias(f"__t_{k}") for k in cfg.keys], joined_hash(compare).alias("__old")).distinct()
    on = [F.col(k) == F.col(f"__t_{k}") for k in cfg.keys]
    flagged = kept.withColumn("__new", joined_hash(compare)).join(old, on, "left")
    flagged = flagged.withColumn("__flag", F.when(F.col("__old").isNull(), 2).when(F.col("__old") != F.col("__new"), 1).otherwise(0))
    changed = flagged.where("__flag = 1").select(*cfg.keys).distinct()
    if cfg.partition:
        gone = looked_at.join(changed, list(cfg.keys), "left_semi")
        left = target.join(gone.select(*cfg.keys, cfg.partition).distinct(), [*cfg.keys, cfg.partition], "left_anti")
    else:
        left = target.join(changed, list(cfg.keys), "left_anti")
    changes = ctx.stamped(flagged.where("__flag > 0").select(*source.columns)).select(*target.columns)
    return LoadResult(left.select(*target.columns).unionByName(changes), changes, logged)
