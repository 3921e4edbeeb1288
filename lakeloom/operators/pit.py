"""Point-in-time tables: for every key, intervals with the valid version of each satellite."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import FIRST, OPEN_END, LoadContext, LoadResult, moment

# The granules by which an interval ends before the next.
GRANULES = ("microsecond", "second", "hour", "day")


@dataclass(frozen=True)
class Pit:
    """``columns`` name the timestamp column of each source; ``load_type`` FULL_REWRITE, RK_REWRITE or INCREMENTAL."""

    keys: tuple[str, ...]
    columns: tuple[str, ...]
    load_type: str = "FULL_REWRITE"
    granularity: str = "microsecond"
    seed_1970: bool = False
    collapse_to_date: bool = False
    null_safe: bool = False

    def __post_init__(self):
        if self.granularity not in GRANULES or self.load_type not in ("FULL_REWRITE", "RK_REWRITE", "INCREMENTAL"):
            raise ValueError("unknown granularity or load type")


def _events(sources: list[DataFrame], cfg: Pit) -> DataFrame:
    """One row for each version of each source: its start, and the start in the source's own column."""
    out = None
    for df, name in zip(sources, cfg.columns, strict=True):
        at = F.date_trunc("day", "valid_from_dttm").cast("timestamp_ntz") if cfg.collapse_to_date else F.col("valid_from_dttm")
        own = {c: (F.col("valid_from_dttm") if c == name else F.lit(None).cast("timestamp_ntz")).alias(c) for c in cfg.columns}
        part = df.select(*cfg.keys, at.alias("__at"), *own.values()).withColumnRenamed("__at", "__from")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("__from", "valid_from_dttm")


def intervals(events: DataFrame, cfg: Pit) -> DataFrame:
    """Events collapsed by start, with ends before the next start and running greatest columns.

    The rows of a key are brought together once; the grouping and both windows use that order.
    """
    keys = list(cfg.keys)
    merged = events.repartition(*keys).groupBy(*keys, "valid_from_dttm").agg(*[F.max(c).alias(c) for c in cfg.columns])
    line = Window.partitionBy(*keys).orderBy("valid_from_dttm")
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    end = F.coalesce(F.lead("valid_from_dttm").over(line) - F.expr(f"interval 1 {cfg.granularity}"), moment(OPEN_END))
    return merged.select(*keys, "valid_from_dttm", end.alias("valid_to_dttm"), *[F.max(c).over(so_far).alias(c) for c in cfg.columns])


def load(target: DataFrame | None, sources: list[DataFrame], cfg: Pit, ctx: LoadContext) -> LoadResult:
    """The table's next state.

    FULL_REWRITE builds all; RK_REWRITE rebuilds the keys that the sources name; INCREMENTAL takes
    the sources as an increment on top of the versions that it may touch, and updates or inserts.
    """
    keys = list(cfg.keys)
    events = _events(sources, cfg)
    if cfg.load_type != "INCREMENTAL":
        if cfg.seed_1970:
            seeds = events.select(*keys).distinct().select(*keys, moment(FIRST).alias("valid_from_dttm"), *[F.lit(None).cast("timestamp_ntz").alias(c) for c in cfg.columns])
            events = events.unionByName(seeds)
        built = ctx.stamped(intervals(events, cfg))
        if target is None or cfg.load_type == "FULL_REWRITE":
            return LoadResult(built, built)
        built = built.select(*target.columns)
        return LoadResult(target.join(events.select(*keys).distinct(), keys, "left_anti").select(*target.columns).unionByName(built), built)
    firsts = events.groupBy(*keys).agg(F.min("valid_from_dttm").alias("__first"))
    held = target.join(firsts, keys).where(F.col("valid_to_dttm") >= F.col("__first"))
    base = held.select(*keys, "valid_from_dttm", *cfg.columns)
    if cfg.seed_1970:
        new = firsts.join(target.select(*keys).distinct(), keys, "left_anti")
        base = base.unionByName(new.select(*keys, moment(FIRST).alias("valid_from_dttm"), *[F.lit(None).cast("timestamp_ntz").alias(c) for c in cfg.columns]))
    built = intervals(events.unionByName(base), cfg)
    names = ["valid_to_dttm", *cfg.columns]
    old = held.select(*keys, "valid_from_dttm", *[F.col(c).alias(f"__{c}") for c in names], F.lit(1).alias("__has"))
    both = built.join(old, [*keys, "valid_from_dttm"], "left")
    differ = F.lit(False)
    for c in names:
        # as published, a null that gains a value is no change; null_safe sees it
        one = ~F.col(c).eqNullSafe(F.col(f"__{c}")) if cfg.null_safe else F.coalesce(F.col(c) != F.col(f"__{c}"), F.lit(False))
        differ = differ | one
    changes = both.where(F.col("__has").isNull() | differ)
    out = ctx.stamped(changes.select(*keys, "valid_from_dttm", *names)).select(*target.columns)
    left = target.join(out.select(*keys, "valid_from_dttm"), [*keys, "valid_from_dttm"], "left_anti")
    return LoadResult(left.select(*target.columns).unionByName(out), out)
