"""Slowly changing dimension of type 2: closed validity intervals that end at an open end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import FIRST, OPEN_END, LoadContext, LoadResult, exception_rows, moment
from ..functions.hashing import hashdiff


def _tick():
    return F.expr("interval 1 microsecond")


@dataclass(frozen=True)
class Scd2:
    """Without ``eff_from`` versions start now; with it, at that column's time, late arrivals included."""

    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    eff_from: str | None = None
    granularity: str = "microsecond"
    seed_1970: bool = False


def _cut(cfg: Scd2, c):
    return c if cfg.granularity.startswith("microsecond") else F.date_trunc(cfg.granularity, c).cast("timestamp_ntz")


def _seeds(staged: DataFrame, target: DataFrame, cfg: Scd2) -> DataFrame:
    """Key-only rows from 1970 to just before the first version of keys that the target lacks."""
    firsts = staged.groupBy(*cfg.keys).agg(F.min("valid_from_dttm").alias("__m")).join(target.select(*cfg.keys), list(cfg.keys), "left_anti").where(F.col("__m") > moment(FIRST))
    return firsts.select(*cfg.keys, *[F.lit(None).cast(target.schema[a].dataType).alias(a) for a in cfg.attributes], moment(FIRST).alias("valid_from_dttm"), (F.col("__m") - _tick()).alias("valid_to_dttm"))


def load(target: DataFrame, source: DataFrame, cfg: Scd2, ctx: LoadContext, name: str = "target") -> LoadResult:
    return _load_now(target, source, cfg, ctx) if cfg.eff_from is None else _load_effective(target, source, cfg, ctx, name)


def _load_now(target: DataFrame, source: DataFrame, cfg: Scd2, ctx: LoadContext) -> LoadResult:
    keys, attrs = list(cfg.keys), list(cfg.attributes)
    is_open = F.col("valid_to_dttm") == moment(OPEN_END)
    held = target.where(is_open).select(*keys, F.col("valid_from_dttm").alias("__t_from"), hashdiff(attrs).alias("__t_hash"))
    start = _cut(cfg, ctx.clock())
    fresh = source.select(*keys, *attrs, hashdiff(attrs).alias("__hash")).join(held, keys, "left").where(~F.col("__hash").eqNullSafe(F.col("__t_hash")))
    fresh = fresh.select(*keys, *attrs, F.when(F.col("__t_from") == start, ctx.clock()).otherwise(start).alias("valid_from_dttm"), moment(OPEN_END).alias("valid_to_dttm"))
    ends = fresh.groupBy(*keys).agg((F.min("valid_from_dttm") - _tick()).alias("__end"))
    closed = target.join(ends, keys, "left").withColumn("valid_to_dttm", F.when(is_open & F.col("__end").isNotNull(), F.col("__end")).otherwise(F.col("valid_to_dttm")))
    added = fresh.unionByName(_seeds(fresh, target, cfg)) if cfg.seed_1970 else fresh
    changes = ctx.stamped(added).select(*target.columns)
    return LoadResult(closed.select(*target.columns).unionByName(changes), changes)


def _load_effective(target: DataFrame, source: DataFrame, cfg: Scd2, ctx: LoadContext, name: str) -> LoadResult:
    """Each source interval is compared with the target's versions that hold one of its ends.

    Same ends and attributes: nothing to do (0). Later start, same attributes: the version is
    extended (3). Later start of a key's first source row, other attributes: the version is cut and
    the row follows (2,1). Other attributes, or no version: the row comes in (1). Else it is a late
    repeat. Of the versions that end after a key's first source row, those go that hold an end of a
    row that comes in, or start after it does.
    """
    keys, attrs = list(cfg.keys), list(cfg.attributes)
    line = Window.partitionBy(*keys).orderBy("valid_from_dttm", *[F.col(a).asc_nulls_last() for a in attrs])
    came = source.select(*keys, *attrs, _cut(cfg, F.coalesce(F.col(cfg.eff_from).cast("timestamp_ntz"), ctx.clock())).alias("valid_from_dttm"))
    came = came.withColumns({"__hash": hashdiff(attrs), "valid_to_dttm": F.coalesce(F.lead("valid_from_dttm").over(line) - _tick(), moment(OPEN_END)), "__min": F.min("valid_from_dttm").over(Window.partitionBy(*keys))})
    firsts = came.groupBy(*keys).agg(F.min("valid_from_dttm").alias("__first"))
    held = target.join(firsts, keys).where((F.col("valid_from_dttm") >= F.col("__first")) | (F.col("valid_to_dttm") >= F.col("__first")))
    held = held.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(a).alias(f"__t_{a}") for a in attrs], F.col("valid_from_dttm").alias("__tf"), F.col("valid_to_dttm").alias("__tt"), hashdiff(attrs).alias("__th"))
    touch = F.col("valid_from_dttm").between(F.col("__tf"), F.col("__tt")) | F.col("valid_to_dttm").between(F.col("__tf"), F.col("__tt"))
    met = came.join(held, [F.col(k) == F.col(f"__k_{k}") for k in keys] + [touch], "left")
    equal, later, absent = F.col("__hash").eqNullSafe(F.col("__th")), F.col("valid_from_dttm") > F.col("__tf"), F.col("__tf").isNull()
    flag = (F.when((F.col("valid_from_dttm") == F.col("__tf")) & (F.col("valid_to_dttm") == F.col("__tt")) & equal, "0").when(later & equal, "3")
            .when(later & (F.col("valid_from_dttm") == F.col("__min")) & ~equal, "2,1").when(~equal | absent, "1"))
    met = met.withColumn("__flag", flag).where("__flag is not null")
    steps = met.where("__flag <> '0'").withColumn("__step", F.explode(F.split("__flag", ",")))
    old = F.col("__step").isin("2", "3")
    new_rows = steps.select(*keys, *[F.when(old, F.col(f"__t_{a}")).otherwise(F.col(a)).alias(a) for a in attrs],
                            F.when(old, F.col("__tf")).otherwise(F.col("valid_from_dttm")).alias("valid_from_dttm"),
                            F.when(F.col("__step") == "2", F.col("valid_from_dttm") - _tick()).otherwise(F.col("valid_to_dttm")).alias("valid_to_dttm"))
    # one row touching two versions must come in once
    whole = Window.partitionBy(*keys, "valid_from_dttm", "valid_to_dttm").orderBy(*[F.col(a).asc_nulls_last() for a in attrs])
    new_rows = new_rows.withColumn("__rn", F.row_number().over(whole)).where("__rn = 1").drop("__rn")
    came_in = steps.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.when(old, F.col("__tf")).otherwise(F.col("valid_from_dttm")).alias("__f"),
                           F.when(F.col("__step") == "2", F.col("valid_from_dttm") - _tick()).otherwise(F.col("valid_to_dttm")).alias("__t"), F.col("__min"))
    vf, vt = F.col("valid_from_dttm"), F.col("valid_to_dttm")
    replaced = (vt > F.col("__min")) & (F.col("__f").between(vf, vt) | F.col("__t").between(vf, vt) | ((F.col("__f") < vf) & (F.col("__f") < vt)))
    left = target.join(came_in, [*[F.col(k) == F.col(f"__k_{k}") for k in keys], replaced], "left_anti")
    twice = came.withColumn("__n", F.count("*").over(Window.partitionBy(*keys, "valid_from_dttm"))).where("__n > 1")
    added = new_rows.unionByName(_seeds(came, target, cfg)) if cfg.seed_1970 else new_rows
    changes = ctx.stamped(added).select(*target.columns)
    return LoadResult(left.select(*target.columns).unionByName(changes), changes, exception_rows(twice, "NUK", "scd2", name, ctx))
