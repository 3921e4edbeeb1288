"""Satellite of a data vault: insert-only history with row hashes, deletes and roll-up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import FIRST, SYSTEM_COLUMNS, LoadContext, LoadResult, exception_rows, moment
from ..functions.hashing import hashdiff


@dataclass(frozen=True)
class Satellite:
    """``by_date`` cuts versions to days; ``roll_up`` drops versions equal to the one before."""

    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    eff_from: str | None = None
    roll_up: bool = True
    by_date: bool = True
    deletes: bool = True
    seed_1970: bool = False


def load(target: DataFrame, source: DataFrame, cfg: Satellite, ctx: LoadContext, name: str = "target") -> LoadResult:
    """Adds versions to ``target(keys, attributes, valid_from_dttm[, delete_flg], ...)``; nothing is ever changed.

    Rows older than a key's latest version are ignored; a live key without a current row in the
    source is deleted by a version of its own.
    """
    keys, attrs = list(cfg.keys), list(cfg.attributes)
    date = lambda c: F.date_trunc("day", c).cast("timestamp_ntz") if cfg.by_date else c
    now = date(ctx.clock())
    eff = F.coalesce(F.col(cfg.eff_from).cast("timestamp_ntz"), ctx.clock()) if cfg.eff_from else ctx.clock()
    incoming = source.select(*keys, *attrs, date(eff).alias("valid_from_dttm"), hashdiff(attrs).alias("__hash"))
    newest = Window.partitionBy(*keys).orderBy(F.desc("valid_from_dttm"), *[F.col(a).asc_nulls_last() for a in attrs])
    ranked = target.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1")
    flag = F.col("delete_flg") if cfg.deletes else F.lit(0)
    latest = ranked.select(*keys, F.col("valid_from_dttm").alias("__t_from"), hashdiff(attrs).alias("__t_hash"), F.coalesce(flag, F.lit(0)).alias("__t_del"), F.lit(1).alias("__t_has"))
    staged = incoming.join(latest, keys, "left").where("__t_has is null or valid_from_dttm >= __t_from")
    same_moment = F.coalesce(F.col("valid_from_dttm") == F.col("__t_from"), F.lit(False))
    order = Window.partitionBy(*keys, "valid_from_dttm").orderBy("__hash", *[F.col(a).asc_nulls_last() for a in attrs])
    staged = staged.withColumns({"__same_from": same_moment, "__diff": ~F.col("__hash").eqNullSafe(F.col("__t_hash")) | (F.coalesce(F.col("__t_del"), F.lit(0)) == 1), "__rn": F.row_number().over(order)})
    clash = F.col("__same_from") & ~F.col("__hash").eqNullSafe(F.col("__t_hash"))
    logged = exception_rows(staged.withColumn("__code", F.when(clash, "KAE").otherwise("NUK")).where((F.col("__rn") > 1) | clash), F.col("__code"), "sat", name, ctx)
    zero = {"delete_flg": F.lit(0)} if cfg.deletes else {}
    if cfg.roll_up:
        line = Window.partitionBy(*keys).orderBy("valid_from_dttm", "__rn")
        before = F.coalesce(F.lag("__hash").over(line), F.col("__t_hash"))
        # the flag before is 0 behind a row of the source, else the target's
        del_before = F.when(F.lag("__hash").over(line).isNotNull(), F.lit(0)).otherwise(F.col("__t_del"))
        rolled = staged.withColumns({"__before": before, "__del_before": del_before})
        repeat = F.coalesce(F.col("__hash") == F.col("__before"), F.lit(False)) & (F.lit(0).eqNullSafe(F.col("__del_before")) if cfg.deletes else F.lit(True))
        first = Window.partitionBy(*keys, "valid_from_dttm").orderBy("__rn")
        fresh = rolled.where(~F.col("__same_from") & ~repeat).withColumn("__first", F.row_number().over(first)).where("__first = 1")
    else:
        fresh = staged.where(~F.col("__same_from") & F.col("__diff") & (F.col("__rn") == 1))
    parts = [fresh.select(*keys, *attrs, "valid_from_dttm").withColumns(zero)]
    if cfg.deletes:
        present = staged.where("__t_has is not null").select(*keys).distinct()
        live = ranked.where("coalesce(delete_flg, 0) = 0").join(present, keys, "left_anti")
        parts.append(live.select(*keys, *attrs, now.alias("valid_from_dttm"), F.lit(1).alias("delete_flg")))
    if cfg.seed_1970:
        empty = target.schema
        seeds = staged.where("__t_has is null").groupBy(*keys).agg(F.min("valid_from_dttm").alias("__m")).where(F.col("__m") > moment(FIRST))
        seeds = seeds.select(*keys, *[F.lit(None).cast(empty[a].dataType).alias(a) for a in attrs], moment(FIRST).alias("valid_from_dttm"))
        parts.append(seeds.withColumns({k: F.lit(None).cast("int") for k in zero}))
    changes = parts[0]
    for part in parts[1:]:
        changes = changes.unionByName(part)
    changes = ctx.stamped(changes)
    changes = changes.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns if c in changes.columns or c in SYSTEM_COLUMNS])
    return LoadResult(target.unionByName(changes), changes, logged, insert_only=True)
