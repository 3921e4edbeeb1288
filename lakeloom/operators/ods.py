"""Change capture: from events, file increments, snapshots or extracts to a change log and a current state.

Each strategy gives log rows with ``cdc_type_code`` I, U or D; the state keeps deleted keys with
``snp_delete_flg`` 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import FIRST, OPEN_END, LoadContext, moment
from ..functions.hashing import hashdiff

# Source spellings of the three change types.
STATUS = {"I": ("create", "created", "adjust.created", "insert", "inserted"), "U": ("update", "updated"), "D": ("delete", "deleted")}


def status_code(column: Column) -> Column:
    """I, U or D for the known spellings; any other code as it is."""
    out = column
    for code, names in STATUS.items():
        out = F.when(F.lower(column).isin(*names), code).otherwise(out)
    return out


def _line(keys, version: str, ties=(), desc: bool = False):
    """By version; rows of one version by ``ties``, nulls last (first, where the order is turned round)."""
    return Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() if desc else F.col(c).asc_nulls_last() for c in (version, *ties)])


def _ranked(df: DataFrame, keys, version: str, ties=()) -> DataFrame:
    return df.withColumns({"rn_asc": F.row_number().over(_line(keys, version, ties)), "rn_desc": F.row_number().over(_line(keys, version, ties, True))})


def dedup_events(events: DataFrame, keys, attrs, version: str, status: str) -> DataFrame:
    """Events without those that repeat the state before: equal hash, and no change to or from deleted.

    Within the batch an insert after anything is an update.
    """
    rows = events.withColumns({"hash": hashdiff(attrs), "cdc_type_code": status_code(F.col(status))})
    ties = (*attrs, status)
    before = _line(keys, version, ties)
    rows = rows.withColumns({"__hash": F.lag("hash").over(before), "__type": F.lag("cdc_type_code").over(before)})
    pair = F.concat("cdc_type_code", "__type")
    repeat = (F.col("hash") == F.col("__hash")) & ~pair.isin("DI", "DU", "ID", "UD")
    rows = rows.where(~F.coalesce(repeat, F.lit(False)))
    rows = rows.withColumn("cdc_type_code", F.when((F.col("cdc_type_code") == "I") & F.col("__type").isin("I", "U", "D"), "U").otherwise(F.col("cdc_type_code")))
    return _ranked(rows.drop("__hash", "__type"), keys, version, ties)


def increment_rows(rows: DataFrame, keys, attrs, version: str) -> DataFrame:
    """File increments: rows that change a key's hash; the first of a key is an insert; no deletes."""
    rows = rows.withColumn("hash", hashdiff(attrs))
    before = _line(keys, version, attrs)
    rows = rows.withColumns({"__hash": F.lag("hash").over(before), "__rn": F.row_number().over(before)})
    rows = rows.where(~F.col("hash").eqNullSafe(F.col("__hash"))).withColumn("cdc_type_code", F.when(F.col("__rn") == 1, "I").otherwise("U"))
    return _ranked(rows.drop("__hash", "__rn"), keys, version, attrs)


def against_state(rows: DataFrame, state: DataFrame, keys, attrs, version: str) -> DataFrame:
    """Rows newer than the state's version, or of keys whose state has none and that change it.

    The first update of an unknown key is an insert, the first insert of a known key (deleted or
    not) an update.
    """
    held = state.select(*keys, F.col(version).alias("__version"), hashdiff(attrs).alias("__hash"), F.lit(1).alias("__has"))
    met = rows.join(held, list(keys), "left")
    fresh = F.col(version) > F.col("__version")
    code, first = F.col("cdc_type_code"), F.col("rn_asc") == 1
    unversioned = F.col("__version").isNull() & ((code == "D") | (code.isin("I", "U") & (~first | ~F.col("hash").eqNullSafe(F.col("__hash")))))
    met = met.where(F.coalesce(fresh, F.lit(False)) | unversioned)
    code = F.when((code == "U") & first & F.col("__has").isNull(), "I").when((code == "I") & first & F.col("__has").isNotNull(), "U").otherwise(code)
    return met.withColumn("cdc_type_code", code).drop("__version", "__hash", "__has")


def snapshot_changes(snapshots: DataFrame, keys, attrs, stamp: str, emit_reappeared: bool = True) -> DataFrame:
    """Full snapshots by date: inserts, updates, and a delete at the first snapshot that lacks a key.

    A key that comes back is inserted again even if it did not change; ``emit_reappeared=False``
    compares it with its last row instead and stays silent then.
    """
    order = Window.partitionBy(*keys, stamp).orderBy(*[F.col(a).asc_nulls_last() for a in attrs])
    rows = snapshots.select(*keys, *attrs, stamp).withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")
    # as many rows as there are snapshots
    dates = snapshots.groupBy(stamp).count().select(F.col(stamp).alias("__at"), F.lead(stamp, 1).over(Window.orderBy(stamp)).alias("__next"))
    rows = rows.join(dates, F.col(stamp) == F.col("__at")).drop("__at").withColumn("hash", hashdiff(attrs))
    line = _line(keys, stamp)
    end = moment(OPEN_END)
    rows = rows.withColumns({"__own": F.lead(stamp).over(line), "__before": F.lag("hash").over(line), "__left": F.lag("__next").over(line)})
    came_back = F.col("__left").isNotNull() & (F.col("__left") != F.col(stamp))
    code = F.when(F.col("__before").isNull(), "I").when(came_back & F.lit(emit_reappeared), "I").when(F.col("hash") != F.col("__before"), "U")
    kept = rows.withColumn("cdc_type_code", code).where("cdc_type_code is not null").select(*keys, *attrs, stamp, "hash", "cdc_type_code")
    vanished = rows.where(F.col("__next").isNotNull() & (F.coalesce("__own", end) != F.col("__next")))
    deletes = vanished.select(*keys, *attrs, F.col("__next").alias(stamp), "hash", F.lit("D").alias("cdc_type_code"))
    return _ranked(kept.unionByName(deletes), keys, stamp, ["cdc_type_code"])


def against_snapshots(rows: DataFrame, state: DataFrame, keys, attrs, stamp: str) -> DataFrame:
    """A batch of ``snapshot_changes`` against the state that earlier batches left.

    Only snapshots newer than the state's newest count; a key's first row counts if it differs from
    the state, whose keys are updated, not inserted. Live keys that the whole batch lacks are
    deleted at its first snapshot, once. An empty batch changes nothing.
    """
    held = state.select(*keys, hashdiff(attrs).alias("__hash"), F.lit(1).alias("__has"))
    loaded = F.coalesce(state.agg(F.max(stamp)).scalar(), moment(FIRST).cast(state.schema[stamp].dataType))
    code, first = F.col("cdc_type_code"), F.col("rn_asc") == 1
    met = rows.join(held, list(keys), "left").where(F.col(stamp) > loaded).where((code == "D") | ~first | ~F.col("hash").eqNullSafe(F.col("__hash")))
    met = met.withColumn("cdc_type_code", F.when((code == "I") & F.col("__has").isNotNull(), "U").otherwise(code)).drop("__hash", "__has")
    gone = state.where("snp_delete_flg = 0").join(rows.select(*keys).distinct(), list(keys), "left_anti").withColumn(stamp, rows.agg(F.min(stamp)).scalar())
    gone = gone.where(F.col(stamp).isNotNull()).select(*keys, *attrs, stamp).withColumns({"hash": hashdiff(attrs), "cdc_type_code": F.lit("D"), "rn_asc": F.lit(1), "rn_desc": F.lit(1)})
    return met.unionByName(gone.select(*met.columns))


def extract_changes(rows: DataFrame, state: DataFrame, keys, attrs, deletes: bool = True, window: Column | None = None) -> DataFrame:
    """A table's extract against its live state: I, U, and D for live keys it lacks.

    ``window`` limits both sides to the increment's range of the cut column first.
    """
    if window is not None:
        rows, state = rows.where(window), state.where(window)
    live = state.where("snp_delete_flg = 0").select(*keys, hashdiff(attrs).alias("__hash"), F.lit(1).alias("__has"))
    met = rows.withColumn("hash", hashdiff(attrs)).join(live, list(keys), "left")
    code = F.when(F.col("__has").isNull(), "I").when(~F.col("hash").eqNullSafe(F.col("__hash")), "U")
    out = met.withColumn("cdc_type_code", code).where("cdc_type_code is not null").select(*keys, *attrs, "cdc_type_code")
    if deletes:
        gone = state.where("snp_delete_flg = 0").join(rows.select(*keys), list(keys), "left_anti")
        out = out.unionByName(gone.select(*keys, *attrs, F.lit("D").alias("cdc_type_code")))
    return out


def change_log(rows: DataFrame, keys, attrs, ctx: LoadContext, *more: str) -> DataFrame:
    stamped = rows.withColumns({"cdc_source_dttm": F.col(more[-1]).cast("timestamp_ntz") if more else ctx.clock(), "cdc_target_dttm": ctx.clock()})
    return ctx.stamped(stamped.select(*keys, *attrs, *more, "cdc_type_code", "cdc_source_dttm", "cdc_target_dttm"))


def merge_state(state: DataFrame, rows: DataFrame, keys) -> DataFrame:
    """The state with each key's last log row in place of its old one; deletes are kept as such."""
    last = rows.where("rn_desc = 1") if "rn_desc" in rows.columns else rows
    fresh = last.withColumn("snp_delete_flg", F.when(F.col("cdc_type_code") == "D", 1).otherwise(0)).select(*state.columns)
    return state.join(last.select(*keys), list(keys), "left_anti").select(*state.columns).unionByName(fresh)
