"""Whole loads: read the state, compute the next one, commit it with all that belongs to it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import LoadContext, LoadResult
from ..functions.schemas import evolve
from ..operators import ods, small
from ..sources.store import TableStore
from .models import Dictionary, OdsHooks, OdsModel

Loader = Callable[[DataFrame, DataFrame], LoadResult]


def run_incremental(store: TableStore, name: str, source: DataFrame, load: Loader, empty: DataFrame, partition_by: list[str] | None = None) -> int:
    """One table: its next state, and its exceptions if the load has any; ``empty`` gives the first schema.

    An insert-only load appends its changes, and exceptions are appended to their log.
    """
    state = store.read(name)
    result = load(evolve(state, empty.schema) if state is not None else empty, source)
    by = {name: partition_by} if partition_by else None
    fits = state is not None and all(dict(result.changes.dtypes).get(c, t) == t for c, t in state.dtypes)  # no column widened
    appends = {name: result.changes} if result.insert_only and fits else {}
    states = {} if appends else {name: result.target}
    if result.exceptions is not None:
        appends["load_exception"] = result.exceptions.select("loader_nm", "target_nm", "exception_type_code", "exception_json", "dataflow_dttm", "dataflow_id")
    return store.commit(states, by, appends)


def run_ods(store: TableStore, name: str, rows: DataFrame, keys: list[str], attrs: list[str], version: str | None, ctx: LoadContext, strategy: str = "es", status: str = "ce_type", hook: Callable[[DataFrame], DataFrame] | None = None,
            load_type: str = "U", cut: str | None = None, window: Column | None = None, full_history: bool = False, hooks: OdsHooks = OdsHooks(), dictionaries: Sequence[Dictionary] = (), partition_by: Mapping[str, list[str]] | None = None) -> int:
    """Change log (appended) and current state of one table, committed together with the watermark and dictionaries.

    ``strategy``: es (events), s3_incr (file increments), message_lib (dated snapshots), jdbc_snap
    (extracts) or custom (``hook`` gives rows with cdc_type_code, rn_asc, rn_desc and hash).
    ``partition_by``: columns by which ``<name>_cdc`` and ``<name>_snp`` are written.

    Extracts: ``window`` limits both sides to the increment's range of the column ``cut``, unless
    ``full_history`` asks for a comparison with the whole state. Keys that the extract lacks are
    deleted if ``load_type`` is R or U and the extract tells: not for an increment that is compared
    with the full history. The watermark of extracts is the greatest logged value of ``cut``.
    """
    rows = hooks.tmp_fields(rows) if hooks.tmp_fields else rows
    filter_input = hooks.filter_input or (hook and (lambda rows, state: hook(rows)))
    OdsModel(strategy, tuple(keys), version, status, load_type, cut, filter_input).validate(rows.columns)
    state = store.read(f"{name}_snp")
    if state is None:
        versions = [version] if version and strategy != "jdbc_snap" else []
        state = rows.limit(0).select(*keys, *attrs, *versions).withColumn("snp_delete_flg", F.lit(0))
    rows = rows.withColumns({a: F.lit(None).cast(state.schema[a].dataType) for a in attrs if a not in rows.columns})
    rows = hooks.post_tmp(rows) if hooks.post_tmp else rows
    if strategy == "jdbc_snap" and not hooks.filter_input:
        changes = ods.extract_changes(rows, state, keys, attrs, deletes=load_type in ("R", "U") and not (window is not None and full_history), window=None if full_history else window)
        entries = ods.change_log(changes, keys, attrs, ctx)
    else:
        made = {"es": lambda: ods.dedup_events(rows, keys, attrs, version, status), "s3_incr": lambda: ods.increment_rows(rows, keys, attrs, version), "message_lib": lambda: ods.snapshot_changes(rows, keys, attrs, version)}
        made = filter_input(rows, state) if filter_input else made[strategy]()
        against = ods.against_snapshots if strategy == "message_lib" else ods.against_state
        changes = against(made, state, keys, attrs, version)
        dated = dict(rows.dtypes)[version].startswith(("timestamp", "date"))
        entries = ods.change_log(changes, keys, attrs, ctx, version) if dated else ods.change_log(changes.withColumn("__at", ctx.clock()), keys, attrs, ctx, version, "__at").drop("__at")
    for step in (hooks.cdc_fields, hooks.cdc_load):
        entries = step(entries) if step else entries
    current = (hooks.snp_load or (lambda state, changes: ods.merge_state(state, changes, keys)))(state, changes)
    states = {f"{name}_snp": hooks.snp_fields(current) if hooks.snp_fields else current}
    appends = {f"{name}_cdc": entries}
    column, marked = (cut, entries) if strategy == "jdbc_snap" else (version, rows)
    if column or hooks.cut_param:
        mark = hooks.cut_param(rows, entries) if hooks.cut_param else marked.agg(F.max(column).cast("string").alias("cut_value")).select(F.lit(name).alias("table_nm"), F.lit(column).alias("column_nm"), "cut_value")
        mark = mark.where("cut_value is not null").select("table_nm", "column_nm", "cut_value")
        old = store.read("cut_param")  # a mark without a new value stays
        states["cut_param"] = mark if old is None else old.join(mark.select("table_nm", "column_nm"), ["table_nm", "column_nm"], "left_anti").select(*mark.columns).unionByName(mark)
    for d in dictionaries:
        held = store.read("udd_element_map")
        found = small.registered_elements(entries, None, held, d.code, d.element, d.source_element, d.description, d.system, d.eff_from, d.obsolete)
        before = appends.get("udd_element_map")
        appends["udd_element_map"] = found if before is None else before.unionByName(found)
        if d.elements:
            mappings = found if held is None else held.select(*found.columns).unionByName(found)
            elements = states.get("udd_element", store.read("udd_element"))
            if elements is None:
                elements = store.spark.createDataFrame([], "dictionary_code string, element_code string, element_desc string")
            states["udd_element"] = small.rebuild_elements(elements, mappings, d.code)
    return store.commit(states, partition_by, appends)
