"""Watermarks, partition plans, code dictionaries and snapshot merges."""

from __future__ import annotations

import calendar
import math
from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hashdiff

# Types by which an extract can be cut.
NUMERIC_CUTS = ("BIGINT", "INT", "INTEGER", "SERIAL", "BIGSERIAL")
TEMPORAL_CUTS = ("TIMESTAMP", "DATE", "DATE_TO_TEXT", "TIMESTAMP WITH TIME ZONE")


def cut_value(text: str | None, kind: str) -> Column:
    if kind not in NUMERIC_CUTS + TEMPORAL_CUTS:
        raise ValueError(f"cannot cut by {kind}")
    first = "0" if kind in NUMERIC_CUTS else "1970-01-01 00:00:00"
    to = "bigint" if kind in NUMERIC_CUTS else "timestamp" if kind.endswith("ZONE") else "timestamp_ntz"
    return F.lit(first if text is None else text).cast(to)


def cut_filter(cuts: Mapping[str, tuple[str | None, str, int]]) -> Column:
    """Rows beyond any of the marks: column to (mark, type, lag); the lag is days or a number."""
    out = F.lit(False)
    for column, (mark, kind, lag) in cuts.items():
        value = cut_value(mark, kind)
        value = value - F.lit(lag) if kind in NUMERIC_CUTS else value - F.make_dt_interval(F.lit(lag))
        side = F.col(column).cast("timestamp_ntz") if kind == "DATE_TO_TEXT" else F.col(column)
        out = out | (side > value)
    return out


def advance_cuts(rows: DataFrame, cuts: Mapping[str, tuple[str | None, str]]) -> DataFrame:
    """``column_nm, cut_value``: the greatest value beyond each mark as text, else the mark."""
    greatest = [F.max(F.when(F.col(c) > cut_value(mark, kind), F.col(c))).cast("string").alias(f"m{k}") for k, (c, (mark, kind)) in enumerate(cuts.items())]
    pairs = [F.struct(F.lit(c).alias("column_nm"), F.coalesce(F.col(f"m{k}"), F.lit(mark)).alias("cut_value")) for k, (c, (mark, _)) in enumerate(cuts.items())]
    return rows.agg(*greatest).select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def _step(start: date, n: int, unit: str) -> date:
    """``n`` units on (or back); a day that the month lacks becomes its last one."""
    if unit == "days":
        return start + timedelta(days=n)
    months = start.year * 12 + start.month - 1 + n * (12 if unit == "years" else 1)
    year, month = months // 12, months % 12 + 1
    return date(year, month, min(start.day, calendar.monthrange(year, month)[1]))


def granularity_of(text: str) -> tuple[int, str]:
    """``3 months``, ``month`` (one of them) or ``2 day`` as a number and ``days``, ``months`` or ``years``."""
    words = text.split()
    n, unit = (int(words[0]), words[1]) if len(words) == 2 else (1, text.strip())
    unit = unit if unit.endswith("s") else f"{unit}s"
    if unit not in ("days", "months", "years") or n < 1:
        raise ValueError(f"granularity {text!r}")
    return n, unit


def plan_partitions(table: str, least: date, most: date, granularity: str = "days", existing: tuple[date, date] | None = None) -> list[tuple[str, date, date]]:
    """Ranges ``(name, from, to)`` to add so that ``least`` to ``most`` is covered, by date.

    The first ranges start at the month or year of ``least``. With ``existing`` (first and last
    bound), ranges go on from its end, and whole steps back from its start. Steps are counted by the
    shortest month or year, and one more is taken in reserve; what overlaps is left out.
    """
    n, unit = granularity_of(granularity)
    steps = lambda a, b: math.ceil((b - a).days / {"days": 1, "months": 28, "years": 365}[unit] / n)
    taken = [existing] if existing else []
    out = []

    def split(start: date, end: date) -> None:
        for k in range(steps(start, end) + 1):
            a, b = _step(start, k * n, unit), _step(start, (k + 1) * n, unit)
            if not any(to > a and of < b for of, to in taken):
                taken.append((a, b))
                out.append((f"p_{table}_{a:%Y%m%d}", a, b))

    if existing is None:
        split(least.replace(day=1) if unit == "months" else least.replace(month=1, day=1) if unit == "years" else least, most)
    else:
        if most >= existing[1]:
            split(existing[1], most)
        if least < existing[0]:
            split(_step(existing[0], -steps(least, existing[0]) * n, unit), existing[0])
    return sorted(out, key=lambda r: r[1])


def span(rows: DataFrame, column: str) -> tuple[date, date] | None:
    """The least and greatest date of a column, None if it has none; one aggregate row."""
    least, most = rows.agg(F.min(F.col(column).cast("date")), F.max(F.col(column).cast("date"))).first()
    return None if least is None else (least, most)


def registered_elements(log: DataFrame, new_rows: DataFrame | None, latest: DataFrame | None, dictionary: str, element: str, source_element: str, description: str, system: str, eff_from: str, include_obsolete: bool = True) -> DataFrame:
    """Code mappings told by a change log, newer than the latest known; deleted codes are obsolete."""
    rows = log.select(F.lit(dictionary).alias("dictionary_code"), F.col(element).cast("string").alias("element_code"), F.col(source_element).cast("string").alias("source_element_code"), F.col(description).cast("string").alias("source_element_desc"),
                      F.when(F.col("cdc_type_code") == "D", "OBS").otherwise("USE").alias("status_code"), F.lit(system).alias("source_system_dk"), F.col(eff_from).alias("valid_from_dttm")).distinct()
    if new_rows is not None:
        rows = rows.unionByName(new_rows.where("status_code = 'NEW'").select(*rows.columns)).distinct()
    if not include_obsolete:
        rows = rows.where("status_code <> 'OBS'")
    if latest is None:
        return rows
    keys = ["dictionary_code", "source_element_code", "source_system_dk"]
    known = latest.groupBy(*keys).agg(F.max("valid_from_dttm").alias("__last"))
    return rows.join(known, keys, "left").where("__last is null or valid_from_dttm > __last").select(*rows.columns)


def unregistered_elements(codes: DataFrame, code: str, known: DataFrame, dictionary: str, system: str) -> DataFrame:
    """Source codes no mapping knows: status NEW, element code from the code's hash."""
    found = codes.where(F.col(code).isNotNull()).select(F.col(code).cast("string").alias("source_element_code")).distinct()
    own = known.where(F.col("dictionary_code") == dictionary).select("source_element_code")
    return found.join(own, "source_element_code", "left_anti").select(F.lit(dictionary).alias("dictionary_code"), hashdiff(["source_element_code"]).alias("element_code"), "source_element_code", F.lit("NEW").alias("status_code"), F.lit(system).alias("source_system_dk"))


def rebuild_elements(elements: DataFrame, mappings: DataFrame, dictionary: str) -> DataFrame:
    """The element table with one dictionary's slice rebuilt; descriptions sorted and joined by ``$``."""
    slice_ = mappings.where(F.col("dictionary_code") == dictionary).select("dictionary_code", "element_code", "source_element_desc").distinct()
    fresh = slice_.groupBy("dictionary_code", "element_code").agg(F.array_join(F.sort_array(F.collect_set("source_element_desc")), "$").alias("element_desc"))
    return elements.where(F.col("dictionary_code") != dictionary).select(*fresh.columns).unionByName(fresh)


def apply_dictionary(rows: DataFrame, code: str, mappings: DataFrame, dictionary: str, out: str) -> DataFrame:
    """``rows`` with the element code of ``code`` in ``out``; codes without a mapping get their md5."""
    newest = Window.partitionBy("source_element_code").orderBy(F.desc("valid_from_dttm"), F.col("element_code").asc_nulls_last())
    one = mappings.where(F.col("dictionary_code") == dictionary).withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").select(F.col("source_element_code").alias("__code"), F.col("element_code").alias("__element"))
    met = rows.join(one, F.col(code).cast("string") == F.col("__code"), "left")
    return met.withColumn(out, F.coalesce("__element", F.md5(F.col(code).cast("string")))).drop("__code", "__element")


def merge_snapshot(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Closes open rows named by update and delete changes, and adds the inserted ones."""
    ends = changes.where("dbt_change_type in ('update', 'delete')").select(F.col("dbt_scd_id").alias("__id"), F.col("dbt_valid_to").alias("__to"))
    closed = target.join(ends, F.col("dbt_scd_id") == F.col("__id"), "left")
    closed = closed.withColumn("dbt_valid_to", F.when(F.col("dbt_valid_to").isNull(), F.col("__to")).otherwise(F.col("dbt_valid_to")))
    return closed.select(*target.columns).unionByName(changes.where("dbt_change_type = 'insert'").select(*target.columns))

