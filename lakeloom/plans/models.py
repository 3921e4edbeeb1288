"""What a captured table is told to do, checked before anything runs; and the registry of such tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schemas import spark_type, split_ddl

# Load strategies and load types.
STRATEGIES = ("es", "s3_incr", "message_lib", "jdbc_snap", "custom")
LOAD_TYPES = ("R", "A", "U")


@dataclass(frozen=True)
class OdsModel:
    """One captured table: how its source speaks, its keys, its version column and its cut column."""

    strategy: str
    keys: tuple[str, ...]
    version: str | None = None
    status: str | None = None
    load_type: str = "U"
    cut: str | None = None
    hook: Callable[[DataFrame], DataFrame] | None = None

    def problems(self, columns: Iterable[str]) -> list[str]:
        """What is wrong with the model for a source of these columns."""
        columns = set(columns)
        out = [] if self.strategy in STRATEGIES else [f"strategy {self.strategy!r} is none of {', '.join(STRATEGIES)}"]
        out += [] if self.load_type in LOAD_TYPES else [f"load type {self.load_type!r} is none of {', '.join(LOAD_TYPES)}"]
        out += [] if self.keys else ["no keys"]
        out += [f"the source lacks the key {k}" for k in self.keys if k not in columns]
        out += [f"the key {k} is named twice" for k in sorted({k for k in self.keys if self.keys.count(k) > 1})]
        if self.strategy in ("es", "s3_incr", "message_lib", "custom"):
            out += [] if self.version in columns else [f"{self.strategy} needs a version column, {self.version!r} is not in the source"]
        if self.strategy == "es" and self.status not in columns:
            out.append(f"es needs a column of change types, {self.status!r} is not in the source")
        if self.strategy == "custom" and self.hook is None:
            out.append("custom needs a hook")
        if self.cut is not None and self.cut not in columns:
            out.append(f"the source lacks the cut column {self.cut}")
        return out

    def validate(self, columns: Iterable[str]) -> None:
        found = self.problems(columns)
        if found:
            raise ValueError("; ".join(found))


@dataclass(frozen=True)
class OdsHooks:
    """Callables that stand in for a step of a captured table's load, or follow it; None leaves the step as it is.

    ``tmp_fields(rows)`` and ``post_tmp(rows)`` change the staged rows, before and after missing columns
    are filled; ``filter_input(rows, state)`` is the strategy itself (rows with cdc_type_code, rn_asc,
    rn_desc and hash); ``cdc_fields(entries)`` and ``snp_fields(state)`` change what is written;
    ``cdc_load(entries)`` and ``snp_load(state, changes)`` give the added log rows and the next state;
    ``cut_param(rows, entries)`` gives the marks ``(table_nm, column_nm, cut_value)``.
    """

    tmp_fields: Callable[[DataFrame], DataFrame] | None = None
    post_tmp: Callable[[DataFrame], DataFrame] | None = None
    filter_input: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    cdc_fields: Callable[[DataFrame], DataFrame] | None = None
    snp_fields: Callable[[DataFrame], DataFrame] | None = None
    cdc_load: Callable[[DataFrame], DataFrame] | None = None
    snp_load: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    cut_param: Callable[[DataFrame, DataFrame], DataFrame] | None = None


@dataclass(frozen=True)
class Dictionary:
    """A code dictionary that a captured table's change log feeds; ``elements``: its element table is rebuilt as well."""

    code: str
    element: str
    source_element: str
    description: str
    system: str
    eff_from: str = "cdc_source_dttm"
    obsolete: bool = True
    elements: bool = False


def registry_rows(spark, models: dict[str, str]) -> DataFrame:
    """``table_nm, column_index, column_nm, source_type, kept_type`` of tables given by their column lists."""
    rows = [(t, k, name, kind, spark_type(kind)) for t, ddl in models.items() for k, (name, kind) in enumerate(split_ddl(ddl), 1)]
    return spark.createDataFrame(rows, "table_nm string, column_index int, column_nm string, source_type string, kept_type string")


def registry_sync(registered: DataFrame, found: DataFrame) -> DataFrame:
    """A full outer join of the registry and what is there: each column with ``state`` NEW, GONE, RETYPED or SAME."""
    keys = ["table_nm", "column_nm"]
    old = registered.select(*keys, F.col("kept_type").alias("old_type"))
    met = old.join(found.select(*keys, "kept_type"), keys, "full")
    state = F.when(F.col("old_type").isNull(), "NEW").when(F.col("kept_type").isNull(), "GONE").when(F.col("old_type") != F.col("kept_type"), "RETYPED").otherwise("SAME")
    return met.select(*keys, "old_type", "kept_type", state.alias("state"))
