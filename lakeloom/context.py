"""What a load needs from outside: a clock, a workflow's name, and how it returns its results."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = "1970-01-01 00:00:00"
OPEN_END = "5999-01-01 00:00:00"
SYSTEM_COLUMNS = ("dataflow_dttm", "dataflow_id")


@dataclass(frozen=True)
class LoadContext:
    """A load's clock and name; injected, so that a load is a function of its inputs."""

    now: datetime
    workflow_id: str

    def clock(self) -> Column:
        return moment(self.now.isoformat(sep=" "))

    def stamped(self, df: DataFrame) -> DataFrame:
        second = self.now.replace(microsecond=0).isoformat(sep=" ")
        return df.withColumns({"dataflow_dttm": moment(second), "dataflow_id": F.lit(self.workflow_id)})


@dataclass(frozen=True)
class LoadResult:
    """A table's next state, the rows that the load adds, and rows it takes exception to.

    ``insert_only``: the next state is the present one and the changes, so a store need only append.
    """

    target: DataFrame
    changes: DataFrame
    exceptions: DataFrame | None = None
    insert_only: bool = False


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def exception_rows(rows: DataFrame, code: Column | str, loader: str, target: str, ctx: LoadContext) -> DataFrame:
    """Rows for the exception log: the row as JSON with nulls and microseconds, and a type code."""
    plain = [c for c in rows.columns if not c.startswith("__")]
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    json = F.to_json(F.struct(*plain), options)
    code = F.lit(code) if isinstance(code, str) else code
    return ctx.stamped(rows.select(F.lit(loader).alias("loader_nm"), F.lit(target).alias("target_nm"), code.alias("exception_type_code"), json.alias("exception_json"), *plain))
