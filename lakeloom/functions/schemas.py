"""Column sets, source types, and controlled schema evolution."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source types and the types they are kept as.
PLAIN_TYPES = {"integer": "int", "bigint": "bigint", "smallint": "smallint", "real": "float", "float8": "double", "boolean": "boolean", "text": "string", "date": "date", "bytea": "binary", "serial": "int", "bigserial": "bigint"}
#: Widenings that evolve a column; any other change of type is refused.
WIDENINGS = {("int", "bigint")}


def common(left: T.StructType, right: T.StructType, exclude=()) -> list[str]:
    """Names of ``left`` that ``right`` has, in the order of ``left``."""
    return [f.name for f in left if f.name in right.names and f.name not in exclude]


def missing(left: T.StructType, right: T.StructType, exclude=()) -> list[str]:
    return [f.name for f in left if f.name not in right.names and f.name not in exclude]


def retyped(left: T.StructType, right: T.StructType, exclude=()) -> dict[str, tuple[str, str]]:
    """Names in both, told apart without case, whose types differ: type in ``right``, type in ``left``."""
    other = {f.name.lower(): f.dataType.simpleString() for f in right}
    return {f.name: (other[f.name.lower()], f.dataType.simpleString()) for f in left if f.name not in exclude and f.name.lower() in other and other[f.name.lower()] != f.dataType.simpleString()}


def same(left: T.StructType, right: T.StructType, exclude=()) -> list[str]:
    return [f.name for f in left if f.name not in exclude and f in T.StructType([T.StructField(g.name, g.dataType, f.nullable, f.metadata) for g in right])]


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; those it lacks are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def split_ddl(ddl: str) -> list[tuple[str, str]]:
    """``name type`` pairs of a column list; commas inside parentheses do not separate."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            parts.append(ddl[start:i])
            start = i + 1
    parts.append(ddl[start:])
    return [(n.strip('"'), " ".join(t)) for n, *t in (p.split() for p in parts if p.strip())]


def spark_type(source: str) -> str:
    """The type a source column is kept as; a type not known here is kept as a string."""
    kind = " ".join(source.lower().split())
    if kind in PLAIN_TYPES:
        return PLAIN_TYPES[kind]
    if kind == "double precision":
        return "double"
    if m := re.fullmatch(r"(?:numeric|decimal)(?:\((\d+),\s*(\d+)\))?", kind):
        return f"decimal({m[1]},{m[2]})" if m[1] else "decimal(38,18)"
    if kind.startswith("timestamp"):
        return "timestamp" if "with time zone" in kind and "without" not in kind else "timestamp_ntz"
    return "string"


def evolve(state: DataFrame, expected: T.StructType) -> DataFrame:
    """``state`` with the columns of ``expected`` added (null) or widened; its own further columns stay."""
    out = state
    for name, (have, want) in retyped(expected, state.schema).items():
        if (have, want) not in WIDENINGS:
            raise ValueError(f"column {name} cannot change from {have} to {want}")
        out = out.withColumn(name, F.col(name).cast(want))
    for f in expected:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out
