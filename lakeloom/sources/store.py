"""Versioned tables: a load writes new folders, then one manifest names them all at once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.schemas import fitted


class TableStore:
    """Tables as parquet folders under ``root``; the manifest of greatest number lists those of each table.

    Everything goes through Hadoop's file system API, so ``root`` may be any store Spark can write.
    A manifest is written under a temporary name and renamed without overwriting: of two loads that
    started from the same state, the second fails and must run again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/_manifests"))

    def _number(self) -> int:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/_manifests"))]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def manifest(self) -> dict[str, list[str]]:
        """Folders of each table, oldest first."""
        n = self._number()
        if not n:
            return {}
        return json.loads(self.spark.read.text(f"{self.root}/_manifests/{n}", wholetext=True).first()[0])

    def read(self, name: str) -> DataFrame | None:
        """The table's present rows; columns that older appends lack are null."""
        folders = self.manifest().get(name)
        if folders is None:
            return None
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(self.spark.read.parquet(paths[-1]).schema).parquet(*paths)

    def commit(self, states: Mapping[str, DataFrame], partition_by: Mapping[str, list[str]] | None = None, appends: Mapping[str, DataFrame] | None = None) -> int:
        """Makes new states and added rows of several tables current together.

        ``states`` replace a table's rows. ``appends`` are written beside them, and no present row is
        read or written: the new folder has the table's columns, then those that are new to it.
        """
        n, current = self._number(), self.manifest()
        for name, df in states.items():
            current[name] = [self._write(name, df, partition_by)]
        for name, df in (appends or {}).items():
            held = states.get(name, self.read(name))
            if held is not None:
                df = fitted(df, T.StructType([*held.schema, *[f for f in df.schema if f.name not in held.columns]]))
            current[name] = [*current.get(name, []), self._write(name, df, partition_by)]
        return self._publish(n + 1, current)

    def compact(self, name: str, partition_by: Mapping[str, list[str]] | None = None) -> int:
        """Many appends as one folder again."""
        return self.commit({name: self.read(name)}, partition_by)

    def _write(self, name: str, df: DataFrame, partition_by: Mapping[str, list[str]] | None) -> str:
        folder = f"{name}/{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd")
        if partition_by and name in partition_by:
            writer = writer.partitionBy(*partition_by[name])
        writer.parquet(f"{self.root}/{folder}")
        return folder

    def _publish(self, number: int, manifest: dict[str, list[str]]) -> int:
        draft = self._path(f"{self.root}/_manifests/draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        final = self._path(f"{self.root}/_manifests/{number}")
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError("another load was committed meanwhile")
        return number


def jdbc_options(url: str, table: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 1) -> dict[str, str]:
    """Options of a JDBC read; with a partition column and bounds it is read in parallel ranges.

    The first range also takes nulls, the last one is open, and filters are pushed down.
    """
    out = {"url": url, "dbtable": table, "pushDownPredicate": "true"}
    if partition_column:
        if not bounds or partitions < 1:
            raise ValueError("ranges need bounds and a number of partitions")
        out |= {"partitionColumn": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(partitions)}
    return out


def range_predicates(column: str, least: int, most: int, partitions: int) -> list[str]:
    """Conditions that split a numeric column's values into ranges: the first takes nulls too, the last is open."""
    step = max(1, -(-(most - least + 1) // max(1, partitions)))
    bounds = list(range(least + step, most + 1, step))
    if not bounds:
        return ["true"]
    middle = [f"{column} >= {a} and {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} or {column} is null", *middle, f"{column} >= {bounds[-1]}"]


def sources_yaml(spark: SparkSession, database: str) -> str:
    """The tables and columns of a database as a YAML source description."""
    lines = ["version: 2", "", "sources:", f"  - name: {database}", "    tables:"]
    for found in sorted(spark.catalog.listTables(database), key=lambda t: t.name):
        lines += [f"      - name: {found.name}", "        columns:"]
        for c in spark.catalog.listColumns(f"{database}.{found.name}"):
            lines += [f"          - name: {c.name}", f"            data_type: {c.dataType}"]
    return "\n".join(lines) + "\n"
