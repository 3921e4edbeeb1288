"""Views, masked views, grants, and what the catalog tells about tables, columns and lineage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Replaces the view in one step; readers see the old or the new one."""
    spark.sql(f"create or replace view {name} as {query}")


def masked(df: DataFrame, personal: Iterable[str] = ()) -> DataFrame:
    """``df`` without its columns of personal data, in any spelling of their names."""
    hidden = {c.strip().lower() for c in personal}
    return df.select(*[c for c in df.columns if c.lower() not in hidden])


def create_masked_view(spark: SparkSession, table: str, view: str, personal: Iterable[str] = ()) -> None:
    names = ", ".join(f"`{c}`" for c in masked(spark.table(table), personal).columns)
    create_view(spark, view, f"select {names} from {table}")


def comment_on(spark: SparkSession, table: str, text: str, of_columns: Mapping[str, str] | None = None) -> None:
    """A table's comment and those of its columns."""
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"comment on table {table} is {quoted(text)}")
    for column, words in (of_columns or {}).items():
        spark.sql(f"alter table {table} alter column `{column}` comment {quoted(words)}")


def analyze(spark: SparkSession, table: str, columns: Iterable[str] = ()) -> None:
    """Statistics of a table, and of some of its columns, for the optimizer."""
    named = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"analyze table {table} compute statistics" + (f" for columns {named}" if named else ""))


def swap(spark: SparkSession, fresh: str, name: str) -> None:
    """A finished table takes another's name; the old one goes last, so that a failure between leaves both."""
    old = f"{name}_backup"
    spark.sql(f"drop table if exists {old}")
    if spark.catalog.tableExists(name):
        spark.sql(f"alter table {name} rename to {old}")
    spark.sql(f"alter table {fresh} rename to {name}")
    spark.sql(f"drop table if exists {old}")


def grants(table: str, view: str, role: str, personal_role: str) -> list[str]:
    """Statements for a catalog with roles: everybody reads the masked view, few the table."""
    return [f"grant select on {table} to {personal_role}", f"grant select on {view} to {role}"]


def tables_like(spark: SparkSession, database: str, like: str | None = None, ilike: str | None = None, regex: str | None = None) -> DataFrame:
    """``table_schema, table_name, table_type`` of a database's tables and views whose names fit all given patterns."""
    rows = [(database, t.name, "VIEW" if t.tableType == "VIEW" else "BASE TABLE") for t in spark.catalog.listTables(database) if not t.isTemporary]
    out = spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")
    name = F.col("table_name")
    for pattern, test in ((like, name.like), (ilike, name.ilike), (regex, name.rlike)):
        out = out if pattern is None else out.where(test(pattern))
    return out


def columns(spark: SparkSession, database: str) -> DataFrame:
    """``table_schema, table_name, table_type, column_name, column_index, column_type`` of a database."""
    kinds = tables_like(spark, database)
    rows = [(t.table_name, c.name, k, c.dataType) for t in kinds.collect() for k, c in enumerate(spark.catalog.listColumns(f"{database}.{t.table_name}"), 1)]
    listed = spark.createDataFrame(rows, "table_name string, column_name string, column_index int, column_type string")
    return kinds.join(listed, "table_name").select("table_schema", "table_name", "table_type", "column_name", "column_index", "column_type")


def lineage(spark: SparkSession, database: str) -> DataFrame:
    """``referenced_schema, referenced_name, dependent_schema, dependent_name``: what each view of a database reads directly."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    rows = set()
    for view in tables_like(spark, database).where("table_type = 'VIEW'").collect():
        text = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended {database}.{view.table_name}").collect()}["View Text"]
        leaves = parser.parsePlan(text).collectLeaves()
        for k in range(leaves.size()):
            if leaves.apply(k).nodeName() == "UnresolvedRelation":
                *schema, name = leaves.apply(k).tableName().replace("`", "").split(".")
                rows.add((schema[-1] if schema else database, name, database, view.table_name))
    return spark.createDataFrame(sorted(rows), "referenced_schema string, referenced_name string, dependent_schema string, dependent_name string")
