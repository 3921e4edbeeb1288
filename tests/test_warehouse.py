"""Every loading query against its SQL, and what the loaders refuse."""

import os
import shutil
import subprocess
import sys
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import warehouse_queries as W
from lakeloom.context import LoadContext
from lakeloom.functions import schemas
from lakeloom.operators import satellite, scd1, small
from lakeloom.plans import models
from lakeloom.plans.loads import run_incremental, run_ods
from lakeloom.sources import catalog
from lakeloom.sources import store as store_module
from lakeloom.sources.store import TableStore
from lakeloom.streaming import capture

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "events"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(W.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = W.queries()[name](spark, SF)
    cols = sorted(df.columns)
    found = duck.execute(W.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in found.fetchall())
    assert want, "the fixture must reach the branch"
    assert sorted(repr(tuple(r)) for r in df.select(*cols).collect()) == want


def test_scd1_refuses(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        scd1.load(W.CTX.stamped(s.limit(0)), s, scd1.Scd1(("k",)), W.CTX)
    with pytest.raises(ValueError):
        scd1.Scd1(("k",), load_type="Z")


def test_scd1_upsert_is_idempotent(spark):
    s = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    one = scd1.load(W.CTX.stamped(s.limit(0)), s, scd1.Scd1(("k",)), W.CTX).target
    assert scd1.load(one, s, scd1.Scd1(("k",)), W.CTX).changes.count() == 0


def test_partition_plan_goes_on_and_back():
    plan = small.plan_partitions("t", date(2023, 11, 5), date(2024, 3, 2), "1 months", (date(2024, 1, 1), date(2024, 2, 1)))
    assert plan[0] == ("p_t_20231001", date(2023, 10, 1), date(2023, 11, 1)) and plan[2][2] == date(2024, 1, 1)
    assert plan[3][1] == date(2024, 2, 1) and plan[-1][2] > date(2024, 3, 2)
    assert small.plan_partitions("t", date(2023, 11, 15), date(2023, 12, 1), "3 month", (date(2024, 1, 1), date(2024, 4, 1))) == [
        ("p_t_20231001", date(2023, 10, 1), date(2024, 1, 1)), ("p_t_20240401", date(2024, 4, 1), date(2024, 7, 1))]  # the second is the step in reserve
    assert small.granularity_of("days") == (1, "days") and small.granularity_of("2 year") == (2, "years")
    assert small.plan_partitions("t", date(2024, 1, 31), date(2024, 1, 31), "months", (date(2024, 1, 31), date(2024, 1, 31)))[0][2] == date(2024, 2, 29)
    for wrong in ("weeks", "0 days"):
        with pytest.raises(ValueError):
            small.granularity_of(wrong)


def test_schemas():
    assert schemas.split_ddl("a numeric(10,2), b timestamp with time zone") == [("a", "numeric(10,2)"), ("b", "timestamp with time zone")]
    assert [schemas.spark_type(t) for t in ("numeric(10, 2)", "numeric", "timestamp(6)", "jsonb", "bigserial")] == ["decimal(10,2)", "decimal(38,18)", "timestamp_ntz", "string", "bigint"]


def test_ods_run_commits_log_state_and_mark(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    ctx = LoadContext(datetime(2024, 2, 1), "wf")
    rows = spark.createDataFrame([(1, "a", 1, "create"), (1, "b", 2, "update"), (2, "x", 3, "create")], "k int, v string, ver int, ce_type string")
    run_ods(store, "t", rows, ["k"], ["v"], "ver", ctx)
    more = spark.createDataFrame([(2, "x", 4, "deleted"), (1, "b", 2, "update")], rows.schema)
    run_ods(store, "t", more, ["k"], ["v"], "ver", ctx)
    state = {r["k"]: (r["v"], r["ver"], r["snp_delete_flg"]) for r in store.read("t_snp").collect()}
    assert state == {1: ("b", 2, 0), 2: ("x", 4, 1)}
    assert sorted((r["k"], r["cdc_type_code"]) for r in store.read("t_cdc").collect()) == [(1, "I"), (1, "U"), (2, "D"), (2, "I")]
    assert store.read("cut_param").select(F.col("cut_value")).first()[0] == "4"


def test_second_load_writes_no_old_row(spark, tmp_path):
    root = tmp_path / "store"
    store = TableStore(spark, f"file://{root}")
    ctx = LoadContext(datetime(2024, 2, 1), "wf")
    rows = spark.createDataFrame([(k, "a", 1, "create") for k in range(50)], "k int, v string, ver int, ce_type string")
    run_ods(store, "t", rows, ["k"], ["v"], "ver", ctx)
    before = {f: f.stat().st_mtime_ns for f in root.glob("t_cdc/*/part-*")}
    run_ods(store, "t", spark.createDataFrame([(1, "b", 2, "update")], rows.schema), ["k"], ["v"], "ver", ctx)
    after = {f: f.stat().st_mtime_ns for f in root.glob("t_cdc/*/part-*")}
    assert all(after[f] == at for f, at in before.items())
    assert sum(spark.read.parquet(f"file://{f}").count() for f in after.keys() - before.keys()) == 1 and store.read("t_cdc").count() == 51
    store.compact("t_cdc")
    assert len(store.manifest()["t_cdc"]) == 1 and store.read("t_cdc").count() == 51


def test_satellite_load_appends_and_logs_exceptions(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    cfg = satellite.Satellite(("k",), ("v",), "ts", deletes=False)
    empty = W.CTX.stamped(spark.createDataFrame([], "k int, v string, valid_from_dttm timestamp_ntz"))
    load = lambda target, source: satellite.load(target, source, cfg, W.CTX)
    first = spark.createDataFrame([(1, "a", datetime(2024, 1, 1)), (1, "b", datetime(2024, 1, 1))], "k int, v string, ts timestamp_ntz")
    run_incremental(store, "s", first, load, empty)
    run_incremental(store, "s", spark.createDataFrame([(1, "c", datetime(2024, 1, 2))], first.schema), load, empty)
    assert len(store.manifest()["s"]) == 2 and sorted(r.v for r in store.read("s").collect()) == ["a", "c"]
    assert [r.exception_type_code for r in store.read("load_exception").collect()] == ["NUK"]


def test_appends_take_new_columns(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    store.commit({}, appends={"t": spark.createDataFrame([(1,)], "a int")})
    store.commit({}, appends={"t": spark.createDataFrame([("x",)], "b string")})
    assert sorted(map(repr, store.read("t").collect())) == sorted(["Row(a=1, b=None)", "Row(a=None, b='x')"])
    wide = schemas.evolve(store.read("t"), T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.DateType())]))
    assert wide.dtypes == [("a", "bigint"), ("b", "string"), ("c", "date")]
    with pytest.raises(ValueError):
        schemas.evolve(store.read("t"), T.StructType([T.StructField("b", T.LongType())]))


def test_extracts_window_load_type_and_mark(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    schema = "k int, v string, d int"
    load = lambda rows, **more: run_ods(store, "x", spark.createDataFrame(rows, schema), ["k"], ["v", "d"], None, W.CTX, "jdbc_snap", cut="d", **more)
    state = lambda: {r.k: (r.v, r.snp_delete_flg) for r in store.read("x_snp").collect()}
    mark = lambda: [r.cut_value for r in store.read("cut_param").where("table_nm = 'x'").collect()]
    load([(1, "a", 1), (2, "a", 5), (3, "a", 9)])
    assert state() == {1: ("a", 0), 2: ("a", 0), 3: ("a", 0)} and mark() == ["9"]
    load([(2, "b", 6)], window=F.col("d") > 4)  # 3 is in the window and gone, 1 is outside it
    assert state() == {1: ("a", 0), 2: ("b", 0), 3: ("a", 1)}
    load([(4, "n", 12)], window=F.col("d") > 4, full_history=True)
    load([(5, "n", 11)], load_type="A")
    assert state() == {1: ("a", 0), 2: ("b", 0), 3: ("a", 1), 4: ("n", 0), 5: ("n", 0)} and mark() == ["11"]
    load([(1, "a", 1), (2, "b", 6), (3, "a", 9), (4, "n", 12), (5, "n", 11)], load_type="R")
    assert state()[3] == ("a", 0)


def test_messages_across_batches(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    day = lambda d: datetime(2024, 1, d)
    load = lambda rows: run_ods(store, "m", spark.createDataFrame(rows, "k int, v string, snap timestamp_ntz"), ["k"], ["v"], "snap", W.CTX, "message_lib")
    load([(1, "a", day(1)), (2, "a", day(1))])
    load([(1, "b", day(2)), (3, "a", day(2)), (1, "b", day(3))])  # 2 is in neither, 3 only in the first
    state = {r.k: (r.v, r.snap.day, r.snp_delete_flg) for r in store.read("m_snp").collect()}
    assert state == {1: ("b", 2, 0), 2: ("a", 2, 1), 3: ("a", 3, 1)}
    load([(1, "old", day(2))])  # not newer than the state
    assert {r.k: r.v for r in store.read("m_snp").where("snp_delete_flg = 0").collect()} == {1: "b"}


def test_models_are_checked():
    model = models.OdsModel("es", ("k", "k"), "ver", "type", "X", "cut")
    assert len(model.problems(["k"])) == 5
    with pytest.raises(ValueError, match="custom needs a hook"):
        models.OdsModel("custom", ("k",), "k").validate(["k"])
    models.OdsModel("jdbc_snap", ("k",)).validate(["k"])


def test_custom_strategy(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([(1, "a", 1)], "k int, v string, ver int")
    hook = lambda df: df.withColumns({"cdc_type_code": F.lit("I"), "rn_asc": F.lit(1), "rn_desc": F.lit(1), "hash": F.lit("h")})
    run_ods(store, "c", rows, ["k"], ["v"], "ver", W.CTX, "custom", hook=hook)
    assert [tuple(r) for r in store.read("c_snp").collect()] == [(1, "a", 1, 0)]


def test_hooks_and_dictionaries(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    seen = []
    add = lambda name: lambda df: df.withColumn(name, F.lit(name))
    hooks = models.OdsHooks(tmp_fields=lambda df: df.where("k > 0"), post_tmp=lambda df: seen.append(df.columns) or df, cdc_fields=add("log_field"), snp_fields=add("state_field"), cdc_load=lambda df: df.where("k < 9"),
                            cut_param=lambda rows, entries: rows.agg(F.max("ver").cast("string").alias("cut_value")).withColumns({"table_nm": F.lit("t"), "column_nm": F.lit("mine")}))
    colours = models.Dictionary("COL", "v", "v", "v", "SRC", elements=True)
    rows = spark.createDataFrame([(0, "a", 1, "create"), (1, "red", 2, "create"), (2, "blue", 3, "create"), (9, "red", 4, "create")], "k int, v string, ver int, ce_type string")
    run_ods(store, "t", rows, ["k"], ["v"], "ver", W.CTX, hooks=hooks, dictionaries=[colours], partition_by={"t_cdc": ["cdc_type_code"]})
    assert sorted(r.k for r in store.read("t_cdc").collect()) == [1, 2] and sorted(r.k for r in store.read("t_snp").collect()) == [1, 2, 9]
    assert store.read("t_cdc").first().log_field == "log_field" and store.read("t_snp").first().state_field == "state_field" and seen
    assert [tuple(r) for r in store.read("cut_param").collect()] == [("t", "mine", "4")]
    assert sorted((r.element_code, r.element_desc) for r in store.read("udd_element").collect()) == [("blue", "blue"), ("red", "red")]
    assert list((tmp_path / "store").glob("t_cdc/*/cdc_type_code=I"))
    later = spark.createDataFrame([(1, "red", 5, "delete"), (3, "green", 6, "create")], rows.schema)
    run_ods(store, "t", later, ["k"], ["v"], "ver", LoadContext(datetime(2024, 2, 2), "wf"), hooks=models.OdsHooks(snp_load=lambda state, changes: state), dictionaries=[colours])
    assert sorted((r.source_element_code, r.status_code) for r in store.read("udd_element_map").collect()) == [("blue", "USE"), ("green", "USE"), ("red", "OBS"), ("red", "USE")]
    assert store.read("t_snp").count() == 3


def test_stream_is_captured_and_replays_change_nothing(spark, tmp_path):
    source, store = tmp_path / "in", TableStore(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([(1, "a", 1, "create"), (1, "b", 2, "update")], "k int, v string, ver int, ce_type string")
    rows.write.parquet(f"file://{source}")
    for checkpoint in ("one", "two"):  # the second reads all again
        events = spark.readStream.schema(rows.schema).parquet(f"file://{source}")
        capture.capture_stream(events, store, "t", ["k"], ["v"], "ver", f"file://{tmp_path}/{checkpoint}", clock=lambda n: datetime(2024, 2, 1)).awaitTermination(120)
    assert [tuple(r) for r in store.read("t_snp").collect()] == [(1, "b", 2, 0)]
    assert sorted(r.cdc_type_code for r in store.read("t_cdc").collect()) == ["I", "U"]


def test_jdbc_options_and_ranges():
    plain = store_module.jdbc_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "pushDownPredicate": "true"}
    ranged = store_module.jdbc_options("jdbc:x", "t", "k", ("1", "9"), 4)
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("k", "1", "9", "4")
    with pytest.raises(ValueError):
        store_module.jdbc_options("jdbc:x", "t", "k")
    assert store_module.range_predicates("k", 0, 9, 3) == ["k < 4 or k is null", "k >= 4 and k < 8", "k >= 8"]
    assert store_module.range_predicates("k", 5, 5, 3) == ["true"]


def test_schema_sets():
    a, b = T.StructType.fromDDL("x int, y string, z date"), T.StructType.fromDDL("x bigint, Y string, w int")
    assert schemas.common(a, b) == ["x"] and schemas.missing(a, b) == ["y", "z"] and schemas.retyped(a, b) == {"x": ("bigint", "int")}
    assert schemas.same(a, T.StructType.fromDDL("x int, y int")) == ["x"]


def test_masks_and_grants(spark):
    df = spark.createDataFrame([(1, "n")], "Id int, Name string")
    assert catalog.masked(df, [" name"]).columns == ["Id"] and catalog.masked(df).columns == ["Id", "Name"]
    assert catalog.grants("t", "v", "all", "few") == ["grant select on t to few", "grant select on v to all"]


def test_comments_statistics_and_swap(spark):
    spark.sql("create database if not exists loom_ddl")
    try:
        spark.createDataFrame([(1, "a")], "k int, v string").write.saveAsTable("loom_ddl.t")
        catalog.comment_on(spark, "loom_ddl.t", "it's a table", {"v": "the value"})
        catalog.analyze(spark, "loom_ddl.t")
        catalog.analyze(spark, "loom_ddl.t", ["k"])
        told = {r.col_name: (r.data_type, r.comment) for r in spark.sql("describe extended loom_ddl.t").collect()}
        assert told["Comment"][0] == "it's a table" and told["v"][1] == "the value" and "1 rows" in told["Statistics"][0]
        spark.createDataFrame([(2, "b")], "k int, v string").write.saveAsTable("loom_ddl.fresh")
        catalog.swap(spark, "loom_ddl.fresh", "loom_ddl.t")
        assert [r.k for r in spark.table("loom_ddl.t").collect()] == [2] and not spark.catalog.tableExists("loom_ddl.fresh")
        catalog.create_masked_view(spark, "loom_ddl.t", "loom_ddl.masked", ["V"])
        assert spark.table("loom_ddl.masked").columns == ["k"]
    finally:
        spark.sql("drop database loom_ddl cascade")


def test_entry_without_the_training_operators(tmp_path):
    """With both folders gone, queries and SQL are those of the loaders; here and in a new process."""
    for name in ("lakeloom", "corpus_pipeline.py", "__spark_entry__.py"):
        source = Path(__file__).resolve().parent.parent / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'pit_full' in q and set(s) <= set(q) and not [n for n in q if n.startswith('op') and n[2].isdigit()], q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(tmp_path)})
