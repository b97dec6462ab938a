"""What keeps the cost of a row small: short compiled methods, few passes, few shuffles."""

import os
import re

import pytest
from pyspark.sql import functions as F

from payrun import rules as R
from payrun.operators import areas as A
from payrun.operators import clean as C
from payrun.operators import containment, exact, header
from payrun.operators import publish as P
from payrun.operators import rates as RT
from payrun.plans import pipeline
from payrun.session import CLEANUP, stored
from payrun.sinks import files as SF
from payrun.sinks import warehouse as WH
from payrun.sources import fixtures as FX

INTERPRETED = 8000          # bytecodes of a method that the JVM does not compile


def largest_method(df) -> int:
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan))


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture()
def derived(spark, tmp_path):
    texts = [c for c in R.INPUT_COLUMNS if not c.startswith("monto")]
    invoices = spark.range(20).selectExpr("'batch-' || id % 2 AS batch_id", *[f"'{c} ' || id AS {c}" for c in texts],
                                          *[f"CAST(id AS DOUBLE) AS {c}" for c in R.INPUT_COLUMNS if c.startswith("monto")])
    invoices.write.parquet(f"{tmp_path}/invoices")
    areas = spark.createDataFrame([(1, "solicitante 3", "VENTAS")], "pos long, codigo string, area string")
    rates = RT.default_rates(spark.createDataFrame([("batch-0",), ("batch-1",)], "batch_id string"))
    return pipeline.step1(spark.read.parquet(f"{tmp_path}/invoices"), areas, rates)


def test_derivation_is_compiled(static_plans, derived):
    assert derived.count() == 20
    for shape in (P.processed_sheet(derived), P.json_records(P.processed_sheet(derived)), P.warehouse_shape(derived)):
        assert largest_method(shape) < INTERPRETED


def test_named_rows_are_compiled(spark, static_plans, tmp_path):
    cells = ", ".join(f"'{h}'" for h in R.EXPECTED_HEADERS)
    spark.range(10).selectExpr("'b' AS batch_id", "id AS row_idx", f"IF(id = 0, array({cells}), transform(sequence(1, 24), i -> CAST(i + id AS STRING))) AS cells").write.parquet(f"{tmp_path}/grid")
    rows = header.named_rows(spark.read.parquet(f"{tmp_path}/grid"))
    assert rows.count() == 9 and largest_method(rows) < INTERPRETED


def test_sums_make_one_row_a_value(spark, static_plans):
    df = spark.createDataFrame([("x", 0.5, 1e-278), ("x", None, 2.0 ** 60)], "k string, a double, b double")
    sums = exact.exact_sums(df, ["k"], ["a", "b"])
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "aggregate(" not in plan
    assert [tuple(r) for r in sums.collect()] == [("x", 0.5, 2.0 ** 60)]


def test_rules_read_the_rows_once(spark, static_plans, tmp_path):
    spark.createDataFrame([("ACME, C.A.", "NORTE"), ("OTHER", "SUR")], "_prov_u string, _suc_u string").write.parquet(f"{tmp_path}/facts")
    always = spark.createDataFrame([("ACME",)], "rule string")
    branch = spark.createDataFrame([("OTHER", "SUR")], "provider string, branch string")
    flagged = containment.flag_rules(spark.read.parquet(f"{tmp_path}/facts"), always, branch)
    assert flagged._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/facts") == 1
    assert sorted((r._prov_u, r._always, r._branch) for r in flagged.collect()) == [("ACME, C.A.", True, False), ("OTHER", False, True)]


def test_a_load_moves_no_rows(spark, derived):
    table = "payrun_scale_load"
    shape = P.warehouse_shape(derived).repartition(3)
    assert WH.load(shape, table, "replace", "a").first().rows_in_table == 20
    current, previous = WH.generations(spark, table)
    files = spark.table(current).select("_metadata.file_path").distinct().count()
    spark.sql(f"DROP VIEW {table}")
    spark.sql(f"DROP TABLE {WH.quoted(current)}")
    assert files == 3


@pytest.fixture()
def tables(spark, tmp_path):
    """Eight lines of four orders, with what the invoice view joins to them."""
    made = {
        "nation": spark.sql("SELECT 1 AS n_nationkey, 'PERU' AS n_name"),
        "customer": spark.range(4).selectExpr("id AS c_custkey", "1 AS c_nationkey", "'BUILDING' AS c_mktsegment"),
        "supplier": spark.range(3).selectExpr("id AS s_suppkey", "'Supplier#' || id AS s_name", "1 AS s_nationkey"),
        "orders": spark.range(4).selectExpr("id AS o_orderkey", "id AS o_custkey", "DATE'2026-01-02' AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": spark.range(8).selectExpr("id % 4 AS l_orderkey", "id AS l_partkey", "id % 3 AS l_suppkey", "CAST(id DIV 4 + 1 AS INT) AS l_linenumber",
                                              "'A' AS l_returnflag", "100.5D * id AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "DATE'2026-02-03' AS l_shipdate"),
    }
    for name, table in made.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture()
def no_broadcast(spark, static_plans):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_not_shuffled_by_customer(spark, no_broadcast, tables):
    view = FX.invoices(spark, tables)
    plan = plan_of(view)
    assert re.findall(r"Join \[(\w+)#", plan) == ["l_suppkey", "l_orderkey", "c_nationkey", "o_custkey"]
    written = FX.INVOICES_SQL.format(extra="", **{t: r for t, r in FX.spark_refs(tables).items() if t in FX.TABLES})
    assert view.count() == 8 and view.exceptAll(spark.sql(written)).isEmpty()


def test_text_amounts_are_compiled(spark, static_plans, tables):
    raw = FX.raw_invoices(spark, tables)
    assert raw.count() == 8 and raw.exceptAll(spark.sql(FX.raw_invoices_sql(FX.spark_refs(tables)))).isEmpty()
    assert largest_method(C.coerce_numbers(C.clean(raw))) < INTERPRETED


def test_lookup_does_not_sort_the_facts(spark, no_broadcast, tables):
    df = A.attach_area_lookup(FX.invoices(spark, tables), FX.areas(spark, tables))
    assert "ShuffledHashJoin [_lookup_key" in plan_of(df) and df.count() == 8


def test_a_run_of_few_batches_is_written_where_it_is(spark, derived, tmp_path):
    sheet = P.processed_sheet(derived).repartition(3)
    rates = RT.rates_from_quotes(spark.sql("SELECT 'batch-0' AS batch_id, CAST(NULL AS MAP<STRING, STRING>) AS ves_quote, '' AS cop_payload, '' AS eur_payload, "
                                           "CAST(NULL AS TIMESTAMP) AS ves_fetched_at, CAST(NULL AS TIMESTAMP) AS cop_fetched_at, CAST(NULL AS TIMESTAMP) AS eur_fetched_at"), ["batch_id"])
    areas = spark.createDataFrame([(1, "3", "VENTAS")], "pos long, codigo string, area string")
    SF.write_run(sheet, rates, areas, f"{tmp_path}/run", F.lit("2026-01-15 14:30:00").cast("timestamp_ntz"))
    rows = SF.read_folders(spark, f"{tmp_path}/run/detail")
    assert rows.count() == 20 and rows.select("_metadata.file_path").distinct().count() > 2
    assert SF.few_batches(spark.range(SF.FEW_FOLDERS)) and not SF.few_batches(spark.range(SF.FEW_FOLDERS + 1))


ODD_CODES = ["7", " 8 ", "0.0", "", "n\u0002o", "\u0003", "a\u0001b", "\u0001", "ñandú 火", "X-7", "77", "+9", "absent", None]


def test_packed_lookup_equals_the_shuffled_one(spark, tmp_path):
    spark.createDataFrame([(i, c) for i, c in enumerate(ODD_CODES * 2)], "id long, solicitante string").write.parquet(f"{tmp_path}/facts")
    spark.createDataFrame([(i, c, a) for i, (c, a) in enumerate([*((c, f"AREA \u0002{i % 3}\u0001") for i, c in enumerate(ODD_CODES) if c != "absent"), ("7", None), ("77", "\u0003")])]
                          + [(100 + i, f"code {i}", "MANY") for i in range(500)], "pos long, codigo string, area string").write.parquet(f"{tmp_path}/areas")
    facts, areas = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("facts", "areas"))
    rows = [sorted(map(tuple, A.attach_area_lookup(facts, areas, **least).select("id", "_sol_key", A.LOOKUP_COL).collect()), key=str) for least in ({}, {"packed_bytes": -1})]
    assert rows[0] == rows[1] and len(rows[0]) == 2 * len(ODD_CODES)
    found = {ODD_CODES[i % len(ODD_CODES)]: a for i, _, a in rows[0]}
    assert found["7"] == "SERVICIOS" and found["77"] == "\u0003" and found["n\u0002o"] == "AREA \u00021\u0001" and found["absent"] is found[""] is found["0.0"] is None
    assert A.attach_area_lookup(facts, areas.limit(0)).where(f"{A.LOOKUP_COL} IS NULL").count() == len(rows[0])


def test_lookup_moves_no_rows(spark, static_plans, tables):
    df = A.attach_area_lookup(FX.invoices(spark, tables), FX.areas(spark, tables))
    plan = plan_of(df)
    facts = plan[plan.index("BroadcastHashJoin [_bucket"):]
    assert "_lookup_key" not in plan and not re.search(r"hashpartitioning\((solicitante|_sol_key|_bucket)", facts[:facts.index("BroadcastExchange")])
    assert df.count() == 8


def shuffle_files(spark) -> set[str]:
    """Those of more than the few bytes that a count shuffles."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f and f.endswith(".data") and os.path.exists(f) and os.path.getsize(f) > 500}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    dealt = spark.range(1000).selectExpr("'b' || id % 3 AS batch_id", "id").repartition(5, "id")
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    assert stored(dealt, "dealt").count() == 1000
    SF.write_staging(dealt, f"{tmp_path}/staging", few=True)
    assert SF.read_folders(spark, f"{tmp_path}/staging").count() == 1000
    left = shuffle_files(spark)
    WH.load(P.warehouse_shape(dealt), "payrun_scale_dropped", "replace", "a")
    current, _ = WH.generations(spark, "payrun_scale_dropped")
    names = [r.file_path for t in (spark.table(current), SF.read_folders(spark, f"{tmp_path}/staging")) for r in t.select("_metadata.file_path").distinct().collect()]
    spark.sql("DROP VIEW payrun_scale_dropped")
    spark.sql(f"DROP TABLE {WH.quoted(current)}")
    assert left <= before and spark.conf.get(CLEANUP) == setting
    assert dealt.exceptAll(dealt).isEmpty() and not shuffle_files(spark) <= before
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_step2_is_compiled(spark, static_plans, derived, tmp_path):
    P.processed_sheet(derived).write.parquet(f"{tmp_path}/sheet")
    rates = RT.default_rates(spark.createDataFrame([("batch-0",), ("batch-1",)], "batch_id string"))
    shape = pipeline.step2_shape(spark.read.parquet(f"{tmp_path}/sheet"), spark.createDataFrame([], "pos long, codigo string, area string"), rates)
    assert shape.count() == 20 and largest_method(shape) < INTERPRETED


def test_rules_are_not_broadcast(spark, static_plans, tmp_path):
    """Each broadcast costs the driver 32 MB at least; the two of the flags are measured."""
    spark.createDataFrame([("ACME, C.A.", "NORTE"), ("OTHER", "SUR"), ("", "")], "_prov_u string, _suc_u string").write.parquet(f"{tmp_path}/facts")
    always = spark.createDataFrame([("ACME",)], "rule string")
    branch = spark.createDataFrame([("OTHER", "SUR")], "provider string, branch string")
    values = spark.read.parquet(f"{tmp_path}/facts").selectExpr("_prov_u AS value")
    assert "BroadcastExchange" not in plan_of(containment.matches(values, always))
    flagged = containment.flag_rules(spark.read.parquet(f"{tmp_path}/facts"), always, branch)
    assert plan_of(flagged).count("BroadcastExchange") == 2
    assert sorted((r._prov_u, r._always, r._branch) for r in flagged.collect()) == [("", True, True), ("ACME, C.A.", True, False), ("OTHER", False, True)]
