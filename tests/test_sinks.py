import os
import uuid

import pytest
from pyspark.sql import functions as F

from payrun import rules as R
from payrun.operators import publish as P
from payrun.plans import pipeline
from payrun.plans import queries as Q
from payrun.sinks import files as SF
from payrun.sinks import warehouse as WH
from payrun.sources import fixtures as FX
from payrun.sources import listing as LS
from payrun.sources import sheets as SH

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def table():
    return "t_" + uuid.uuid4().hex


@pytest.fixture(scope="module")
def shape(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shape") / "rows")
    Q.q_warehouse_shape(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sheet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sheet") / "rows")
    Q.q_ordered_output(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def digest(df):
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


# -- warehouse (K4, A11) ---------------------------------------------------------

def test_round_trip_in_each_mode(spark, shape, table):
    n = shape.count()
    first = WH.load(shape, table, "empty", "a").first()
    assert (first.load_id, first.mode, first.rows_uploaded, first.rows_in_table) == ("a", "empty", n, n)
    assert digest(spark.table(table)) == digest(shape.drop("batch_id"))
    assert spark.table(table).schema.names == P.warehouse_schema().names
    one = shape.where("batch_id = 'batch-1'")
    second = WH.load(one, table, "append", "b").first()
    assert (second.rows_uploaded, second.rows_in_table) == (one.count(), n + one.count() == spark.table(table).count() and n + one.count())
    assert digest(spark.table(table)) == digest(shape.unionByName(one).drop("batch_id"))
    third = WH.load(one, table, "replace", "c").first()
    assert third.rows_uploaded == third.rows_in_table == one.count()
    assert digest(spark.table(table)) == digest(one.drop("batch_id"))
    assert {r.load_id: r.rows for r in WH.loads(spark, table).collect()} == {"c": one.count()}


def test_a_load_run_again_replaces_its_own_rows(spark, shape, table):
    WH.load(shape, table, "append", "a")                    # the first append makes the table
    WH.load(shape, table, "append", "b")
    again = WH.load(shape.where("batch_id = 'batch-0'"), table, "append", "b").first()
    assert again.rows_in_table == shape.count() + shape.where("batch_id = 'batch-0'").count()


def test_empty_mode(spark, shape, table):
    none = shape.where("false")
    assert WH.load(none, table, "empty").first().rows_in_table == 0
    assert WH.load(shape, table, "empty").first().rows_in_table == shape.count()
    with pytest.raises(WH.TableNotEmpty):
        WH.load(shape, table, "empty")
    assert spark.table(table).count() == shape.count()


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_a_failed_load_leaves_the_table(spark, shape, table, mode):
    WH.load(shape, table, "replace", "a")
    before = digest(spark.table(table))
    broken = shape.withColumn("monto", F.when(F.col("batch_id") == "batch-3", F.raise_error(F.lit("no"))).otherwise(F.col("monto")))
    with pytest.raises(Exception, match="no"):
        WH.load(broken, table, mode, "b")
    assert digest(spark.table(table)) == before
    assert WH.load(shape, table, mode, "b").first().rows_uploaded == shape.count()


def test_readers_of_the_replaced_table_keep_its_files(spark, shape, table):
    WH.load(shape, table, "replace")
    old = WH.generations(spark, table)[0]
    WH.load(shape, table, "replace")
    assert spark.table(old).count() == shape.count()
    WH.load(shape, table, "replace")
    assert not spark.catalog.tableExists(old)
    with pytest.raises(ValueError, match="none of"):
        WH.load(shape, table, "overwrite")


# -- staging (K1, K6, S10, C9) -------------------------------------------------------

def test_a_run_replaces_its_own_batches_only(spark, sheet, tmp_path):
    path = str(tmp_path / "staging")
    SF.write_staging(sheet, path)
    assert digest(SH.read_staging(spark, path)) == digest(sheet)
    before = files(path)
    assert {f.split("batch_id=")[1].split("/")[0] for f in before} == {f"batch-{i}" for i in range(4)}
    SF.write_staging(sheet.where("batch_id = 'batch-2' AND Moneda = 'USD'"), path)
    after = files(path)
    others = {f: t for f, t in before.items() if "batch-2" not in f}
    assert {f: t for f, t in after.items() if "batch-2" not in f} == others
    assert not {f for f in before if "batch-2" in f} & set(after)
    SF.write_staging(sheet.where("batch_id = 'batch-0'"), path, reset="all")
    assert all("batch_id=batch-0" in f for f in files(path))


def test_batch_names_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("007", "F1"), ("8", "F2")], "batch_id string, `Numero de Factura` string")
    SF.write_staging(df, str(tmp_path / "s"))
    assert sorted(r.batch_id for r in SH.read_staging(spark, str(tmp_path / "s")).collect()) == ["007", "8"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_step2_on_staged_output(spark, sheet, shape, tmp_path, fmt):
    """Display names and, in CSV, number texts: the warehouse shape is that of the direct path."""
    path = str(tmp_path / fmt)
    SF.write_staging(sheet, path, fmt)
    table = SH.read_staging(spark, path, fmt)
    assert "ÁREA" in table.columns and pipeline.processed_already(pipeline.resolve_names(table))
    got = pipeline.step2_shape(table, FX.areas(spark, SF_DIR), Q.batch_rates(spark, SF_DIR), Q.run_ts())
    assert digest(got.select(shape.columns)) == digest(shape)


def test_names_are_resolved_without_case(spark):
    names = ["batch_id", "NUMERO DE FACTURA", "tipo\nfactura ", "Id Cta", "prioridad ORIGEN", "ÁREA", "capex", "Tipo Capex", "otra", "Prioridad"]
    df = spark.createDataFrame([tuple("0123456789")], ", ".join(f"`{n}` string" for n in names))
    got = pipeline.resolve_names(df)
    assert got.columns == ["batch_id", "numero_factura", "tipo_factura", "codigo_cuenta", "prioridad", "area", "tipo_capex_2", "tipo_capex", "otra"]
    assert tuple(got.first()) == tuple("012345678")
    assert set(pipeline.canonical_names().values()) == {*R.INPUT_COLUMNS, *R.DERIVED_COLUMNS}


# -- dated output (K2, K3, K5, K7, K8) and its listing (S8, A8, A9) ----------------------

def test_runs_are_kept_and_listed(spark, sheet, tmp_path):
    root, rates, areas = str(tmp_path / "logs"), Q.batch_rates(spark, SF_DIR), FX.areas(spark, SF_DIR)
    times = ["2026-01-15 14:30:00", "2026-01-15 15:30:00", "2026-01-16 02:00:00", "2026-01-17 12:00:00"]    # the third is the 15th in Caracas
    for t in [*times, times[0]]:                            # the first run is written again
        SF.write_run(sheet, rates, areas, root, F.lit(t).cast("timestamp_ntz"), records=True, max_rows=500)
    detail = SF.read_folders(spark, f"{root}/detail")
    counts = {(r.run_date, r.run_stamp): r["count"] for r in detail.groupBy("run_date", "run_stamp").count().collect()}
    n = sheet.count()
    assert counts == {("2026-01-15", "20260115_103000"): n, ("2026-01-15", "20260115_113000"): n, ("2026-01-15", "20260115_220000"): n,
                      ("2026-01-17", "20260117_080000"): n}
    assert digest(detail.where("run_date = '2026-01-17'").select(sheet.columns)) == digest(sheet)
    assert SF.read_folders(spark, f"{root}/areas").count() == 4 * areas.count()
    assert SF.read_folders(spark, f"{root}/rates").count() == 4 * 5 * 4
    assert spark.read.text(f"{root}/records").count() == 4 * n
    sizes = detail.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes <= 500
    found = files(f"{root}/detail")
    listed = LS.list_files(spark, f"{root}/detail")
    by_date = {r.fecha: r.total_archivos for r in LS.files_by_date(listed).collect()}
    assert by_date == {d: sum(f"run_date={d}/" in f for f in found) for d in ("2026-01-15", "2026-01-17")}
    assert list(by_date) == ["2026-01-17", "2026-01-15"]    # newest first
    assert tuple(LS.listing_totals(listed).first()) == (len(found), 2)
    assert {r.bytes for r in listed.collect()} == {os.path.getsize(f) for f in found}
