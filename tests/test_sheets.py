import csv

import pytest
from pyspark.sql import functions as F

from payrun import rules as R
from payrun.operators import header as H
from payrun.sources import sheets


def write(path, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows(rows)


def test_headers_past_column_64(spark, tmp_path):
    wide = [f"x{i}" for i in range(60)] + list(R.EXPECTED_HEADERS)
    cells = [f"v{i}" for i in range(82)] + ['a "quoted", cell', "two\nlines"]
    write(tmp_path / "wide.csv", [wide, cells])
    write(tmp_path / "narrow.csv", [list(R.EXPECTED_HEADERS), [str(i) for i in range(24)], ["only"]])
    grid = sheets.read_grid(spark, str(tmp_path))
    assert sheets.sheet_width(spark, str(tmp_path)) == 84
    got = {(r.batch_id, r.row_idx): r.cells for r in grid.collect()}
    assert got["wide", 1] == cells and len(got["narrow", 2]) == 84
    named = {(r.batch_id, r.row_idx): r for r in H.promote_header(grid).collect()}
    assert named["wide", 1].numero_factura == "v60" and named["wide", 1].proveedor_remito == "two\nlines"
    assert named["narrow", 1].proveedor_remito == "23" and named["narrow", 2].numero_oc is None


def test_wider_record_than_the_schema_is_an_error(spark, tmp_path):
    write(tmp_path / "a.csv", [["1", "2", "3"]])
    raw = spark.read.schema(sheets.wide_schema(2)).options(**sheets.CSV_OPTIONS).csv(str(tmp_path))
    with pytest.raises(Exception, match="more than 2 cells"):
        sheets.sheet_rows(raw, 2).agg(F.sum(F.size("cells"))).collect()


def test_equal_names_in_two_folders(spark, tmp_path):
    for folder, values in (("a b", ["1", "2"]), ("c", ["3"])):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder / "lote.x.csv", [[v, "y"] for v in values])
    write(tmp_path / "lote.x.csv", [["9", "y"]])
    grid = sheets.read_grid(spark, str(tmp_path), recursive=True)
    got = sorted((r.batch_id, r.row_idx, r.cells[0]) for r in grid.collect())
    assert got == [("a%20b/lote.x", 0, "1"), ("a%20b/lote.x", 1, "2"), ("c/lote.x", 0, "3"), ("lote.x", 0, "9")]
    assert sorted(r.batch_id for r in sheets.read_grid(spark, str(tmp_path)).collect()) == ["lote.x"]
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan           # the sheets themselves were read once, before


def test_many_files_in_one_task_and_a_csv_lookup(spark, tmp_path):
    for k in range(30):
        write(tmp_path / f"s{k:02}.csv", [[f"{k}-{i}", "z"] for i in range(k + 1)])
    got = {(r.batch_id, r.row_idx): r.cells[0] for r in sheets.read_grid(spark, str(tmp_path)).collect()}
    assert got == {(f"s{k:02}", i): f"{k}-{i}" for k in range(30) for i in range(k + 1)}
    (tmp_path / "lookup").mkdir()
    write(tmp_path / "lookup" / "areas.csv", [["codigo", "area"], ["7", "A"], ["7", "B"], ["", "C"]])
    areas = sheets.read_areas(spark, str(tmp_path / "lookup"), "csv")
    from payrun.operators import areas as A
    assert [(r.codigo, r.area) for r in A.dedupe_areas(areas).collect()] == [("7", "B")]


def test_columns_a_sheet_keeps(spark):
    """An empty unknown column goes, an empty expected one stays; columns past the 62nd too."""
    hdr = ["Numero de Factura", "Monto", "Moneda", "RIF", "Cuenta", "vacia", "extra", None, "extra"] + [f"u{i}" for i in range(70)]
    row = ["F1", "1", None, "", "c", "NA", "x", "y", None] + [None] * 69 + ["last"]
    grid = spark.createDataFrame([("b", 0, hdr), ("b", 1, row), ("b", 2, [None] * 79), ("only header", 0, hdr)], "batch_id string, row_idx int, cells array<string>")
    got = {r.batch_id: [c.name for c in r["columns"]] for r in H.sheet_columns(grid).collect()}
    assert got == {"b": ["Numero de Factura", "Monto", "Moneda", "RIF", "Cuenta", "extra", "u69"],
                   "only header": ["Numero de Factura", "Monto", "Moneda", "RIF", "Cuenta"]}
    rows = sorted(H.promote_all(grid).collect(), key=lambda r: r.row_idx)
    assert [(r.numero_factura, r.unknown) for r in rows] == [("F1", {"extra": "x", "u69": "last"}), (None, {"extra": None, "u69": None})]
    from payrun.operators import summary
    assert summary.sheet_summary(grid).where("batch_id = 'b'").first().total_columnas == 7 + 16
