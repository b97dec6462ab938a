import json
import os
import tempfile

from pyspark.sql import functions as F

from payrun import rules as R
from payrun.operators import header as H
from payrun.operators import publish as P

EXP = list(R.EXPECTED_HEADERS)


def grid(spark, rows):
    return spark.createDataFrame(rows, "batch_id string, row_idx long, cells array<string>")


def test_detection_cases(spark):
    g = grid(spark, [
        ("h1", 0, ["Titulo"] + [None] * 23), ("h1", 2, EXP), ("h1", 3, [str(i) for i in range(24)]),
        ("h2", 0, [str(i) for i in range(12)]), ("h2", 1, EXP[:3] + [h.upper() for h in EXP[3:]]),
        ("h3", 0, ["a", "b"]), ("h3", 25, EXP),
    ])
    got = {r.batch_id: (r.header_row, r.method) for r in H.detect_headers(g).collect()}
    assert got == {"h1": (2, "match"), "h2": (1, "fallback"), "h3": (0, "first_row")}


def test_promote_names_and_duplicates(spark):
    hdr = list(EXP)
    hdr[0] = "Numero de\nFactura"
    hdr[13] = "Moneda"          # repeated name: the first one is used
    g = grid(spark, [("b", 0, hdr), ("b", 1, ["F1"] + ["x"] * 9 + ["USD"] + ["y"] * 13)])
    r = H.promote_header(g).collect()[0]
    assert r.numero_factura == "F1" and r.moneda == "USD" and r.banco is None


def test_warehouse_schema_and_json(spark):
    sch = P.warehouse_schema("p_")
    assert len(sch.fields) == 43 and sch.fields[0].name == "p_numero_factura"
    df = spark.createDataFrame([("b", "x", None, 1.5)], "batch_id string, a string, n string, v double")
    rec = json.loads(P.json_records(df).first().record)
    assert rec == {"a": "x", "n": None, "v": 1.5}


def test_sink_round_trip(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="payrun-test-"), "staging")
    df = spark.createDataFrame([("b1", 1.0), ("b2", 2.0)], "batch_id string, monto double")
    df.write.mode("overwrite").partitionBy("batch_id").parquet(out)
    back = spark.read.parquet(out)
    assert sorted((r.batch_id, r.monto) for r in back.collect()) == [("b1", 1.0), ("b2", 2.0)]
    df.where(F.col("batch_id") == "b1").write.mode("append").partitionBy("batch_id").parquet(out)
    assert spark.read.parquet(out).count() == 3            # Q11: append duplicates
