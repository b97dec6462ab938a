import pytest
from pyspark.sql import functions as F

from payrun.operators import derive as D
from payrun.operators import rates as RT
from payrun.plans import pipeline

COLS = "batch_id string, numero_factura string, moneda string, prioridad string, cuenta string, monto string, " \
       "monto_capex_ext string, monto_capex_ord string, monto_cadm string, proveedor string, sucursal string, solicitante string"


def rows(spark, data):
    return spark.createDataFrame(data, COLS)


def derive(spark, data, ves=40.0, eur=1.2, cop=0.00025):
    areas = spark.createDataFrame([(1, "123", "Redes")], "pos long, codigo string, area string")
    df = RT.literal_rates(D.ensure_inputs(rows(spark, data)), ves, eur, cop)
    return pipeline.derive_all(df, areas).orderBy("numero_factura").collect()


def test_currency_account_day(spark):
    data = [
        ("b", "1", None, "70", "A1", "10", "0", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),
        ("b", "2", "eur", "10", "A2", "10", "0", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),
        ("b", "3", " usd ", "70", None, "10", "0", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),
        ("b", "4", "USD", "83", "A4", "10", "0", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),
        ("b", "5", "USD", "60", "A5", "10", "0", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),
        ("b", "6", "GBP", "60", "A6", "10", "0", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),
        ("b", "7", "COP", "n/d", "A7", "10", "0", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),
    ]
    r = derive(spark, data)
    assert [x.moneda_pago for x in r] == ["VES", "EUR", "USD", "VES", "VES", "VES", "COP"]
    assert [x.cuenta_bancaria for x in r] == ["A1", "A2", "", "A4", "1111", "A6", "A7"]
    assert [x.dia_pago for x in r] == ["JUEVES", "VIERNES", "VIERNES", "JUEVES", "JUEVES", "JUEVES", "JUEVES"]
    # Priority 70/83 in the no-conversion list keep the amount; EUR (Friday) x ves;
    # USD outside the lists, GBP (Q13) and COP are paid on Thursday: x (ves + 5)
    assert [x.monto_final for x in r] == [10.0, 400.0, 10.0, 10.0, 450.0, 450.0, 450.0]


def test_capex_split_and_usd(spark):
    data = [
        ("b", "1", "VES", "60", "A", "100", "30", "10", "60", "ACME SUMINISTROS", "SEDE CENTRO", "123"),   # mixed
        ("b", "2", "VES", "60", "A", "100", "0", "0", "50", "ACME SUMINISTROS", "SEDE CENTRO", "123"),    # opex only
        ("b", "3", "VES", "60", "A", "100", "5", "-5", "0", "ACME SUMINISTROS", "SEDE CENTRO", "123"),    # total 0, ext+ord=0
        ("b", "4", "EUR", "60", "A", "100", "40", "0", "0", "ACME SUMINISTROS", "SEDE CENTRO", "0"),      # ext only, requester 0
        ("b", "5", "VES", "60", "A", "100", "0", "20", "20", "RECARGAS MOVIL C.A", "S", "123"),
        ("b", "6", "VES", "60", "A", "0", "1", "1", "1", "ACME SUMINISTROS", "SEDE CENTRO", "123"),        # monto 0
    ]
    r = {x.numero_factura: x for x in derive(spark, data)}
    m = r["1"]
    assert m.monto_capex_final == pytest.approx(40.0) and m.monto_opex_final == pytest.approx(60.0)
    assert m.tipo_capex_2 == "MIXTA" and m.tipo_capex == "MIXTA"
    assert m.monto_capex_ord_2 + m.monto_capex_ext_3 == pytest.approx(m.monto_capex_final)
    assert m.monto_total_usd == pytest.approx(m.monto_capex_usd + m.monto_opex_usd)
    assert m.monto_capex_usd == pytest.approx(40.0 / 45.0)                  # VES -> / Thursday rate
    assert r["2"].tipo_capex_2 == "OPEX" and r["2"].tipo_capex == "OPEX" and r["2"].monto_capex_final == 0.0
    assert r["3"].monto_capex_final == 0.0 and r["3"].monto_opex_final == 100.0
    e = r["4"]
    assert e.area == "SERVICIOS" and e.tipo_capex == "EXT"
    assert e.monto_final == pytest.approx(100 * 40.0)                        # EUR paid on Friday: x ves (Q2)
    assert e.monto_capex_usd == pytest.approx(4000.0 * 1.2)
    assert r["5"].area == "RECARGAS" and r["5"].tipo_capex == "RECARGAS" and r["5"].monto_capex_ord_2 == 0.0
    assert r["1"].area == "Redes"
    assert r["6"].monto_final == 0.0 and r["6"].monto_total_usd == 0.0


def test_to_usd_dead_branches(spark):
    from payrun.functions import money
    df = spark.createDataFrame([(10.0, "VES", "MARTES"), (10.0, "COP", "JUEVES"), (0.0, "EUR", "VIERNES")],
                               "x double, mp string, dp string")
    got = df.select(money.to_usd(F.col("x"), F.col("mp"), F.col("dp"), F.lit(2.0), F.lit(0.0), F.lit(1.5),
                                 passthrough=("USD",)).alias("u")).collect()
    assert [g.u for g in got] == [5.0, 0.0, 0.0]                               # MARTES / ves; zero rate -> 0
