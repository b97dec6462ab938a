import csv
import os
import tempfile

from payrun import rules as R
from payrun.streaming import uploads


def write_sheet(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(rows)


def test_inbox_stream_processes_each_sheet(spark):
    root = tempfile.mkdtemp(prefix="payrun-stream-")
    inbox, out = os.path.join(root, "inbox"), os.path.join(root, "out")
    os.makedirs(inbox)
    hdr = list(R.EXPECTED_HEADERS)
    row = ["F1", "OC1", "A", "L", "Prov", "J-1", "2024-01-02", "T", "SEDE", "100", "VES", "2024-02-01", "C1",
           "", "", "", "", "60", "10", "0", "0", "", "5", ""]
    write_sheet(os.path.join(inbox, "lote-a.csv"), [["Titulo"], hdr, row, ["Total de Facturas"]])
    write_sheet(os.path.join(inbox, "lote-b.csv"), [hdr, row, row])
    areas = spark.createDataFrame([(1, "5", "Redes")], "pos long, codigo string, area string")
    rates = spark.createDataFrame([("lote-a", 40.0, 45.0, 1.2, 0.0003)],
                                  "batch_id string, ves double, ves_thursday double, eur double, cop double")
    q = uploads.start(spark, inbox, out, areas, rates, width=24,
                      checkpoint=os.path.join(root, "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    counts = {r.batch_id: r["count"] for r in got.groupBy("batch_id").count().collect()}
    assert counts == {"lote-a": 1, "lote-b": 2}
    a = got.where("batch_id = 'lote-a'").first()
    assert a.area == "Redes" and a.monto_final == 100.0 and a.tasa_bolivares == 40.0
