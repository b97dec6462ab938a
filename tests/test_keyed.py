import pytest
from pyspark.sql import functions as F

from payrun import rules as R
from payrun.operators import clean as C
from payrun.operators import derive as D
from payrun.operators import header as H
from payrun.operators import rates as RT

EXP = list(R.EXPECTED_HEADERS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, rows=2000):
    """Nine tenths of the rows in one batch."""
    return spark.range(rows).select(F.when(F.col("id") % 10 > 0, "big").otherwise(F.concat(F.lit("b"), F.col("id"))).alias("batch_id"),
                                    F.col("id").alias("monto"), F.create_map(F.lit("k"), "id").alias("m"))


@pytest.mark.parametrize("limit", [None, 0])
def test_rates_leave_the_facts_in_place_or_spread_them(spark, limit):
    facts = skewed(spark).unionByName(spark.range(1).select(F.lit(None).cast("string").alias("batch_id"), F.lit(-1).alias("monto"),
                                                            F.create_map(F.lit("k"), F.lit(1).cast("long")).alias("m")))
    rates = spark.createDataFrame([("big", 40.0, 45.0, 1.2, 0.1), ("b10", 50.0, 55.0, 1.3, 0.2)],
                                  "batch_id string, ves double, ves_thursday double, eur double, cop double")
    df = RT.attach_rates(facts, rates, broadcast_bytes=limit)
    text = plan(df)
    assert ("BroadcastHashJoin" in text) == (limit is None) and ("_salt" in text) == (limit == 0)
    got = {r.batch_id: (r["count"], r.ves) for r in df.groupBy("batch_id").agg(F.count("*").alias("count"), F.max("tasa_bolivares").alias("ves")).collect()}
    assert got["big"] == (1800, 40.0) and got["b10"] == (1, 50.0) and got["b20"] == (1, 36.5) and got[None] == (1, 36.5)
    if limit == 0:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # small partitions would be joined
        moved = df.groupBy(F.spark_partition_id()).count().collect()
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert max(r["count"] for r in moved) < 0.6 * 2001      # of four tasks none gets the big batch


@pytest.mark.parametrize("limit", [None, 0])
def test_promotion_with_a_large_batch(spark, limit):
    rows = [("a", 0, EXP), ("b", 0, ["title"]), ("b", 1, EXP[::-1])]
    rows += [("a", i, [f"a{i}-{k}" for k in range(24)]) for i in range(1, 400)] + [("b", 2, [f"b-{k}" for k in range(23, -1, -1)])]
    grid = spark.createDataFrame(rows, "batch_id string, row_idx int, cells array<string>")
    got = H.promote_header(grid, broadcast_bytes=limit)
    assert ("_salt" in plan(got)) == (limit == 0)
    found = {(r.batch_id, r.row_idx): r for r in got.collect()}
    assert len(found) == 400
    assert [found["a", 7][c] for c in R.INPUT_COLUMNS] == [f"a7-{k}" for k in range(24)]
    assert [found["b", 2][c] for c in R.INPUT_COLUMNS] == [f"b-{k}" for k in range(24)]


def test_filters_above_cleaning_prune_the_scan(spark, tmp_path):
    cols = ", ".join(f"{c} string" for c in ("batch_id", "numero_factura", "monto"))
    df = spark.createDataFrame([("x", "F1", "1"), ("y", "F2", "2"), ("y", None, None), ("y", "Total", "2")], cols)
    df.write.partitionBy("batch_id").parquet(str(tmp_path / "t"))
    cleaned = C.clean(D.ensure_inputs(spark.read.parquet(str(tmp_path / "t")))).where("batch_id = 'y'")
    scan = next(line for line in plan(cleaned).split("\n") if "FileScan" in line)
    assert "= y)]" in scan.split("PartitionFilters: ")[1].split(", PushedFilters")[0]
    assert [r.numero_factura for r in cleaned.collect()] == ["F2"]
