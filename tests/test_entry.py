from pyspark.sql import functions as F

import __spark_entry__ as E
from payrun.plans import queries as Q


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"batch_id", "moneda_pago", "dia_pago", "rows", "total_monto_final"}


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the training-data queries, where present, state theirs in their own package
    assert set(Q.registry()) - set(o) == {"files_by_date", "json_records"}


def test_json_records_hold_the_processed_rows(spark):
    """No oracle (number texts differ between engines): the records read back as the rows."""
    sheet = Q.q_ordered_output(spark, E.SF_SMOKE).drop("batch_id")
    records = Q.q_json_records(spark, E.SF_SMOKE)
    back = records.select(F.from_json("record", sheet.schema).alias("r")).select("r.*")

    def digest(df):
        h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        return df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()

    assert digest(back) == digest(sheet)
