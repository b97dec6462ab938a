from pyspark.sql import functions as F

from payrun import rules as R
from payrun.functions import dates, text
from payrun.operators import areas


def test_strip_matches_python(spark):
    vals = ["　x ", " a ", "\tb\n", "c", "", None, "  ", "é ", " \u0085z\x1c", "a b"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(text.strip("s")).collect()]
    assert got == [None if v is None else v.strip() for v in vals]


def test_num_and_int_coercion(spark):
    vals = [" 12.5 ", "1e3", "+7", ".5", "5.", "1,234", "1_000", "0x10", "NaN", "inf", "abc", None, "-1.5", "69.9"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    rows = df.select(text.num(F.col("s")).alias("n"), text.to_int(F.col("s")).alias("i")).collect()
    nums = [r.n for r in rows]
    assert nums == [12.5, 1000.0, 7.0, 0.5, 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, -1.5, 69.9]
    assert [r.i for r in rows][-2:] == [-1, 69]        # truncation toward zero


def test_null_tokens(spark):
    vals = ["NA", "n/a", " n/a ", "<NA>", "#N/A", " None ", "null", "x", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [tuple(r) for r in df.select(text.null_if_token(F.col("s"), R.NULL_TOKENS),
                                       text.is_empty_cell(F.col("s"), R.NULL_TOKENS)).collect()]
    kept = [None, None, " n/a ", None, None, " None ", None, "x", None, None]
    assert got == [(v, v is None) for v in kept]


def test_large_integers_and_non_finite(spark):
    df = spark.createDataFrame([("3000000000",), ("1e25",), ("1e999",), ("-1e999",), ("-0.0",)], "s string")
    rows = df.select(text.num(F.col("s")).alias("n"), text.to_int(F.col("s")).alias("i")).collect()
    assert [r.n for r in rows] == [3e9, 1e25, 0.0, 0.0, 0.0]
    assert [r.i for r in rows] == [3_000_000_000, 0, 0, 0, 0]
    d = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.7976931348623157e308,), (None,)], "v double")
    assert [r[0] for r in d.select(text.num(F.col("v"), d.schema["v"].dataType)).collect()] == [0.0, 0.0, 1.7976931348623157e308, 0.0]


def test_cells_are_stripped_as_python_does(spark):
    vals = ["　x ", " a ", "a\t", "~", "!", "", None, "  ", "é ", "é", "xé", " \u0085z\x1c", "a b", "\x7f", "z\u3000", "J-12"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [tuple(r) for r in df.select(text.strip_cell("s"), text.upper_cell("s")).collect()]
    assert got == [(None, None) if v is None else (v.strip(), v.strip().upper()) for v in vals]


def test_plain_integers_read_as_numbers_do(spark):
    vals = ["0", "-0", "7", "-7", "+7", "007", " 7", "7 ", "", None, "n/d", "1e3", "0.0", "1e-400", "999999999999999", "9007199254740993",
            "9223372036854775807", "9223372036854775808", "1_0", "٣", "0x1", "7L"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    by_pattern = F.coalesce(text.num("s").try_cast("bigint"), F.lit(0).cast("bigint"))
    zero = (F.col("s") == "") | (F.coalesce(text.text_to_double("s"), F.lit(1.0)) == 0)
    for r in df.select("s", text.to_int("s").alias("i"), by_pattern.alias("j"), areas.requester_is_zero(F.col("s")).alias("z"), zero.alias("y")).collect():
        assert (r.i, r.z) == (r.j, r.y), r


def test_dates_read_as_their_formats_do(spark):
    vals = ["2025-01-31", "2025-02-30", "2025-1-1 x", "2025-01-1T", "2025-01-1 ", " 2025-01-31 ", "0000-01-01", "0001-01-01", "9999-12-31", "+2025-01-1",
            "1582-10-10", "31/01/2025", "2025/01/31", "31-01-2025", "2025-01-31 10:00:00", "2025-01-31T10:00:00", "", "n/d", None, "20250131", "２０２５-01-01"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    by_format = F.coalesce(*[F.try_to_timestamp(text.strip("s"), F.lit(f)) for f in R.DATE_FORMATS]).cast("date")
    other = ("yyyy-dd-MM", "yyyy-MM-dd")
    for r in df.select("s", dates.parse_date("s", R.DATE_FORMATS).cast("string").alias("d"), by_format.cast("string").alias("e"),
                       dates.parse_date(F.lit("2025-01-02"), other).cast("string").alias("o")).collect():
        assert r.d == r.e and r.o == "2025-02-01", r

