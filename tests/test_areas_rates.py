from pyspark.sql import functions as F

from payrun.operators import areas as A
from payrun.operators import rates as RT


def test_lookup_last_wins_and_nulls(spark):
    areas = spark.createDataFrame([(1, "7", "A"), (2, " 7 ", "B"), (3, None, "C"), (4, "8", None)],
                                  "pos long, codigo string, area string")
    got = {r.codigo: r.area for r in A.dedupe_areas(areas).collect()}
    assert got == {"7": "B", "8": "SERVICIOS"}


def test_provider_rules_blank_matches(spark):
    df = spark.createDataFrame([("",), ("RECARGAS MOVIL C.A",), ("OTRO",), ("NETUNO",)], "p string")
    got = [r[0] for r in df.select(A.provider_rule(F.col("p"))).collect()]
    assert got == [True, True, False, False]                                 # Q1: blank matches
    df2 = spark.createDataFrame([("NETUNO, C.A.", "RECARGAS NORTE"), ("NETUNO, C.A.", "SEDE"),
                                 ("CORPORACION DIGITEL, C.A.", "PREPAGO RECARGA NORTE"),
                                 ("CORPORACION DIGITEL, C.A.", "SEDE")], "p string, s string")
    got2 = [r[0] for r in df2.select(A.provider_branch_rule(F.col("p"), F.col("s"))).collect()]
    assert got2 == [True, False, True, False]          # branch text contained in the cell


def test_pick_quote_classes(spark):
    q = spark.createDataFrame([
        ("a", 1, '{"nombre":"BCV","promedio":"10"}'), ("a", 2, '{"nombre":"Paralelo","promedio":"20"}'),
        ("a", 3, '{"nombre":"Oficial","promedio":"30,5"}'),
        ("b", 1, '{"nombre":"X","promedio":"1"}'), ("b", 2, '{"nombre":"Paralelo","promedio":"2"}'),
        ("b", 3, '{"nombre":"paralelo 2","promedio":"3"}'),
        ("c", 5, '{"nombre":"X","promedio":"7"}'), ("c", 4, '{"nombre":"Y","promedio":"8"}'),
    ], "k string, pos int, payload string").select("k", "pos", F.from_json("payload", RT.QUOTE_MAP).alias("quote"))
    got = {r.k: (r.pos, r.v) for r in RT.pick_quote(q, ["k"]).select("k", "pos", RT.ves_value(F.col("quote")).alias("v")).collect()}
    assert got == {"a": (3, 30.5), "b": (3, 3.0), "c": (4, 8.0)}


def test_snapshot_defaults(spark):
    rows = [
        ("a", 1, "VES", '{"nombre":"BCV","promedio":null,"compra":"9"}'),        # explicit null -> default
        ("a", 2, "COP", '[{"valor":4000}]'),
        ("a", 3, "EUR", '{"amount":1.0,"rates":{"USD":1.16}}'),
        ("b", 1, "VES", '{"nombre":"BCV","compra":"9,5"}'),
        ("b", 2, "COP", '{"promedio":4000,"compra":"n/d"}'),                   # bad compra fails COP
        ("b", 3, "EUR", '{"rates":'),                                            # broken JSON
    ]
    q = spark.createDataFrame(rows, "k string, pos int, pair string, payload string")
    got = {r.k: r for r in RT.snapshot_from_quote_rows(q, ["k"]).collect()}
    a, b = got["a"], got["b"]
    assert (a.ves, a.ves_thursday, a.ves_is_default) == (36.5, 41.5, True)
    assert (a.cop, a.eur) == (4000.0, 1.16)
    assert (b.ves, b.ves_thursday) == (9.5, 14.5)
    assert (b.cop, b.cop_is_default, b.eur, b.eur_is_default) == (0.00024, True, 1.1, True)


def ves(spark, answers):
    rows = [("k", i, "VES", a, f"2026-01-0{i + 1} 10:00:00") for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "k string, pos int, pair string, payload string, at string")
    return df.withColumn("fetched_at", F.col("at").cast("timestamp_ntz")).drop("at")


def test_list_answers(spark):
    """One fold per answer keeps the order of the source across all of them."""
    def got(*answers):
        r = RT.snapshot_from_quote_rows(ves(spark, answers), ["k"]).first()
        return r.ves, r.ves_source, r.ves_date, r.ves_answered, r.ves_is_default, str(r.ves_fetched_at)[:10]

    official = '[{"nombre":"Paralelo","promedio":2},{"nombre":"BCV","promedio":"3,5","fechaActualizacion":"f"},{"nombre":"X","promedio":9}]'
    assert got(official) == (3.5, "BCV", "f", True, False, "2026-01-01")
    assert got(official, '[{"nombre":"paralelo","promedio":7}]') == (3.5, "BCV", "f", True, False, "2026-01-01")
    assert got(official, '[{"nombre":"oficial","promedio":7}]')[:2] == (7.0, "oficial")           # the last official one
    assert got('[{"nombre":"A","promedio":5},{"nombre":"B","promedio":6}]', '[{"nombre":"C","promedio":8}]')[:2] == (5.0, "A")
    assert got("[]", official)[0] == 3.5
    assert got('[{"nombre":"A","promedio":0}]') == (36.5, "A", "2026-01-01", True, True, "2026-01-01")    # answered, not used
    assert got('[{"compra":4}]') == (4.0, "DolarAPI Venezuela", "2026-01-01", True, False, "2026-01-01")
    for broken in ("[]", "[", "null", "7", '["x"]', '[{"nombre":null,"promedio":3}]', "[{}]", '[{},{"nombre":"A","promedio":3}]', None):
        assert got("[", broken) == (36.5, "default", None, False, True, "2026-01-02"), broken


def test_answered_is_not_used(spark):
    rows = [("a", 0, "VES", '[{"nombre":"BCV","promedio":"n/d"}]'), ("a", 1, "COP", '{"valor":0}'), ("a", 2, "EUR", '{"rates":{"USD":0}}'),
            ("b", 0, "VES", "[]"), ("b", 1, "COP", "[]"), ("b", 2, "EUR", '{"rates":{"USD":1.2},"date":"d"}')]
    q = spark.createDataFrame(rows, "k string, pos int, pair string, payload string")
    assert {r.k: r.rates_ok for r in RT.rates_collected(q, ["k"]).collect()} == {"a": 2, "b": 1}
    r = {r.k: r for r in RT.snapshot_from_quote_rows(q, ["k"]).collect()}
    assert (r["a"].cop, r["a"].cop_source, r["a"].cop_is_default) == (0.00024, "DolarAPI Colombia", True)
    assert (r["b"].eur, r["b"].eur_source, r["b"].eur_date) == (1.2, "Frankfurter API (ECB)", "d")


def test_exploded_quotes_are_those_of_sound_answers(spark):
    df = spark.createDataFrame([(1, '[{"nombre":"A"},{"nombre":"B"}]'), (2, '{"nombre":"C"}'), (3, "["), (4, '[{"nombre":null}]')], "k int, payload string")
    got = RT.explode_quote_list(df, ["k"]).select("k", "pos", F.col("quote")["nombre"]).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "A"), (1, 1, "B"), (2, 0, "C")]
