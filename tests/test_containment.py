import random

import pytest
from pyspark.sql import functions as F

from payrun.operators import areas as A
from payrun.operators import containment
from payrun.rules import PayRules


def texts(pick, n):
    return list({"".join(pick.choice("AB .É") for _ in range(pick.randint(1, 6))) for _ in range(n)})


def rows(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_index_equals_the_loop_over_pairs(spark):
    pick = random.Random(1)
    a, b = texts(pick, 60), texts(pick, 60)
    got = containment.matches(rows(spark, a + [""], "value"), rows(spark, b + [""], "rule"))
    assert sorted(map(tuple, got.collect())) == sorted((x, y) for x in a for y in b if x in y or y in x)


def test_no_loop_over_pairs_in_the_plan(spark):
    plan = containment.matches(rows(spark, ["AB"], "value"), rows(spark, ["ABC"], "rule"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("nonblank", [False, True])
def test_flags_equal_the_chain(spark, nonblank):
    pick = random.Random(2)
    always = texts(pick, 12) + ["a lower case rule"]
    branch = tuple((p, tuple(texts(pick, 3))) for p in texts(pick, 15))
    rules = PayRules(always_recargas_providers=tuple(f"{r}XYZ" for r in always), branch_recargas_providers=branch, require_nonblank_match=nonblank)
    values = [(p, o) for p in texts(pick, 40) + ["", "XYZ", "QQ"] for o in texts(pick, 6) + ["", "ZZ"]]
    df = spark.createDataFrame(values, "_prov_u string, _suc_u string")
    chain = df.select("*", A.provider_rule(F.col("_prov_u"), rules).alias("_always"),
                      A.provider_branch_rule(F.col("_prov_u"), F.col("_suc_u"), rules).alias("_branch"))
    got = A.add_rule_flags(df, rules).select(chain.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, chain.collect()))


def test_ten_thousand_rules(spark):
    """The area of each row equals that of the chain, which is checked in Python here."""
    pick = random.Random(3)
    words = ["".join(pick.choice("ABCDEFGHIJ") for _ in range(6)) for _ in range(10_000)]
    rules = PayRules(always_recargas_providers=tuple(words[:6000]), branch_recargas_providers=tuple((w, (words[i],)) for i, w in enumerate(words[6000:])))
    assert A.rule_count(rules) == 10_000 > A.INLINE_RULES
    provs = [f"X {w} Y" if k % 2 else w[1:4] for k, w in enumerate(pick.sample(words, 60))]
    data = [(p, pick.choice([words[1], "SEDE", words[2][:2], ""]), "9") for p in provs] + [(f"X {w} Y", f"S {words[i]}", "9") for i, w in enumerate(words[6000:6040])]
    areas = spark.createDataFrame([(1, "9", "Redes")], "pos long, codigo string, area string")
    df = A.add_area(spark.createDataFrame(data, "proveedor string, sucursal string, solicitante string"), areas, rules)

    def either(x, y):
        return x in y or y in x

    def expected(p, o):
        if any(either(r, p) for r in rules.always_recargas_providers) or any(either(r, p) and any(either(b, o) for b in bs) for r, bs in rules.branch_recargas_providers):
            return "RECARGAS"
        return "Redes"

    got = {(r.proveedor, r.sucursal): r.area for r in df.collect()}
    want = {(p, o): expected(p, o) for p, o, _ in data}
    assert got == want and set(want.values()) == {"RECARGAS", "Redes"}
