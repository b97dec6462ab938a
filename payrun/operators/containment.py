"""J2 and J3 with many rules: which texts contain a rule or lie in one.

A text s lies in a text t only if every gram (three characters, or s itself where it
is shorter) of s occurs in t. So the long side is listed by its distinct grams, each
short text looks up the rarest of its own ones, and the few pairs found are tested
with ``contains``: an inverted index instead of a loop over all pairs. Both
directions run on distinct texts; the flags are joined back to the rows.

The many joins of texts and grams are sort-merge joins: as a table for every task, each of
them would take the driver 32 MB and more, all at once, however small it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .keyed import join_keyed

GRAM = 3


def grams(c: Column, size) -> Column:
    """Distinct substrings of ``size`` characters (none where the text is shorter)."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(c) >= size, F.sequence(F.lit(1), F.length(c) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(c, i, size)))


def merged(df: DataFrame) -> DataFrame:
    """Joined by sorting, not by a table that the driver holds."""
    return df.hint("merge")


def contained(short: DataFrame, long: DataFrame) -> DataFrame:
    """All ``(s, t)`` of ``short(s)`` and ``long(t)`` where t contains s, blank s left out."""
    s, t = F.col("s"), F.col("t")
    index = long.distinct().select("t", F.explode(F.array_union(F.array_union(grams(t, 1), grams(t, 2)), grams(t, GRAM))).alias("gram"))
    seen = index.groupBy("gram").agg(F.count("*").alias("n"))
    wanted = short.where(s != "").distinct().select("s", F.explode(grams(s, F.least(F.length(s), F.lit(GRAM)))).alias("gram"))
    rarest = (wanted.join(merged(seen), "gram", "left").groupBy("s")
              .agg(F.min_by("gram", F.coalesce("n", F.lit(0))).alias("gram"), F.min(F.coalesce("n", F.lit(0))).alias("n")))
    return rarest.where(F.col("n") > 0).join(merged(index), "gram").where(t.contains(s)).select("s", "t").distinct()


def matches(values: DataFrame, rules: DataFrame) -> DataFrame:
    """All ``(value, rule)`` of ``values(value)`` and ``rules(rule)`` where one contains the other;
    blank texts (which match everything) are left to the caller."""
    inside = contained(rules.select(F.col("rule").alias("s")), values.select(F.col("value").alias("t")))
    around = contained(values.select(F.col("value").alias("s")), rules.select(F.col("rule").alias("t")))
    return inside.select(F.col("t").alias("value"), F.col("s").alias("rule")).union(
        around.select(F.col("s").alias("value"), F.col("t").alias("rule"))).where((F.col("value") != "") & (F.col("rule") != "")).distinct()


def flag_rules(df: DataFrame, always: DataFrame, branch: DataFrame, provider: str = "_prov_u", office: str = "_suc_u",
               blank_matches: bool = True, broadcast_bytes: int | None = None) -> DataFrame:
    """Adds ``_always`` (J2: the provider matches a rule of ``always(rule)``) and ``_branch``
    (J3: provider and branch match one row of ``branch(provider, branch)``).

    Columns and rules hold upper-cased, stripped texts. A blank text lies in every
    other (Q1): it matches any rule unless ``blank_matches`` is off.
    """
    always = always.select("rule").distinct()
    branch = branch.select(F.col("provider").alias("_rp"), F.col("branch").alias("_rb")).distinct()
    p, o = F.col(provider), F.col(office)
    pairs = stored(df.select(p.alias("_p"), o.alias("_o")).distinct(), "pairs")        # the one pass over the rows before the joins
    providers = pairs.select(F.col("_p").alias("value")).distinct()
    hit = matches(providers, always).select("value").distinct()
    if blank_matches:
        any_rule = always.limit(1).select(F.lit("").alias("value"))
        blank_rule = providers.join(F.broadcast(always.where("rule = ''").limit(1).select(F.lit(True).alias("_x"))), F.lit(True), "inner").select("value")
        hit = hit.union(any_rule).union(blank_rule).distinct()

    by_provider = matches(pairs.select(F.col("_p").alias("value")), branch.select(F.col("_rp").alias("rule")))
    by_branch = matches(pairs.select(F.col("_o").alias("value")), branch.select(F.col("_rb").alias("rule")))
    fits_p = by_provider.select(F.col("value").alias("_p"), F.col("rule").alias("_rp"))
    fits_b = by_branch.select(F.col("value").alias("_o"), F.col("rule").alias("_rb"))
    found = [pairs.join(merged(fits_p), "_p").join(merged(branch), "_rp").join(merged(fits_b), ["_o", "_rb"]).select("_p", "_o")]
    if blank_matches:
        found.append(pairs.where("_o = ''").join(merged(fits_p), "_p", "left_semi"))                   # a blank branch fits any rule of the provider
        found.append(pairs.where("_p = ''").join(merged(fits_b), "_o", "left_semi"))                   # a blank provider fits any provider's rule
        found.append(pairs.where("_p = '' AND _o = ''").join(F.broadcast(branch.limit(1).select(F.lit(True).alias("_x"))), F.lit(True), "left_semi"))
    both = found[0]
    for more in found[1:]:
        both = both.unionByName(more)

    flagged = join_keyed(df, hit.select(F.col("value").alias(provider), F.lit(True).alias("_a")), provider, "left", broadcast_bytes)
    keyed = both.distinct().select(F.struct(F.col("_p").alias("p"), F.col("_o").alias("o")).alias("_pair"), F.lit(True).alias("_b"))
    flagged = join_keyed(flagged.withColumn("_pair", F.struct(p.alias("p"), o.alias("o"))), keyed, "_pair", "left", broadcast_bytes)
    return flagged.withColumns({"_always": F.coalesce("_a", F.lit(False)), "_branch": F.coalesce("_b", F.lit(False))}).drop("_a", "_b", "_pair")
