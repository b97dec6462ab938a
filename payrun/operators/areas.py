"""The business area of each invoice.

* J2/J3 are "theta" rules: provider text contains a rule text or is
  contained in it (and, for J3, the same for the branch). Up to ``INLINE_RULES``
  they are an OR-chain of ``contains`` inside the projection, so no join is planned
  at all; more are matched by the gram index of ``containment``.
* J1 is a left join from the stripped requester code to a deduplicated lookup (the
  last duplicate wins). The lookup is measured: packed, many codes a row, it goes to
  every task; one too large for that is joined by a shuffle, where AQE's skew
  handling splits a requester code that holds a large share of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import text
from ..rules import DEFAULT_RULES, PayRules
from ..session import stored
from .containment import flag_rules

LOOKUP_COL = "_area_lookup"
INLINE_RULES = 64
NO_REQUESTER_KEYS = 256
PACKED_BYTES = 128 << 20    # of codes and areas, each area once a code: packed, it stands once a bucket
BUCKET_CODES = 64
ESCAPE, CODE, AREA = "\u0001", "\u0002", "\u0003"
MARKS = ((ESCAPE, "a"), (CODE, "b"), (AREA, "c"))


def _contains_either(value: Column, rule_text: str, require_nonblank: bool) -> Column:
    """``rule in value or value in rule`` (Python ``in`` on text)."""
    rule_u = rule_text.upper()
    hit = value.contains(F.lit(rule_u)) | F.lit(rule_u).contains(value)
    return hit & (value != "") if require_nonblank else hit


def provider_rule(prov: Column, rules: PayRules = DEFAULT_RULES) -> Column:
    """Provider is one of the always-top-up providers."""
    hits = [_contains_either(prov, r, rules.require_nonblank_match)
            for r in rules.always_recargas_providers]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def provider_branch_rule(prov: Column, branch: Column, rules: PayRules = DEFAULT_RULES) -> Column:
    """Provider matches a conditional rule and the branch one of its texts."""
    hits = []
    for provider, branches in rules.branch_recargas_providers:
        branch_hit = reduce(lambda a, b: a | b,
                            [_contains_either(branch, b, rules.require_nonblank_match)
                             for b in branches], F.lit(False))
        hits.append(_contains_either(prov, provider, rules.require_nonblank_match) & branch_hit)
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def requester_key(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> Column:
    """Stripped requester text; a missing requester reads as ``'0'``."""
    sol = text.as_text(F.col("solicitante"), text.dtype_of(df, "solicitante"))
    return F.coalesce(text.strip(text.null_if_token(sol, rules.null_tokens)), F.lit("0"))


def requester_is_zero(sol: Column) -> Column:
    """Requester blank or numerically zero -> SERVICIOS; integers need no regular expression."""
    return (sol == "") | F.coalesce(text.plain_int(sol) == 0, F.coalesce(text.text_to_double(sol), F.lit(1.0)) == 0)


def dedupe_areas(areas: DataFrame) -> DataFrame:
    """S3 -> lookup: one row per stripped code, the last position wins.

    ``areas`` has ``pos`` (row order), ``codigo`` and ``area``. Null codes
    are skipped; a null area reads as SERVICIOS. ``max_by`` is a partial
    (map-side) aggregate, so a code repeated many times never gathers its
    rows in one task.
    """
    a = areas.where(F.col("codigo").isNotNull()).select(
        F.col("pos"),
        text.strip(F.col("codigo").cast("string")).alias("codigo"),
        F.coalesce(text.strip(F.col("area").cast("string")), F.lit(R.SERVICIOS)).alias("area"),
    )
    return a.groupBy("codigo").agg(F.max_by("area", "pos").alias("area"))


def escaped(c: Column) -> Column:
    """A text without the marks of a packed lookup."""
    for mark, code in MARKS:
        c = F.replace(c, F.lit(mark), F.lit(ESCAPE + code))
    return c


def unescaped(c: Column) -> Column:
    for mark, code in reversed(MARKS):
        c = F.replace(c, F.lit(ESCAPE + code), F.lit(mark))
    return c


def bucket_of(code: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(code), F.lit(buckets))


def packed_lookup(lookup: DataFrame, buckets: int) -> DataFrame:
    """``_bucket, _packed``: the codes of a bucket in one text, each area followed by its codes."""
    coded = lookup.select(bucket_of(F.col("codigo"), buckets).alias("_bucket"), escaped(F.col(LOOKUP_COL)).alias("_area"), escaped(F.col("codigo")).alias("_code"))
    by_area = coded.groupBy("_bucket", "_area").agg(F.array_join(F.collect_list("_code"), CODE).alias("_codes"))
    one = F.concat(F.lit(AREA), F.col("_area"), F.lit(CODE), F.col("_codes"), F.lit(CODE))
    return by_area.groupBy("_bucket").agg(F.array_join(F.collect_list(one), "").alias("_packed"))


def packed_area(packed: Column, sought: Column) -> Column:
    """The area of a code, ``sought`` as it stands in the packed text; null where it doesn't."""
    before = F.call_function("substring_index", packed, sought, F.lit(1))
    area = F.substring_index(F.substring_index(before, AREA, -1), CODE, 1)
    return F.when(F.contains(packed, sought), unescaped(area))


def broadcasts(spark: SparkSession) -> bool:
    """Whether the session lets tables go to every task (a negative threshold forbids it)."""
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


def attach_area_lookup(df: DataFrame, areas: DataFrame, rules: PayRules = DEFAULT_RULES, packed_bytes: int = PACKED_BYTES) -> DataFrame:
    """Left join the deduplicated lookup on the requester code.

    The lookup is stored and measured. Up to ``packed_bytes`` of text it goes to every task,
    some ``BUCKET_CODES`` codes a row: a hash table of single codes would take many times the
    memory, and to be shuffled by code the wide rows would have to go to the disk.

    Beyond that, or where the session broadcasts nothing, both sides are shuffled. A blank or zero requester has no area of its own
    (D7), and often most rows have none: their rows get keys that match nothing and spread
    over the tasks. Each task looks its part of the codes up in a hash table; to merge
    them, the wide rows would have to be sorted.
    """
    lookup = stored(dedupe_areas(areas).withColumnRenamed("area", LOOKUP_COL), "areas")
    measured = lookup.agg(F.count("*").alias("codes"), F.sum(F.octet_length("codigo") + F.octet_length(LOOKUP_COL)).alias("bytes")).first()
    keyed = df.withColumn("_sol_key", requester_key(df, rules))
    if broadcasts(df.sparkSession) and (measured.bytes or 0) <= packed_bytes:
        buckets = measured.codes // BUCKET_CODES + 1
        packed = packed_lookup(lookup, buckets).withColumnRenamed("_bucket", "_of")
        keyed = keyed.withColumn("_bucket", F.when(~requester_is_zero(F.col("_sol_key")), bucket_of(F.col("_sol_key"), buckets)))
        found = keyed.join(F.broadcast(packed), F.col("_bucket") == F.col("_of"), "left")
        sought = F.concat(F.lit(CODE), escaped(F.col("_sol_key")), F.lit(CODE))
        return found.withColumn(LOOKUP_COL, packed_area(F.col("_packed"), sought)).drop("_bucket", "_of", "_packed")
    none = F.concat(F.lit("\u0000"), (F.monotonically_increasing_id() % NO_REQUESTER_KEYS).cast("string"))
    keyed = keyed.withColumn("_lookup_key", F.when(requester_is_zero(F.col("_sol_key")), none).otherwise(F.col("_sol_key")))
    return (keyed.join(lookup.hint("shuffle_hash"), keyed["_lookup_key"] == lookup["codigo"], "left")
            .drop("codigo", "_lookup_key"))


def add_area_inputs(df: DataFrame) -> DataFrame:
    """Upper-cased, stripped provider and branch as helper columns.

    The rule chain reads each of them many times; as columns they are
    computed once per row.
    """
    return df.withColumns({
        "_prov_u": F.coalesce(text.upper_cell(text.as_text(F.col("proveedor"), text.dtype_of(df, "proveedor"))), F.lit("")),
        "_suc_u": F.coalesce(text.upper_cell(text.as_text(F.col("sucursal"), text.dtype_of(df, "sucursal"))), F.lit("")),
    })


def rule_count(rules: PayRules) -> int:
    return len(rules.always_recargas_providers) + sum(len(b) for _, b in rules.branch_recargas_providers)


def add_rule_flags(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """J2 + J3 by index, as columns ``_always`` and ``_branch``; needs ``add_area_inputs``."""
    spark = df.sparkSession
    always = spark.createDataFrame([(r.upper(),) for r in rules.always_recargas_providers], "rule string")
    branch = spark.createDataFrame([(p.upper(), b.upper()) for p, bs in rules.branch_recargas_providers for b in bs],
                                   "provider string, branch string")
    return flag_rules(df, always, branch, blank_matches=not rules.require_nonblank_match)


def area(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> Column:
    """D7 ``AREA``; needs ``attach_area_lookup`` and ``add_area_inputs`` first (and
    ``add_rule_flags`` where the rules are many)."""
    prov, suc, sol = F.col("_prov_u"), F.col("_suc_u"), F.col("_sol_key")
    flagged = "_always" in df.columns
    return (
        F.when(F.col("_always") if flagged else provider_rule(prov, rules), F.lit(R.RECARGAS))
        .when(F.col("_branch") if flagged else provider_branch_rule(prov, suc, rules), F.lit(R.RECARGAS))
        .when(requester_is_zero(sol), F.lit(R.SERVICIOS))
        .otherwise(F.coalesce(F.col(LOOKUP_COL), F.lit(R.SERVICIOS)))
    )


HELPER_COLS = ("_sol_key", LOOKUP_COL, "_prov_u", "_suc_u", "_always", "_branch")


def derive_area(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """J2, J3 and D7 on rows that carry the lookup's area; drops the helper columns."""
    df = add_area_inputs(df)
    if rule_count(rules) > INLINE_RULES:
        df = add_rule_flags(df, rules)
    return df.withColumn("area", area(df, rules)).drop(*HELPER_COLS)


def add_area(df: DataFrame, areas: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """J1-J3 + D7: adds ``area``."""
    return derive_area(attach_area_lookup(df, areas, rules), rules)
