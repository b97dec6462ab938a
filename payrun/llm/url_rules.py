"""URL filtering by mined association rules, plus a list of fixed rules.

FP-growth mines combinations of URL tokens that occur together with a "bad"
label; rules are kept by support and confidence. Each rule is posted in an
inverted index under its rarest token: a URL looks up its own tokens and blocks
if all tokens of some posted rule are present. Everything is a DataFrame
function or Spark ML's FP-growth; there is no Python code per row.

Defined results: a null url, or one without ``://``, has an empty host and path
and (unless other tokens apply) no mined rule; repeated rows are judged alike;
without labelled pages no rule is mined; ``labels`` repeated for a document
count as bad if any of them is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrun.llm.common import stage

BAD = "label:bad"
BROADCAST_SETS = 100_000            # matched token sets of about 200 bytes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str


HOST_RULES = (HostRule("net", "/", "block"), HostRule("example.net", "/en/", "allow"),
              HostRule("example.com", "/de/", "block"), HostRule("org", "/fr/", "allow"))


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Scheme, host labels, path words, file extension, query keys.

    Of these only path words that are a number, with or without an extension, are left
    out: they name a document, not a kind of page.
    """
    url = F.coalesce(url, F.lit(""))
    path = url_path(url)

    def named(prefix: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))

    scheme = F.array(F.lower(F.regexp_extract(url, "^([A-Za-z]+)://", 1)))
    words = F.filter(F.split(path, "/"), lambda x: ~x.rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$"))
    extension = F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*)$", 1))
    return F.array_sort(F.array_distinct(F.concat(
        named("s:", scheme), named("h:", F.split(url_host(url), r"\.")), named("p:", words),
        named("x:", extension), named("q:", F.regexp_extract_all(url, F.lit("[?&]([^=&#]+)="), 1)))))


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules ``antecedent -> bad`` from rows of ``tokens`` and ``bad``.

    Columns: antecedent, confidence, support. FP-growth splits its trees by
    item over the executors.
    """
    items = F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens"))
    baskets = labelled.select(items.alias("items")).where(F.size("items") > 0)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    return (model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
            .select("antecedent", "confidence", "support"))


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule that fits each distinct ``tokens`` set, by inverted index."""
    seen = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("seen"))
    listed = rules.withColumn("rule", F.array_join(F.array_sort("antecedent"), " "))
    postings = (listed.select("rule", "antecedent", "confidence", "support", F.explode("antecedent").alias("token"))
                .join(seen, "token")
                .groupBy("rule")
                .agg(F.min_by("token", F.struct("seen", "token")).alias("token"), F.first("antecedent").alias("need"),
                     F.first("confidence").alias("confidence"), F.first("support").alias("support")))
    return (sets.select("tokens", F.explode("tokens").alias("token")).join(postings, "token")
            .where(F.size(F.array_except("need", "tokens")) == 0)
            .groupBy("tokens")
            .agg(F.max(F.struct("confidence", "support", "rule")).alias("best"))
            .select("tokens", F.col("best.rule").alias("mined_rule"), F.col("best.confidence").alias("confidence")))


def judge(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url",
          host_rules: tuple[HostRule, ...] = HOST_RULES, min_support: float = 0.01,
          min_confidence: float = 0.5) -> DataFrame:
    """Verdict of every page: the longest fitting fixed rule's, else the mined rules'.

    ``labelled`` holds ``url`` and ``bad``. Pages are matched as distinct token
    sets, so a host with a third of all pages is looked up once per set.
    """
    rules = mine_rules(labelled.select(url_tokens(F.col("url")).alias("tokens"), "bad"), min_support, min_confidence)
    rows = pages.select(pages[id_col].alias("page_id"), url_host(pages[url_col]).alias("host"),
                        url_path(pages[url_col]).alias("path"), url_tokens(pages[url_col]).alias("tokens"))
    matched = stage(match_rules(rows.groupBy("tokens").agg(F.count("*").alias("pages")), rules), "matched")
    if matched.count() <= BROADCAST_SETS:           # beyond it the pages move, and Spark splits a hot set
        matched = F.broadcast(matched)
    rule, listed = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(host_rules, key=lambda r: len(r.host + r.path)):
        fits = (((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path))
        rule, listed = F.when(fits, r.host + r.path).otherwise(rule), F.when(fits, r.verdict).otherwise(listed)
    return (rows.join(matched, "tokens", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(listed, F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow"))
                    .alias("verdict"), "mined_rule"))


def label_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages with the label of the document that the last number of their path names."""
    number = F.regexp_extract(url_path(pages["url"]), r"([0-9]+)[^/0-9]*/?$", 1).try_cast("long")
    bad = labels.groupBy("doc_id").agg((F.min("quality") == 0).alias("bad")).where(F.col("bad").isNotNull())
    return pages.select("url", number.alias("doc_id")).join(bad, "doc_id").select("url", "bad")
