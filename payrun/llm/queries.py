"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrun.llm import (ann, decontam, fim, hamming_dedup, langid, packing, pii, piece_bpe, suffix_index, toxicity, url_rules,
                        warc, whitening)
from payrun.llm.common import new_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_rules.judge(pages, url_rules.label_pages(pages, table(spark, sf_dir, "labels"))).drop("mined_rule")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.where(~held))
    return toxicity.score(docs, model, keep=()).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score",
                                               F.size("spans").alias("n_spans"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_spans(docs, pii.fit(docs))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *map(count, pii.BASE_KINDS),
                        F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op6_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_dedup.near_duplicates(table(spark, sf_dir, "documents"), n=2)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write_archives(warc.mark_revisits(table(spark, sf_dir, "pages")), path)
    return (warc.read_archives(spark, path, payload="checked").where(F.col("record_type").isin("response", "revisit"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    return whitening.by_component(whitening.whiten(vectors, model), model)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(piece_bpe.decode(piece_bpe.encode(table(spark, sf_dir, "documents"))))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.transform(table(spark, sf_dir, "documents"), with_text=False)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline.py``, which stands beside the package."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir).drop("ids")


def queries() -> dict[str, Query]:
    return {"op1_url_rules": op1_url_rules, "op2_toxicity": op2_toxicity, "op3_langid": op3_langid, "op4_packing": op4_packing, "op5_pii": op5_pii,
            "op6_suffix_index": op6_suffix_index, "op7_ann": op7_ann, "op8_near_dups": op8_near_dups, "op9_warc": op9_warc, "op10_decontam": op10_decontam, "op11_whitening": op11_whitening,
            "op12_pieces": op12_pieces, "op13_fim": op13_fim, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    """DuckDB texts of the queries that SQL can express."""
    return {"op1_url_rules": ORACLE_OP1, "op8_near_dups": ORACLE_OP8, "op9_warc": ORACLE_OP9}


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
g AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT g.y, r.root FROM r JOIN g ON g.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

ORACLE_OP9 = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first_id,
        list_transform(range(1, 40, 5), lambda i: list_reduce(list_transform(range(0, 5), lambda k:
          strpos('0123456789abcdef', substr(h, (i + k)::INT, 1)) - 1), lambda a, b: a * 16 + b)) AS parts FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(flatten(list_transform(parts, lambda v: [(v >> 15) & 31, (v >> 10) & 31, (v >> 5) & 31, v & 31])),
    lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

ORACLE_OP1 = rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url,
    coalesce({LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
t AS (SELECT *, list_sort(list_distinct(list_concat(
    list_transform(list_filter([lower(regexp_extract(url, '^([A-Za-z]+)://', 1))], lambda x: x <> ''), lambda x: 's:' || x),
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> '' AND NOT regexp_matches(x, '^[0-9]+(\.[A-Za-z0-9]+)?$')), lambda x: 'p:' || x),
    list_transform(list_filter([regexp_extract(path, '\.([A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*)$', 1)], lambda x: x <> ''), lambda x: 'x:' || x),
    list_transform(regexp_extract_all(url, '[?&]([^=&#]+)=', 1), lambda x: 'q:' || x)))) AS tokens FROM u),
b AS (SELECT doc_id, min(quality) = 0 AS bad FROM labels GROUP BY 1 HAVING min(quality) IS NOT NULL),
k AS (SELECT t.page_id, tokens, bad FROM t
      JOIN b ON b.doc_id = try_cast(regexp_extract(path, '([0-9]+)[^/0-9]*/?$', 1) AS BIGINT)),
m AS (SELECT page_id, tokens, bad, unnest(range(1, (1::BIGINT << len(tokens)))) AS bits FROM k),
a AS (SELECT list_filter(tokens, lambda x, i: (bits >> (i - 1)) & 1 = 1) AS need, bad FROM m),
r AS (SELECT need, count(*) AS n, count(*) FILTER (bad) AS n_bad FROM a GROUP BY 1),
rules AS (SELECT need FROM r WHERE n_bad >= ceil(0.01 * (SELECT count(*) FROM k)) AND n_bad > 0 AND n_bad::DOUBLE / n >= 0.5),
hit AS (SELECT DISTINCT t.page_id FROM t JOIN rules ON list_has_all(t.tokens, rules.need)),
l AS (SELECT t.*, hit.page_id IS NOT NULL AS mined,
    CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM t LEFT JOIN hit USING (page_id))
SELECT page_id, host, path, rule,
  CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'example.com/de/' THEN 'block'
    WHEN 'net/' THEN 'block' ELSE CASE WHEN mined THEN 'block' ELSE 'allow' END END AS verdict
FROM l
"""
