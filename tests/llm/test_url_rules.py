from itertools import combinations

from pyspark.sql import functions as F

from payrun.llm import url_rules as U


def judged(spark, urls, labelled=(), **kw):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    marks = spark.createDataFrame(list(labelled), "url string, bad boolean")
    return {r.page_id: r for r in U.judge(pages, marks, **kw).collect()}


def test_hosts_paths_and_fixed_rules(spark):
    urls = ["https://A.Example.NET/en/1?x", "http://b.example.net/de/1", "http://net", "http://xnet/", "http://q.org/fr/a#b",
            "ftp://example.com/de/", "http://myexample.com/de/", None, "no scheme", "", "http://h:80/p", "x://net/a://b/",
            "http://É.net/en/", "http://example.net/en"]
    got = judged(spark, urls)
    seen = [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))]
    assert seen == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("b.example.net", "/de/1", "net/", "block"),
        ("net", "", None, "allow"), ("xnet", "/", None, "allow"), ("q.org", "/fr/a", "org/fr/", "allow"),
        ("example.com", "/de/", "example.com/de/", "block"), ("myexample.com", "/de/", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h:80", "/p", None, "allow"),
        ("net", "/a://b/", "net/", "block"), ("É.net", "/en/", "net/", "block"), ("example.net", "/en", "net/", "block")]


def test_mined_rules_match_brute_force(spark):
    words = ["casino", "news", "blog", "shop"]
    labelled = [(f"http://{a}.example.com/{b}/{i}.html", (a == "casino" and b != "blog") or i % 5 == 0)
                for a in words for b in words for i in range(1, 4)] + [("http://casino.example.com/shop/9", True)] * 3
    support, confidence = 0.05, 0.6
    rows = [({w for w in (a, b) if w}, bad) for (u, bad) in labelled
            for a, b in [(u.split("//")[1].split(".")[0] + "@h", u.split("/")[3] + "@p")]]
    n = len(rows)
    fixed = set()
    for size in (1, 2):
        for need in {frozenset(c) for tokens, _ in rows for c in combinations(sorted(tokens), size)}:
            hit = [bad for tokens, bad in rows if need <= tokens]
            if sum(hit) >= support * n and sum(hit) / len(hit) >= confidence:
                fixed.add(need)
    urls = [f"http://{a}.example.com/{b}/7.html" for a in words for b in words]
    got = judged(spark, urls, labelled, host_rules=(), min_support=support, min_confidence=confidence)
    for i, u in enumerate(urls):
        tokens = {u.split("//")[1].split(".")[0] + "@h", u.split("/")[3] + "@p"}
        assert (got[i].verdict == "block") == any(need <= tokens for need in fixed), u
    assert any(r.verdict == "block" for r in got.values()) and any(r.verdict == "allow" for r in got.values())


def test_empty_tables_and_labels(spark):
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(1, "http://a/en/12.html?x=3"), (2, "http://a/en/"), (3, None)], "page_id long, url string")
    labels = spark.createDataFrame([(12, 1, 0), (12, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in U.label_pages(pages, labels).collect()] == [("http://a/en/12.html?x=3", True)]


def test_tokens_with_digits_are_mined(spark):
    """Host labels, path words, extensions and query keys may hold digits; document numbers are no words."""
    bad = [f"http://bet24.example.com/a/{i}.html" for i in range(40)] + [f"http://x.com/casino-2024/{i}" for i in range(40)] \
        + [f"http://y.com/{i}.mp4" for i in range(40)] + [f"http://z.com/p?id2={i}" for i in range(40)]
    good = [f"http://{h}.com/{i}/" for h in "wxyz" for i in range(60)]
    got = judged(spark, ["http://bet24.example.com/q/9", "http://w.com/casino-2024/1", "http://w.com/7.mp4", "http://w.com/?id2=1", "http://w.com/24/2024"],
                 [(u, True) for u in bad] + [(u, False) for u in good], host_rules=(), min_confidence=0.9)
    assert [got[i].verdict for i in range(5)] == ["block"] * 4 + ["allow"]
    tokens = spark.createDataFrame([("http://a1.b/12/x9/34.html?k-1=2&n[]=3#f",)], "u string").select(U.url_tokens(F.col("u"))).first()[0]
    assert tokens == ["h:a1", "h:b", "p:x9", "q:k-1", "q:n[]", "s:http", "x:html"]
