import corpus_pipeline as P
from payrun.llm.common import stage

SF = "/root/testdata/sf0.001"


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, function in P.STAGES:
        columns = docs.columns
        docs = stage(function(spark, docs, SF), name)
        assert docs.count() == 0
        assert name == "packing" or docs.columns == columns


def kept(spark, function, rows):
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    out = stage(function(spark, docs, SF), "out")
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_null_and_repeated_ids_are_judged_by_row(spark):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(40)) for w in ("one", "two", "three", "four"))
    got = kept(spark, P.drop_near_copies, [(None, a), (None, a), (9, a), (3, a + " more"), (5, b), (5, b), (5, c), (None, d), (None, d), (2, "")])
    assert got == sorted([(3, a + " more"), (5, b), (5, c), (None, d), (2, "")], key=str)
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    got = kept(spark, P.drop_contaminated, [(None, f"{a} {passage} {b}"), (None, c), (7, a), (7, f"{b} {passage}"), (8, d), (8, d)])
    assert got == sorted([(None, c), (7, a), (8, d), (8, d)], key=str)


def test_clashing_names_stay(spark):
    """Columns named like the helpers of any stage, and a very long text."""
    names = ["score", "spans", "redacted", "pipeline_row", "row", "document", "scored_text", "component_id", "_place", "id", "y"]
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, long, "en", "web", len(long)), (2, "write to ann.lee@example.org now", "en", "web", 32), (None, "plain words of it", None, None, None)]
    docs = spark.createDataFrame([(*r, *[f"{n}!" for n in names]) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` string" for n in names))
    for name, function in P.STAGES[:-1]:
        out = stage(function(spark, docs, SF), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = {r.doc_id: r for r in out.collect()}
        assert set(got) == {1, 2, None}, name
        assert all(r[n] == f"{n}!" for r in got.values() for n in names), name
        assert got[1].text == long
    assert got[2].text == "write to [EMAIL] now" and got[2].n_chars == 20
    assert stage(P.pack(spark, docs, SF), "packed").count() > 100
