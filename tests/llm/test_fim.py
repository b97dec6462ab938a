import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from payrun.llm import fim, queries

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text, seed=42):
    """The contract, straight from its words."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text), text, text
    if h4 % 100 < 80:
        form, out = "spm", f"<S>{s}<P>{p}<M>{m}"
    else:
        form, out = "psm", f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text), out, text


TEXTS = [None, "", " ", "one", " a  b\n", "\t\n", "é 你好 \U0001F600 z", "x <S> y", "< S > <P", "a<", "<S", "P> <", "no space" * 50,
         "word " * 9000, "w" * 70_000 + " tail", "a b c\x0bd", "<<S <P M> S>"]


@pytest.mark.parametrize("chunk", [1, 3, 2048])
def test_equals_the_contract(spark, chunk):
    rows = [(i, t) for i, t in enumerate(TEXTS * 6)] + [(None, "null id text here"), (-5, "negative id of it")]
    docs = spark.createDataFrame([(*r, "clash", "x") for r in rows], "doc_id long, text string, form string, n string").repartition(3)
    got = sorted((tuple(r) for r in fim.transform(docs, chunk=chunk).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_repeated_rows_and_empty_table(spark):
    schema = "doc_id long, text string"
    assert fim.transform(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "same text of words")] * 5 + [(1, "another text of it"), (None, None), (None, None)]
    got = fim.transform(spark.createDataFrame(rows, schema).repartition(2), chunk=1).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_texts_are_shuffled_once(spark):
    """The second sort has the partitioner of the first one."""
    docs = spark.createDataFrame([(i, "a b c d") for i in range(20)], "doc_id long, text string")
    lineage = fim.transform(docs).rdd.toDebugString().decode()
    assert lineage.count("PairwiseRDD") == 1
    assert fim.transform(docs, partition_bytes=10).rdd.getNumPartitions() == 14       # 140 bytes of text


def test_query_equals_the_contract(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_fim(spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"),
                          ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r)[:7] for r in docs), key=str)


@settings(max_examples=300, deadline=None)
@given(st.text("<PSM> \nab", max_size=30), st.text("<PSM> \nab", max_size=10), st.text("<PSM> \nab", max_size=10),
       st.sampled_from(["psm", "spm"]), st.integers(1, 4))
def test_parts_are_found_in_any_pieces(a, b, c, form, size):
    if any(x in a + b + c for x in ("<P>", "<S>", "<M>")):
        return
    text = [a.encode(), b.encode(), c.encode()]
    out = b"".join(marker + text[part] for marker, part in fim.LAYOUT[form])
    got = [b"", b"", b""]
    for part, piece in fim.parts((out[i:i + size] for i in range(0, len(out), size)), form):
        got[part] += piece
    assert got == text
