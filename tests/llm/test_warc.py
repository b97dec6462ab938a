import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from payrun.llm import warc
from payrun.llm.common import new_path

SCHEMA = "page_id long, url string, html string, payload string"


def round_trip(spark, rows, **kw):
    path = new_path(spark, "archives")
    warc.write_archives(warc.mark_revisits(spark.createDataFrame(rows, SCHEMA), **kw), path)
    return path, warc.read_archives(spark, path)


def test_round_trip_with_edge_cases(spark):
    big = "WARC/1.1\r\n\r\n é" * 50_000
    rows = [(5, "http://a/x", "same", "c"), (2, "http://b/ y\r\nz", "same", "c"), (3, None, None, "c"), (4, "u", "", "c"),
            (6, "http://c", big, "c"), (None, "http://d", "same", "c"), (7, "http://e", big, "c"), (2, "http://b", "same", "c")]
    _, back = round_trip(spark, rows)
    got = sorted((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to, r.payload_bytes,
                  bytes(r.payload) if r.payload is not None else None, r.payload_digest) for r in back.collect())

    def digest(s):
        return base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()

    def row(i, kind, ref, text):
        data = text.encode()
        return (i, kind, ref, len(data), data if kind == "response" else None, digest(text))

    want = [row(-1, "revisit", 2, "same"), row(2, "response", None, "same"), row(2, "response", None, "same"),
            row(3, "response", None, ""), row(4, "revisit", 3, ""), row(5, "revisit", 2, "same"),
            row(6, "response", None, big), row(7, "revisit", 6, big)]
    assert got == sorted(want, key=lambda r: (r[0], r[1], r[2] or 0))


def test_small_payloads_stay_responses(spark):
    _, back = round_trip(spark, [(1, "u", "ab", ""), (2, "u", "ab", "")], min_bytes=3)
    assert {r.record_type for r in back.collect()} == {"response"}


def test_pushdown_and_skipping(spark):
    path, back = round_trip(spark, [(i, f"http://h{i % 3}/p", f"t{i // 2}", "") for i in range(20)])
    only = back.where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://h1"))
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")     # the source took both
    assert sorted(r.page_id for r in only.collect()) == [i for i in range(20) if i % 2 and i % 3 == 1]
    heads = warc.read_archives(spark, path, payload=False)
    assert heads.where("payload is null").count() == 20
    assert heads.where(F.col("page_id").isin(4, 5)).count() == 2
    assert back.where(F.length("payload") > 0).count() == 10


def test_empty_table(spark):
    assert round_trip(spark, [])[1].count() == 0


@pytest.mark.parametrize("limit", [0, 10])
def test_repeated_payloads_broadcast_or_joined(spark, limit):
    rows = [(i, "u", f"t{i % 3}" if i < 30 else f"own {i}", "") for i in range(40)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = warc.mark_revisits(spark.createDataFrame(rows, SCHEMA), broadcast_rows=limit)
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) == (limit > 0)
    assert {r.page_id: (r.record_type, r.refers_to) for r in got.collect()} == {
        i: ("revisit", i % 3) if 3 <= i < 30 else ("response", None) for i in range(40)}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_revisits_name_the_record_they_refer_to(spark):
    _, back = round_trip(spark, [(4, "u", "same", ""), (2, "v", "same", ""), (9, "w", "other", "")])
    ids = {r.page_id: r.record_id for r in back.collect()}
    assert len(set(ids.values())) == 3
    digest = base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    assert ids[2] == warc.record_id(2, digest, 4)
    raw = warc.record_bytes({"record_type": "revisit", "page_id": 4, "target_uri": "u", "refers_to": 2, "payload": b"same"})
    assert f"WARC-Refers-To: {ids[2]}".encode() in raw


def test_archives_from_elsewhere(spark, tmp_path):
    """No manifest, gzip members, a header that is not UTF-8, digests of another kind."""
    def record(kind, body, *more):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + body
        head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:uuid:1>", *more, b"Content-Length: %d" % len(block)]
        return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"

    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    one = record(b"response", b"plain body", b"WARC-Target-URI: http://a/caf\xe9")
    two = record(b"response", b"zipped", b"WARC-Payload-Digest: md5:abc", b"WARC-Target-URI: http://b/")
    (tmp_path / "a.warc").write_bytes(info + one)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(two) + gzip.compress(two))
    rows = warc.read_archives(spark, str(tmp_path)).where("record_type = 'response'").collect()
    assert sorted((r.target_uri, bytes(r.payload)) for r in rows) == [("http://a/caf\xe9", b"plain body"), ("http://b/", b"zipped"), ("http://b/", b"zipped")]
    assert warc.read_archives(spark, str(tmp_path), payload=False).where("record_type = 'warcinfo'").count() == 2


def test_checked_payloads_are_compared_and_not_given(spark):
    path, back = round_trip(spark, [(1, "u", "body of it", ""), (2, "u", "body of it", "")])
    checked = warc.read_archives(spark, path, payload="checked").collect()
    assert {(r.page_id, r.payload_bytes, r.payload) for r in checked} == {(1, 10, None), (2, 10, None)}
    import os
    for name in os.listdir(path):
        if name.endswith(".warc"):
            place = os.path.join(path, name)
            data = open(place, "rb").read()
            open(place, "wb").write(data.replace(b"body of it", b"body of IT"))
    with pytest.raises(Exception, match="damaged record"):
        warc.read_archives(spark, path, payload="checked").collect()
    assert warc.read_archives(spark, path, payload=False).count() == 2
