import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from payrun.llm import packing


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


TEXTS = [None, "", "one two", "tie", "tie", "x " * 3000, "<|endoftext|> é 你好\n\n  a", "word " * 1023, "word " * 500]


@pytest.mark.parametrize("parts", [1, 3])
def test_every_id_in_one_piece_and_sequences_gapless(spark, parts):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, length string").repartition(parts)
    rows = packing.pack(docs, with_ids=True).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, text in enumerate(TEXTS):
        ids = reference_ids(text)
        joined = []
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == len(joined) and r.doc_tokens == len(ids)
            joined += r.ids
        assert joined == ids
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.SEQ_LEN
    total = sum(r.length for r in rows)
    assert len(by_seq) <= total // packing.SEQ_LEN + parts + sum(len(p) == 1 for p in by_seq.values())


def test_assign_fills_and_balances():
    lengths = np.array([700, 700, 300, 300, 24, 24])
    placed = packing.assign(lengths, 1024, 1.0, 1 / 1024)
    used = defaultdict(int)
    for piece, _, count, seq, _ in placed:
        used[seq] += count
    assert dict(used) == {0: 1024, 1: 1024}
    assert all(count == lengths[piece] for piece, _, count, _, _ in placed)


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema)).count() == 0
    rows = packing.pack(spark.createDataFrame([(1, "same"), (1, "same"), (None, "n")], schema).coalesce(1)).collect()
    assert len(rows) == 3 and len({r.offset for r in rows}) == 3
    assert packing.pack(spark.createDataFrame([(1, "a")], schema)).agg(F.sum("length")).first()[0] == 2
