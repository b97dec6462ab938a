import hashlib
import random
from array import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from payrun.llm import piece_bpe, queries


@pytest.fixture(scope="module")
def library():
    return piece_bpe.processor(piece_bpe.model_path())


def ids_of(text, pieces=None):
    return list(array("i", next((pieces or piece_bpe.pieces_of(piece_bpe.model_path())).encode([text]))))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ODD = ["", " ", "   ", "\n", "a  b", "▁x", "x▁▁ y", "<s> </s> <unk> <0x0A>", "\x00a", "你好世界", "\U0001F600\U0001F600", "é" * 50, "a" * 1000,
       " " * 1000, "1234567 89", "hello\tworld\r\n", "ﬁ ﬃ", "﻿q", "aaaa bbbb" * 200, "word, word. (word) -- word", "=" * 999]


def test_odd_texts(library):
    for text in ODD:
        assert ids_of(text) == library.encode(text), text[:40]


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("abethingsr. ▁\n\té你好12-=_/*#ſ\U0001F600"), max_size=60))
def test_equals_the_library(text):
    assert ids_of(text) == piece_bpe.processor(piece_bpe.model_path()).encode(text)


def test_joined_pieces(library):
    """Texts made of pieces, where the longest match often is wrong."""
    pick = random.Random(5)
    pieces = [p.replace("▁", " ") for p in piece_bpe.pieces_of(piece_bpe.model_path()).score]
    for _ in range(4000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randint(1, 12)))
        assert ids_of(text) == library.encode(text), text


@pytest.mark.parametrize("text", ["".join(random.Random(1).choices("abething", k=200_000)), "你好" * 100_000, "=" * 200_001, "ab " * 100_000])
def test_very_long_texts(library, text):
    assert ids_of(text) == library.encode(text)


def test_backtracking_and_failed_positions():
    """Without cuts, backtracking takes pieces back and still gives what plain merging gives."""
    pieces = piece_bpe.pieces_of(piece_bpe.model_path())
    pick = random.Random(2)
    for _ in range(3000):
        text = "".join(pick.choices("aeinrst▁.o", k=pick.randint(1, 25)))
        assert pieces.split(text) == pieces.merged(text)


def test_many_parts_at_once():
    """The arrays of positions give what one part at a time gives."""
    pieces = piece_bpe.Pieces(piece_bpe.model_path())
    pick = random.Random(3)
    parts = ["".join(pick.choices("aeinrstxé▁.o(=\U0001F600" if k % 9 else "ab\n\U0001F600", k=pick.randint(1, 48))) for k in range(6000)]
    got = pieces.split_many(parts)
    assert sum(ids is None for ids in got) > 100                # characters that are no piece
    assert [ids for ids in got if ids is not None] == [pieces.ids_of(p) for p, ids in zip(parts, got) if ids is not None]


def test_full_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "PAIR_BITS", 1)
    pieces = piece_bpe.Pieces(piece_bpe.model_path())
    monkeypatch.setattr(piece_bpe, "KEPT_PARTS", 3)
    monkeypatch.setattr(piece_bpe, "STEP", 2)               # parts longer than what is cut at once
    for text in ["these are words that do not fit into the small tables kept", "  a  bc ", *ODD]:
        assert ids_of(text, pieces) == library.encode(text)
    assert len(pieces.kept) < 60 and len(pieces.older) < 60


def test_models_with_other_rules_are_an_error():
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="no BPE, no byte fallback"):
        piece_bpe.Pieces.check(model)


def test_tables(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "tie", "x"), (None, "tie", "x"), (7, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = piece_bpe.decode(piece_bpe.encode(docs)).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert piece_bpe.digests(piece_bpe.decode(piece_bpe.encode(empty))).collect() == []


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    got = queries.op12_pieces(spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    want = []
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, got.collect())) == sorted(want)
