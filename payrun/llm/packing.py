"""Cost-balanced packing of tokenized documents into fixed-length sequences.

A document is tokenized with a public byte-level BPE vocabulary and closed by
the end id. Whole blocks of ``seq_len`` ids become sequences of their own. What
is left over is packed group by group: the group opens just as many sequences
as its ids need, pieces go in descending size to the sequence of lowest
estimated cost (linear plus quadratic attention cost) that has room, and a piece
that fits nowhere is cut across the cheapest sequences with free room. A group
therefore pads fewer than ``seq_len`` ids in total.

Groups never leave their task, so packing needs no shuffle: each task holds one
group of at most ``group_tokens`` left-over ids plus one document.

Defined results: null text counts as empty (a document of the end id alone);
repeated rows are documents of their own; a null doc_id stays null; extra input
columns are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SEQ_LEN = 1024
END_ID = 0
END_OF_TEXT = {"<|endoftext|>": 50256}      # the vocabulary's one added token
COLUMNS = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "`offset` long")


@lru_cache(maxsize=2)
def encoder(path: str):
    """The vocabulary at ``path`` (ranks in text form) as an encoder."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=END_OF_TEXT)


def vocabulary_path() -> str:
    """The byte-level BPE vocabulary; its ids are those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cost(length, linear: float, quadratic: float):
    """Estimated cost of one document piece in a sequence."""
    return linear * length + quadratic * length * length


def assign(lengths: np.ndarray, seq_len: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Place pieces of ``lengths`` ids; gives (piece, from, count, sequence, offset)."""
    placed: list[tuple[int, int, int, int, int]] = []
    n_seq = -(-int(lengths.sum()) // seq_len)
    load = np.zeros(n_seq)
    room = np.full(n_seq, seq_len, dtype=np.int64)
    for piece in np.argsort(-lengths, kind="stable"):
        done, left = 0, int(lengths[piece])
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            seq = int(np.argmin(np.where(fits, load, np.inf)))
            take = min(left, int(room[seq]))
            placed.append((int(piece), done, take, seq, seq_len - int(room[seq])))
            room[seq] -= take
            load[seq] += cost(take, linear, quadratic)
            done, left = done + take, left - take
    return placed


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         seq_len: int = SEQ_LEN, linear: float = 1.0, quadratic: float = 1 / 1024, group_tokens: int = 2_000_000,
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences.

    ``with_ids`` adds the ids of each piece. Sequence ids join the task's
    partition number and a counter, so a task that runs again after a lost
    executor gives the same ids.
    """
    vocabulary = vocabulary or vocabulary_path()
    schema = COLUMNS + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_to_numpy
        base = TaskContext.get().partitionId() << 32
        n_seq = 0
        rows: list[tuple] = []
        held: list[tuple[int | None, int, int, np.ndarray]] = []
        held_tokens = 0

        def piece(doc_id, start, ids, total, seq, offset):
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            rows.append((doc_id, start, len(ids), crc, total, base + seq, offset, ids if with_ids else None))

        def close_group():
            nonlocal n_seq, held, held_tokens
            if held:
                lengths = np.array([len(h[3]) for h in held], dtype=np.int64)
                for i, first, count, seq, offset in assign(lengths, seq_len, linear, quadratic):
                    doc_id, start, total, ids = held[i]
                    piece(doc_id, start + first, ids[first:first + count], total, n_seq + seq, offset)
                n_seq += -(-int(lengths.sum()) // seq_len)
            held, held_tokens = [], 0

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                arrays.append(pa.array([c.astype(np.int32) for c in cols[7]], pa.list_(pa.int32())))
                names.append("ids")
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or "", allowed_special="all").astype(np.uint32), np.uint32(END_ID))
                whole = len(ids) - len(ids) % seq_len
                for start in range(0, whole, seq_len):
                    piece(doc_id, start, ids[start:start + seq_len], len(ids), n_seq, 0)
                    n_seq += 1
                if whole < len(ids):
                    held.append((doc_id, whole, len(ids), ids[whole:]))
                    held_tokens += len(ids) - whole
                if held_tokens >= group_tokens:
                    close_group()
                if len(rows) >= 20_000:
                    yield flush()
        close_group()
        if rows:
            yield flush()

    return docs.select(docs[id_col].cast("long"), docs[text_col]).mapInArrow(run, schema)
