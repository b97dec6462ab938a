"""Fill-in-middle transformation, assembled by a secondary sort.

A text is cut into units (a word with the white space before it, or white space at
the end). Two unit positions drawn from the hash of the document id split it into
prefix, middle and suffix, and a third and a fourth draw choose the form:

* ``plain``: the text itself
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle

Each document is emitted as pieces of at most ``chunk`` units, in the order of the
text, under the key (document, place in the output).
``repartitionAndSortWithinPartitions`` brings the pieces of a document together in
output order, so that the output's digest is fed piece by piece. The same stream is
read back into its three parts, by the form and the markers met, and sorted again by
place in the text. The second sort has the same partitioner, hence needs no shuffle.
Both sorts spill; no task holds more than one document's input row and what its
sorter may keep, and texts are shuffled once.

Defined results: null text counts as empty, an empty text is plain with ``n`` 0; a null
id is drawn from the seed alone; a text that holds a marker is plain; repeated rows are
documents of their own, whatever their ids; extra input columns are not read; an
empty table gives no rows. A key of pieces is the hash of the row, the input
partition and a count among equal rows there, so a task that runs again gives the
same keys, in whatever order its rows then come.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42
FORM_RATE = 50          # per cent of documents that change their form ...
SPM_RATE = 80           # ... and of these, the share that takes spm
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

#: Parts in output order, each with its marker and its place in the text.
LAYOUT = {"plain": ((b"", 0),),
          "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
          "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

HEAD = (-1, 0)          # a document's properties sort before its pieces

COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
TEXTS = ", output string, restored string"


def unit_ends(data: bytes) -> np.ndarray:
    """Ends of the units, in bytes: after each word, and after white space at the end."""
    b = np.frombuffer(data, np.uint8)
    space = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
    after = np.append(space[1:], True)
    if len(b) and space[-1]:
        return np.append(np.flatnonzero(~space & after) + 1, len(b))
    return np.flatnonzero(~space & after) + 1


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The four numbers that decide on a document."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[i:i + 4], "big") for i in (0, 4, 8, 12)]


def choose(doc_id: int | None, data: bytes, n: int, seed: int, form_rate: int, spm_rate: int) -> tuple[str, int, int]:
    """Form of a document and the numbers of units before its middle and its suffix."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not data or h3 % 100 >= form_rate or any(m in data for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", 0, 0
    return "spm" if h4 % 100 < spm_rate else "psm", first, last


def chars(data: bytes) -> int:
    """Code points of a UTF-8 text."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def emitted(doc_id: int | None, data: bytes, seed: int, form_rate: int, spm_rate: int,
            chunk: int) -> Iterator[tuple[tuple[int, int], object]]:
    """(place in the output, piece) of one document, pieces in the order of the text."""
    ends = unit_ends(data)
    n = len(ends)
    form, first, last = choose(doc_id, data, n, seed, form_rate, spm_rate)
    cuts = (0, first, last, n) if form != "plain" else (0, n)
    at = np.concatenate(([0], ends))
    lengths = [chars(data[at[a]:at[b]]) for a, b in zip(cuts, cuts[1:])][:2] if form != "plain" else (None, None)
    yield HEAD, (doc_id, n, form, *lengths)
    place = {part: (rank, marker) for rank, (marker, part) in enumerate(LAYOUT[form])}
    for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
        rank, marker = place[part]
        for k, start in enumerate(range(a, max(b, a + 1), chunk)):
            stop = min(start + chunk, b)
            yield (rank, k), (marker if k == 0 else b"") + data[at[start]:at[stop]]


def parts(pieces: Iterable[bytes], form: str) -> Iterator[tuple[int, bytes]]:
    """(place in the text, bytes) of an output that comes in pieces.

    Each part runs from its marker to the next one's; a marker may be cut by the
    border of two pieces, so the last bytes that may begin one are held back.
    """
    layout = LAYOUT[form]
    if form == "plain":
        yield from ((0, p) for p in pieces)
        return
    turn, held = -1, b""
    for piece in pieces:
        held += piece
        while turn + 1 < len(layout):
            marker = layout[turn + 1][0]
            i = held.find(marker)
            if i < 0:
                break
            if i:
                yield layout[turn][1], held[:i]
            held, turn = held[i + len(marker):], turn + 1
        keep = min(len(held), 2) if turn + 1 < len(layout) else 0
        if len(held) > keep:
            yield layout[turn][1], held[:len(held) - keep]
            held = held[len(held) - keep:]
    if held:
        yield layout[turn][1], held


def by_document(records: Iterator) -> Iterator[tuple[bytes, tuple, Iterator[bytes]]]:
    """(key, properties, pieces in order) of each document in a sorted partition."""
    for key, group in groupby(records, key=lambda r: r[0][0]):
        head = next(group)[1]
        yield key, head, (piece for _, piece in group)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, form_rate: int = FORM_RATE,
              spm_rate: int = SPM_RATE, chunk: int = 2048, with_text: bool = True, partition_bytes: int = 64 << 20) -> DataFrame:
    """One row per document: its form, the lengths of prefix and middle in code points
    (null where plain), the digests of the output and of the text rebuilt from it.

    ``with_text`` adds both texts; without it no task ever holds an output whole. There
    are as many partitions as Spark is set to shuffle into, or more where the texts would
    come to more than ``partition_bytes`` in one (their bytes are added up first, as
    nothing splits the partitions of a sorted shuffle later).
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(docs[text_col].cast("string")))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // partition_bytes))

    def emit(number: int, rows: Iterator) -> Iterator:
        seen: Counter = Counter()
        for doc_id, text in rows:
            data = (text or "").encode()
            row = hashlib.blake2b(data, digest_size=16, person=str(doc_id)[-16:].encode()).digest()
            seen[row] += 1
            key = hashlib.blake2b(row + f"{number}:{seen[row]}".encode(), digest_size=16).digest()
            for place, piece in emitted(doc_id, data, seed, form_rate, spm_rate, chunk):
                yield (key, place), piece

    def assemble(records: Iterator) -> Iterator:
        for key, head, pieces in by_document(records):
            digest, whole, count = hashlib.sha256(), [], 0

            def fed():
                for p in pieces:
                    digest.update(p)
                    if with_text:
                        whole.append(p)
                    yield p

            for count, (part, piece) in enumerate(parts(fed(), head[2])):
                yield (key, (part, count)), piece
            yield (key, HEAD), (*head, digest.hexdigest(), b"".join(whole).decode() if with_text else None)

    def restore(records: Iterator) -> Iterator:
        for _, head, pieces in by_document(records):
            digest, whole = hashlib.sha256(), []
            for p in pieces:
                digest.update(p)
                if with_text:
                    whole.append(p)
            *properties, output = head
            yield (*properties, digest.hexdigest(), *((output, b"".join(whole).decode()) if with_text else ()))

    def sorted_in(pieces):
        return pieces.repartitionAndSortWithinPartitions(partitions, partition_of)

    pieces = docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).rdd.mapPartitionsWithIndex(emit)
    rebuilt = sorted_in(sorted_in(pieces).mapPartitions(assemble, preservesPartitioning=True))
    return spark.createDataFrame(rebuilt.mapPartitions(restore), COLUMNS + (TEXTS if with_text else ""), verifySchema=False)


def partition_of(key: tuple[bytes, tuple[int, int]]) -> int:
    """All pieces of a document in one partition, documents spread by their hash."""
    return int.from_bytes(key[0][:8], "big")
