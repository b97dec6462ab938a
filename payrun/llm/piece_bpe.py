"""Exact encoding and decoding with a sentencepiece BPE model.

The model merges, again and again, the adjacent pair whose joined piece has the best
score, leftmost first. A sequence of pieces is its result exactly if each piece alone
and each two neighbours alone come out of merging unchanged: merges inside a piece do
not depend on what stands beside it, and the first merge across a border would be
seen by the two pieces at that border. So the encoding needs no merging of the text:

1. An Aho-Corasick automaton over the reversed pieces gives the longest piece that
   starts at each position, in one pass.
2. From the left, the longest piece is tried whose neighbour before it is compatible;
   two pieces are compatible if re-merging their joined text gives the two again
   (kept in a bounded table, as neighbours repeat). Where it is not, the next shorter
   piece that begins alike is tried.
3. Where nothing fits, the position is marked in a bitfield and the last piece is
   taken back. What leads to a position is unique, so a marked position is never
   tried again and the work is linear in the text.

Texts are first cut where no piece of the vocabulary could ever join the two sides
(before a run of spaces, if no piece has a space after another character, and between
characters that no chain of pieces joins). Frequent parts are kept in a bounded table;
the short ones that are not there are encoded together, as numpy arrays of positions.

Defined results: null text counts as empty (no ids, an empty decoded text); repeated
rows, null ids and extra columns are kept or left aside as they are; an empty table
gives no rows. Very long texts without any cut need a reference for each character and each
piece, and one bit a character.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"            # sentencepiece's sign for a space
KEPT_PARTS = 400_000        # entries of a table; a full one is begun anew
KEPT_LENGTH = 48            # longer parts are not kept, and are encoded one by one
PAIR_BITS, SPREAD = 20, np.uint64(0x9E3779B97F4A7C15)       # slots of the table of pairs, and its hash
FLUSH_BYTES = 2_000_000     # of ids in a batch that goes back to Spark
STEP = 1_000_000            # characters that are cut into parts at once

NOTHING: dict = {}
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6         # fixed values: kinds of a piece in a model file
BPE = 2                                             # fixed value: model type


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary of a model and its encoder."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.check(model)
        self.dummy_prefix = model.normalizer_spec.add_dummy_prefix
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.byte_id = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_id[int(p.piece[1:-1], 16)] = i
        stable = {p for p in self.score if self.merged(p) == [p]}
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in stable), p[0]) for p in stable if len(p) > 1}
        self.names = ["", *sorted(stable | {p[0] for p in stable})]           # a piece's number is its place here
        number = {p: i for i, p in enumerate(self.names)}
        self.starts = ahocorasick.Automaton()
        for p in stable:
            self.starts.add_word(p[::-1], number[p])
        self.starts.make_automaton()
        self.length_at = np.array([len(p) for p in self.names])
        self.shorter_at = np.array([number[self.shorter.get(p, "")] for p in self.names])
        self.id_at = np.array([self.id.get(p, -1) for p in self.names], np.int32)
        used = {c for p in self.score for c in p}
        self.border = next(c for c in map(chr, range(0x10FFFF)) if c not in used)
        self.part = re.compile(self.cut_pattern(), re.DOTALL)
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.pair_key = np.full(1 << PAIR_BITS, -1)
        self.pair_fits = np.zeros(1 << PAIR_BITS, bool)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def check(model) -> None:
        """Models with other rules than those this encoder has are an error."""
        norm, train = model.normalizer_spec, model.trainer_spec
        other = [name for name, bad in (
            ("no BPE", train.model_type != BPE), ("no byte fallback", not train.byte_fallback),
            ("normalization rules", bool(norm.precompiled_charsmap)), ("removal of white space", norm.remove_extra_whitespaces),
            ("unescaped spaces", not norm.escape_whitespaces), ("white space as suffix", train.treat_whitespace_as_suffix),
            ("own or unused symbols", any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces))) if bad]
        if other:
            raise ValueError(f"the model has {', '.join(other)}")

    def cut_pattern(self) -> str:
        """Parts between which no piece can arise: runs of characters that pieces join,
        directly or through others, each with the spaces before it."""
        group: dict[str, str] = {}

        def root(c: str) -> str:
            while group.setdefault(c, c) != c:
                c = group[c]
            return c

        spaces_inside = any(SPACE in p.lstrip(SPACE) for p in self.score)
        for p in self.score:
            letters = p if spaces_inside else p.lstrip(SPACE)
            for a, b in zip(letters, letters[1:]):
                group[root(a)] = root(b)
        runs: dict[str, list[str]] = {}
        for c in group:
            runs.setdefault(root(c), []).append(c)
        before = "" if spaces_inside else f"{SPACE}*"
        classes = ["[" + "".join(map(re.escape, sorted(r))) + "]+" for r in sorted(runs.values(), key=len, reverse=True)]
        return "|".join(before + c for c in [*classes, "."])

    def merged(self, text: str) -> list[str]:
        """Plain merging: the pieces of a short text."""
        pieces, score = list(text), self.score
        while len(pieces) > 1:
            found = [(score[t], -i) for i in range(len(pieces) - 1) if (t := pieces[i] + pieces[i + 1]) in score]
            if not found:
                break
            i = -max(found)[1]
            pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]
        return pieces

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the joined text gives the two pieces again (kept)."""
        if self.n_pairs >= KEPT_PARTS:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        known = self.pairs.setdefault(left, {})[right] = self.merged(left + right) == [left, right]
        return known

    def split(self, text: str) -> list[str]:
        """The pieces of a text, by backtracking."""
        n, shorter, pairs = len(text), self.shorter, self.pairs
        longest = [""] * n                                  # by distance from the end
        for end, piece in self.starts.iter(text[::-1]):     # the longest comes first
            if not longest[end]:
                longest[end] = self.names[piece]
        failed, any_failed = bytearray(n // 8 + 1), False
        taken: list[str] = []
        at, piece, beside = 0, longest[n - 1] or text[0], None
        while at < n:
            while piece:
                end = at + len(piece)
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    if not taken:
                        break
                    fits = beside.get(piece)
                    if fits is None:
                        fits = self.compatible(taken[-1], piece)
                    if fits:
                        break
                piece = shorter.get(piece, "")
            if piece:
                taken.append(piece)
                at = end
                beside = pairs.get(piece, NOTHING)
                piece = (longest[n - 1 - at] or text[at]) if at < n else ""
            else:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                piece = taken.pop()
                at -= len(piece)
                piece = shorter.get(piece, "")
                beside = pairs.get(taken[-1], NOTHING) if taken else None
        return taken

    def ids_of(self, part: str) -> bytes:
        """Ids of one part, as 32-bit numbers; a character that is no piece becomes its bytes."""
        pieces = self.split(part)
        try:
            return array("i", map(self.id.__getitem__, pieces)).tobytes()
        except KeyError:
            return array("i", (i for p in pieces for i in ((self.id[p],) if p in self.id else map(self.byte_id.__getitem__, p.encode())))).tobytes()

    def pairs_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs of piece numbers, from a table with one pair a slot."""
        key = left * len(self.names) + right
        slot = (key.astype(np.uint64) * SPREAD >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        fits = self.pair_fits[slot]
        new = np.flatnonzero(self.pair_key[slot] != key)
        if len(new):
            keys, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            known = np.array([self.merged(a + b) == [a, b] for a, b in
                              ((self.names[left[i]], self.names[right[i]]) for i in new[first])])
            fits[new] = known[back]
            self.pair_key[slot[new[first]]], self.pair_fits[slot[new[first]]] = keys, known
        return fits

    def split_many(self, parts: list[str]) -> list[bytes | None]:
        """Ids of many short parts, by the same backtracking, one step of all of them at
        a time; None for a part with a character that is no piece."""
        joined = self.border.join(p[::-1] for p in parts)
        found = [0] * (len(joined) + 1)
        for end, piece in self.starts.iter(joined):         # the longest comes first
            if not found[end]:
                found[end] = piece
        longest, n = np.array(found), np.array([len(p) for p in parts])
        start = np.cumsum(n + 1) - n - 1
        unknown = np.add.reduceat(longest[:-1] == 0, start) - (np.arange(len(parts)) < len(parts) - 1) > 0
        failed, any_failed = np.zeros(len(joined) // 8 + 1, np.uint8), False
        taken, depth, at = np.zeros((len(parts), int(n.max())), np.int64), np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        piece = longest[start + n - 1]
        todo = np.flatnonzero(~unknown)
        while len(todo):
            now, end = piece[todo], at[todo] + self.length_at[piece[todo]]
            inner = depth[todo] > 0
            fits = np.ones(len(todo), bool)
            fits[inner] = self.pairs_fit(taken[todo[inner], depth[todo[inner]] - 1], now[inner])
            if any_failed:
                place = start[todo] + end
                fits &= failed[place >> 3] >> (place & 7) & 1 == 0
            on = todo[fits]
            taken[on, depth[on]] = now[fits]
            depth[on] += 1
            at[on] = end[fits]
            piece[on] = longest[start[on] + n[on] - 1 - at[on]]
            back = todo[~fits]
            piece[back] = self.shorter_at[piece[back]]
            back = back[piece[back] == 0]
            if len(back):                                   # nothing fits here: the last piece is taken back
                any_failed = True
                place = start[back] + at[back]
                np.bitwise_or.at(failed, place >> 3, (1 << (place & 7)).astype(np.uint8))
                depth[back] -= 1
                last = taken[back, depth[back]]
                at[back] -= self.length_at[last]
                piece[back] = self.shorter_at[last]
            todo = todo[at[todo] < n[todo]]
        ids = self.id_at[taken]
        ids[np.arange(ids.shape[1]) >= depth[:, None]] = 0
        whole = ~unknown & (ids >= 0).all(axis=1)
        return [row[:4 * k] if ok else None for row, k, ok in zip(map(bytes, ids), depth, whole)]

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, as 32-bit numbers."""
        cut, size = [], 0
        for text in texts:
            text = text.replace(" ", SPACE)
            if text and self.dummy_prefix:
                text = SPACE + text
            if size and size + len(text) > STEP:
                yield from self.encode_parts(cut)
                cut, size = [], 0
            size += len(text)
            if size <= STEP:
                cut.append(self.part.findall(text))
            else:                                           # a long text of its own, a step at a time
                yield b"".join(b for parts in self.steps(text) for b in self.encode_parts([parts]))
                size = 0
        yield from self.encode_parts(cut)

    def steps(self, text: str) -> Iterator[list[str]]:
        """The parts of a long text."""
        at, reach = 0, STEP
        while at < len(text):
            parts = self.part.findall(text, at, at + reach)
            if at + reach < len(text):                      # the last part may go on
                if len(parts) == 1:
                    reach *= 2
                    continue
                parts.pop()
            yield parts
            at, reach = at + sum(map(len, parts)), STEP

    def encode_parts(self, cut: list[list[str]]) -> Iterator[bytes]:
        """Ids of texts that are cut into parts."""
        if len(self.kept) > KEPT_PARTS // 2:
            self.kept, self.older = {}, self.kept           # what is still met moves on from the older table
        kept, older, missing, long = self.kept, self.older, [], {}
        for part in set().union(*cut) - kept.keys():
            ids = older.get(part)
            if ids is not None:
                kept[part] = ids
            elif len(part) <= KEPT_LENGTH:
                missing.append(part)
            else:
                long[part] = self.ids_of(part)
        if missing:
            for part, ids in zip(missing, self.split_many(missing)):
                kept[part] = self.ids_of(part) if ids is None else ids
        ids_of = ({**kept, **long} if long else kept).__getitem__
        for parts in cut:
            yield b"".join(map(ids_of, parts))


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``doc_id, ids``: the ids of each whole text, without begin or end ids.

    ``model`` is the path of a sentencepiece model file on every machine.
    """
    model = model or model_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            first, ids, ends = 0, bytearray(), [0]

            def flush(stop: int) -> pa.RecordBatch:
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(bytes(ids))])
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, stop - first),
                                                   pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["doc_id", "ids"])

            for i, found in enumerate(pieces.encode(text.as_py() or "" for text in batch.column(1))):
                ids += found
                ends.append(len(ids) // 4)
                if len(ids) >= FLUSH_BYTES:
                    yield flush(i + 1)
                    first, ids, ends = i + 1, bytearray(), [0]
            if first < batch.num_rows:
                yield flush(batch.num_rows)

    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """``doc_id, ids, text``: the texts that the library gives for the ids."""
    model = model or model_path()
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                texts = [processor(model).decode(ids.values.to_numpy().tolist() if ids.is_valid else []) for ids in rows.column(1)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select(encoded[id_col], encoded[ids_col]).mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """Number and digest of the ids, digest of the decoded text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
