"""Byte-level BPE by monoid tree reduction.

Two nested reductions. A text is halved until its parts are short; a part is split by the vocabulary's
pattern; neighbours are joined by splitting again from a piece boundary well inside the left part until a
piece ends where one of the right part's pieces does. From there on both splits depend on the same
characters, so all pieces outside the window are proved stable. A piece (one match of the pattern) is
halved down to leaf size, the leaves are encoded, and neighbours are joined by encoding the bytes of a
boundary window again: k tokens to either side, k growing until the token pairs at both window edges are
themselves valid encodings. A sequence in which every adjacent pair is valid is the encoding of its bytes,
so the tokens outside are proved stable. Decoding concatenates byte strings up the same tree.

Nulls: a null text is the empty text, which has no ids; null ids decode to none. Any length works: memory is that of
one text and its ids. Repeated rows and ties are coded each for itself. An empty table gives an empty result. encode()
and decode() keep all columns but those of the names of the columns that they add, which they replace.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.llm.common import extended, in_arrow, without

#: Code points of a text leaf, bytes of a piece leaf, remembered pieces of a generation.
TEXT_LEAF, PIECE_LEAF, MEMO = 16_384, 16, 40_000
#: Ids of a leaf of the decoding tree.
DECODE_LEAF = 1024
#: How far behind its end, in code points, a match of the pattern can depend on the text.
REACH = 3


class Memo(dict):
    """Pieces' ids by piece. When full, it starts anew but looks at its last generation before encoding again."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> list[int]:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece.encode("utf-8", "replace"))
        if len(piece) <= 64:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class TreeBPE:
    def __init__(self, rank_file: str, pattern: str, text_leaf: int = TEXT_LEAF, piece_leaf: int = PIECE_LEAF):
        import regex

        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.text_leaf, self.piece_leaf = text_leaf, piece_leaf
        self.memo = Memo(self.piece)
        try:  # the compiled library encodes leaves and windows; the method below does the same
            import tiktoken

            self.leaf = tiktoken.Encoding("leaves", pat_str=".", mergeable_ranks=self.ranks, special_tokens={})._core_bpe.encode_single_piece
        except ImportError:
            pass
        self.valid: dict[tuple[int, int], bool] = {}

    # -- tokens of one piece

    def leaf(self, data: bytes) -> list[int]:
        """Merges the adjacent parts of least rank, leftmost first, until none can be merged."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i : i + 2], 1 << 60) for i in range(len(data) - 1)]
        while pairs:
            least = min(pairs)
            if least == 1 << 60:
                break
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def pair_ok(self, a: int, b: int) -> bool:
        found = self.valid.get((a, b))
        if found is None:
            if len(self.valid) > MEMO:
                self.valid.clear()
            found = self.valid[a, b] = self.leaf(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.pair_ok(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            window = self.leaf(b"".join(map(self.bytes_of.__getitem__, left[a:] + right[:b])))
            if (a == 0 or self.pair_ok(left[a - 1], window[0])) and (b == len(right) or self.pair_ok(window[-1], right[b])):
                return left[:a] + window + right[b:]
            k *= 2

    def piece(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        if len(data) <= self.piece_leaf:
            return self.leaf(data)
        half = len(data) // 2
        return self.join(self.piece(data[:half]), self.piece(data[half:]))

    # -- pieces of one text

    def ends(self, text: str, lo: int, hi: int) -> list[int]:
        """Ends of the pattern's matches in text[lo:hi] taken as a text of its own."""
        if hi - lo <= self.text_leaf:
            return [m.end() for m in self.pattern.finditer(text, lo, hi)]
        mid = (lo + hi) // 2
        left, right = self.ends(text, lo, mid), self.ends(text, mid, hi)
        while left and left[-1] > mid - REACH:
            left.pop()
        at, known, i = left[-1] if left else lo, right, 0
        while at < hi:
            at = self.pattern.match(text, at, hi).end()
            left.append(at)
            while i < len(known) and known[i] < at:
                i += 1
            if i < len(known) and known[i] == at:
                left += known[i + 1 :]
                break
        return left

    def pieces(self, text: str) -> list[str]:
        if len(text) <= self.text_leaf:
            return self.pattern.findall(text)
        ends = self.ends(text, 0, len(text))
        return [text[a:b] for a, b in zip(chain((0,), ends), ends, strict=False)]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int]) -> bytes:
        """Leaves of ids as bytes, neighbours concatenated up the tree."""
        level = [b"".join(map(self.bytes_of.__getitem__, ids[i : i + DECODE_LEAF])) for i in range(0, len(ids), DECODE_LEAF)]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids", exact_col: str | None = None) -> DataFrame:
    """docs plus an array of ids and, if named, whether they decode to the text. rank_file is a path every executor has."""

    docs = without(docs, ids_col, exact_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TreeBPE(rank_file, pattern)  # a task has its own, so that its memory goes when the task is over
        for batch in batches:
            for part in _slices(batch, text_col):
                flat, ends, exact = [], [0], []
                for text in part.column(text_col):
                    text = text.as_py() or ""
                    ids = bpe.encode(text)
                    flat.append(np.array(ids, np.int32))
                    ends.append(ends[-1] + len(ids))
                    if exact_col:
                        exact.append(bpe.decode(ids) == text.encode("utf-8", "replace"))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
                more = [pa.array(exact, pa.bool_())] if exact_col else []
                yield pa.RecordBatch.from_arrays([*part.columns, ids, *more], names=[*part.schema.names, ids_col, *([exact_col] if exact_col else [])])

    return in_arrow(docs, run, extended(docs.schema, **{ids_col: "array<int>"} | ({exact_col: "boolean"} if exact_col else {})))


def decode(docs: DataFrame, rank_file: str, pattern: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """docs plus the decoded bytes (binary); null ids decode to none."""
    docs = without(docs, out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TreeBPE(rank_file, pattern)  # a task has its own, so that its memory goes when the task is over
        for batch in batches:
            for part in _slices(batch, ids_col):
                data = pa.array([bpe.decode(x.as_py() or []) for x in part.column(ids_col)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, data], names=[*part.schema.names, out_col])

    return in_arrow(docs, run, extended(docs.schema, **{out_col: "binary"}))


def _slices(batch: pa.RecordBatch, text_col: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of text, whole rows each."""
    rows = max(1, int(batch.num_rows * most / max(1, batch.column(text_col).nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of what encode and decode return, taken where they run."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TreeBPE(rank_file, pattern)  # a task has its own, so that its memory goes when the task is over
        decimal = {i: str(i) for i in bpe.bytes_of}
        for batch in (part for whole in batches for part in _slices(whole, "text")):
            count, told, back = [], [], []
            for text in batch.column("text"):
                ids = bpe.encode(text.as_py() or "")
                count.append(len(ids))
                told.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(told), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_arrow(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
