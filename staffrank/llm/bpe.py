"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Every byte prefix of a piece has exactly one token that can end its encoding.  So the encoder goes
over the bytes once and stores, for each prefix, this *last token*: the one token that ends there
and fits the last token of the prefix before it.  Two neighbours fit when merging by rank would
never join bytes across their border.  The encoding is read back from the stored tokens.

A stored prefix never changes when bytes are appended, so :class:`PrefixEncoding` appends exactly,
and after an edit encodes again from the edited byte on only.

Vocabulary files hold one ``base64(token bytes) rank`` per line; ids are ranks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE_PIECES = 1 << 19  # distinct pieces (or token pairs) that a task remembers; then it starts anew
CACHE_PIECE_BYTES = 64  # longer pieces are not remembered
STRIDE = 4              # the last tokens of a piece are remembered after so many bytes


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


class PrefixEncoder:
    """Last-token tables over one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        # the tokens from their last byte on, as a tree: (node, byte before) -> node, and the token at a node
        self._step: dict[int, int] = {}
        self._ends: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in reversed(token):
                node = self._step.setdefault(node << 8 | b, len(self._ends))
                if node == len(self._ends):
                    self._ends.append(-1)
            self._ends[node] = rank
        self._split: dict[int, tuple[int, int] | None] = {}
        self._right: dict[int, list[int]] = {}
        self._left: dict[int, list[int]] = {}
        self._fits: dict[int, bool] = {}
        self._prefixes: dict[bytes, list[int]] = {}

    def split(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes t; (t, t) for a byte; None if merging never makes t."""
        if t not in self._split:
            parts = [self.ranks.get(bytes((b,))) for b in self.token[t]]
            found = (t, t) if len(parts) == 1 else None
            while len(parts) > 1 and None not in parts:
                joins = [(self.ranks.get(self.token[a] + self.token[b], 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, i = min(joins)
                if rank == 1 << 60:
                    break
                if len(parts) == 2:
                    found = (parts[0], parts[1])
                parts[i: i + 2] = [rank]
            self._split[t] = found
        return self._split[t]

    def _spine(self, t: int, side: int, memo: dict[int, list[int]]) -> list[int]:
        """Tokens at one end of t, from its outermost byte up to t itself."""
        if t not in memo:
            child = self.split(t)[side]
            memo[t] = [t] if child == t else [*self._spine(child, side, memo), t]
        return memo[t]

    def fits(self, a: int, b: int) -> bool:
        """Do a and b stay apart?  Follow the tokens that touch at their border while both grow: a
        join across it happens if its rank comes before the next growth on either side (of equal
        ranks the left one is first)."""
        key = a << 32 | b
        known = self._fits.get(key)
        if known is not None:
            return known
        left, right = self._spine(a, 1, self._right), self._spine(b, 0, self._left)
        i = j = 0
        never = 1 << 60
        ok = True
        while True:
            grow_left = left[i + 1] if i + 1 < len(left) else never
            grow_right = right[j + 1] if j + 1 < len(right) else never
            across = self.ranks.get(self.token[left[i]] + self.token[right[j]])
            if across is not None and across < grow_left and across <= grow_right:
                ok = False
                break
            if grow_left == grow_right == never:
                break
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1
        if len(self._fits) >= CACHE_PIECES:
            self._fits.clear()
        self._fits[key] = ok
        return ok

    def extend(self, data: bytes, last: list[int]) -> None:
        """Append to ``last`` the last token of every prefix of data longer than len(last) bytes."""
        step, ends, split, known, fits = self._step.get, self._ends, self._split, self._fits.get, self.fits
        for end in range(len(last) + 1, len(data) + 1):
            node, found = 0, []
            for start in range(end - 1, -1, -1):  # back over the bytes that some token ends with
                node = step(node << 8 | data[start])
                if node is None:
                    break
                t = ends[node]
                if t >= 0:
                    if (split[t] if t in split else self.split(t)) is None:
                        ends[node] = -1  # merging never makes this token
                    else:
                        found.append((start, t))
            while found:
                start, t = found.pop()
                if start:
                    stay = known(last[start - 1] << 32 | t)
                    if not (fits(last[start - 1], t) if stay is None else stay):
                        continue
                last.append(t)
                break
            else:
                raise ValueError(f"no token ends byte {end} of a piece: {data[:end][-20:]!r}")

    def read_back(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            t = last[end - 1]
            out.append(t)
            end -= len(self.token[t])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:  # a piece that is a token is this token
            return [whole]
        last = self._begun(data, (len(data) - 1) // STRIDE * STRIDE) if STRIDE < len(data) <= CACHE_PIECE_BYTES else []
        self.extend(data, last)
        return self.read_back(last)

    def _begun(self, data: bytes, n: int) -> list[int]:
        """A copy of the last tokens of the first n bytes, a multiple of ``STRIDE``: many pieces begin alike."""
        last = self._prefixes.get(data[:n])
        if last is None:
            last = self._begun(data, n - STRIDE) if n > STRIDE else []
            self.extend(data[:n], last)
            if len(self._prefixes) >= CACHE_PIECES // 4:
                self._prefixes.clear()
            self._prefixes[data[:n]] = last
        return last.copy()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PrefixEncoding:
    """One piece that grows or is edited: keeps the last tokens of unchanged prefixes."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.encoder.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        self.data = self.data[:start] + new + self.data[stop:]
        del self.last[start:]
        self.encoder.extend(self.data, self.last)

    def ids(self) -> list[int]:
        whole = self.encoder.ranks.get(self.data)
        return [whole] if whole is not None else self.encoder.read_back(self.last)


class TextEncoder:
    """Splits texts by a pattern and encodes each match by itself; remembers short pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = PrefixEncoder(ranks)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _encode(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode_piece(piece.encode("utf-8")), dtype=np.int32).tobytes()
        if len(piece) <= CACHE_PIECE_BYTES:
            if len(self.known) >= CACHE_PIECES:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        known, encode = self.known.get, self._encode
        return np.frombuffer(b"".join([known(p) or encode(p) for p in self.pieces(text)]), dtype=np.int32)


@lru_cache(maxsize=2)
def text_encoder(content: bytes, pattern: str) -> TextEncoder:
    """The encoder of a vocabulary file: one for all tasks of a worker, with the pieces that it remembers."""
    return TextEncoder(parse_ranks(content), pattern)


ENCODED = "ids array<int>, decoded binary"
_TYPE = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def round_trip(spark: SparkSession, ranks_path: str, pattern: str, text: Column) -> Column:
    """Struct column of (ids, decoded): the token ids of a text, and the bytes they decode to.

    Defined cases: a null text is read as empty, and an empty text has no ids and no bytes; characters
    outside of every token are spelled by their bytes; equal texts have equal ids; very long pieces
    take time in proportion to their bytes.
    """
    with open(ranks_path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())  # one vocabulary, about a MB

    @F.arrow_udf(ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        texts = text_encoder(content.value, pattern)
        token = texts.encoder.token.__getitem__
        for batch in batches:
            ids = [texts.encode(t) if t else np.zeros(0, np.int32) for t in (x.as_py() for x in batch)]
            decoded = pa.array([b"".join(map(token, x.tolist())) for x in ids], pa.binary())
            yield pa.StructArray.from_arrays([_lists(ids), decoded], fields=list(_TYPE))

    return encode(text.cast("string"))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, out: str) -> DataFrame:
    """``docs`` with a struct column ``out`` of (ids, decoded) for its ``text``."""
    return docs.withColumn(out, round_trip(docs.sparkSession, ranks_path, pattern, F.col("text")))
