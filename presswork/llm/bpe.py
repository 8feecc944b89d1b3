"""Byte-level BPE by prefix dynamic programming.

Of all tokens that end at a byte of a piece, exactly one can be the last token of
the encoding of the bytes so far: the one that may stand behind the last token of
the prefix it leaves. ``PrefixTable`` stores it for every byte. Reading the table
backwards encodes any prefix, appending bytes only fills new entries, and after an
edit entries are renewed from the edit on until they agree with the old ones for
as many bytes as the longest token has.

Two tokens may stand side by side if merging their bytes by rank never crosses the
seam. ``Merges`` decides that from the merge history of each token: histories of
the two sides advance by rank, and the seam must not be the best merge at any time.

Defined cases: a null text encodes like an empty one (no tokens); rows are encoded
one by one; other columns pass through.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from presswork.llm.common import binaries, chunks

# Entries of the per-process memories; a full one is emptied and filled anew.
UNITS = 900_000
SEAMS = 500_000
TAILS = 200_000
# Tokens of up to so many bytes that end alike are looked up together.
TAIL = 6
NEVER = 1 << 60
# Longer pieces fill their table from the front instead of asking for prefixes as needed.
ON_DEMAND = 256


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Merges:
    """What the ranks alone decide: histories of tokens and seams between tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.length_of = {rank: len(token) for token, rank in ranks.items()}
        # Every ending of a token, with the token's rank if it is itself one.
        self.suffixes: dict[bytes, int | None] = {}
        for token in ranks:
            for k in range(1, len(token)):
                self.suffixes.setdefault(token[k:], None)
        self.suffixes.update(ranks)
        self.histories: dict[int, tuple | None] = {}
        self.seams: dict[int, bool] = {}
        self.tails: dict[bytes, tuple[list[int], bool]] = {}

    def endings(self, data: bytes, end: int) -> list[int]:
        """The tokens that end at ``end``, longest first."""
        tail = data[end - TAIL if end > TAIL else 0 : end]
        known = self.tails.get(tail)
        if known is None:
            found = []
            for start in range(len(tail) - 1, -1, -1):
                token = self.suffixes.get(tail[start:], NEVER)
                if token == NEVER:
                    break
                if token is not None:
                    found.append(token)
            goes_on = len(tail) == TAIL and tail in self.suffixes
            if len(self.tails) >= TAILS:
                self.tails.clear()
            known = self.tails[tail] = (found[::-1], goes_on)
        found, goes_on = known
        if not goes_on or end == TAIL:
            return found
        longer = []
        for start in range(end - TAIL - 1, -1, -1):
            token = self.suffixes.get(data[start:end], NEVER)
            if token == NEVER:
                break
            if token is not None:
                longer.append(token)
        return longer[::-1] + found

    def history(self, token: int) -> tuple | None:
        """Merges of the token's bytes: (rank, first part, last part) after each one.

        The first entry has rank -1 and the single bytes. None if merging ends
        elsewhere than at the token, which then never appears in an encoding.
        """
        if token not in self.histories:
            whole = self.bytes_of[token]
            parts = [whole[i : i + 1] for i in range(len(whole))]
            log = [(-1, parts[0], parts[-1])]
            while len(parts) > 1:
                found = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
                best = min(found)
                if best == NEVER:
                    break
                at = found.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                log.append((best, parts[0], parts[-1]))
            self.histories[token] = tuple(log) if len(parts) == 1 else None
        return self.histories[token]

    def seam(self, left: int, right: int) -> bool:
        """Does merging the bytes of both leave the seam between them untouched?"""
        key = left << 32 | right
        known = self.seams.get(key)
        if known is None:
            if len(self.seams) >= SEAMS:
                self.seams.clear()
            known = self.seams[key] = self._seam(left, right)
        return known

    def _seam(self, left: int, right: int) -> bool:
        one, two = self.history(left), self.history(right)
        if one is None or two is None:
            return False
        i = j = 0
        while True:
            across = self.ranks.get(one[i][2] + two[j][1], NEVER)
            next_left = one[i + 1][0] if i + 1 < len(one) else NEVER
            next_right = two[j + 1][0] if j + 1 < len(two) else NEVER
            # Of equal ranks the leftmost merge comes first.
            if across < next_left and across <= next_right:
                return False
            if next_left <= next_right:
                if next_left == NEVER:
                    return True
                i += 1
            else:
                j += 1


class PrefixTable:
    """The last token of the encoding of every prefix of some bytes."""

    def __init__(self, merges: Merges, data: bytes = b""):
        self.merges = merges
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def _token_at(self, end: int) -> int:
        """The one token that ends at ``end`` and fits behind what it leaves."""
        merges = self.merges
        low = max(0, end - merges.longest)
        for token in merges.endings(bytes(self.data[low:end]), end - low):
            at = end - merges.length_of[token]
            if merges.seam(self.last[at - 1], token) if at else merges.history(token) is not None:
                return token
        raise ValueError("a byte has no token of its own")

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        for end in range(start + 1, len(self.data) + 1):
            self.last.append(self._token_at(end))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes start..stop; returns how many entries were renewed."""
        old = self.last[stop:]
        self.data[start:stop] = new
        del self.last[start:]
        renewed = agreed = 0
        for end in range(start + 1, len(self.data) + 1):
            token = self._token_at(end)
            self.last.append(token)
            renewed += 1
            behind = end - start - len(new) - 1
            agreed = agreed + 1 if behind >= 0 and old[behind] == token else 0
            if agreed >= self.merges.longest:
                self.last += old[behind + 1 :]
                break
        return renewed

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes."""
        at = len(self.data) if end is None else end
        ids = []
        while at:
            ids.append(self.last[at - 1])
            at -= len(self.merges.bytes_of[ids[-1]])
        return ids[::-1]


def encode_piece(merges: Merges, piece: bytes) -> list[int]:
    """The encoding of one piece; a piece that is a token is that token."""
    whole = merges.ranks.get(piece)
    if whole is not None:
        return [whole]
    if not piece or len(piece) > ON_DEMAND:
        return PrefixTable(merges, piece).tokens()
    last: dict[int, int] = {}
    _fill(merges, piece, len(piece), last)
    ids = []
    at = len(piece)
    while at:
        token = last[at]
        ids.append(token)
        at -= merges.length_of[token]
    ids.reverse()
    return ids


def _fill(merges: Merges, piece: bytes, end: int, last: dict[int, int]) -> int:
    """Store the last token of the prefix ``end``, and of those prefixes that it asks for."""
    for token in merges.endings(piece, end):
        start = end - merges.length_of[token]
        if start:
            behind = last.get(start)
            if behind is None:
                behind = _fill(merges, piece, start, last)
            fits = merges.seams.get(behind << 32 | token)
            if fits is None:
                fits = merges.seam(behind, token)
        else:
            fits = merges.history(token) is not None
        if fits:
            last[end] = token
            return token
    raise ValueError("a byte has no token of its own")


class Codec:
    """Encode and decode texts with a rank file and a pattern that cuts texts into pieces.

    ``pattern`` must have no lookbehind and must start a new piece at every blank
    that is followed by a character other than white space, as the usual patterns
    do. A text is then cut at those blanks first, and the encoding of a unit (with
    the blank before it) is kept for its next occurrence.
    """

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(load_ranks(path))
        self.cut = regex.compile(pattern)
        self.blank = re.compile(r" (?=\S)")
        self.units: dict[str, bytes] = {}
        size = max(self.merges.bytes_of, default=-1) + 1
        self.token_bytes = [self.merges.bytes_of.get(i, b"") for i in range(size)]
        self.decimals = [str(i) for i in range(size)]

    def _encoded(self, text: str) -> bytes:
        """The ids of ``text`` as int32, piece by piece."""
        ids: list[int] = []
        for piece in self.cut.findall(text):
            ids += encode_piece(self.merges, piece.encode())
        return array("i", ids).tobytes()

    def _unit(self, unit: str) -> bytes:
        if len(self.units) >= UNITS:
            self.units.clear()
        made = self.units[unit] = self._encoded(" " + unit)
        return made

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        first, *rest = self.blank.split(text)
        known, new = self.units.get, self._unit
        parts = [self._encoded(first)]
        parts += [known(u) or new(u) for u in rest]
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def in_decimals(self, ids: list[int]) -> str:
        return ",".join(map(self.decimals.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    return Codec(path, pattern)


def _with(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    new = {f.name for f in fields}
    old = [T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in new]
    return T.StructType([*old, *fields])


def encode_documents(docs: DataFrame, path: str, pattern: str, out: str = "ids") -> DataFrame:
    """Add the token ids of ``text`` as an array column."""
    schema = _with(docs.schema, T.StructField(out, T.ArrayType(T.IntegerType(), False)))
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in chunks(batches):
            ids = [own.encode(t.decode("utf-8", "replace")) for t in binaries(batch, "text")]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            made = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], made], names=[*names, out])

    return docs.mapInArrow(run, schema)


def decode_documents(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded"):
    """Add the bytes that the token ids stand for."""
    schema = _with(docs.schema, T.StructField(out, T.BinaryType()))
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            made = [own.decode(x or ()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(made, pa.binary())], names=[*names, out]
            )

    return docs.mapInArrow(run, schema)


DIGEST_ROWS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, decode and add count and digests, without shipping ids between processes."""
    schema = _with(docs.schema, *DIGEST_ROWS)
    names = schema.names[:-3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        own = codec(path, pattern)
        for batch in chunks(batches):
            counts, ids, texts = [], [], []
            for text in binaries(batch, "text"):
                tokens = own.encode(text.decode("utf-8", "replace")).tolist()
                counts.append(len(tokens))
                ids.append(sha256(own.in_decimals(tokens).encode()).hexdigest())
                texts.append(sha256(own.decode(tokens)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.string()),
                    pa.array(texts, pa.string()),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(run, schema)
