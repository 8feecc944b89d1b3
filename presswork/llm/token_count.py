"""Token counts: lengths of frequent pre-tokens from a sent table, the others from worker caches.

A tokenizer of this kind cuts a text into pre-tokens and merges each by itself, so a text's
count is the sum of its pre-tokens' lengths. Pre-tokens repeat, so they are looked up:

1. a compact table of frequent pre-tokens and their lengths, learnt from a bounded part of
   the corpus and sent to the workers once (at most ``FREQUENT`` entries of ``LONGEST`` bytes);
2. a cache of each worker for the others, filled by the library's own model and bounded by
   ``CACHE_BYTES``.

No pre-token is shuffled; a document is one row throughout. Both tiers only save time: what
they hold comes from the library, so the counts do not depend on the sample.

Cutting is done here for characters on which the library was asked first (``Counter.plain``:
it neither composes nor treats them apart from the pattern below); a unit between blanks with any other
character goes to the library whole.

Defined cases: null reads as empty and has no tokens; special strings inside a text count one
token each, as the library's default; a very long text is cut at blanks, where no pre-token can
run on; repeated rows get equal counts and a null doc_id is counted like any other; an empty
table gives an empty result. Other columns pass through; columns named like the three outputs
are replaced.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter as Multiset
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from presswork.llm.common import chunks

LIMIT = 2048
# The sent table: entries, and bytes of a pre-token.
FREQUENT = 1 << 15
LONGEST = 64
# The part of the corpus it is learnt from: one document in THINNING until so many
# (pre-token, count) rows have come, at most PER_RUN from each run of texts.
THINNING = 16
LEARNT_ROWS = 200_000
PER_RUN = 8192
CACHE_BYTES = 1 << 25
# Longer texts are counted in runs of about so many characters.
RUN = 1 << 20
MADE = ("n_bytes", "n_tokens", "over_limit")

# The cuts of the vocabulary file's pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


class Lengths(dict):
    """Pre-token -> number of tokens; what is missing is asked from the model and kept while there is room."""

    def __init__(self, model, known: dict[str, int], room: int = CACHE_BYTES):
        super().__init__(known)
        self.known, self.model, self.room, self.left = known, model, room, room
        self.letters = byte_letters()

    def __missing__(self, piece: str) -> int:
        n = len(self.model.tokenize("".join([self.letters[b] for b in piece.encode()])))
        return self.keep(piece, n)

    def keep(self, piece: str, n: int) -> int:
        if len(piece) <= LONGEST:
            # An entry takes about 150 bytes besides its letters.
            cost = 150 + 4 * len(piece)
            if self.left < cost:
                self.clear()
                self.update(self.known)
                self.left = self.room
            self.left -= cost
            self[piece] = n
        return n


class Counter:
    """Counts tokens as the library does with its default treatment of special strings."""

    def __init__(self, path: str, known: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.lengths = Lengths(self.library.model, known or {})
        added = self.library.get_added_tokens_decoder().values()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path}: only plain special strings are supported")
        marks = sorted((t.content for t in added), key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.pattern = regex.compile(PATTERN)
        self.checked: dict[str, bool] = {}
        # The library is asked once whether it cuts letters, digits, signs and blanks as we do.
        if not all(self.plain(chr(c)) for c in (*range(1, 128), 0xE9, 0x416)):
            raise ValueError(f"{path}: the vocabulary cuts or folds texts in another way")

    def plain(self, c: str) -> bool:
        """Does the library fold and cut around this character as done here?"""
        known = self.checked.get(c)
        if known is None:
            known = self.checked[c] = self._asked(c)
        return known

    def _asked(self, c: str) -> bool:
        # Marks and conjoining letters may change with their neighbours.
        if unicodedata.category(c)[0] in "MC" and c not in "\t\n\x0b\x0c\r" and ord(c) > 127:
            return False
        if 0x1100 <= ord(c) <= 0x11FF or 0xA960 <= ord(c) <= 0xA97F or 0xD7B0 <= ord(c) <= 0xD7FF:
            return False
        folded = self._fold(c)
        if regex.sub(r"\s+", " ", folded) != self.library.normalizer.normalize_str(c):
            return False
        probe = f"a{folded}a {folded}{folded} 1{folded}1 !{folded}! '{folded}"
        cut = self.library.pre_tokenizer.pre_tokenize_str(probe)
        return [probe[a:b] for _, (a, b) in cut] == self.pattern.findall(probe)

    @staticmethod
    def _fold(text: str) -> str:
        # Letter by letter: Python alone writes the sigma at a word's end another way.
        return text.replace("Σ", "σ").lower()

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text of plain characters."""
        if text.isascii():
            return ASCII.findall(text.lower())
        return self.pattern.findall(self._fold(text))

    def _all_plain(self, text: str) -> bool:
        return text.isascii() or all(map(self.plain, set(text)))

    def _unmarked(self, text: str) -> int:
        if self._all_plain(text):
            return sum(map(self.lengths.__getitem__, self.pieces(text)))
        # Neither composition nor a pre-token runs across a blank.
        total = 0
        for unit in text.split(" "):
            if self._all_plain(unit):
                total += sum(map(self.lengths.__getitem__, self.pieces(unit)))
                continue
            # A pre-token holds no blank, so one in front keeps these keys apart.
            key = " " + unit
            n = dict.get(self.lengths, key)
            if n is None:
                n = self.lengths.keep(key, len(self.library.encode(unit, add_special_tokens=False).ids))
            total += n
        return total

    def count(self, text: str) -> int:
        total = 0
        parts = [text]
        if self.marks and self.marks.search(text):
            parts = self.marks.split(text)
            total += len(parts) - 1
        for part in parts:
            start = 0
            while len(part) - start > RUN:
                stop = part.find(" ", start + RUN)
                if stop < 0:
                    break
                total += self._unmarked(part[start:stop])
                start = stop
            total += self._unmarked(part[start:] if start else part)
        return total


@lru_cache(maxsize=2)
def counter(path: str, key: str, shared) -> Counter:
    """One counter a worker and call; ``key`` names the call, so no table outlives it."""
    return Counter(path, unpacked(*shared.value))


class _Shared:
    """A broadcast value that the cache of ``counter`` takes as one argument whatever it holds."""

    def __init__(self, value):
        self._value = value

    def __hash__(self):
        return 0

    def __eq__(self, other):
        return isinstance(other, _Shared)

    @property
    def value(self):
        return self._value.value


def packed(known: dict[str, int]) -> tuple[bytes, bytes]:
    """The table as two strings: pre-tokens parted by blanks, which they never hold, and a byte each."""
    return " ".join(known).encode(), bytes(known.values())


def unpacked(pieces: bytes, lengths: bytes) -> dict[str, int]:
    return dict(zip(pieces.decode().split(" "), lengths)) if lengths else {}


def piece_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Counter(path)
        for batch in chunks(batches):
            counts: Multiset = Multiset()
            for text in batch.column(0).to_pylist():
                if text and own._all_plain(text):
                    counts.update(own.pieces(text))
            kept = [(p, n) for p, n in counts.most_common(PER_RUN) if len(p.encode()) <= LONGEST]
            if kept:
                pieces, numbers = zip(*kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pieces, pa.string()), pa.array(numbers, pa.int64())], names=["piece", "n"]
                )

    return run


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", size: int = FREQUENT) -> dict[str, int]:
    """The most frequent pre-tokens of a bounded part of the corpus, with their lengths.

    The limit is the feature: Spark reads splits until ``LEARNT_ROWS`` rows have come, so the
    work and what reaches the driver do not grow with the corpus. Only the speed of the
    count depends on it.
    """
    thinned = docs.where(F.pmod(F.xxhash64(F.col(text).substr(1, 64)), F.lit(THINNING)) == 0)
    rows = thinned.select(F.col(text).alias("text")).mapInArrow(piece_rows(path), "piece string, n long")
    counts: Multiset = Multiset()
    for row in rows.limit(LEARNT_ROWS).collect():
        counts[row["piece"]] += row["n"]
    own = Counter(path)
    best = sorted(counts, key=lambda p: (-counts[p], p))[:size]
    lengths = {p: own.lengths[p] for p in best}
    return {p: n for p, n in lengths.items() if n < 256}


def count_rows(path: str, shared, key: str, columns: list[str], limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, key, shared)
        for batch in chunks(batches, "__text"):
            texts = batch.column("__text")
            sizes = [0 if t is None else len(t) for t in texts.cast(pa.binary()).to_pylist()]
            tokens = [own.count(t) if t else 0 for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in columns],
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=[*columns, *MADE],
            )

    return run


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path`` is a vocabulary file of the ``tokenizers`` library that every worker can read.
    """
    columns = [c for c in docs.columns if c != text and c not in MADE]
    known = packed(frequent_lengths(docs, path, text))
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(known))
    schema = T.StructType(
        [
            *[docs.schema[c] for c in columns],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    slim = docs.select(*columns, F.col(text).alias("__text"))
    return slim.mapInArrow(count_rows(path, shared, uuid.uuid4().hex, columns, limit), schema)
