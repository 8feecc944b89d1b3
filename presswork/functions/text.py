"""Text column expressions: folding, cleaning, tokenising, counting, sections."""

from __future__ import annotations

import functools
import re
import string
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, functions as F

from presswork.functions.maths import let
from presswork.functions.stopwords import ENGLISH

NON_ASCII = r"[^\x00-\x7F]"
# A table is looked up once a letter; a class of so many ranges beside other patterns is slow.
DROPPED = "".join(c for c in string.punctuation if c != "-") + string.digits

# The Treebank contractions that still match once apostrophes are gone.
CONTRACTIONS = [
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
]


@functools.lru_cache(maxsize=1)
def _fold_rules() -> tuple[str, str, str, str]:
    """NFKD folding derived from the Unicode data: one-letter and longer results."""
    single, base, longer, expansion = [], [], [], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        ascii_form = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(ascii_form) == 1:
            single.append(char)
            base.append(ascii_form)
        elif ascii_form:
            longer.append(char)
            expansion.append(ascii_form)
    return "".join(single), "".join(base), "".join(longer), "\n".join(expansion)


def fold_ascii(text: Column) -> Column:
    """Compatibility-decompose and drop what is not ASCII; ASCII text is untouched."""
    single, base, longer, expansion = _fold_rules()
    longer_class = f"[{longer}]"
    expansions = F.split(F.lit(expansion), "\n")
    # The large character class is slow to test, so it sees the non-ASCII rest only.
    rest = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    spelled_out = F.when(
        rest.rlike(longer_class),
        F.aggregate(
            F.array_distinct(F.regexp_extract_all(rest, F.lit(f"({longer_class})"), 1)),
            text,
            lambda acc, char: F.replace(
                acc, char, F.get(expansions, F.position(char, F.lit(longer)) - 1)
            ),
        ),
    ).otherwise(text)
    folded = F.regexp_replace(
        F.translate(spelled_out, single, base), f"{NON_ASCII}+", ""
    )
    return F.when(text.rlike(NON_ASCII), folded).otherwise(text)


def strip_punct_digits(text: Column) -> Column:
    """Hyphens become spaces; other ASCII punctuation and digits disappear."""
    return F.translate(text, "-" + DROPPED, " ")


def split_contractions(text: Column) -> Column:
    heads = "|".join(f"{head}(?={tail}\\b)" for head, tail in CONTRACTIONS)
    return F.regexp_replace(text, rf"(?i)\b({heads})", "$1 ")


def words(text: Column) -> Column:
    """Word tokens of already stripped text."""
    return F.filter(F.split(split_contractions(text), r"\s+"), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Raw text to word tokens, case kept."""
    return words(strip_punct_digits(fold_ascii(text)))


def sentences(text: Column) -> Column:
    """Sentences as strings; only for callers who want them, the bag does not."""
    return F.transform(
        F.sentences(text, F.lit("en"), F.lit("US")), lambda s: F.concat_ws(" ", s)
    )


def default_stopwords() -> tuple[str, ...]:
    return ENGLISH


def keep_word(word: Column, stopwords) -> Column:
    """At least three characters and, in lower case, not a stopword."""
    long_enough = F.length(word) >= 3
    if not stopwords:
        return long_enough
    return long_enough & ~F.lower(word).isin(list(stopwords))


def plural_stem(word: Column) -> Column:
    """Harman's S-stemmer: the three plural rules, first match wins."""
    return (
        F.when(
            word.endswith("ies") & ~word.endswith("eies") & ~word.endswith("aies"),
            F.regexp_replace(word, "ies$", "y"),
        )
        .when(
            word.endswith("es")
            & ~word.endswith("aes")
            & ~word.endswith("ees")
            & ~word.endswith("oes"),
            F.regexp_replace(word, "es$", "e"),
        )
        .when(
            word.endswith("s") & ~word.endswith("us") & ~word.endswith("ss"),
            F.regexp_replace(word, "s$", ""),
        )
        .otherwise(word)
    )


def count_words(words_: Column) -> Column:
    """Array of words to ``array<struct<term, tf>>``, inside the row.

    Sort, find where each run starts, subtract neighbouring starts. A document
    is one row, so its counts need neither an explode nor a shuffle.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(
                ordered, lambda w, i: F.when((i == 0) | (w != F.get(ordered, i - 1)), i)
            ),
            lambda i: i.isNotNull(),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, j: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, j + 1), F.size(ordered)) - start)
                    .cast("bigint")
                    .alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(words_), runs)


class _Terms(dict):
    """Lower-case word to its term, worked out when a task first meets the word.

    A dropped word has None. Only signs that are no letters can leave a word with several terms; it has
    their tuple, which is also in ``several``.
    """

    LIMIT = 400_000  # words; about 100 MB in a task

    def __init__(self, stopwords: tuple[str, ...], plural: bool):
        super().__init__()
        self.stopwords, self.plural = frozenset(s.encode() for s in stopwords), plural
        heads = "|".join(f"{head}(?={tail}\\b)" for head, tail in CONTRACTIONS)
        self.contractions = re.compile(rf"\b({heads})".encode())
        self.contracted = frozenset(f"{head}{tail}".encode() for head, tail in CONTRACTIONS)
        self.several: set[tuple[str, ...]] = set()

    def _term(self, word: bytes) -> str | None:
        if len(word) < 3 or word in self.stopwords:
            return None
        if self.plural:
            word = _plural_stem(word)
            if len(word) < 3 or word in self.stopwords:
                return None
        return word.decode()

    def __missing__(self, word: bytes) -> str | tuple[str, ...] | None:
        if word.isalpha() and word not in self.contracted:
            found = self._term(word)
        else:
            terms = map(self._term, self.contractions.sub(rb"\1 ", word).split())
            some = tuple(t for t in terms if t is not None)
            found = some if len(some) > 1 else some[0] if some else None
            if len(some) > 1:
                self.several.add(some)
        self[word] = found
        return found

    def counts(self, words: list[bytes]) -> dict[str, int]:
        if len(self) >= self.LIMIT:
            self.clear()
            self.several.clear()
        counted = Counter(map(self.__getitem__, words))
        counted.pop(None, None)
        for some in counted.keys() & self.several:
            n = counted.pop(some)
            for term in some:
                counted[term] += n
        return counted


def _plural_stem(word: bytes) -> bytes:
    """``plural_stem`` of one word."""
    if word.endswith(b"ies") and not word.endswith((b"eies", b"aies")):
        return word[:-3] + b"y"
    if word.endswith(b"es") and not word.endswith((b"aes", b"ees", b"oes")):
        return word[:-1]
    if word.endswith(b"s") and not word.endswith((b"us", b"ss")):
        return word[:-1]
    return word


def _lowered_words(text: bytes) -> list[bytes]:
    """``tokens`` in lower case, contractions whole; bytes split at the white space of ``\\s``."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.decode("utf-8", "replace")).encode("ascii", "ignore")
    blank = bytes.maketrans(b"-" + string.ascii_uppercase.encode(), b" " + string.ascii_lowercase.encode())
    return text.translate(blank, DROPPED.encode()).split()


def term_counts(text: Column, stopwords=(), plural: bool = True) -> Column:
    """Raw text to ``struct<bag array<struct<term, tf>>, doc_len>``, terms in order.

    The same as ``count_words`` over ``tokens``, ``keep_word``, lower case and (``plural``)
    ``plural_stem``. Those work a word's rules out at each occurrence; here an occurrence is a lookup.
    """
    entry = pa.struct([("term", pa.string()), ("tf", pa.int64())])

    @F.arrow_udf("struct<bag: array<struct<term: string, tf: bigint>>, doc_len: bigint>")
    def counted(texts: pa.Array) -> pa.Array:
        ends, names, numbers, lengths = [0], [], [], []
        for text in texts.cast(pa.binary()):
            raw = text.as_py()
            if raw is None:
                ends[-1] = None  # Arrow's mark of a null list: its start is null
                ends.append(len(names))
                lengths.append(None)
                continue
            bag = known.counts(_lowered_words(raw))
            ordered = sorted(bag)
            names += ordered
            numbers += map(bag.__getitem__, ordered)
            ends.append(len(names))
            lengths.append(sum(bag.values()))
        entries = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int64())], fields=list(entry))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
        return pa.StructArray.from_arrays([lists, pa.array(lengths, pa.int64())], ["bag", "doc_len"])

    known = _Terms(tuple(stopwords), plural)
    return counted(text)


def split_sections(raw: Column, word_boundary: bool = False) -> Column:
    """One ``online_sections`` value to lower-case categories, duplicates kept.

    By default ``and`` also splits inside a word, as the published labels were
    made; ``word_boundary=True`` splits on the whole word only.
    """
    separator = r";|\band\b|," if word_boundary else ";|and|,"
    parts = F.split(F.regexp_replace(raw, "[()]", ", "), separator)
    trimmed = F.transform(parts, lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.transform(F.filter(trimmed, lambda s: s != ""), F.lower)
