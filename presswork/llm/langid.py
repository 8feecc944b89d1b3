"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (1 to 3 letters, blanks marking word
ends) of a language by rank. A document is compared with a profile by the
out-of-place distance: its own most frequent n-grams, how far each is from its
place in the profile, and the profile's length for those it lacks.

Profiles come from word counts per language over all training documents, summed
up in each task; n-grams are then counted once per distinct word. Documents are
counted in numpy: the n-grams of a run of texts are numbers that are sorted once.

Defined cases: a text that is null or has no letter is ``und`` with score 0; equal
distances go to the least language; n-grams of equal counts rank by code points; a
null doc_id hashes like an empty one; rows are judged one by one; without training
documents everything is ``und``; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from presswork.llm.common import binaries, chunks
from presswork.llm.lm import remainder
from presswork.session import materialize

LENGTH = 300
SHIFT = 21  # bits of a code point
BLANK = 1
BUFFERED_WORDS = 300_000
# Profiles travel to every task: 10,000 languages are 3 million n-grams, about 50 MB.
MAX_LANGUAGES = 10_000


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point to lower-case letter, or to the blank."""
    table = np.full(0x110000, BLANK, np.int64)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low[0])
    return table


def code_points(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The letters of a text with one blank around each word, and where in the text they stand.

    Blanks stand for the character before the word or after it. Both are empty
    for a text without a letter.
    """
    points = letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    inside = np.empty(len(points) + 2, bool)
    inside[0] = inside[-1] = False
    np.not_equal(points, BLANK, out=inside[1:-1])
    # A blank stays if a letter follows it, or if it is the last of all.
    keep = inside.copy()
    keep[:-1] |= inside[1:]
    at = np.flatnonzero(keep)
    if not len(at):
        return np.zeros(0, np.int64), at
    at = np.append(at, at[-1] + 1)
    padded = np.full(len(points) + 2, BLANK, np.int64)
    padded[1:-1] = points
    return padded[at], at - 1


def grams(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All 1- to 3-grams as numbers, and the place of the first letter or blank of each.

    No gram is a blank alone or has one in its middle.
    """
    two = (a[:-1] << SHIFT) | a[1:]
    three = (two[:-1] << SHIFT) | a[2:]
    letter = np.flatnonzero(a != BLANK)
    middle = np.flatnonzero(a[1:-1] != BLANK)
    return (
        np.concatenate([a[letter], two, three[middle]]),
        np.concatenate([letter, np.arange(len(two)), middle]),
    )


def ranked(values: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The ``length`` most frequent values, ties to the smaller one."""
    distinct, seen = np.unique(values, return_counts=True)
    return distinct[np.lexsort((distinct, -seen))[:length]]


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letter words by language, summed up in the task."""

    def rows(counts: dict) -> pa.RecordBatch:
        flat = [(lang, w, n) for lang, own in counts.items() for w, n in own.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
            names=["lang", "word", "n"],
        )

    counts: dict[str, Counter] = {}
    held = 0
    for batch in chunks(batches):
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        for lang, text in zip(langs, binaries(batch, "text")):
            counts.setdefault(lang, Counter()).update(text.split())
        held = sum(map(len, counts.values()))
        if held >= BUFFERED_WORDS:
            yield rows({k: _as_text(c) for k, c in counts.items()})
            counts = {}
    if counts:
        yield rows({k: _as_text(c) for k, c in counts.items()})


def _as_text(counts: Counter) -> Counter:
    return Counter({w.decode("utf-8", "replace"): n for w, n in counts.items()})


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of distinct words, weighted with the words' counts; blocks of words of one language."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        by_lang: dict[str, list[int]] = {}
        for i, lang in enumerate(langs):
            by_lang.setdefault(lang, []).append(i)
        words, counts = batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
        for lang, own in by_lang.items():
            # Words hold no white space, so a line is a word.
            joined = "\n".join([words[i] for i in own])
            points, where = code_points(joined)
            if not len(points):
                continue
            raw = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
            word = np.concatenate([[0], np.cumsum(raw == 10)])
            found, first = grams(points)
            # A blank in front of a word is the line end before it: look at the next character.
            at_char = np.minimum(np.where(points == BLANK, where + 1, where), len(raw) - 1)
            weights = counts[own][word[at_char[first]]]
            distinct, at = np.unique(found, return_inverse=True)
            total = np.bincount(at, weights).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(distinct)), pa.array(distinct), pa.array(total)],
                names=["lang", "gram", "n"],
            )


def profiles(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(lang, gram, place)``: the ``length`` most frequent n-grams of each language."""
    words = (
        docs.where("lang is not null")
        .select("lang", "text")
        .mapInArrow(_word_rows, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    counts = (
        words.mapInArrow(_gram_rows, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # The bound on the row number itself lets Spark keep the first rows of a language before the shuffle.
    ranked_rows = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= length)
    return ranked_rows.withColumn("place", F.col("place") - 1)


class Profiles:
    """All profiles as a sorted list of n-grams with a row of places each."""

    def __init__(self, rows: list, length: int = LENGTH):
        self.length = length
        self.langs = sorted({r["lang"] for r in rows}, key=lambda x: x.encode())
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.grams = np.unique(np.array([r["gram"] for r in rows], np.int64))
        self.places = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for r in rows:
            self.places[np.searchsorted(self.grams, r["gram"]), at[r["lang"]]] = r["place"]

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of ranked n-grams to each profile."""
        place = np.searchsorted(self.grams, own)
        found = place < len(self.grams)
        found[found] = self.grams[place[found]] == own[found]
        theirs = self.places[np.where(found, place, len(self.grams))]
        apart = np.abs(theirs - np.arange(len(own))[:, None])
        return np.where(theirs < 0, self.length, apart).sum(axis=0)

    def judge(self, text: str) -> tuple[str, float]:
        points, _ = code_points(text)
        if not len(points) or not self.langs:
            return "und", 0.0
        own = ranked(grams(points)[0], length=self.length)
        apart = self.distances(own)
        best = int(np.argmin(apart))
        return self.langs[best], float(1.0 - apart[best] / (self.length * len(own)))


def _judged(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in chunks(batches):
            made = [own.judge(t.decode("utf-8", "replace")) for t in binaries(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m[0] for m in made]), pa.array([m[1] for m in made], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def predict_languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``; remainder 2 of 4 is held out of learning."""
    training = docs.where(remainder(F.col("doc_id"), 4) != 2).select("lang", "text")
    table = materialize(profiles(training), "profiles")
    n = table.select("lang").distinct().count()
    if n > MAX_LANGUAGES:
        raise ValueError(f"{n} languages: more than {MAX_LANGUAGES} profiles do not fit a task")
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(table.collect()))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    judged = docs.select("doc_id", "text").mapInArrow(
        _judged(shared), f"doc_id {id_type}, lang_pred string, score double"
    )
    return judged.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
