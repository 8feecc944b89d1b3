"""LM scoring with a log-bilinear model trained by noise-contrastive estimation.

The model predicts a *unit* from the two units before it: frequent words are units
of their own, all other words share a unit with words of the same ending, inside
which they are told apart by their smoothed counts. A unit's score in a context is
bilinear, ``(C1 r1 + C2 r2) . q + b``, so it is a sum of two tables over unit pairs,
and the normaliser of every context is one entry of a single matrix product of
their exponentials. Token probabilities are therefore exactly normalised and cost
a few look-ups each.

Training passes over every training document once. In each round tasks start from
the same parameters, run NCE on their own tokens in numpy, and the parameters are
averaged by tokens; a round sees its own share of the documents.

Words are counted over all training documents. Words that make up at least one in
``HEAD`` of the tokens go to every task (so at most ``HEAD`` words); the counts of
the rest are joined to the documents that use them.

Defined cases: a null or empty text is the end token alone; a null doc_id hashes
like an empty one; rows are scored one by one, repeated ones alike; without a
training document every word is unknown; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from presswork.llm.common import binaries, chunks
from presswork.session import materialize

END = b"\n"  # no word holds white space
HEAD = 1 << 20
UNITS = 2048
ENDINGS = 256
DIMS = 24
NOISE = 64
BATCH = 4096
ROUNDS = 2
RATE = 0.08
BUFFERED_WORDS = 400_000
LIMIT = np.float32(20.0)


def remainder(doc_id: Column, n: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of one task, summed up before they are sent."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "c"],
        )

    counts: Counter = Counter()
    for batch in chunks(batches):
        for text in binaries(batch, "text"):
            counts.update(text.lower().split())
        counts[END] += batch.num_rows
        if len(counts) >= BUFFERED_WORDS:
            yield rows(counts)
            counts = Counter()
    if counts:
        yield rows(counts)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over whole texts, the end token included."""
    rows = docs.select("text").mapInArrow(_counted, "word binary, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


@dataclass
class Lexicon:
    """What every task knows of the words: bounded by ``HEAD`` words."""

    words: list[bytes]  # by falling count
    counts: np.ndarray
    n: int  # training tokens
    v: int  # distinct ones
    ending_tokens: np.ndarray  # of the words that are no unit of their own
    ending_words: np.ndarray

    def __post_init__(self):
        own = min(len(self.words), UNITS - ENDINGS)
        self.own = own
        self.n_units = own + ENDINGS
        ends = np.array([ending(w) for w in self.words[own:]], np.int64)
        self.unit_of = np.concatenate([np.arange(own), own + ends]).astype(np.int32)
        self.unit_counts = np.concatenate([self.counts[:own], self.ending_tokens]).astype(float)
        self.log_n = np.log10(self.n + 0.5 * (self.v + 1))
        self.log_ending = np.log10(self.ending_tokens + 0.5 * (self.ending_words + 1))
        logs = np.log10(self.counts + 0.5)
        self.base = logs - self.log_n
        inside = logs[own:] - self.log_ending[ends]
        self.inside = np.concatenate([np.zeros(own), inside])
        self.end = self.words.index(END) if END in self.words else -1 - ending(END)

    def index(self) -> dict:
        return _Places((w, i) for i, w in enumerate(self.words))

    def units(self, places: np.ndarray) -> np.ndarray:
        known = self.unit_of[np.maximum(places, 0)] if len(self.unit_of) else np.zeros(len(places), np.int32)
        return np.where(places >= 0, known, self.own - 1 - places).astype(np.int32)


class _Places(dict):
    """Word to place in the lexicon; other words to ``-1 - ending``."""

    def __missing__(self, word: bytes) -> int:
        return -1 - ending(word)


def lexicon(counts: DataFrame, head: int = HEAD) -> Lexicon:
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"]), int(total["v"])
    rows = counts.where(F.col("c") * head >= n).collect()
    rows.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    words = [bytes(r["word"]) for r in rows]
    sizes = np.array([r["c"] for r in rows], np.int64)
    by_ending = counts.groupBy((F.crc32(F.substring("word", -3, 3)) % ENDINGS).alias("e")).agg(
        F.sum("c").alias("n"), F.count("*").alias("v")
    )
    tokens, distinct = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for r in by_ending.collect():
        tokens[r["e"]], distinct[r["e"]] = r["n"], r["v"]
    for word, c in list(zip(words, sizes))[: UNITS - ENDINGS]:
        tokens[ending(word)] -= c
        distinct[ending(word)] -= 1
    return Lexicon(words, sizes, n, v, tokens, distinct)


class LogBilinear:
    """Parameters and their numpy training."""

    def __init__(self, counts: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        k = len(counts)
        share = (counts + 0.5) / (counts + 0.5).sum()
        self.noise = share.astype(np.float64)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.params = {
            "r": small(k, DIMS),
            "q": small(k, DIMS),
            "c1": np.eye(DIMS, dtype=np.float32),
            "c2": np.eye(DIMS, dtype=np.float32),
            "b": np.log(share).astype(np.float32),
        }

    def train(self, contexts: np.ndarray, targets: np.ndarray, state: dict, rng) -> None:
        """NCE steps over the examples; the noise words of a batch are shared by its examples."""
        p = self.params
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        edges = np.cumsum(self.noise)
        for at in range(0, len(targets), BATCH):
            u1, u2 = contexts[0][at : at + BATCH], contexts[1][at : at + BATCH]
            w = targets[at : at + BATCH]
            drawn = np.searchsorted(edges, rng.random(NOISE) * edges[-1])
            drawn = np.minimum(drawn, len(edges) - 1)
            r1, r2, q, qn = p["r"][u1], p["r"][u2], p["q"][w], p["q"][drawn]
            hat = r1 @ p["c1"].T + r2 @ p["c2"].T
            data = np.einsum("ij,ij->i", hat, q) + p["b"][w] - log_noise[w]
            other = hat @ qn.T + (p["b"][drawn] - log_noise[drawn])
            up = 1 / (1 + np.exp(np.clip(data, -LIMIT, LIMIT)))
            down = -1 / (1 + np.exp(np.clip(-other, -LIMIT, LIMIT)))
            scale = np.float32(1.0 / len(w))
            up, down = up * scale, down * scale
            d_hat = up[:, None] * q + down @ qn
            grads = {
                "c1": d_hat.T @ r1,
                "c2": d_hat.T @ r2,
                "q": _rows(p["q"], [(w, up[:, None] * hat), (drawn, down.T @ hat)]),
                "r": _rows(p["r"], [(u1, d_hat @ p["c1"]), (u2, d_hat @ p["c2"])]),
                "b": np.bincount(w, up, len(p["b"])) + np.bincount(drawn, down.sum(0), len(p["b"])),
            }
            for name, grad in grads.items():
                grad = grad.astype(np.float32)
                state[name] = state.get(name, 0) + grad * grad
                p[name] = p[name] + np.float32(RATE) * grad / (np.sqrt(state[name]) + np.float32(1e-6))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores by previous unit, by the one before, biases, and log normalisers of all contexts."""
        p = self.params
        one = np.clip(p["r"] @ p["c1"].T @ p["q"].T, -LIMIT, LIMIT)
        two = np.clip(p["r"] @ p["c2"].T @ p["q"].T, -LIMIT, LIMIT)
        norm = np.log((np.exp(two) * np.exp(p["b"])) @ np.exp(one).T)
        return one, two, p["b"], norm


def _rows(like: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of rows by their place."""
    out = np.zeros_like(like)
    for places, values in parts:
        order = np.argsort(places.astype(np.uint16), kind="stable")
        sorted_places = places[order]
        starts = np.flatnonzero(np.diff(sorted_places, prepend=-1))
        out[sorted_places[starts]] += np.add.reduceat(values[order], starts, axis=0)
    return out


def _tokens(batch: pa.RecordBatch, index: dict, end: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Places of all tokens of a run of rows, rows' lengths, and the words of each row."""
    rows = [text.lower().split() for text in binaries(batch, "text")]
    places: list[int] = []
    for words in rows:
        places += map(index.__getitem__, words)
        places.append(end)
    return np.array(places, np.int64), np.array([len(x) + 1 for x in rows]), rows


def _contexts(units: np.ndarray, lengths: np.ndarray, end_unit: int) -> tuple[np.ndarray, np.ndarray]:
    """The two units before each token; before a text stand end tokens."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    one = np.roll(units, 1)
    one[starts] = end_unit
    two = np.roll(one, 1)
    two[starts] = end_unit
    return one, two


def _trained(shared, round_no: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, params = shared.value
        model = LogBilinear(lex.unit_counts)
        model.params = dict(params)
        index, state, seen = lex.index(), {}, 0
        rng = np.random.default_rng([round_no, TaskContext.get().partitionId()])
        end_unit = int(lex.units(np.array([lex.end]))[0])
        for batch in chunks(batches, size=1 << 20):
            places, lengths, _ = _tokens(batch, index, lex.end)
            units = lex.units(places)
            order = rng.permutation(len(units))
            one, two = _contexts(units, lengths, end_unit)
            model.train((one[order], two[order]), units[order], state, rng)
            seen += len(units)
        if seen:
            names = sorted(model.params)
            values = [(model.params[n].astype(np.float64) * seen).tobytes() for n in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([seen] * len(names), pa.int64()), pa.array(values, pa.binary())],
                names=["name", "seen", "sums"],
            )

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the parameters of tasks one by one."""
    sums: dict[str, np.ndarray] = {}
    seen: Counter = Counter()
    for batch in batches:
        for name, n, data in zip(*(c.to_pylist() for c in batch.columns)):
            own = np.frombuffer(data, np.float64)
            sums[name] = sums[name] + own if name in sums else own
            seen[name] += n
    for name, own in sums.items():
        mean = (own / seen[name]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([mean.tobytes()], pa.binary())], names=["name", "mean"]
        )


def train(docs: DataFrame, lex: Lexicon, rounds: int = ROUNDS) -> LogBilinear:
    """``docs`` are the training documents; each is read in one of the rounds."""
    model = LogBilinear(lex.unit_counts)
    context = docs.sparkSession.sparkContext
    for k in range(rounds):
        share = docs.where(F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) / 5) % rounds == k)
        shared = context.broadcast((lex, model.params))
        rows = share.select("text").mapInArrow(_trained(shared, k), "name string, seen long, sums binary")
        means = rows.repartition(len(model.params), "name").mapInArrow(_averaged, "name string, mean binary")
        for row in means.collect():
            shape = model.params[row["name"]].shape
            model.params[row["name"]] = np.frombuffer(row["mean"], np.float32).reshape(shape)
        shared.unpersist()
    return model


_TABLES: dict = {}


def _scored(shared, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _TABLES:
            _TABLES.clear()
            lex, params = shared.value
            model = LogBilinear(lex.unit_counts)
            model.params = params
            _TABLES[key] = lex, lex.index(), model.tables()
        lex, index, (one, two, bias, norm) = _TABLES[key]
        end_unit = int(lex.units(np.array([lex.end]))[0])
        row_id = TaskContext.get().partitionId() << 36
        for batch in chunks(batches, size=1 << 20):
            places, lengths, rows = _tokens(batch, index, lex.end)
            units = lex.units(places)
            u1, u2 = _contexts(units, lengths, end_unit)
            logs = (one[u1, units].astype(np.float64) + two[u2, units] + bias[units] - norm[u2, u1]) / np.log(10)
            known = places >= 0
            place = np.maximum(places, 0)
            ends = np.where(known, 0, -1 - places)
            if len(lex.words):
                base = np.where(known, lex.base[place], -lex.log_n)
                inside = np.where(known, lex.inside[place], -lex.log_ending[ends])
            else:
                base, inside = np.full(len(places), -lex.log_n), -lex.log_ending[ends]
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            tails = []
            for start, words in zip(starts, rows):
                rare = np.flatnonzero(~known[start : start + len(words)])
                own = Counter([words[i] for i in rare])
                if lex.end < 0:
                    own[END] += 1
                tails.append(own)
            flat = [w for own in tails for w in own]
            times = [n for own in tails for n in own.values()]
            offsets = np.concatenate([[0], np.cumsum([len(own) for own in tails])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row_id, row_id + batch.num_rows), pa.int64()),
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat(known.astype(np.int64), starts), pa.int64()),
                    pa.array(np.add.reduceat(base, starts), pa.float64()),
                    pa.array(np.add.reduceat(logs + inside, starts), pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.binary())),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(times, pa.int32())),
                ],
                names=["row", "doc_id", "n_tokens", "n_head", "base", "logs", "tail", "times"],
            )
            row_id += batch.num_rows

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of every document; those with remainder 1 of 5 are held out of training.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    slim = docs.select("doc_id", "text")
    training = slim.where(remainder(F.col("doc_id"), 5) != 1)
    counts = materialize(word_counts(training), "lm-counts")
    lex = lexicon(counts)
    model = train(training, lex)
    shared = spark.sparkContext.broadcast((lex, model.params))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row long, doc_id {id_type}, n_tokens long, n_head long, base double, logs double, "
        "tail array<binary>, times array<int>"
    )
    key = f"{spark.sparkContext.applicationId}-{id(shared)}"
    scored = materialize(slim.mapInArrow(_scored(shared, key), schema), "lm-scored")
    tail = scored.select("row", F.inline(F.arrays_zip("tail", "times")).alias("word", "times"))
    rare = counts.where(F.col("c") * HEAD < lex.n)
    met = tail.join(rare, "word", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("t_logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("t_known"),
    )
    more = F.coalesce("t_logs", F.lit(0.0))
    return (
        scored.drop("tail", "times")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            (remainder(F.col("doc_id"), 5) == 1).alias("held_out"),
            "n_tokens",
            (F.col("n_head") + F.coalesce("t_known", F.lit(0))).cast("long").alias("n_known"),
            F.lit(lex.n).cast("long").alias("train_tokens"),
            (F.col("base") + more).alias("base_score"),
            (F.col("logs") + more).alias("score"),
        )
    )
