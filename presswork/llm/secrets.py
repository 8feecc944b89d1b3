"""Secret scans: fixed rules, and a character convolutional network beside them.

The rules find assignments, access keys and long hexadecimal strings. The network
looks at every candidate, a run of eight or more of the rules' characters that holds
a digit or meets a finding, together with the characters around it, and learns from
the rules' findings: candidates that meet one are positive, all others negative. So
every finding has a candidate. Long ones are looked at piece by piece, the whole of them. It reads characters through an
embedding, convolves, takes the maximum over the window and ends in one logit.
A fifth of the windows, by their hash, is kept out of training: all candidates that
show one of these are scored, counts of their logits calibrate probabilities, and the
threshold is the highest that still recalls ``RECALL`` of the positive ones. Candidates at or above it that no rule covers become
findings of kind ``model``.

Training takes at most ``SAMPLE`` windows of either label, those with the least
hashes; calibration and threshold take every candidate held out, and every candidate
of every text is scored. Where a label is missing on either side, all are on both.

Defined cases: a null or empty text has no findings; places count code points, ends
are exclusive; rows are scanned one by one, a null doc_id like any other; without
candidates of both labels the network adds nothing; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presswork.llm.common import binaries, chunks
from presswork.session import materialize

# The rules' patterns and least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "model")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

CANDIDATE = r"[A-Za-z0-9+/_.=-]{8,}"
BEFORE, INSIDE, AFTER = 24, 40, 8
WINDOW = BEFORE + INSIDE + AFTER
ALPHABET = 98  # printable ASCII, line end, other, outside of the text
SAMPLE = 3000
# One window in so many is held out; logits are counted in steps of 1 / STEPS up to MAX_LOGIT.
HELD = 5
STEPS, MAX_LOGIT = 64, 64
RECALL = 0.99
EMBED, FILTERS, WIDTH = 12, 24, 5
EPOCHS = 4

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(ACCESS)
_hex = re.compile(HEX)
_candidate = re.compile(CANDIDATE)
_digit = re.compile(r"[0-9]")


def base_spans(text: str, lower: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` by the rules, by start and then kind."""
    spans = []
    if any(k in lower for k in KEYWORDS):
        spans += [(m.start(), m.end(), 0) for m in _assign.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if b"akia" in lower:
        spans += [(m.start(), m.end(), 1) for m in _access.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    spans += [(m.start(), m.end(), 2) for m in _hex.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """``(start, end, known)`` of runs with a digit, and of all that meet one of the sorted ``spans``."""
    found, reach, at = [], -1, 0
    for m in _candidate.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][1])
            at += 1
        known = reach > m.start()
        if known or _digit.search(m[0]):
            found.append((m.start(), m.end(), known))
    return found


def windows(text: str, start: int, end: int) -> list[bytes]:
    """The windows of a candidate: one for each ``INSIDE`` characters, the last one ends with it."""
    cuts = [*range(start, max(start, end - INSIDE), INSIDE), max(start, end - INSIDE)]
    return [window(text, start, end, cut) for cut in cuts]


def window(text: str, start: int, end: int, cut: int | None = None) -> bytes:
    """Character classes before a candidate, inside it from ``cut`` on, and after it."""
    cut = start if cut is None else cut
    inside = text[cut : min(end, cut + INSIDE)]
    before = text[max(0, start - BEFORE) : start]
    after = text[end : end + AFTER]
    pad = bytes([ALPHABET - 1])
    parts = [
        _classes(before).rjust(BEFORE, pad),
        _classes(inside).ljust(INSIDE, pad),
        _classes(after).ljust(AFTER, pad),
    ]
    return b"".join(parts)


def _classes(text: str) -> bytes:
    return bytes([ord(c) - 32 if " " <= c <= "~" else 95 if c == "\n" else 96 for c in text])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rule findings and candidates with their windows, per document."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])
    candidate = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("known", pa.bool_()), ("window", pa.binary())])
    for batch in chunks(batches):
        spans, found = [], []
        for data in binaries(batch, "text"):
            text = data.decode("utf-8", "replace")
            own = base_spans(text, data.lower())
            spans.append([{"start": s, "end": e, "kind": k} for s, e, k in own])
            found.append(
                [
                    {"start": s, "end": e, "known": known, "window": piece}
                    for s, e, known in candidates(text, own)
                    for piece in windows(text, s, e)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(candidate))],
            names=["doc_id", "spans", "candidates"],
        )


class CharNet:
    """Embedding, one convolution, maximum over places, one logit."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.3, (ALPHABET, EMBED)).astype(np.float32)
        self.kernel = rng.normal(0, 0.2, (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        # The maximum is taken apart before, inside and after the candidate's beginning.
        self.out = rng.normal(0, 0.2, 2 * FILTERS).astype(np.float32)
        self.out_bias = np.float32(0)
        self.scale, self.shift = 1.0, 0.0
        self.threshold = np.inf

    def _forward(self, chars: np.ndarray):
        e = self.embed[chars]
        n, length, _ = e.shape
        places = length - WIDTH + 1
        cols = np.concatenate([e[:, k : k + places] for k in range(WIDTH)], axis=2)
        act = np.maximum(cols @ self.kernel + self.bias, 0)
        halves = (act[:, : BEFORE - 2], act[:, BEFORE - 2 :])
        peaks = [h.argmax(axis=1) for h in halves]
        peaks[1] = peaks[1] + BEFORE - 2
        pooled = np.concatenate([np.take_along_axis(act, p[:, None, :], 1)[:, 0] for p in peaks], axis=1)
        return cols, peaks, pooled, pooled @ self.out + self.out_bias

    def logits(self, chars: np.ndarray) -> np.ndarray:
        parts = [self._forward(chars[i : i + 512])[3] for i in range(0, len(chars), 512)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def probabilities(self, chars: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.logits(chars).astype(float) + self.shift)))

    def fit(self, chars: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.05):
        rng = np.random.default_rng(5)
        names = ("embed", "kernel", "bias", "out", "out_bias")
        square = {n: np.zeros_like(getattr(self, n)) for n in names}
        weight = np.where(labels, 0.5 / max(1, labels.sum()), 0.5 / max(1, (~labels).sum())) * len(labels)
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                x, y = chars[rows], labels[rows].astype(np.float32)
                cols, peaks, pooled, logit = self._forward(x)
                d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight[rows] / len(rows)
                d = d.astype(np.float32)
                d_pool = d[:, None] * self.out * (pooled > 0)
                g = {"out": pooled.T @ d, "out_bias": d.sum(), "kernel": np.zeros_like(self.kernel)}
                g["bias"] = np.zeros_like(self.bias)
                g["embed"] = np.zeros_like(self.embed)
                every = np.arange(len(rows))[:, None]
                for side, peak in enumerate(peaks):
                    own = d_pool[:, side * FILTERS : (side + 1) * FILTERS]
                    g["bias"] += own.sum(0)
                    seen = cols[every, peak]  # row, filter, column of the patch
                    g["kernel"] += np.einsum("nf,nfc->cf", own, seen)
                    back = own[:, :, None] * self.kernel.T[None]
                    for k in range(WIDTH):
                        part = back[:, :, k * EMBED : (k + 1) * EMBED]
                        np.add.at(g["embed"], x[every, peak + k], part)
                for n in names:
                    square[n] = square[n] + g[n] ** 2
                    setattr(self, n, getattr(self, n) - np.float32(rate) * g[n] / (np.sqrt(square[n]) + np.float32(1e-6)))

    def calibrate(self, chars: np.ndarray, labels: np.ndarray, recall: float = RECALL) -> None:
        labels = np.asarray(labels, bool)
        self.calibrate_counts(self.logits(chars).astype(float), labels * 1.0, ~labels * 1.0, recall)

    def calibrate_counts(self, z: np.ndarray, positive: np.ndarray, negative: np.ndarray, recall: float = RECALL):
        """Platt scaling of logits with their counts, then the highest threshold that recalls enough."""
        total = positive + negative
        share, rate = total / total.sum(), positive / total
        a, b = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            error, spread = share * (p - rate), share * p * (1 - p)
            h = np.array([[(spread * z * z).sum(), (spread * z).sum()], [(spread * z).sum(), spread.sum()]])
            h += 1e-3 * np.eye(2)
            step = np.linalg.solve(h, [(error * z).sum() + 1e-3 * (a - 1), error.sum()])
            a, b = a - 0.5 * step[0], b - 0.5 * step[1]
        self.scale, self.shift = float(a), float(b)
        chances = 1 / (1 + np.exp(-(self.scale * z + self.shift)))
        order = np.argsort(chances, kind="stable")
        lost = np.cumsum(positive[order]) - positive[order]
        allowed = (lost <= (1 - recall) * positive.sum()) & (positive[order] > 0)
        self.threshold = float(chances[order][allowed][-1])


def _as_array(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW)


def _logit_steps(shared):
    """``(known, step)``: the logit of every row, in whole steps, rounded down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = shared.value.logits(_as_array(batch.column(1).to_pylist()))
                steps = np.floor(np.clip(z, -MAX_LOGIT, MAX_LOGIT) * STEPS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(steps)], names=["known", "step"])

    return run


def train(scanned: DataFrame, sample: int = SAMPLE) -> CharNet | None:
    """Fit on ``sample`` windows per label at most; all candidates that are held out calibrate."""
    each = scanned.select(F.explode("candidates").alias("c")).select("c.known", "c.window")
    each = each.withColumn("held", F.crc32("window") % HELD == 0)
    sides = {(r["known"], r["held"]) for r in each.select("known", "held").distinct().collect()}
    if len({known for known, _ in sides}) < 2:
        return None
    whole = len(sides) < 4
    fitted = (each if whole else each.where("not held")).select("known", "window").distinct()
    rows = []
    for known in (True, False):
        own = fitted.where(F.col("known") == known).orderBy(F.md5("window"), "window").limit(sample).collect()
        rows += [(bytes(r["window"]), known) for r in own]
    net = CharNet()
    net.fit(_as_array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    judged = (each if whole else each.where("held")).select("known", "window")
    scored = judged.mapInArrow(_logit_steps(scanned.sparkSession.sparkContext.broadcast(net)), "known boolean, step int")
    counts = scored.groupBy("step").agg(F.count_if("known").alias("yes"), F.count_if(~F.col("known")).alias("no"))
    z, yes, no = np.array(counts.orderBy("step").collect(), float).T
    net.calibrate_counts(z / STEPS, yes, no)
    return net


def _judged(shared):
    """Add the network's findings to the rules'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])
        for batch in batches:
            own = batch.column(2).to_pylist()
            new = [(i, c) for i, found in enumerate(own) for c in found if not c["known"]]
            added: list[list] = [[] for _ in own]
            if net is not None and new:
                p = net.probabilities(_as_array([c["window"] for _, c in new]))
                for (i, c), score in zip(new, p):
                    found = {"start": c["start"], "end": c["end"], "kind": 3}
                    if score >= net.threshold and found not in added[i][-1:]:
                        added[i].append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(added, pa.list_(span))],
                names=["doc_id", "spans", "added"],
            )

    return run


SPANS = "array<struct<start: int, end: int, kind: int>>"
CANDIDATES = "array<struct<start: int, end: int, known: boolean, window: binary>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans, added)``: findings of the rules and of the network, as structs."""
    slim = docs.select("doc_id", "text")
    id_type = slim.schema["doc_id"].dataType.simpleString()
    scanned = slim.mapInArrow(_scanned, f"doc_id {id_type}, spans {SPANS}, candidates {CANDIDATES}")
    scanned = materialize(scanned, "scanned")
    net = train(scanned)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return scanned.mapInArrow(_judged(shared), f"doc_id {id_type}, spans {SPANS}, added {SPANS}")
