"""The rules of the secret scan against a matcher that is written out letter by letter."""

from __future__ import annotations

import random
from hashlib import sha256

from presswork.llm.queries import op7_secret_scan

KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LOWER = "abcdefghijklmnopqrstuvwxyz"
VALUE = set(LOWER + LOWER.upper() + "0123456789+/_.=-")
FOLD = dict(zip(LOWER.upper(), LOWER))


def run_of(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def assignment(text, at):
    """(end, value length) of an assignment that begins at ``at``."""
    for key in KEYS:
        if "".join(FOLD.get(c, c) for c in text[at : at + len(key)]) != key:
            continue
        end = at + len(key)
        end += text[end : end + 1] in ("'", '"')
        end = run_of(text, end, " ")
        if text[end : end + 1] not in (":", "="):
            continue
        end = run_of(text, end + 1, " ")
        end += text[end : end + 1] in ("'", '"')
        stop = run_of(text, end, VALUE)
        if stop > end:
            return stop, stop - end
    return None


def expected(text):
    spans, at = [], 0
    while at < len(text):
        found = assignment(text, at)
        if found and found[1] >= 8:
            spans.append((at, "assign", found[0]))
        at = found[0] if found else at + 1
    at = 0
    while at < len(text):
        if text.startswith("AKIA", at):
            end = run_of(text, at + 4, set(LOWER.upper() + "0123456789"))
            if end > at + 4:
                if end - at >= 16:
                    spans.append((at, "access", end))
                at = end
                continue
        at += 1
    at = 0
    while at < len(text):
        end = run_of(text, at, set("0123456789abcdef"))
        if end - at >= 32:
            spans.append((at, "hex", end))
        at = max(end, at + 1)
    order = ("assign", "access", "hex")
    spans.sort(key=lambda s: (s[0], order.index(s[1])))
    return spans


def texts():
    rnd = random.Random(11)
    parts = [
        "password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "apikey", "=", ":", " = ", ' : "', "'", '"', " ", "  ", "\t", "\n",
        "abcdefgh", "abc.def/ghi", "hunter2", "x", "AKIA", "AKIAABCDEFGH1234", "akia", "IOSFODNN7EXAMPLE", "deadbeef" * 4, "deadbeef" * 3,
        "0123456789abcdef", "é", "ſecret", "日本", "word", "-", "==",
    ]
    return ["".join(rnd.choices(parts, k=rnd.randrange(1, 25))) for _ in range(1500)]


def test_rules_equal_the_matcher(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, "", *texts()])] + [(None, "token=abcdefgh12"), (3, "token=abcdefgh12")] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op7_secret_scan(spark, str(tmp_path)).drop("spans").collect()), key=repr)
    want = []
    for doc_id, text in rows:
        spans = expected(text or "")
        kinds = [k for _, k, _ in spans]
        listed = ",".join(f"{k}:{s}:{e}" for s, k, e in spans)
        want.append((doc_id, *[kinds.count(k) for k in ("assign", "access", "hex")], sha256(listed.encode()).hexdigest()))
    assert sum(w[1] for w in want) > 100 and sum(w[2] for w in want) > 100 and sum(w[3] for w in want) > 100
    assert got == sorted(want, key=repr)
