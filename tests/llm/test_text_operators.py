"""Quality rules, line dedup, BPE and source mixing against brute force on small tables."""

from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from presswork.llm import bpe, line_dedup, mixing, quality
from presswork.llm.queries import VOCABULARY

DOCS = "doc_id long, text string, lang string, source string"
LONG = "alpha beta gamma delta " * 3000
TEXTS = [
    None,
    "",
    " \t\n ",
    "one two three",
    "The same line here\nunique to the first one\nThe same line here",
    "  the SAME line here\t\nanother one of its own",
    "short\nshort\nshort",
    LONG,
    LONG,
    "a b c a b c a b d " * 12,
    "Ünïcode wörter ÀÉ \x85 und\x0bmehr",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None) for i, t in enumerate(TEXTS)]
    rows += [(None, "The same line here", None, None), (4, TEXTS[4], "en", "s1")]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return (text or "").encode().split()


def repeated(tokens):
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    counts = Counter(windows)
    hit = set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            hit |= {i, i + 1, i + 2}
    return len(hit)


def test_quality_statistics(spark, docs):
    nobody = spark.createDataFrame([], "doc_id long")
    rows = quality.with_quality(docs.withColumn("quality", F.lit("clash")), nobody).collect()
    assert len(rows) == docs.count()
    for row in rows:
        text, got = row["text"] or "", row["quality"]
        tokens = words(text)
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert got["n_words"] == len(tokens)
        assert got["word_chars"] == sum(len(w.decode()) for w in tokens)
        assert got["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert got["n_dup_lines"] == len(lines) - len(set(lines))
        assert got["n_repeat_words"] == repeated(tokens)
        failed = len(tokens) < 50 or 100 * repeated(tokens) > 50 * len(tokens)
        assert got["base_failed"] == failed
        assert got["log_ratio"] == 0 and got["kept"] == (not failed)


def test_repeated_windows_by_either_way(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 2, 3, 40, 900)]
    texts.append(" ".join(str(rng.randrange(60)) for _ in range(6000)))  # very many repeated windows
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = quality.with_base(frame).select("text", "__q_repeats").collect()
    assert all(r["__q_repeats"] == repeated(words(r["text"])) for r in got)


def test_quality_ratio(spark):
    good = [(i, " ".join(f"good{(i + k) % 9}" for k in range(60))) for i in range(6)]
    bad = [(10 + i, " ".join(f"bad{(i + k) % 7}***" for k in range(60))) for i in range(4)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(3)] + [(10, 0, 0), (11, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    trusted = quality.trusted_documents(labels)
    assert {r["doc_id"] for r in trusted.collect()} == {0, 1, 2}
    got = {r["doc_id"]: r for r in quality.with_quality(frame, trusted).select("doc_id", "quality.*").collect()}
    raw, target = Counter(), Counter()

    def features(text):
        """Buckets of words and of pairs of neighbours, as hashes of their hashes."""
        each = [xxhash.xxh64_intdigest(w, 42) for w in words(text)]
        chain = lambda h, seed: xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
        pairs = [chain(b, chain(a, 42)) for a, b in zip(each, each[1:])]
        return [h & (quality.BUCKETS - 1) for h in each + pairs]

    for i, text in good + bad:
        raw.update(features(text))
        if i in (0, 1, 2):
            target.update(features(text))
    share, more = target.total() / raw.total(), quality.SMOOTHING
    weight = lambda b: np.log((target[b] + more) / (max(raw[b] - 1, 0) * share + more))
    for i, text in good + bad:
        assert got[i]["log_ratio"] == pytest.approx(np.mean([weight(b) for b in features(text)]), abs=1e-4)


def test_quality_verdict_on_held_out_texts(spark):
    rng = random.Random(5)
    text = lambda stem: " ".join(f"{stem}{rng.randrange(300)}" for _ in range(120))
    rows = [(i, text("clean")) for i in range(80)] + [(100 + i, text("junk")) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    judged = quality.good_documents(
        spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    )
    trusted = judged.where("doc_id < 20")
    got = {r["doc_id"]: r for r in quality.with_quality(frame, trusted, judged=judged).select("doc_id", "quality.*").collect()}
    assert sum(got[i]["kept"] for i in range(40)) >= quality.RECALL * 40
    assert sum(got[i]["kept"] for i in range(40, 80)) >= 36
    assert not any(got[100 + i]["kept"] for i in range(40))
    # A trusted text has no gain from its own counts: it is judged like any other clean text.
    held = lambda ids: np.mean([got[i]["held_out_ratio"] for i in ids])
    assert abs(held(range(20)) - held(range(20, 80))) < 0.05 < np.mean([got[i]["log_ratio"] for i in range(20)]) - held(range(20))


def test_quality_buckets_follow_the_trusted_volume(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "a b c d " * 1000) for i in range(8)], "doc_id long, text string")
    trusted = frame.select("doc_id").where("doc_id < 4")
    monkeypatch.setattr(quality, "LOAD", 1)
    monkeypatch.setattr(quality, "BUCKETS", 16)
    assert quality.bucket_count(frame, trusted) == 32768
    assert quality.bucket_count(frame, trusted.limit(0)) == 16


def brute_lines(rows):
    holders = {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
            if len(key) >= 10 and r["doc_id"] is not None:
                holders.setdefault(key, set()).add(r["doc_id"])
    out = []
    for r in rows:
        lines, kept = (r["text"] or "").split("\n"), []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
            own = holders.get(key, set())
            if r["doc_id"] is None or len(own) < 2 or min(own) == r["doc_id"]:
                kept.append(line)
        out.append((r["doc_id"], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup(spark, docs):
    frame = docs.withColumn("n_dropped", F.lit("clash")).withColumn("keys", F.lit(1))
    got = line_dedup.drop_repeated_lines(frame)
    rows = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()]
    assert sorted(rows, key=repr) == brute_lines(docs.collect())
    assert "keys" in got.columns
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_lines_that_share_a_hash_are_told_apart(spark, docs):
    weak = lambda keys: np.array([len(k) % 3 for k in keys], np.uint64)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(20 + i, f"own line number {i}\nanother one of its own\nown line number {i % 3}") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for hashed in (weak, line_dedup._hashes):
        got = line_dedup.drop_repeated_lines(frame, hashed).collect()
        assert sorted(map(tuple, ((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got)), key=repr) == (
            brute_lines(frame.collect())
        )


def test_line_dedup_of_string_ids_and_clashing_names(spark):
    rows = [(f"d{i}", "one line of ten and more\nown words of %d, too" % i, "x", "y") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id string, text string, __gone string, __id string")
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(frame).collect()}
    assert [got[f"d{i}"]["n_dropped"] for i in range(9)] == [0] + [1] * 8
    assert all(r["__gone"] == "x" and r["__id"] == "y" for r in got.values())


def test_a_line_that_is_everywhere(spark, monkeypatch):
    rows = [(i, f"a line that everybody has\nline of its own, the {i}th") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    for buffered in (1, 1 << 20):
        monkeypatch.setattr(line_dedup, "BUFFERED", buffered)
        got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.drop_repeated_lines(frame).collect()}
        assert got == {i: int(i > 0) for i in range(400)}


def test_filters_stay_as_empty_at_any_volume():
    for volume in (0, 10**6, 3 * 10**10, 10**12, 10**14):
        n, size = line_dedup.layout(volume)
        assert n * size >= volume / 8 and line_dedup.SEGMENT_BITS <= size <= line_dedup.LARGEST_SEGMENT


def test_suspects_are_few_in_a_filter_loaded_as_at_any_volume():
    rng = np.random.default_rng(7)
    for size in (line_dedup.SEGMENT_BITS, line_dedup.LARGEST_SEGMENT):
        own = line_dedup.TwoFilters(size)
        hashes = np.unique(rng.integers(0, 1 << 63, size // 12).astype(np.uint64) * np.uint64(2))
        for part in np.array_split(hashes, 7):
            own.add(part)
        assert own.suspects(hashes).mean() < 0.1


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(1)
    own = line_dedup.TwoFilters(line_dedup.SEGMENT_BITS)
    first, second = (np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64)) for _ in range(2))
    own.add(first)
    own.add(np.concatenate([second, first[:50]]))
    for place in line_dedup._places(first[:50], line_dedup.SEGMENT_BITS):
        assert own.twice[place].all()


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    import tiktoken

    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.merges.ranks, special_tokens={}
    )


def test_bpe_equals_the_library(codec, reference):
    rng = random.Random(2)
    letters = "abc  thé \n\t\r\x85\xa0\x1c​日本語1234'sll  ..!!ﬃ😀é"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["x" * 5000, " " * 3000, "ab" * 2000 + " end ", "don't  we'll\n\n  go <|endoftext|>"]
    for text in texts:
        ids = codec.encode(text).tolist()
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_prefixes_appends_and_edits(codec):
    rng = random.Random(4)
    for _ in range(150):
        data = bytes(rng.choice(b"abcdethe ing") for _ in range(rng.randint(0, 80)))
        new = bytes(rng.choice(b"abcdethe ing") for _ in range(rng.randint(0, 8)))
        start = rng.randint(0, len(data))
        stop = rng.randint(start, min(len(data), start + 5))
        edited = bpe.PrefixTable(codec.merges, data)
        edited.replace(start, stop, new)
        fresh = bpe.PrefixTable(codec.merges, data[:start])
        fresh.append(new + data[stop:])
        whole = data[:start] + new + data[stop:]
        assert edited.last == fresh.last == bpe.PrefixTable(codec.merges, whole).last
        if whole not in codec.merges.ranks:
            assert edited.tokens() == bpe.encode_piece(codec.merges, whole)
        assert codec.decode(edited.tokens(len(whole) // 2)) == whole[: len(whole) // 2]


def test_an_edit_renews_only_what_it_must(codec):
    table = bpe.PrefixTable(codec.merges, b"the quick brown fox and " * 40)
    assert table.replace(4, 5, b"Q") < len(table.data) / 2


def test_bpe_documents(spark, docs, reference):
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    coded = bpe.encode_documents(docs.withColumn("ids", F.lit("clash")), path, pattern)
    back = bpe.decode_documents(coded, path, pattern)
    for r in back.collect():
        assert list(r["ids"]) == reference.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    for r in bpe.round_trip_digests(docs, path, pattern).collect():
        ids = reference.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.round_trip_digests(docs.limit(0), path, pattern).count() == 0


def shares(sizes):
    """Targets by sharing again and again, as the contract words it."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_mix(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        source = rng.choice(["big"] * 20 + ["tiny", "ü", None, "b"])
        rows.append((i, " ".join("wordy"[: rng.randint(1, 5)] for _ in range(rng.randint(0, 120))), "en", source))
    rows += [(None, "no id", "en", "b"), (7, None, "en", "b"), (8, "x y", None, "tiny"), (8, "x y", None, "tiny")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("mix", F.lit(0)).withColumn("target", F.lit("clash"))
    got = mixing.mix(docs).drop("target").select("doc_id", "text", "source", "mix.*").collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    expected = shares(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source]
    again = mixing.mix(docs.repartition(5)).select("doc_id", "text", "mix.taken").collect()
    assert Counter(map(tuple, again)) == Counter((r["doc_id"], r["text"], r["taken"]) for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    rows = [(i, "w " * (1 + i % 13), "en", "ab"[i % 2]) for i in range(500)]
    docs = spark.createDataFrame(rows, DOCS)
    many = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).select("doc_id", "mix.taken").collect()}
    monkeypatch.undo()
    one = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).select("doc_id", "mix.taken").collect()}
    assert many == one
