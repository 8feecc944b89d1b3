"""Conversation repair, Merkle manifest and token counts against brute force on small tables."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from presswork.llm import conversations, merkle, token_count
from presswork.llm.queries import COUNTED_VOCABULARY

TURNS = "conv_id long, turn long, role string, text string, extra int, fate string, copies string"


def conversation_rows(seed=5):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "cut short", "", " \t", None, "same. ", "Where to go?", "a\x0b", "ends:x.y", "end.\n"]
    roles = ["user", "assistant", "system", "tool", None, "", "student"]
    weights = [8, 8, 3, 1, 1, 1, 1]
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rnd.randrange(0, 12)):
            if rnd.random() < 0.1:
                turn = None
            text = rnd.choice(texts) if rnd.random() < 0.5 else f"words {rnd.random()}" + rnd.choice([".", "?", ""])
            rows.append((conv, turn, rnd.choices(roles, weights)[0], text))
    # One conversation over many blocks, with one row repeated very often and in many turns.
    for turn in range(700):
        role = ("user", "assistant")[turn % 2] if rnd.random() < 0.8 else rnd.choice(roles)
        rows.append((99, turn * 2, role, "Fine." if turn % 3 == 0 else f"turn {turn}."))
    rows += [(99, 500, "user", "Fine.")] * 150
    rows.append((77, 1, "user", "long words " * 60_000 + "."))
    rnd.shuffle(rows)
    return rows


def shown(value):
    return " " if value is None else str(value)


def after_damage(rows):
    kept = {}
    for conv, turn, role, text in rows:
        own = kept.setdefault(conv, [])
        role, text = shown(role), shown(text)
        fate = crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if fate == 3 else 1)

    def order(row):
        turn, role, text = row
        hashed = xxhash.xxh64(text.encode(), seed=42).intdigest()
        signed = hashed - (1 << 64) if hashed >= 1 << 63 else hashed
        return (turn is not None, turn or 0, role, signed, text)

    return {conv: sorted(own, key=order) for conv, own in kept.items()}


def cheapest(rows, faults):
    """Least (cost, edits) by whole strings, state by state."""
    flip = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        ways, level = [], [(s, *v) for s, v in best.items()]
        for _ in range(3):
            ways += level
            level = [(flip[s], c + 3, e + "I", (*o, f"{name[flip[s]]}:")) for s, c, e, o in level]
        following = {}

        def offer(state, way):
            if state not in following or way < following[state]:
                following[state] = way

        for s, c, e, o in ways:
            offer(s, (c + 4, e + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            offer(flip[s], (c + 3 + extra, e + "R", (*o, f"{name[flip[s]]}:{text}")))
            if role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[s] and role:
                offer(role[:1], (c + extra, e + "K", (*o, f"{role}:{text}")))
        best = following
    tails = {"": "", "s": "II", "u": "I", "a": ""}
    lines = {"": (), "s": ("user:", "assistant:"), "u": ("assistant:",), "a": ()}
    return min((c + 3 * len(tails[s]), e + tails[s], (*o, *lines[s])) for s, (c, e, o) in best.items())


def expected_repair(rows):
    blank = " \t\n\x0b\x0c\r"
    for conv, own in after_damage(rows).items():
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(blank)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else ""
            faults.append(fault or ("" if bare[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = cheapest(own, faults)
        yield conv, (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            "\n".join(lines),
        )


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(*r, 1, "clash", "clash") for r in conversation_rows()]
    return spark.createDataFrame(rows, TURNS).repartition(6)


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_conversation_repair(turns, block_rows):
    found = {r["conv_id"]: r for r in conversations.repair(conversations.damage(turns), block_rows).collect()}
    expected = dict(expected_repair(conversation_rows()))
    assert found.keys() == expected.keys()
    for conv, (*counts, audit, text) in expected.items():
        row = found[conv]
        assert [row[c] for c in conversations.COUNTS] == counts, conv
        assert row["audit"] == audit and row["repaired_sha256"] == sha256(text.encode()).hexdigest(), conv


def test_repaired_texts(turns):
    rows = conversations.repaired_texts(conversations.damage(turns), 50).orderBy("part", "seq").collect()
    for conv, (*_, text) in expected_repair(conversation_rows()):
        parts = [r["repaired"] for r in rows if r["conv_id"] == conv]
        assert "\n".join(p for p in parts if p) == text


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversations.repair(conversations.damage(empty)).collect() == []
    # crc32("0:27") and its like: a conversation that loses all its rows stays in the result.
    lost = [(c, t, "user", "Hi.") for c in range(3) for t in range(200) if crc32(f"{c}:{t}".encode()) % 20 == 0]
    rows = conversations.repair(conversations.damage(spark.createDataFrame(lost, "conv_id long, turn long, role string, text string")))
    for row in rows.collect():
        assert list(row)[1:] == [0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest()]


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def expected_leaf(row):
    return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_over(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path_of(levels, i):
    for nodes in levels[:-1]:
        start = i - i % 3
        yield nodes[start:i], nodes[i + 1 : start + 3]
        i //= 3


def expected_proofs(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, expected_leaf(row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subtrees = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
        subtrees[name] = levels_over([x[2] for x in trees[name]])
    top = levels_over([subtrees[n][-1][0] for n in names])
    for k, name in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(trees[name]):
            path = [*path_of(subtrees[name], i), *path_of(top, k)]
            doc_id, source, lang, n_chars, text = row
            shown = leaf
            if crc32(("" if doc_id is None else str(doc_id)).encode()) % 2 == 0 and text is not None:
                shown = expected_leaf((doc_id, source, lang, n_chars, text.replace("\n", "")))
            for left, right in path:
                shown = h([*left, shown, *right])
            proof = "".join("".join(a + b) for a, b in path)
            yield doc_id, leaf, subtrees[name][-1][0], top[-1][0], proof, shown


def manifest_rows(rows, spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string, digest int, tree string, chunk int"
    docs = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], schema).repartition(5)
    manifest = merkle.build_manifest(merkle.tampered_leaves(docs), payload=["tampered"])
    return manifest, merkle.proofs(manifest, "tampered").collect()


@pytest.mark.parametrize("many", [0, 2300])
def test_merkle_manifest(spark, many):
    texts = [None, "", "one\ntwo", "three", "long " * 200_000, "né\n"]
    rows = [(i if i % 7 else None, f"s{i % 3}" if i % 5 else None, "en", i, texts[i % 6]) for i in range(40)]
    rows += [rows[3]] * 5 + [(5, "S", None, None, "x\ny"), (6, "é", None, None, "")]
    rows += [(i, "hot", "de", None, f"text\n{i}") for i in range(many)]
    rows += [(i, f"site{i}", "de", None, "t") for i in range(many // 3)]
    manifest, found = manifest_rows(rows, spark)
    expected = sorted(expected_proofs(rows), key=repr)
    assert sorted(map(tuple, found), key=repr) == expected
    assert manifest.root() == expected[0][3]
    assert sum(r["folded_root"] != r["root"] for r in found) > 0


def test_merkle_of_nothing_and_of_one(spark):
    manifest, found = manifest_rows([], spark)
    assert found == [] and manifest.root() is None
    row = (1, "a", "en", 3, "abc")
    _, found = manifest_rows([row], spark)
    leaf = expected_leaf(row)
    assert [tuple(r) for r in found] == [(1, leaf, leaf, leaf, "", leaf)]


@pytest.mark.parametrize("leaves", [*range(1, 60), 242, 243, 244, 728, 729])
def test_log_positions(leaves):
    nodes = [sha256(str(i).encode()).digest() for i in range(leaves)]
    for levels in (merkle.height(leaves), merkle.LEVELS):
        log = merkle.build_log(nodes, levels)
        level_nodes = nodes
        for level in range(levels + 1):
            for j, node in enumerate(level_nodes):
                assert log[merkle.position(leaves, levels, level, j)] == node
            level_nodes = [merkle.node_digest(level_nodes[i : i + 3]) for i in range(0, len(level_nodes), 3)]


ODD = [
    None, "", " ", "plain words, 12 of them.", "it's 'S we'll don't I'm", "<|endoftext|>a<|startoftext|><|endoftext|>",
    "<|EndOfText|>", "ΣΑΣ Σ ΟΔΟΣ", "İstanbul ǅ ﬁ ½ ²", "é ȩ́x á é", "한국어 한", "x　y\x85z\x1c\x1f", "日本語テスト 👩‍👩‍👧",
    "ก็ไทย हिन्दी", "\x00\x07 a", "x" * 5000, "word " * 3000, "no blanks" * 200_000, "é " * 700_000, "ß ẞ ŉ ǰ 𞤀",
]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(COUNTED_VOCABULARY)
    library = Tokenizer.from_file(path)
    rnd = random.Random(2)
    pool = [chr(rnd.randrange(1, 0x3000)) for _ in range(300)] + list(" a1!'sΣ\n") * 20
    texts = ODD + ["".join(rnd.choices(pool, k=rnd.randrange(1, 50))) for _ in range(2000)]
    rows = [(i if i else None, t, 1, True) for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, over_limit boolean")
    docs = docs.withColumn("__text_", F.lit("kept"))
    found = token_count.count_tokens(docs, path)
    assert found.columns == ["doc_id", "__text_", "n_bytes", "n_tokens", "over_limit"]
    counts = {}
    for row in found.collect():
        counts.setdefault(row["doc_id"], []).append((row["n_bytes"], row["n_tokens"], row["over_limit"]))
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert counts[i or None] == [(len((text or "").encode()), n, n > 2048)] * 2, ascii(text)[:80]
    assert found.where("doc_id is null and doc_id is not null").count() == 0
    assert token_count.count_tokens(docs.where("doc_id < 0"), path).collect() == []


def test_token_cache_stays_bounded():
    path = public_tokenizers.path(COUNTED_VOCABULARY)
    own = token_count.Counter(path, {"the": 1})
    own.lengths.room = own.lengths.left = 2000
    counts = [own.count(f"the word{'x' * i}") for i in range(100)]
    assert len(own.lengths) < 20 and own.lengths["the"] == 1
    fresh = token_count.Counter(path)
    assert counts == [fresh.count(f"the word{'x' * i}") for i in range(100)]


def test_frequent_table_packs():
    table = {"the": 1, "été": 2, "'s": 1}
    assert token_count.unpacked(*token_count.packed(table)) == table
    assert token_count.unpacked(*token_count.packed({})) == {}


def test_counts_do_not_depend_on_the_table_of_pretokens(spark, monkeypatch):
    """The table sent beforehand only saves time: with none, or with other pre-tokens, the counts are the same."""
    path = public_tokenizers.path(COUNTED_VOCABULARY)
    texts = ["The cat's unbelievable hat", "the the THE", "été 2024!", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = token_count.Counter(path)
    found = []
    for words in (None, (), ("unbelievable", "zebra")):
        if words is not None:
            monkeypatch.setattr(token_count, "frequent_lengths", lambda *_: {w: own.count(w) for w in words})
        found.append(sorted(map(tuple, token_count.count_tokens(docs, path).collect())))
    assert found[0] == found[1] == found[2] and [r[2] for r in found[0]] == [own.count(t or "") for t in texts]
