"""Conversation structure repair: the cheapest edits that make roles alternate.

The repaired roles spell ``(s?(ua)+)?``, which four states tell apart: nothing yet, after the
system turn, after a user, after an assistant. An edit of a row (with the inserts before it) leads
from state to state, so a stretch of rows is a matrix of costs. Edits are found as Hirschberg
does: costs forward from the start and backward from the end meet in the middle; of the
optimal states there, the one with the least edits so far is taken, and both halves follow alone.
Nothing but two vectors of four states is kept on the way.

Forward vectors hold a rank beside each cost: the order of the least cheapest edits that lead to
each state. Such edit strings up to one row are never prefixes of each other, so the ranks of
a row follow from those before it, and no string is compared.

The same divide step spreads a long conversation: rows are range-partitioned by conversation and
turn and cut into blocks of ``BLOCK_ROWS``. A conversation inside one block of one task is done there.
The blocks of others become matrices, one pass chains the forward vectors, one the
backward vectors, their crossings fix the states between blocks, and each block is solved
by itself. Only hashing the repaired text goes through a conversation in order, a
block at a time; no task ever holds more than a block of rows (and the audit, a letter a row).

Defined cases: nulls are one space, in texts, in roles and in the damage's key; a null conv_id is
a conversation; rows of one turn go by role, then by hash of the text, then by text; repeated
rows are duplicates; roles that begin with other letters can only be rewritten or deleted; a very
long text is a block of its own; a conversation without rows after damage has zeros, an empty
audit and an empty text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from presswork.llm.common import BLANKS
from presswork.session import materialize

BLOCK_ROWS = 1024
BLOCK_CHARS = 1 << 22
NEVER = 1 << 20
STATES = range(4)
# Inserts that end a conversation in each state, and what they cost.
ENDINGS = ("", "II", "I", "")
END_COSTS = (0, 6, 3, 0)

# A row as one letter: the initial of its role if it may stay (x: another one), in upper
# case if its text is cut short; b and d for blank rows and duplicates.
STAYING = "suaxSUAX"


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with planted faults: ``gone`` marks rows to drop, ``copies`` counts repeated ones."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    place = F.concat(filled["conv_id"], F.lit(":"), filled["turn"])
    fate = rows.select(
        "conv_id", "turn", filled["role"].alias("role"), filled["text"].alias("text"),
        (F.crc32(F.encode(place, "UTF-8")) % 20).alias("fate"),
    )
    text = F.col("text")
    return fate.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, F.lit(""))
        .when(F.col("fate") == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.when(F.col("fate") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
        (F.col("fate") == 0).alias("gone"),
    )


def flipped(state: int) -> int:
    """The state after the one role that an inserted or rewritten row can have there."""
    return 3 if state == 2 else 2


def given_role(state: int) -> str:
    return "assistant" if state == 2 else "user"


def _kept(state: int, initial: str) -> int | None:
    if initial == "s" and state == 0:
        return 1
    if initial == "u" and state != 2:
        return 2
    if initial == "a" and state == 2:
        return 3
    return None


@lru_cache(maxsize=None)
def steps(kind: str) -> tuple:
    """For each state before a row of this kind and each after it: (cost, edits), or None."""
    table = [[None] * 4 for _ in STATES]
    for state in STATES:
        before, cost, edits = state, 0, ""
        for _ in range(3):
            options = [(before, cost + 4, edits + "D")]
            if kind in STAYING:
                more = 3 if kind.isupper() else 0
                options.append((flipped(before), cost + 3 + more, edits + "R"))
                kept = _kept(before, kind.lower())
                if kept is not None:
                    options.append((kept, cost + more, edits + "K"))
            for after, total, letters in options:
                if table[state][after] is None or (total, letters) < table[state][after]:
                    table[state][after] = (total, letters)
            before, cost, edits = flipped(before), cost + 3, edits + "I"
    return tuple(map(tuple, table))


def start_at(state: int) -> tuple:
    """A forward vector: (costs, ranks of the least edits)."""
    return tuple(0 if q == state else NEVER for q in STATES), (0, 0, 0, 0)


def end_at(state: int) -> tuple:
    return tuple(0 if q == state else NEVER for q in STATES)


def _level(costs: list[int]) -> tuple:
    least = min(costs)
    return tuple(c - least if c < NEVER else NEVER for c in costs)


def _ranked(chosen: list) -> tuple:
    order = sorted({c for c in chosen if c is not None})
    return tuple(order.index(c) if c is not None else 0 for c in chosen)


# Costs differ by a few edits at most, so there are few vectors and few entries here.
@lru_cache(maxsize=1 << 16)
def forward(vector: tuple, kind: str) -> tuple:
    """The vector after a row, its costs told from the least one."""
    costs, ranks = vector
    table = steps(kind)
    totals, chosen = [], []
    for after in STATES:
        options = [
            (costs[q] + table[q][after][0], ranks[q], table[q][after][1])
            for q in STATES
            if costs[q] < NEVER and table[q][after] is not None
        ]
        best = min(options, default=None)
        totals.append(best[0] if best else NEVER)
        chosen.append(best[1:] if best else None)
    return _level(totals), _ranked(chosen)


@lru_cache(maxsize=1 << 16)
def backward(costs: tuple, kind: str) -> tuple:
    """The least costs from each state before a row to the end."""
    table = steps(kind)
    return _level(
        [
            min((t[0] + costs[q] for q, t in enumerate(table[p]) if t is not None and costs[q] < NEVER), default=NEVER)
            for p in STATES
        ]
    )


def crossing(ahead: tuple, back: tuple) -> int:
    """Where an optimal way with the least edits so far passes between two rows."""
    costs, ranks = ahead
    return min((costs[q] + back[q], ranks[q], q) for q in STATES if costs[q] < NEVER and back[q] < NEVER)[2]


def solve(kinds: str, start: int = 0, end: tuple = END_COSTS) -> tuple[str, int]:
    """The least of the cheapest edits of the rows ``kinds``, and the state they end in.

    Inserts after the last row are not part of it: see ``ENDINGS``.
    """
    audit, state = [], start
    todo = [(0, len(kinds), end)]
    while todo:
        low, high, end = todo.pop()
        if high - low > 1:
            middle = (low + high) // 2
            ahead, back = start_at(state), end
            for kind in kinds[low:middle]:
                ahead = forward(ahead, kind)
            for kind in reversed(kinds[middle:high]):
                back = backward(back, kind)
            # The left half is solved first and leaves its state to the right one.
            todo.append((middle, high, end))
            todo.append((low, middle, end_at(crossing(ahead, back))))
        elif high > low:
            ways = [(t[0] + end[q], t[1], q) for q, t in enumerate(steps(kinds[low])[state]) if t is not None]
            _, edits, state = min(ways)
            audit.append(edits)
    return "".join(audit), state


def transfer(kinds: str) -> list[int]:
    """What the rows do from each state: four costs and four ranks, thirty-two numbers.

    Costs are absolute here, so that ways from different states can be compared.
    """
    out = []
    for start in STATES:
        vector, least = start_at(start), 0
        for kind in kinds:
            table, costs = steps(kind), vector[0]
            least += min(
                costs[q] + t[0] for q in STATES if costs[q] < NEVER for t in table[q] if t is not None
            )
            vector = forward(vector, kind)
        out += [c + least if c < NEVER else NEVER for c in vector[0]] + list(vector[1])
    return out


def after_block(vector: tuple, block: list[int]) -> tuple:
    """The forward vector after a block, from that before it and the block's ``transfer``."""
    costs, ranks = vector
    totals, chosen = [], []
    for after in STATES:
        best = min(
            (
                (costs[q] + block[8 * q + after], ranks[q], block[8 * q + 4 + after])
                for q in STATES
                if costs[q] < NEVER and block[8 * q + after] < NEVER
            ),
            default=None,
        )
        totals.append(best[0] if best else NEVER)
        chosen.append(best[1:] if best else None)
    return _level(totals), _ranked(chosen)


def before_block(costs: tuple, block: list[int]) -> tuple:
    """The backward costs before a block from those after it."""
    return _level(
        [
            min((block[8 * p + q] + costs[q] for q in STATES if costs[q] < NEVER and block[8 * p + q] < NEVER), default=NEVER)
            for p in STATES
        ]
    )


def edited(audit: str, roles: list[str], texts: list[str], state: int = 0) -> list[str]:
    """The lines ``role:text`` that the edits leave, from the state before them."""
    lines, row = [], 0
    for letter in audit:
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            state = _kept(state, roles[row][:1])
            lines.append(f"{roles[row]}:{texts[row]}")
            row += 1
            continue
        role, state = given_role(state), flipped(state)
        lines.append(f"{role}:{texts[row] if letter == 'R' else ''}")
        row += letter == "R"
    return lines


def edit_cost(audit: str, kinds: str) -> int:
    rows = [x for x in audit if x != "I"]
    cut = sum(1 for letter, kind in zip(rows, kinds) if letter != "D" and kind.isupper())
    return 3 * (len(audit) - len(rows)) + 4 * rows.count("D") + 3 * rows.count("R") + 3 * cut


def kind_of(role: str, text: str, seen: bool) -> str:
    bare = text.rstrip(BLANKS)
    if not bare:
        return "b"
    if seen:
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial if bare[-1] in ".!?" else initial.upper()


def broken_pairs(initials: str) -> int:
    """Adjacent roles that do not follow each other."""
    return sum(1 for pair in zip(initials, initials[1:]) if "".join(pair) not in ("su", "ua", "au"))


@dataclass
class Block:
    """Rows of one conversation in order; duplicates within the block are known."""

    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    kinds: list[str] = field(default_factory=list)
    turns: list[int] = field(default_factory=list)
    seen: set = field(default_factory=set)
    chars: int = 0

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.chars >= BLOCK_CHARS

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.kinds.append(kind_of(role, text, (role, text) in self.seen))
        self.seen.add((role, text))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def facts(self) -> dict:
        return {
            "initials": "".join([r[:1] if r[:1] in ("s", "u", "a") else "x" for r in self.roles]),
            "kinds": "".join(self.kinds),
            "n_turns": len(self.turns),
            "first_turn": self.turns[0] if self.turns else None,
            "last_turn": self.turns[-1] if self.turns else None,
        }


def summary(facts: dict, audit: str, digest: str) -> dict:
    kinds, turns = facts["kinds"], facts["n_turns"]
    return {
        "gaps": facts["last_turn"] - facts["first_turn"] + 1 - turns if turns else 0,
        "blank": kinds.count("b"),
        "duplicate": kinds.count("d"),
        "truncated": sum(1 for k in kinds if k.isupper()),
        "illegal": broken_pairs(facts["initials"]),
        "cost": edit_cost(audit, kinds),
        "audit": audit,
        "repaired_sha256": digest,
    }


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = [*[T.StructField(c, T.LongType()) for c in COUNTS], *[T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")]]
FACTS = [
    T.StructField("initials", T.StringType()),
    T.StructField("kinds", T.StringType()),
    T.StructField("n_turns", T.LongType()),
    T.StructField("first_turn", T.LongType()),
    T.StructField("last_turn", T.LongType()),
]
PLACE = [T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType())]
LINES = [T.StructField(c, T.ArrayType(T.StringType())) for c in ("roles", "texts")]


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2000, chars: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, cut by number and by characters of text."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(map(len, row.get("texts") or ())) + len(row.get("repaired") or "")
        if len(held) >= size or weight >= chars:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows(batches: Iterator[pa.RecordBatch], step: int = 500) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield from batch.slice(start, step).to_pylist()


def _blocks_of(rows: Iterator[dict], size: int) -> Iterator[tuple]:
    """(conv_id, number of the block in this task, block, whether nothing of the conversation is elsewhere)."""
    known, conv, block, seq, begun, first = False, None, Block(), 0, 0, True
    for row in rows:
        if not known or row["conv_id"] != conv:
            if known:
                # The first conversation of a task may have begun in the one before.
                yield conv, seq, block, seq == begun and not first
                first, seq = False, seq + 1
            known, conv, block, begun = True, row["conv_id"], Block(), seq
        for _ in range(0 if row["gone"] else row["copies"]):
            if block.full(size):
                yield conv, seq, block, False
                block, seq = Block(), seq + 1
            block.add(row["turn"], row["role"], row["text"])
    if known:
        # And the last one may go on in the next.
        yield conv, seq, block, False


def block_rows(schema: pa.Schema, texts: bool, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def made() -> Iterator[dict]:
            for conv, seq, block, whole in _blocks_of(_rows(batches), size):
                row = {"conv_id": conv, "part": part, "seq": seq}
                facts = block.facts()
                if whole:
                    audit, state = solve(facts["kinds"])
                    audit += ENDINGS[state]
                    text = "\n".join(edited(audit, block.roles, block.texts))
                    row |= summary(facts, audit, sha256(text.encode()).hexdigest())
                    row |= {"done": True, "repaired": text if texts else None}
                else:
                    row |= facts | {"done": False, "roles": block.roles, "texts": block.texts}
                yield row

        return _batches(made(), schema)

    return run


def key_rows(schema: pa.Schema):
    """The first row of each block with a role and text, as a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for row in _rows(batches, 8):
                for i, (role, text, kind) in enumerate(zip(row["roles"], row["texts"], row["kinds"])):
                    if kind in STAYING:
                        name = f"{len(role)}:{role}:{text}".encode()
                        yield {"conv_id": row["conv_id"], "part": row["part"], "seq": row["seq"], "i": i, "key": sha256(name).digest()}

        return _batches(made(), schema)

    return run


def transfer_rows(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for row in _rows(batches):
                kinds = list(row["kinds"])
                for i in row.pop("earlier") or ():
                    kinds[i] = "d"
                kinds = "".join(kinds)
                yield row | {"kinds": kinds, "block": transfer(kinds)}

        return _batches(made(), schema)

    return run


def ahead_rows(schema: pa.Schema):
    """Blocks of a conversation in order: the forward vectors around each, and how it meets the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            known, conv, vector, initial, turn = False, None, start_at(0), "", None
            for row in _rows(batches):
                if not known or row["conv_id"] != conv:
                    known, conv, vector, initial, turn = True, row["conv_id"], start_at(0), "", None
                after = after_block(vector, row["block"])
                joint = initial + row["initials"][:1]
                yield row | {
                    "ahead": [*vector[0], *vector[1]],
                    "ahead_end": [*after[0], *after[1]],
                    "joint": broken_pairs(joint),
                    "shared": int(turn is not None and turn == row["first_turn"]),
                }
                vector, initial = after, row["initials"][-1:] or initial
                turn = row["last_turn"] if row["last_turn"] is not None else turn

        return _batches(made(), schema)

    return run


def state_rows(schema: pa.Schema):
    """Blocks of a conversation from its end: the states that each begins and ends in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            known, conv, back = False, None, END_COSTS
            for row in _rows(batches):
                last = not known or row["conv_id"] != conv
                if last:
                    known, conv, back = True, row["conv_id"], END_COSTS
                end = crossing((row["ahead_end"][:4], row["ahead_end"][4:]), back)
                back = before_block(back, row["block"])
                start = crossing((row["ahead"][:4], row["ahead"][4:]), back)
                yield row | {"start": start, "end": end, "last": last}

        return _batches(made(), schema)

    return run


def audit_rows(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for row in _rows(batches):
                audit, state = solve(row["kinds"], row["start"], end_at(row["end"]))
                yield row | {"audit": audit + (ENDINGS[state] if row["last"] else "")}

        return _batches(made(), schema)

    return run


def joined_rows(schema: pa.Schema, texts: bool):
    """Each block's edits followed by its rows, in order: one result per conversation.

    With ``texts``, one row per block with its part of the repaired text instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(conv, total: dict, low, high, turns, audits, digest) -> dict:
            gaps = high - low + 1 - turns if turns else 0
            return {"conv_id": conv, **total, "gaps": gaps, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

        def made() -> Iterator[dict]:
            known, conv, edits = False, None, None
            total, low, high, turns, audits, digest, empty = {}, None, None, 0, [], sha256(), True
            for row in _rows(batches, 8):
                if not known or row["conv_id"] != conv:
                    if known and not texts:
                        yield closed(conv, total, low, high, turns, audits, digest)
                    known, conv = True, row["conv_id"]
                    total, low, high, turns = dict.fromkeys(COUNTS[1:], 0), None, None, 0
                    audits, digest, empty = [], sha256(), True
                if row["audit"] is not None:
                    edits = row
                    continue
                part = summary(edits, edits["audit"], "")
                for name in total:
                    total[name] += part[name]
                total["illegal"] += edits["joint"]
                if edits["n_turns"]:
                    low = edits["first_turn"] if low is None else low
                    high = edits["last_turn"]
                    turns += edits["n_turns"] - edits["shared"]
                lines = edited(edits["audit"], row["roles"], row["texts"], edits["start"])
                text = "\n".join(lines)
                if texts:
                    yield {"conv_id": conv, "part": row["part"], "seq": row["seq"], "repaired": text if lines else None}
                    continue
                audits.append(edits["audit"])
                if lines:
                    digest.update((text if empty else "\n" + text).encode())
                    empty = False
            if known and not texts:
                yield closed(conv, total, low, high, turns, audits, digest)

        return _batches(made(), schema)

    return run


def _mapped(df: DataFrame, work, schema: T.StructType, *more) -> DataFrame:
    return df.mapInArrow(work(to_arrow_schema(schema), *more), schema)


def _blocks(rows: DataFrame, texts: bool, size: int) -> DataFrame:
    """Done conversations with their results, and the blocks of all others."""
    conv = T.StructField("conv_id", rows.schema["conv_id"].dataType)
    keys = [
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(),
        F.col("role").asc(), F.col("__hash").asc(),
    ]
    hashed = rows.withColumns({"__hash": F.xxhash64("text"), "__row": F.monotonically_increasing_id()})
    # The row number parts equal rows, however many; the text itself stays out of the sampled keys.
    ranged = hashed.repartitionByRange(*keys, F.col("__row").asc())
    ordered = ranged.sortWithinPartitions(*keys, F.col("text").asc()).drop("__hash", "__row")
    schema = T.StructType(
        [conv, *PLACE, T.StructField("done", T.BooleanType()), *RESULT, T.StructField("repaired", T.StringType()), *FACTS, *LINES]
    )
    return materialize(_mapped(ordered, block_rows, schema, texts, size), "conversation-blocks")


def _edits(blocks: DataFrame) -> DataFrame:
    """The edits of every block of the conversations that run over blocks or tasks."""
    conv = blocks.schema["conv_id"]
    place = [conv, *PLACE]
    key_schema = T.StructType([*place, T.StructField("i", T.IntegerType()), T.StructField("key", T.BinaryType())])
    keys = materialize(_mapped(blocks.select("conv_id", "part", "seq", "kinds", "roles", "texts"), key_rows, key_schema), "conversation-keys")
    at = F.struct("part", "seq")
    firsts = keys.groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(F.min(at).alias("first"))
    repeated = keys.join(firsts, (F.col("key") == F.col("k")) & F.col("conv_id").eqNullSafe(F.col("c"))).where(at > F.col("first"))
    earlier = repeated.groupBy("part", "seq").agg(F.collect_list("i").alias("earlier"))

    facts = [f.name for f in FACTS]
    slim = blocks.select("conv_id", "part", "seq", *facts).join(earlier, ["part", "seq"], "left")
    slim = slim.select("conv_id", "part", "seq", *facts, "earlier")
    numbers = T.ArrayType(T.IntegerType())
    with_block = [*place, *FACTS, T.StructField("block", numbers)]
    transfers = _mapped(slim, transfer_rows, T.StructType(with_block))
    with_ahead = [
        *with_block,
        *[T.StructField(c, numbers) for c in ("ahead", "ahead_end")],
        *[T.StructField(c, T.IntegerType()) for c in ("joint", "shared")],
    ]
    order = transfers.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    ahead = materialize(_mapped(order, ahead_rows, T.StructType(with_ahead)), "conversation-ahead")
    back_order = [F.col("conv_id"), F.col("part").desc(), F.col("seq").desc()]
    order = ahead.repartition("conv_id").sortWithinPartitions(*back_order)
    with_state = [
        *with_ahead,
        *[T.StructField(c, T.IntegerType()) for c in ("start", "end")],
        T.StructField("last", T.BooleanType()),
    ]
    states = _mapped(order, state_rows, T.StructType(with_state)).drop("block", "ahead", "ahead_end")
    spread = states.repartition("part", "seq")
    solved = T.StructType([*spread.schema.fields, T.StructField("audit", T.StringType())])
    return _mapped(spread, audit_rows, solved)


def _joined(blocks: DataFrame, texts: bool) -> DataFrame:
    edits, lines = _edits(blocks), blocks.select("conv_id", "part", "seq", "roles", "texts")
    both = edits.unionByName(lines, allowMissingColumns=True)
    order = ["conv_id", "part", "seq", F.col("audit").isNull()]
    ordered = both.repartition("conv_id").sortWithinPartitions(*order)
    conv = blocks.schema["conv_id"]
    if texts:
        schema = T.StructType([conv, *PLACE, T.StructField("repaired", T.StringType())])
    else:
        schema = T.StructType([conv, *RESULT])
    return _mapped(ordered, joined_rows, schema, texts)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: its faults, the cost and edits of its repair, and the digest of the
    repaired lines. ``rows`` as from ``damage``: conv_id, turn, role, text, copies and gone."""
    blocks = _blocks(rows, False, block_rows)
    done = blocks.where("done").select("conv_id", *[f.name for f in RESULT])
    return done.unionByName(_joined(blocks.where(~F.col("done")), False))


def repaired_texts(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired lines: one row per block of a conversation, in the order of ``part`` and ``seq``;
    a conversation inside one block is one row. Blocks without lines are null."""
    blocks = _blocks(rows, True, block_rows)
    done = blocks.where("done").select("conv_id", "part", "seq", "repaired")
    return done.unionByName(_joined(blocks.where(~F.col("done")), True))
