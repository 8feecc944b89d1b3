"""Line dedup: keep a repeated line only in the first document that holds it.

Two Bloom filters find the lines that can be repeats without moving any text.
Each task hashes the keys of its lines, one hash per document and key, and sends
them to the filter segment that owns the hash; a segment's rows come in two passes.
In the first it notes hashes seen once in one filter and hashes that were already
there in a second one; in the second pass each hash is asked for in the second
filter, with the id of its document. The filters stay where their segments are:
nothing is sent to all tasks, and their number and size follow the volume of text
without a bound. A hash that a task meets in two documents needs no filter and is
dealt evenly, so a line that is everywhere reaches its segment once per task.

Suspects are grouped by hash: the least document keeps the line. Documents are
joined once with their suspects and written; from there the texts of suspected
lines are compared by hash. Where two texts share a hash, which is rare, the
lines are taken apart by their texts, so results do not rest on the hash.

Defined cases: a null or empty text is one empty line; a row without doc_id keeps
all its lines and counts for no other; rows that share a doc_id count as one
document; a text whose lines all go becomes empty; a very long text is one row;
an empty table gives an empty result. Other columns pass through whatever their
names; columns named like the three outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from presswork.llm.common import binaries, chunks, pow2_at_least
from presswork.session import materialize

MIN_POINTS = 10
# Bits of one filter of a segment: one task holds two filters of one segment at a time, a byte a bit.
SEGMENT_BITS = 1 << 18
LARGEST_SEGMENT = 1 << 26
# Segments grow to their largest size first; only then does their number grow beyond this.
SEGMENTS = 512
BUFFERED = 1 << 20
PIECE = 1 << 13
# A hash with more than this share of all suspects is joined apart; there are fewer than 1,024 such hashes.
HOT_SHARE = 1024
STRIP = b" \t\n\x0b\x0c\r"

Hasher = Callable[[list[bytes]], np.ndarray]


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()


def _counts(key: bytes) -> bool:
    """Has the key enough code points? Bytes 10xxxxxx continue one."""
    return len(key) >= MIN_POINTS and (
        len(key) >= 4 * MIN_POINTS or len(key.decode("utf-8", "replace")) >= MIN_POINTS
    )


def document_keys(text: bytes) -> set[bytes]:
    return {k for k in map(line_key, text.split(b"\n")) if _counts(k)}


def _hashes(keys) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def layout(volume: int) -> tuple[int, int]:
    """Segments for that many bytes of text, and the bits of a filter in each: a bit for 8 bytes."""
    bits = max(SEGMENT_BITS, pow2_at_least(volume / 8))
    size = min(LARGEST_SEGMENT, max(SEGMENT_BITS, bits // SEGMENTS))
    return bits // size, size


def _places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places per hash inside its segment."""
    mask = np.uint64(size - 1)
    mixed = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return (hashes & mask).astype(np.int64), (mixed & mask).astype(np.int64)


def _segments(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(36)) % np.uint64(n)).astype(np.int32)


# Rows of a segment, in this order: hashes of one and of several documents of a block, for the filters;
# hashes to look up; hashes that are suspects already.
ONCE, TWICE, ASKED, SURE = range(4)


def _hash_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("segment", T.IntegerType()),
            T.StructField("kind", T.IntegerType()),
            T.StructField("hashes", T.BinaryType()),
            T.StructField("ids", T.ArrayType(id_type)),
        ]
    )


def _block(values: np.ndarray, ids: pa.Array, n: int) -> pa.RecordBatch:
    """Rows for the segments of one block of ``(hash, document)``."""
    known, inverse, seen = np.unique(values, return_inverse=True, return_counts=True)
    alone = np.flatnonzero(seen[inverse] == 1)
    again = np.flatnonzero(seen[inverse] > 1)
    alone = alone[np.argsort(_segments(values[alone], n), kind="stable")]
    repeated = known[seen > 1]
    repeated = repeated[np.argsort(_segments(repeated, n), kind="stable")]
    rows: tuple[list, list, list, list] = ([], [], [], [])
    none = ids.slice(0, 0)

    def add(segment: int, kind: int, hashes: np.ndarray, own: pa.Array) -> None:
        for column, value in zip(rows, (segment, kind, hashes.tobytes(), own)):
            column.append(value)

    def runs(hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(segment, start, stop)`` of hashes sorted by segment."""
        segments = _segments(hashes, n)
        starts = np.flatnonzero(np.diff(segments, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], len(segments)]):
            yield int(segments[start]), int(start), int(stop)

    for segment, start, stop in runs(values[alone]):
        add(segment, ONCE, values[alone[start:stop]], none)
        add(segment, ASKED, values[alone[start:stop]], ids.take(pa.array(alone[start:stop])))
    for segment, start, stop in runs(repeated):
        add(segment, TWICE, repeated[start:stop], none)
    for piece, start in enumerate(range(0, len(again), PIECE)):
        own = again[start : start + PIECE]
        spread = int((int(values[own[0]]) + piece) % n)
        add(spread, SURE, values[own], ids.take(pa.array(own)))
    offsets = np.cumsum([0, *map(len, rows[3])])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays([none, *rows[3]]))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary()), lists],
        names=["segment", "kind", "hashes", "ids"],
    )


def hash_rows(n: int, hashed: Hasher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: list[np.ndarray] = []
        ids: list[pa.Array] = []
        held = 0
        for batch in chunks(batches):
            own = [hashed(list(document_keys(text))) for text in binaries(batch, "text")]
            lengths = [len(x) for x in own]
            values += own
            ids.append(batch.column(0).take(pa.array(np.repeat(np.arange(len(own)), lengths))))
            held += sum(lengths)
            if held >= BUFFERED:
                yield _block(np.concatenate(values), pa.concat_arrays(ids), n)
                values, ids, held = [], [], 0
        if held:
            yield _block(np.concatenate(values), pa.concat_arrays(ids), n)

    return run


class TwoFilters:
    """One segment: hashes seen once, and hashes seen again."""

    def __init__(self, size: int):
        self.once = np.zeros(size, bool)
        self.twice = np.zeros(size, bool)
        self.size = size

    def add(self, hashes: np.ndarray) -> None:
        """Take hashes that differ from each other."""
        a, b = _places(hashes, self.size)
        again = self.once[a] & self.once[b]
        self.twice[a[again]] = True
        self.twice[b[again]] = True
        self.once[a] = True
        self.once[b] = True

    def add_repeated(self, hashes: np.ndarray) -> None:
        a, b = _places(hashes, self.size)
        for bits in (self.once, self.twice):
            bits[a] = True
            bits[b] = True

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        a, b = _places(hashes, self.size)
        return self.twice[a] & self.twice[b]


def suspect_rows(size: int, id_type: pa.DataType):
    """``(doc_id, hash)`` of the suspects; the input is sorted by segment and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, filters = None, None
        for batch in batches:
            hashes, ids = [], []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for i, (segment, kind, data) in enumerate(zip(*columns)):
                own = np.frombuffer(data, np.uint64)
                if kind != SURE and segment != current:
                    current, filters = segment, TwoFilters(size)
                if kind == ONCE:
                    filters.add(own)
                elif kind == TWICE:
                    filters.add_repeated(own)
                else:
                    hit = np.arange(len(own)) if kind == SURE else np.flatnonzero(filters.suspects(own))
                    hashes.append(own[hit])
                    ids.append(batch.column(3)[i].values.take(pa.array(hit)))
            if hashes:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(ids).cast(id_type), pa.array(np.concatenate(hashes).view(np.int64))],
                    names=["doc_id", "hash"],
                )

    return run


def suspected_lines(docs: DataFrame, hashed: Hasher = _hashes) -> DataFrame:
    """``(doc_id, hash)`` of line keys that the filters take for repeated, of ``(doc_id, text)``."""
    n, size = layout(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    id_type = docs.schema["doc_id"].dataType
    sent = docs.mapInArrow(hash_rows(n, hashed), _hash_schema(id_type))
    dealt = sent.repartition("segment").sortWithinPartitions("segment", "kind")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("hash", T.LongType())])
    return dealt.mapInArrow(suspect_rows(size, to_arrow_type(id_type)), schema)


def _with_first(suspects: DataFrame, firsts: DataFrame) -> DataFrame:
    """Suspects of repeated hashes with ``first``, the least document; hot hashes apart."""
    total = suspects.count()
    hot = F.broadcast(firsts.where(F.col("n") * HOT_SHARE > total).select("hash", "first"))
    others = firsts.where(F.col("n") * HOT_SHARE <= total).select("hash", "first")
    return suspects.join(hot, "hash").unionByName(suspects.join(hot, "hash", "left_anti").join(others, "hash"))


def held_keys(id_type: pa.DataType, hashed: Hasher):
    """``(hash, key, doc_id)`` of the line keys behind a document's suspects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, hashes, kept = [], [], []
            rows = zip(batch.column(0).to_pylist(), binaries(batch, "text"), batch.column(2).to_pylist())
            for doc_id, text, wanted in rows:
                keys = list(document_keys(text))
                own, wanted = hashed(keys).view(np.int64), set(wanted)
                for key, value in zip(keys, own.tolist()):
                    if value in wanted:
                        ids.append(doc_id)
                        hashes.append(value)
                        kept.append(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(kept, pa.binary()), pa.array(ids, id_type)],
                names=["hash", "key", "doc_id"],
            )

    return run


def _exceptions(keys: DataFrame, firsts: DataFrame) -> DataFrame | None:
    """``(doc_id, kept)``: line keys that only share the hash of an earlier line; None if there are none."""
    texts = keys.groupBy("hash").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    clashes = materialize(texts.where("least <> most").select("hash"), "line-clashes")
    if clashes.isEmpty():
        return None
    own = keys.join(clashes, "hash").groupBy("hash", "key").agg(F.min("doc_id").alias("doc_id"))
    late = own.join(firsts.select("hash", "first"), "hash").where("doc_id > first")
    return late.groupBy("doc_id").agg(F.collect_set("key").alias("kept"))


def rewrite_rows(columns: list[str], hashed: Hasher):
    """Rows of ``columns``, lost hashes and kept keys, with the three outputs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = []
            n_lines, n_dropped = [], []
            rows = zip(binaries(batch, "text"), *(batch.column(i).to_pylist() for i in (-2, -1)))
            for text, gone, saved in rows:
                lines = kept = text.split(b"\n")
                if gone:
                    keys = [line_key(x) for x in lines]
                    asked = list({k for k in keys if _counts(k)}.difference(saved or ()))
                    gone = set(gone)
                    lost = {k for k, h in zip(asked, hashed(asked).view(np.int64).tolist()) if h in gone}
                    kept = [x for x, k in zip(lines, keys) if k not in lost]
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in columns],
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=[*columns, "n_lines", "n_dropped", "kept_text"],
            )

    return run


def _unused(columns: list[str]) -> str:
    """A prefix that no column has."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def drop_repeated_lines(docs: DataFrame, hashed: Hasher = _hashes) -> DataFrame:
    """``docs`` with ``n_lines`` (before), ``n_dropped`` and ``kept_text``."""
    made = ("n_lines", "n_dropped", "kept_text")
    docs = docs.select(*[c for c in docs.columns if c not in made])
    slim = docs.select("doc_id", "text").where("doc_id is not null")
    suspects = materialize(suspected_lines(slim, hashed), "line-suspects")
    each = suspects.groupBy("hash").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )
    firsts = materialize(each.where("first < last").drop("last"), "line-firsts")
    name = _unused(docs.columns)
    key, gone, held, saved = (name + x for x in ("id", "gone", "held", "saved"))
    later = F.col("doc_id") > F.col("first")
    marks = _with_first(suspects, firsts).groupBy(F.col("doc_id").alias(key)).agg(
        F.collect_set(F.when(later, F.col("hash"))).alias(gone), F.collect_set("hash").alias(held)
    )
    marked = materialize(docs.join(marks, docs["doc_id"] == F.col(key), "left").drop(key), "line-marked")
    shared = marked.where(F.size(held) > 0).select("doc_id", "text", held)
    schema = T.StructType(
        [T.StructField("hash", T.LongType()), T.StructField("key", T.BinaryType()), docs.schema["doc_id"]]
    )
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    exceptions = _exceptions(shared.mapInArrow(held_keys(id_type, hashed), schema), firsts)
    marked = marked.drop(held)
    if exceptions is None:
        marked = marked.withColumn(saved, F.lit(None).cast("array<binary>"))
    else:
        kept = exceptions.select(F.col("doc_id").alias(key), F.col("kept").alias(saved))
        marked = marked.join(kept, marked["doc_id"] == F.col(key), "left").drop(key)
    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]
    numbers = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped")]
    out = T.StructType([*fields, *numbers, T.StructField("kept_text", T.StringType())])
    return marked.mapInArrow(rewrite_rows(docs.columns, hashed), out)
