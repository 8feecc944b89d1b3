"""Merkle manifest of a table: one hash tree per source, one over the sources' roots.

Every document is a leaf. Three consecutive nodes of a level (the last run may be shorter)
have one parent, level by level, until one node remains. The roots of the sources, in order
of the sources, are the leaves of a last tree of the same kind.

A builder owns an aligned run of ``CHUNK`` = 3**``LEVELS`` leaves, so each node below its root
needs no other builder. It appends every node to its log when the node is complete: a leaf,
then each parent whose last child that was; what stays incomplete is closed at the end from
below. Where a node stands in such a log follows from the sizes of the subtrees before it
(``position``), so siblings are read from the log by their address, without an index. The roots
of the chunks are the leaves of the next tier of builders, ``CHUNK`` times fewer each time.

Texts are hashed where they are read; only digests move. Positions within a source come
from a range partitioning and the counts of its partitions, so a source may be of any size.

Defined cases: a null field is ``-``, an empty text ``0:``; leaves of one source go by doc_id
(null first), then by digest; repeated rows are leaves of their own; a null source is a source
before the others; a null doc_id is tampered with like the empty string; a very long text is
one leaf; an empty table gives an empty result; columns beside the five fields are not part of
a leaf and do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from presswork.session import materialize

FAN = 3
LEVELS = 6
CHUNK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: dict[str, Column]) -> Column:
    """The digest (32 bytes) of a document's fields."""
    return F.unhex(F.sha2(F.concat(*[field(values[name]) for name in FIELDS]), 256))


def node_digest(children: list[bytes]) -> bytes:
    return sha256("".join([c.hex() for c in children]).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels, nodes = 0, leaves
    while nodes > 1:
        levels, nodes = levels + 1, -(-nodes // FAN)
    return levels


def chunk_height(total: int) -> int:
    """Levels that each builder of a tier of ``total`` nodes closes."""
    return LEVELS if total > CHUNK else height(total)


def position(leaves: int, levels: int, level: int, index: int) -> int:
    """Place in the log of node ``index`` of ``level``, in a tree of that many leaves and levels.

    A complete subtree is closed right after its last leaf e: e leaves and ``e // 3**i`` parents
    of level i stand before that leaf. Incomplete ones follow all others, lowest first.
    """
    width = FAN**level
    if index < leaves // width:
        last = (index + 1) * width - 1
        return last + sum(last // FAN**i for i in range(1, levels + 1)) + level
    before = sum(leaves // FAN**i for i in range(1, levels + 1))
    return leaves + before + sum(1 for i in range(1, level) if leaves % FAN**i)


def build_log(leaves: list[bytes], levels: int) -> list[bytes]:
    """All nodes over ``leaves`` in order of completion; the last one is the root."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def append(node: bytes, level: int) -> None:
        log.append(node)
        run = open_runs[level]
        run.append(node)
        if level < levels and len(run) == FAN:
            open_runs[level] = []
            append(node_digest(run), level + 1)

    for leaf in leaves:
        append(leaf, 0)
    for level in range(levels):
        if open_runs[level]:
            run, open_runs[level] = open_runs[level], []
            append(node_digest(run), level + 1)
    return log


def siblings(log: bytes, leaves: int, levels: int, index: int) -> list[tuple[str, str]]:
    """Hex digests left and right of the path from leaf ``index`` to the root, from below."""
    path = []
    for level in range(levels):
        start = index - index % FAN
        stop = min(start + FAN, -(-leaves // FAN**level))
        places = {c: 32 * position(leaves, levels, level, c) for c in range(start, stop) if c != index}
        shown = {c: log[p : p + 32].hex() for c, p in places.items()}
        path.append(("".join(shown[c] for c in shown if c < index), "".join(shown[c] for c in shown if c > index)))
        index //= FAN
    return path


def fold(leaf: bytes, path: list[tuple[str, str]]) -> bytes:
    """The root that ``leaf`` leads to along the siblings of ``path``."""
    node = leaf
    for left, right in path:
        node = sha256((left + node.hex() + right).encode()).digest()
    return node


PATH = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def _indexed(leaves: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``index`` within ``tree`` and ``total``, the number of leaves of that tree.

    The rows are range-partitioned; each partition knows its counts by tree. A row number of the
    input is the last key, so that equal rows, however many, spread as well.
    """
    keys = [F.col("tree").asc_nulls_first(), *order]
    salted = leaves.withColumn("__row", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(*keys, "__row").sortWithinPartitions(*keys, "__row").drop("__row")
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)
    stored = materialize(ranged.withColumns({"__part": part, "__place": place}), "merkle-leaves")
    each = stored.groupBy("tree", "__part").agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    before = W.partitionBy("tree").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shifts = each.select(
        F.col("tree").alias("__tree"),
        F.col("__part").alias("__at"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(W.partitionBy("tree")).alias("total"),
    )
    shifts = materialize(shifts, "merkle-counts")
    joined = stored.join(shifts, (F.col("__at") == F.col("__part")) & F.col("__tree").eqNullSafe(F.col("tree")))
    return joined.withColumn("index", F.col("__place") + F.col("__shift")).drop(
        "__tree", "__at", "__part", "__place", "__shift"
    )


def _build_chunk(payload: list[str], schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("index").to_numpy())
        table = table.take(pa.array(order))
        total = table.column("total")[0].as_py()
        log = build_log(table.column("digest").to_pylist(), chunk_height(total))
        row = {
            "tree": [table.column("tree")[0].as_py()],
            "chunk": [table.column("chunk")[0].as_py()],
            "total": [total],
            "size": [table.num_rows],
            "root": [log[-1]],
            "log": [b"".join(log)],
            **{name: [table.column(name).to_pylist()] for name in payload},
        }
        return pa.table(row, schema=schema)

    return run


def _tier(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """One row per builder: its log, its root and, of the lowest tier, the leaves' ``payload``."""
    schema = T.StructType(
        [
            nodes.schema["tree"],
            T.StructField("chunk", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("root", T.BinaryType()),
            T.StructField("log", T.BinaryType()),
            *[T.StructField(name, T.ArrayType(nodes.schema[name].dataType)) for name in payload],
        ]
    )
    work = _build_chunk(payload, to_arrow_schema(schema))
    chunked = nodes.withColumn("chunk", F.floor(F.col("index") / CHUNK).cast("long"))
    return materialize(chunked.groupBy("tree", "chunk").applyInArrow(work, schema), "merkle-log")


def build_forest(leaves: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The tiers of logs over ``leaves`` (tree, index, total, digest and the payload columns).

    A tree with one chunk in a tier ends there; the others go on with their chunks' roots.
    """
    tiers = [_tier(leaves, payload)]
    while (tiers[-1].agg(F.max("total")).first()[0] or 0) > CHUNK:
        below = tiers[-1].where(F.col("total") > CHUNK)
        nodes = below.select(
            "tree",
            F.col("chunk").alias("index"),
            F.ceil(F.col("total") / CHUNK).cast("long").alias("total"),
            F.col("root").alias("digest"),
        )
        tiers.append(_tier(nodes, []))
    return tiers


def tree_roots(tiers: list[DataFrame]) -> DataFrame:
    """``(tree, root)`` of every tree."""
    ends = [t.where(F.col("total") <= CHUNK).select("tree", "root") for t in tiers]
    roots = ends[0]
    for more in ends[1:]:
        roots = roots.unionByName(more)
    return roots


def _path_rows(passed: list[str], schema: pa.Schema):
    """One row per leaf of a chunk: its whole path, of which ``above`` is the upper part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                upper = [(step["left"], step["right"]) for step in row["above"]]
                levels, out = chunk_height(row["total"]), []
                for index in range(row["size"]):
                    path = siblings(row["log"], row["size"], levels, index) + upper
                    out.append(
                        {
                            "tree": row["tree"],
                            "chunk": row["chunk"] * CHUNK + index,
                            "above": [{"left": a, "right": b} for a, b in path],
                            **{name: row[name] for name in passed},
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _with_above(tier: DataFrame, above: DataFrame) -> DataFrame:
    named = above.withColumnsRenamed({"tree": "__tree", "chunk": "__chunk"})
    same = (F.col("chunk") == F.col("__chunk")) & F.col("tree").eqNullSafe(F.col("__tree"))
    return tier.join(named, same).drop("__tree", "__chunk")


def chunk_paths(tiers: list[DataFrame], ends: DataFrame) -> DataFrame:
    """For every chunk of the lowest tier, the siblings from its root up, and what ``ends`` tells.

    ``ends`` has one row per tree: ``tree``, ``above`` (the path over the tree's root) and more.
    """
    passed = [c for c in ends.columns if c not in ("tree", "above")]
    above = None
    for tier in reversed(tiers):
        single = tier.where(F.col("total") <= CHUNK).select(F.col("tree").alias("__t"), F.lit(0).cast("long").alias("chunk"))
        here = single.join(ends, F.col("__t").eqNullSafe(F.col("tree"))).select("tree", "chunk", "above", *passed)
        if above is not None:
            here = here.unionByName(above)
        if tier is tiers[0]:
            return materialize(here, "merkle-paths")
        schema = T.StructType([here.schema["tree"], here.schema["chunk"], T.StructField("above", PATH), *[here.schema[c] for c in passed]])
        rows = _with_above(tier, here).mapInArrow(_path_rows(passed, to_arrow_schema(schema)), schema)
        above = materialize(rows, "merkle-paths")
    raise AssertionError("a forest has a tier")


@dataclass
class Manifest:
    """The logs of all builders: ``tiers`` over the documents, ``top`` over the sources."""

    tiers: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame

    def root(self) -> str | None:
        """The root over all sources; none of an empty table."""
        row = tree_roots(self.top).first()
        return row["root"].hex() if row else None


def build_manifest(leaves: DataFrame, source: str = "source", payload: list[str] | None = None) -> Manifest:
    """The manifest of ``leaves``: doc_id, a source column, ``digest`` and columns to keep beside it."""
    payload = payload or []
    kept = leaves.withColumnRenamed(source, "tree").select("tree", "doc_id", "digest", *payload)
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()]
    tiers = build_forest(_indexed(kept, order), ["doc_id", *payload])
    roots = materialize(tree_roots(tiers), "merkle-roots")
    subtrees = roots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    ordered = _indexed(subtrees, [F.col("name").asc_nulls_first()])
    return Manifest(tiers, build_forest(ordered, ["name"]), roots)


def _source_rows(schema: pa.Schema):
    """One row per source: name, path of its root and the root over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                upper = [(step["left"], step["right"]) for step in row["above"]]
                levels, out = chunk_height(row["total"]), []
                for index, name in enumerate(row["name"]):
                    path = siblings(row["log"], row["size"], levels, index) + upper
                    steps = [{"left": a, "right": b} for a, b in path]
                    out.append({"tree": name, "above": steps, "__root": row["__root"]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _proof_rows(changed: str | None, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                upper = [(step["left"], step["right"]) for step in row["above"]]
                levels, log, size = chunk_height(row["total"]), row["log"], row["size"]
                out = []
                for index, doc_id in enumerate(row["doc_id"]):
                    at = 32 * position(size, levels, 0, index)
                    leaf = log[at : at + 32]
                    path = siblings(log, size, levels, index) + upper
                    shown = leaf if changed is None else row[changed][index]
                    out.append(
                        {
                            "doc_id": doc_id,
                            "leaf": leaf.hex(),
                            "subroot": row["__subroot"].hex(),
                            "root": row["__root"].hex(),
                            "proof": "".join([a + b for a, b in path]),
                            "folded_root": fold(shown, path).hex(),
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def proofs(manifest: Manifest, changed: str | None = None) -> DataFrame:
    """One row per leaf: its digest, both roots, the proof (the siblings, hex, from below) and
    the root that the leaf, or the digest in the payload column ``changed`` instead, folds to."""
    spark = manifest.roots.sparkSession
    over_all = tree_roots(manifest.top).select("tree", F.col("root").alias("__root"), F.array().cast(PATH).alias("above"))
    top = _with_above(manifest.top[0], chunk_paths(manifest.top, over_all))
    ends_schema = T.StructType(
        [
            T.StructField("tree", manifest.roots.schema["tree"].dataType),
            T.StructField("above", PATH),
            T.StructField("__root", T.BinaryType()),
        ]
    )
    ends = top.mapInArrow(_source_rows(to_arrow_schema(ends_schema)), ends_schema)
    subroots = manifest.roots.select(F.col("tree").alias("__t"), F.col("root").alias("__subroot"))
    ends = ends.join(subroots, F.col("__t").eqNullSafe(F.col("tree"))).drop("__t")
    ends = materialize(ends, "merkle-ends")
    chunks = _with_above(manifest.tiers[0], chunk_paths(manifest.tiers, ends))
    schema = T.StructType(
        [
            T.StructField("doc_id", manifest.tiers[0].schema["doc_id"].dataType.elementType),
            *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof", "folded_root")],
        ]
    )
    return chunks.mapInArrow(_proof_rows(changed, to_arrow_schema(schema)), schema)


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``digest`` and ``tampered``: the digest with the text's line feeds gone
    where the id's CRC-32 is even, else the same."""
    values = {name: F.col(name) for name in FIELDS}
    digests = docs.select(*FIELDS, leaf_digest(values).alias("digest"))
    decimal = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hit = (F.crc32(F.encode(decimal, "UTF-8")) % 2 == 0) & F.contains("text", F.lit("\n"))
    stripped = values | {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    tampered = F.when(hit, leaf_digest(stripped)).otherwise(F.col("digest"))
    return digests.select("doc_id", "source", "digest", tampered.alias("tampered"))
