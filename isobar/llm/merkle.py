"""A manifest of a dataset as a Merkle tree, and proofs of all its documents by multiproofs of leaf ranges.

Leaves are hashes of documents. Each source has a tree over its leaves by doc_id, and one more tree has the sources' roots as leaves; a
node is the hash of up to FAN_OUT neighbours. Trees are built in blocks of BLOCK leaves: a block's nodes need nothing from outside,
and the block roots are the leaves of the next round. For proofs, a range of whole blocks goes to one task. What its leaves' proofs need
beyond the nodes that follow from the leaves themselves is known from positions alone: those coordinates are
looked up once for the range, all other nodes are derived, and every leaf's proof is read from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import in_order, numbered, running_before, ship, written

FAN_OUT = 3
_ROUND = 6  # levels of a block
BLOCK = FAN_OUT**_ROUND
LEAVES_AT_ONCE = 3 * BLOCK
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ trees by position
def joined(digests: Sequence[bytes]) -> bytes:
    """H of some nodes: the SHA-256 of their digests as hexadecimal text."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def width_at(leaves: int, level: int) -> int:
    """How many nodes a tree has at a level; level 0 has the leaves."""
    return -(-leaves // FAN_OUT**level)


def height(leaves: int) -> int:
    level = 0
    while leaves > 1:
        leaves, level = -(-leaves // FAN_OUT), level + 1
    return level


def above(nodes: list[bytes]) -> list[bytes]:
    return [joined(nodes[i : i + FAN_OUT]) for i in range(0, len(nodes), FAN_OUT)]


def missing_at(first: int, end: int, at_level: int) -> list[int]:
    """Of ``at_level`` nodes, the neighbours that a range of them lacks in the runs at its two ends."""
    return [*range(first // FAN_OUT * FAN_OUT, first), *range(end, min(-(-end // FAN_OUT) * FAN_OUT, at_level))]


def missing(first: int, end: int, leaves: int) -> list[tuple[int, int]]:
    """Coordinates (level, place) that the proofs of leaves ``first`` to ``end`` - 1 need and that do not follow from them.

    The nodes known at a level are a range, so only the runs at its ends can lack any. This is the smallest set: each of them is a
    sibling in some proof, and none has a leaf of the range below it.
    """
    found = []
    for level in range(height(leaves)):
        found += [(level, place) for place in missing_at(first, end, width_at(leaves, level))]
        first, end = first // FAN_OUT, -(-end // FAN_OUT)
    return found


class RangeTree:
    """The part of a tree that the proofs of a range of leaves need: the range's own nodes and the fetched ones."""

    def __init__(self, first: int, digests: list[bytes], leaves: int, fetched: dict[tuple[int, int], bytes]):
        self.height = height(leaves)
        self.nodes: list[dict[int, bytes]] = []
        known = dict(enumerate(digests, first))
        for level in range(self.height):
            at_level = width_at(leaves, level)
            for place in missing_at(first, first + len(digests), at_level):
                known[place] = fetched[level, place]
            self.nodes.append(known)
            begin, end = min(known), max(known) + 1
            digests = above([known[p] for p in range(begin, end)])
            first = begin // FAN_OUT
            known = dict(enumerate(digests, first))
        self.nodes.append(known)
        self.root = known[0]

    def proof(self, place: int) -> list[tuple[list[bytes], list[bytes]]]:
        """For each level, the digests before and after the node of the path within its run."""
        steps = []
        for level in range(self.height):
            start = place // FAN_OUT * FAN_OUT
            run = self.nodes[level]
            steps.append((
                [run[p] for p in range(start, place)],
                [run[p] for p in range(place + 1, start + FAN_OUT) if p in run],
            ))
            place //= FAN_OUT
        return steps


def folded(leaf: bytes, steps: Sequence[tuple[Sequence[bytes], Sequence[bytes]]]) -> bytes:
    """The root that a leaf and its proof give."""
    for before, after in steps:
        leaf = joined([*before, leaf, *after])
    return leaf


# ------------------------------------------------------------------ leaves
def leaf_of(columns: Sequence[Column]) -> Column:
    """The hash of a document: each value as its length in bytes, a colon and the value, ``-`` for NULL, one after another."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


# ------------------------------------------------------------------ building
def _climbed(nodes: DataFrame, all_levels: bool) -> DataFrame:
    """Nodes (source, n, level, place, digest) above those of one level, up to _ROUND levels, each block in one task.

    ``n`` is the number of leaves of the source. Only the highest of a block, or all new ones.
    """
    ship(nodes.sparkSession)

    def climb(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        source, n, level, place = (table.column(c)[0].as_py() for c in ("source", "n", "level", "place"))
        digests = table.column("digest").to_pylist()
        rows = []
        for _ in range(min(_ROUND, height(n) - level)):
            digests, level, place = above(digests), level + 1, place // FAN_OUT
            made = [(source, n, level, place + i, d) for i, d in enumerate(digests)]
            rows = [*rows, *made] if all_levels else made
        cells = list(zip(*rows)) or [[]] * 5
        kinds = (table.schema.field("source").type, pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.table({c: pa.array(v, k) for c, v, k in zip(("source", "n", "level", "place", "digest"), cells, kinds)})

    kind = nodes.schema["source"].dataType.simpleString()
    blocks = nodes.withColumn("_block", F.floor(F.col("place") / BLOCK))
    return blocks.groupBy("source", "_block").applyInArrow(climb, f"source {kind}, n long, level int, place long, digest binary")


def _tree(leaves: DataFrame, largest: int, label: str) -> tuple[DataFrame, DataFrame]:
    """All nodes from level _ROUND on, and the roots, of trees with leaves (source, n, level 0, place, digest), ``largest`` at most."""
    upper = written(_climbed(leaves, False), label)
    parts, at = [upper], _ROUND
    while width_at(largest, at) > 1:
        upper = written(_climbed(upper.where((F.col("level") == at) & (width_sql("n", at) > 1)), True), label)
        parts.append(upper)
        at += _ROUND
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    alone = leaves.where("n = 1").select("source", "n", "digest")
    top = nodes.where((F.col("place") == 0) & (F.col("level") >= 1) & (width_sql("n", F.col("level")) == 1))
    return nodes, alone.unionByName(top.select("source", "n", "digest"))


def width_sql(n: str, level: int | Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.ceil(F.col(n) / F.pow(F.lit(float(FAN_OUT)), level))


@dataclass(frozen=True)
class Manifest:
    """A dataset's trees, all as tables in the shared folder.

    ``leaves`` (doc_id, source, leaf, what ``build`` was asked to carry, place, n, rank, before) has the documents: ``n`` is the number of
    leaves of the source, ``rank`` its place among the sources and ``before`` the number of leaves of earlier ones. ``nodes`` (source, n, level, place,
    digest) has the block roots and all nodes above them, ``sources`` (source, n, rank, before, subroot) the leaves of the upper tree and ``upper`` (level,
    place, digest) all its nodes below the root.
    """

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    upper: DataFrame
    n_sources: int
    root: bytes | None


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, carried: dict[str, Column] | None = None) -> Manifest:
    """The trees of a table, over ``columns`` of its rows; ``carried`` names further values to keep with each leaf.

    Leaves go by doc_id, NULL first, then by digest; sources by code point, NULL first. Repeated rows are leaves like others. An empty
    table has no root. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    carried = carried or {}
    if {"doc_id", "source", "leaf", "place", "n", "rank", "before"} & set(carried):
        raise ValueError("a carried value has the name of a column of the manifest")
    rows = written(
        docs.select("doc_id", "source", leaf_of([F.col(c) for c in columns]).alias("leaf"), *[c.alias(n) for n, c in carried.items()]), "leaves"
    )
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    by_source = in_order(written(rows.groupBy("source").agg(F.count("*").alias("n")), "sources"), order[:1], "sources")
    ranked = running_before(by_source.withColumn("_one", F.lit(1)), [], ["_place"], "_part", "_one", "rank")
    ranked = written(running_before(ranked, [], ["_place"], "_part", "n", "before").select("source", "n", "rank", "before"), "sources")
    leaves = written(numbered(in_order(rows, order, "leaves"), ["source"], "place", ranked), "leaves")
    largest = ranked.agg(F.max("n")).first()[0] or 0
    nodes, roots = _tree(leaves.select("source", "n", F.lit(0).alias("level"), "place", F.col("leaf").alias("digest")), largest, "nodes")
    roots = roots.select(F.col("source").alias("_r"), F.col("digest").alias("subroot"))
    sources = written(ranked.join(roots.hint("merge"), F.col("source").eqNullSafe(F.col("_r"))).drop("_r"), "sources")
    n_sources = sources.count()
    # The upper tree is one tree: blocks as above, all of its nodes kept, the lowest ones included.
    lowest = sources.select(F.lit(0).alias("source"), F.lit(n_sources).cast("long").alias("n"), F.lit(0).alias("level"), F.col("rank").alias("place"), F.col("subroot").alias("digest"))
    parts, at = [lowest], 0
    while width_at(n_sources, at) > 1:
        parts.append(written(_climbed(parts[-1].where(F.col("level") == at), True), "upper"))
        at += _ROUND
    upper = parts[0]
    for part in parts[1:]:
        upper = upper.unionByName(part)
    top = height(n_sources)
    found = upper.where(F.col("level") == top).select("digest").take(1) if n_sources else []
    return Manifest(leaves, nodes, sources, upper.where(F.col("level") < top).select("level", "place", "digest"), n_sources, bytes(found[0][0]) if found else None)


# ------------------------------------------------------------------ proving
def _wanted(leaves: DataFrame, n_sources: int) -> DataFrame:
    """(range, tree, source, level, place): the coordinates that each range of leaves needs from elsewhere; NULL level where none."""
    kind = leaves.schema["source"].dataType.simpleString()
    held = leaves.groupBy("range", "source").agg(
        F.min("place").alias("first"), (F.max("place") + 1).alias("end"), F.first("n").alias("n"), F.first("rank").alias("rank")
    )

    def below(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r, source, first, end, n in zip(*(batch.column(c).to_pylist() for c in ("range", "source", "first", "end", "n"))):
                rows += [(r, "source", source, *at) for at in missing(first, end, n)]
            yield _coordinates(rows, batch.schema.field("source").type)

    def over(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r, first, end in zip(*(batch.column(c).to_pylist() for c in ("range", "first", "end"))):
                rows += [(r, "upper", None, *at) for at in missing(first, end, n_sources)]
            yield _coordinates(rows, batch.schema.field("source").type)

    schema = f"range long, tree string, source {kind}, level int, place long"
    ranks = held.groupBy("range").agg(F.min("rank").alias("first"), (F.max("rank") + 1).alias("end"), F.first("source").alias("source"))
    return held.select("range", "source", "first", "end", "n").mapInArrow(below, schema).unionByName(ranks.mapInArrow(over, schema))


def _coordinates(rows: list[tuple], source: pa.DataType) -> pa.RecordBatch:
    cells = list(zip(*rows)) or [[]] * 5
    kinds = (pa.int64(), pa.string(), source, pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=["range", "tree", "source", "level", "place"])


def prove(manifest: Manifest, claimed: str | None = None, with_proof: bool = False, leaves_at_once: int = LEAVES_AT_ONCE) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (digests as hexadecimal text).

    ``folded_root`` is the root that the carried digest ``claimed`` (default: the leaf itself; a NULL one too) gives with the leaf's
    proof, ``verified`` whether it is the root. ``proof_sha256`` is H of the proof's digests from the leaf's run up to the root's, left to
    right. ``with_proof`` adds the proof: for each level of both trees, the digests before and after the path's node.
    """
    ship(manifest.leaves.sparkSession)
    root, n_sources = manifest.root, manifest.n_sources
    given = F.coalesce(F.col(claimed), F.col("leaf")) if claimed else F.col("leaf")
    # Whole blocks in the order of all leaves, so many that some leaves_at_once leaves meet.
    block_start = F.col("before") + F.floor(F.col("place") / BLOCK) * BLOCK
    leaves = manifest.leaves.select(
        "doc_id", "source", "place", "n", "rank", "leaf", given.alias("claimed"), F.floor(block_start / leaves_at_once).alias("range")
    )
    wanted = written(_wanted(leaves, n_sources), "wanted")
    at = ("level", "place")
    lower = wanted.where("tree = 'source'").join(
        manifest.nodes.select(F.col("source").alias("_s"), *[F.col(c).alias(f"_{c}") for c in at], "digest"),
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("level") == F.col("_level")) & (F.col("place") == F.col("_place")),
    )
    upper = wanted.where("tree = 'upper'").join(
        manifest.upper.select(*[F.col(c).alias(f"_{c}") for c in at], "digest"),
        (F.col("level") == F.col("_level")) & (F.col("place") == F.col("_place")),
    )
    names = ["range", "tree", "source", *at, "digest"]
    fetched = lower.select(*names).unionByName(upper.select(*names))

    def expand(held: pa.Table, found: pa.Table) -> pa.Table:
        below: dict = {}
        over: dict[tuple[int, int], bytes] = {}
        for tree, source, level, place, digest in zip(*(found.column(c).to_pylist() for c in names[1:])):
            (over if tree == "upper" else below.setdefault(source, {}))[level, place] = digest
        held = held.sort_by([("rank", "ascending"), ("place", "ascending")])
        columns = {c: held.column(c).to_pylist() for c in ("doc_id", "source", "place", "n", "rank", "leaf", "claimed")}
        rank = np.array(columns["rank"], np.int64)
        starts = [*np.flatnonzero(np.diff(rank, prepend=-1)).tolist(), len(rank)]
        trees = [
            RangeTree(columns["place"][a], columns["leaf"][a:b], columns["n"][a], below.get(columns["source"][a], {})) for a, b in zip(starts, starts[1:])
        ]
        top = RangeTree(int(rank[0]), [t.root for t in trees], n_sources, over)
        rows = []
        for tree, a, b in zip(trees, starts, starts[1:]):
            rest = top.proof(int(rank[a]))
            rest_text = [d for before, after in rest for d in (*before, *after)]
            for i in range(a, b):
                steps = [*tree.proof(columns["place"][i]), *rest]
                flat = [d for before, after in steps[: tree.height] for d in (*before, *after)] + rest_text
                end = folded(columns["claimed"][i], steps)
                row = (columns["leaf"][i].hex(), tree.root.hex(), root.hex(), joined(flat).hex(), end.hex(), end == root)
                rows.append((*row, [{"before": x, "after": y} for x, y in steps]) if with_proof else row)
        made = pa.table(dict(zip(("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"), map(list, zip(*rows)))))
        made = made.add_column(0, "doc_id", held.column("doc_id"))
        if with_proof:
            step = pa.struct([("before", pa.list_(pa.binary())), ("after", pa.list_(pa.binary()))])
            made = made.append_column("proof", pa.array([r[-1] for r in rows], pa.list_(step)))
        return made

    kind = manifest.leaves.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if with_proof:
        schema += ", proof array<struct<before: array<binary>, after: array<binary>>>"
    return leaves.groupBy("range").cogroup(fetched.groupBy("range")).applyInArrow(expand, schema)
