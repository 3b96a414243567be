"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import block_of, blocks_for, running_before, written

_BITS = 11  # of the priority, looked at per level


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(position, shard) around the ring, ascending; positions have 31 bits and depend on shard and node alone."""
    def position(shard: int, node: int) -> int:
        return int.from_bytes(hashlib.sha256(f"{shard}:{node}".encode()).digest()[:4], "big") >> 1

    return sorted((position(s, v), s) for s in range(shards) for v in range(virtual_nodes))


def _with_arc(df: DataFrame, starts: list[int]) -> DataFrame:
    """Turn ``position`` into ``arc``: the index of the first ring point at or after it, by binary search.

    A column per step, so that no step repeats the ones before it.
    """
    points = F.array(*[F.lit(p) for p in starts])
    df = df.withColumn("arc", F.lit(0))
    step = 1 << (len(starts).bit_length() - 1)
    while step:
        here = F.col("arc") + step
        inside = (here <= len(starts)) & (F.get(points, here - 1) < F.col("position"))
        df = df.withColumn("arc", F.when(inside, here).otherwise(F.col("arc")))
        step >>= 1
    return df.withColumn("arc", F.col("arc") % len(starts)).drop("position")


def _owners(points: list[tuple[int, int]], full: frozenset[int]) -> list[int]:
    """The first shard that is not full, clockwise from each point."""
    owners, owner = [-1] * len(points), -1
    for i in range(2 * len(points) - 1, -1, -1):
        shard = points[i % len(points)][1]
        owner = shard if shard not in full else owner
        owners[i % len(points)] = owner
    return owners


def assign(docs: DataFrame, shards: int = 8, virtual_nodes: int = 64, law: str = "rows", slack: float = 0.0) -> DataFrame:
    """Put every row into a shard: doc_id, size, text_crc32, shard, slot.

    A document's place on the ring is the hash of its doc_id; it goes to the first shard clockwise that still has room. Documents arrive
    in order of a random priority. What a shard may hold is its share of the rows (law ``rows``) or bytes (``bytes``)
    times 1 + ``slack``. With ``rows`` and no slack shares are whole numbers at most one apart, so counts are too; more slack moves
    fewer rows when the number of shards changes. By ``bytes`` a shard takes documents until its share is reached.

    Which shard is full matters only from the priority at which it fills up: after that its arcs belong to the next
    shards clockwise. So the placement of all rows follows from at most one priority per shard. Each is found by sums over
    priority bins, refined level by level; rows are never gathered.

    ``size`` is the number of UTF-8 bytes plus 1, NULL text has none. Rows with NULL or repeated doc_ids are placed like others; equal
    rows share ring place and priority, and are told apart by position only where a shard fills among them. ``slot`` numbers the rows of
    a shard from 0 without a gap.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"no such law: {law}")
    points = ring_points(shards, virtual_nodes)
    raw = F.encode("text", "UTF-8")
    compact = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.lit(b""))).alias("text_crc32"),
        F.xxhash64(F.lit(1), "doc_id", F.crc32(raw)).alias("first"),
        F.shiftrightunsigned(F.xxhash64(F.lit(2), "doc_id"), 33).cast("int").alias("position"),
    )
    # Priorities are made unique, so that a shard fills at one row: rows with equal keys get new ones by their rank.
    same = Window.partitionBy("first").orderBy("doc_id", "size", "text_crc32")
    compact = compact.withColumn("rank", F.row_number().over(same)).select(
        "doc_id", "size", "text_crc32",
        F.when(F.col("rank") == 1, F.col("first")).otherwise(F.xxhash64("first", "rank")).alias("priority"),
        "position",
    )
    compact = _with_arc(compact, [p for p, _ in points])
    compact = written(compact.withColumn("weight", F.lit(1).cast("long") if law == "rows" else F.col("size")), "ring")
    total, rows = compact.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.count("*")).first()
    room = [(total // shards + (s < total % shards)) * 1.0 for s in range(shards)]
    room = [r + int(r * slack) for r in room]
    epochs = _epochs(compact, points, room)
    placed = _placed(compact, epochs)
    blocks = blocks_for(rows)
    numbered = running_before(
        placed.withColumn("block", block_of(F.col("priority"), blocks)).withColumn("one", F.lit(1).cast("long")),
        ["shard"], ["priority"], "block", "one", "slot",
    )
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot")


def _epochs(rows: DataFrame, points: list[tuple[int, int]], room: list[float]) -> list[tuple[int | None, list[int]]]:
    """[(last priority of the epoch, owner of each arc)]; the last epoch has no end."""
    epochs: list[tuple[int | None, list[int]]] = []
    full: frozenset[int] = frozenset(s for s, r in enumerate(room) if r <= 0)
    left = dict(enumerate(room))
    since: int | None = None
    while True:
        if len(full) >= len(room) - 1 or len(full) == len(room):
            full = full if len(full) < len(room) else frozenset()
            epochs.append((None, _owners(points, full)))
            return epochs
        owners = _owners(points, full)
        found = _first_full(rows, owners, left, since)
        epochs.append((found[0] if found else None, owners))
        if not found:
            return epochs
        since, taken = found
        for shard, weight in taken.items():
            left[shard] -= weight
        full = full | {s for s in left if left[s] <= 0}


def _first_full(rows: DataFrame, owners: list[int], left: dict[int, float], since: int | None) -> tuple[int, dict[int, int]] | None:
    """The priority at which a shard's room is used up, and what each shard takes until then, from ``since`` on.

    Each level groups the rows under one prefix of the priority by its next bits and the shards: at most 2,048 rows per
    shard come back.
    """
    ordered = F.col("priority").bitwiseXOR(F.lit(-(2**63)))  # unsigned order is the priorities' order
    rows = rows if since is None else rows.where(F.col("priority") > since)
    rows = rows.withColumn("shard", _owner(owners)).withColumn("ordered", ordered)
    base: dict[int, int] = {}
    prefix, shift = 0, 64
    while True:
        here = rows if shift == 64 else rows.where(F.shiftrightunsigned("ordered", shift) == prefix)
        shift = max(0, shift - _BITS)
        sums = here.groupBy(F.shiftrightunsigned("ordered", shift).alias("bin"), "shard").agg(
            F.sum("weight").alias("weight"), F.count("*").alias("n"), F.min("priority").alias("priority")
        ).collect()
        bins: dict[int, list] = {}
        for row in sums:
            bins.setdefault(row["bin"] % 2**64, []).append(row)
        for prefix in sorted(bins):
            after = dict(base)
            for row in bins[prefix]:
                after[row["shard"]] = after.get(row["shard"], 0) + row["weight"]
            if any(after[row["shard"]] >= left[row["shard"]] for row in bins[prefix]):
                if sum(row["n"] for row in bins[prefix]) == 1 or shift == 0:
                    return bins[prefix][0]["priority"], after
                break
            base = after
        else:
            return None


def _owner(owners: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in owners]), F.col("arc") + 1)


def _placed(rows: DataFrame, epochs: list[tuple[int | None, list[int]]]) -> DataFrame:
    shard = None
    for end, owners in reversed(epochs):
        shard = _owner(owners) if shard is None else F.when(F.col("priority") <= end, _owner(owners)).otherwise(shard)
    return rows.withColumn("shard", shard)


def place_of(position: int, points: list[tuple[int, int]]) -> int:
    """The arc of a position, for tests."""
    return bisect_left([p for p, _ in points], position) % len(points)
