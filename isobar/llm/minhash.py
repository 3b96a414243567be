"""Near duplicates: min-max hashing of word shingles, banded; every link confirmed on whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import lighten, ship, written
from isobar.llm.components import components

SHINGLE = 3
SIMILARITY = 85  # percent
PERMUTATIONS = 96
ROWS_PER_BAND = 6
_WORDS_AT_ONCE = 1 << 18
_U = np.uint64


def _multipliers(n: int) -> np.ndarray:
    """Odd 64-bit factors, the permutations, from a fixed seed."""
    return np.random.Generator(np.random.PCG64(9)).integers(0, 2**63, n, dtype=np.uint64) * _U(2) + _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def word_hashes(text: str | None) -> np.ndarray:
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def shingle_set(words: np.ndarray, length: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles, ascending; fewer words make one shingle, none make none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    length = min(length, len(words))
    total = np.full(len(words) - length + 1, _U(length))
    for i in range(length):
        total = _mixed(total + words[i : len(words) - length + 1 + i] * _U(0x9E3779B97F4A7C15 + 2 * i))
    return np.unique(total)


def min_max(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """Both ends of every set under every permutation: (sets, 2 * permutations), minimum before maximum."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    ends = np.empty((len(sets), 2 * len(factors)), np.uint64)
    for k, factor in enumerate(factors):
        permuted = flat * factor
        ends[:, 2 * k] = np.minimum.reduceat(permuted, starts)
        ends[:, 2 * k + 1] = np.maximum.reduceat(permuted, starts)
    return ends


def bands(ends: np.ndarray, rows: int = ROWS_PER_BAND) -> np.ndarray:
    """One hash for each band of ``rows`` signature values."""
    parts = ends.reshape(len(ends), -1, rows)
    total = np.tile(np.arange(parts.shape[1], dtype=np.uint64), (len(ends), 1))
    for i in range(rows):
        total = _mixed(total + parts[:, :, i])
    return total.view(np.int64)


def _set_hash(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sets(texts: list[str | None], length: int) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for text in texts:
        held.append(shingle_set(word_hashes(text), length))
        size += len(held[-1])
        if size > _WORDS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def signatures(docs: DataFrame, length: int = SHINGLE, permutations: int = PERMUTATIONS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit hash (h1, h2) and its bands, from whole texts; empty sets have no bands."""
    ship(docs.sparkSession)
    factors = _multipliers(permutations)

    def sign(batches) -> Iterator[pa.RecordBatch]:
        lighten()
        for batch in batches:
            at = 0
            for sets in _sets(batch.column("text").to_pylist(), length):
                ids = batch.column("doc_id").slice(at, len(sets)).cast(pa.int64())
                at += len(sets)
                full = [s for s in sets if len(s)]
                found = bands(min_max(full, factors), rows) if full else np.zeros((0, 1), np.int64)
                row = iter(found)
                hashes = np.frombuffer(b"".join(map(_set_hash, sets)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(hashes[:, 0]), pa.array(hashes[:, 1]),
                        pa.array([next(row) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


# ------------------------------------------------------------------ comparison with pivots
_ROWS_PER_SALT = 2_000
_BLOCK = 4_000


def _salted_stars(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (pivot, salt, node, n, shingles, is_pivot), a pivot's own set before the sets of its members.

    A pivot with very many members is dealt to several salts, each with a copy of the pivot's set.
    """
    counts = pairs.groupBy("pivot").agg(F.count("*").alias("_members"))
    salts = counts.select("pivot", F.ceil(F.col("_members") / _ROWS_PER_SALT).cast("int").alias("_salts"))
    members = pairs.join(salts, "pivot").select(
        "pivot", F.pmod(F.xxhash64("node"), F.col("_salts")).cast("int").alias("salt"), "node", F.lit(False).alias("is_pivot")
    )
    pivots = salts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt")).select(
        "pivot", "salt", F.col("pivot").alias("node"), F.lit(True).alias("is_pivot")
    )
    return members.unionByName(pivots).join(sets, "node")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For pairs (pivot, node): both sizes, the size of the intersection, and which of the pivot's shingles the node has.

    ``rest`` marks the node's other shingles by hash, in four bits for each shingle of the pivot. ``sets`` has (node, n, shingles).
    One set at a time is held beside the pivot's.
    """
    ship(pairs.sparkSession)

    def compare(batches) -> Iterator[pa.RecordBatch]:
        pivot, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(n).to_pylist() for n in ("pivot", "node", "is_pivot", "shingles")]
            for number, node, is_pivot, raw in zip(*columns):
                found = np.frombuffer(raw, np.uint64)
                if is_pivot:
                    pivot, own = number, found
                    continue
                if number != pivot:
                    raise ValueError(f"the set of pivot {number} is missing")
                at = np.minimum(np.searchsorted(own, found), len(own) - 1)
                same = own[at] == found
                mask, rest = np.zeros(len(own), bool), np.zeros(4 * len(own), bool)
                mask[at[same]] = True
                rest[_mixed(found[~same]) % _U(len(rest))] = True
                bits = [np.packbits(b).tobytes() for b in (mask, rest)]
                rows.append((number, node, len(own), len(found), int(same.sum()), *bits))
            kinds = [pa.int64()] * 5 + [pa.binary()] * 2
            cells = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cells, kinds)],
                names=["pivot", "node", "n_pivot", "n_node", "shared", "mask", "rest"],
            )

    dealt = _salted_stars(pairs, sets).repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", F.desc("is_pivot"), "node")
    return dealt.mapInArrow(
        compare, "pivot long, node long, n_pivot long, n_node long, shared long, mask binary, rest binary"
    )


def _linked(shared, n_a, n_b, percent: int):
    return shared * (100 + percent) >= percent * (n_a + n_b)


def _across(stars: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between members of a star in different components: (a, b, sure).

    What two members share is at least what both share with the pivot. Beyond it they share at most one shingle for each bit that
    both have in ``rest``, and as many more as one of them has shingles without a bit of their own. The first is enough for most links and
    the second against nearly all others; a pair in between is not sure. For a member at most one sure link to each component
    comes out. Large stars are compared block against block.
    """
    ship(stars.sparkSession)
    labelled = stars.join(labels, "node").select("pivot", "node", "component", F.col("n_node").alias("n"), "shared", "mask", "rest")
    groups = labelled.groupBy("pivot").agg(
        F.count("*").alias("_size"), (F.min("component") != F.max("component")).alias("_open")
    ).where("_open").select("pivot", F.ceil(F.col("_size") / _BLOCK).cast("int").alias("_blocks"))
    rows = labelled.join(groups, "pivot").withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.select(
        "pivot", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "node", "component", "n", "shared", "mask", "rest"
    )

    def compare(batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        for batch in batches:
            names = ("pivot", "i", "j", "_own", "node", "component", "n", "shared", "mask", "rest")
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if row[:3] != key:
                    if len(held) > 1:
                        yield from _block_links(held, percent)
                    held, key = [], row[:3]
                held.append(row)
        if len(held) > 1:
            yield from _block_links(held, percent)

    dealt = rows.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "node")
    return dealt.mapInArrow(compare, "a long, b long, sure boolean")


def _matrix(rows: list[bytes]) -> np.ndarray:
    """Bit strings of one length as rows of 64-bit words."""
    width = -(-len(rows[0]) // 8) * 8
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint64).reshape(len(rows), -1)


def _block_links(rows: list[tuple], percent: int) -> Iterator[pa.RecordBatch]:
    _, i, j, own, nodes, component, n, shared, masks, rests = (list(c) for c in zip(*rows))
    bits, others_bits = (_matrix(m) for m in (masks, rests))
    nodes, component, n, shared, own = (np.array(x, np.int64) for x in (nodes, component, n, shared, own))
    rest = n - shared
    crowded = rest - np.bitwise_count(others_bits).sum(axis=1).astype(np.int64)
    values, counts = np.unique(component, return_counts=True)
    if len(values) == 1:
        return
    # Members of the most frequent component need no row of their own: the others' rows meet them.
    todo = np.flatnonzero(component != values[counts.argmax()])
    done = np.zeros(len(rows), bool)
    links: list[tuple[int, int, bool]] = []
    for u in todo.tolist():
        done[u] = True
        others = (component != component[u]) & ~done
        if i[0] != j[0]:
            others &= own != own[u]
        v = np.flatnonzero(others)
        common = np.bitwise_count(bits[v] & bits[u]).sum(axis=1).astype(np.int64)
        sure = _linked(common, n[u], n[v], percent)
        seen, first = np.unique(component[v[sure]], return_index=True)
        links.extend((int(nodes[u]), int(x), True) for x in nodes[v[sure][first]])
        more = np.bitwise_count(others_bits[v] & others_bits[u]).sum(axis=1).astype(np.int64) + np.minimum(crowded[u], crowded[v])
        more = np.minimum(more, np.minimum(rest[u], rest[v]))
        open_ = _linked(common + more, n[u], n[v], percent) & ~np.isin(component[v], seen)
        links.extend((int(nodes[u]), int(x), False) for x in nodes[v[open_]])
    if links:
        a, b, known = zip(*links)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(known)], names=["a", "b", "sure"])


# ------------------------------------------------------------------ the operator
def _star_pairs(nodes: DataFrame) -> DataFrame:
    """(pivot, node): all members of a bucket with the one among them that meets most nodes over all its buckets.

    Such a node is near the middle of its neighbours: it links most of them by itself, and is the pivot of most of their buckets, so that
    a node has few pivots however many bands there are.
    """
    keys = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = keys.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(keys.join(sizes, ["band", "key"]), "buckets")
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    best = members.join(met, "node").groupBy("band", "key").agg(F.max(F.struct("met", (-F.col("node")).alias("minus"))).alias("best"))
    pivots = best.select("band", "key", (-F.col("best.minus")).alias("pivot"))
    return members.join(pivots, ["band", "key"]).where("node <> pivot").select("pivot", "node").distinct()


def _shingles_of(docs: DataFrame, nodes: DataFrame, length: int) -> DataFrame:
    """(node, n, shingles) of the texts that represent nodes (node, h1, h2)."""
    ship(docs.sparkSession)
    wanted = docs.select("doc_id", "text").join(nodes, F.col("doc_id") == F.col("node"))

    def collect(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text, h1, h2 in zip(*(batch.column(n).to_pylist() for n in ("node", "text", "h1", "h2"))):
                found = shingle_set(word_hashes(text), length)
                if np.array([h1, h2], np.int64).tobytes() == _set_hash(found):  # rows can share an id
                    rows.append((node, len(found), found.tobytes()))
            cells = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cells, (pa.int64(), pa.int64(), pa.binary()))], names=["node", "n", "shingles"]
            )

    found = wanted.select("node", "text", "h1", "h2").mapInArrow(collect, "node long, n long, shingles binary")
    return found.groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))


def near_duplicates(
    docs: DataFrame, length: int = SHINGLE, percent: int = SIMILARITY,
    permutations: int = PERMUTATIONS, rows: int = ROWS_PER_BAND,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A text's set has its distinct shingles of ``length`` words (split at ASCII white space, A-Z lower-cased); a shorter text is one shingle,
    one without words has the empty set and no links. Texts are linked when 100 * shared >= ``percent`` * united, decided on
    whole sets of 64-bit shingle hashes. ``component_id`` is the smallest doc_id reachable over links.

    Equal sets are grouped first. The members of a bucket that share a band are compared with its most central one, the pivot; then the
    members of different components below one pivot with each other. Two texts at 85 % share none of 32 bands once in some 4 million
    times; such a link would be missed unless others join the two.

    A NULL doc_id loses to any other; rows that have only NULL ids in their group have a NULL component_id and stay. Rows with one
    doc_id are one document: their links are joined, and they stay or go together. An empty table gives no rows.
    """
    signed = written(signatures(docs, length, permutations, rows), "signatures")
    groups = signed.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("node"), F.first("bands").alias("bands")
    )
    nodes = written(groups.where("node IS NOT NULL"), "sets")
    pairs = written(_star_pairs(nodes), "pairs")
    used = pairs.select(F.col("node").alias("_used")).union(pairs.select("pivot")).distinct()
    hashes = nodes.select("node", "h1", "h2").join(used, F.col("node") == F.col("_used"), "left_semi")
    sets = written(_shingles_of(docs, hashes, length), "shingles")
    stars = written(compared(pairs, sets), "stars")
    direct = stars.where(_linked(F.col("shared"), F.col("n_pivot"), F.col("n_node"), percent)).select(
        F.col("pivot").alias("a"), F.col("node").alias("b")
    )
    # Nodes without a link keep a label of their own: a link to itself.
    alone = sets.select(F.col("node").alias("a"), F.col("node").alias("b"))
    labels = components(direct.unionByName(alone))
    across = written(_across(stars, labels, percent), "across")
    unsure = compared(across.where("NOT sure").select(F.col("a").alias("pivot"), F.col("b").alias("node")).distinct(), sets)
    confirmed = unsure.where(_linked(F.col("shared"), F.col("n_pivot"), F.col("n_node"), percent)).select(
        F.col("pivot").alias("a"), F.col("node").alias("b")
    )
    # Components of components: what is linked already is one node now.
    more = across.where("sure").select("a", "b").unionByName(confirmed)
    as_label = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    joined = more.join(as_label("a"), "a").join(as_label("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    final = components(joined).withColumnRenamed("node", "_label").withColumnRenamed("component", "_final")
    labels = labels.join(final, F.col("component") == F.col("_label"), "left").select(
        F.col("node").alias("_node"), F.coalesce("_final", "component").alias("component")
    )
    groups = nodes.select("h1", "h2", "node").join(labels, F.col("node") == F.col("_node"), "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.coalesce("component", "node").alias("component_id")
    )
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("n_shingles") > 0)
    result = signed.select("doc_id", "n_shingles", "h1", "h2").join(groups, same, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
