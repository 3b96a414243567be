"""Repeated lines: exact reference tables with sharded cuckoo filters before them, reversible document by document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.common import ship, written

BLANK = " \t\n\x0b\x0c\r"
LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
KEYS_PER_SHARD = 1 << 20
#: So many lines at most, on average, meet one copy of a shard's filter.
LINES_PER_COPY = 1 << 20
_SLOTS = 4
_KICKS = 500
_KEY = ["h1", "h2"]
_FILTER_SCHEMA = "shard int, n_keys long, slots binary"
_REFS_SCHEMA = "h1 long, h2 long, doc_id long, row long"


# ------------------------------------------------------------------ cuckoo filter
class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key is in one of two buckets. Only what was inserted may be deleted."""

    def __init__(self, n_keys: int, slots=None):
        buckets = 1 << max(0, (int(n_keys / 0.8) // _SLOTS).bit_length())
        held = np.zeros(buckets * _SLOTS, np.uint16) if slots is None else np.frombuffer(slots, np.uint16).copy()
        self.slots = held.reshape(-1, _SLOTS)

    @staticmethod
    def places(h1: np.ndarray, h2: np.ndarray, buckets: np.ndarray | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets; ``buckets`` is a power of two (or one for each key)."""
        h1, h2 = np.asarray(h1).astype(np.uint64), np.asarray(h2).astype(np.uint64)
        mark = (h2 & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        mask = np.asarray(buckets, np.int64) - 1
        first = (h1 >> np.uint64(20)).astype(np.int64) & mask
        return mark, first, first ^ (mark.astype(np.int64) * 0x5BD1E995 & mask)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """False if a key finds no place: the filter has to be made larger, from the exact table."""
        mask = len(self.slots) - 1
        for mark, first, second in zip(*(x.tolist() for x in self.places(h1, h2, len(self.slots)))):
            at = first
            for kick in range(_KICKS):
                free = [i for b in {at, second} for i in [(b, int(np.argmin(self.slots[b])))] if self.slots[i] == 0]
                if free:
                    self.slots[free[0]] = mark
                    break
                slot = kick % _SLOTS
                mark, self.slots[at, slot] = int(self.slots[at, slot]), mark
                at = second = at ^ (mark * 0x5BD1E995 & mask)
            else:
                return False
        return True

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        for mark, first, second in zip(*(x.tolist() for x in self.places(h1, h2, len(self.slots)))):
            for bucket in (first, second):
                found = np.flatnonzero(self.slots[bucket] == mark)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        mark, first, second = self.places(h1, h2, len(self.slots))
        return ((self.slots[first] == mark[:, None]) | (self.slots[second] == mark[:, None])).any(axis=1)

    def bytes(self) -> bytes:
        return self.slots.tobytes()


def _with_keys(n_keys: int, h1: np.ndarray, h2: np.ndarray) -> CuckooFilter:
    """A filter that holds all the keys, as large as that needs."""
    while True:
        made = CuckooFilter(n_keys)
        if made.insert(h1, h2):
            return made
        n_keys = n_keys * 2 + 1


# ------------------------------------------------------------------ lines and keys
def line_keys(text: str | None, least_length: int = LEAST_LENGTH) -> tuple[list[str], list[bytes | None]]:
    """Lines of a text and, of those long enough, 128-bit hashes of their keys (stripped, A-Z lower-cased)."""
    lines = (text or "").split("\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip(BLANK)
        long = len(key) >= least_length
        keys.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()) if long else None)
    return lines, keys


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def line_refs(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(h1, h2, doc_id, row) for each row and distinct key in it; ``row`` is a hash of the text, which tells rows of one id apart."""
    spark = docs.sparkSession
    ship(spark)

    def refs(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            counts = []
            for text in batch.column("text").to_pylist():
                keys = set(line_keys(text, least_length)[1])
                keys.discard(None)
                found.extend(sorted(keys))
                counts.append(len(keys))
            h1, h2 = _halves(found)
            held = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            ids = batch.column("doc_id").cast(pa.int64()).take(held)
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), ids, batch.column("row").take(held)], names=[*_KEY, "doc_id", "row"])

    return docs.select("doc_id", "text", _row_hash().alias("row")).mapInArrow(refs, _REFS_SCHEMA)


def _row_hash() -> Column:
    return F.xxhash64("text")


def _updated(filters: DataFrame, changes: DataFrame, repeated: DataFrame, shards: int) -> DataFrame:
    """Each shard's filter after its keys have changed; rebuilt from the exact table's keys where there is none or it is full."""
    ship(changes.sparkSession)
    shard = F.pmod("h1", F.lit(shards)).cast("int").alias("shard")
    rows = (
        changes.select(shard, *_KEY, F.when(F.col("enters"), 1).otherwise(2).alias("kind"), F.lit(None).cast("binary").alias("slots"))
        .unionByName(repeated.select(shard, *_KEY, F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("slots")))
        .unionByName(filters.select("shard", F.lit(None).cast("long").alias("h1"), F.lit(None).cast("long").alias("h2"), F.lit(3).alias("kind"), "slots"))
    )

    def update(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        h1, h2 = (table.column(n).fill_null(0).to_numpy() for n in _KEY)
        old = [x for x in table.column("slots").to_pylist() if x is not None]
        keys = kind == 0
        made = None
        if old:
            made = CuckooFilter(0, old[0])
            made.delete(h1[kind == 2], h2[kind == 2])
            if not made.insert(h1[kind == 1], h2[kind == 1]):
                made = None
        if made is None:
            made = _with_keys(int(keys.sum()), h1[keys], h2[keys])
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "n_keys": pa.array([int(keys.sum())], pa.int64()),
            "slots": pa.array([made.bytes()], pa.binary()),
        })

    return rows.groupBy("shard").applyInArrow(update, _FILTER_SCHEMA)


@dataclass(frozen=True)
class LineIndex:
    """A version of the index: which documents hold which keys, and the keys that are repeated.

    ``refs`` (h1, h2, doc_id, row) is the exact reference table; ``repeated`` (h1, h2, n_docs, owner) has the counts of keys in at least
    ``least_documents`` documents, and the largest doc_id among them; ``filters`` has a cuckoo filter over these keys for each shard. Shards
    are doubled when their keys are more than ``keys_per_shard`` on average. All are tables in the shared folder. ``insert`` and ``remove`` give
    a new version and leave this one as it is; removing what was inserted gives back the results of before.
    """

    refs: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int
    least_length: int = LEAST_LENGTH
    least_documents: int = LEAST_DOCUMENTS
    keys_per_shard: int = KEYS_PER_SHARD

    @staticmethod
    def empty(
        spark: SparkSession, shards: int = 16, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS,
        keys_per_shard: int = KEYS_PER_SHARD,
    ) -> LineIndex:
        return LineIndex(
            spark.createDataFrame([], _REFS_SCHEMA),
            spark.createDataFrame([], "h1 long, h2 long, n_docs long, owner long"),
            spark.createDataFrame([], _FILTER_SCHEMA),
            shards, least_length, least_documents, keys_per_shard,
        )

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents. A row is a document; rows that share a doc_id count as several."""
        added = written(line_refs(docs, self.least_length), "line-refs")
        return self._changed(self.refs.unionByName(added), added)

    def remove(self, docs: DataFrame) -> LineIndex:
        """Take out all that is known of the doc_ids in ``docs`` (NULL ids together)."""
        gone = docs.select(F.col("doc_id").alias("_gone")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("_gone"))
        removed = written(self.refs.join(gone, same, "left_semi"), "line-refs-gone")
        left = written(self.refs.join(gone, same, "left_anti"), "line-refs")
        return self._changed(left, removed)

    def _changed(self, refs: DataFrame, touched: DataFrame) -> LineIndex:
        first = self.repeated.isEmpty() and self.filters.isEmpty()
        keys = touched.select(*_KEY).distinct()
        counted = refs if first else refs.join(keys, _KEY, "left_semi")
        now = counted.groupBy(*_KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("owner"))
        now = written(now.where(F.col("n_docs") >= self.least_documents), "line-counts")
        if first:
            repeated, entered, left = now, now, now.limit(0)
        else:
            repeated = written(self.repeated.join(keys, _KEY, "left_anti").unionByName(now), "line-repeated")
            entered = now.join(self.repeated, _KEY, "left_anti")
            left = self.repeated.join(keys, _KEY, "left_semi").join(now, _KEY, "left_anti")
        shards, n_keys = self.shards, repeated.count()
        while n_keys > shards * self.keys_per_shard:
            shards *= 2
        old = self.filters
        if shards > self.shards:  # other shards: all are made anew from the exact table
            old, entered, left = old.limit(0), now.limit(0), now.limit(0)
        changes = entered.select(*_KEY, F.lit(True).alias("enters")).unionByName(left.select(*_KEY, F.lit(False).alias("enters")))
        filters = written(_updated(old, changes, repeated, shards), "line-filters")
        return replace(self, refs=refs, repeated=repeated, filters=filters, shards=shards)

    def _maybe_repeated(self, refs: DataFrame) -> DataFrame:
        """Those of ``refs``, a written table, whose key the filter of its shard may hold.

        Lines are dealt by shard, and in a large table by several parts of a shard, so that a line that many documents share is
        not in one task. A task reads the copy of the filter first and then tests the lines as they come.
        """
        ship(refs.sparkSession)
        copies = max(1, -(-refs.count() // (self.shards * LINES_PER_COPY)))
        lines = refs.select(
            F.pmod("h1", F.lit(self.shards)).cast("int").alias("shard"), F.pmod(F.xxhash64("doc_id", "row"), F.lit(copies)).cast("int").alias("part"),
            F.lit(None).cast("binary").alias("slots"), *_KEY, "doc_id", "row",
        )
        held = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("part"), "slots",
            *[F.lit(None).cast("long").alias(c) for c in (*_KEY, "doc_id", "row")],
        )

        def test(batches) -> Iterator[pa.RecordBatch]:
            shard, held = None, None
            for batch in batches:
                shards = batch.column("shard").to_numpy()
                slots = batch.column("slots")
                starts = np.flatnonzero(slots.is_valid().to_numpy(zero_copy_only=False)).tolist()
                h1, h2 = (batch.column(c).fill_null(0).to_numpy() for c in _KEY)
                kept = np.zeros(batch.num_rows, bool)
                for begin, end in zip([-1, *starts], [*starts, batch.num_rows]):
                    if begin >= 0:
                        shard, held = shards[begin], CuckooFilter(0, slots[begin].as_buffer())
                    own = np.arange(begin + 1, end)
                    own = own[shards[begin + 1 : end] == shard] if shard is not None else own[:0]
                    if len(own):
                        kept[own] = held.contains(h1[own], h2[own])
                chosen = pa.array(np.flatnonzero(kept))
                yield pa.RecordBatch.from_arrays([batch.column(c).take(chosen) for c in (*_KEY, "doc_id", "row")], names=[*_KEY, "doc_id", "row"])

        dealt = held.unionByName(lines).repartition("shard", "part")
        # The filter comes first: its slots are not NULL.
        return dealt.sortWithinPartitions("shard", "part", F.col("slots").isNull()).mapInArrow(test, _REFS_SCHEMA)

    def dropped(self, docs: DataFrame) -> DataFrame:
        """(doc_id, row, keys): keys whose lines a row loses, with both halves of each."""
        return self._lost(written(line_refs(docs, self.least_length), "line-refs"))

    def _lost(self, refs: DataFrame) -> DataFrame:
        """``dropped`` of the rows that a table of line references is of."""
        hits = self._maybe_repeated(refs).join(self.repeated.select(*_KEY, "owner"), _KEY)
        lost = hits.where(~F.col("doc_id").eqNullSafe(F.col("owner")))
        return lost.groupBy("doc_id", "row").agg(F.collect_set(F.struct(*_KEY)).alias("keys"))

    def clean(self, docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
        """Per row of ``docs``: doc_id, n_lines, n_dropped, and the text that stays.

        A repeated key loses all its lines but those in the holder with the largest doc_id. NULL text is one empty line. A NULL
        doc_id loses to any other; rows that share the owner's doc_id all keep the lines, and keys held by NULL ids alone stay.
        ``refs`` are the rows' references where they are at hand.
        """
        ship(docs.sparkSession)
        least_length = self.least_length
        lost = (self.dropped(docs) if refs is None else self._lost(refs)).withColumnsRenamed({"doc_id": "_lost_id", "row": "_lost_row"})
        rows = docs.select("doc_id", "text", _row_hash().alias("row")).join(
            lost, F.col("doc_id").eqNullSafe(F.col("_lost_id")) & (F.col("row") == F.col("_lost_row")), "left"
        )

        def strip(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lines_in, dropped, texts = [], [], []
                for text, gone in zip(batch.column("text").to_pylist(), batch.column("keys").to_pylist()):
                    lines, keys = line_keys(text, least_length) if gone else ((text or "").split("\n"), None)
                    lost_keys = {np.array([k["h1"], k["h2"]], np.int64).tobytes() for k in gone or ()}
                    kept = [line for line, key in zip(lines, keys) if key not in lost_keys] if gone else lines
                    lines_in.append(len(lines))
                    dropped.append(len(lines) - len(kept))
                    texts.append("\n".join(kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(lines_in, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
                    names=["doc_id", "n_lines", "n_dropped", "text"],
                )

        return rows.select("doc_id", "text", "keys").mapInArrow(strip, "doc_id long, n_lines long, n_dropped long, text string")


def dedup_lines(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Index a table and clean it: doc_id, n_lines, n_dropped, text. An empty table gives no rows."""
    index = LineIndex.empty(docs.sparkSession, shards).insert(docs)
    return index.clean(docs, index.refs)
