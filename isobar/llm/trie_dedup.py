"""Exact duplicates: texts meet in radix tries whose terminal nodes hold the row that stays."""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import ship

MOST_TRIE_BYTES = 128 << 20
_NODE_BYTES = 250  # besides its label
_BATCH_BYTES = 8 << 20
_TEXT_SCHEMA = "n_bytes long, digest binary, text binary, keep_id long, group_size long"
_OWNER_SCHEMA = "n_bytes long, digest binary, keep_id long, group_size long"


def normalised(text: str | None) -> bytes:
    """UTF-8 of a text with A-Z lower-cased and nothing else; NULL is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


class _Node:
    __slots__ = ("label", "children", "owner", "spill")

    def __init__(self, label: bytes, owner: list | None = None):
        self.label, self.owner = label, owner  # owner: [id, count, digest]
        self.children: dict[int, _Node] = {}
        self.spill = None


def _common(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` stand in ``b`` at ``at``, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Whole byte strings to [owner, count, digest], within a bound on memory.

    Beyond ``most_bytes`` the largest subtree below the root goes to a file, and so does what comes for it later; when
    everything else has been read out, each file becomes a trie of its own, whose keys are shorter by the subtree's
    label. Files are removed as they are read. ``better(a, b)`` says whether owner a replaces owner b.
    """

    def __init__(self, better, most_bytes: int = MOST_TRIE_BYTES):
        self.better, self.most_bytes = better, most_bytes
        self.root, self.bytes = _Node(b""), 0

    def _merge(self, node: _Node, owner: list) -> None:
        if node.owner is None:
            node.owner = list(owner)
        else:
            if self.better(owner[0], node.owner[0]):
                node.owner[0] = owner[0]
            node.owner[1] += owner[1]

    def insert(self, key: bytes, owner: list) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                pickle.dump((key[at:], owner), node.spill)
                return
            if at == len(key):
                return self._merge(node, owner)
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = _Node(key[at:], list(owner))
                self.bytes += len(key) - at + _NODE_BYTES
                break
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            common = _common(child.label, key, at)
            upper = _Node(child.label[:common])
            child.label = child.label[common:]
            upper.children[child.label[0]] = child
            node.children[key[at]] = upper
            self.bytes += _NODE_BYTES
            node, at = upper, at + common
        if self.bytes > self.most_bytes:
            self._spill_largest()

    def _size(self, node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            n = stack.pop()
            total += len(n.label) + _NODE_BYTES
            stack.extend(n.children.values())
        return total

    def _spill_largest(self) -> None:
        parent, best = self.root, None
        while True:  # from the root down, until it branches into what can be told apart
            resident = [c for c in parent.children.values() if c.spill is None]
            if not resident:
                return
            best = max(resident, key=self._size)
            if len(resident) > 1 or best.owner is not None or not best.children:
                break
            parent = best
        self.bytes -= self._size(best) - len(best.label) - _NODE_BYTES
        file = tempfile.TemporaryFile(dir=os.environ.get("TMPDIR"))
        for key, owner in self._walk(best, b"", skip_label=True):
            pickle.dump((key, owner), file)
        best.children, best.owner, best.spill = {}, None, file

    def _walk(self, top: _Node, prefix: bytes, skip_label: bool = False) -> Iterator[tuple[bytes, list]]:
        """Resident keys below a node, then those in files."""
        stack = [(top, prefix if skip_label else prefix + top.label)]
        spilled = []
        while stack:
            node, key = stack.pop()
            if node.spill is not None:
                spilled.append((node, key))
                continue
            if node.owner is not None:
                yield key, node.owner
            stack.extend((c, key + c.label) for c in node.children.values())
        for node, key in spilled:
            part = PatriciaTrie(self.better, self.most_bytes)
            node.spill.seek(0)
            while True:
                try:
                    suffix, owner = pickle.load(node.spill)
                except EOFError:
                    break
                part.insert(suffix, owner)
            node.spill.close()
            yield from part._walk(part.root, key)

    def items(self) -> Iterator[tuple[bytes, list]]:
        """(key, [owner, count, digest]) of every key; the trie is used up."""
        yield from self._walk(self.root, b"")


def _larger(a: int | None, b: int | None) -> bool:
    return a is not None and (b is None or a > b)


def _smaller(a: int | None, b: int | None) -> bool:
    return a is not None and (b is None or a < b)


def _batches(rows, names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def exact_groups(docs: DataFrame, keep: str = "smallest", most_bytes: int = MOST_TRIE_BYTES) -> DataFrame:
    """Groups of equal normalised texts, a row per text: n_bytes, digest (SHA-256), keep_id, group_size.

    Each task first puts its own rows into a trie, so a text comes out of a task once however often it is there. These texts are
    dealt by length and content hash, and meet, in full, in the tries of the second step.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"no such choice: {keep}")
    ship(docs.sparkSession)
    better = _smaller if keep == "smallest" else _larger

    def local(batches):
        trie = PatriciaTrie(better, most_bytes)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                trie.insert(normalised(text), [doc_id, 1, None])
        rows = ((len(k), hashlib.sha256(k).digest(), k, o[0], o[1]) for k, o in trie.items())
        names = ["n_bytes", "digest", "text", "keep_id", "group_size"]
        yield from _batches(rows, names, [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()])

    def meet(batches):
        trie = PatriciaTrie(better, most_bytes)
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("text", "keep_id", "group_size", "digest")]
            for text, owner, count, digest in zip(*columns):
                trie.insert(text, [owner, count, digest])
        seen: set[bytes] = set()

        def rows():
            for key, (owner, count, digest) in trie.items():
                if digest in seen:
                    raise ValueError("two texts have one SHA-256")  # results could not be told apart
                seen.add(digest)
                yield len(key), digest, owner, count

        yield from _batches(rows(), ["n_bytes", "digest", "keep_id", "group_size"], [pa.int64(), pa.binary(), pa.int64(), pa.int64()])

    texts = docs.select("doc_id", "text").mapInArrow(local, _TEXT_SCHEMA)
    return texts.repartition("n_bytes", "digest").mapInArrow(meet, _OWNER_SCHEMA)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and digest of each row's normalised text."""
    ship(docs.sparkSession)

    def digest(batches):
        for batch in batches:
            texts = [normalised(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "digest"],
            )

    return docs.select("doc_id", "text").mapInArrow(digest, "doc_id long, n_bytes long, digest binary")


def exact_dedup(docs: DataFrame, keep: str = "smallest", most_bytes: int = MOST_TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty. The row with the smallest or largest doc_id of a
    group stays. A NULL doc_id loses to any other; if a group has no other, all its rows stay. Rows that share a group's
    kept doc_id all stay. An empty table gives no rows. Only doc_id and text are read.
    """
    groups = exact_groups(docs, keep, most_bytes)
    joined = digests(docs).join(groups, ["n_bytes", "digest"])
    return joined.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
