"""Benchmark decontamination: an FM-index over the words of each shard of documents, searched for all phrases at once.

The alphabet of an index is the benchmark's vocabulary. Any other word ends a stretch, and stretches shorter than the
shortest phrase cannot hold one, so neither is indexed; equal stretches of a shard are indexed once.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import lighten, shared_folder, ship

WINDOW = 10
SHARD_WORDS = 1 << 19
LONGEST_STRETCH = 1 << 12
MOST_BLOCK_WORDS = 1 << 20
SAMPLE_EVERY = 16
_TEXTS_AT_ONCE = 2_000
_OCCURRENCES_AT_ONCE = 1 << 20

# A-Z to lower case, all other ASCII but digits and a-z to a space.
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


# The same words in a text that is not lower-cased.
_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


# ------------------------------------------------------------------ index
class WaveletMatrix:
    """Ranks of symbols in an array, by one bit of the symbols per level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[int, int, np.ndarray]] = []  # shift, number of zeros, ones before each place
        for shift in range(bits - 1, -1, -1):
            bit = (symbols >> shift) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((shift, len(symbols) - int(ones[-1]), ones))
            high = bit.astype(bool)
            symbols = np.concatenate([symbols[~high], symbols[high]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start, end = np.zeros_like(before), before
        for shift, zeros, ones in self.levels:
            high = ((symbol >> shift) & 1).astype(bool)
            start = np.where(high, zeros + ones[start], start - ones[start])
            end = np.where(high, zeros + ones[end], end - ones[end])
        return end - start

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbol = np.zeros_like(place)
        start, end = np.zeros_like(place), place
        for shift, zeros, ones in self.levels:
            high = (ones[end + 1] - ones[end]).astype(bool)
            symbol |= high.astype(symbol.dtype) << shift
            start = np.where(high, zeros + ones[start], start - ones[start])
            end = np.where(high, zeros + ones[end], end - ones[end])
        return symbol, end - start


class FMIndex:
    """Stretches of symbols 1..n, each ended by a 0; the ends order by position, so no comparison goes past one."""

    def __init__(self, stretches: list[np.ndarray], n_symbols: int):
        lengths = np.array([len(s) + 1 for s in stretches])
        self.starts = np.cumsum(lengths) - lengths
        text = np.zeros(int(lengths.sum()), np.int64)
        for start, stretch in zip(self.starts.tolist(), stretches):
            text[start : start + len(stretch)] = stretch
        order = self._suffix_order(text)
        sampled = np.zeros(len(text), bool)
        sampled[::SAMPLE_EVERY] = True
        sampled[self.starts] = True
        self.marks = sampled[order]
        self.marks_before = np.cumsum(self.marks) - self.marks
        self.samples = order[self.marks]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.matrix = WaveletMatrix(text[order - 1], max(1, int(n_symbols).bit_length()))

    @staticmethod
    def _suffix_order(text: np.ndarray) -> np.ndarray:
        """Suffix array by doubling the length that ranks stand for."""
        n = len(text)
        ends = text == 0
        key = text + ends.sum()
        key[ends] = np.arange(int(ends.sum()))
        reach = 1
        while True:
            order = np.argsort(key, kind="stable")
            new = key[order]
            steps = np.concatenate([[0], np.cumsum(new[1:] != new[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = steps
            if steps[-1] == n - 1:
                return order
            after = np.zeros(n, np.int64)
            after[: n - reach] = rank[reach:]  # ends are unique: what lies beyond one is never decisive
            key = rank * n + after
            reach *= 2

    def find(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges of all phrases (rows, padded at the right) by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), int(self.first[-1]), np.int64)
        alive = np.arange(len(phrases))
        for step in range(int(lengths.max(initial=0))):
            alive = alive[(lengths[alive] > step) & (high[alive] > low[alive])]
            symbol = phrases[alive, lengths[alive] - 1 - step]
            low[alive] = self.first[symbol] + self.matrix.rank(symbol, low[alive])
            high[alive] = self.first[symbol] + self.matrix.rank(symbol, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back to a sampled suffix, counting."""
        place, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        found = np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            here = place[open_]
            done = self.marks[here]
            at = open_[done]
            found[at] = self.samples[self.marks_before[place[at]]] + steps[at]
            open_ = open_[~done]
            symbol, rank = self.matrix.access(place[open_])
            place[open_] = self.first[symbol] + rank
            steps[open_] += 1
        return found


# ------------------------------------------------------------------ phrases
@dataclass
class Phrases:
    """Distinct phrases of a block of items, as symbols, and the items that hold each."""

    vocabulary: dict[bytes, int]
    symbols: np.ndarray
    lengths: np.ndarray
    item_starts: np.ndarray  # into items, by phrase
    items: np.ndarray
    item_ids: list

    @staticmethod
    def of(items: list[tuple[object, str | None]], window: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[int]] = {}
        ids: dict[object, int] = {}
        for item_id, text in items:
            coded = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
            number = ids.setdefault(item_id, len(ids))
            for at in range(max(1, len(coded) - window + 1) if coded else 0):
                holders.setdefault(tuple(coded[at : at + window]), set()).add(number)
        lengths = np.array([len(p) for p in holders], np.int64)
        symbols = np.zeros((len(holders), window), np.int64)
        for row, phrase in enumerate(holders):
            symbols[row, : len(phrase)] = phrase
        counts = np.array([len(h) for h in holders.values()], np.int64)
        flat = np.fromiter(chain.from_iterable(sorted(h) for h in holders.values()), np.int64, int(counts.sum()))
        return Phrases(vocabulary, symbols, lengths, np.cumsum(counts) - counts, flat, list(ids))

    def holders(self, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``phrase``, item number) for all items of each phrase."""
        counts = np.diff(np.append(self.item_starts, len(self.items)))[phrase]
        which = np.repeat(np.arange(len(phrase)), counts)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        return which, self.items[self.item_starts[phrase][which] + offset]


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, most_words: int = MOST_BLOCK_WORDS) -> str:
    """Write the phrases of all items to the shared folder, in blocks of about ``most_words`` words; returns the folder.

    Tasks read the blocks one after the other, so a benchmark of any size needs no more memory than a block.
    """
    ship(benchmark.sparkSession)
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * most_words)))

    def build(table: pa.Table) -> pa.Table:
        items = sorted(zip(table.column("item_id").to_pylist(), table.column("text").to_pylist()), key=repr)
        return pa.table({"phrases": pa.array([pickle.dumps(Phrases.of(items, window))], pa.binary())})

    made = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block")).groupBy("block").applyInArrow(build, "phrases binary")
    folder = shared_folder(benchmark.sparkSession, "phrases")
    made.write.parquet(folder)
    return folder


def _read_blocks(folder: str) -> Iterator[Phrases]:
    store, path = pafs.FileSystem.from_uri(folder)
    files = sorted(f.path for f in store.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet"))
    for file in files:
        for batch in pq.ParquetFile(store.open_input_file(file)).iter_batches(batch_size=1):
            for held in batch.column("phrases").to_pylist():
                yield pickle.loads(held)


# ------------------------------------------------------------------ search
def _stretches(codes: np.ndarray, least: int, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, symbols) of the runs without 0 that are long enough; long runs in pieces that overlap."""
    zero = np.flatnonzero(np.concatenate([[0], codes, [0]]) == 0) - 1
    gaps = np.diff(zero) - 1
    for i in np.flatnonzero(gaps >= max(1, least)).tolist():
        start, end = int(zero[i]) + 1, int(zero[i + 1])
        while True:
            stop = min(end, start + LONGEST_STRETCH)
            yield start, codes[start:stop]
            if stop == end:
                break
            start = stop - overlap


def _search(codes: np.ndarray, phrases: Phrases, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, phrase) of all occurrences in a coded shard, in parts of bounded size."""
    instances: dict[bytes, list[int]] = {}
    size = 0
    for start, symbols in _stretches(codes, int(phrases.lengths.min()), window - 1):
        key = symbols.astype(np.int32).tobytes()
        if key in instances:
            instances[key].append(start)
            continue
        instances[key] = [start]
        size += len(symbols) + 1
        if size >= SHARD_WORDS:
            yield from _search_index(instances, phrases)
            instances, size = {}, 0
    if instances:
        yield from _search_index(instances, phrases)


def _search_index(instances: dict[bytes, list[int]], phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    index = FMIndex([np.frombuffer(k, np.int32) for k in instances], len(phrases.vocabulary))
    places = list(instances.values())
    copies = np.array([len(p) for p in places])
    firsts = np.cumsum(copies) - copies
    flat = np.fromiter(chain.from_iterable(places), np.int64, int(copies.sum()))
    low, high = index.find(phrases.symbols, phrases.lengths)
    counts = high - low
    hit = np.flatnonzero(counts)
    for part in np.split(hit, np.searchsorted(np.cumsum(counts[hit]), np.arange(_OCCURRENCES_AT_ONCE, int(counts.sum()), _OCCURRENCES_AT_ONCE))):
        n = counts[part]
        rows = np.repeat(low[part], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = index.locate(rows)
        stretch = np.searchsorted(index.starts, at, side="right") - 1
        offset = at - index.starts[stretch]
        for some in range(0, len(at), 1 << 16):
            s, o, p = stretch[some : some + (1 << 16)], offset[some : some + (1 << 16)], np.repeat(part, n)[some : some + (1 << 16)]
            which = np.repeat(np.arange(len(s)), copies[s])
            copy = np.arange(len(which)) - np.repeat(np.cumsum(copies[s]) - copies[s], copies[s])
            yield flat[firsts[s][which] + copy] + o[which], p[which]


def find_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, columns: list[str] | None = None,
    names: tuple[str, str, str] = ("_n_words", "_spans", "_items"),
) -> DataFrame:
    """Where benchmark phrases stand in documents: the columns asked for, _n_words, _spans and _items (or ``names``).

    Words are runs of digits, letters a-z (A-Z lower-cased) and anything beyond ASCII. A phrase is ``window`` consecutive words of an
    item, or all of a shorter one. ``_spans`` are the merged ranges (start, end) of words that lie in occurrences, end exclusive;
    ``_items`` the ids of items with a phrase in the document, ascending. NULL and empty texts have no words. An item without id
    counts in spans but is not listed; items that share an id are one. Rows are searched one by one, so repeated rows give repeated results.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = phrase_blocks(benchmark, window)
    columns = ["doc_id"] if columns is None else columns

    def search(batches) -> Iterator[pa.RecordBatch]:
        lighten()
        blocks: list[Phrases] | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                part = batch.slice(at, _TEXTS_AT_ONCE)
                if blocks is None:
                    held = list(_first_two(folder))
                    blocks = held if len(held) < 2 else None
                rows = _search_texts(part.column("text").to_pylist(), blocks if blocks is not None else _read_blocks(folder), window)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *rows], names=[*columns, *names])

    kept = docs.select(*columns, *([] if "text" in columns else ["text"]))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    found = (T.LongType(), T.ArrayType(span), T.ArrayType(benchmark.schema["item_id"].dataType))
    schema = T.StructType([*(kept.schema[c] for c in columns), *(T.StructField(n, k) for n, k in zip(names, found))])
    return kept.mapInArrow(search, schema)


def _first_two(folder: str) -> Iterator[Phrases]:
    for number, block in enumerate(_read_blocks(folder)):
        yield block
        if number:
            return


def _search_texts(texts: list[str | None], blocks, window: int) -> list[pa.Array]:
    split = [words(t) for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    width = counts + 1  # a 0 after each document
    firsts = np.cumsum(width) - width
    change = np.zeros(int(width.sum()) + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    for phrases in blocks:
        if not len(phrases.lengths):
            continue
        get = phrases.vocabulary.get
        codes = np.fromiter(chain.from_iterable(chain(map(get, ws, repeat(0)), (0,)) for ws in split), np.int64, int(width.sum()))
        pairs: list[np.ndarray] = []
        for start, phrase in _search(codes, phrases, window):
            np.add.at(change, start, 1)
            np.add.at(change, start + phrases.lengths[phrase], -1)
            which, item = phrases.holders(phrase)
            row = np.searchsorted(firsts, start[which], side="right") - 1
            pairs.append(np.unique(row * len(phrases.item_ids) + item))
        for pair in np.unique(np.concatenate(pairs)).tolist() if pairs else ():
            item_id = phrases.item_ids[pair % len(phrases.item_ids)]
            if item_id is not None:
                items[pair // len(phrases.item_ids)].add(item_id)
    hit = np.cumsum(change)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    row = np.searchsorted(firsts, begin, side="right") - 1
    per_row = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(begin - firsts[row], pa.int64()), pa.array(end - firsts[row], pa.int64())], ["start", "end"])
    return [
        pa.array(counts), pa.ListArray.from_arrays(pa.array(per_row), spans),
        pa.array([sorted(i) for i in items], pa.list_(pa.int64() if not any(isinstance(x, str) for i in items for x in i) else pa.string())),
    ]


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """A text without the words of the spans and what stands between them; a space stays in the place of each."""
    if not spans or text is None:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at : places[start][0]].rstrip())
        at = places[end - 1][1]
    return " ".join([*parts, text[at:].lstrip()]).strip()


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the merged spans of benchmark phrases cut out of the texts; other texts stay as they are."""
    taken = {c.lower() for c in docs.columns}
    names = tuple(next(n for n in (f"{'_' * k}{base}" for k in range(1, 99)) if n not in taken) for base in ("n_words", "spans", "items"))
    found = find_items(docs, benchmark, window, docs.columns, names)
    kept = docs.columns
    place = kept.index("text")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                without_spans(t, [(s["start"], s["end"]) for s in spans])
                for t, spans in zip(batch.column("text").to_pylist(), batch.column(names[1]).to_pylist())
            ]
            columns = [batch.column(c) for c in kept]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=kept)

    return found.mapInArrow(cut, docs.schema)
