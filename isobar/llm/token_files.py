"""Token ids in files: Arrow files of equal-length sequences, and flat files without an index.

Both writers run in the tasks that hold the documents and put each file in place under its final
name when it is whole, so a task that runs again leaves the same file. Folders are given as
URIs; any store that Arrow knows will do.

NULL texts count as empty: such a document is its end id alone. Columns other than ``doc_id`` and ``text``
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.llm.common import shared_folder, ship
from isobar.llm.pieces import encoder

SEQUENCE = 2048
SEQUENCES_PER_BATCH = 256
_TEXTS_AT_ONCE = 500


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    store, path = pafs.FileSystem.from_uri(folder)
    return store, path.rstrip("/")


class _Placed:
    """A file that appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        self.store, path = _opened(folder)
        self.store.create_dir(path, recursive=True)
        self.final = f"{path}/{name}"
        self.temporary = f"{path}/.{name}.{TaskContext.get().taskAttemptId()}"

    def __enter__(self) -> pa.NativeFile:
        self.sink = self.store.open_output_stream(self.temporary)
        return self.sink

    def __exit__(self, kind, *_) -> None:
        if not self.sink.closed:
            self.sink.close()
        if kind is None:
            self.store.move(self.temporary, self.final)
        else:
            self.store.delete_file(self.temporary)


def _encoded(batches, tokenizer: str, plain_specials: bool) -> Iterator[tuple[int | None, bytes]]:
    encode = encoder(tokenizer, plain_specials)
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
            part = batch.slice(at, _TEXTS_AT_ONCE)
            ids = part.column("doc_id").to_pylist()
            texts = [text or "" for text in part.column("text").to_pylist()]
            yield from zip(ids, encode.encode(texts))


# ------------------------------------------------------------------ Arrow files
class _SequenceWriter:
    """Packs ids into sequences; of each id it marks whether it is one, and whether it ends a document."""

    def __init__(self, sink: pa.NativeFile, dtype: np.dtype, length: int):
        self.length, self.dtype = length, dtype
        self.schema = sequence_schema(dtype, length)
        self.file = pa.ipc.new_file(sink, self.schema)
        self.ids = bytearray()
        self.ends: list[int] = []  # positions in the buffered ids
        self.docs: list[int | None] = []
        self.written = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids += ids
        self.ends.append(len(self.ids) // self.dtype.itemsize - 1)
        self.docs.append(doc_id)
        batch = self.length * SEQUENCES_PER_BATCH
        while len(self.ids) >= batch * self.dtype.itemsize:
            self._write(batch)

    def _write(self, count: int) -> None:
        taken = np.frombuffer(bytes(self.ids[: count * self.dtype.itemsize]), self.dtype)
        del self.ids[: count * self.dtype.itemsize]
        rows = -(-count // self.length)
        ids = np.zeros(rows * self.length, self.dtype)
        ids[:count] = taken
        mask, ends = np.zeros(ids.size, bool), np.zeros(ids.size, bool)
        mask[:count] = True
        n = int(np.searchsorted(self.ends, count))
        at = np.array(self.ends[:n], np.int64)
        ends[at] = True
        per_row = np.searchsorted(at, np.arange(rows + 1) * self.length).astype(np.int32)
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(ends), self.length),
            pa.ListArray.from_arrays(pa.array(per_row), pa.array(self.docs[:n], pa.int64())),
        ]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))
        self.ends = [end - count for end in self.ends[n:]]
        del self.docs[:n]
        self.written += count

    def close(self) -> int:
        if self.ids:
            self._write(len(self.ids) // self.dtype.itemsize)
        self.file.close()
        return self.written


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.field("item", pa.from_numpy_dtype(dtype), False), length)),
        ("mask", pa.list_(pa.field("item", pa.bool_(), False), length)),
        ("document_end", pa.list_(pa.field("item", pa.bool_(), False), length)),
        ("doc_ids", pa.list_(pa.field("item", pa.int64()))),
    ])


_RANGE_LETTERS = 100


def write_sequences(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = SEQUENCE
) -> DataFrame:
    """Write documents in ascending ``doc_id`` as Arrow files; one row per file: file_no, file, n_ids.

    Files follow each other in order of ``doc_id`` (NULL first, equal ids by text; an id with very many rows is cut by the first letters
    of their texts). Each begins a new sequence; its last one is
    padded. Columns of a file: ``ids``, ``mask`` (not padding), ``document_end``, and the ids of the
    documents that end in the sequence. Ids take two bytes where the vocabulary allows it.
    """
    spark = docs.sparkSession
    ship(spark)

    def write(batches):
        number = TaskContext.get().partitionId()
        name = f"part-{number:06d}.arrow"
        rows = _encoded(batches, tokenizer, False)
        first = next(rows, None)
        if first is None:
            return
        dtype = encoder(tokenizer).dtype
        end = np.array([end_id], dtype).tobytes()
        with _Placed(folder, name) as sink:
            file = _SequenceWriter(sink, dtype, length)
            for doc_id, ids in chain([first], rows):
                file.add(doc_id, ids + end)
            n_ids = file.close()
        yield pa.RecordBatch.from_pydict({"file_no": [number], "file": [name], "n_ids": [n_ids]})

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id", F.substring("text", 1, _RANGE_LETTERS))
    ordered = dealt.sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(write, "file_no long, file string, n_ids long")
    listing = shared_folder(spark, "sequence-files")
    files.write.parquet(listing)
    return spark.read.schema(files.schema).parquet(listing)


def open_sequences(folder: str, file: str) -> pa.ipc.RecordBatchFileReader:
    """An Arrow file by memory map where it is local: batches are views, nothing is copied."""
    store, path = _opened(folder)
    if isinstance(store, pafs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(f"{path}/{file}"))
    return pa.ipc.open_file(store.open_input_file(f"{path}/{file}"))


def sequence(reader: pa.ipc.RecordBatchFileReader, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence of a file; the ids are a view into it."""
    batch = reader.get_batch(row // SEQUENCES_PER_BATCH)
    at = row % SEQUENCES_PER_BATCH
    ids = batch.column("ids")[at].values.to_numpy(zero_copy_only=True)
    return ids, batch.column("mask")[at].values.to_numpy(zero_copy_only=False)


def documents_in_sequences(files: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32 (of 32-bit little-endian ids)."""
    spark = files.sparkSession
    ship(spark)
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("file_start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches):
        for listed in batches:
            for name, start in zip(listed.column("file").to_pylist(), listed.column("file_start").to_pylist()):
                yield from _file_documents(open_sequences(folder, name), start)

    return placed.repartition(max(1, files.count()), "file_no").mapInArrow(  # few rows, much work: not to be coalesced
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _file_documents(reader: pa.ipc.RecordBatchFileReader, position: int) -> Iterator[pa.RecordBatch]:
    begin, crc = position, 0
    for number in range(reader.num_record_batches):
        batch = reader.get_batch(number)
        flat = {n: batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in ("ids", "mask", "document_end")}
        count = int(flat["mask"].sum())
        ids = flat["ids"][:count].astype("<u4")
        starts, lengths, crcs, at = [], [], [], 0
        for end in np.flatnonzero(flat["document_end"]).tolist():
            crc = zlib.crc32(ids[at : end + 1], crc)
            starts.append(begin)
            lengths.append(position + end + 1 - begin)
            crcs.append(crc)
            begin, crc, at = position + end + 1, 0, end + 1
        crc = zlib.crc32(ids[at:], crc)
        position += count
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_ids").flatten(), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs))],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


# ------------------------------------------------------------------ flat files
def write_flat(docs: DataFrame, folder: str, tokenizer: str, separator: int) -> DataFrame:
    """Write ids one after the other, each document ended by ``separator``, with nothing else in the file.

    Returns what the writer knows: (file_no, place, doc_id) per document, and the number of bytes (n_bytes) per file in a row
    whose ``place`` is NULL. Strings of special tokens count as text, so the separator occurs nowhere else.
    """
    spark = docs.sparkSession
    ship(spark)

    def write(batches):
        number = TaskContext.get().partitionId()
        n_bytes, place = 0, 0
        rows = _encoded(batches, tokenizer, True)
        first = next(rows, None)
        if first is None:
            return
        end = np.array([separator], encoder(tokenizer, True).dtype).tobytes()
        doc_ids: list[int | None] = []

        def told(count: int | None = None) -> pa.RecordBatch:
            nonlocal place
            n = len(doc_ids)
            places = pa.array(range(place, place + n), pa.int64())
            place += n
            columns = [pa.array([number] * n, pa.int32()), places, pa.array(doc_ids, pa.int64()), pa.nulls(n, pa.int64())]
            if count is not None:
                last = [pa.array([number], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([count], pa.int64())]
                columns = [pa.concat_arrays(pair) for pair in zip(columns, last)]
            doc_ids.clear()
            return pa.RecordBatch.from_arrays(columns, names=["file_no", "place", "doc_id", "n_bytes"])

        with _Placed(folder, f"part-{number:06d}.bin") as sink:
            for doc_id, ids in chain([first], rows):
                n_bytes += sink.write(ids + end)
                doc_ids.append(doc_id)
                if len(doc_ids) >= 10_000:
                    yield told()
        yield told(n_bytes)

    known = docs.select("doc_id", "text").mapInArrow(write, "file_no int, place long, doc_id long, n_bytes long")
    listing = shared_folder(spark, "flat-files")
    known.write.parquet(listing)
    return spark.read.schema(known.schema).parquet(listing)


def scan_flat(
    files: DataFrame, folder: str, separator: int, dtype: np.dtype, block_ids: int = 1 << 20
) -> DataFrame:
    """Token counts from flat files: file_no, place (of the document in its file), start, n_tokens (without separator).

    ``files`` has file_no and n_bytes. Blocks are searched for separators in parallel; a prefix scan over the blocks of a
    file, a row each, carries the number of documents and the last separator on, so a document may span any number
    of blocks. Ids after a file's last separator belong to no ended document and are not reported.
    """
    spark: SparkSession = files.sparkSession
    ship(spark)
    width = dtype.itemsize
    blocks = files.where("n_bytes > 0").select(
        "file_no", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_bytes") / width - 1) / block_ids).cast("long"))).alias("block")
    )

    def search(batches):
        store, path = _opened(folder)
        for batch in batches:
            for number, block in zip(batch.column("file_no").to_pylist(), batch.column("block").to_pylist()):
                with store.open_input_file(f"{path}/part-{number:06d}.bin") as file:
                    read = file.read_at(block_ids * width, block * block_ids * width)
                found = np.flatnonzero(np.frombuffer(read, dtype) == separator) + block * block_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([block], pa.int64()), pa.array([found], pa.list_(pa.int64()))],
                    names=["file_no", "block", "ends"],
                )

    earlier = Window.partitionBy("file_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        blocks.repartition(max(1, blocks.count()), "file_no", "block")  # few rows, much work: not to be coalesced
        .mapInArrow(search, "file_no int, block long, ends array<long>")
        .withColumn("n_before", F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)))
        .withColumn("last_before", F.coalesce(F.max(F.array_max("ends")).over(earlier), F.lit(-1)))
        .where(F.size("ends") > 0)
    )
    starts = F.concat(
        F.array(F.col("last_before") + 1), F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda e: e + 1)
    )
    return stitched.select(
        "file_no", "n_before", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end")))
    ).select(
        "file_no",
        (F.col("n_before") + F.col("pos")).alias("place"),
        F.col("col.start").alias("start"),
        (F.col("col.end") - F.col("col.start")).alias("n_tokens"),
    )


def token_counts(docs: DataFrame, tokenizer: str, separator: int) -> DataFrame:
    """Encode documents into flat files and count from the files: doc_id, file_no, start, n_tokens."""
    folder = shared_folder(docs.sparkSession, "flat")
    known = write_flat(docs, folder, tokenizer, separator)
    dtype = encoder(tokenizer, True).dtype
    counted = scan_flat(known.where("place IS NULL"), folder, separator, dtype)
    return known.where("place IS NOT NULL").select("file_no", "place", "doc_id").hint("merge").join(
        counted, ["file_no", "place"]
    ).select("doc_id", "file_no", "start", "n_tokens")
