"""Token ids against the library's own, and files read back."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from isobar.llm import token_files
from isobar.llm.common import shared_folder
from isobar.llm.pieces import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _library(texts, plain=False):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = plain
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("most_pieces", [20, 100_000])
def test_pieces_give_the_ids_of_whole_texts(plain, most_pieces):
    rng = random.Random(3)
    parts = ["a", "B", "é", " ", "\n", "\t", "1", ".", "'s", "<|endoftext|>", "  ", "\n\n", " ", "\x1d", "日", "\r", " word", "　", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["", "x" * 5000 + " " + "y" * 100, "a b\nc"]
    encoder = PieceEncoder(PATH, plain, most_pieces)
    for _ in range(2):  # the second time from memory
        found = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)]
        assert found == _library(texts, plain)
    assert encoder.cuts


@pytest.mark.parametrize("most_pieces", [20, 100_000])
def test_words_with_marks_and_letters_of_two_bytes(most_pieces):
    rng = random.Random(4)
    letters = [chr(c) for c in range(0xC0, 0x250)] + list("abcXYZ")  # with the signs × and ÷ between the letters
    marks = ["", "", "", ".", ",", ";", ":", "!", "?", ".,", "'", "1", "="]
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 5))) + rng.choice(marks) for _ in range(300)] + ["Z" * 60, "Z" * 60 + "."]
    texts = [" ".join(["", "\n"][rng.random() < 0.1] + rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(400)]
    encoder = PieceEncoder(PATH, most_pieces=most_pieces)
    assert encoder.words is not None
    for _ in range(2):
        assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)] == _library(texts)
    assert len(encoder.memory) <= most_pieces + len(words) * 2


def test_words_are_remembered_without_marks_and_line_breaks():
    """Before, each of "word", "word." and "\\nword" was a piece to learn and to remember."""
    encoder = PieceEncoder(PATH)
    texts = ["word word. word, 's. it's; é! x1. ..\nword\nword?", "word", ""]
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)] == _library(texts)
    assert {key for key in encoder.memory if "word" in key} == {"word", " word"}
    assert encoder.encode([]) == []


def test_added_token_of_letters_and_a_mark(tmp_path):
    library = Tokenizer.from_file(PATH)
    library.add_tokens(["b."])
    path = str(tmp_path / "added.json")
    library.save(path)
    encoder = PieceEncoder(path, plain_specials=True)
    texts = ["ab. b. c. b.d", "b."]
    library.encode_special_tokens = True
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]


def test_added_token_of_letters(tmp_path):
    library = Tokenizer.from_file(PATH)
    library.add_tokens(["abc"])
    path = str(tmp_path / "added.json")
    library.save(path)
    encoder = PieceEncoder(path, plain_specials=True)
    texts = ["xabcx abc. zabc", "abc", "no other"]
    library.encode_special_tokens = True
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]


def test_other_tokenizers_get_whole_texts():
    encoder = PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["One two", " x\ny ", ""]
    assert not encoder.cuts
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]


def _expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out, start = [], 0
    for (doc_id, _), ids in zip(rows, _library([t or "" for _, t in rows])):
        ids = np.array([*ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("table", ["docs", "odd", "nothing"])
def test_sequences_round_trip(request, spark, table):
    table = request.getfixturevalue(table)
    folder = shared_folder(spark, "test-sequences")
    files = token_files.write_sequences(table, folder, PATH, 2, length=64)
    found = token_files.documents_in_sequences(files, folder).collect()
    expected = _expected([(r.doc_id, r.text) for r in table.collect()])
    # Files come in order of doc_id; repeated ids are told apart by their starts.
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected


def test_sequences_are_views_of_equal_length(spark, docs):
    folder = shared_folder(spark, "test-views")
    files = token_files.write_sequences(docs, folder, PATH, 2, length=32).orderBy("file_no").collect()
    stream = []
    for file in files:
        reader = token_files.open_sequences(folder, file.file)
        assert pa.types.is_fixed_size_list(reader.schema.field("ids").type)
        n = sum(reader.get_batch(i).num_rows for i in range(reader.num_record_batches))
        for row in range(n):
            ids, mask = token_files.sequence(reader, row)
            assert len(ids) == len(mask) == 32 and not ids.flags.owndata
            stream.extend(ids[mask].tolist())
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert stream == [i for ids in _library([t for _, t in rows]) for i in [*ids, 2]]


@pytest.mark.parametrize("table", ["docs", "odd", "nothing"])
def test_flat_counts(request, table):
    table = request.getfixturevalue(table)
    found = token_files.token_counts(table, PATH, 50256).collect()
    texts = [(r.doc_id, r.text or "") for r in table.collect()]
    expected = [(i, len(ids)) for (i, _), ids in zip(texts, _library([t for _, t in texts], plain=True))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_scan_stitches_blocks(spark, block):
    import os

    rng = np.random.default_rng(block)
    folder = shared_folder(spark, "test-flat")
    path = folder.removeprefix("file://")
    os.makedirs(path)
    expected, files = [], []
    for number in range(4):
        lengths = rng.integers(0, 40, number * 5)
        ids, at = [], 0
        for place, n in enumerate(lengths.tolist()):
            expected.append((number, place, at, n))
            ids += rng.integers(0, 9, n).tolist() + [9]
            at += n + 1
        ids += [1, 2, 3]  # no separator follows
        np.array(ids, "<u2").tofile(f"{path}/part-{number:06d}.bin")
        files.append((number, len(ids) * 2))
    table = spark.createDataFrame(files, "file_no int, n_bytes long")
    found = token_files.scan_flat(table, folder, 9, np.dtype("<u2"), block)
    assert sorted(map(tuple, found.collect())) == expected
