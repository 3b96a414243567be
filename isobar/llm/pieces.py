"""Encode texts with the tokenizers library, each distinct piece of text once.

Byte-level BPE cuts a text by a fixed pattern and encodes the cuts independently. A single space or line
break before a visible character always starts a new cut, so texts may be cut there and the
pieces' ids put together. Each distinct piece of a batch is looked up once, in a bounded memory; new ones go to
the library many at a time.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Visible characters that no pattern counts as white space.
_SEEN = "!-~¡-ɏ"
_UNSAFE = f"[ \n](?:[^{_SEEN}]|\\z)|\\x00"
_SAFE = re.compile(f" (?=[{_SEEN}])|(?=\n[{_SEEN}])")
_LONGEST_PIECE = 48
_BATCH = 200
_PIECES = pa.list_(pa.string())
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_WORD = re.compile(f"([ \n]?)([{_LETTERS}]+)([.,;:!?]?)")
_NO_LETTER = re.compile(f"[^{_LETTERS}]")
_MARKED = f"([{_LETTERS}])([.,;:!?])"


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: visible Latin-1 as it is, the others from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: 256 + i for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class PieceEncoder:
    """Ids of whole texts as little-endian bytes, the same as the library's own for each text.

    ``plain_specials``: the strings of special tokens in a text are ordinary text. Tokenizers
    that cut texts in another way get every text whole.
    """

    def __init__(self, path: str, plain_specials: bool = False, most_pieces: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.most_pieces = most_pieces
        self.memory: dict[str, bytes] = {}
        self.cuts = self._cuts_at_spaces(path)
        line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.cuts = self.cuts and len(line_break) == 1
        self.line_break = line_break[0] if self.cuts else None
        self.words = self._words_only(path, pre_tokenizers)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = [] if plain_specials else added

    def _words_only(self, path: str, pre_tokenizers):
        """The same tokenizer for words in byte letters with line breaks between; None where a word, or one with a mark after it, could hold an added token."""
        added = self.tokenizer.get_added_tokens_decoder().values()
        if not self.cuts or any(not _NO_LETTER.search(t.content) or re.search(_MARKED, t.content) for t in added):
            return None
        words = type(self.tokenizer).from_file(path)
        words.model._resize_cache(0)  # each word comes once
        words.pre_tokenizer = pre_tokenizers.Split(chr(_BYTE_LETTERS[ord("\n")]), "isolated")
        return words

    def _cuts_at_spaces(self, path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter = spec.get("pre_tokenizer") or {}
        return (
            cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
            and not spec.get("normalizer")
            and all(
                not (re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"])
                for t in spec.get("added_tokens", [])
            )
        )

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if not self.cuts:
            return self._whole(texts)
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.specials)]
        at_once = dict(zip(whole, self._whole([texts[i] for i in whole])))
        rest = [i for i in range(len(texts)) if i not in at_once]
        unsafe = pc.match_substring_regex(pa.array([texts[i] for i in rest], pa.string()), _UNSAFE).to_pylist()
        odd = [i for i, is_unsafe in zip(rest, unsafe) if is_unsafe]
        simple = [i for i, is_unsafe in zip(rest, unsafe) if not is_unsafe]
        if odd:
            at_once.update(zip(odd, self._joined(pa.array([self._pieces(texts[i]) for i in odd], _PIECES))))
        if simple:
            at_once.update(zip(simple, self._joined(self._simple_pieces([texts[i] for i in simple]))))
        return [at_once[i] for i in range(len(texts))]

    def _joined(self, cut: pa.ListArray) -> Iterator[bytes]:
        """The ids of each text's pieces, put together. Only distinct pieces are looked up."""
        coded = cut.values.dictionary_encode()
        ids = pa.array(self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary()).take(coded.indices)
        _, offsets, joined = ids.buffers()
        ends = np.frombuffer(offsets, np.int32, len(ids) + 1)[cut.offsets.to_numpy()].tolist()
        joined = joined.to_pybytes() if joined else b""
        return (joined[start:end] for start, end in zip(ends, ends[1:]))

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        found = list(map(self.memory.get, pieces))
        gaps = [at for at, ids in enumerate(found) if ids is None]
        if gaps:
            new = {pieces[at] for at in gaps}
            if len(self.memory) + len(new) > self.most_pieces:
                self.memory.clear()
            learnt = self._learn(new)
            for at in gaps:
                found[at] = learnt[pieces[at]]
        return found

    @staticmethod
    def _pieces(text: str) -> list[str]:
        """Keys of a text's pieces: " x" for the first one x, "x" for a later " x", "\nx" for itself."""
        pieces = _SAFE.split(text)
        pieces[0] = " " + pieces[0]
        return pieces

    def _simple_pieces(self, texts: list[str]) -> pa.ListArray:
        """The same of texts whose every space and line break is before a visible character; a line break is a piece of its own, "\n",
        and so is the mark that ends a word.
        """
        parted = [" " + text.replace(" ", "\0").replace("\n", "\0\n\0 ") for text in texts]
        keys = pa.array(parted, pa.string())
        if self.words:
            keys = pc.replace_substring_regex(keys, _MARKED + r"(\x00|\z)", "\\1\0 \\2\\3")
        return pc.split_pattern(keys, "\0")

    def _learn(self, keys: set[str]) -> dict[str, bytes]:
        """The ids of new pieces. The memory takes them too, but for long pieces and for words with a line break or a
        mark, which are put together from the word's own ids.
        """
        words, built, rest = [], [], []
        for key in keys:
            if not self.words:
                rest.append(key)
            elif key.isalpha() and key.isascii():
                words.append(key)
            elif parts := _WORD.fullmatch(key):
                before, letters, mark = parts.groups()
                stem = " " + letters if before else letters  # the key of the same word without line break and mark
                if stem == key:
                    words.append(key)
                else:
                    built.append((key, stem, "\n" if before == "\n" else "", mark))
            else:
                rest.append(key)
        known = {stem: self.memory[stem] for _, stem, _, _ in built if stem in self.memory}
        words += {stem for _, stem, _, _ in built}.difference(known, words)
        learnt = self._of_words(words) | self._of_others(rest)
        self.memory.update((key, ids) for key, ids in learnt.items() if len(key) <= _LONGEST_PIECE)
        learnt |= known
        around = {text: self._whole([text])[0] for text in {text for part in built for text in part[2:]}}
        for key, stem, before, mark in built:
            learnt[key] = around[before] + learnt[stem] + around[mark]
        return learnt

    def _of_words(self, keys: list[str]) -> dict[str, bytes]:
        spelt = [
            "\n".join(k[1:] if k[0] == " " else " " + k for k in keys[i : i + _BATCH]).encode().decode("latin-1").translate(_BYTE_LETTERS)
            for i in range(0, len(keys), _BATCH)
        ]
        ids: list[bytes] = []
        for some in range(0, len(spelt), 64):
            for encoded in self.words.encode_batch_fast(spelt[some : some + 64], add_special_tokens=False):
                ids += self._parted(np.array(encoded.ids, self.dtype))
        return dict(zip(keys, ids, strict=True))

    def _parted(self, ids: np.ndarray) -> Iterator[bytes]:
        """Ids between line breaks."""
        width = self.dtype.itemsize
        ends = [*(np.flatnonzero(ids == self.line_break) * width).tolist(), ids.nbytes]
        whole = ids.tobytes()
        return (whole[start:end] for start, end in zip([0, *(end + width for end in ends)], ends))

    def _of_others(self, keys: list[str]) -> dict[str, bytes]:
        """Pieces without other white space are joined by line breaks, each of which is one id of its own, and the ids are parted
        there; the rest are encoded one by one.
        """
        joined = [k for k in keys if " " not in k and k.isprintable()]
        texts = ["\n " + "\n ".join(joined[i : i + _BATCH]) for i in range(0, len(joined), _BATCH)]
        ids: list[bytes] = []
        for some in range(0, len(texts), 64):
            for encoded in self._whole(texts[some : some + 64]):
                ids += islice(self._parted(np.frombuffer(encoded, self.dtype)), 1, None)  # nothing before the first line break
        learnt = dict(zip(joined, ids, strict=True))
        rest = [k for k in keys if " " in k or not k.isprintable()]
        for some in range(0, len(rest), 20_000):
            part = rest[some : some + 20_000]
            learnt.update(zip(part, self._whole([k[1:] if k[0] == " " else k if k[0] == "\n" else " " + k for k in part])))
        return learnt


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, plain_specials: bool = False) -> PieceEncoder:
    """This worker's encoder for a tokenizer file; it keeps its memory from task to task."""
    key = (path, plain_specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, plain_specials)
    return _ENCODERS[key]


def forget() -> None:
    """Give back the memory of this worker's encoders; the next use begins anew."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim:
            trim(0)
