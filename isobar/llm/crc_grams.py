"""CRC-32 of every run of words in a text, from the running CRCs of one scan.

CRC-32 is linear over GF(2): crc(AB) = shift(crc(A), |B|) ^ crc(B), where the shift appends |B| zero bytes. So the checksum of a
substring B follows from the checksums of two prefixes, A and AB, by cancelling the shifted first one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np

_NEAR = 64  # shifts by fewer bytes have a table each; the rest of a longer one goes by powers of two
_ALL = np.uint32(0xFFFFFFFF)

# A-Z to lower case, all other ASCII but digits and a-z to a space.
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def _one_byte() -> np.ndarray:
    """What a zero byte makes of each value of the register's lowest byte, by the polynomial's rule."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_STEP = _one_byte()


def _applied(lanes: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map, given by its images of each value in each of the four bytes."""
    return lanes[0][x & 255] ^ lanes[1][(x >> 8) & 255] ^ lanes[2][(x >> 16) & 255] ^ lanes[3][x >> 24]


def _near_tables() -> np.ndarray:
    tables = np.empty((_NEAR + 1, 4, 256), np.uint32)
    values = np.arange(256, dtype=np.uint32)
    tables[0] = [values << (8 * lane) for lane in range(4)]
    for n in range(_NEAR):
        tables[n + 1] = _STEP[tables[n] & 255] ^ (tables[n] >> 8)
    return tables


_TABLES = _near_tables()
_FAR = [_TABLES[_NEAR]]  # shifts by _NEAR * 2**k bytes, made as they are needed


def shifted(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """Checksums after appending so many zero bytes, each its own number."""
    near = n_bytes % _NEAR
    out = np.zeros(len(crc), np.uint32)
    for lane in range(4):
        out ^= _TABLES[near, lane, (crc >> np.uint32(8 * lane)) & 255]
    far, k = n_bytes // _NEAR, 0
    while far.any():
        if k == len(_FAR):
            _FAR.append(_applied(_FAR[-1], _FAR[-1]))
        set_ = (far & 1).astype(bool)
        out[set_] = _applied(_FAR[k], out[set_])
        far, k = far >> 1, k + 1
    return out


def normalised(text: str | None) -> bytes:
    """The words of a text (runs of digits, a-z and anything beyond ASCII; A-Z lower-cased), a space between two."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split())


@dataclass(frozen=True)
class Prefixes:
    """Running checksums of some texts at the words' borders, one text after another."""

    n_words: np.ndarray  # of each text
    before: np.ndarray  # checksum of the text up to each word's first byte
    after: np.ndarray  # and up to its end
    lengths: np.ndarray  # of the words, in bytes

    @staticmethod
    def scan(texts: Sequence[str | None]) -> Prefixes:
        """One pass over each text; the checksum at the end of a word is kept, the one after the next space follows from it."""
        counts, ends, lengths = [], [], []
        for text in texts:
            # No word holds a zero byte: these are the words, all but the first with the space before it.
            pieces = normalised(text).replace(b" ", b"\0 ").split(b"\0")
            if pieces == [b""]:
                counts.append(0)
                continue
            counts.append(len(pieces))
            ends.extend(accumulate(pieces, lambda crc, piece: crc32(piece, crc), initial=0))
            lengths.extend(map(len, pieces))
        n_words = np.array(counts, np.int64)
        first = np.cumsum(n_words) - n_words
        some = n_words > 0
        running = np.array(ends, np.uint32)  # with a 0 at the start of each text that has words
        starts = first[some] + np.arange(int(some.sum()))
        after = np.delete(running, starts)
        before = np.delete(running, starts + n_words[some])
        size = np.array(lengths, np.int64)
        inner = np.ones(len(size), bool)
        inner[first[some]] = False
        register = before[inner] ^ _ALL
        before[inner] = _STEP[(register ^ 0x20) & 255] ^ (register >> 8) ^ _ALL
        return Prefixes(n_words, before, after, size - inner)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Checksums of all runs of ``n`` words, text by text, and how many each text has."""
        counts = np.maximum(self.n_words - n + 1, 0)
        start = np.repeat(np.cumsum(self.n_words) - self.n_words - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        width = np.concatenate([[0], np.cumsum(self.lengths)])
        n_bytes = width[start + n] - width[start] + n - 1
        return self.after[start + n - 1] ^ shifted(self.before[start], n_bytes), counts
