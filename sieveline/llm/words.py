"""Words and their hashes, computed on the UTF-8 bytes of whole Arrow batches.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with
A-Z lowered.  Every byte of a non-ASCII character is 0x80 or above, so this can
be decided byte by byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; only bounds temporary memory, results do not depend on it.
PIECE = 1 << 20

_WORD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))


def release() -> None:
    """Give back what a task's Arrow batches took; Python workers live on for other tasks."""
    pa.default_memory_pool().release_unused()


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def spaced(raw: bytes) -> bytes:
    """Lower-cased words, everything else replaced by blanks; as long as ``raw``."""
    return raw.translate(_WORD)


def split_words(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD).split()


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(raws: list[bytes]):
    """``(document, bytes)`` lists of about PIECE bytes, cut between words only."""
    group, size = [], 0
    for doc, raw in enumerate(raws):
        text = raw.translate(_WORD)
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE:
                cut = text.rfind(b" ", at, at + PIECE)
                end = cut if cut > at else text.find(b" ", at + PIECE)
                end = len(text) if end < 0 else end
            group.append((doc, text[at:end]))
            size += end - at
            at = end
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, texts one after another, and words per text."""
    counts = np.zeros(len(raws), dtype=np.int64)
    found = []
    for group in _pieces(raws):
        data = np.frombuffer(b" ".join(t for _, t in group) + b" ", dtype=np.uint8)
        inside = data != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        starts, ends = edges[0::2], edges[1::2]
        if not len(starts):
            continue
        lengths = ends - starts
        letters = data[inside].astype(np.uint64) + np.uint64(1)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        letters *= _POWERS[place % len(_POWERS)]
        found.append(mix(np.add.reduceat(letters, first) + lengths.astype(np.uint64)))
        sizes = np.array([len(t) + 1 for _, t in group])
        owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
        counts += np.bincount(np.array([d for d, _ in group])[owner], minlength=len(raws))
    return (np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words, and the index of their first word; no
    shingle crosses from one text into the next."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    factor = np.uint64(1)
    for i in range(n):
        total += words[i:len(words) - n + 1 + i] * factor
        factor = np.uint64(int(factor) * 0xD6E8FEB86659FD93 % (1 << 64))
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))  # words left in the text
    first = np.flatnonzero(left[:len(total)] >= n)
    return mix(total[first] + np.uint64(n)), first
