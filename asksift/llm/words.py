"""Words and shingles of many texts at once, as arrays of 64-bit hashes.

A word is a run of digits, letters and non-ASCII characters, compared with
A-Z lower-cased. All functions take the UTF-8 bytes of a run of texts, as they
lie in an Arrow column, and never look across the end of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _WORD[_low : _high + 1] = True

_random = np.random.default_rng(20)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_PLACE = _random.integers(0, 1 << 63, 1024, dtype=np.uint64) * 2 + 1
_STEP = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * 2 + 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def set_minima(tokens: np.ndarray, ends: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Per set (none empty) the smallest of its tokens' products with each factor."""
    out = np.empty((len(ends) - 1, len(factors)), np.uint64)
    for j, factor in enumerate(factors if len(out) else ()):
        out[:, j] = np.minimum.reduceat(tokens * factor, ends[:-1])
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its texts; a null
    counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def runs_of_texts(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer text."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and the n+1 places where the words of
    each text begin."""
    data = data[offsets[0] : offsets[-1]]
    inner = offsets - offsets[0]
    is_word = _WORD[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    starts_of_texts = inner[:-1][inner[:-1] < len(data)]
    begins[starts_of_texts] = is_word[starts_of_texts]
    at = np.flatnonzero(begins)
    firsts = np.searchsorted(at, inner)
    if not len(at):
        return np.zeros(0, np.uint64), firsts
    inside = np.flatnonzero(begins[is_word])
    letters = _LOWER[data[is_word]]
    place = np.arange(len(letters), dtype=np.int32)
    place -= np.repeat(inside.astype(np.int32), np.diff(np.append(inside, len(letters))))
    weighed = _BYTE[letters] * _PLACE[place & 1023]
    return mixed(np.add.reduceat(weighed, inside)), firsts


def shingle_hashes(
    words: np.ndarray, firsts: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``size`` words, and the n+1 places where those
    of each text begin. A text of fewer words, but not none, is one run."""
    counts = np.diff(firsts)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    places = np.concatenate([[0], np.cumsum(runs)])
    if not len(words):
        return np.zeros(0, np.uint64), places
    start = np.arange(places[-1]) + np.repeat(firsts[:-1] - places[:-1], runs)
    last = np.repeat(firsts[1:], runs)
    out = np.zeros(len(start), np.uint64)
    short = bool((counts < size).any())
    for j in range(size):
        part = words[np.minimum(start + j, len(words) - 1)] * _STEP[j]
        if short:
            part = np.where(start + j < last, part, np.uint64(0))
        out += part
    return mixed(out), places


def shingle_sets(
    shingles: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The same, sorted and without repeats within each text."""
    ordered, cuts = shingles.copy(), places.tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        ordered[a:b].sort()
    keep = np.ones(len(ordered), bool)
    keep[1:] = ordered[1:] != ordered[:-1]
    keep[places[:-1][np.diff(places) > 0]] = True
    ends = np.concatenate([[0], np.cumsum(keep)])[places]
    return ordered[keep], ends


def set_keys(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 63-bit name of every set; 0 is that of the empty one."""
    counts = np.diff(ends)
    keys = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        totals = np.add.reduceat(mixed(tokens), ends[some]) + counts[some].astype(np.uint64)
        keys[some] = np.maximum(mixed(totals) >> np.uint64(1), np.uint64(1))
    return keys.astype(np.int64)


def unused(columns: list[str], name: str) -> str:
    """A column name like ``name`` that is not taken yet."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name
