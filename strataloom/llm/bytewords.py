"""Words and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.
No Python object is made for a word; a chunk of texts is a byte array and offsets.
Hashes only bring together what may be equal: `kinds` compares the bytes, so two
words of one hash are two words.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK = (1 << 19) - 1

_rng = np.random.default_rng(20240501)
_odd = lambda n: _rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHINGLE_FACTOR = _odd(16)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK, END = 0x20, 0x0A
#: Bytes up to which spans are read in lanes of eight, all at once; longer ones are read one by one.
LONG = 64


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros stand behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))


def _lane(lanes: np.ndarray, starts: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Lane k of spans that reach into it, without what lies behind their end."""
    left = np.minimum(size - 8 * k, 8).astype(np.uint64)
    return lanes[starts + 8 * k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each (non-empty) span: a key to look up by, never the span itself."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * SHINGLE_FACTOR[14])
    lanes = _lanes(data)
    live = np.flatnonzero(size <= LONG)
    k = 0
    while len(live):
        h[live] = mix(h[live] ^ _lane(lanes, starts[live], size[live], k) * SHINGLE_FACTOR[13])
        k += 1
        live = live[size[live] > 8 * k]
    for j in np.flatnonzero(size > LONG).tolist():
        h[j] = xxhash.xxh3_64_intdigest(data[starts[j] : ends[j]].tobytes())
    return h


def equal_spans(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether the bytes of each span of `a` are those of the span of `b` beside it."""
    size = a_end - a_start
    same = size == b_end - b_start
    a_lanes, b_lanes = _lanes(a), _lanes(b)
    live = np.flatnonzero(same & (size <= LONG))
    k = 0
    while len(live):
        same[live] = _lane(a_lanes, a_start[live], size[live], k) == _lane(b_lanes, b_start[live], size[live], k)
        k += 1
        live = live[same[live] & (size[live] > 8 * k)]
    for j in np.flatnonzero(same & (size > LONG)).tolist():
        same[j] = np.array_equal(a[a_start[j] : a_end[j]], b[b_start[j] : b_end[j]])
    return same


def kinds(keys: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray], name: Callable[[int], Hashable]) -> tuple[np.ndarray, np.ndarray]:
    """One place of each kind, and the kind of each place, for things with hashes `keys`.

    same(i, j) compares things by themselves and name(i) is one's whole content: two of one hash that differ are two kinds.
    """
    _, first, kind = np.unique(keys, return_index=True, return_inverse=True)
    odd = np.flatnonzero(~same(np.arange(len(keys)), first[kind])).tolist()
    if odd:
        names: dict[Hashable, int] = {}
        more = []
        for j in odd:
            if (own := name(j)) not in names:
                names[own] = len(first) + len(more)
                more.append(j)
            kind[j] = names[own]
        first = np.concatenate([first, more])
    return first, kind


def span_kinds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One span of each kind, and the kind of each span; spans are of one kind if their bytes are equal."""
    hashes = span_hash(data, starts, ends) if hashes is None else hashes
    same = lambda i, j: equal_spans(data, starts[i], ends[i], data, starts[j], ends[j])
    return kinds(hashes, same, lambda i: data[starts[i] : ends[i]].tobytes())


def span_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """The bytes of spans (below 2 GB together)."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    place = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[place]))])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, min(n, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1))
        yield a, b
        a = b


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each text's words begin among them (texts + 1 places)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    held = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[held] = inside[held]
    held = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[held] = inside[held]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all `width`-word shingles in order, where each text's begin, and the first word of each.

    A text of fewer words, but one, has a single shingle of them all.
    """
    counts = np.diff(at)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(n)])
    places = np.arange(begin[-1]) - np.repeat(begin[:-1], n) + np.repeat(at[:-1], n)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    size = np.repeat(np.minimum(counts, width), n)
    total = size.astype(np.uint64) * SHINGLE_FACTOR[15]
    for k in range(width):
        total = mix(total ^ np.where(k < size, padded[places + k], np.uint64(0)) * SHINGLE_FACTOR[k])
    return total, begin, places


def shingle_kinds(word: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each shingle of words given by kind, and where each text's begin: equal if all their words are."""
    keys, begin, places = shingles(mix(word.astype(np.uint64)), at, width)
    size = np.repeat(np.minimum(np.diff(at), width), np.diff(begin))
    padded = np.concatenate([word, np.zeros(width, word.dtype)])

    def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = size[i] == size[j]
        for k in range(width):
            out &= (k >= size[i]) | (padded[places[i] + k] == padded[places[j] + k])
        return out

    return kinds(keys, same, lambda i: tuple(word[places[i] : places[i] + size[i]].tolist()))[1], begin


def plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words with a blank between two and an END behind the last, and where each text's bytes begin; data is in lower case."""
    size = ends - starts
    place = np.concatenate([[0], np.cumsum(size + 1)])
    empty = np.flatnonzero(np.diff(at) == 0)
    out = np.full(place[-1], BLANK, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(place[:-1], size) + within] = data[np.repeat(starts, size) + within]
    begin = place[at]
    last = at[1:][np.diff(at) > 0]
    out[place[last] - 1] = END
    if len(empty):
        out = np.insert(out, begin[empty], END)
        begin = begin + np.concatenate([[0], np.cumsum(np.diff(at) == 0)])
    return out, begin
