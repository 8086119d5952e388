"""Byte-level BPE: a bounded-lookahead transducer over a public merge list, and its decoder.

The merge list decides how far the text to the right can reach back (`lookahead`).
A token whose end lies at least that many bytes before the end of what has been read
cannot change any more; it is emitted and its bytes are forgotten, so a run of letters
of any length is encoded in constant memory. Texts are cut into pretokens as arrays
over code points; a pretoken's ids are looked up by its text and made once per worker.
A pretoken that ends within the lookahead is stable only when it ends, so all such ones of a
chunk are merged together; longer ones go through the stream. Texts longer than a chunk
are taken in parts that end where a pretoken ends.

Rows: a null text counts as empty: no ids, an empty decoded text. The text of an added
token (such as an end mark) is that token, as in the tokenizers library. Any id may
come twice. Other columns do not pass through.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import bytewords as bw
from strataloom.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Pretokens kept by a worker; bytes that the transducer takes in beyond its lookahead.
CACHED, WINDOW = 200_000, 256

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 255
#: Unicode's white space (fixed values).
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point by Unicode's letters, numbers and white space; UNKNOWN where this Python's Unicode has no character."""
    known = {"L": LETTER, "N": NUMBER}
    out = np.array([UNKNOWN if (kind := category(chr(c))) == "Cn" else known.get(kind[0], OTHER) for c in range(0x110000)], np.uint8)
    out[list(WHITE)] = SPACE
    return out


def _ask(point: int) -> int:
    """Class of a code point in the tokenizers library, whose Unicode may be newer: the one whose neighbours it joins."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    return next((kind for kind, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(f"{beside}{chr(point)}{beside}")) == 1), SPACE)


def classes(points: np.ndarray) -> np.ndarray:
    kind = _classes()[points]
    if (kind == UNKNOWN).any():
        for point in np.unique(points[kind == UNKNOWN]).tolist():
            _classes()[point] = _ask(point)
        kind = _classes()[points]
    return kind


#: The endings that follow an apostrophe as a pretoken of their own (fixed values of the tokenizer's pattern).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def pretokens(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all pretokens in code points; offsets part texts, over which no pretoken reaches."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes(points)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space, blank = kind == SPACE, points == 0x20
    # The last white space before something else in its text: a blank goes with what follows, another is alone.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
    start[np.flatnonzero(last)] = True
    start[np.flatnonzero(last & blank) + 1] = False
    # An apostrophe that begins a pretoken takes a listed ending along; what follows the ending starts anew.
    for q in np.flatnonzero((points == 0x27) & start).tolist():
        for ending in ENDINGS:
            stop = q + 1 + len(ending)
            if stop <= n and not edge[q + 1 : stop].any() and all(points[q + 1 + i] == ord(c) for i, c in enumerate(ending)):
                start[q + 1] = False
                if stop < n:
                    start[stop] = True
                break
    return np.flatnonzero(start)


class Merges:
    """A tokenizer file's vocabulary and merges over bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        others = [b for b in range(256) if b not in set(plain)]
        to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        vocab = dict(spec["model"]["vocab"])
        self.added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.text: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.text[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for token, i in self.added.items():
            self.text[i] = token.encode()
        self.size = size
        self.single = [vocab[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = (n, vocab[a + b])
        self.lookahead = self._lookahead()
        self.none = len(self.rank)
        self.wholes = np.array([whole for _, whole in self.rank.values()], np.int64)
        pairs = np.array([a * self.size + b for a, b in self.rank], np.int64)
        self.by_key = np.argsort(pairs)
        self.keys = pairs[self.by_key]

    def _lookahead(self) -> int:
        """Bytes right of a place that can decide whether a merge crosses it.

        Whether a merge (a, b) takes place is changed from the right only by an earlier
        merge whose left part is b or one of the tokens at b's right end while b is built;
        that one reaches over its own right part and as far again as it can be changed.
        As ranks fall along such a chain, one pass in order of rank finds the longest.
        """
        made: dict[int, tuple[int, int]] = {}  # token: rank and right part of the merge that makes it
        ranks: dict[int, list[int]] = {}  # left part: ranks so far, and the farthest reach up to each
        reach: dict[int, list[int]] = {}
        longest = 1
        for (a, b), (rank, whole) in self.rank.items():
            beyond, token, limit = 0, b, rank
            while True:
                if (k := bisect_left(ranks.get(token, []), limit)) > 0:
                    beyond = max(beyond, reach[token][k - 1])
                if token not in made:
                    break
                limit, token = made[token]
            far = len(self.text[b]) + beyond
            longest = max(longest, far)
            ranks.setdefault(a, []).append(rank)
            reach.setdefault(a, []).append(max(far, reach[a][-1] if reach.get(a) else 0))
            made.setdefault(whole, (rank, b))
        return longest

    def merge(self, ids: list[int]) -> list[int]:
        """All merges over a short run of tokens, lowest rank and leftmost first."""
        rank = self.rank
        while len(ids) > 1:
            best, at = None, -1
            for i in range(len(ids) - 1):
                r = rank.get((ids[i], ids[i + 1]))
                if r is not None and (best is None or r[0] < best[0]):
                    best, at = r, i
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def stream(self, parts: Iterator[bytes]) -> Iterator[int]:
        """Ids of one pretoken that comes in parts; besides a part, it holds a window and the lookahead at most."""
        window = max(WINDOW, max(map(len, self.text)))
        held = bytearray()
        for part in parts:
            held += part
            while len(held) >= window + self.lookahead:
                done = 0
                for i in self.merge([self.single[b] for b in held[: window + self.lookahead]]):
                    if done + len(self.text[i]) > window:
                        break
                    done += len(self.text[i])
                    yield i
                del held[:done]
        yield from self.merge([self.single[b] for b in held])

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of pretokens: short ones all at once, long ones as a stream."""
        out: list[list[int]] = [[]] * len(words)
        short: dict[int, list[tuple[int, bytes]]] = {}
        for j, word in enumerate(words):
            raw = word.encode()
            if word in self.added:
                out[j] = [self.added[word]]
            elif len(raw) <= 64:
                short.setdefault((len(raw) + 3) // 4 * 4, []).append((j, raw))
            else:
                out[j] = list(self.stream(raw[i : i + WINDOW] for i in range(0, len(raw), WINDOW)))
        for width, found in short.items():
            for (j, _), ids in zip(found, self._merge_many([raw for _, raw in found], width), strict=True):
                out[j] = ids
        return out

    def _merge_many(self, raws: list[bytes], width: int) -> list[list[int]]:
        """merge() over runs of at most `width` bytes, a merge of every run at a time."""
        rows = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(-1, width)
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        ids = np.where(np.arange(width) < size[:, None], np.array(self.single, np.int64)[rows], -1)
        ids = np.concatenate([ids, np.full((len(raws), 1), -1)], 1)
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        out: list[list[int]] = [[]] * len(raws)
        live = np.arange(len(raws))
        column = np.arange(width)
        while len(live):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(live)), at]
            more = best < self.none
            for j, row in zip(live[~more].tolist(), ids[~more].tolist(), strict=True):
                out[j] = row[: row.index(-1)]
            live, ids, ranks, at, best = live[more], ids[more], ranks[more], at[more], best[more]
            each = np.arange(len(live))
            ids[each, at] = self.wholes[best]
            move = column + (column > at[:, None])
            ids[:, :-1] = np.take_along_axis(ids, move, 1)
            ranks = np.take_along_axis(np.concatenate([ranks, np.full((len(live), 1), self.none)], 1), move, 1)
            ranks[each, at] = self._ranks(ids[each, at], ids[each, at + 1])
            left = np.maximum(at - 1, 0)
            ranks[each, left] = np.where(at > 0, self._ranks(ids[each, left], ids[each, at]), ranks[each, left])
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = np.where((a < 0) | (b < 0), -1, a * self.size + b)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.by_key[place], self.none)


class Decoder:
    """Bytes of tokens to text, a piece at a time; holds the bytes of one unfinished character at most."""

    def __init__(self, text: list[bytes]):
        self.text, self.state = text, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.text.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(2)
def merges(path: str) -> Merges:
    return Merges(path)


class Encoder:
    """Ids of many texts at once. `make` gives the ids of pretokens that are new to this worker."""

    def __init__(self, added: list[str], make: Callable[[list[str]], list[list[int]]], keep: int = CACHED):
        import re

        self.make, self.keep, self.known, self.older = make, keep, {}, {}
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.cuts = not any(c.isspace() for mark in added for c in mark)

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where each text's begin."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if len(offsets) == 2 and len(data) > bw.CHUNK:
            ids = np.concatenate([self._chunk(x, np.array([0, len(x)]))[0] for x in self.pieces(data)])
            return ids, np.array([0, len(ids)])
        return self._chunk(data, offsets)

    def pieces(self, data: np.ndarray, size: int = bw.CHUNK) -> Iterator[np.ndarray]:
        """A long text in parts of about `size` bytes, parted before a blank between two bytes that are no white space.

        A pretoken always begins there. A text without such a place is one part.
        """
        a = 0
        while self.cuts and len(data) - a > size:
            near = data[a + size // 2 : len(data)]
            for i in range(0, len(near), size):
                part = near[i : i + size + 2]
                # Beyond ASCII there is white space too, so only ASCII bytes count as none.
                plain = (part > 0x20) & (part < 0x7F)
                found = np.flatnonzero(plain[:-2] & (part[1:-1] == 0x20) & plain[2:])
                if len(found):
                    break
            else:
                break
            b = a + size // 2 + i + int(found[0]) + 1
            yield data[a:b]
            a = b
        yield data[a:]

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = data.tobytes().decode("utf-8", "replace")
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        marks = [m.span() for m in self.added.finditer(text)] if self.added else []
        marks = [(a, b) for a, b in marks if np.searchsorted(at, a, "right") == np.searchsorted(at, b - 1, "right")]
        edges = np.unique(np.concatenate([at[at < len(points)], *([a, b] if b < len(points) else [a] for a, b in marks)])).astype(np.int64)
        starts = pretokens(points, edges)
        for a, b in marks:
            starts = starts[(starts <= a) | (starts >= b)]
        ends = np.append(starts[1:], len(points))
        lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        first, kind = bw.span_kinds(data, lead[starts], lead[ends])
        keys = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        packed = list(map(self.known.get, keys))
        new = [j for j, x in enumerate(packed) if x is None]
        for j in new if self.older else ():
            if (x := self.older.get(keys[j])) is not None:
                packed[j] = self.known[keys[j]] = x
        if new := [j for j in new if packed[j] is None]:
            if len(self.known) > self.keep:
                self.known, self.older = {}, self.known
            for j, ids in zip(new, self.make([keys[j] for j in new]), strict=True):
                packed[j] = np.array(ids, np.uint32).tobytes()
                if len(keys[j]) <= bw.LONG:
                    self.known[keys[j]] = packed[j]
        flat = np.frombuffer(b"".join(packed), np.uint32)
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        begin = np.cumsum(size) - size
        each = size[kind]
        done = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(begin[kind] - done[:-1], each) + np.arange(done[-1])]
        return ids, done[np.searchsorted(starts, at)]

    def texts(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each chunk of a text column: its range, the ids and where each text's begin."""
        data, offsets = bw.buffers(column)
        for a, b in bw.chunks(offsets):
            part = offsets[a : b + 1]
            yield a, b, *self.chunk(data[part[0] : part[-1]], part - part[0])


@lru_cache(2)
def own_encoder(path: str) -> Encoder:
    m = merges(path)
    return Encoder(list(m.added), m.encode)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Rows (doc_id, ids array<int>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = own_encoder(path)
        for batch in batches:
            for a, b, ids, begin in encoder.texts(batch.column(1)):
                lists = pa.ListArray.from_arrays(begin.astype(np.int32), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_ids(rows: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Rows (doc_id, text) of rows (doc_id, ids); null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = merges(path).text
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                out = []
                for ids in part.column(1):
                    decoder, ids = Decoder(text), ids.values.to_pylist() if ids.is_valid else []
                    out.append("".join(decoder.feed(ids[k : k + 4096]) for k in range(0, len(ids), 4096)) + decoder.finish())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), encoded and decoded in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, text = own_encoder(path), merges(path).text
        names = list(map(str, range(len(text))))
        for batch in batches:
            for a, b, ids, begin in encoder.texts(batch.column(1)):
                n, of_ids, of_text = [], [], []
                for i in range(b - a):
                    own = ids[begin[i] : begin[i + 1]].tolist()
                    decoder, digest = Decoder(text), hashlib.sha256()
                    for k in range(0, len(own), 4096):
                        digest.update(decoder.feed(own[k : k + 4096]).encode())
                    digest.update(decoder.finish().encode())
                    n.append(len(own))
                    of_ids.append(hashlib.sha256(",".join(map(names.__getitem__, own)).encode()).hexdigest())
                    of_text.append(digest.hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every document."""
    return digests(table(spark, sf_dir, "documents"))
