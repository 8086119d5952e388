"""Context-tree weighting over byte contexts, learned from all training texts and scored on whole texts.

A text is its lower-cased words, a blank between two and an end mark (a line feed, which no
word holds) behind the last. Each byte is eight binary decisions; a node is a context of
0 to `DEPTH` bytes and the bits of the byte so far, and holds how often 0 and 1 came there.
Its Krichevsky-Trofimov estimate is mixed with the weighted probability of its longer
contexts, half and half, from the deepest up; the weight that a node's own estimate has
after training, and that estimate, are all that scoring needs. A longer context that was
never seen adds nothing to go by, so the mixture ends at the node above it.

Training counts (DEPTH + 1)-byte grams over all texts and deals them by the nearest TOP + 1
bytes of context, so that every node of more than `TOP` bytes lies in one bucket with all its
longer ones: a task builds them there, no node is left out, and only sums for the nodes of
`TOP` bytes leave it. Those and the shorter ones, at most 255 * (256^TOP + ... + 1) at any
corpus size, are sent to every task. So are the results of the commonest grams, as a cache;
every other gram of a text goes to its bucket and is scored against all the nodes there.

Rows: a null text is an empty one; an empty text is the end mark alone. Repeated ids and
rows count each. Without training texts every bit has probability one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import bytewords as bw
from strataloom.llm.common import crc_mod, cut, spread, table

DEPTH = 5
#: Bytes of context up to which nodes are sent to every task; buckets of grams (a power of two); grams worked on at once.
TOP, BUCKET_BITS, TOGETHER = 2, 16, 100_000
#: Grams whose result, and words whose count, is sent to every task (the others' are joined).
SENT_GRAMS, SENT_WORDS = 1 << 21, 1 << 20
_U = np.uint64


def code_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes to code for each text of a chunk, in turn, and where each text's begin."""
    return bw.plain(bw.LOWER[data], *bw.words(data, offsets))


def grams(code: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each byte, it and the DEPTH bytes before it in its text, the nearest lowest; end marks stand before a text."""
    out = code.astype(np.uint64)
    behind = np.arange(len(code)) - np.repeat(begin[:-1], np.diff(begin))
    for d in range(1, DEPTH + 1):
        before = np.full(len(code), bw.END, np.uint64)
        before[d:] = code[:-d] if d < len(code) else code[:0]
        before[behind < d] = bw.END
        out |= before << _U(8 * d)
    return out


def nodes(gram: np.ndarray, depth: int, bit: int) -> np.ndarray:
    """Names of the nodes that decide `bit` (0 the highest) of each gram's byte in a context of `depth` bytes.

    Lowest first: the byte's bits so far behind a leading 1, the context, the depth.
    """
    context = (gram >> _U(8)) & _U((1 << 8 * depth) - 1)
    so_far = (_U(0x100) | (gram & _U(0xFF))) >> _U(8 - bit)
    return so_far | context << _U(8) | _U(depth) << _U(56)


def slot_of(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place for each node, one of its own as bw.mix() is one-to-one, and the bucket of that place."""
    h = bw.mix(name)
    return h.view(np.int64), (h >> _U(64 - BUCKET_BITS)).astype(np.int32)


def bucket_of(gram: np.ndarray) -> np.ndarray:
    """Bucket of the nearest TOP + 1 bytes of context."""
    return slot_of(nodes(gram, TOP + 1, 0))[1]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of training texts with counts, summed over a few chunks at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merge() -> tuple[np.ndarray, np.ndarray]:
        kinds, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate([c for _, c in held])).astype(np.int64)
        held.clear()
        return kinds, sums

    def flush(kinds: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket_of(kinds)), pa.array(kinds.view(np.int64)), pa.array(sums)], ["bucket", "gram", "n"])

    for batch in batches:
        data, offsets = bw.buffers(batch.column(0))
        for a, b in bw.chunks(offsets):
            part = offsets[a : b + 1]
            held.append(np.unique(grams(*code_bytes(data[part[0] : part[-1]], part - part[0])), return_counts=True))
            if sum(len(k) for k, _ in held) > 1_500_000:
                merged = merge()
                if len(merged[0]) > 750_000:
                    yield flush(*merged)
                else:
                    held.append(merged)
    if held:
        yield flush(*merge())


def log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log(Gamma(n + 1/2) / Gamma(1/2)) for counts n."""
    x = n + 0.5
    shift = np.zeros_like(x)
    for _ in range(8):
        small = x < 8
        shift = np.where(small, shift - np.log(np.where(small, x, 1)), shift)
        x = np.where(small, x + 1, x)
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return series + shift - 0.5 * np.log(np.pi)


def log_factorial(n: np.ndarray) -> np.ndarray:
    x = n + 1.0
    shift = np.zeros_like(x)
    for _ in range(8):
        small = x < 8
        shift = np.where(small, shift - np.log(np.where(small, x, 1)), shift)
        x = np.where(small, x + 1, x)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) + shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma_half(zeros) + log_gamma_half(ones) - log_factorial(zeros + ones)


def _place(names: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `name` among ascending `names`, and whether they are there."""
    if not len(names):
        return np.zeros(len(name), np.int64), np.zeros(len(name), bool)
    place = np.minimum(np.searchsorted(names, name), len(names) - 1)
    return place, names[place] == name


def _kept_bits(name: np.ndarray, bits: int) -> np.ndarray:
    return name & _U((1 << bits) - 1)


class Level:
    """All nodes of one depth, for each bit in ascending order of their name: the context, then the byte's bits so far.

    counts: for each bit names, zeros and ones. longer: for each bit the sums of the longer
    contexts' weighted log probabilities, None at the deepest.
    """

    def __init__(self, depth: int, counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], longer: list[np.ndarray] | None):
        self.depth, self.counts, self.names = depth, counts, [c[0] for c in counts]
        self.mixed, self.weight = [], []
        for bit, (_, zeros, ones) in enumerate(counts):
            own = log_kt(zeros, ones)
            both = own if longer is None else np.logaddexp(own, longer[bit])
            self.mixed.append(own if longer is None else both - np.log(2))
            self.weight.append(np.exp(own - both))

    def shorter(self) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], list[np.ndarray]]:
        """Counts and sums for the nodes one byte shorter."""
        counts, longer = [], []
        for bit, (name, zeros, ones) in enumerate(self.counts):
            kinds, inverse = np.unique(_kept_bits(name, 8 * (self.depth - 1) + bit), return_inverse=True)
            sums = [np.bincount(inverse, x, len(kinds)) for x in (zeros, ones, self.mixed[bit])]
            counts.append((kinds, sums[0], sums[1]))
            longer.append(sums[2])
        return counts, longer

    def reach(self, parent: Level | None) -> None:
        """From the next shorter nodes: what the mixture has at each node, the weight left, and its estimate if it ends there."""
        self.total, self.left, self.one = [], [], []
        for bit, (name, zeros, ones) in enumerate(self.counts):
            own = (ones + 0.5) / (zeros + ones + 1)
            total, left = np.zeros(len(name)), np.ones(len(name))
            if parent is not None:
                place = np.searchsorted(parent.names[bit], _kept_bits(name, 8 * parent.depth + bit))
                total, left = parent.total[bit][place], parent.left[bit][place]
            self.total.append(total + left * self.weight[bit] * own)
            self.left.append(left * (1 - self.weight[bit]))
            self.one.append(self.total[bit] + self.left[bit] * own)
        del self.counts, self.mixed, self.weight


def _longest(gram: np.ndarray, n: np.ndarray) -> list[Level]:
    """Levels DEPTH to TOP + 1 of all grams (distinct) of some buckets."""
    order = np.argsort(gram)
    gram, n = gram[order], n[order].astype(float)
    counts = []
    for bit in range(8):
        name = gram >> _U(8 - bit)
        at = np.flatnonzero(np.diff(name, prepend=~name[:1]))
        total, ones = (np.add.reduceat(x, at) if len(at) else np.zeros(0) for x in (n, n * ((gram >> _U(7 - bit)) & _U(1))))
        counts.append((name[at], total - ones, ones))
    levels = [Level(DEPTH, counts, None)]
    while levels[-1].depth > TOP + 1:
        levels.append(Level(levels[-1].depth - 1, *levels[-1].shorter()))
    return levels


def _reached(levels: list[Level], parent: Level | None) -> list[Level]:
    """Levels, shortest first, reached from `parent`."""
    out = levels[::-1]
    for level in out:
        level.reach(parent)
        parent = level
    return out


def log10(gram: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each gram's byte behind its context, from all levels, shortest first."""
    out = np.zeros(len(gram))
    for bit in range(8):
        one = np.full(len(gram), 0.5)
        for level in levels:
            # A node's shorter ones are there too, so the last one found is where the mixture ends.
            place, there = _place(level.names[bit], _kept_bits(gram, 8 * (level.depth + 1)) >> _U(8 - bit))
            one[there] = level.one[bit][place[there]]
        one = np.clip(one, 1e-9, 1 - 1e-9)
        out += np.log10(np.where((gram >> _U(7 - bit)) & _U(1), one, 1 - one))
    return out


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams and counts of whole buckets, from rows (bucket, gram, n) in order of bucket."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not len(batch):
            continue
        bucket, gram, n = (batch.column(i).to_numpy() for i in range(3))
        if sum(len(h[0]) for h in held) >= TOGETHER:
            ends = int(np.searchsorted(bucket, held[-1][0][-1], "right"))
            held.append([bucket[:ends], gram[:ends], n[:ends]])
            bucket, gram, n = bucket[ends:], gram[ends:], n[ends:]
            if len(bucket):
                yield np.concatenate([h[1] for h in held]).view(np.uint64), np.concatenate([h[2] for h in held])
                held = []
        if len(bucket):
            held.append([bucket, gram, n])
    if held:
        yield np.concatenate([h[1] for h in held]).view(np.uint64), np.concatenate([h[2] for h in held])


def _top_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the nodes of TOP bytes: (node, zeros, ones, longer)."""
    for gram, n in _whole_buckets(batches):
        counts, longer = _longest(gram, n)[-1].shorter()
        name = [name >> _U(bit) << _U(8) | _kept_bits(name, bit) | _U(1 << bit) for bit, (name, _, _) in enumerate(counts)]
        cols = [np.concatenate(x) for x in (name, [c[1] for c in counts], [c[2] for c in counts], longer)]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0].view(np.int64)), *map(pa.array, cols[1:])], ["node", "zeros", "ones", "longer"])


def gathered(df: DataFrame, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """Columns of a bounded frame on the driver, packed by batch before they are sent."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [batch.column(i).to_numpy().astype(t).tobytes() for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in raw], [f"c{i}" for i in range(len(kinds))])

    parts = df.mapInArrow(packed, ", ".join(f"c{i} binary" for i in range(len(kinds)))).toLocalIterator()
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    for row in parts:
        for held, raw, kind in zip(columns, row, kinds, strict=True):
            held.append(np.frombuffer(bytes(raw), kind))
    return [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(columns, kinds, strict=True)]


def train(texts: DataFrame) -> DataFrame:
    """All grams (bucket, gram, n) of a column of texts; a bucket lies in one partition, in order of bucket."""
    parts = texts.mapInArrow(_counted, "bucket int, gram long, n long")
    return cut(parts.repartition("bucket").groupBy("bucket", "gram").agg(F.sum("n").alias("n")).sortWithinPartitions("bucket"))


class Tree:
    """A trained tree: all grams, from which tasks build the nodes of their buckets; the levels up to TOP; the commonest grams' results."""

    def __init__(self, counts: DataFrame, rows: int, top: list[Level], known: np.ndarray, logs: np.ndarray):
        self.counts, self.rows, self.top = counts, rows, top
        order = np.argsort(known)
        self.known, self.logs = known[order], logs[order]


def gather(counts: DataFrame) -> Tree:
    """The tree of all grams (see train); what comes to the driver is bounded."""
    sums = counts.mapInArrow(_top_sums, "node long, zeros double, ones double, longer double")
    sums = sums.groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("longer"))
    name, zeros, ones, longer = gathered(sums, ("<u8", "<f8", "<f8", "<f8"))
    own, more = [], []
    for bit in range(8):
        there = np.flatnonzero((name & _U(0xFF)) >> _U(bit) == 1)
        named = name[there] >> _U(8) << _U(bit) | _kept_bits(name[there], bit)
        order = np.argsort(named)
        there = there[order]
        own.append((named[order], zeros[there], ones[there]))
        more.append(longer[there])
    levels = [Level(TOP, own, more)]
    while levels[-1].depth:
        levels.append(Level(levels[-1].depth - 1, *levels[-1].shorter()))
    top = _reached(levels, None)

    scale = F.floor(F.log2(F.col("n").cast("double")) * 8)
    steps = sorted(counts.groupBy(scale.alias("step")).count().collect(), reverse=True)
    least, room = None, SENT_GRAMS
    for step, rows in steps:
        if rows > room:
            break
        least, room = step, room - rows
    if least is None:
        return Tree(counts, sum(rows for _, rows in steps), top, np.zeros(0, np.uint64), np.zeros(0))
    sent = counts.sparkSession.sparkContext.broadcast(top)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = sent.value
        for gram, n in _whole_buckets(batches):
            often = gram[np.floor(np.log2(n) * 8) >= least]
            if len(often):
                logs = log10(often, [*top, *_reached(_longest(gram, n), top[-1])])
                yield pa.RecordBatch.from_arrays([pa.array(often.view(np.int64)), pa.array(logs)], ["gram", "log"])

    return Tree(counts, sum(rows for _, rows in steps), top, *gathered(counts.mapInArrow(results, "gram long, log double"), ("<u8", "<f8")))


def _missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, key, gram, n) of packed grams (key, missed)."""
    for batch in batches:
        size = np.array([len(x.as_buffer()) // 8 for x in batch.column(1)], np.int64)
        gram = np.frombuffer(b"".join(x.as_buffer() for x in batch.column(1)), np.uint64)
        owner = np.repeat(batch.column(0).to_numpy(), size)
        yield pa.RecordBatch.from_arrays([pa.array(bucket_of(gram)), pa.array(owner), pa.array(gram.view(np.int64)), pa.array(np.ones(len(gram), np.int64))], ["bucket", "key", "gram", "n"])


def gram_sums(missed: DataFrame, tree: Tree) -> DataFrame:
    """Sums (key, log) of the results of grams (bucket, key, gram, n), each scored in its bucket against all nodes there."""
    # Neighbouring buckets are put together up to about TOGETHER grams, but not below the number of partitions.
    parts = max(tree.rows // TOGETHER, spread(missed.sparkSession))
    shift = max(0, BUCKET_BITS - int(parts - 1).bit_length())
    sent = missed.sparkSession.sparkContext.broadcast(tree.top)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = sent.value
        part, held, levels = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            parts, gram, n = batch.column(0).to_numpy(), batch.column(2).to_numpy().view(np.uint64), batch.column(3).to_numpy()
            trained = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            keys = batch.column(1).fill_null(0).to_numpy()
            turns = np.flatnonzero(np.diff(parts * 2 + ~trained, prepend=-1))
            for a, b in zip(turns, [*turns[1:], len(parts)], strict=True):
                if parts[a] != part:
                    part, held, levels = parts[a], [], None
                if trained[a]:
                    held.append((gram[a:b], n[a:b]))
                    continue
                if levels is None:
                    every = [np.concatenate([h[i] for h in held]) if held else np.zeros(0, (np.uint64, np.int64)[i]) for i in range(2)]
                    levels, held = [*top, *_reached(_longest(*every), top[-1])], []
                kinds, inverse = np.unique(keys[a:b], return_inverse=True)
                sums = np.bincount(inverse, log10(gram[a:b], levels) * n[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(sums)], ["key", "log"])

    known = tree.counts.select("bucket", F.lit(None).cast("long").alias("key"), "gram", "n")
    every = known.unionByName(missed).select(F.call_function("shiftright", "bucket", F.lit(shift)).alias("part"), "key", "gram", "n")
    # A part's training grams come first, as their key is null.
    every = every.repartition("part").sortWithinPartitions("part", "key")
    return every.mapInArrow(score, "key long, log double").groupBy("key").agg(F.sum("log").alias("log"))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of training texts with counts, summed over a few chunks at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        data, offsets = bw.buffers(batch.column(0))
        for a, b in bw.chunks(offsets):
            part = offsets[a : b + 1]
            own = bw.LOWER[data[part[0] : part[-1]]]
            starts, ends, _ = bw.words(own, part - part[0])
            first, kind = bw.span_kinds(own, starts, ends)
            held.append(pa.table({"word": bw.span_array(own, starts[first], ends[first]), "n": np.bincount(kind, minlength=len(first))}))
            if sum(map(len, held)) > 500_000:
                held = [_summed(held)]
                if len(held[0]) > 250_000:
                    yield from held.pop().to_batches()
    if held:
        yield from _summed(held).to_batches()


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).combine_chunks()


class Words:
    """Counts of the training texts' commonest words, found by hash and told by their bytes, and the sums over all words."""

    def __init__(self, words: list[bytes], n: list[int], ends: int, total: int, distinct: int):
        self.data = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words], np.int64)
        self.ends_at, self.n = np.cumsum(size), np.array(n, np.int64)
        self.starts = self.ends_at - size
        hashes = bw.span_hash(self.data, self.starts, self.ends_at)
        # Of words that share a hash one is found here; the others are counted by the join, as all rare words are.
        self.hashes, self.place = np.unique(hashes, return_index=True)
        self.ends, self.total = ends, total
        self.log_all = float(np.log10(total + 0.1 * (distinct + 1)))

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of words, -1 where one is not among the commonest."""
        place, there = _place(self.hashes, bw.span_hash(data, starts, ends))
        out = np.full(len(starts), -1, np.int64)
        at, own = np.flatnonzero(there), self.place[place[there]] if there.any() else np.zeros(0, np.int64)
        same = bw.equal_spans(data, starts[at], ends[at], self.data, self.starts[own], self.ends_at[own])
        out[at[same]] = self.n[own[same]]
        return out


def count_words(texts: DataFrame) -> tuple[DataFrame, Words]:
    """Counts (word, n) of all words, and the commonest of them on the driver: SENT_WORDS of up to 64 bytes at most, by a least count."""
    counts = cut(texts.mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    ends = texts.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    short = counts.where(F.length("word") <= bw.LONG)
    scale = F.floor(F.log2(F.col("n").cast("double")) * 8)
    steps = sorted(short.groupBy(scale.alias("step")).count().collect(), reverse=True)
    least, room = None, SENT_WORDS
    for step, words in steps:
        if words > room:
            break
        least, room = step, room - words

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [x.as_buffer().size for x in batch.column(0)]
            cells = (b"".join(x.as_buffer() for x in batch.column(0)), np.array(size, np.uint8).tobytes(), batch.column(1).to_numpy().tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in cells], ["words", "size", "n"])

    words, n = [], []
    if least is not None:
        for text, size, many in short.where(scale >= least).select("word", "n").mapInArrow(packed, "words binary, size binary, n binary").toLocalIterator():
            ends_at = np.cumsum(np.frombuffer(bytes(size), np.uint8), dtype=np.int64).tolist()
            words += [bytes(text[a:b]) for a, b in zip([0, *ends_at], ends_at, strict=False)]
            n += np.frombuffer(bytes(many), np.int64).tolist()
    return counts, Words(words, n, ends, (sums["n"] or 0) + ends, sums["words"] + (ends > 0))


def scores(docs: DataFrame, tree: Tree, known: Words, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, n_bytes, base_score, score): log10 probabilities of each whole text.

    What a task cannot score by itself, rare grams and rare words, is kept beside the row and joined by the row's number.
    """
    context = docs.sparkSession.sparkContext
    sent, common = context.broadcast((tree.known, tree.logs)), context.broadcast(known)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (often, results), words = sent.value, common.value
        for batch in batches:
            data, offsets = bw.buffers(batch.column(1))
            for a, b in bw.chunks(offsets):
                part = offsets[a : b + 1]
                own = bw.LOWER[data[part[0] : part[-1]]]
                starts, ends, at = bw.words(own, part - part[0])
                code, begin = bw.plain(own, starts, ends, at)
                kinds, inverse = np.unique(grams(code, begin), return_inverse=True)
                place, there = _place(often, kinds)
                logs = np.zeros(len(kinds))
                logs[there] = results[place[there]]
                logs = np.add.reduceat(logs[inverse], begin[:-1])
                elsewhere = np.flatnonzero(~there[inverse])
                bounds = np.searchsorted(elsewhere, begin) * 8
                missed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(bounds), pa.py_buffer(kinds[inverse[elsewhere]])]).cast(pa.binary())
                first, word = bw.span_kinds(own, starts, ends)
                n = words.counts(own, starts[first], ends[first])[word]
                owner = np.repeat(np.arange(b - a), np.diff(at))
                sums = lambda x: np.bincount(owner, x, b - a)
                base = sums(np.where(n > 0, np.log10(np.maximum(n, 0) + 0.1) - words.log_all, 0)) + np.log10(words.ends + 0.1) - words.log_all
                found = sums(n > 0) + (words.ends > 0)
                rare = np.flatnonzero(n < 0)
                lists = pa.ListArray.from_arrays(np.searchsorted(rare, at).astype(np.int32), bw.span_array(own, starts[rare], ends[rare]))
                cols = [pa.array(np.diff(at) + 1), pa.array(found.astype(np.int64)), pa.array(np.diff(begin)), pa.array(base), pa.array(logs), missed, lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *cols], ["doc_id", "n_tokens", "n_common", "n_bytes", "base", "score", "missed", "rare"])

    first = rows.mapInArrow(score, f"doc_id {kind}, n_tokens long, n_common long, n_bytes long, base double, score double, missed binary, rare array<binary>")
    first = cut(first.withColumn("key", F.monotonically_increasing_id()))
    logs = gram_sums(first.where("length(missed) > 0").select("key", "missed").mapInArrow(_missed, "bucket int, key long, gram long, n long"), tree)
    found = first.select("key", F.explode("rare").alias("word")).join(counts, "word", "left")
    found = found.groupBy("key").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.1) - known.log_all).alias("more"), F.count("n").alias("n_rare"))
    out = first.drop("missed", "rare").join(found, "key", "left").join(logs, "key", "left").na.fill(0, ["more", "n_rare", "log"])
    return out.select("doc_id", "n_tokens", (F.col("n_common") + F.col("n_rare")).alias("n_known"), "n_bytes", (F.col("base") + F.col("more")).alias("base_score"), (F.col("score") + F.col("log")).alias("score"))


def op6_context_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under the tree and under word counts, learned from nine tenths of the ids."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 10) == 0
    texts = docs.where(~held_out).select("text")
    tree = gather(train(texts))
    counts, known = count_words(texts)
    out = scores(docs, tree, known, counts).withColumn("held_out", held_out).withColumn("train_tokens", F.lit(known.total).cast("long"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes")
