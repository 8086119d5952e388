"""MinHash near-duplicates by a signature-coordinate inverted join, confirmed on whole shingle sets.

1. Each text gets the number of its distinct 5-word shingles, a 128-bit digest of its words and a
   signature of 32 minima. Texts of equal words collapse to one representative.
2. Representatives are posted under (coordinate, minimum). Minima that nobody shares
   go; so do texts with fewer than `matches` shared minima, as no link can reach them.
3. Prefix: of a text's 32 postings ordered from rare to frequent, only the first
   32 - matches + 1 are joined; two texts with that many equal minima meet there.
4. Postings of up to `LIST` texts are joined pair by pair; a pair is counted only at
   its first shared posting, the others are skipped, and stays if it has `matches`
   equal minima. Then it is confirmed on the two whole sets.
5. Longer postings are united into clusters. First the texts of a posting are intersected in runs by
   size, which joins most of a large group of near copies at a linear cost.
   Then a cluster is cut into blocks of bounded volume, those of a large component by themselves; each
   pair of blocks whose sizes allow a link, and that are not of one component, is
   intersected exactly as a matrix product, and only a spanning forest leaves the task.
6. Links become components.

Hashes only find candidates. What travels are texts, and a link is confirmed on sets of shingles
whose words have been compared byte by byte. A pair at the threshold exactly has fewer than `MATCHES`
equal minima with a probability of about 1e-8; matches=1 joins every posting, for those who want it exact.

Rows: a null text, an empty text or one of white space has an empty set and links with
nothing. A null id takes no part: n_shingles is given, component_id is null, kept is true.
Repeated ids are the same document. Other columns of the input do not pass through, but for those named in `keep`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.llm import bytewords as bw
from strataloom.llm.common import bounded, components, cut, table

#: Coordinates of a signature, and the least number that two linked texts are taken to share.
COORDINATES, MATCHES = 32, 14
WIDTH, PERCENT = 5, 85
#: Texts of a posting joined pair by pair; shingles of a block in a longer one's cluster; bytes of texts confirmed together.
LIST, BLOCK_SHINGLES, TOGETHER = 32, 120_000, 1 << 19
#: Texts of a run.
RUN = 32

MIXED = -(2**63) + 1

_FACTORS = bw._odd(256)
_MASKS = bw._odd(256)


def signature(hashes: np.ndarray, begin: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """Minima (upper 32 bits) of k permutations of each text's shingles; texts without any are left out."""
    at = begin[:-1][np.diff(begin) > 0]
    out = np.empty((len(at), k), np.uint32)
    for i in range(k):
        out[:, i] = np.minimum.reduceat((hashes ^ _MASKS[i]) * _FACTORS[i], at) >> np.uint64(32) if len(at) else 0
    return out


def _worded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts in lower case; starts and ends of their words, and where each text's begin."""
    data = bw.LOWER[data]
    return data, *bw.words(data, offsets)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = bw.buffers(batch.column(1))
        for a, b in bw.chunks(offsets):
            part = offsets[a : b + 1]
            own, starts, ends, at = _worded(data[part[0] : part[-1]], part - part[0])
            hashes = bw.span_hash(own, starts, ends)
            sh, begin, _ = bw.shingles(hashes, at, WIDTH)
            kind, _ = bw.shingle_kinds(bw.span_kinds(own, starts, ends, hashes)[1], at, WIDTH)
            owner = np.repeat(np.arange(b - a), np.diff(begin))
            n = np.bincount(np.unique(owner << 32 | kind) >> 32, minlength=b - a)
            sigs = signature(sh, begin)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum((n > 0) * COORDINATES)]).astype(np.int32), pa.array(sigs.ravel().view(np.int32)))
            text, place = bw.plain(own, starts, ends, at)
            prints = [hashlib.blake2b(text[i:j], digest_size=16).digest() if x else None for i, j, x in zip(place[:-1].tolist(), place[1:].tolist(), n.tolist(), strict=True)]
            rest = [batch.column(i).slice(a, b - a) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *rest, pa.array(n), pa.array(prints, pa.binary()), lists], ["doc_id", *batch.schema.names[2:], "n_shingles", "print", "sig"])


def _sets(texts: list[pa.Buffer | None]) -> list[np.ndarray]:
    """The shingle set of each text as numbers that stand for the same shingle in all of them."""
    size = np.array([t.size if t else 0 for t in texts], np.int64)
    data = np.frombuffer(b"".join(t for t in texts if t), np.uint8)
    own, starts, ends, at = _worded(data, np.concatenate([[0], np.cumsum(size)]))
    kind, begin = bw.shingle_kinds(bw.span_kinds(own, starts, ends)[1], at, WIDTH)
    return [np.unique(kind[i:j]) for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _collide(batches: Iterator[pa.RecordBatch], matches: int) -> Iterator[pa.RecordBatch]:
    """Pairs (key, a, b, sig_a, sig_b, prefix_a, prefix_b) at their first shared posting with enough equal minima."""
    for batch in batches:
        if not len(batch):
            continue
        c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        equal = _matrix(c["sig_a"]) == _matrix(c["sig_b"])
        both = c["prefix_a"].to_numpy() & c["prefix_b"].to_numpy()
        shared = equal & ((both[:, None] >> np.arange(COORDINATES)) & 1).astype(bool)
        first = shared.argmax(1) == c["key"].to_numpy() >> 32
        keep = pa.array(first & (equal.sum(1) >= matches))
        yield pa.RecordBatch.from_arrays([c["a"].filter(keep), c["b"].filter(keep)], ["a", "b"])


def linked(shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * shared >= PERCENT * (n + m - shared)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = ([v.as_buffer() for v in batch.column(i)] for i in (2, 3))
        size = np.concatenate([[0], np.cumsum([a.size + b.size for a, b in zip(x, y, strict=True)])])
        for i, j in bw.chunks(size, TOGETHER):
            sets = _sets(x[i:j] + y[i:j])
            keep = pa.array([bool(linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))) for a, b in zip(sets[: j - i], sets[j - i :], strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).filter(keep), batch.column(1).slice(i, j - i).filter(keep)], ["u", "v"])


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between places a and b of ids: each id that is linked, with the least id it reaches."""
    least = ids.copy()
    while len(a):
        low = np.minimum(least[a], least[b])
        before = least.copy()
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        if (before == least).all():
            break
    there = np.flatnonzero(least != ids)
    return ids[there], least[there]


def _block_pair(group: pa.Table) -> pa.Table:
    """Exact links inside one block, or between two, as a spanning forest."""
    group = group.combine_chunks()
    ids, side = group.column("rep").to_numpy(), group.column("side").to_numpy()
    sets = _sets([x.as_buffer() for chunk in group.column("text").chunks for x in chunk])
    n = np.array([len(x) for x in sets])
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    same = not len(right)
    right = left if same else right
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    often = count > 1
    number = np.cumsum(often) - 1
    use = often[place]
    owner, place = owner[use], number[place[use]]
    shared = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for start in range(0, int(often.sum()), 2048):
        i, j = np.searchsorted(place, [start, start + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[i:j], place[i:j] - start] = 1
        shared += part[left] @ part[right].T
    found = linked(shared.astype(np.int64), n[left][:, None], n[right][None, :])
    if same:
        found = np.triu(found, 1)
    i, j = np.nonzero(found)
    u, v = forest(ids, left[i], right[j])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _runs(long_: DataFrame, texts: DataFrame) -> DataFrame:
    """Forest edges inside runs of texts that follow each other by size in a long posting (key, texts, rep, n_shingles).

    Each text takes part in its two longest postings, whose members mostly join in this way; a posting is salted.
    """
    rank = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("texts"), "key"))
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("texts") / 1024))
    members = long_.withColumn("rank", rank).where("rank <= 2").select("key", part.alias("salt"), "rep", "n_shingles")
    n = F.row_number().over(Window.partitionBy("key", "salt").orderBy("n_shingles", "rep"))
    run = F.floor((n - 1) / RUN)
    # The first of a run is the last of the one before as well.
    runs = F.when(((n - 1) % RUN == 0) & (n > 1), F.array(run - 1, run)).otherwise(F.array(run))
    rows = members.withColumn("runs", runs).select("key", "salt", "rep", F.explode("runs").alias("run"), F.lit(0).alias("side"))
    return rows.join(texts, "rep").groupBy("key", "salt", "run").applyInArrow(_block_pair, "u long, v long")


def _long_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Forest edges inside clusters: members (rep, cluster, component, n_shingles), what is known to be linked by component."""
    rows = members.withColumn("bin", F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100 / PERCENT))).cast("int"))
    large = rows.groupBy("cluster", "bin", "component").agg(F.sum("n_shingles").alias("volume")).where(F.col("volume") > BLOCK_SHINGLES)
    large = bounded(cut(large.select("cluster", "bin", "component", F.col("component").alias("part_of"))))
    # Blocks hold texts of one large component, or (MIXED) of several others.
    rows = cut(rows.join(large, ["cluster", "bin", "component"], "left").withColumn("part_of", F.coalesce("part_of", F.lit(MIXED))).drop("component"))
    parts = cut(rows.groupBy("cluster", "bin", "part_of").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("parts")))
    blocks = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = lambda s: blocks.select("cluster", F.col("bin").alias(f"bin_{s}"), F.col("part_of").alias(f"of_{s}"), F.struct("bin", "part_of", "part").alias(f"block_{s}"))
    beside = side("a").withColumn("bin_b", F.explode(F.array("bin_a", F.col("bin_a") + 1)))
    pairs = beside.join(side("b"), ["cluster", "bin_b"]).where(f"(bin_a < bin_b or block_a <= block_b) and (of_a <> of_b or of_a = {MIXED})")
    pairs = cut(pairs.select("cluster", "block_a", "block_b"))
    tasks = pairs.select("cluster", F.col("block_a").alias("block"), "block_a", "block_b", F.lit(0).alias("side"))
    tasks = tasks.unionByName(pairs.where("block_a <> block_b").select("cluster", F.col("block_b").alias("block"), "block_a", "block_b", F.lit(1).alias("side")))
    rows = rows.join(bounded(parts), ["cluster", "bin", "part_of"])
    rows = rows.select("rep", "cluster", F.struct("bin", "part_of", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part")).alias("block"))
    met = rows.join(bounded(tasks), ["cluster", "block"]).join(texts, "rep").select("cluster", "block_a", "block_b", "side", "rep", "text")
    return met.groupBy("cluster", "block_a", "block_b").applyInArrow(_block_pair, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), matches: int = MATCHES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept (see the module), and the columns `keep`."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    carried = "".join(f"{docs.schema[c].simpleString().replace(':', ' ', 1)}, " for c in keep)
    signed = cut(texts.mapInArrow(_sign, f"doc_id long, {carried}n_shingles long, print binary, sig array<int>"))
    classes = signed.where("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n_shingles"), F.any_value("sig").alias("sig"))
    classes = cut(classes)

    key = F.col("pos").cast("long") * 2**32 + F.col("value").cast("long").bitwiseAND(F.lit(2**32 - 1))
    posted = classes.select("rep", F.posexplode("sig").alias("pos", "value")).select("rep", key.alias("key"))
    counts = cut(posted.groupBy("key").agg(F.count("*").alias("texts")).where("texts > 1"))
    # The few keys that many texts share go to every task, so that none of them lands in one.
    frequent = max(LIST, classes.count() // 1000)
    often = bounded(counts.where(F.col("texts") > frequent))
    shared = posted.join(often, "key").unionByName(posted.join(often.select("key"), "key", "left_anti").join(counts.where(F.col("texts") <= frequent), "key"))
    # Without the texts' own minima, the first of the others up to the prefix's end are what a text is joined by.
    mine = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("texts", "key"))).alias("keys")).where(F.size("keys") >= matches)
    mine = mine.select("rep", F.slice("keys", 1, F.size("keys") - matches + 1).alias("keys"))
    prefix = F.aggregate("keys", F.lit(0).cast("long"), lambda m, k: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftright", k["key"], F.lit(32)).cast("int"))))
    chosen = cut(mine.withColumn("prefix", prefix).join(classes, "rep").select("rep", "keys", "prefix", "sig", "n_shingles"))

    postings = chosen.select("rep", "prefix", "sig", "n_shingles", F.explode("keys").alias("k")).select("rep", "prefix", "sig", "n_shingles", "k.key", "k.texts")
    long_ = cut(postings.where(F.col("texts") > LIST).select("key", "texts", "rep", "n_shingles"))
    heads = bounded(cut(long_.groupBy("key").agg(F.min("rep").alias("head"))))
    united = components(long_.select("key", "rep").join(heads, "key").select(F.col("rep").alias("u"), F.col("head").alias("v")))
    members = cut(united.select(F.col("node").alias("rep"), F.col("component").alias("cluster")).join(chosen.select("rep", "n_shingles"), "rep"))

    short = postings.where(F.col("texts") <= LIST)
    side = lambda s: short.select("key", F.col("rep").alias(s), F.col("sig").alias(f"sig_{s}"), F.col("prefix").alias(f"prefix_{s}"))
    met = side("a").join(side("b"), "key").where("a < b")
    pairs = met.select("key", "a", "b", "sig_a", "sig_b", "prefix_a", "prefix_b").mapInArrow(lambda batches: _collide(batches, matches), "a long, b long")
    in_cluster = lambda s: members.select(F.col("rep").alias(s), F.col("cluster").alias(f"cluster_{s}"))
    pairs = pairs.join(in_cluster("a"), "a", "left").join(in_cluster("b"), "b", "left").where("cluster_a is null or cluster_b is null or cluster_a <> cluster_b")
    pairs = cut(pairs.select("a", "b"))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(members.select("rep")).distinct()
    found = cut(texts.select(F.col("doc_id").alias("rep"), F.col("text").cast("binary").alias("text")).join(wanted, "rep", "left_semi").dropDuplicates(["rep"]))
    one = pairs.join(found.select(F.col("rep").alias("a"), F.col("text").alias("x")), "a").join(found.select(F.col("rep").alias("b"), F.col("text").alias("y")), "b")
    links = cut(one.select("a", "b", "x", "y").mapInArrow(_confirm, "u long, v long").unionByName(_runs(long_, found)))
    known = components(links).select(F.col("node").alias("rep"), "component")
    members = members.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    joined = components(links.unionByName(_long_links(members, found))).select(F.col("node").alias("rep"), "component")

    named = classes.select("print", "rep").join(joined, "rep", "left").select("print", F.coalesce("component", "rep").alias("reached"))
    reached = F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id"))
    out = signed.drop("sig").join(named, "print", "left").select("doc_id", *keep, "n_shingles", reached.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shingle set size and near-duplicate component."""
    return near_duplicates(table(spark, sf_dir, "documents"))
