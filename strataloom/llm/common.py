"""Helpers that the corpus operators share: tables, lineage cuts, bounded broadcasts, components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side with at most so many narrow rows may be broadcast.
BROADCAST_ROWS = 50_000
#: Links of a node from which it may go to every task, and the most such nodes of one table of links.
HOT_LINKS, HOT_NODES = 64, 1000
#: At most so many links (16 bytes each) become components in one task; more are contracted in rounds over all tasks.
FEW_LINKS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _local_folder(spark: SparkSession) -> str:
    """A folder of this machine, for sessions in which all tasks run here and that name no other."""
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors share; the master is {master}")
    return tempfile.mkdtemp(prefix="strataloom-ckpt-")


def _checkpoints(spark: SparkSession) -> str:
    """The session's checkpoint folder, as it is or as spark.checkpoint.dir names it."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or _local_folder(spark))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that spark.checkpoint.dir names.

    A folder of this machine is set only where the session names none and runs on this machine alone.
    """
    _checkpoints(df.sparkSession)
    return df.checkpoint()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as a URI or a path."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir") or _checkpoints(spark)).rstrip("/")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows, else unchanged.

    Beyond the bound the join is a sort-merge join whose skewed keys adaptive
    execution splits. `df` should be narrow and cheap to count, or cut before.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def crc_mod(id_column: str, modulus: int) -> Column:
    """crc32 of an id written as decimal text, modulo `modulus`; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def spread(spark: SparkSession, least: int = 1) -> int:
    """Partitions to ask for where an operator has to name a number."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stars(links: DataFrame) -> bool:
    """Whether each node is the upper end of one link at most, and then the lower end of none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def _with_least(rows: DataFrame, low: DataFrame, ends: int) -> DataFrame:
    """`rows` (u, v) with the m of their u in `low` (u, m, n); n are links, `ends` in all at most.

    A node with over a `HOT_NODES`th of them goes to every task, as there are fewer than `HOT_NODES` of these: a
    join dealt by u would put all its links in one task, which adaptive execution does not split beside an aggregate.
    """
    many = max(HOT_LINKS, ends // HOT_NODES)
    hot = low.where(F.col("n") > many)
    rest = rows.join(F.broadcast(hot.select("u")), "u", "left_anti").join(low.where(F.col("n") <= many), "u")
    return rows.join(F.broadcast(hot), "u").unionByName(rest).drop("n")


def least_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least of n places that each reaches by links between places a and b.

    Greater roots hook on to lesser ones, then paths are halved to their root; roots halve at least every second round.
    """
    least = np.arange(n)
    while True:
        x, y = least[a], least[b]
        if (x == y).all():
            return least
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least = least[least]


def _at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all links (u, v) of a task."""
    links = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if links:
        u, v = (np.concatenate(x) for x in zip(*links, strict=True))
        nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        component = nodes[least_reached(place[: len(u)], place[len(u) :], len(nodes))]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(component)], ["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (u, v longs): rows (node, component), the smallest node of each.

    Up to `FEW_LINKS` links meet in one task, whose work that bounds: rounds over them would be hundreds of
    tasks of a few rows, each with files of its own.
    Else alternating large-star and small-star contraction. Each half round is one
    aggregation and one join, so no neighbourhood is gathered in a task; rounds
    grow with the logarithm of the longest path. Nodes without an edge have no row.
    """
    links = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if links.count() <= FEW_LINKS:
        return cut(links.coalesce(1).mapInArrow(_at_once, "node long, component long"))
    while not _stars(links):
        ends = 2 * links.count()
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = cut(_with_least(both.where("v > u"), low, ends).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = (
            _with_least(large, low, ends)
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        links = cut(small)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
