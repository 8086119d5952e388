"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions.

A source's target is its weight's share of all sizes, but at most `epochs` times its own
size; what is cut off goes to the others by weight until none is above. In order of
cap / weight the clamped sources are a prefix, so sums over the (few) sources give the
fixed point at once. Every document is taken floor(target / size) times; for the rest,
documents are drawn once more in the order of a seeded hash until the next would exceed the
source's words; `ROUNDS` rounds go on behind it with the documents that are no larger than
what is missing, the last to within half a document. The place where a round stops is found
by a histogram over 4,096 ranges of the hash and by ordering one such range, so no source is
ordered as a whole, and it is one row: taking part in the mix needs no join by document.

Rows: a null or empty text has size 0 and takes part with no words; a null source is a
source of its own, ordered last; a null id is hashed as the text ''. Rows alike in id and
size are drawn together. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.llm.common import bounded, cut, table

WEIGHTS, EPOCHS, SEED = (5, 2, 1), 3, 17
ROUNDS = 3
_BITS = 48  # of a 60-bit hash below one of 4,096 ranges


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_col: Column, seed: int) -> Column:
    """60 bits that a row is ordered by."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")


def with_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: float = EPOCHS) -> DataFrame:
    """Rows (source, source_size) with weight, target: weights go to sources by code point, null last, in turn."""
    every = Window.partitionBy(F.lit(0))
    n = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((n - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.lit(float(epochs)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = every.orderBy("ratio", F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    share = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / share).withColumn("place", F.row_number().over(order))
    level = F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.col("place"))).over(whole)
    rows = rows.withColumn("level", level)
    return rows.select("source", "source_size", "weight", F.least(F.col("weight") * F.col("level"), F.col("cap")).alias("target"))


def _key() -> Column:
    return F.struct("draw", "id", "size")


def _drawn(rounds: int) -> Column:
    """Whether a row is drawn in one of the first rounds, where last_i and most_i of its source stand beside it."""
    found = F.lit(False)
    for i in range(rounds):
        fits = F.lit(True) if i == 0 else F.col("size") <= F.col(f"most_{i}")
        found = found | F.coalesce(fits & (_key() <= F.col(f"last_{i}")), F.lit(False))
    return found


def _stop(rows: DataFrame, needs: DataFrame, part: float) -> DataFrame:
    """Rows (s, last): the last (draw, id, size) of each source whose words so far and `part` of its own fit the need."""
    bin_ = F.shiftright("draw", _BITS)
    bins = rows.groupBy("source", bin_.alias("bin")).agg(F.sum("size").alias("words"))
    bins = bins.withColumn("end", F.sum("words").over(Window.partitionBy("source").orderBy("bin")))
    stops = bins.join(needs, F.col("source").eqNullSafe(F.col("s"))).where(F.col("end") > F.col("need"))
    stops = stops.groupBy("s").agg(F.min("bin").alias("stop"), F.min_by(F.col("end") - F.col("words"), "bin").alias("start"), F.first("need").alias("need"))
    stops = bounded(cut(stops))
    inside = rows.join(stops, F.col("source").eqNullSafe(F.col("s"))).where(bin_ == F.col("stop"))
    before = Window.partitionBy("s").orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") * part
    last = inside.withColumn("reached", reached).where(F.col("reached") <= F.col("need")).groupBy("s").agg(F.max(_key()).alias("last"))
    # Where no row of the stopping range fits, the ranges before it are drawn; a source that never stops is drawn whole.
    high = F.lit(2**63 - 1)
    below = F.struct((F.shiftleft("stop", _BITS) - 1).alias("draw"), high.alias("id"), high.alias("size"))
    every = F.struct(high.alias("draw"), high.alias("id"), high.alias("size"))
    found = stops.join(last.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left").select(F.col("s").alias("s3"), F.coalesce("last", below).alias("last"))
    return needs.join(found, F.col("s").eqNullSafe(F.col("s3")), "left").select("s", F.coalesce("last", every).alias("last"))


def plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: float = EPOCHS) -> DataFrame:
    """One row a source: target, whole repetitions, and for each round the last row that it draws and the largest size.

    sized: rows (source, id, size, draw), id and draw not null.
    """
    goals = with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goals = goals.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    goals = cut(goals.withColumnRenamed("source", "s"))
    for i in range(ROUNDS):
        rows = sized
        if i:
            beside = sized.join(bounded(goals), F.col("source").eqNullSafe(F.col("s"))).withColumn("drawn", _drawn(i))
            got = beside.groupBy("s").agg(F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(F.lit(0))).alias("got"))
            got = cut(got.withColumnRenamed("s", "s4"))
            goals = cut(goals.join(bounded(got), F.col("s").eqNullSafe(F.col("s4")), "left").withColumn(f"most_{i}", F.col("need") - F.coalesce("got", F.lit(0))).drop("s4", "got"))
            beside = sized.join(bounded(goals), F.col("source").eqNullSafe(F.col("s")))
            rows = beside.where(~_drawn(i) & (F.col("size") <= F.col(f"most_{i}"))).select(*sized.columns)
        needs = goals.select("s", F.col(f"most_{i}" if i else "need").alias("need"))
        last = _stop(rows, bounded(needs), 0.5 if i == ROUNDS - 1 else 1.0).select(F.col("s").alias("s5"), F.col("last").alias(f"last_{i}"))
        goals = cut(goals.join(last, F.col("s").eqNullSafe(F.col("s5"))).drop("s5"))
    return goals


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[float, ...] = WEIGHTS, epochs: float = EPOCHS, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if None) of `docs` in one struct `row`, with source, size, source_size, target, copies, taken.

    The sizes are gone over once and kept narrow where only the id is kept.
    """
    keep = docs.columns if keep is None else keep
    least = F.lit(-(2**63))
    columns = [F.struct(*keep).alias("row"), F.col(source_col).alias("source"), F.coalesce(F.col(id_col).cast("long"), least).alias("id"), n_words(F.col(text_col)).alias("size"), draw(F.col(id_col), seed).alias("draw")]
    rows = docs.select(*columns)
    if text_col not in keep:
        rows = cut(rows)
        sized = rows
    else:
        sized = cut(rows.drop("row"))
    sources = plan(sized.select("source", "id", "size", "draw"), weights, epochs)
    out = rows.join(bounded(sources), F.col("source").eqNullSafe(F.col("s")))
    copies = F.col("whole") + _drawn(ROUNDS).cast("long")
    return out.select("row", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def op1_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    rows = mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select("row.doc_id", "size", "source_size", "target", "taken")


_ROUNDS_SQL = ",\n".join(
    f"""m{i} AS (SELECT *, need - coalesce(sum(CASE WHEN drawn THEN size ELSE 0 END) OVER (PARTITION BY source), 0) AS most FROM r{i}),
f{i} AS (SELECT *, NOT drawn AND ({i} = 0 OR size <= most) AS fit FROM m{i}),
r{i + 1} AS (
  SELECT doc_id, source, size, draw, id, source_size, target, whole, need,
         drawn OR (fit AND coalesce(sum(size) OVER (PARTITION BY source, fit ORDER BY draw, id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   + size * {0.5 if i == ROUNDS - 1 else 1.0}::DOUBLE <= most) AS drawn
  FROM f{i})"""
    for i in range(ROUNDS)
)

OP1_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
caps AS (SELECT *, 3.0::DOUBLE * source_size AS cap, (3.0::DOUBLE * source_size) / weight AS ratio FROM sums),
levels AS (
  SELECT *, row_number() OVER o AS place,
         ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) /
         (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS lv
  FROM caps WINDOW o AS (ORDER BY ratio, source ASC NULLS LAST)),
goals AS (
  SELECT source, source_size, least(weight * (SELECT min_by(lv, place) FROM levels WHERE lv <= ratio), cap) AS target FROM levels),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goals),
r0 AS (
  SELECT s.doc_id, s.source, s.size, s.draw, coalesce(s.doc_id, -9223372036854775808) AS id, g.source_size, g.target, g.whole,
         g.target - g.whole * g.source_size AS need, false AS drawn
  FROM sized s JOIN needs g ON s.source IS NOT DISTINCT FROM g.source),
{_ROUNDS_SQL}
SELECT doc_id, size, source_size, target, (size * (whole + drawn::BIGINT))::BIGINT AS taken FROM r{ROUNDS}
"""
