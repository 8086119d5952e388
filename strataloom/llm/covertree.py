"""Embedding near-duplicates by dual traversal of cover trees: exact threshold pairs within a label.

Unit vectors with a cosine of c are sqrt(2 - 2c) apart. Equal vectors of a label collapse to
one with a weight. A cover tree's levels have centres that are nested and radii that halve;
each node also has the true radius of what it holds. Two nodes farther apart than both
radii and the threshold are left with all below them; two nodes that lie within the threshold
as wholes are linked without a look inside; what remains at the last level is compared.

On the cluster, the first levels come from a bounded sample and part the vectors into cells,
whose true radii are measured over all vectors. Cells are cut into blocks of about `BLOCK`
vectors by hash; pairs of cells that cannot hold a link are left, each other pair of blocks
is one task with its own trees. A task returns counts and a spanning forest, never all pairs.

Rows: a vector that is null, empty or zero, or that has null or non-finite components, and
any vector with a null label, links with nothing (component_id its own id). Vectors of
unlike lengths do not link. Repeated rows are vectors like any: they link with each other.
A null id has a null component_id where nothing with an id is reached, and kept is then true.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import bounded, components, cut, table
from strataloom.llm.minhash import forest

COSINE = 0.98
BLOCK, SAMPLE, CELLS = 2048, 4096, 2048
#: Pairs of two nodes below which they are compared one by one even if they lie within the threshold as wholes.
FEW = 64
FIRST_RADIUS, LAST_RADIUS = 2.0, 0.05


def units(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors of a list column in double precision; None where there is none."""
    out: list[np.ndarray | None] = []
    values, valid = column.values, column.is_valid().to_numpy(zero_copy_only=False)
    null = values.is_null().to_numpy(zero_copy_only=False)
    flat = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = column.offsets.to_numpy()
    for i in range(len(column)):
        a, b = offsets[i], offsets[i + 1]
        x = flat[a:b]
        if not valid[i] or a == b or null[a:b].any() or not np.isfinite(x).all() or not (top := np.abs(x).max()):
            out.append(None)
            continue
        x = x / top
        out.append(x / np.sqrt(x @ x))
    return out


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = units(batch.column(2))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() if x is not None else None for x in found], pa.binary())], ["vec_id", "label", "unit"])


def apart(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def slack(size: int) -> float:
    """What three distances taken from single-precision cosines of `size` components may be wrong by together."""
    return 3 * float(np.sqrt(2 * (size + 4) * 2.0**-24))


class CoverTree:
    """Levels of a cover tree: centres (places of vectors), for each vector its centre's number, true radii, parents.

    At each level a vector that is farther from its centre than the radius becomes a centre in its turn, in order of
    place; the vectors of a node stay below it. Levels that would part nothing are left out.
    """

    def __init__(self, x: np.ndarray, most: int | None = None):
        n = len(x)
        # Distances in single precision steer the tree; what that may miss is in slack(), and pairs are compared in double.
        d = apart(x.astype(np.float32) @ x.astype(np.float32).T) if n else np.zeros((0, 0), np.float32)
        np.fill_diagonal(d, 0)
        owner, centres, radius = np.zeros(n, np.int64), np.zeros(min(n, 1), np.int64), FIRST_RADIUS
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        away = d[0] if n else np.zeros(0, np.float32)
        self._add(centres, owner, away, np.zeros(len(centres), np.int64))
        while radius > LAST_RADIUS and (most is None or len(centres) < most):
            radius /= 2
            far = np.flatnonzero(away > radius)
            if not len(far):
                continue
            fresh = self._centres(d, owner, far, radius)
            if most is not None:
                fresh = fresh[: most - len(centres)]
            parents = np.concatenate([np.arange(len(centres)), owner[fresh]])
            above, centres = owner, np.concatenate([centres, fresh])
            # The nearest centre of those below the same node; a centre belongs to itself.
            for node in np.unique(owner[fresh]):
                mine, own = np.flatnonzero(above == node), np.flatnonzero(parents == node)
                near = d[np.ix_(mine, centres[own])]
                best = near.argmin(1)
                owner = owner if owner is not above else above.copy()
                away = away.copy()
                owner[mine], away[mine] = own[best], near[np.arange(len(mine)), best]
            owner[centres], away[centres] = np.arange(len(centres)), 0
            self._add(centres, owner, away, parents)

    @staticmethod
    def _centres(d: np.ndarray, owner: np.ndarray, far: np.ndarray, radius: float) -> np.ndarray:
        """Of the places `far`, in order, those that no earlier one of the same node is near to."""
        close = (d[np.ix_(far, far)] <= radius) & (owner[far][:, None] == owner[far][None, :])
        np.fill_diagonal(close, False)
        earlier = np.tril(close)
        taken = ~earlier.any(1)  # nothing before them is near: centres at once
        for i in np.flatnonzero(~taken).tolist():
            taken[i] = not taken[:i][earlier[i, :i]].any()
        return far[taken]

    def _add(self, centres: np.ndarray, owner: np.ndarray, away: np.ndarray, parents: np.ndarray) -> None:
        radii = np.zeros(len(centres))
        np.maximum.at(radii, owner, away)
        self.levels.append((centres.copy(), owner.copy(), radii, parents))


def dual(x: np.ndarray, y: np.ndarray | None, w: np.ndarray, v: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Link counts of all vectors of x then y (weighted by the other side), and links a - b as places that span them.

    Without y, links inside x are found.
    """
    same = y is None
    s = CoverTree(x)
    t = s if same else CoverTree(y)
    y, v = (x, w) if same else (y, v)
    shift = 0 if same else len(x)
    counts = np.zeros(len(x) + (0 if same else len(y)), np.int64)
    reach, wrong = float(apart(np.array(cosine))), slack(x.shape[1])
    rough_x, rough_y = x.astype(np.float32), y.astype(np.float32)
    alive = np.ones((1, 1), bool)
    a_links, b_links = [], []
    for k in range(max(len(s.levels), len(t.levels))):
        (ca, oa, ra, pa_), (cb, ob, rb, pb) = s.levels[min(k, len(s.levels) - 1)], t.levels[min(k, len(t.levels) - 1)]
        if k:
            alive = alive[np.ix_(pa_ if k < len(s.levels) else np.arange(len(ca)), pb if k < len(t.levels) else np.arange(len(cb)))]
        d = apart(rough_x[ca] @ rough_y[cb].T)
        alive = alive & (d <= ra[:, None] + rb[None, :] + reach + wrong)
        i, j = np.nonzero(alive)
        many = np.bincount(oa, minlength=len(ca))[i] * np.bincount(ob, minlength=len(cb))[j] > FEW
        whole = np.flatnonzero(many & (d[i, j] + ra[i] + rb[j] <= reach - wrong))
        alive[i[whole], j[whole]] = False
        for i, j in zip(i[whole], j[whole], strict=True):
            p, q = np.flatnonzero(oa == i), np.flatnonzero(ob == j)
            if same and i > j:
                continue
            if same and i == j:
                counts[p] += w[p].sum() - w[p]
            else:
                counts[p] += v[q].sum()
                counts[q + shift] += w[p].sum()
            both = np.concatenate([p, q + shift])
            a_links.append(np.full(len(both), both[0]))
            b_links.append(both)
    p_order, q_order = np.argsort(oa, kind="stable"), np.argsort(ob, kind="stable")
    p_at, q_at = np.searchsorted(oa[p_order], np.arange(len(ca) + 1)), np.searchsorted(ob[q_order], np.arange(len(cb) + 1))
    pairs = np.argwhere(np.triu(alive) if same else alive)
    size = (p_at[pairs[:, 0] + 1] - p_at[pairs[:, 0]]) * (q_at[pairs[:, 1] + 1] - q_at[pairs[:, 1]])
    done = 0
    total = np.cumsum(size)
    while done < len(pairs):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + 500_000, "right")))
        i, j, n = pairs[done:stop, 0], pairs[done:stop, 1], size[done:stop]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(q_at[j + 1] - q_at[j], n)
        p = p_order[np.repeat(p_at[i], n) + within // np.maximum(width, 1)]
        q = q_order[np.repeat(q_at[j], n) + within % np.maximum(width, 1)]
        if same:
            ordered = (p < q) | (np.repeat(i != j, n) & (p != q))
            p, q = p[ordered], q[ordered]
        for c in range(0, len(p), 100_000):
            pp, qq = p[c : c + 100_000], q[c : c + 100_000]
            hit = np.einsum("ij,ij->i", x[pp], y[qq]) >= cosine
            pp, qq = pp[hit], qq[hit]
            counts += np.bincount(pp, v[qq], len(counts)).astype(np.int64) + np.bincount(qq + shift, w[pp], len(counts)).astype(np.int64)
            a_links.append(pp)
            b_links.append(qq + shift)
        done = stop
    none = np.zeros(0, np.int64)
    return counts, np.concatenate([none, *a_links]), np.concatenate([none, *b_links])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept (see the module)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    label_kind = rows.schema["label"].dataType.simpleString()
    rows = rows.mapInArrow(_normalise, f"vec_id long, label {label_kind}, unit binary")
    rows = cut(rows.withColumn("node", F.when(F.col("label").isNotNull() & F.col("unit").isNotNull(), F.xxhash64("label", "unit"))))
    nodes = cut(rows.where("node is not null").groupBy("node", "label", "unit").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least")))
    nodes = nodes.withColumn("size", F.length("unit"))

    largest = nodes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    wanted = min(CELLS, -(-largest // BLOCK))
    # Cells of each vector length that the sample has; other lengths are one cell.
    drawn = nodes.orderBy(F.xxhash64("node"), "node").select("unit").limit(SAMPLE).collect() if wanted > 1 else []
    sample: dict[int, list[bytes]] = {}
    for r in drawn:
        sample.setdefault(len(r["unit"]), []).append(bytes(r["unit"]))
    pivots = {}
    for size, raw in sample.items():
        points = np.stack([np.frombuffer(u) for u in raw])
        pivots[size] = points[CoverTree(points, wanted).levels[-1][0]]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, aways = np.zeros(len(batch), np.int32), np.full(len(batch), 2.0)
            raw = [u.as_buffer() for u in batch.column("unit")]
            sizes = np.array([u.size for u in raw], np.int64)
            for size in np.unique(sizes).tolist():
                if size in pivots:
                    at = np.flatnonzero(sizes == size)
                    for part in np.array_split(at, -(-len(at) // 2048)):
                        c = np.stack([np.frombuffer(raw[i]) for i in part]) @ pivots[size].T
                        cells[part], aways[part] = c.argmax(1), apart(c.max(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(aways)], [*batch.schema.names, "cell", "away"])

    placed = nodes.select("node", "label", "size", "weight", "unit").mapInArrow(place, f"node long, label {label_kind}, size int, weight long, unit binary, cell int, away double")
    cells = placed.groupBy("label", "size", "cell").agg(F.max("away").alias("radius"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    cells = cut(cells)
    placed = placed.join(bounded(cells.select("label", "size", "cell", "parts")), ["label", "size", "cell"])
    placed = cut(placed.withColumn("part", F.pmod("node", F.col("parts")).cast("int")).drop("parts", "away"))

    reach = float(apart(np.array(cosine)))
    gaps = {size: apart(np.clip(p @ p.T, -1, 1)) for size, p in pivots.items()}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n).to_numpy() for n in ("size", "cell_a", "cell_b", "radius_a", "radius_b")}
            gap = np.array([gaps[s][a, b] if s in gaps and a != b else 0.0 for s, a, b in zip(c["size"], c["cell_a"], c["cell_b"], strict=True)])
            yield batch.filter(pa.array(gap <= c["radius_a"] + c["radius_b"] + reach + 1e-6))

    side = lambda s: cells.select("label", "size", *[F.col(n).alias(f"{n}_{s}") for n in ("cell", "radius", "parts")])
    both = side("a").join(side("b"), ["label", "size"]).where("cell_a <= cell_b")
    both = both.mapInArrow(near, both.schema)
    tasks = both.withColumn("part_a", F.explode(F.sequence(F.lit(0), F.col("parts_a") - 1))).withColumn("part_b", F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1)))
    key = ["label", "size", "cell_a", "part_a", "cell_b", "part_b"]
    tasks = cut(tasks.where("cell_a < cell_b or part_a <= part_b").select(*key))
    left = placed.withColumnsRenamed({"cell": "cell_a", "part": "part_a"}).join(tasks, ["label", "size", "cell_a", "part_a"]).withColumn("side", F.lit(0))
    right = placed.withColumnsRenamed({"cell": "cell_b", "part": "part_b"}).join(tasks.where("cell_a < cell_b or part_a < part_b"), ["label", "size", "cell_b", "part_b"]).withColumn("side", F.lit(1))

    def compare(group: pa.Table) -> pa.Table:
        ids, weight, on = (group.column(n).to_numpy() for n in ("node", "weight", "side"))
        x = np.stack([np.frombuffer(u.as_buffer()) for chunk in group.column("unit").chunks for u in chunk])
        order = np.lexsort((ids, on))
        ids, weight, x, on = ids[order], weight[order], x[order], on[order]
        k = int((on == 0).sum())
        # Where one of two blocks is empty, the other has come alone and has no partner here.
        alone = k in (0, len(ids)) and any(group.column(f"{n}_a")[0] != group.column(f"{n}_b")[0] for n in ("cell", "part"))
        if alone:
            none = pa.array([], pa.int64())
            return pa.table({"node": none, "links": none, "low": none})
        sides = (x, None, weight, None) if k == len(ids) else (x[:k], x[k:], weight[:k], weight[k:])
        counts, a, b = dual(*sides, cosine)
        low = ids.copy()
        there, least = forest(ids, a, b)
        by_id = np.argsort(ids)
        low[by_id[np.searchsorted(ids[by_id], there)]] = least
        some = counts > 0
        return pa.table({"node": ids[some], "links": counts[some], "low": low[some]})

    columns = [*key, "node", "weight", "unit", "side"]
    found = left.select(*columns).unionByName(right.select(*columns)).groupBy(*key).applyInArrow(compare, "node long, links long, low long")
    found = cut(found)
    joined = components(found.select(F.col("node").alias("u"), F.col("low").alias("v")))
    joined = cut(joined.join(nodes.select("node", "least"), "node").select("node", "component", "least"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "weight", "least").join(counts, "node", "left").join(joined.join(least, "component").select("node", "component_id"), "node", "left")
    known = known.select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    out = rows.select("vec_id", "node").join(known, "node", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def op2_cover_tree_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings of equal labels at a cosine of 0.98."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
