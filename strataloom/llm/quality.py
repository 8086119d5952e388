"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

Statistics are computed for whole texts as arrays over bytes, words and lines. They are
standardised, mapped to cosines that approximate a Gaussian kernel, and a ridge
regression is solved from normal equations that each partition sums by itself and that
are summed again by row of the matrix, so that only the matrix reaches the driver. The
raw scores of the training rows are counted in `BINS` bins, and pool-adjacent-violators
over the bins gives the probability. All labelled training rows take part.

Rows: a null text is empty; empty texts have statistics (zeros) and a score like any. Null
labels are left out, repeated ones count again. Without labels every score is 0.5.
Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.llm import bytewords as bw
from strataloom.llm.common import crc_mod, cut, table

COSINES, WIDTH, RIDGE, BINS, THRESHOLD = 384, 4.0, 1e-3, 2048, 0.3

_KIND = np.full(256, 6, np.uint8)  # byte kinds: 0 lower, 1 upper, 2 digit, 3 common marks, 4 other marks, 5 white space, 6 beyond ASCII or control
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[33:48], _KIND[58:65], _KIND[91:97], _KIND[123:127] = 4, 4, 4, 4
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = 3
_KIND[[32, *range(9, 14)]] = 5

STATISTICS = (
    "bytes", "words", "word_length", "word_length_spread", "lower", "upper", "digit", "common_marks", "other_marks", "white", "beyond",
    "distinct", "commonest", "same_again", "repeated_shingles", "short_words", "long_words", "capital_starts", "mark_ends", "sentence_ends",
    "marks_only", "lines", "repeated_lines", "capitals_only", "two_marks_end",
)


def _within(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values over each text's range."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def _repeats(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text: how many of its hashes are distinct, and how often the commonest comes."""
    n = len(at) - 1
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    owner = np.repeat(np.arange(n), np.diff(at))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    most = np.zeros(n)
    np.maximum.at(most, o[first], times)
    return np.bincount(o[first], minlength=n).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text of a chunk."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    some = np.maximum(size, 1)
    kinds = _KIND[data]
    share = {k: _within(kinds == k, offsets) / some for k in range(7)}
    starts, ends, at = bw.words(data, offsets)
    words = np.diff(at).astype(float)
    many = np.maximum(words, 1)
    length = (ends - starts).astype(float)
    mean = _within(length, at) / many
    spread = np.sqrt(np.maximum(_within(length**2, at) / many - mean**2, 0))
    hashes = bw.span_hash(bw.LOWER[data], starts, ends) if len(data) else np.zeros(0, np.uint64)
    distinct, commonest = _repeats(hashes, at)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[at[:-1][at[:-1] < len(hashes)]] = False
    sh, begin, _ = bw.shingles(hashes, at)
    n_sh = np.maximum(np.diff(begin), 1)
    first, last = (kinds[starts], kinds[ends - 1]) if len(starts) else (np.zeros(0, np.uint8), np.zeros(0, np.uint8))
    before_last = kinds[np.maximum(ends - 2, 0)] if len(starts) else last
    uppers = np.concatenate([[0], np.cumsum(kinds == 1)])
    lowers = np.concatenate([[0], np.cumsum(kinds == 0)])
    shout = (uppers[ends] - uppers[starts] >= 2) & (lowers[ends] == lowers[starts])
    marks = np.concatenate([[0], np.cumsum((kinds == 3) | (kinds == 4))])
    is_break = data == 10
    line_first = is_break.copy()
    line_first[1:] = is_break[:-1]
    line_first[:1] = False
    if len(data):
        line_first[offsets[:-1][size > 0]] = True
    line_start = np.flatnonzero(line_first)
    line_at = np.searchsorted(line_start, offsets)
    line_hash = bw.span_hash(data, line_start, np.append(line_start[1:], len(data))) if len(line_start) else np.zeros(0, np.uint64)
    lines = np.diff(line_at).astype(float)
    stop = data[ends - 1] if len(starts) else np.zeros(0, np.uint8)
    per_word = lambda x: _within(x, at) / many
    return np.column_stack([
        np.log1p(size), np.log1p(words), np.minimum(mean, 60), np.minimum(spread, 60), *(share[k] for k in range(7)),
        distinct / many, commonest / many, per_word(again), 1 - _repeats(sh, begin)[0] / n_sh * (np.diff(begin) > 0), per_word(length <= 3), per_word(length >= 12),
        per_word(first == 1), per_word((last == 3) | (last == 4)), per_word((stop == 46) | (stop == 63)), per_word(marks[ends] - marks[starts] == length),
        lines / many, 1 - _repeats(line_hash, line_at)[0] / np.maximum(lines, 1) * (lines > 0), per_word(shout), per_word((last == 4) & (before_last == 4)),
    ]).reshape(n, len(STATISTICS))


def of_column(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = bw.buffers(column)
    for a, b in bw.chunks(offsets):
        part = offsets[a : b + 1]
        yield a, b, statistics(data[part[0] : part[-1]], part - part[0])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, x in of_column(batch.column(1)):
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["doc_id", "x"])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, x array<double>)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_rows, f"doc_id {kind}, x array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


class Model:
    """Scores of statistics; small and picklable."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1)
        self.waves = rng.normal(size=(len(mean), COSINES)) / WIDTH
        self.phases = rng.uniform(0, 2 * np.pi, COSINES)
        self.weights = np.zeros(COSINES + 1)
        self.knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def map(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.column_stack([np.sqrt(2 / COSINES) * np.cos(z @ self.waves + self.phases), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.map(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.knots), 0, 1)


def isotonic(place: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ordered bins: places and non-decreasing shares."""
    blocks: list[list[float]] = []
    for p, o, c in zip(place.tolist(), ones.tolist(), count.tolist(), strict=True):
        blocks.append([p, p, o, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, end, o2, c2 = blocks.pop()
            blocks[-1][1:] = [end, blocks[-1][2] + o2, blocks[-1][3] + c2]
    xs, ys = [], []
    for start, end, o, c in blocks:
        xs += [start, end] if end > start else [start]
        ys += [o / c] * (2 if end > start else 1)
    return np.array(xs), np.array(ys)


def fit(train: DataFrame) -> Model:
    """A model from rows (x, quality)."""
    d = len(STATISTICS)
    sums = train.select(*[F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(d)], *[F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(d)], F.count("*").alias("n")).first()
    if not sums["n"]:
        return Model(np.zeros(d), np.ones(d))
    model = Model(np.array([sums[f"m{k}"] for k in range(d)]), np.array([sums[f"s{k}"] for k in range(d)]))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((COSINES + 1, COSINES + 2))
        for batch in batches:
            z = model.map(matrix(batch.column(0)))
            total += z.T @ np.column_stack([z, batch.column(1).to_numpy().astype(float)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(COSINES + 1, dtype=np.int32)), pa.array([r.tobytes() for r in total], pa.binary())], ["row", "cells"])

    def add(group: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(x.as_buffer()) for chunk in group.column("cells").chunks for x in chunk)
        return pa.table({"row": group.column("row")[:1], "cells": pa.array([cells.tobytes()], pa.binary())})

    parts = train.select("x", "quality").mapInArrow(equations, "row int, cells binary")
    rows = parts.groupBy("row").applyInArrow(add, "row int, cells binary").collect()
    whole = np.stack([np.frombuffer(r["cells"]) for r in sorted(rows, key=lambda r: r["row"])])
    left, right = whole[:, :-1], whole[:, -1]
    penalty = np.eye(len(left)) * RIDGE * float(sums["n"]) / COSINES
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(left + penalty, right)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.clip(np.floor((model.raw(matrix(batch.column(0))) + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], ["bin", "quality"])

    bins = train.select("x", F.col("quality").cast("double").alias("quality")).mapInArrow(raw, "bin int, quality double")
    counted = sorted(tuple(r) for r in bins.groupBy("bin").agg(F.sum("quality"), F.count("*").cast("double")).collect())
    place, ones, count = (np.array(x, float) for x in zip(*counted, strict=True))
    model.knots = isotonic((place + 0.5) / BINS * 2 - 0.5, ones, count)
    return model


def train_on(rows: DataFrame, labels: DataFrame) -> Model:
    """A model from features (doc_id, x) and labels (doc_id, quality) outside the held-out fifth."""
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").where(crc_mod("doc_id", 5) != 0)
    return fit(cut(rows.join(known, "doc_id").select("x", F.col("quality").cast("int").alias("quality"))))


def beside(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (row, x): each row of `docs` whole, and its statistics; whatever its columns are named. No shuffle."""
    at = docs.columns.index(text_col)
    # As positions: names of the input may repeat or be those used here.
    schema = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in of_column(batch.column(at)):
                part = batch.slice(a, b - a)
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], schema.names)

    flat = docs.toDF(*schema.names[:-1]).mapInArrow(run, schema)
    return flat.select(F.struct(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)]).alias("row"), "x")


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Rows (row, score) of rows (row, x)."""
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(matrix(batch.column(1))))], ["row", "score"])

    return rows.select("row", "x").mapInArrow(run, schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    rows = cut(features(table(spark, sf_dir, "documents")))
    model = train_on(rows, table(spark, sf_dir, "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(matrix(batch.column(1))))], ["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
