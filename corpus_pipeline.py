"""Documents to token digests: reject poor texts, drop near copies, mix sources, encode and decode.

Each stage takes (spark, docs, sf_dir) and works on every row that the one before kept.
All but the last return the columns of `docs`.

Rows: a null or empty text is scored like any, is no copy of anything, takes part in the
mix with no words, and gives no ids. Rows without an id are kept by the second stage; of rows
alike in id and text one is kept, and rows that repeat an id with another text are judged by
their own text. Columns may have any names. An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import bpe, minhash, mixing, quality
from strataloom.llm.common import bounded, cut, remove, shared_dir, table

#: No SQL gives these rows: the first stage is a trained model. tests/llm has a brute-force version.
ORACLE_SQL = None


#: Folders that a stage's result is read from, until it is written; run() removes them.
_scratch: list[str] = []


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of this input, does not reject.

    Statistics are computed once and lie beside the rows in the shared folder, from which training reads them alone.
    """
    folder = f"{shared_dir(spark)}/statistics-{uuid.uuid4().hex}"
    _scratch.append(folder)
    quality.beside(docs).write.parquet(folder)
    rows = spark.read.parquet(folder)
    model = quality.train_on(rows.select(F.col("row.doc_id").alias("doc_id"), "x"), table(spark, sf_dir, "labels"))
    return quality.scored(rows, model).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the least id.

    Linked are texts at a similarity of 0.85 or more over 5-word shingles, as in op3: within "0.8 or more", and a
    pair from 0.80 to 0.85 is kept.
    """
    mark = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    found = cut(minhash.near_duplicates(docs.select("doc_id", "text", mark.alias("mark")), keep=("mark",)))
    dropped = found.where("not kept").select("doc_id", "mark").distinct()
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id", "mark").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id", "mark")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", mark.alias("mark"))
    alone = rows.join(bounded(cut(dropped.unionByName(repeated))), ["doc_id", "mark"], "left_anti")
    first = rows.join(bounded(cut(repeated)), ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    return alone.select("row.*").unionByName(first.select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mixed = mixing.mix(docs).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the text decoded from them."""
    return bpe.digests(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("bpe encoding and decoding", encode_decode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one returns is written to the shared folder and read by the next.

    Once a stage is written, what the one before it wrote is removed.
    """
    folder = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        for old in [*([f"{folder}/{i - 1}"] if i else []), *_scratch]:
            remove(spark, old)
        _scratch.clear()
    return docs
