"""The pipeline, stage by stage, against plain versions of each decision."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from strataloom.llm import bpe, mixing, quality
from tests.llm.test_ops import near_components

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input of each stage and the last result, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, out[-1], DATA).write.parquet(str(folder / str(i)))
        out.append(spark.read.parquet(str(folder / str(i))))
    return out


def test_columns(stages):
    assert [s.columns for s in stages[:-1]] == [COLUMNS] * len(pipeline.STAGES)


def test_quality_stage(stages):
    kept = {r[0] for r in stages[1].select("doc_id").collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM read_parquet('{DATA}/labels.parquet')").fetchall()
    good, bad = {i for i, q in labels if q}, {i for i, q in labels if not q}
    assert good <= kept and len(bad & kept) <= 0.2 * len(bad)
    model = quality.train_on(quality.features(stages[0]), stages[0].sparkSession.read.parquet(f"{DATA}/labels.parquet"))
    scored = quality.scored(quality.beside(stages[0]), model)
    assert {r[0] for r in scored.where(f"score >= {quality.THRESHOLD}").select("row.doc_id").collect()} == kept


def test_near_duplicate_stage(stages):
    rows = stages[1].select("doc_id", "text").collect()
    least = near_components([r["doc_id"] for r in rows], [r["text"] for r in rows])
    assert sorted(r[0] for r in stages[2].select("doc_id").collect()) == sorted(i for i, c in least.items() if i == c)


def test_mixing_stage(stages):
    """Copies of every document as the operator's SQL says."""
    documents = stages[2].toPandas()
    db = duckdb.connect()
    db.register("documents", documents)
    want = {i: taken // size if size else None for i, size, taken in db.sql(f"SELECT doc_id, size, taken FROM ({mixing.OP1_SQL})").fetchall()}
    got = stages[3].groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got if want[r["doc_id"]] is not None} == {i: n for i, n in want.items() if n}


def test_last_stage(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.VOCABULARY)
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    rows = stages[4].collect()
    assert len(rows) == stages[3].count()
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())


def test_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is pipeline.run
    folder = pipeline.shared_dir(spark)
    got = pipeline.run(spark, DATA)
    (files,) = {f.split("/corpus-pipeline-")[1].split("/")[1] for f in got.inputFiles()}
    assert files == "3" and got.count() > 0 and folder


def test_an_id_with_two_texts(spark):
    """7 is a copy of 3 in one row and unlike any other in the next; that one stays."""
    rows = [(3, "a b c d e f"), (7, "A b c d\te f"), (7, "something else that nobody has"), (8, "x"), (8, "x"), (8, "y")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.drop_near_duplicates(spark, docs, DATA).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted([rows[0], rows[2], rows[3], rows[5]])


def test_hard_rows(spark):
    """Nulls in any column, empty texts, repeated rows, other columns, and nothing at all."""
    rows = [(None, "one two three", None, None, None, 1), (1, None, "en", "a", 0, 2), (2, "", "en", "a", 0, 3), (3, "x y z", "en", None, 5, 4), (3, "x y z", "en", None, 5, 4), (4, "x y z", "en", "b", 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0
    assert pipeline.keep_quality(spark, docs, DATA).columns == docs.columns
    unique = pipeline.drop_near_duplicates(spark, docs, DATA)
    assert unique.columns == docs.columns and sorted(map(str, (r["doc_id"] for r in unique.collect()))) == ["1", "2", "3", "None"]
    assert pipeline.mix_sources(spark, docs, DATA).columns == docs.columns
    assert pipeline.encode_decode(spark, docs, DATA).count() == len(rows)
    names = ["score", "row", "x", "mark", "kept", "component_id", "_quality_score", "n", "s", "draw"]
    clash = docs.drop("kept").select("*", *[F.lit(1).alias(n) for n in names])
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, clash, DATA)
        assert got.columns == clash.columns and got.count() > 0, name
