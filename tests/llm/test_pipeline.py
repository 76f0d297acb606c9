"""The pipeline's stages on a small corpus, each on its predecessor's documents."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from skyframe.llm import mixing


@pytest.fixture
def folder(spark, docs, tmp_path):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{tmp_path}/documents.parquet")
    bad = [(500 + i, f"vilewordone stuff{i} more{i * 7} vilewordtwo item{i * 3}", "en", "a", 1) for i in range(12)]
    spark.createDataFrame(bad, plain.schema).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    ids = [(r.doc_id, 1, 0) for r in plain.filter("doc_id is not null").distinct().collect()] + [(b[0], 1, 1) for b in bad[:10]]
    spark.createDataFrame(ids, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        ids = {r.doc_id for r in after.collect()}
        if name == "toxicity":
            assert not ids & set(range(500, 512)) and after.count() == before.count() - 12
        elif name == "line dedup":
            assert after.count() == before.count()
            assert after.agg(F.sum(F.length("text"))).first()[0] < before.agg(F.sum(F.length("text"))).first()[0]
        elif name == "near copies":
            assert ids < {r.doc_id for r in before.collect()}
        else:
            words = after.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
            assert words <= before.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, folder)
    assert Counter(r.doc_id for r in pieces.filter("piece = 0").collect()) == Counter(r.doc_id for r in before.collect())


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near copies", "mixing", "packing"]
