"""The registered queries against their SQL, and the pipeline's stages."""

import corpus_pipeline
import pytest
from oracle import compare, connect

from panelweave.llm.common import written
from panelweave.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], SQL[name]) is None


def test_stages_take_effect_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, SF), name)
        assert docs.columns == columns and dict(docs.dtypes) == dict(before.dtypes)
        seen[name] = (before.count(), docs.count())
        if name == "quality_classifier":
            lost = before.join(docs, "doc_id", "left_anti").join(labels, "doc_id")
            assert lost.where("quality = 1").count() == 0 and lost.where("quality = 0").count() > 0
    assert seen["quality_classifier"][1] < seen["quality_classifier"][0]
    assert seen["secret_scan"][0] == seen["secret_scan"][1]
    assert docs.where("n_chars <> char_length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_on_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "none")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
