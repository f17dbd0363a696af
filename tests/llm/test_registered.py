import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["op2_exact_topk", "op10_chat_format", "op13_warc"])
def test_against_sql(spark, name):
    from tests.oracle import duck, rows_of

    got = __spark_entry__.queries()[name](spark, SF)
    want = duck(SF).execute(__spark_entry__.oracle_sql()[name])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([c[0] for c in want.description], want.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline_by_stages(spark):
    """Each stage against what its operator says of its input."""
    from tidemark.llm import near_dedup

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, kept[-1], SF).collect()
        kept.append(spark.createDataFrame(rows, docs.schema) if rows else docs.limit(0))
        assert kept[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in kept]
    assert all(later <= earlier for earlier, later in zip(ids, ids[1:]))
    assert ids[3] == {r["class_id"] for r in near_dedup.classes(kept[2]).collect()} and ids[4] == ids[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids[4]
    lengths = packed.groupBy("doc_id").sum("length").join(packed.select("doc_id", "doc_tokens").distinct(), "doc_id")
    assert lengths.where("`sum(length)` <> doc_tokens").count() == 0
