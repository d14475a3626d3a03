import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as p  # noqa: E402

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    from pathlib import Path

    if not Path(DATA).exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in p.STAGES[:-1]:
        out = p.written(stage(spark, docs, DATA))
        assert out.columns == names, name
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left <= ids and len(left) > 0.5 * len(ids), name
        docs, ids = out, left
    from palimpsest.llm import decontaminate, near_dedup, secrets

    assert secrets.scan(docs).filter("size(spans) > 0").count() == 0
    assert near_dedup.near_duplicates(docs, percent=80).filter("not kept").count() == 0
    assert decontaminate.decontaminate(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).filter("contaminated").count() == 0
    assert docs.count() == len(ids)
    packed = p.STAGES[-1][1](spark, docs, DATA)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
    assert p.run(spark, DATA).count() == packed.count()
