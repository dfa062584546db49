"""The bindings against their SQL, and the pipeline's stages against the operators' reports."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from mise.llm import dart_minhash, decontaminate, quality, queries, secret_scan  # noqa: E402
from mise.llm.common import table  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    assert compare(spark, name, queries.QUERIES[name], queries.ORACLE[name], SF, duck(SF))[0]


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs, kept = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        kept.append((docs, docs := spark.read.parquet(f"{tmp_path}/{name}")))

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    (q0, q1), (n0, n1), (d0, d1), (s0, s1) = kept
    assert ids(q1) == ids(quality.quality_report(q0).where("kept"))
    assert ids(n1) == ids(dart_minhash.near_duplicates(n0).select("class_id").distinct().withColumnRenamed("class_id", "doc_id"))
    dirty = set(ids(decontaminate.find_passages(d0, table(spark, SF, "benchmark"))))
    assert ids(d1) == [d for d in ids(d0) if d not in dirty]
    assert ids(s1) == ids(s0) and secret_scan.secret_report(s1).where("spans != ''").count() == 0
    pieces = corpus_pipeline.run(spark, SF)
    assert sorted({r["doc_id"] for r in pieces.select("doc_id").collect()}) == ids(s1)
