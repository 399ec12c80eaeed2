from pathlib import Path

import corpus_pipeline
from fiscalmill.sources import staging

import __spark_entry__ as entry


def test_stages_keep_the_columns(spark, edge_docs, folder, tmp_path):
    docs, counts = edge_docs, []
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == edge_docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(docs.count())
    assert counts[0] >= counts[1] == counts[2] > 0 and counts[4] >= counts[3] > 0
    assert docs.where("not exact").count() == 0


def test_stages_leave_no_intermediate_tables(spark, edge_docs, folder, tmp_path):
    docs = edge_docs
    for i, (_, function) in enumerate(corpus_pipeline.STAGES[:3]):
        function(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert len(corpus_pipeline._left) == 1
    (left,) = corpus_pipeline._left
    assert staging.exists(spark, left)
    names = {p.name.rsplit("-", 1)[0] for p in Path(left.removeprefix("file:")).iterdir()}
    assert "spans" in names and not names & {"contexts", "hot-contexts", "hot-parts", "groups"}
    corpus_pipeline.remove_left(spark, spark.read.parquet(*[f"{left}/{p.name}" for p in Path(left.removeprefix("file:")).glob("spans-*")]))
    assert corpus_pipeline._left == [left]  # still read
    corpus_pipeline.remove_left(spark, docs)
    assert not corpus_pipeline._left and not staging.exists(spark, left)


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
