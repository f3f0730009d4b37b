"""The pipeline's stages: columns, effects and the whole run."""

import corpus_pipeline
import pytest

from tests.conftest import SF_SMALL
from tests.llm.helpers import corpus, frame
from tidewell.llm import decontaminate, packing, quality, simhash
from tidewell.llm.common import written
from tidewell.session import read_table


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, in order, the documents first."""
    out = [read_table(spark, SF_SMALL, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_SMALL), "test"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    assert all(s.schema.names == stages[0].schema.names for s in stages[:-1])
    assert [s.count() for s in stages[:-1]] == sorted((s.count() for s in stages[:-1]), reverse=True)


def test_stage_decisions(spark, stages):
    kept = {r.doc_id for r in quality.judge(stages[0]).filter("kept").collect()}
    assert ids(stages[1]) == kept
    assert 0 < stages[0].join(stages[2].withColumnRenamed("text", "t"), "doc_id").filter("text <> t").count()
    assert ids(stages[3]) == {r.component_id for r in simhash.classes(stages[2].select("doc_id", "text")).collect()}
    bench = read_table(spark, SF_SMALL, "benchmark")
    clean = {r.doc_id for r in decontaminate.report(stages[3], bench).filter("NOT contaminated").collect()}
    assert ids(stages[4]) == clean and len(clean) < stages[3].count()


def test_run_packs_every_kept_document(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    want = packing.pieces(stages[4]).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(map(tuple, want))
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= -(-total // packing.TOKENS) + 1


def test_stages_take_odd_documents(spark):
    docs = frame(spark, corpus(), clashes=True).selectExpr("*", "'en' AS lang")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF_SMALL), "odd")
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        docs = out
    assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()


def test_every_operator_has_a_registered_query():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 11))
