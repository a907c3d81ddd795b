import pytest

import corpus_pipeline
from tests.llm.conftest import AWKWARD, FOLDER


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:4]], ids=lambda f: f.__name__)
def test_stage_on_awkward_and_empty_tables(spark, awkward, nothing, stage):
    got = stage(spark, awkward, FOLDER)
    assert got.columns == awkward.columns
    known = {(r[0], r[1]) for r in AWKWARD}
    assert {(r.doc_id, r.text) for r in got.select("doc_id", "text").collect()} <= known
    left = stage(spark, nothing, FOLDER)
    assert left.columns == nothing.columns and left.count() == 0
