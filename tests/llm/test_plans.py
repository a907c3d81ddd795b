"""The native operators run no Python; no query joins everything with everything."""

import re

import pytest
from pyspark.sql import functions as F

from clicksieve.llm import queries  # noqa: F401  registers the queries
from clicksieve.llm.common import documents
from clicksieve.llm.line_dedup import drop_recurring_lines
from clicksieve.llm.mixing import mix_sources
from clicksieve.llm.quality_rules import fit_ratio, judge, trusted_ids
from clicksieve.queries.base import QUERIES

from .conftest import FOLDER


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("name", ["op1_line_dedup", "op5_mixing", "op6_quality_rules"])
def test_native(spark, name):
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan(QUERIES[name](spark, FOLDER)))


def test_texts_move_once(spark):
    """Mixing sends keys around; the text is in one exchange only."""
    docs = documents(spark, FOLDER)
    wide = mix_sources(docs).select("doc_id", "text", "taken")
    assert len(re.findall(r"Exchange hashpartitioning\(__h1", plan(wide))) >= 1
    assert drop_recurring_lines(docs).columns == [*[c for c in docs.columns if c != "text"], "text", "n_lines", "n_dropped"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = judge(docs, fit_ratio(docs, trusted_ids(labels))).select("doc_id", "kept")
    assert "Exchange" not in plan(judged) and judged.filter(F.col("kept")).count() > 0


def test_line_keys_are_computed_once(spark, monkeypatch):
    from clicksieve.llm import line_dedup

    seen = []
    monkeypatch.setattr(line_dedup, "keep_table", lambda df, name: seen.append(df) or df)
    line_dedup.drop_recurring_lines(spark.createDataFrame([(1, "a 1 b\n\n \nc")], "doc_id long, text string"))
    text = spark._jvm.PythonSQLUtils.explainString(seen[0]._jdf.queryExecution(), "simple")
    assert text.count("regexp_replace") == 1 and seen[0].count() == 2
