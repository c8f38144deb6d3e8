"""Registered queries against their SQL, native plans, and the pipeline against brute force."""

from __future__ import annotations

import contextlib
import io

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_words_and_passages import contaminated, groups, later_lines
from tests.oracle import connect, differences
from tidewright.llm import quality_classifier
from tidewright.llm.queries import QUERIES, SQL

NATIVE = ("op1_quality_rules", "op5_line_dedup", "op6_chat_formatting")


@pytest.mark.parametrize("name", list(SQL))
def test_query_and_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), SQL[name], connect(folder)) == []


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, folder, name):
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        QUERIES[name](spark, folder).explain()
    for shape in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert shape not in plan.getvalue()


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [f for _, f in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


def test_pipeline_and_brute_force(spark, folder):
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet")
    docs, labels, benchmark = read("documents"), read("labels"), read("benchmark")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in quality_classifier.resample(docs, labels).where("kept").collect()}
    model = quality_classifier.fit(docs, labels)
    weight = quality_classifier.log_weights([t.encode() for _, t in data], model.ratio)
    near = [i for (i, _), w in zip(data, weight, strict=True) if abs(w - model.cut) < 1.0]  # the noise may change these
    sure = {i for (i, _), w in zip(data, weight, strict=True) if w > model.cut and i not in near}
    assert sure <= kept <= sure | set(near)
    data = [d for d in data if d[0] in kept]
    data = [(i, left) for i, _, gone, left in later_lines(data, 1, keep_blank=True) if not gone or left.split()]
    data = [d for d, (i, n, group) in zip(data, groups(data, 5, 80), strict=True) if not n or i == group]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    data = [d for d, (_, _, hit, _) in zip(data, contaminated(data, items, 10), strict=True) if not hit]
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in data)
    assert all(r.lossless and r.n_tokens == len(np.frombuffer(r.token_ids, "<u4")) for r in found)
    stages = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stages = stage(spark, stages, folder)
        assert stages.columns == docs.columns
