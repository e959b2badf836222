"""Registered queries against their SQL, and the pipeline stage by stage."""

import pyarrow as pa
import pytest
from check_oracles import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from tabfold.llm.common import BATCH_SETTING
from tabfold.llm.queries import ORACLES, QUERIES

NO_ORACLE = {"op2_embedding_dedup", "op4_simhash", "op5_toxicity", "op6_language", "op7_licences", "op8_packing", "op9_repeats"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, folder, name):
    problem, n_rows = compare(spark, connect(folder), folder, name)
    assert problem is None and n_rows > 0


def test_all_operators_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE
    assert set(queries()) >= {*QUERIES, "pipeline"}


def test_pipeline_is_its_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        found = docs.collect()
        assert {r.doc_id for r in found} <= set(before)
        if name in ("toxicity", "simhash_near_dedup"):
            assert docs.columns == names and 0 < len(found) == len({r.doc_id for r in found})
            assert all(r.text == before[r.doc_id] for r in found)
        if name == "suffix_array_dedup":
            assert all(r.n_chars == len(r.text) <= len(before[r.doc_id]) for r in found)
        if name == "mixing":
            assert docs.columns == names and all(r.text == before[r.doc_id] for r in found)
    # Packing places every document as often as the mix has it.
    last = corpus_pipeline.STAGES[-1][0]
    assert last == "packing"
    kept = spark.read.parquet(f"{tmp_path}/3")
    times = {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    placed = {}
    for r in found:
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.length / r.doc_tokens
    assert placed.keys() == times.keys() and all(abs(placed[d] - times[d]) < 1e-9 for d in times)


def test_pipeline_runs_whole(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


@pytest.mark.parametrize("name", ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "packing", "op8_packing", "op9_repeats"])
def test_rows_go_to_python_by_the_megabyte(spark, folder, name, monkeypatch):
    """An executor's memory is bounded: batches of 10,000 texts take tens of megabytes in its JVM and in each worker."""
    # Only the setting is looked at, so the steps that run at once are left out.
    monkeypatch.setattr(corpus_pipeline, "toxicity_lexicon", lambda *_: None)
    monkeypatch.setattr(corpus_pipeline.toxicity, "without_toxic", lambda docs, _: docs)
    for module, step in ((corpus_pipeline.simhash, "one_per_group"), (corpus_pipeline.repeats, "without_repeats"), (corpus_pipeline.repeats, "repeats")):
        monkeypatch.setattr(module, step, lambda docs: docs)

    def batch_sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    try:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        stages = dict(corpus_pipeline.STAGES)
        stages[name](spark, docs, folder) if name in stages else QUERIES[name](spark, folder)
        long = spark.range(2000, numPartitions=1).select(F.repeat(F.lit("x"), 5000).alias("text"))
        sizes = [r.n for r in long.mapInArrow(batch_sizes, "n long").collect()]
        assert sum(sizes) >= 10**7 and max(sizes) < 2 << 20
        spark.conf.set(BATCH_SETTING, "3m")
        stages[name](spark, docs, folder) if name in stages else QUERIES[name](spark, folder)
        assert spark.conf.get(BATCH_SETTING) == "3m"
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)
