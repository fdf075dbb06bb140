import re

import pytest
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from lakepipe.llm import decision_list, line_templates, quality_model
from lakepipe.session import importable_by_workers
from test_bpe_and_packing import holds_all, library
from test_decision_list import facts
from test_lines_and_licences import brute as brute_lines
from test_ngram_join import brute as brute_components

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and the output of every stage, written and read again."""
    importable_by_workers(spark)
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tables = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, tables[-1], SMALL).write.parquet(str(root / str(k)))
        tables.append(spark.read.parquet(str(root / str(k))))
    return tables


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_five_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == [
        "quality classifier", "quality rules", "line dedup", "n-gram Jaccard join", "packing",
    ]
    assert "pipeline" in entry.queries()


def test_columns_of_documents_but_for_the_last(stages):
    for table in stages[1:-1]:
        assert table.dtypes == stages[0].dtypes
    assert "sequence_id" in stages[-1].columns


def test_classifier_keeps_what_scores_high(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality_model.train(stages[0], labels, F.lit(True))
    given, kept = texts(stages[0]), texts(stages[1])
    scores = dict(zip(given, model.scores([t.encode() for t in given.values()])))
    assert kept == {i: t for i, t in given.items() if scores[i] >= 0.3}
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(i in kept for i in given if quality.get(i) == 1)
    assert sum(i in kept for i in given if quality.get(i) == 0) <= 0.05 * sum(q == 0 for q in quality.values())


def test_rules_reject_what_fails_the_base(stages):
    given, kept = texts(stages[1]), texts(stages[2])
    passing = {i: t for i, t in given.items() if not facts(t)[-1]}
    assert set(kept) <= set(passing) and len(kept) >= 0.98 * len(passing)
    assert all(kept[i] == given[i] for i in kept)


def test_lines_as_by_brute_force(stages):
    given, kept = texts(stages[2]), texts(stages[3])
    want = {}
    for i, _, gone, left in brute_lines(list(given.items()), line_templates.MIN_DOCS):
        if not gone or re.search(r"[^\x20\x09-\x0D]", left):
            want[int(i)] = left
    assert kept == want
    assert stages[3].where("n_chars <> length(text)").isEmpty()


def test_one_document_of_each_group_stays(stages):
    given, kept = texts(stages[3]), texts(stages[4])
    groups = brute_components(list(given.items()), pipeline.SHINGLE_WORDS, pipeline.SIMILAR_PERCENT)
    assert kept == {i: t for i, t in given.items() if groups[i][1] == i}


def test_everything_left_is_packed(stages):
    lib = library(public_tokenizers.path(pipeline.TOKENIZER))
    holds_all(stages[5].collect(), texts(stages[4]), lib, pipeline.SEQUENCE_LENGTH)


def test_run_gives_the_rows_of_the_stages(spark, stages):
    columns = sorted(stages[-1].columns)
    ran = pipeline.run(spark, SMALL)
    pieces = lambda f: sorted(map(tuple, f.select("doc_id", "start", "length", "ids_crc32").collect()))
    assert sorted(ran.columns) == columns and pieces(ran) == pieces(stages[-1])


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs, odd_labels, tmp_path):
    importable_by_workers(spark)
    odd_labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs, no_docs):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes and out.count() <= docs.count()
        assert pipeline.pack(spark, docs, str(tmp_path)).where("start = 0").count() == docs.count()


def test_learned_rules_are_plain_expressions(spark, stages):
    kept = pipeline.quality_rules(spark, stages[1], SMALL)
    assert not re.search("Python|Pandas|Arrow", kept._jdf.queryExecution().toString())
    assert decision_list.DecisionList().keeps() is not None
