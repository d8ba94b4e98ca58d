"""The registered queries of the subpackage and the pipeline, on the smallest tables."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from firngrid.llm import pii, queries
from firngrid.sources.tables import read_table
from tests.llm.test_operators import _components, _contamination, _sets, _tiktoken
from tests.oracles import connection, of_duckdb, of_spark


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, data, name):
    assert of_spark(queries.QUERIES[name](spark, data)) == of_duckdb(connection(data), queries.ORACLE_SQL[name])


def test_language_is_right_on_held_out_rows(spark, data):
    truth = dict(read_table(spark, data, "documents").select("doc_id", "lang").collect())
    found = [r for r in queries.op1_language_id(spark, data).collect() if r.held_out]
    assert len(found) > 20 and sum(r.lang_pred == truth[r.doc_id] for r in found) >= 0.95 * len(found)


def test_quality_is_right_on_held_out_rows(spark, data):
    truth = dict(read_table(spark, data, "labels").select("doc_id", "quality").collect())
    found = [r for r in queries.op3_quality(spark, data).collect() if r.held_out and r.doc_id in truth]
    assert len(found) > 10 and sum(r.predicted == truth[r.doc_id] for r in found) >= 0.8 * len(found)


def test_bpe_query_equals_the_library(spark, data):
    _, own = _tiktoken()
    whole = dict(read_table(spark, data, "documents").select("doc_id", "text").collect())
    for r in queries.op9_byte_bpe(spark, data).collect():
        ids = own.encode_ordinary(whole[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_pipeline_stages_equal_brute_force(spark, data):
    docs = read_table(spark, data, "documents")
    columns, (_, quality_stage), *rest = docs.columns, *corpus_pipeline.STAGES
    kept = quality_stage(spark, docs, data)
    assert kept.columns == columns
    truth = dict(read_table(spark, data, "labels").select("doc_id", "quality").collect())
    left = dict(kept.select("doc_id", "text").collect())
    assert sum(truth[i] == 1 for i in truth if i in left) >= 0.95 * sum(v == 1 for v in truth.values())

    _, stage = rest[0]
    one = stage(spark, kept, data)
    groups = _components(_sets(left.items(), 5), 80)
    assert one.columns == columns
    assert {r.doc_id for r in one.select("doc_id").collect()} == {i for i in left if groups[i] == i}

    _, stage = rest[1]
    items = [(r.item_id, r.text) for r in read_table(spark, data, "benchmark").collect()]
    clean = stage(spark, one, data)
    texts = dict(one.select("doc_id", "text").collect())
    good = {i for i, t in texts.items() if not _contamination(t, items)[-1]}
    assert clean.columns == columns and {r.doc_id for r in clean.select("doc_id").collect()} == good

    _, stage = rest[2]
    hidden = stage(spark, clean, data)
    assert hidden.columns == columns
    for r in hidden.collect():
        assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)

    _, stage = rest[3]
    _, own = _tiktoken()
    texts = dict(hidden.select("doc_id", "text").collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in stage(spark, hidden, data).collect()) == Counter((i, tuple(own.encode_ordinary(t))) for i, t in texts.items())


def test_pipeline_decides_by_row(spark, data):
    docs = read_table(spark, data, "documents")
    (_, quality_stage), (_, one_stage), (_, clean_stage), *_ = corpus_pipeline.STAGES

    # a rejected text and a good one under one id, and a rejected one without an id
    kept = quality_stage(spark, docs, data)
    good = kept.orderBy("doc_id").first()
    bad = docs.join(kept.select("doc_id"), "doc_id", "left_anti").orderBy("doc_id").first()
    extra = [{**good.asDict(), "doc_id": bad.doc_id}, {**bad.asDict(), "doc_id": None}]
    more = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    left = Counter((r.doc_id, r.text) for r in quality_stage(spark, more, data).collect())
    assert left == Counter((r.doc_id, r.text) for r in kept.collect()) + Counter([(bad.doc_id, good.text)])

    words = lambda a: " ".join(f"w{a}x{k}" for k in range(60))
    rows = [(1, words(1)), (1, words(1)), (2, words(1) + " end"), (None, words(1) + " last"), (2, words(2)), (None, words(3)), (None, words(3)), (7, words(4)), (7, words(5)), (5, words(5) + " end"), (8, ""), (9, "")]
    make = lambda rows: spark.createDataFrame([{"doc_id": i, "text": t} for i, t in rows], docs.schema)
    left = [(r.doc_id, r.text) for r in one_stage(spark, make(rows), data).collect()]
    assert Counter(left) == Counter([(1, words(1)), (2, words(2)), (None, words(3)), (7, words(4)), (5, words(5) + " end"), (8, ""), (9, "")])

    item = read_table(spark, data, "benchmark").where("length(text) > 100").orderBy("item_id").first().text
    rows = [(1, words(1)), (1, item), (None, item), (None, words(2)), (3, None)]
    left = [(r.doc_id, r.text) for r in clean_stage(spark, make(rows), data).collect()]
    assert Counter(left) == Counter([(1, words(1)), (None, words(2)), (3, None)])


def test_pipeline_stages_on_nothing_long_texts_and_clashing_names(spark, data):
    docs = read_table(spark, data, "documents")
    clash = {c: F.lit(k) for k, c in enumerate(("text_key", "score", "n", "words", "component", "c1", "entry", "n_words", "ids", "spans", "rejected"))}
    odd = docs.limit(40).withColumns(clash)
    long = " ".join(f"w{k % 5000}q{k % 77}" for k in range(60_000))
    rows = [{**r.asDict(), "doc_id": i, "text": t} for r in odd.limit(1).collect() for i, t in ((10**9, long), (10**9 + 1, None), (None, ""))]
    wide = odd.unionByName(spark.createDataFrame(rows, odd.schema))
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), data)
        assert none.count() == 0, name
        out = stage(spark, wide, data)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == wide.columns and none.columns == docs.columns, name
            assert out.count() <= wide.count() and (out.where(f"doc_id = {10**9}").count() == 1 or name == "quality classifier"), name
        else:
            assert out.columns == ["doc_id", "ids"] and out.count() == wide.count()
            assert out.where(f"doc_id = {10**9}").first().ids
