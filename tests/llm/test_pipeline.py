"""The registered queries, and each stage of the pipeline held against brute force on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from llm import test_decontam, test_near

from ebbline.llm import bpe, nbsvm, queries
from ebbline.llm.common import save, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(save(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def test_stages_keep_the_columns(results):
    columns = results[0].columns
    assert all(r.columns == columns for r in results[:-1]) and results[-1].columns[: len(columns)] == columns


def test_classifier_drops_what_it_rejects(spark, results):
    model = nbsvm.train(results[0], table(spark, SF, "labels"))
    want = {r.doc_id for r in results[0].collect() if model.score(nbsvm.features(r.text)) >= nbsvm.THRESHOLD}
    assert {r.doc_id for r in results[1].collect()} == want and 0 < len(want) < results[0].count()


def test_exact_dedup_keeps_the_longest_original(results):
    best = {}
    for r in results[1].collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = max(best.get(key, (-1, 0)), (len(r.text), -r.doc_id))
    assert {r.doc_id for r in results[2].collect()} == {-i for _, i in best.values()}


def test_near_dedup_keeps_the_least_of_each_group(results):
    rows = [(r.doc_id, r.text) for r in results[2].collect()]
    assert sorted(r.doc_id for r in results[3].collect()) == test_near.kept(rows)


def test_decontamination_cuts_every_window(spark, results):
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in results[3:5])
    for i, text in before.items():
        n, hit, _ = test_decontam.slow(text, bench)
        assert (i in after) == (len(hit) * 2 <= n)
        if i in after:
            own = test_decontam.words(text)
            assert test_decontam.words(after[i]) == [w for k, w in enumerate(own) if k not in hit]
            assert after[i] == text or hit


def test_encoding_is_that_of_the_library(results):
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.tokens, special_tokens={})
    rows = results[-1].collect()
    assert len(rows) == results[-2].count()
    assert all(r.ids == library.encode_ordinary(r.text) and r.n_tokens == len(r.ids) and r.round_trip for r in rows)


def test_run_gives_what_the_stages_give(spark, results):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, results[-1].collect()))


@pytest.mark.parametrize("index", range(len(corpus_pipeline.STAGES)))
def test_stages_take_awkward_and_empty_tables(spark, index, docs, no_docs):
    stage = corpus_pipeline.STAGES[index][1]
    got = stage(spark, docs, SF)
    assert got.columns[: len(docs.columns)] == docs.columns or index == 4
    assert 0 < got.count() <= docs.count()
    assert stage(spark, no_docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted((tuple(r) for r in got.select(*want.columns).collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr) and rows


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_other_queries_give_a_row_per_document(spark, name):
    got = queries.QUERIES[name](spark, SF)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in table(spark, SF, "documents").collect())
    assert got.where(" or ".join(f"`{c}` is null" for c in got.columns if c != "grown_shard")).count() == 0
