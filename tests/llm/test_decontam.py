from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ebbline.llm import decontam

BENCH = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away"), (2, "Two words"), (3, ""), (4, None), (5, "one two THREE four"),
    (6, "quick brown fox jumps over the lazy dog and runs"), (7, "Two words"), (None, "lorem ipsum"), (12, "a a a a a a a a a a a a"),
]
MORE = [
    (30, "see: the quick brown fox jumps over the lazy dog and nothing, one two three four five! two-words"),
    (31, "a a a a a a a a a b a a a a a a a a a a a c"), (32, "one two three"), (33, "quick brown fox jumps over the lazy dog and walks"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def slow(text, bench):
    own, hit, items = words(text), set(), set()
    for item, t in bench:
        run = words(t)
        k = min(10, len(run))
        if item is None or not k:
            continue
        for i in range(len(run) - k + 1):
            for j in range(len(own) - k + 1):
                if own[j : j + k] == run[i : i + k]:
                    hit.update(range(j, j + k))
                    items.add(item)
    return len(own), hit, sorted(items)


@pytest.fixture
def cases(spark, docs):
    extra = spark.createDataFrame(MORE, "doc_id long, text string")
    return docs.select("doc_id", "text", "score").union(extra.withColumn("score", F.lit("x")))


@pytest.mark.parametrize("shard_words", [decontam.SHARD_WORDS, 1, 20])
def test_spans_and_items_match_brute_force(spark, cases, shard_words):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    for r in decontam.find_leaks(cases, bench, shard_words=shard_words).collect():
        n, hit, items = slow(r.doc.text, BENCH)
        spans = [(s.start, s.stop) for s in r.found.spans]
        assert r.found.n_words == n and list(r.found["items"]) == items
        assert sorted(hit) == [i for a, b in spans for i in range(a, b)]


def test_without_benchmark_or_documents(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.found.spans for r in decontam.find_leaks(docs, none).collect())
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert decontam.find_leaks(no_docs, bench).collect() == []
    assert decontam.decontaminate(no_docs, bench).columns == no_docs.columns


def test_leaks_go_and_clean_documents_stay(spark):
    passage = "The quick, brown fox jumps over the lazy dog AND runs far away"
    around = "some clean words stand before it and after it so that most of this text is clean and can stay as it was"
    rows = [(1, f"{around}. {passage}! {around}", 9), (2, passage, 9), (3, around, 9), (4, None, None), (5, "", 0)]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in decontam.decontaminate(docs, bench).collect()}
    assert sorted(got) == [1, 3, 4, 5]
    assert got[1].text == f"{around}. ! {around}" and got[1].n_chars == len(got[1].text)
    assert got[3].text == around and got[3].n_chars == 9 and got[4].text is None and got[5].text == ""


@pytest.mark.parametrize("name", ["op3_decontamination"])
def test_items_without_id_count_as_in_the_sql(spark, docs, tmp_path, name):
    import duckdb

    from ebbline.llm import queries

    cases = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in (None, 2)] + MORE
    spark.createDataFrame(cases, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [*BENCH, (None, "jumps over the lazy"), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
    kept = decontam.decontaminate(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.createDataFrame(items, "item_id long, text string"))
    assert not kept.where("text like '%lorem ipsum%'").count()
