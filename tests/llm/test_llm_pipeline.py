"""The stages one by one against plain versions, the run, and the registered queries against SQL."""

import os
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from oracle import compare, connect
from stockloom.llm import pii, queries
from test_llm_quality_rules import plainly
from test_llm_simhash import plain_survivors

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
stage = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_all_queries_are_registered():
    assert {*(f"op{n}" for n in range(1, 14)), "ledger"} == {q.split("_")[0] for q in queries.QUERIES}
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries())
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, queries.QUERIES[name], queries.SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL) - {"op13_spelling_variants"}))
def test_runs_over_all_rows(spark, docs, name):
    id, table = ("conv_id", "conversations") if name == "op12_conversation_repair" else ("doc_id", "documents")
    got = queries.QUERIES[name](spark, FOLDER)
    assert got.select(id).distinct().count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").select(id).distinct().count()


def test_spelling_runs_over_all_words(spark, docs):
    times = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", r["text"] or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            at = h % len(run)
            times[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    got = queries.QUERIES["op13_spelling_variants"](spark, FOLDER).collect()
    assert {r["word"]: r["n"] for r in got} == {w: n for w, n in times.items() if len(w) >= 5 and n >= 3}
    assert len(got) == len({r["word"] for r in got})


def test_quality_stage(spark, docs):
    kept = stage["quality_rules"](spark, docs, FOLDER)
    assert kept.columns == COLUMNS
    want = set()
    for r in docs.collect():
        n, chars, symbols, dup, lines, repeat = plainly(r["text"] or "")
        bad = n < 20 or 100 * repeat > 30 * n or symbols > 2 * n or (lines >= 10 and 100 * dup > 60 * lines) or chars < 2 * n or chars > 25 * n
        want |= set() if bad else {r["doc_id"]}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_near_duplicate_stage(spark, docs):
    kept = stage["near_duplicates"](spark, docs, FOLDER)
    assert kept.columns == COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == plain_survivors(rows)


def test_personal_data_stage(spark, docs):
    out = stage["pii_surrogates"](spark, docs, FOLDER)
    assert out.columns == COLUMNS and out.count() == docs.count()
    found = F.regexp_extract_all("d.text", F.lit(pii.ANY), F.lit(0))
    both = out.alias("o").join(docs.alias("d"), "doc_id")
    assert both.select(F.explode(found).alias("e"), "o.text").filter("contains(text, e)").count() == 0


def test_mixing_stage(spark, docs):
    out = stage["poisson_mix"](spark, docs, FOLDER)
    assert out.columns == COLUMNS
    copies = queries.QUERIES["op1_poisson_mix"](spark, FOLDER)
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in copies.select("doc_id").collect())


def test_encoding_stage(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    out = stage["encode"](spark, docs, FOLDER)
    ids = {r["doc_id"]: r["token_ids"] for r in out.collect()}
    for r in docs.collect():
        assert ids[r["doc_id"]] == library.encode(r["text"], add_special_tokens=False).ids


def test_run_applies_all_stages(spark, docs):
    out = corpus_pipeline.run(spark, FOLDER)
    step = docs
    for name, apply in corpus_pipeline.STAGES:
        step = apply(spark, step, FOLDER)
    key = ["doc_id", F.hash("token_ids").alias("ids")]
    assert sorted(map(tuple, out.select(*key).collect())) == sorted(map(tuple, step.select(*key).collect()))
    assert 0 < out.select("doc_id").distinct().count() < docs.count()


def test_stages_take_empty_tables_and_nulls(spark, docs):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, None, None)], docs.schema)
    for name, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs.limit(0), FOLDER).count() == 0
        assert apply(spark, odd, FOLDER).count() <= 8
