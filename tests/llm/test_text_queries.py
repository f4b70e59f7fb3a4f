"""The registered queries over the small tables, and the pipeline stage by stage."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tallymark.llm import suffixes, tokens
from tallymark.llm.queries import ORACLES, QUERIES
from tallymark.session import materialise


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_of_the_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    want = con.execute(ORACLES[name])
    assert [d[0] for d in want.description] == df.columns
    as_text = lambda rows: sorted(map(str, map(tuple, rows)))
    assert as_text(df.collect()) == as_text(want.fetchall())


def test_bpe_digests(spark, sf_dir, texts):
    library = tokens.load("word_bpe_49k.json")
    for r in QUERIES["op2_bpe_round_trip"](spark, sf_dir).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_files(spark, sf_dir, texts):
    library, start = tokens.load("word_bpe_49k.json"), 0
    got = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, sf_dir).collect()}
    for doc in sorted(texts):
        ids = np.array([*library.encode(texts[doc], add_special_tokens=False).ids, 2], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_suffixes(spark, sf_dir, texts):
    seen = {}
    raw = {doc: text.encode() for doc, text in texts.items()}
    for text in raw.values():
        for i in range(len(text) - 199):
            h = hash(text[i : i + 200])
            seen[h] = seen.get(h, 0) + 1
    for r in QUERIES["op7_suffix_array_dedup"](spark, sf_dir).collect():
        text = raw[r.doc_id]
        spans = [{"start": i, "end": i + 200} for i in range(len(text) - 199) if seen[hash(text[i : i + 200])] > 1]
        runs = suffixes.clean_spans(spans, len(text))
        kept = suffixes.without(text, runs)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("name", ["op3_url_filter", "op4_secret_scan", "op6_ngram_jaccard_join", "op8_best_fit_packing", "op9_quality_rules", "op10_license_scan"])
def test_whole_tables(spark, sf_dir, texts, name):
    got = QUERIES[name](spark, sf_dir).collect()
    table, key = ("pages", "page_id") if name == "op3_url_filter" else ("documents", "doc_id")
    assert {r[key] for r in got} == {r[key] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()}


def test_pipeline(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert not any(labels.get(d) == 0 for d in kept["quality"])
    assert set(kept["passages"]) == set(kept["near"]) == set(kept["secrets"]) < set(kept["quality"])
    assert len(set(kept["near"].values())) == len(kept["near"])
    assert {r.doc_id for r in docs.collect()} == set(kept["secrets"])


def test_pipeline_of_no_documents(spark, sf_dir, docs_of):
    docs = docs_of([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
