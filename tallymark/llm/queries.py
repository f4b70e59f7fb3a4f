"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import bpe, codec, copies, licenses, negatives, packing, quality, resampling, secrets, similarity, suffixes, topk, urls
from tallymark.llm.common import doc_bytes, slices, table, values
from tallymark.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(
    """
    WITH v AS (
      SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.row AS query, q.vec_id AS query_id, c.row, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.row <> q.row AND len(c.e) = len(q.e)
      WHERE q.vec_id % 50 = 0),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, row) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op1_exact_top_k(spark, sf_dir):
    """Five best vectors by integer inner product for every 50th vector."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter(F.col("id") % 50 == 0), 5)


@query()
def op9_quality_rules(spark, sf_dir):
    """Rule statistics and verdicts of all documents."""
    docs = table(spark, sf_dir, "documents")
    judge = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.statistics(docs, judge)


@query()
def op10_license_scan(spark, sf_dir):
    """Licence phrases and templates in all documents."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan_documents(docs, licenses.fit(docs))


@query()
def op4_secret_scan(spark, sf_dir):
    """Secrets by pattern and by character models in all documents."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.fit(docs))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, secrets.BASE_KINDS),
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"),
    )


WORD_BPE = "word_bpe_49k.json"
#: Ids decoded at a time.
DECODED_IDS = 4096


@query()
def op2_bpe_round_trip(spark, sf_dir):
    """Ids of all documents by the transducer, decoded again piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, names = bpe.encoder(WORD_BPE).encode, bpe.token_list(WORD_BPE)
        for batch in slices(batches, 500):
            rows = []
            for doc, text in zip(values(batch, "doc_id"), doc_bytes(batch, "text"), strict=True):
                ids = encode(text)
                decoder, digest = bpe.TokenDecoder(names), hashlib.sha256()
                listed = np.frombuffer(ids, dtype="<u4").tolist()
                for start in range(0, len(listed), DECODED_IDS):
                    digest.update(decoder.push(listed[start : start + DECODED_IDS]).encode())
                rows.append((doc, len(listed), hashlib.sha256(ids).hexdigest(), digest.hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query()
def op8_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 ids."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), digest=True))


# The rules of the URL query.
URL_RULES = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")]


@query()
def op3_url_filter(spark, sf_dir):
    """Verdicts on all pages by rule, else by host words and path tokens."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query()
def op7_suffix_array_dedup(spark, sf_dir):
    """All documents without the strings of 200 bytes that occur elsewhere."""
    return suffixes.report(table(spark, sf_dir, "documents"))


@query()
def op6_ngram_jaccard_join(spark, sf_dir):
    """Class and number of links of all documents at a similarity of 0.8 or more."""
    return similarity.classes_of(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query()
def op5_token_files(spark, sf_dir):
    """Ids of all documents, written in compressed segments and read back."""
    return codec.round_trip(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH crc AS (
      SELECT list(c ORDER BY i) AS t
      FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
    texts AS (
      SELECT 0 AS side, row_number() OVER () AS row, doc_id AS id, text FROM documents
      UNION ALL SELECT 1, row_number() OVER (), item_id, text FROM benchmark),
    words AS (
      SELECT side, row, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM texts),
    features AS (
      SELECT side, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
    counted AS (SELECT side, row, f, count(*) AS n FROM features GROUP BY ALL),
    hashed AS (
      SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
                            lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
      FROM (SELECT DISTINCT f FROM counted), crc),
    placed AS (SELECT side, row, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
    totals AS (
      SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM placed GROUP BY bucket),
    sums AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM totals),
    gains AS (
      SELECT bucket, floor(1000 * ln(CAST((t + 1) * (ss + 10000) AS DOUBLE) / CAST((s + 1) * (tt + 10000) AS DOUBLE))) AS gain FROM totals, sums),
    weights AS (SELECT row, sum(n) AS n_features, floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
    scored AS (
      SELECT id AS doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
      FROM words LEFT JOIN weights USING (row) WHERE side = 0),
    ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
    """
)
def op11_importance_resampling(spark, sf_dir):
    """A quarter of the documents, drawn by how much their words are like those of the benchmark."""
    return resampling.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    """
    WITH texts AS (
      SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
    SELECT doc_id, max(doc_id) OVER equal AS keep_id, count(*) OVER equal AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST, row DESC) = 1 AS kept, sha256(norm) AS text_sha256
    FROM texts WINDOW equal AS (PARTITION BY norm)
    """
)
def op12_exact_dedup(spark, sf_dir):
    """Copies among all documents, by a stream over an index of digests that is kept on disk."""
    index = copies.CopyIndex(spark, f"{sf_dir}/documents.parquet", work_path(spark, "copies"))
    index.advance()
    return index.rows().select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query(
    """
    WITH v AS (
      SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, c.row, c.vec_id, c.label, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON c.row <> a.row AND len(c.e) = len(a.e)
      WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT anchor, anchor_id, anchor_label, row AS positive, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) AS place
      FROM scored WHERE label = anchor_label),
    ranked AS (
      SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id, row) AS rank
      FROM positives p JOIN scored s ON s.anchor = p.anchor AND s.label <> p.anchor_label
       AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
      WHERE place <= 5)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """
)
def op13_hard_negatives(spark, sf_dir):
    """Vectors of other labels that score nearly as high as the best of the anchor's own."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = negatives.integer_rows(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding")
    return negatives.mine(vectors, F.col("id") % 100 == 0)
