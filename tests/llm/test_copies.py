import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallymark.llm import copies

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows):
    """(id, keep_id, group_size) of every row."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(LOWER)].append(doc)
    out = []
    for doc, text in rows:
        group = groups[(text or "").translate(LOWER)]
        out.append((doc, max((d for d in group if d is not None), default=None), len(group), hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()))
    return out, len(groups)


def weak(text):
    """Six digests for all texts."""
    return F.pmod(F.crc32(text), F.lit(6)).cast("string")


def plain(row):
    return tuple((x is None, str(x)) for x in row)


def corpus(seed, first):
    rng = random.Random(seed)
    texts = [None, "", "Same Text", "same text", "SAME TEXT", "same text ", "ÄRGER", "ärger", "x" * 300_000, "X" * 300_000, "x" * 299_999]
    rows = [(first + i, rng.choice(texts)) for i in range(60)] + [(first + 100 + i, "hot copy") for i in range(40)]
    return rows + [(first, rows[0][1]), (first, "only here"), (None, "nobody"), (None, "nobody"), (None, "same text")]


@pytest.mark.parametrize("digest", [copies.sha256, weak])
def test_batches_add_up_to_the_whole(spark, tmp_path, docs_of, digest):
    source, folder = str(tmp_path / "docs"), str(tmp_path / "index")
    index = copies.CopyIndex(spark, source, folder, digest=digest, bytes_a_batch=12_000, rows_a_task=7)
    seen = []
    for part in range(2 if digest is copies.sha256 else 3):
        rows = corpus(part, part * 1000)
        docs_of(rows).repartition(3).write.mode("append").parquet(source)
        seen += rows
        # A new object each time: all that is known comes from the folder.
        index = copies.CopyIndex(spark, source, folder, digest=digest, bytes_a_batch=12_000, rows_a_task=7)
        index.advance()
        want, groups = brute(seen)
        got = index.rows().collect()
        assert sorted((plain((r.doc_id, r.keep_id, r.group_size)) for r in got)) == sorted(plain(w[:3]) for w in want)
        assert sum(r.kept for r in got) == groups and all(r.doc_id == r.keep_id for r in got if r.kept)
        if digest is copies.sha256:
            assert sorted(plain((r.doc_id, r.digest)) for r in got) == sorted(plain((w[0], w[3])) for w in want)
    mixed = spark.read.parquet(f"{folder}/mixed").distinct().count()
    assert mixed == 0 if digest is copies.sha256 else mixed > 1
    assert spark.read.parquet(f"{folder}/rows").select("batch").distinct().count() >= 2
    kept = index.kept()
    assert kept.columns == docs_of([]).columns
    assert sorted(plain((r.doc_id, (r.text or "").translate(LOWER))) for r in kept.collect()) == sorted(
        plain((w[1], t)) for t, w in {(t or "").translate(LOWER): w for (_, t), w in zip(seen, want, strict=True)}.items()
    )


def test_copy_of_an_earlier_batch_is_compared_with_its_bytes(spark, tmp_path, docs_of):
    """Texts that share a digest but come one batch apart are not taken for copies."""
    source, folder = str(tmp_path / "docs"), str(tmp_path / "index")
    for number, text in enumerate(["first", "second", "second", "first"]):
        docs_of([(number, text)]).coalesce(1).write.mode("append").parquet(source)
        index = copies.CopyIndex(spark, source, folder, digest=lambda text: F.lit("d"))
        index.advance()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in index.rows().collect()) == [(0, 3, 2), (1, 2, 2), (2, 2, 2), (3, 3, 2)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, docs_of):
    """A run that stopped after it wrote a batch, before that was noted, goes on without counting twice."""
    import shutil

    source, folder = str(tmp_path / "docs"), str(tmp_path / "index")
    rows = corpus(5, 0)
    docs_of(rows).repartition(2).write.parquet(source)
    copies.CopyIndex(spark, source, folder).advance()
    for name in ("intake_state", "index_state"):
        last = max((tmp_path / "index" / name / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        shutil.move(last, tmp_path / f"{name}-commit")
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    index = copies.CopyIndex(spark, source, folder)
    index.advance()
    got = sorted(plain((r.doc_id, r.keep_id, r.group_size)) for r in index.rows().collect())
    assert got == sorted(plain(w[:3]) for w in brute(rows)[0])


def test_empty_tables_and_settings(spark, tmp_path, docs_of):
    source = str(tmp_path / "docs")
    docs_of([]).write.parquet(source)
    index = copies.CopyIndex(spark, source, str(tmp_path / "index"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    index.advance()
    assert index.rows().count() == 0 and index.kept().count() == 0
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before

