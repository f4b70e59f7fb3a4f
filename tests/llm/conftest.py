import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) rows, with columns whose names the operators use themselves."""

    def make(rows):
        ddl = "doc_id long, text string, lang string, n_chars long, `secret.key` string, suffix_spans int, near_key int, score double, pack_rank int"
        return spark.createDataFrame([(i, t, "en", None if t is None else len(t), "k", 1, 2, 0.5, 3) for i, t in rows], ddl)

    return make
