from pyspark.sql import functions as F

from tallymark.llm import secret_models, secrets


def test_every_text_is_counted(spark):
    letters = "abcdefghijklmnopqrst"
    # Each rare pair of characters is in one word of one of 3,000 texts.
    rare = {150 * i: f"wordQ{c}ing" for i, c in enumerate(letters)}
    rows = [(i, f"the weather in harbour {i} remained moderate {rare.get(i, '')}") for i in range(3000)]
    model = secret_models.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    size, code = len(secrets.ALPHABET) + 1, lambda c: secrets.ALPHABET.index(c) + 1
    ratio = {c: model.ratios[code("Q") * size + code(c)] for c in letters + "wxyz"}
    assert max(ratio[c] for c in letters) < min(ratio[c] for c in "wxyz")


def test_secrets_are_found_and_identifiers_are_not(spark):
    rng = __import__("random").Random(3)
    words = "message error handler report total index table column builder factory manager service".split()
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    token = lambda: "".join(rng.choice(alphabet) for _ in range(24))
    rows = [(i, " ".join(rng.choices(words, k=80))) for i in range(60)] + [(100 + i, f"the token = {token()} was there") for i in range(30)]
    # Nulls, empty texts and rows that come twice take no part of their own.
    rows += [(200, None), (201, ""), rows[0], rows[0]]
    model = secret_models.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    hidden, named = [token() for _ in range(100)], ["MAX_COLUMN_COUNT", "indexTableBuilder", "/service/report/total", "error_handler_17"]
    df = spark.createDataFrame([(v,) for v in hidden + named], "value string")
    found = {r.value for r in df.filter(model.secret(F.col("value"))).collect()}
    assert len(found & set(hidden)) >= 95 and not found & set(named)
    assert secret_models.fit(spark.createDataFrame([], "doc_id long, text string")).limit == secrets.LEAST
