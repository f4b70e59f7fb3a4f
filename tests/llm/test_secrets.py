import re

import pytest

from tallymark.llm import secrets

HEX = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"
TEXTS = [
    None, "", "plain words only here", f"token = \"{HEX}\" end", f"é🙂 password:'abcdefghijkl' and {HEX}", "secret: short and api_key=ABCDEFGHIJKLMNOP",
    "AKIAABCDEFGHIJKLMN x AKIAAB", "passwd==aaaa token:secret=abcdefghijklmnop", "x" * 30_000 + " key Zx9Qw8Er7Ty6Ui5Op4As3Df2Gh1Jk0",
    f"{HEX} {HEX}\n{HEX}", "token = token = abcdefghijkl12", "API-KEY=abcdefghijklmno ApiKey = abcdefghijklmno",
]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


@pytest.fixture
def docs(docs_of):
    rng = __import__("random").Random(1)
    words = [" ".join("".join(rng.choice(["th", "er", "in", "on", "ea"]) for _ in range(5)) for _ in range(200)) for _ in range(5)]
    return docs_of([*enumerate(TEXTS), (3, TEXTS[3]), *((100 + i, w) for i, w in enumerate(words))])


def test_base_spans_against_brute_force(docs):
    model = secrets.fit(docs)
    from pyspark.sql import functions as F

    got = secrets.scan(docs, model).select("doc_id", secrets.as_text(F.filter("spans", lambda s: s["kind"] != "random")).alias("base"), secrets.as_text(F.col("spans")).alias("all"))
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id < 100:
            assert r.base == base(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        else:
            assert r["all"] == ""
    # The model finds the token that no pattern knows.
    assert [r["all"] for r in rows if r.doc_id == 8] == ["random:30005:30035"]


def test_masking(docs):
    out = secrets.redact(docs, secrets.fit(docs))
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[0] is None and texts[1] == "" and texts[2] == TEXTS[2]
    assert texts[3] == "[SECRET]\" end" and texts[4] == "é🙂 [SECRET]' and [SECRET]"
    assert texts[9] == "[SECRET] [SECRET]\n[SECRET]" and not any(HEX in (t or "") for t in texts.values())


def test_held_out_strings(docs):
    import random

    model, rng = secrets.fit(docs), random.Random(9)
    from pyspark.sql import functions as F

    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = [("".join(rng.choice(alphabet) for _ in range(24)), True) for _ in range(200)]
    word = [("".join(rng.choice(["th", "er", "in", "on", "ea"]) for _ in range(12)), False) for _ in range(200)]
    df = docs.sparkSession.createDataFrame(secret + word, "value string, label boolean")
    right = df.filter((model.score(F.col("value")) > model.limit) == F.col("label")).count()
    assert right >= 390


def test_no_python_in_the_plan(docs):
    plan = secrets.scan(docs, secrets.Model([0.0] * 4761))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_empty_table(docs_of):
    empty = docs_of([])
    model = secrets.fit(empty)
    assert secrets.scan(empty, model).count() == 0 and secrets.redact(empty, model).count() == 0


def _tokens(seed, n, size):
    rng = __import__("random").Random(seed)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    return ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(n)]


def _recall(docs, model, tokens):
    from pyspark.sql import functions as F

    df = docs.sparkSession.createDataFrame([(t,) for t in tokens], "value string")
    return df.filter(model.score(F.col("value")) > model.limit).count() / len(tokens)


def test_secrets_in_the_sample_do_not_blind_the_scan(docs, docs_of):
    known = docs_of([(1000 + i, f"er in {t} th on") for i, t in enumerate(_tokens(4, 400, 32))])
    copies = docs_of([(5000 + i, f"on er {_tokens(6, 1, 32)[0]} in") for i in range(300)])
    model = secrets.fit(docs.unionByName(known).unionByName(copies))
    assert _recall(docs, model, _tokens(5, 300, 32)) >= 0.98


def test_fillers_are_no_secrets(docs_of):
    rules = docs_of([(i, f"above {c * 40} below") for i, c in enumerate("=-x_")])
    words = docs_of([(100 + i, "the weather in northern harbours remained moderate") for i in range(3)])
    both = rules.unionByName(words)
    assert all(not r.spans for r in secrets.scan(both, secrets.fit(both)).collect())


def test_short_tokens_are_found_and_words_of_their_length_are_not(docs, docs_of):
    known = docs_of([(1000 + i, f"er in token = {t} th on") for i, t in enumerate(_tokens(7, 40, 24))])
    model = secrets.fit(docs.unionByName(known))
    tokens = [t for n in (12, 15, 19) for t in _tokens(n, 40, n)]
    rows = [(i, f"pwd {t}, therinonther on") for i, t in enumerate(tokens)] + [(500 + i, "therinonther ineaoneaerthin") for i in range(9)]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secrets.scan(docs_of(rows), model).collect()}
    assert sum(got[i] == [(4, 4 + len(t))] for i, t in enumerate(tokens)) >= 0.95 * len(tokens)
    assert not any(got[500 + i] for i in range(9))
    assert secrets.redact(docs_of(rows[-1:]), model).first().text == "therinonther ineaoneaerthin"


ENGLISH = """connection status readme local library python array list request response window server value count max user name
    message error handler report total index table column builder factory manager service default session number""".split()


@pytest.fixture(scope="module")
def english(spark):
    """A model fitted on plain English prose with some labelled secrets."""
    rng = __import__("random").Random(11)
    common = "the and with from this that have were been they which their would there about".split()
    prose = [" ".join(rng.choice(ENGLISH if rng.random() < 0.5 else common) for _ in range(150)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(prose)] + [(1000 + i, f"the token = {t} was there") for i, t in enumerate(_tokens(21, 30, 24))]
    return secrets.fit(spark.createDataFrame(rows, "doc_id long, text string"))


def _secret(spark, model, values):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(v,) for v in values], "value string")
    return {r.value for r in df.filter(model.secret(F.col("value"))).collect()}


def test_ordinary_identifiers_are_no_secrets(spark, english):
    named = ["MAX_CONNECTION_COUNT", "HTTP_STATUS_OK_200", "README-v1-beta2", "/usr/local/lib/python3", "java/util/ArrayList", "XMLHttpRequest",
             "2024-01-15T10", "550e8400-e29b-41d4-a716-446655440000", "id=550E8400-E29B-41D4-A716-446655440000", "hunter2hunter2", "2024-01-15", "default_session_timeout"]
    assert _secret(spark, english, named) == set()
    rng = __import__("random").Random(12)
    # Held out: other joins of other words, some of them never seen.
    words = [*ENGLISH, "cluster", "payload", "widget", "gateway", "invoice", "matrix"]
    ways = [lambda a, b, c, n: f"{a}_{b}_{c}", lambda a, b, c, n: f"{a}.{b}".replace(".", "-") + f"-{n}", lambda a, b, c, n: a + b.title() + c.title(), lambda a, b, c, n: f"{a}_{b}{n}".upper(),
            lambda a, b, c, n: f"/{a}/{b}/{c}{n}", lambda a, b, c, n: a.title() + b.title() + "V" + str(n % 10), lambda a, b, c, n: f"{a}={b}_{n}", lambda a, b, c, n: f"20{n % 90 + 10}-0{n % 9 + 1}-1{n % 9}T1{n % 9}"]
    held = [w for w in (rng.choice(ways)(*rng.choices(words, k=3), rng.randrange(1000)) for _ in range(600)) if len(w) >= 12]
    assert len(_secret(spark, english, held)) <= 0.02 * len(held)


@pytest.mark.parametrize("size", [12, 16, 24, 40])
def test_random_tokens_are_secrets(spark, english, size):
    tokens = _tokens(100 + size, 300, size)
    assert len(_secret(spark, english, tokens)) >= 0.95 * len(tokens)


def test_a_token_of_many_texts_is_ordinary_and_one_of_copies_is_not(docs, docs_of):
    token, copied = _tokens(31, 2, 20)
    several = docs_of([(1000 + i, f"er in {token} th on {'on ' * i}") for i in range(40)])
    copies = docs_of([(2000 + i, f"on er {copied} in") for i in range(40)])
    model = secrets.fit(docs.unionByName(several).unionByName(copies))
    plain = secrets._ordinary(secrets._some_texts(several.unionByName(copies), "text", 2000)).collect()
    assert token in {r.value for r in plain} and copied not in {r.value for r in plain}
    assert _secret(docs.sparkSession, model, [copied]) == {copied}
