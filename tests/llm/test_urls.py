import itertools
import math

from tallymark.llm import urls

RULES = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")]


def test_rules_hosts_and_paths(spark):
    rows = [
        (1, "http://a.Example.NET/en/1?x=1", "a.example.net", "/en/1", "example.net/en/", "allow"),
        (2, "https://example.net/de/", "example.net", "/de/", "net/", "block"),
        (3, "http://example.com/de/x#y", "example.com", "/de/x", "example.com/de/", "block"),
        (4, "http://notexample.com/de/", "notexample.com", "/de/", None, None),
        (5, "HTTP://x.org?fr/", "x.org", "", None, None),
        (6, "http://b.org/fr/é", "b.org", "/fr/é", "org/fr/", "allow"),
        (7, None, "", "", None, None),
        (8, "no scheme/en", "", "", None, None),
        (None, "ftp://h://x/y", "h:", "//x/y", None, None),
        (8, "no scheme/en", "", "", None, None),
    ]
    df = spark.createDataFrame([(r[0], r[1], "<p>some words</p>", "x") for r in rows], "page_id long, url string, html string, host string")
    got = urls.judge(df, RULES).collect()
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in got) == sorted((str(r[0]), r[2], r[3], str(r[4])) for r in rows)
    fixed = {r[0]: r[5] for r in rows if r[5]}
    assert all(r.verdict == fixed.get(r.page_id, r.verdict) and r.verdict in ("allow", "block") for r in got)


def test_hosts_with_seed_words_are_blocked_and_others_are_not(spark):
    html = "<a href='x'>the best house garden pills cheap the house</a>"
    bad = [f"http://cheappills.example.com/shop/{i}" for i in range(5)] + ["http://cheap.example.com/shop/9"]
    good = [f"http://housegarden{i}.example.com/en/{i}" for i in range(30)]
    df = spark.createDataFrame([(i, u, html) for i, u in enumerate(bad + good)], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judge(df, []).collect()}
    # The last bad host holds no seed word, only its company.
    assert [got[i] for i in range(len(bad + good))] == ["block"] * len(bad) + ["allow"] * len(good)


def test_best_split_against_all_splits():
    known_words = {"the": 50, "rap": 3, "therapist": 2, "ist": 1, "he": 30, "a": 40, "pist": 1}
    label, total = "therapist", 200
    known = {(s, n): known_words[label[s : s + n]] for s in range(9) for n in range(1, 10 - s) if label[s : s + n] in known_words}

    def cost(word):
        return math.log(known_words[word] / total) if word in known_words else math.log(10 / total) - len(word) * math.log(10)

    cuts = (c for k in range(9) for c in itertools.combinations(range(1, 9), k))
    splits = [[label[a:b] for a, b in itertools.pairwise([0, *c, 9])] for c in cuts]
    best = max(sum(map(cost, s)) for s in splits)
    assert math.isclose(sum(map(cost, urls.viterbi(label, known, total))), best)


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(df, RULES).count() == 0


def _site(spark, hosts, texts=""):
    html = f"<p>the best house garden win the house near the club and garden {texts}</p>"
    rows = [(i, f"http://{h}.example.com/x/{i}", html) for i, h in enumerate(hosts)]
    # Many more words than a seed's single count is worth.
    rows += [(1000 + i, "http://example.com/", html * 60) for i in range(40)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def _split(spark, df, hosts):
    labels = spark.createDataFrame([(h,) for h in {*hosts}], "label string")
    return {r.label: r.words for r in urls.segment(labels, urls.word_counts(df, "html")).collect()}


def test_concatenated_seeds_that_no_page_writes(spark):
    bad = [h for s in urls.SEEDS for h in (f"win{s}", f"{s}club", *([f"{s}qvk"] if len(s) > 5 else []))]
    good = ["housegarden", "bestclub", "winhouse", "nearclub"] * 20
    df = _site(spark, bad + good)
    got = _split(spark, df, bad + good)
    assert all(set(got[h]) & set(urls.SEEDS) for h in bad), got
    assert got["housegarden"] == ["house", "garden"] and not any(set(got[h]) & set(urls.SEEDS) for h in good)
    assert {r.page_id for r in urls.judge(df, []).collect() if r.verdict == "block"} == set(range(len(bad)))


def test_words_that_hold_a_seed_by_chance_stay_whole(spark):
    words = ["downloads", "threads", "roads", "alphabets", "adsorption", "leads", "nomads", "adsl", "adulthood", "xxxl", "spamalot"]
    df = _site(spark, [*words, "winporn", "wincasino"])
    got = _split(spark, df, [*words, "winporn"])
    assert {w: got[w] for w in words} == {w: [w] for w in words} and got["winporn"] == ["win", "porn"]
    verdicts = {r.page_id: r.verdict for r in urls.judge(df, []).collect()}
    assert [verdicts[i] for i in range(len(words) + 2)] == ["allow"] * len(words) + ["block"] * 2


def test_long_words_and_long_hosts(spark):
    long = "donaudampfschifffahrtsgesellschaftskapitaen"
    host = "house" * 800 + "q" * 300 + long
    df = _site(spark, [host], long)
    got = _split(spark, df, [host, f"the{long}"])
    assert got[f"the{long}"] == ["the", long]
    assert got[host] == ["house"] * 800 + ["q" * 300, long]


def test_labelled_hosts_go_before_seeds(spark):
    df = _site(spark, ["casino", "housegarden", "bestclub", "nearclub"])
    hosts = spark.createDataFrame([("casino.example.com", False), ("bestclub.example.com", True), ("bestclub.example.com2", True)], "host string, block boolean")
    got = {r.page_id: r for r in urls.judge(df, [], labelled=hosts).collect()}
    assert got[0].verdict == "allow" and got[2].score > got[1].score


def test_scores_against_brute_force(spark):
    from collections import Counter

    rng = __import__("random").Random(3)
    hosts = ["casino.win", "wincasino.example.com", "house.garden.org", "bestclub", "club-casino", "a1.b2", ""]
    paths = ["/x/12/win", "/en/7", "/X/y?q", "", "/win-win/004"]
    urls_of = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(60)] + [(100, None), (101, "nothing")]
    html = "<b>win casino house garden best club the</b>"
    df = spark.createDataFrame([(i, u, html) for i, u in urls_of], "page_id long, url string, html string")
    got = urls.judge(df, []).collect()
    split = {r.label: r.words for r in urls.segment(spark.createDataFrame([(t,) for h in hosts for t in h.replace("-", ".").split(".") if t], "label string").distinct(), urls.word_counts(df, "html")).collect()}
    host_words = lambda host: [w for t in host.replace("-", ".").split(".") if t for w in split[t]]
    path_words = lambda path: ["0" if t.isdigit() else t for t in __import__("re").split("[^a-z0-9]+", path.lower()) if t]
    block = lambda host: any(w in urls.SEEDS for w in host_words(host))
    counts, sides = {True: Counter(), False: Counter()}, Counter()
    for r in got:
        sides[block(r.host)] += 1
        counts[block(r.host)].update([f"h:{w}" for w in host_words(r.host)] + [f"p:{w}" for w in path_words(r.path)])
    size = len({*counts[True], *counts[False]})
    share = lambda side, token: (counts[side][token] + 1) / (sum(counts[side].values()) + size)
    for r in got:
        tokens = [f"h:{w}" for w in host_words(r.host)] + [f"p:{w}" for w in path_words(r.path)]
        score = math.log((sides[True] + 1) / (sides[False] + 1)) + sum(math.log(share(True, t) / share(False, t)) for t in tokens)
        assert math.isclose(r.score, score, abs_tol=1e-9) and r.verdict == ("block" if score > 0 else "allow")
    assert {r.verdict for r in got} == {"allow", "block"}
