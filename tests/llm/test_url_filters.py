import itertools
import math
import random

import pytest
from helpers import SMALL

from lexigrove.llm import url_filters as U
from lexigrove.llm.queries import URL_RULES, op1_url_filters


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    tail = rest[end:]
    stop = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def rule_of(host, path):
    fits = [(a, r) for a, r in URL_RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits, key=lambda x: len(x[1]), default=None)


URLS = [None, "", "no scheme", "http://A.Example.com/en/x?y#z", "https://www.example.com/en/", "http://example.com", "x://net/es/", "http://a.net/fr/é", "http://b.net?q", "http://bnet/es/", "a://b://c/d", "://com/", "http://x.com/\nnew?z"]


def test_fixed_rules(spark):
    rows = [(i, u, "h", "clash") for i, u in enumerate(URLS)] + [(None, URLS[3], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(pages, labels, URL_RULES).collect()}
    want = set()
    for i, u, *_ in rows:
        host, path = parts(u)
        hit = rule_of(host, path)
        want.add((i, host, path, hit[1] if hit else None, hit[0] if hit else "allow"))
    assert got == want


def test_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = op1_url_filters(spark, SMALL).collect()
    assert len(got) == len(urls)
    for r in got:
        hit = rule_of(*parts(urls[r.page_id]))
        assert (r.host, r.path) == parts(urls[r.page_id]) and r.rule == (hit[1] if hit else None)
        if hit:
            assert r.verdict == hit[0]
    assert op1_url_filters.__name__.startswith("op1_")


@pytest.fixture
def labelled(spark):
    pages = [(i, f"http://{'casino' if i % 4 == 0 else 'news'}.org/{'win' if i % 2 == 0 else 'read'}/{i}") for i in range(400)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)] + [(5, None, None)]
    return spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_mined_rules(labelled):
    pages, labels = labelled
    rules = U.minimal([(r.tokens, r.confidence) for r in U.mine_rules(pages, labels).collect()])
    assert (("h:casino",), 1.0) in rules
    got = {r.page_id: r.verdict for r in U.filter_urls(pages, labels, [], min_confidence=0.6).collect()}
    assert got == {i: "block" if i % 4 == 0 else "allow" for i in range(400)}


def test_inverted_index_equals_all_rules():
    mined = [(("h:a", "p:x"), 0.6), (("h:b",), 0.7), (("p:x", "p:y"), 0.9)]
    rules = U.RuleSet([], mined)
    for host, path in [("a", "/x"), ("b", "/x/y"), ("a.c", "/z"), ("b", ""), ("c", "/y/x")]:
        own = U.tokens_of(host, path)
        assert rules.confidence(host, path) == max((c for t, c in mined if set(t) <= own), default=0.0)


def test_minimal_rules():
    assert U.minimal([(("a",), 0.8), (("a", "b"), 0.7), (("b", "c"), 0.9), (("a", "c"), 0.9)]) == [(("a",), 0.8), (("a", "c"), 0.9), (("b", "c"), 0.9)]


def test_small_host_of_many_pages(spark):
    urls = [(i, f"http://{'spam' if i % 120 == 0 else 'news'}.org/{i}") for i in range(3000)]
    labels = [(i, 1, int(i % 120 == 0 or i % 10 == 1)) for i in range(3000)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    rules = U.minimal([(r.tokens, r.confidence) for r in U.mine_rules(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()])
    assert rules == [(("h:spam",), 1.0), (("h:spam.org",), 1.0)]


def every_rule(pages, labels, min_count, min_confidence, min_lift):
    """All token combinations that are rules, by plain enumeration."""
    bad = {}
    for d, quality, toxic in labels:
        bad[d] = bad.get(d, False) or toxic == 1 or quality == 0
    baskets = [(U.tokens_of(*parts(u)), bad[i]) for i, u in pages if i in bad]
    n, n_bad = len(baskets), sum(b for _, b in baskets)
    joint, single = {}, {}
    for tokens, is_bad in baskets:
        for k in range(1, len(tokens) + 1):
            for x in itertools.combinations(sorted(tokens), k):
                single[x] = single.get(x, 0) + 1
                joint[x] = joint.get(x, 0) + is_bad

    def g2(b, s):
        cells = [(b, s * n_bad), (s - b, s * (n - n_bad)), (n_bad - b, (n - s) * n_bad), (n - n_bad - s + b, (n - s) * (n - n_bad))]
        return 2 * sum(x * math.log(x * n / y) for x, y in cells if x > 0)

    return {x: b / single[x] for x, b in joint.items() if b >= min_count and b / single[x] >= min_confidence and b / single[x] * n / n_bad >= min_lift and g2(b, single[x]) >= U.LEAST_RATIO}


@pytest.mark.parametrize("few", [50_000, 0])
def test_verdicts_equal_all_combinations(spark, monkeypatch, few):
    monkeypatch.setattr(U, "MAX_BROADCAST", few)
    pick = random.Random(3)
    pages = [(i, f"http://{pick.choice(['a.x', 'b.x', 'c.y'])}/{'/'.join(pick.sample(['p', 'q', 'r', 's'], 2))}" + "/win/big" * (i % 3 == 0)) for i in range(900)]
    labels = [(i, 1, int(pick.random() < (0.9 if "a.x" in u and "/q" in u else 0.8 if "win" in u and "c.y" in u else 0.1))) for i, u in pages if i < 700]
    rules = every_rule(pages, labels, 20, 0.5, 1.5)
    assert len({len(x) for x in rules}) > 1
    args = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.verdict, pytest.approx(r.confidence)) for r in U.filter_urls(*args, []).collect()}
    for i, u in pages:
        own = U.tokens_of(*parts(u))
        best = max((c for x, c in rules.items() if set(x) <= own), default=0.0)
        assert got[i] == ("block" if best else "allow", best)


def test_words_that_always_stand_together_are_one_item(spark):
    shared = "/".join("abcdefghijklm")
    pages = [(i, f"http://{'spam' if i % 2 else 'news'}.org/{shared if i % 2 else 'read'}/{i}") for i in range(200)]
    labels = [(i, 1, i % 2) for i in range(200)]
    rules = U.mine_rule_sets(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(U.minimal([(r.sets, r.confidence) for r in rules])) == 1 and len(rules) <= 4


def test_ratio_of_counts(spark):
    rows = spark.createDataFrame([(20, 0), (10, 10), (0, 7)], "bad long, good long").withColumn("g2", U.ratio(U.F.col("bad"), U.F.col("good"), 40, 60))

    def want(bad, good):
        n, having = 100, bad + good
        cells = [(bad, having * 40), (good, having * 60), (40 - bad, (n - having) * 40), (60 - good, (n - having) * 60)]
        return 2 * sum(x * math.log(x * n / m) for x, m in cells if x)

    got = rows.collect()
    assert len(got) == 3 and all(abs(r.g2 - want(r.bad, r.good)) < 1e-9 for r in got)
