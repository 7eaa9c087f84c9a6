import random

from skein.llm import url_filter

SCHEMA = "page_id long, url string, host string, verdict int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:cut]


def brute(url, rules):
    host, path = parts(url)
    fits = [(len(h) + len(p), len(h), a, h + p) for h, p, a in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    top = max(f[:2] for f in fits)
    action, rule = min((a, r) for n, m, a, r in fits if (n, m) == top)
    return host, path, rule, action


def run(spark, urls, rules, **kw):
    # extra columns share names with the result
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in urls], SCHEMA)
    got = url_filter.apply_rules(df, spark.createDataFrame(rules, url_filter.RULE_SCHEMA), **kw).collect()
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str)


def want(urls, rules):
    return sorted(((i, *brute(u, rules)) for i, u in urls), key=str)


EDGES = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x?y#z", "http://a.net?x/", "x://É.NeT/en/://b",
         "http://a..net/", "http://.net/", "http://net./", "http://example.net/en", "http://example.net/en/" + "p" * 100_000, "http://xnet/"]


def test_edges_and_ties(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("net", "/", "allow"), ("a.net", "", "block"), ("net", "/x", "allow")]
    urls = [(i, u) for i, u in enumerate(EDGES)] + [(None, "http://a.net/x"), (4, "http://net"), (4, "http://net")]
    assert run(spark, urls, rules) == want(urls, rules)


def test_random_nested_rules(spark):
    rng = random.Random(2)
    label = lambda: rng.choice(["a", "b", "c", "net"])
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda: "/" + "/".join(label() for _ in range(rng.randint(0, 3)))
    rules = [(host(3), rng.choice(["", path()]), rng.choice(["allow", "block"])) for _ in range(60)]
    # a third of the urls are one and the same, and more are of one host
    urls = [(i, f"http://{host(5)}{path()}") for i in range(400)] + [(1000 + i, "http://a.b.net/a/b") for i in range(300)]
    urls += [(2000 + i, f"http://c.net{path()}") for i in range(200)]
    assert run(spark, urls, rules, buckets=13) == want(urls, rules)


def test_empty_tables(spark):
    assert run(spark, [], [("net", "/", "block")]) == []
    urls = [(1, "http://a.net/")]
    df = spark.createDataFrame(urls, "page_id long, url string")
    got = url_filter.apply_rules(df, spark.createDataFrame([], url_filter.RULE_SCHEMA)).collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "allow")]
