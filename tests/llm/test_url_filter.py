import random

from pyspark.sql import functions as F

from aljibe.llm import url_filter as uf


def judge(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule_host, rule_path, says in uf.RULES:
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            if best is None or len(rule_host + rule_path) > len(best[0]):
                best = (rule_host + rule_path, says)
    return host, path, best and best[0], best[1] if best else ("block" if url in listed else "allow")


def test_equals_brute_force(spark, rows, with_clashes):
    dice = random.Random(5)
    hosts = ["a.org", "org", "xorg", "example.org", "www.example.org", "B.EXAMPLE.com", "com", "x.net", "é.net", ""]
    paths = ["", "/", "/es/1", "/en/1", "/en/12", "/en/2", "/fr/x", "/de/y", "/de", "?q=/de/", "#/de/", "/a/?utm_source=x&b=1"]
    urls = [None, "", "no scheme", "http://", "a://b://c/", "https://u@x.net:80/de/?a#b"] + [f"http{dice.choice(['', 's'])}://{dice.choice(hosts)}{dice.choice(paths)}" for _ in range(300)]
    listed = {u for u in urls if u and dice.random() < 0.3}
    pages = with_clashes(spark.createDataFrame(list(enumerate(urls)) + [(5000, urls[10]), (None, urls[11])], "page_id long, url string"))
    got = uf.judge_urls(pages, spark.createDataFrame([(u,) for u in listed] + [(None,)], "url string"))
    on_list = {r[0] for r in spark.createDataFrame([(u,) for u in listed], "url string").select(uf.canonical(F.col("url"))).collect()} - {None}
    canon = {r[0]: r[1] for r in spark.createDataFrame([(u,) for u in set(urls)], "url string").select("url", uf.canonical(F.col("url"))).collect()}
    hits = {u for u in urls if canon[u] in on_list}
    want = [(i, *judge(u, hits)) for i, u in [*enumerate(urls), (5000, urls[10]), (None, urls[11])]]
    assert rows(got, "page_id", "host", "path", "rule", "verdict") == sorted(want, key=repr)


def test_canonical_forms(spark):
    def form(url):
        return spark.createDataFrame([(url,)], "url string").select(uf.canonical(F.col("url"))).first()[0]

    assert form("HTTP://WWW.X.net/a/?ref=1&b=2&a=1#top") == form("https://x.net/a?a=1&b=2") == "x.net/a?a=1&b=2"
    assert form("mailto") is None and form(None) is None


def test_the_filter_loses_nothing_and_is_bounded(spark):
    names = spark.range(5000).select(F.concat(F.lit("x.net/"), "id").alias("listed_url"))
    blocks = uf.bloom_blocks(5000)
    bloom = uf.blocked_bloom(names, "listed_url", blocks)
    asked = spark.range(20_000).select(F.concat(F.lit("x.net/"), "id").alias("canon"))
    passed = {r[0] for r in uf.possible_hits(asked, bloom, "canon", blocks).collect()}
    assert passed >= {f"x.net/{i}" for i in range(5000)} and len(passed) < 5000 + 0.05 * 15_000
    assert uf.bloom_blocks(10**12) == uf.MAX_BLOCKS and uf.bloom_blocks(0) == 1
    assert bloom.count() <= blocks


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    nothing = spark.createDataFrame([], "url string")
    assert uf.judge_urls(pages, nothing).first()["verdict"] == "allow"
    assert uf.judge_urls(pages.where("false"), nothing).count() == 0
