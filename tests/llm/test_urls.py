from chronofold.llm import urls
from chronofold.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://a.org/x", "http://org/", "ftp://Example.ORG/es/1?x#y", "https://www.example.org/en/12",
    "https://example.org/en/2", "http://xexample.org/es/", "http://a.com/de", "http://a.com/de/", "http://b.com?u=http://x.org/", "x://com/fr/#de/",
    "http://a..org/", "http://org./", "http://" + "a." * 3000 + "com/de/" + "p" * 5000, "http://a.com/fr/x\nhttp://b.org/", "http://a.com/FR/",
    "http://éà.org/ü", "a://b://c.org/", "http://u:p@x.com:80/de/",
]


def by_hand(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = []
    for verdict, rule in rules:
        name, slash, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + prefix):
            fits.append((len(rule), len(name), verdict, rule))
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


def pages(spark, found):
    return spark.createDataFrame([(i, u, "<p>", "h") for i, u in found], "page_id bigint, url string, html string, host string")


def check(spark, rules, found):
    got = urls.judge_urls(pages(spark, found).repartition(3), urls.rule_table(spark, rules)).collect()
    want = [(i, *by_hand(u, rules)) for i, u in found]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_urls(spark):
    found = [*enumerate(URLS), (None, "http://a.org/x"), (1, ""), (5, "http://a.org/x"), (5, "http://a.org/x")]
    check(spark, URL_RULES, found)


def test_precedence(spark):
    rules = [("allow", "com/ab"), ("block", "a.com/"), ("block", "com/"), ("allow", "x.a.com/abc"), ("block", "localhost"), ("allow", "com/aa")]
    found = [(k, u) for k, u in enumerate(["h://x.a.com/abc", "h://a.com/ab", "h://b.com/abc", "h://localhost", "h://localhost/q", "h://b.com/aa"])]
    check(spark, rules, found)


def test_no_rules_and_no_pages(spark):
    check(spark, [], list(enumerate(URLS)))
    assert urls.judge_urls(pages(spark, []), urls.rule_table(spark, URL_RULES)).count() == 0


def test_rules_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    check(spark, URL_RULES, list(enumerate(URLS)))


def test_equal_rules_of_both_kinds_block(spark):
    table = urls.rule_table(spark, [("allow", "a.org/"), ("block", "a.org/")])
    got = urls.judge_urls(pages(spark, [(1, "h://a.org/")]), table).collect()
    assert [r["verdict"] for r in got] == ["block"]


def test_no_python_in_the_plan(spark):
    plan = urls.judge_urls(pages(spark, []), urls.rule_table(spark, URL_RULES))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_hashes_bring_together_and_full_ones_decide(spark, monkeypatch):
    monkeypatch.setattr(urls, "PREFIX_DIGITS", 1)  # most expressions meet a rule that is not theirs
    check(spark, URL_RULES, list(enumerate(URLS)))
    monkeypatch.undo()
    judged = urls.judge_urls(pages(spark, [(1, "h://a.org/")]), urls.rule_table(spark, URL_RULES))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 1 and "_digest" not in joins[0] and "_key" in joins[0]
