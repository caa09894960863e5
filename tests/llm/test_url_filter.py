import re

from flowframe.llm.queries import RULES
from flowframe.llm.url_filter import compile_rules, index_rules, rule_table, url_filter


def judge(url, rules, default="allow"):
    """All rules tried on one url."""
    match = re.search(r"(?s)://([^?#]*)", url or "")
    rest = match[1] if match else ""
    cut = rest.find("/") if "/" in rest else len(rest)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def check(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, rule string, _other string")
    out = url_filter(df, rule_table(spark, rules))
    assert out.columns == ["page_id", "url", "_other", "host", "path", "rule", "verdict"]
    rows = out.collect()
    assert sorted(r.page_id for r in rows) == list(range(len(urls)))
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == judge(r.url, rules), r.url


URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://a.org/", "http://a.org", "https://x.Example.ORG/es/1?q=/fr/#x",
    "http://example.org/en/1", "http://example.org/en/12/3", "http://example.org/en/2", "http://notexample.org/es/", "http://b.com/fr/",
    "http://b.com/FR/", "http://b.com/fr", "http://com/de/#", "http://com.net/de/", "ftp://u:p@b.com:80/de/", "http://b.com?x=/fr/",
    "http://b.com#/fr/", "http://a.b.com/de/://c.org/", "http://é.com/fr/é", "http://a.com/fr/\n2", "http://" + "a" * 100_000 + ".com/fr/" + "b/" * 50_000,
]


def test_contract_rules(spark):
    check(spark, URLS * 2, RULES)


def test_odd_rules(spark):
    rules = [("block", "a.com", ""), ("allow", "a.com", "/x.(y"), ("block", "com", "/x.(y"), ("allow", "", "/all"), ("block", "org", "/p"), ("allow", "org", "/p")]
    urls = ["http://a.com", "http://a.com/x.(y)/z", "http://b.com/x.(y", "http://b.com/xx(y", "http://a.comx/", "http://o.org/pq", "http://x/all"]
    check(spark, urls, rules)


def test_rarest_token_is_the_key(spark):
    tokens = spark.createDataFrame([("com",)] * 9 + [("fr",)] * 2 + [("org",)] * 3, "__llm_token string")
    index = {r["__llm_rule"]: r["__llm_token"] for r in index_rules(compile_rules(rule_table(spark, RULES)), tokens).collect()}
    assert index["com/fr/"] == "fr" and index["org/"] == "org" and index["com/de/"] == "de"
    assert index["example.org/en/1"] in {"example", "en"}


def test_one_url_on_most_rows_and_empty_table(spark):
    check(spark, ["http://b.com/de/1"] * 300 + ["http://b.com/fr/1"], RULES)
    df = spark.createDataFrame([], "page_id long, url string")
    assert url_filter(df, rule_table(spark, RULES)).collect() == []


def test_other_default(spark):
    df = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    assert url_filter(df, rule_table(spark, RULES), default="block").first().verdict == "block"


def test_only_ascii_letters_of_hosts_are_folded(spark):
    df = spark.createDataFrame([(1, "http://É.com/x"), (2, "http://é.com/x"), (3, "http://www.AÉ.com/x")], "page_id long, url string")
    out = url_filter(df, rule_table(spark, [("block", "É.com", "/"), ("block", "aÉ.COM", "/")]), url="url").collect()
    assert {r.page_id: r.verdict for r in out} == {1: "block", 2: "allow", 3: "block"}
