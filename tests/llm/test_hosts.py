"""URL filter: parts and rules case by case, reputations from planted hosts."""

import pytest
from pyspark.sql import functions as F

from shardlog.llm import hosts
from shardlog.llm.queries import QUERIES, RULES


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://WWW.Example.ORG/es/1?x#y", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
    ("http://example.org/en/27", "example.org", "/en/27", "org/", "allow"),
    ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("x://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
    ("x://a.com/fr", "a.com", "/fr", None, "allow"),
    ("x://com/de/#", "com", "/de/", "com/de/", "block"),
    ("x://a.com?/de/", "a.com", "", None, "allow"),
    ("x://a.org", "a.org", "", None, "allow"),
    ("x://É.Net/a", "É.net", "/a", None, "allow"),
    ("a://b.net/c://d.org/e", "b.net", "/c://d.org/e", None, "allow"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(url,)], "url string").select(hosts.host_of(F.col("url")).alias("h"), hosts.path_of(F.col("url")).alias("p"))
    which, said = hosts.rule_for(RULES, F.col("h"), F.col("p"))
    got = df.select("h", "p", which, F.coalesce(said, F.lit("allow"))).first()
    assert tuple(got) == (host, path, rule, verdict)


def test_reputation_follows_the_levels(spark):
    pages, bad = [], []
    def add(host, n, share):
        for i in range(n):
            pages.append((len(pages), f"http://{host}/{i}"))
            bad.append((len(bad), i < share * n))
    for i in range(12):
        add(f"h{i}.spam.com", 30, 0.95)
        add(f"h{i}.fine.com", 30, 0.05)
    add("new.spam.com", 1, 0.0)
    add("new.fine.com", 1, 1.0)
    unlabelled = [(90_000, "http://other.spam.com/"), (90_001, "http://other.fine.com/"), (90_002, "http://x.net/")]
    df = spark.createDataFrame(pages + unlabelled, "page_id long, url string").selectExpr("*", "1 as host", "2 as n", "3 as x", "4 as a")
    got = {r.page_id: r for r in hosts.judged(df, spark.createDataFrame(bad, "page_id long, bad boolean"), []).collect()}
    assert all(r.verdict == ("block" if "spam" in r.host else "allow") for i, r in got.items() if i < len(pages) - 2)
    assert got[90_000].bad_share > 0.8 and got[90_001].bad_share < 0.2
    assert got[90_000].verdict == "block" and got[90_002].verdict == "allow"
    assert got[len(pages) - 1].verdict == "allow"  # one bad page does not outweigh its domain


@pytest.mark.parametrize("host,domain,suffix", [
    ("a.b.example.com", "example.com", "com"), ("example.co.uk", "example.co.uk", "co.uk"), ("x.example.co.id", "example.co.id", "co.id"),
    ("me.github.io", "me.github.io", "github.io"), ("a.me.github.io", "me.github.io", "github.io"), ("github.io", "github.io", "github.io"),
    ("a.b.c.ck", "b.c.ck", "c.ck"), ("x.www.ck", "www.ck", "ck"), ("city.kawasaki.jp", "city.kawasaki.jp", "kawasaki.jp"),
    ("a.b.kawasaki.jp", "a.b.kawasaki.jp", "b.kawasaki.jp"), ("a.b.unlisted", "b.unlisted", "unlisted"), ("com", "com", "com"), ("", "", ""),
    ("10.0.0.1", "10.0.0.1", "number"), ("[::1]", "[::1]", "number"), ("xn--85x722f.xn--55qx5d.cn", "xn--85x722f.xn--55qx5d.cn", "xn--55qx5d.cn"),
    ("食狮.公司.cn", "食狮.公司.cn", "公司.cn"), ("l." * 3000 + "co.uk", "l.co.uk", "co.uk"),
])
def test_levels(spark, host, domain, suffix):
    df = spark.createDataFrame([(host, 1)], "host string, n int")
    got = hosts.placed(df, hosts.suffix_rules(spark)).first()
    assert (got.host, got.n, got.domain, got.suffix) == (host, 1, domain, suffix)


def test_a_list_of_ones_own(spark, tmp_path):
    (tmp_path / "list").write_text("// own\n\nshop\n*.shop  and a remark\n!my.shop\n")
    rules = hosts.suffix_rules(spark, str(tmp_path / "list"))
    df = spark.createDataFrame([("a.b.c.shop",), ("a.my.shop",), ("x.com",)], "host string")
    assert {(r.host, r.suffix) for r in hosts.placed(df, rules).collect()} == {("a.b.c.shop", "c.shop"), ("a.my.shop", "shop"), ("x.com", "com")}


@pytest.mark.parametrize("host,name", [("a.com:8080", "a.com"), ("u:p@a.com", "a.com"), ("a.com.", "a.com"), ("[::1]:80", "[::1]"), ("", ""), ("a@b@c.de:", "c.de")])
def test_plain_names(spark, host, name):
    assert spark.createDataFrame([(host,)], "h string").select(hosts.plain(F.col("h"))).first()[0] == name


def test_query_finds_planted_hosts(spark, tmp_path):
    """Bad documents shown by one host only; the numbers of its pages are those of good documents."""
    pages, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        host = f"h{i % 3}.pills.net:8080" if bad else f"h{i % 5}.news.net"
        pages.append((1000 + (i + 1) % 400, f"http://{host}/en/2024/{1000 + i}.html?id=7#5"))
        labels.append((1000 + i, int(not bad), 0))
    pages += [(5000, "http://new.pills.net/"), (5001, "http://new.news.net/no/number"), (5002, None), (None, "http://h1.news.net/en/1000")]
    spark.createDataFrame(pages, "page_id long, url string").withColumn("html", F.lit("")).write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op8_url_filter"](spark, str(tmp_path)).collect()
    assert len(got) == len(pages)
    assert all(r.verdict == ("block" if "pills" in r.host else "allow") for r in got)
    assert {r.host for r in got if "pills" in r.host} == {"h0.pills.net:8080", "h1.pills.net:8080", "h2.pills.net:8080", "new.pills.net"}


@pytest.mark.parametrize("path,number", [("/en/7817", 7817), ("/en/4033.html", 4033), ("/en/1/22/", 22), ("/", None), ("", None), ("/" + "9" * 30, int("9" * 18))])
def test_the_document_of_a_page(spark, path, number):
    assert spark.createDataFrame([(path,)], "p string").select(hosts.shown_document(F.col("p"))).first()[0] == number


def test_awkward(spark):
    rows = [(1, None), (1, None), (None, "http://a.com/"), (2, ""), (3, "http://" + "x" * 100_000 + ".com/" + "y" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    none = spark.createDataFrame([(None, True), (1, None), (1, True), (1, True)], "page_id long, bad boolean")
    assert hosts.judged(df, none, RULES).count() == len(rows)
    assert hosts.judged(df.limit(0), none, RULES).count() == 0
    assert hosts.judged(df, none.limit(0), RULES).where("bound is null").count() == 0
    assert hosts.judged(df.limit(0), none.limit(0), RULES).count() == 0
