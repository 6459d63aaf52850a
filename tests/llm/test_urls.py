from pyspark.sql import types as T

from viaduct.llm.url_filter import judge_urls

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("host", T.StringType()), T.StructField("n_bad", T.StringType())])


def judged(spark, urls, outcomes=()):
    pages = spark.createDataFrame([(i, u, None, None) for i, u in urls], PAGES)
    labels = spark.createDataFrame(list(outcomes), "page_id long, bad int")
    return {r["page_id"]: r for r in judge_urls(pages, labels).collect()}


def test_rules_hosts_and_paths(spark):
    found = judged(spark, enumerate([
        "http://A.Example.NET/en/x?y#z", "https://example.net/de/", "https://b.net", "http://org/fr/a", "http://x.org/fr",
        "ftp://example.com/de/1", "https://notexample.com/de/1", None, "no address", "http://", "http://a.com://b/de/",
        "http://www.example.com/de/?http://b.net/"]))
    assert [(found[i]["host"], found[i]["path"], found[i]["rule"], found[i]["verdict"]) for i in range(12)] == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "/de/", "net/", "block"),
        ("b.net", "", None, "allow"), ("org", "/fr/a", "org/fr/", "allow"), ("x.org", "/fr", None, "allow"),
        ("example.com", "/de/1", "example.com/de/", "block"), ("notexample.com", "/de/1", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.com:", "//b/de/", None, "allow"),
        ("www.example.com", "/de/", "example.com/de/", "block")]


def test_reputation_shrinks_to_the_domain(spark):
    urls, labels = [], []
    for k in range(40):  # a bad host, good hosts, and hosts of a bad domain with few labels each
        urls += [(k, "http://bad.one.com/a"), (100 + k, f"http://h{k % 4}.two.com/a"), (200 + k, f"http://h{k}.three.com/a")]
        labels += [(k, 1), (100 + k, 0), (200 + k, 1)]
    urls += [(1000 + k, f"http://g{k % 50}.five.com/") for k in range(2000)]
    labels += [(1000 + k, int(k % 25 == 0)) for k in range(2000)]
    urls += [(300, "http://new.three.com/"), (301, "http://new.two.com/"), (302, "http://lone.four.com/")]
    labels += [(302, 1)]
    found = judged(spark, urls, labels)
    assert found[0]["verdict"] == "block" and found[100]["verdict"] == "allow" and found[200]["verdict"] == "block"
    assert found[301]["verdict"] == "allow" and found[302]["verdict"] == "allow"
    assert found[300]["bad_low"] > found[302]["bad_low"] * 0.5


def test_empty_tables(spark):
    assert judged(spark, []) == {}
    assert judged(spark, [(1, "http://a.org/")])[1]["verdict"] == "allow"


def test_suffixes_may_come_from_a_table(spark):
    from pyspark.sql import functions as F

    from viaduct.llm.url_filter import domain_of, suffix_list, suffix_of
    listed = suffix_list(spark.createDataFrame([("com.pl",), ("CITY.kawasaki.jp",), (None,), ("pl",), ("com.pl",)], "suffix string"))
    assert listed == ("city.kawasaki.jp", "com.pl", "pl")
    hosts = ["a.b.com.pl", "com.pl", "b.pl", "x.y.city.kawasaki.jp", "y.kawasaki.jp", "", "10.0.0.1"]
    frame = spark.createDataFrame([(h,) for h in hosts], "h string")
    found = frame.select(suffix_of(F.col("h"), listed), domain_of(F.col("h"), listed)).collect()
    assert [tuple(r) for r in found] == [("com.pl", "b.com.pl"), ("com.pl", "com.pl"), ("pl", "b.pl"),
                                         ("city.kawasaki.jp", "y.city.kawasaki.jp"), ("jp", "kawasaki.jp"), ("", ""), ("1", "10.0.0.1")]
