"""Operator 9 against SQL on the given pages and plain Python on odd ones."""

import duckdb
import pytest

from assayframe.llm import url_filter as uf

URLS = [
    None,
    "",
    "no scheme here",
    "http://",
    "http://a.net",
    "http://a.net/",
    "HTTPS://WWW.A.NET/x",
    "http://example.net/en/1",
    "http://b.example.net/en/1?x=1",
    "http://notexample.net/en/1",
    "http://example.com/de/",
    "http://example.com/de?x",
    "http://w.org/fr/#top",
    "http://w.org/fr",
    "x://y://z/net/",
    "http://É.org/fr/é",
    "http://a.net:80/p?q=://x",
    "http://spam.site/a/?b=2&a=1&utm_source=f#x",
    "https://www.spam.site/a?a=1&b=2",
    "http://spam.site/a?a=1",
]
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
    path = rest[stop:].split("?")[0].split("#")[0]
    return host, path


def plain_rule(host, path):
    fits = [
        (h + p, v)
        for v, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


def frame(spark, urls):
    rows = [(i, u, "x", "x") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")


def test_odd_urls(spark):
    listed = spark.createDataFrame([("spam.site/a?a=1&b=2",), (None,)], "canonical string")
    found = {r["page_id"]: r for r in uf.judge(frame(spark, URLS + URLS), listed).collect()}
    assert len(found) == 2 * len(URLS)
    for i, url in enumerate(URLS + URLS):
        host, path = plain_parts(url)
        rule, verdict = plain_rule(host, path)
        own = "block" if url and "spam.site" in url and "b=2" in url else "allow"
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == (verdict or own), url


def test_false_positives_go(spark, monkeypatch):
    """With a filter of a single block nearly all pages pass, and the join still has the last word."""
    monkeypatch.setattr(uf, "BLOCK_BITS", 1 << 40)
    urls = [f"http://h{i}.io/p" for i in range(4_000)]
    listed = spark.createDataFrame([(f"h{i}.io/p",) for i in range(0, 4_000, 4)], "canonical string")
    pages = frame(spark, urls)
    from pyspark.sql import functions as F

    known = pages.select("page_id", uf.canonical(F.col("url")).alias("canonical"))
    passed = uf.passing(known, uf.build(listed, 1), 1).where("_passes").count()
    assert passed > 3_900
    verdicts = {r["page_id"]: r["verdict"] for r in uf.judge(pages, listed, ()).collect()}
    assert all((v == "block") == (i % 4 == 0) for i, v in verdicts.items())


def test_filter_loses_none_and_passes_few(spark):
    from pyspark.sql import functions as F

    listed = spark.range(20_000).select(F.concat(F.lit("in/"), "id").alias("canonical"))
    others = spark.range(20_000).select(F.concat(F.lit("out/"), "id").alias("canonical"))
    blocks = 20_000 * uf.KEY_BITS // uf.BLOCK_BITS
    bloom = uf.build(listed, blocks)
    assert uf.passing(listed, bloom, blocks).where("NOT _passes").count() == 0
    assert uf.passing(others, bloom, blocks).where("_passes").count() < 200


def test_a_filter_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(uf, "BROADCAST_BYTES", 0)
    listed = spark.createDataFrame([("a.io/p",)], "canonical string")
    pages = frame(spark, ["http://a.io/p", "http://b.io/p", None])
    found = {r["page_id"]: r["verdict"] for r in uf.judge(pages, listed, ()).collect()}
    assert found == {0: "block", 1: "allow", 2: "allow"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "canonical string")
    pages = frame(spark, ["http://a.io/p", None])
    assert {r["verdict"] for r in uf.judge(pages, none, ()).collect()} == {"allow"}
    assert uf.judge(frame(spark, []), none).count() == 0
    with pytest.raises(ValueError, match="listed"):
        uf.by_rule([uf.Rule("block", str(i), "/") for i in range(uf.MAX_RULES + 1)], lambda r: r.name)


def test_the_join_decides_verdicts(spark, sf_dir):
    """Reported URLs are known by the list alone: their hosts have pages of both verdicts."""
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{sf_dir}/../sf0.1/pages.parquet").select("page_id", "url")
    with_list = uf.query(spark, f"{sf_dir}/../sf0.1").where("rule IS NULL")
    without = uf.judge(pages, uf.spam_list(pages)).select("page_id", F.col("verdict").alias("bare"))
    changed = with_list.join(without, "page_id").where("verdict <> bare")
    plain = with_list.where(~F.col("host").rlike("|".join(uf.SPAM_WORDS)))
    mixed = plain.groupBy("host").agg(F.count_distinct("verdict").alias("n")).where("n = 2")
    assert changed.count() > 20 and mixed.count() > 3
    # other forms of a URL are the same URL
    forms = pages.select(uf.canonical(F.col("url")).alias("a")).where("a IS NOT NULL")
    again = forms.select("a", uf.canonical(uf.mirrored(F.col("a"))).alias("b"))
    assert again.where("a <> b").isEmpty()


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    wanted = con.execute(uf.SQL)
    names = [d[0] for d in wanted.description]
    found = uf.query(spark, sf_dir).select(*names).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted.fetchall()))
    assert {r["verdict"] for r in found} == {"allow", "block"}
