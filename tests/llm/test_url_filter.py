import random
import re

import pytest

import oracle
from demandloom.llm import oracles, queries
from demandloom.llm import url_filter as u


def brute(url, rules, words=()):
    """Every rule tried on the url by plain string tests."""
    host, path = "", ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        h, p = h.lower(), ("/" + p if "/" in rule else "")
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), verdict, h + p))
    if fits:
        return host, path, max(fits)[3], max(fits)[2]
    return host, path, None, "block" if set(re.split("[^a-z0-9]+", host)) & set(words) else "allow"


ODD_URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://A.NET/", "ftp://x.NET", "http://net/", "http://anet/", "http://..net/",
    "http://x.net?/q", "http://x.net#/f", "http://example.net/en/", "http://a.example.net/en/7?x=://b.org/fr/", "http://example.net/e",
    "http://user@x.org/fr/1", "http://x.org:80/fr/", "http://x.org/fr", "http://ünï.org/fr/ß", "http://casino-win.org/", "http://casinos.casino.net/",
    "http://x.org/fr/\nline", "http://" + "a." * 3000 + "net/" + "b/" * 3000, "http://x.com/" + "y" * 200_000, "x://example.com/de/../en/",
]


def odd_pages(spark):
    rows = [(i, t, None) for i, t in enumerate(ODD_URLS)]
    rows += [(None, None, "h"), (None, "http://x.net/", "h"), (None, "http://x.net/", "h"), rows[4], rows[9], rows[9]]
    rows = [(*r, "host", "path", "rule", 1, "a", "d", "p") for r in rows]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, host string, path string, rule string, _copies int, _asked string, _digest string, _prefix string"
    )


@pytest.mark.parametrize("digits", [1, 8])
def test_odd_urls(spark, digits):
    """Null, empty, broken and very long urls, repeated rows, clashing columns; short digits collide and are told apart."""
    pages = odd_pages(spark)
    got = sorted(map(str, (tuple(r)[:5] for r in u.judge_urls(pages, prefix_digits=digits).collect())))
    want = sorted(str((r[0], *brute(r[1], u.RULES, u.BLOCKED_WORDS))) for r in pages.collect())
    assert got == want


def test_any_rules(spark):
    """Rules of every shape: hosts alone, starts inside a path segment, ties, conflicts, none at all."""
    rng = random.Random(3)
    labels, segments = ["a", "b", "net", "x-y"], ["", "en", "e", "enx", "fr", "fr/x"]
    urls = [f"http://{'.'.join(rng.choices(labels, k=rng.randint(0, 4)))}/{'/'.join(rng.choices(segments, k=rng.randint(0, 4)))}" for _ in range(400)]
    rules = [
        (rng.choice(["block", "allow"]), ".".join(rng.choices(labels, k=rng.randint(0, 3))) + rng.choice(["", "/", "/e", "/en", "/en/", "/en/f", "//", "/fr/x/"]))
        for _ in range(80)
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for some in (rules, rules[:3], []):
        for frame in (some, spark.createDataFrame(some, "verdict string, rule string")):
            got = {r["page_id"]: tuple(r)[1:5] for r in u.judge_urls(pages, frame, words=("y",)).collect()}
            assert got == {i: brute(t, some, ("y",)) for i, t in enumerate(urls)}


def test_rules_that_say_nothing(spark):
    rules = spark.createDataFrame([("block", None), (None, "net/"), ("maybe", "net/"), ("block", "/x"), ("allow", "NET/"), ("block", "net/")], "verdict string, rule string")
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert [tuple(r)[3:5] for r in u.judge_urls(pages, rules).collect()] == [("net/", "block")]


def test_empty_table(spark):
    assert u.judge_urls(odd_pages(spark).where("false")).collect() == []


def test_allowed_rows_keep_their_columns(spark):
    pages = odd_pages(spark)
    kept = u.allowed_pages(pages)
    assert kept.schema == pages.schema
    want = [tuple(r) for r in pages.collect() if brute(r["url"], u.RULES, u.BLOCKED_WORDS)[3] == "allow"]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


def test_joined_by_short_digits_and_no_page_is_sent_out(spark, sf_dir):
    plan = queries.op11_url_filters(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "substring(_asked" in plan and "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_odd_urls_in_sql(spark, tmp_path):
    odd_pages(spark).select("page_id", "url", "html").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    connection = oracle.duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert oracle.differences(queries.op11_url_filters(spark, str(tmp_path)), connection, oracles.SQL["op11_url_filters"]) == []
