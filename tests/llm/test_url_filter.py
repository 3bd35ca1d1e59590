import numpy as np
import pytest
from pyspark.sql import functions as F

from lognorm.llm import url_filter as uf

URLS = [
    None, "", "no scheme", "http://", "://x", "http://A.Example.ORG/es/1?q=/x", "https://org/", "https://notorg/x", "http://example.org/en/12",
    "http://example.org/en/2", "http://x.example.org:80/en/1", "http://b.com/fr", "http://b.com/fr/", "http://com/de/x#y", "http://b.com?x=/fr/",
    "http://b.com#/de/", "ftp://casino-win.example.net/a://b/", "http://sub.bets.net", "http://É.org/path", "http://a..org//", "http://.com/de/",
    "http://casino.org/x", "http://x.net/" + "long/" * 20_000, "http://adult-x.example.com/de/1", "http://a\nb.org/x"]


def plain(url, rules, listed):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), len(h), k, h + p) for k, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        n = max(f[:2] for f in fits)
        kinds = {f[2] for f in fits if f[:2] == n}
        return host, path, max(fits)[3], "block" if "block" in kinds else "allow"
    parents = [host] + [host[i + 1:] for i, c in enumerate(host) if c == "."]
    return host, path, None, "block" if host and any(p in listed for p in parents) else "allow"


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [(i, u, None, None) for i, u in enumerate(URLS)] + [(4, URLS[4], None, None)], "page_id long, url string, keys string, host string")


def check(spark, pages, rules, listed):
    hosts = spark.createDataFrame([(h,) for h in listed] + [(None,)], "h string")
    got = uf.judge(pages, hosts, rules).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(URLS[r.page_id], rules, set(listed)), URLS[r.page_id]


def test_rules_and_lists(spark, pages):
    check(spark, pages, uf.RULES, ["casino-win.example.net", "bets.net", "net.unused", "example.com"])


def test_ties_double_listing_and_empty_paths(spark, pages):
    rules = [("allow", "org", "/"), ("block", "org", "/"), ("allow", "b.com", "/f"), ("block", "com", "/fr/"), ("block", "net", ""), ("allow", "example.net", "")]
    check(spark, pages, rules, ["com"])


def test_no_rules_no_list_no_pages(spark, pages):
    check(spark, pages, [], [])
    assert uf.judge(pages.limit(0), spark.createDataFrame([], "h string")).count() == 0


@pytest.mark.parametrize("shard", [10**9, 150])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, shard):
    monkeypatch.setattr(uf, "SHARD_KEYS", shard)
    monkeypatch.setattr(uf, "BITS_PER_KEY", 2.5)  # many false positives, so many levels
    keys = spark.range(3000).select(F.concat(F.lit("key"), "id").alias("k"), (F.col("id") % 7 == 0).alias("listed"))
    h1, h2 = uf.hashes(F.col("k"))
    universe = keys.select(h1.alias("h1"), h2.alias("h2"), "listed").cache()
    cascades = uf.build_cascades(universe, "listed")
    assert len(cascades) == (1 if shard > 1000 else 3) and all(len(c) > 1 for c in cascades)
    rows = uf.with_membership(keys.groupBy(F.lit(1)).agg(F.collect_list("k").alias("keys"), F.collect_list("listed").alias("want")), "keys", cascades, "got")
    r = rows.collect()[0]
    assert list(r.got) == list(r.want)


def test_empty_cascade():
    assert not uf.member([], np.array([1], np.uint64), np.array([2], np.uint64)).any()
