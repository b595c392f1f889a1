"""Rules and trees over URLs against brute force, and on odd rows."""

import io
import math
import re
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from onomast.llm import url_filter
from onomast.llm.queries import QUERIES, URL_RULES

FOLDER = "/root/testdata/sf0.001"
ODD = [
    None, "", "no scheme", "://", "http://", "http://ORG", "http://Org/", "HTTP://a.ORG/x?y=1&z;q=2#f", "http://xorg/", "a://b://c.org/d",
    "http://example.org/en/1", "http://example.org/en/12?x", "http://www.example.org/en/2", "http://EXAMPLE.org/es/", "http://x.com/fr/#a?b", "http://x.com/fr",
    "http://y.com/de/1.html", "http://ÄB.com/de/ü", "http://a.org?/es/", "http://a.org#/es/", "line\nbreak://u.org/\n/es/", "http://😀.com/fr/😀", "http://c.com/" + "a1-" * 50_000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = lambda rule: (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith("/" + rule.split("/", 1)[1])
    return max((r for r, _ in URL_RULES if fits(r)), key=len, default=None)


def entropy(text):
    n = len(text)
    return round(1000 * (math.log2(n) - sum(c * math.log2(c) for c in Counter(text).values()) / n)) if n else 0


def chance(model, features):
    total = model.base
    for tree in model.trees:
        while not isinstance(tree, float):
            name, limit, low, high = tree
            tree = low if features[name] <= limit else high
        total += tree
    return 1 / (1 + math.exp(-total))


def described(urls, model):
    rows = urls.select(F.col("url").alias("_url"), url_filter.host_of(F.col("url")).alias("_host"), url_filter.path_of(F.col("url")).alias("_path"))
    return url_filter._described(rows, model.part, model.suffixes)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")


@pytest.fixture(scope="module")
def model(spark, pages):
    return url_filter.learn(pages, URL_RULES)


def test_query_against_brute_force(spark, pages, model):
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    rows = QUERIES["op11_url_trees"](spark, FOLDER).collect()
    assert len(rows) == len(urls)
    features = {r["_url"]: {k[3:]: v for k, v in r.asDict().items() if k.startswith("_f_")} for r in described(pages, model).collect()}
    for r in rows:
        host, path = parts(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule_of(host, path))
        score = chance(model, features[urls[r["page_id"]]])
        assert r["score"] == pytest.approx(score, abs=1e-12)
        assert r["verdict"] == (dict(URL_RULES)[r["rule"]] if r["rule"] else "block" if score >= 0.5 else "allow")


def test_features(spark, model):
    urls = spark.createDataFrame([(u,) for u in ODD], "url string")
    for r in described(urls, model).collect():
        url = r["_url"] or ""
        host, path = parts(r["_url"])
        assert (r["_host"], r["_path"]) == (host, path)
        query = re.match(r"(?s)[^?#]*\?([^#]*)", url)
        digits = sum(c in "0123456789" for c in url)
        expected = {
            "length": len(url), "host_length": len(host), "path_length": len(path), "labels": len([x for x in host.split(".") if x]), "hyphens": host.count("-"),
            "depth": len([x for x in path.split("/") if x]) if path.startswith("/") else 0, "digit_part": 1000 * digits // len(url) if url else 0,
            "longest_number": max(map(len, re.findall("[0-9]+", url)), default=0), "parameters": len(re.findall("[^&;]+", query[1])) if query else 0,
            "entropy": entropy(url), "host_entropy": entropy(host),
        }
        assert {k: r[f"_f_{k}"] for k in expected} == expected, url[:40]


def test_trees_against_plain_boosting(spark, pages, model):
    """The same trees from the sample's features by plain loops over all rows, limits and nodes."""
    labelled = [(u, b) for u in {r["url"] for r in pages.collect()} for h, p in [parts(u)] for r in [rule_of(h, p)] if r for b in [int(dict(URL_RULES)[r] == "block")]]
    features = {r["_url"]: {k[3:]: v for k, v in r.asDict().items() if k.startswith("_f_")} for r in described(pages, model).collect()}
    rows, names = [(features[u], b) for u, b in labelled], sorted(next(iter(features.values())))
    assert model.part == sum(b for _, b in rows) / len(rows)

    def quantile(values, share):
        at = (len(values) - 1) * share
        low = values[math.floor(at)]
        return math.floor(low + (values[math.ceil(at)] - low) * (at - math.floor(at)))

    limits = {f: sorted({quantile(sorted(x[f] for x, _ in rows), k / url_filter.BINS) for k in range(1, url_filter.BINS)}) for f in names}
    unit, totals = url_filter.UNIT, [model.base] * len(rows)

    def grow(some, depth):
        g, h = (sum(x[k] for x in some) for k in (1, 2))
        worth = lambda part: sum(x[1] for x in part) ** 2 / (sum(x[2] for x in part) + unit)
        best = None
        for f in names if depth else ():
            for limit in limits[f]:
                low, high = [x for x in some if x[0][f] <= limit], [x for x in some if x[0][f] > limit]
                if min(len(low), len(high)) >= url_filter.LEAST:
                    gain = worth(low) + worth(high) - worth(some)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, limit, low, high)
        if best is None:
            return url_filter.RATE * g / (h + unit)
        return best[1], best[2], grow(best[3], depth - 1), grow(best[4], depth - 1)

    for tree in model.trees[:4]:
        p = [1 / (1 + math.exp(-t)) for t in totals]
        some = [(x, round((b - q) * unit), round(q * (1 - q) * unit)) for (x, b), q in zip(rows, p)]
        assert grow(some, url_filter.DEPTH) == tree
        totals = [t + chance_of(tree, x) for t, (x, _) in zip(totals, rows)]


def chance_of(tree, features):
    while not isinstance(tree, float):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def test_labels_not_learnt_from(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    out = F.crc32("url") % 5 == 0
    model = url_filter.learn(pages.where(~out), URL_RULES)
    rows = url_filter.judge_urls(pages.where(out), URL_RULES, model, []).where("rule is not null").collect()
    assert sum((r["score"] >= 0.5) == (r["verdict"] == "block") for r in rows) >= 0.85 * len(rows)


def test_odd_rows(spark, model):
    names = ["host", "path", "rule", "verdict", "score", "_url", "_suffix", "_part", "_c0", "_f_length"]
    table = spark.createDataFrame([(i, u) for i, u in enumerate(ODD * 2)], "page_id long, url string").withColumns({n: F.lit("own") for n in names})
    rows = {r["page_id"]: r for r in url_filter.judge_urls(table, URL_RULES, model, ["page_id"]).collect()}
    assert len(rows) == 2 * len(ODD)
    for i, url in enumerate(ODD * 2):
        host, path = parts(url)
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule_of(host, path)) and r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1
        assert r["score"] == rows[i % len(ODD)]["score"]
    assert url_filter.judge_urls(table, URL_RULES, model, ["_url", "_c0"]).columns[:2] == ["_url", "_c0"]
    assert url_filter.judge_urls(table.limit(0), URL_RULES, model, ["page_id"]).collect() == []


def test_without_labels_and_with_one_kind(spark):
    table = spark.createDataFrame([(0, "http://a.net/x"), (1, None), (2, "http://b.org/x"), (2, "http://b.org/x")], "page_id long, url string")
    assert url_filter.learn(table.limit(0), URL_RULES) is None and url_filter.learn(table.where("page_id < 2"), URL_RULES) is None
    rows = url_filter.judge_urls(table, URL_RULES, None, ["page_id"]).collect()
    assert [(r["page_id"], r["verdict"], r["score"]) for r in sorted(rows)] == [(0, "allow", None), (1, "allow", None), (2, "allow", None), (2, "allow", None)]
    one = url_filter.learn(table, URL_RULES)
    assert one.trees == [] and {r["verdict"] for r in url_filter.judge_urls(table, URL_RULES, one, ["page_id"]).collect()} == {"allow"}
    blocked = url_filter.learn(table, [("org/", "block")])
    assert {r["verdict"] for r in url_filter.judge_urls(table, [("org/", "block")], blocked, ["page_id"]).collect()} == {"block"}


def test_sample_is_bounded_and_fixed(spark):
    rows = spark.range(6_000).select(F.concat(F.lit("http://x.org/"), F.col("id") % 3_000).alias("_url"), F.lit(0).alias("_blocked"))
    first = url_filter.sample_labelled(rows, 100).collect()
    assert len(first) == 100 == len(set(first))
    assert sorted(first) == sorted(url_filter.sample_labelled(rows.repartition(7), 100).collect())


def test_plan_is_native(spark):
    text = io.StringIO()
    with redirect_stdout(text):
        QUERIES["op11_url_trees"](spark, FOLDER).explain("formatted")
    assert "Python" not in text.getvalue() and "Pandas" not in text.getvalue() and "html" not in text.getvalue()
