import random
import re

import pytest
from pyspark.sql import functions as F

from tillroll.llm import url_filter

RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y", 1.0) for i, u in enumerate(urls)],
                                 "page_id long, url string, URL string, verdict string, features double")


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for line in RULES:
        verdict, name = line.split(" ")
        h, p = name.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(name) > len(best[0])):
            best = (name, verdict)
    return host, path, best


ODD = [None, "", "no scheme", "http://", "://a.org/", "http://A.ORG/x", "http://a.org", "http://a.org?x=1", "http://example.org/en/12", "http://x.example.org/es/",
       "http://notexample.org/es/", "http://a.com/fr/", "http://a.com/FR/", "http://com/de/", "http://a.net://b.org/x", "http://u@a.org:80/p#f", "http://Éa.org/é",
       "http://a.org/\nb", "\nhttp://a.org/x", "http://" + "a." * 20_000 + "com/de/" + "1" * 20_000, "http://org./", "ftp://org/", "http://a.com/de"]


def test_hosts_paths_and_rules(spark):
    got = url_filter.judge(pages(spark, ODD * 2), url_filter.rules(*RULES)).collect()
    assert len(got) == 2 * len(ODD)
    for r in got:
        host, path, best = brute((ODD * 2)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")


def labelled(n=3000, seed=1):
    """Bad urls are long, deep, full of digits and parameters, under some hosts more than others."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bad = rng.random() < 0.4
        host = f"{'x' if bad else 'site'}{rng.randint(1, 30)}.{rng.choice(['farm.example', 'fine.example'] if rng.random() < .8 else ['other.example'])}"
        path = "/".join(str(rng.randint(0, 99999)) if bad and rng.random() < 0.7 else "page" for _ in range(rng.randint(3, 6) if bad else rng.randint(1, 4)))
        out.append((f"https://{host}/{path}" + ("?a=1&b=2&c=3" if bad and rng.random() < 0.6 else ""), int(bad)))
    return out


def test_trees_learn_labelled_urls(spark):
    train, test = labelled(), labelled(800, 2)
    known = spark.createDataFrame(train, "url string, blocked int")
    got = url_filter.judge(pages(spark, [u for u, _ in test]), [url_filter.Rule("allow", "nowhere", "/")], known, sample=2000).collect()
    right = sum((r.verdict == "block") == bool(test[r.page_id][1]) for r in got)
    assert right >= 0.9 * len(test) and all(0 <= r.blocked <= 1 for r in got)


def test_suffix_statistics_are_of_all_labelled_urls(spark):
    """Most suffixes have no row in the sample; their labelled urls still decide."""
    known = spark.createDataFrame([(f"https://a{n}.{c}{i:03d}.net/page", i % 2) for c in "st" for i in range(500) for n in range(10)],
                                  "url string, blocked int")
    asked = [f"https://b1.{c}{i:03d}.net/page" for c in "st" for i in range(500)]
    got = url_filter.judge(pages(spark, asked), [url_filter.Rule("allow", "nowhere", "/")], known, sample=300).collect()
    assert len(got) == 1000 and all((r.verdict == "block") == bool(r.page_id % 2) for r in got)


@pytest.mark.parametrize("rows,verdict", [([], "allow"), ([("http://a/", 1)], "block"), ([("http://a/", 0), (None, None)], "allow")])
def test_without_both_kinds_of_labels(spark, rows, verdict):
    known = spark.createDataFrame(rows, "url string, blocked int")
    got = url_filter.judge(pages(spark, ["http://q.net/", None]), url_filter.rules(*RULES), known).collect()
    assert [r.verdict for r in got] == [verdict] * 2


def test_empty_table(spark):
    assert url_filter.judge(pages(spark, []), url_filter.rules(*RULES)).count() == 0


def test_features(spark):
    url, host, path = F.col("u"), F.lit("a.b"), F.lit("/1/2")
    f = url_filter._features(url, host, path)
    row = spark.createDataFrame([("http://a.b/1/2?x=1&y=2#z",)], "u string").select(*[c.alias(k) for k, c in f.items()]).first()
    assert (row.depth, row.parameters, row.fragment, row.labels) == (2, 2, True, 1) and abs(row.digit_ratio - 4 / 24) < 1e-9
    text = spark.createDataFrame([("aabb",), ("aaaa",), ("",)], "u string").select(url_filter._entropy(F.col("u"))).collect()
    assert [round(r[0], 9) for r in text] == [1.0, 0.0, 0.0]
