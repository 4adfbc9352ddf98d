from __future__ import annotations

import random
import re

import pytest

from ebbline.llm import urls

RULES = [
    ("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
    ("", "/", "block"), (None, "/", "block"), ("net", None, "block"), ("a.net", "", "allow"), ("org", "/", "allow"),
]
PAGES = [
    "http://x.example.org/es/1?q=/fr/", "https://EXAMPLE.ORG/en/17", "http://example.org/en/2", "http://badexample.org/es/", "http://org", "http://org/",
    "http://a.com/fr/x#y", "http://com/de/", "http://com.com/de", "https://x.a.net", "ftp://b.net?x", "http://.org/", "http://org./", "no scheme", "", None,
    "://", "a://b://c.org/", "http://user@h.org:80/p", "http://a.com/FR/", "http://é.org/ü?", "http://a.com\n/fr/", "http://x..org/",
]


def slow(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = ("", "") if not m else (re.sub("[A-Z]", lambda x: x[0].lower(), m[2]), m[3])
    fits = [(h.lower(), p or "", v) for h, p, v in RULES if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p or "")]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.fixture
def rules(spark):
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def test_verdicts_match_brute_force(spark, rules):
    rng = random.Random(2)
    made = [f"http://{rng.choice(['a.', 'b.a.', ''])}{rng.choice(['example.org', 'a.net', 'com'])}/{rng.choice(['es', 'en', 'fr', 'de'])}/{rng.choice('12')}" for _ in range(50)]
    rows = [(i, u, "h", "r") for i, u in enumerate([*PAGES, *made])] + [(None, PAGES[0], "h", "r"), (0, PAGES[0], "h", "r")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule string"), rules).collect()
    assert sorted(((r.page.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == sorted(((i, *slow(u)) for i, u, *_ in rows), key=repr)


def test_without_rules_or_pages(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r)[1:] for r in urls.judge(pages, rules.limit(0)).collect()] == [("a.org", "/", None, "allow")]
    assert urls.judge(pages.limit(0), rules).collect() == []
