from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from leaseload.llm import url_filter
from leaseload.llm.queries import URL_RULES
from tests.llm.conftest import CLASHING

SCHEMA = "page_id bigint, url string, html string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def plain_rule(host, path, rules=URL_RULES):
    fits = []
    for verdict, rule in rules:
        own, slash, beginning = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + beginning):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://a.example.org/en/1", "https://A.Example.ORG/es/x?y=http://z", "http://example.org/es", "http://org/x", "http://notorg/x",
    "http://b.com/fr/1#top", "http://b.com/de/", "http://b.com/de", "http://b.com", "http://b.net/de/1", None, "", "no scheme", "://", "://x",
    "http://?q", "http://b.com:80/de/1", "http://ÉA.com/fr/", "http://x.org?/en/", "ftp://x.org#a/b", "http://x.example.org/en/12/3",
]


def test_parts_and_rules(spark):
    rows = [(n, url, "") for n, url in enumerate(URLS)]
    found = url_filter.judged(spark.createDataFrame(rows, SCHEMA).repartition(3), URL_RULES).collect()
    assert len(found) == len(URLS)
    for r in found:
        host, path = plain_parts(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        rule, verdict = plain_rule(host, path)
        assert r.rule == rule and (verdict is None or r.verdict == verdict)
    assert urlsplit("http://A.b/c").hostname == plain_parts("http://A.b/c")[0]


def test_longest_rule_on_random_hosts():
    rng = random.Random(2)
    names = ["a", "b", "a.b", "b.a.b", "ab"]
    for _ in range(300):
        rules = tuple((rng.choice(["allow", "block"]), rng.choice(names) + rng.choice(["", "/", "/x", "/x/y"])) for _ in range(6))
        rules = tuple({r: (v, r) for v, r in rules}.values())
        host, path = ".".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))), rng.choice(["", "/", "/x", "/x/y/z"])
        rule, verdict = url_filter.Rules(rules).fitting(host, path)
        expected = plain_rule(host, path, rules)
        assert (rule is None) == (expected[0] is None) and (rule is None or len(rule) == len(expected[0]))
        assert rule is None or (verdict, rule) in rules


def test_viterbi_is_the_best_of_all_splits():
    rng = random.Random(3)
    for _ in range(200):
        shares = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))): math.log(rng.random()) for _ in range(8)}
        name, unknown = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))), -3.0

        def value(words):
            return sum(shares.get(w, unknown - len(w) * math.log(10)) for w in words)

        splits = []
        for cuts in itertools.product([0, 1], repeat=len(name) - 1):
            words, begin = [], 0
            for i, cut in enumerate(cuts, 1):
                if cut:
                    words.append(name[begin:i])
                    begin = i
            splits.append([*words, name[begin:]])
        best = url_filter.split_name(name, shares, unknown)
        assert "".join(best) == name
        assert value(best) == pytest.approx(max(map(value, splits)))


def pages(spark, extra=()):
    """Clean hosts of two words, unwanted ones that hold a listed word, and text with both words."""
    rng = random.Random(4)
    clean = ["garden", "kitchen", "river", "stone", "paper", "silver", "forest", "window"]
    bad = ["casino", "poker", "lucky", "royal"]
    rows = []
    for n in range(600):
        if n % 10 == 0:
            name = rng.choice(["casino", "poker"]) + rng.choice(["lucky", "royal"])
        else:
            name = rng.choice(clean) + rng.choice(clean)
        text = " ".join(rng.choice(clean + bad) for _ in range(30))
        rows.append((n, f"http://www.{name}.net/{rng.choice(['news', 'en'])}/{n}", f"<html><p>{text}</p></html>"))
    return spark.createDataFrame([*rows, *extra], SCHEMA).repartition(4)


def test_names_are_split_and_unwanted_ones_blocked(spark):
    # A host without any listed word, whose words go with listed ones.
    extra = [(1000, "http://luckyroyal.net/en/1", ""), (1001, "http://gardenriver.net/en/1", "")]
    found = {r.page_id: r for r in url_filter.judged(pages(spark, extra), URL_RULES).collect()}
    assert found[1000].words == ["lucky", "royal", "net"] and found[1000].verdict == "block"
    assert found[1001].words == ["garden", "river", "net"] and found[1001].verdict == "allow"
    for n in range(600):
        assert found[n].verdict == ("block" if n % 10 == 0 else "allow"), found[n]


def test_equals_a_plain_model(spark):
    """Split and scores against a model in plain Python from the same definition."""
    docs = pages(spark)
    rows = docs.collect()
    counts = Counter(w for r in rows for w in re.findall("[a-z]{1,20}", re.sub("<[^<>]*>", " ", r.html)))
    counts.update(url_filter.BLOCKED_WORDS)
    total = sum(counts.values())

    def words(host):
        *labels, last = host.split(".")
        shares = {w: math.log(n / total) for w, n in counts.items()}
        return [w for x in labels for w in url_filter.split_name(x, shares, math.log(10 / total))] + [last]

    split = {plain_parts(r.url)[0]: words(plain_parts(r.url)[0]) for r in rows}
    blocked = {h: bool(set(ws) & set(url_filter.BLOCKED_WORDS)) for h, ws in split.items()}
    seen = {(kind, y): Counter() for kind in "hp" for y in (False, True)}
    for r in rows:
        host, path = plain_parts(r.url)
        seen["h", blocked[host]].update(split[host])
        seen["p", blocked[host]].update(re.sub("[0-9]+", "0", path).strip("/").split("/"))

    def weight(kind, w):
        shares = {y: seen[kind, y][w] / seen[kind, y].total() for y in (False, True)}
        mean = sum(shares.values()) / 2
        smooth = {y: (seen[kind, y][w] + 10 * mean) / (seen[kind, y].total() + 10) for y in shares}
        return math.log(smooth[True]) - math.log(smooth[False])

    prior = math.log((sum(blocked.values()) + 1) / (len(blocked) - sum(blocked.values()) + 1))
    for r in url_filter.judged(docs, URL_RULES).collect():
        odds = min(prior, 0) + sum(weight("h", w) for w in split[r.host])
        odds += sum(weight("p", w) for w in re.sub("[0-9]+", "0", r.path).strip("/").split("/"))
        assert r.words == split[r.host]
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-6)


def test_odd_rows_and_a_hot_host(spark):
    rows = [(n, "http://hot.net/a", "<p>hot</p>") for n in range(500)] + [(None, None, None), (None, "http://hot.net/a", None), (7, "http://" + "x" * 5000 + ".net/", "")]
    rows += [(n, f"http://h{n}.net/{n}", None) for n in range(200)] + [rows[0]] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in (*CLASHING.split(), "host", "path", "words", "n", "lane", "blocked", "verdict", "rule"):
        docs = docs.withColumn(name, F.lit("x"))
    found = url_filter.judged(docs, URL_RULES).collect()
    assert sorted((str(r.page_id) for r in found)) == sorted(str(r[0]) for r in rows)
    assert {r.verdict for r in found} == {"allow"}
    assert [r.words for r in found if len(r.host) > 4000] == [["x" * 5000, "net"]]


def test_empty_table(spark):
    assert url_filter.judged(spark.createDataFrame([], SCHEMA), URL_RULES).count() == 0
