from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leaseload.llm import quality_rules
from tests.llm.conftest import CLASHING, LONG

WHITE = " \t\n\r\x0b\x0c"


def plain_signals(text):
    text = text or ""
    words = [w for w in text.translate({ord(c): " " for c in WHITE}).split(" ") if w]
    lines = [x for x in text.split("\n") if any(c not in WHITE for c in x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
    )


@pytest.mark.parametrize(
    "text",
    ["", None, "a", "a b c d e", "a b c d e f a b c d e", "x " * 30, "é |x y\n \né |x y\n#", "a b c d a b c d a b c d"],
)
def test_signals(text):
    assert quality_rules.signals_of(text)[:5] == plain_signals(text)


def test_signals_on_random_words():
    rng = np.random.default_rng(1)
    for _ in range(100):
        text = " ".join(rng.choice(list("abc"), rng.integers(0, 60)))
        assert quality_rules.signals_of(text)[:5] == plain_signals(text)


def corpus(spark):
    """Groups of plain texts, each with a few texts full of symbols."""
    rows = []
    for n in range(900):
        words = [f"w{(n * 7 + k * k) % 211}" for k in range(40)]
        if n % 50 == 0:
            words = [w + "###" for w in words]
        rows.append((n, " ".join(words), ["en", None][n % 2], ["big", "big", None, f"s{n % 9}"][n % 4], 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_junk_fails_and_plain_stays(spark):
    judged = quality_rules.judged(corpus(spark).repartition(5)).collect()
    assert {r.doc_id for r in judged if not r.kept} == {n for n in range(900) if n % 50 == 0}
    assert all("symbol_share" in r.failed for r in judged if not r.kept)


def test_limits_follow_the_group(spark):
    """Two sources with other habits get other limits, and repeats act below the base rule's cutoff."""
    rng = np.random.default_rng(5)
    rows = []
    for n in range(1200):
        tagged = n % 2 == 0
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        # One source puts a number sign before up to a tenth of its words, the other never does.
        if tagged:
            words = ["#" + w if rng.random() < 0.1 else w for w in words]
        if n in (3, 4):
            words = [w + ("#" if k % 12 == 0 else "") for k, w in enumerate(words)]
        if n in (7, 8):
            words[100:115] = words[:15]
            words[200:215] = words[:15]
        rows.append((n, " ".join(words), "en", "tags" if tagged else "plain", 0))
    judged = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")).collect()}
    assert judged[3].failed == ["symbol_share"] and judged[4].failed == []
    for n in (7, 8):
        assert not judged[n].base_failed and judged[n].failed == ["repeat_share"]
    assert sum(not r.kept for r in judged.values()) == 3


def test_sketch_merges_and_bounds_the_quantiles(spark):
    rng = np.random.default_rng(2)
    values = rng.lognormal(0, 1, 4000)
    rows = spark.createDataFrame(
        [(f"l{i % 2}", f"s{i % 5}", float(v)) for i, v in enumerate(values)], "lang string, source string, v double"
    )
    sketch = quality_rules.sketches(rows, F.create_map(F.lit("x"), F.col("v")))
    one = quality_rules.quantiles(sketch, []).collect()[0]
    assert one.size == 4000
    for got, q in ((one.median, 0.5), (one.high, quality_rules.HIGH)):
        exact = np.quantile(values, q, method="inverted_cdf")
        assert abs(got / exact - 1) <= quality_rules.GAMMA - 1
    halves = {r.lang: r.high for r in quality_rules.quantiles(sketch, ["lang"]).collect()}
    for half in (0, 1):
        exact = np.quantile(values[half::2], quality_rules.HIGH, method="inverted_cdf")
        assert abs(halves[f"l{half}"] / exact - 1) <= quality_rules.GAMMA - 1


def test_odd_rows_and_columns(documents):
    good = " ".join(f"plain{n}" for n in range(30))
    docs = documents(good, good, None, "", "two words", (None, good), LONG, (3, good), extra=CLASHING)
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([0, 1, None, 3], key=repr)
    judged = {(r.doc_id, r.n_words): r.base_failed for r in quality_rules.judged(docs).collect()}
    assert judged[2, 0] and judged[4, 2] and judged[6, 120_000] and not judged[0, 30]


def test_empty_table(documents):
    docs = documents("x").filter("false")
    assert quality_rules.judged(docs).count() == 0
    assert quality_rules.kept_documents(docs).count() == 0
