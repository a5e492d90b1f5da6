from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leaseload.llm import collocations
from tests.llm.conftest import CLASHING, LONG

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, top=collocations.TOP, min_count=10):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        covered = {p[i : i + 2] for p, a in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * a >= 50 * f[p[i : i + 2]]}
        scores = []
        for p, a in candidates.items():
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in covered:
                scores.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scores)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found_in(docs, **options):
    made = collocations.collocations(docs, **options).drop("example")
    return sorted(tuple(r) for r in made.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed=3, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["ñandú", "X", "x", "#", "\\"]
    phrases = ["New York City", "machine learning", "new york", "à la carte", "one two three"]
    rows = []
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.2 else rng.choice(words) + rng.choice(["", "", ".", ",\t", "\n", "\x0b"]) for _ in range(60)]
        rows.append((i, rng.choice([" ", "  ", "\t"]).join(parts), rng.choice(["en", "de", None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", 0) for i, t, lang in rows], SCHEMA).repartition(5)


def test_equals_plain_counts(spark):
    rows = corpus()
    assert found_in(frame(spark, rows)) == plain(rows)


def test_top_and_ties(spark):
    # All phrases alike: the order of the texts decides.
    rows = [(i, ". ".join(f"a{k} b{k}" for k in range(50)), "en") for i in range(12)]
    found = found_in(frame(spark, rows), top=7)
    assert found == plain(rows, top=7) and len(found) == 7


def test_odd_rows(spark):
    rows = [(None, "a b c " * 40, None), (1, None, "en"), (2, "", "en"), (2, LONG, "fr"), (2, LONG, "fr"), (3, " \t\n.,", "en")]
    docs = frame(spark, rows)
    for name in (*CLASHING.split(), "phrase", "n", "k", "rank", "lane", "example"):
        docs = docs.withColumn(name, F.lit("x"))
    assert found_in(docs) == plain(rows)


def test_empty_table(spark):
    assert found_in(frame(spark, [(1, "a b", "en")]).filter("false")) == []
    assert found_in(frame(spark, [(1, "a b", "en")])) == []


def test_an_example_holds_the_phrase(spark):
    rows = corpus()
    texts = {i: re.sub("[ \t]+", " ", t.translate(LOWER)) for i, t, _ in rows}
    for r in collocations.collocations(frame(spark, rows)).collect():
        assert r.phrase in texts[r.example]


def test_long_texts_lose_no_phrase_between_batches():
    text = "alpha beta gamma. " * 3000 + "delta"
    rows = pa.RecordBatch.from_pydict({"doc_id": [1], "lang": ["en"], "text": [text]})
    batches = [b for _, b in collocations.batches_of(iter([rows]), limit=1000)]
    assert len(batches) > 10
    for k, n in ((1, 9001), (2, 6000), (3, 3000)):
        assert sum(len(b.fingerprints(k)[0]) for b in batches) == n


def test_fingerprints_stand_for_the_words_alone():
    rng = np.random.default_rng(1)
    words = [b"%d" % i for i in rng.integers(0, 30, 4000)]
    batch = collocations.Batch([b" ".join([*words, b"."])], [0])
    for k in (1, 2, 3, 4):
        at, fps = batch.fingerprints(k)
        pairs = {(tuple(words[p : p + k]), int(f)) for p, f in zip(at, fps)}
        assert len({w for w, _ in pairs}) == len(pairs) == len({f for _, f in pairs})
        assert len(np.unique(batch.exact(at, k))) == len(pairs)
        assert batch.phrases(at[:9], k).to_pylist() == [b" ".join(words[p : p + k]).decode() for p in at[:9]]


def test_colliding_fingerprints_cost_nothing(spark, monkeypatch):
    """Phrases are counted by their text: with a bitmap that lets all pass, counts are the same."""
    rows = corpus(5, 60)
    docs = frame(spark, rows)
    full = docs.sparkSession.sparkContext.broadcast(np.full(32, -1, np.int64).tobytes())
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    all_phrases = collocations.verified(texts, {k: full for k in (1, 2, 3)})
    exact, _ = collocations.frequent_phrases(docs)
    assert sorted(map(tuple, all_phrases.filter("n >= 10 AND k > 0").collect())) == sorted(map(tuple, exact.collect()))


@pytest.mark.parametrize("a, left, right", [(10, 10, 10), (3_000_000_000, 4_000_000_000, 5_000_000_000), (10**14, 10**15 - 1, 10**14 + 7)])
def test_scores_are_exact(spark, a, left, right):
    rows = [("en", 1, "x", left, 0), ("en", 1, "y", right, 0), ("en", 2, "x y", a, 0)]
    phrases = spark.createDataFrame(rows, "lang string, k int, phrase string, n long, example long")
    assert collocations.scored(phrases).first().score == 1_000_000 * a * a // (left * right)


def test_hot_word_of_candidates_is_spread(spark):
    """Candidates that begin with one word are dealt over lanes."""
    rows = [("en", 1, "the", 9000, 0)] + [("en", 1, f"w{i}", 20, 0) for i in range(900)] + [("en", 2, f"the w{i}", 10, 0) for i in range(900)]
    phrases = spark.createDataFrame(rows, "lang string, k int, phrase string, n long, example long")
    found = collocations.scored(phrases).collect()
    assert len(found) == 900 and {(r.l, r.r) for r in found} == {(9000, 20)}
