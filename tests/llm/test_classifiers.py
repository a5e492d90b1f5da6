from __future__ import annotations

import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from leaseload.llm import quality_net, toxicity
from leaseload.llm.training import fold
from tests.llm.conftest import CLASHING, LONG

LABELS = "doc_id bigint, quality int, toxic int"
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ti st it to".split()
INSULTS = ("blockhead", "numbskull", "dimwit")


def prose(rng, n):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if rng.random() < 0.1 else "") for w in words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    texts, quality, toxic = [], [], []
    for n in range(400):
        text = prose(rng, rng.randrange(30, 120))
        bad, rude = n % 5 == 0, n % 4 == 0
        if bad:
            text = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in text.split())
        if rude:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
            text = " ".join(words)
        texts.append(text)
        quality.append(int(not bad))
        toxic.append(int(rude))
    return texts, quality, toxic


def test_folds(documents):
    rows = documents((0, "a"), (17, "b"), (-3, "c"), (None, "d")).select("doc_id", fold("doc_id", 5).alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {
        i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 for i in (0, 17, -3, None)
    }


def test_kernel_is_the_weighted_sum_over_subsequences():
    def plain(word):
        codes = toxicity.letter_codes([word])[0]
        found = {}
        for i in range(len(codes)):
            for j in range(i + 1, len(codes)):
                for k in range(j + 1, min(len(codes), i + toxicity.SPAN + 1)):
                    if codes[i] and codes[j] and codes[k]:
                        t = (codes[i] * toxicity.LETTERS + codes[j]) * toxicity.LETTERS + codes[k]
                        found.setdefault(int(t), []).append(toxicity.DECAY ** (k - i + 1))
        size = np.sqrt(sum(w * w for ws in found.values() for w in ws))
        return {t: sum(ws) / size for t, ws in found.items()}

    words = ["idiot", "i-d.iot", "é", "x", "banana", "a1b2c3"]
    rows = toxicity.kernel_map(words)
    for word, row in zip(words, rows):
        expected = plain(word)
        assert set(np.flatnonzero(row)) == set(expected)
        assert np.allclose([row[t] for t in expected], list(expected.values()), atol=1e-5)
    weights = np.random.default_rng(0).normal(size=toxicity.LETTERS**3).astype(np.float32)
    weights[0] = 0  # stands for no subsequence
    assert np.allclose(toxicity.scored_by(weights, words), rows @ weights, atol=1e-4)


def test_toxicity_held_out_and_gapped(spark, documents, corpus):
    texts, quality, toxic = corpus
    docs = documents(*texts, extra=CLASHING)
    labels = spark.createDataFrame([(n, quality[n], toxic[n]) for n in range(400)], LABELS)
    found = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    held = [r for r in found.values() if r.held_out]
    assert len(held) > 40
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.95
    sample = [t for n, t in enumerate(texts) if not found[n].held_out]
    model = toxicity.fit(sample, np.array([toxic[n] for n in range(400) if not found[n].held_out]))
    clean = prose(random.Random(99), 60)

    def probability(text):
        return model.probability(np.array(toxicity.judged(model, toxicity.units(text), {})))[0]

    assert probability(clean) < 0.5
    for insult in ("numbskull", "numb-skull", "numb*skull", "n u m b s k u l l", "numbbskull"):
        assert probability(f"{clean} {insult} {clean}") > 0.5, insult


@pytest.mark.parametrize(("k", "n", "toxic", "everything"), [(4, 4, 36, 262), (6, 8, 36, 262), (0, 5, 10, 40), (10, 30, 10, 40), (3, 3, 3, 3)])
def test_tails_are_those_of_drawing_documents(k, n, toxic, everything):
    ways = sum(math.comb(toxic, j) * math.comb(everything - toxic, n - j) for j in range(k, min(n, toxic) + 1) if n - j <= everything - toxic)
    found = toxicity.log_tails(np.array([k]), np.array([n]), toxic, everything)[0]
    assert found == pytest.approx(math.log(ways / math.comb(everything, n)), abs=1e-9)


def test_no_word_of_few_documents_marks():
    """Copies of a toxic text share rare words, which must not stand for toxicity."""
    rng = random.Random(8)
    texts, toxic = [], []
    for n in range(360):
        rude = n % 6 == 0
        texts.append(prose(rng, 80) + (f" {rng.choice(INSULTS)} odd{n} rare{n}" if rude else ""))
        toxic.append(int(rude))
    texts += [texts[0]] * 5
    toxic += [1] * 5
    model = toxicity.fit(texts, np.array(toxic))
    known = {}

    def probability(text):
        return model.probability(np.array(toxicity.judged(model, toxicity.units(text), known)))[0]

    clean = prose(random.Random(5), 60)
    assert probability(f"{clean} odd0 rare0 {clean}") < 0.5 < probability(f"{clean} dimwit {clean}")


def test_evidence_adds_up_over_a_document():
    scores = np.array([-1.0, 0.5, 0.5, -2.0, 0.25])
    starts = toxicity.sentence_starts(["a", "b", "c.", "d", "e"])
    assert starts.tolist() == [0, 3]
    worst, sentence, total, share = toxicity.evidence(scores, starts)
    assert (worst, share) == (0.5, 0.6)
    assert (sentence, total) == (pytest.approx(np.log1p(1.0)), pytest.approx(np.log1p(1.25)))


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="supplied tables are not here")
@pytest.mark.parametrize(("scale", "least_fit", "least_held"), [("sf0.01", 0.6, 0.6), ("sf0.1", 0.85, 0.85)])
def test_toxic_documents_of_the_supplied_tables(scale, least_fit, least_held):
    """Recall and false alarms at any number of labels; 45 and 449 documents are labelled toxic."""
    import duckdb

    folder = f"/root/testdata/{scale}"
    rows = duckdb.sql(f"SELECT d.doc_id, text, toxic FROM '{folder}/documents.parquet' d JOIN '{folder}/labels.parquet' USING (doc_id) WHERE toxic IS NOT NULL AND text IS NOT NULL ORDER BY 1").fetchall()
    parts = {held: [r for r in rows if (zlib.crc32(str(r[0]).encode()) % 5 == 0) == held] for held in (False, True)}
    few = [r for r in parts[False] if r[2]] + [r for r in parts[False] if not r[2]][: toxicity.ROWS_PER_CLASS]
    model = toxicity.fit([r[1] for r in few], np.array([r[2] for r in few]))
    known = {}
    for held, least in ((False, least_fit), (True, least_held)):
        found = model.probability(np.array([toxicity.judged(model, toxicity.units(r[1]), known) for r in parts[held]])) >= 0.5
        marked = np.array([r[2] for r in parts[held]]) == 1
        assert found[marked].mean() >= least and found[~marked].mean() <= 0.02


def test_quality_held_out(spark, documents, corpus):
    texts, quality, toxic = corpus
    docs = documents(*texts, extra=CLASHING)
    labels = spark.createDataFrame([(n, quality[n], toxic[n]) for n in range(400)], LABELS)
    held = [r for r in quality_net.scored(docs, labels).collect() if r.held_out]
    assert len(held) > 80
    assert np.mean([r.predicted == quality[r.doc_id] for r in held]) > 0.95


def test_gradients_match_differences():
    rng = np.random.default_rng(4)
    net = quality_net.fit(["a"], np.array([1]))
    net.constant = None
    for name in net.order:
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.dense_bias += 0.1  # an empty chunk would stand on the bend of the rectifier
    texts = [bytes(rng.integers(97, 123, n).tolist()) for n in (0, 5, 200, 700)]
    y = np.array([0, 1, 1, 0], np.float32)

    def loss():
        p = quality_net.probabilities(net, texts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    slopes = quality_net.gradients(net, texts, y)
    for name in net.order:
        value, slope = getattr(net, name), slopes[name]
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        old = value[at].copy()
        value[at] = old + 1e-4
        up = loss()
        value[at] = old - 1e-4
        down = loss()
        value[at] = old
        assert abs((up - down) / 2e-4 - slope[at]) < 0.05 * abs(slope[at]) + 1e-3, name


def test_chunks_cover_every_byte_alike():
    net = quality_net.fit(["a"], np.array([1]))
    net.constant = None
    texts = [b"", b"x", b"y" * 192, b"z" * 193, b"ab" * 5000]
    together = quality_net.probabilities(net, texts)
    assert np.allclose(together, [quality_net.probabilities(net, [t])[0] for t in texts], atol=1e-6)
    rows, there, firsts = quality_net.padded(texts)
    assert there.sum() == sum(map(len, texts))
    pairs, chunk_firsts = quality_net.chunk_pairs(firsts, len(rows))
    assert set(pairs.ravel()) == set(range(len(rows))) and len(chunk_firsts) == len(texts)


def test_forward_pass_is_a_plain_convolution():
    """Every place, filter and chunk by loops over the definition."""
    rng = np.random.default_rng(9)
    net = quality_net.fit(["a"], np.array([1]))
    net.constant = None
    net.dense_bias += rng.normal(0, 0.1, net.dense_bias.shape).astype(np.float32)
    half, width = quality_net.HALF, quality_net.WIDTH
    for text in (b"", b"x", bytes(rng.integers(0, 256, half).tolist()), bytes(rng.integers(0, 256, 2 * half + 7).tolist()), b"ab" * 400):
        places = []
        for i in range(len(text)):
            value = net.bias.astype(np.float64).copy()
            for k in range(width):
                j = i - (width - 1) + k
                value += net.filters[k][text[j] if j >= 0 else 0]
            places.append(np.maximum(value, 0))
        halves = max(1, -(-len(text) // half))
        evidence = np.zeros(len(net.dense_bias))
        for first in range(max(1, halves - 1)):
            seen = places[first * half : (first + 2) * half]
            average = np.mean(seen, axis=0) if seen else np.zeros(len(net.bias))
            evidence = np.maximum(evidence, average @ net.dense + net.dense_bias)
        expected = 1 / (1 + np.exp(-(evidence @ net.out + net.out_bias[0])))
        assert quality_net.probabilities(net, [text])[0] == pytest.approx(expected, abs=1e-5)


@pytest.mark.parametrize("scored", [toxicity.scored, quality_net.scored])
def test_odd_rows_and_few_labels(spark, documents, scored):
    docs = documents("good text", None, "", LONG, (None, "no id"), (0, "good text"), extra=CLASHING)
    for labels in ([], [(0, 1, 1)], [(None, 1, None), (0, None, 0), (2, 0, 1), (2, 1, 0)]):
        rows = scored(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(rows) == 6
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert scored(docs.filter("false"), spark.createDataFrame([], LABELS)).count() == 0
    assert scored(docs, spark.createDataFrame([(0, 1, 1)], LABELS)).select(F.count("score")).collect()[0][0] == 6
