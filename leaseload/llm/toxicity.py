"""Toxicity by a subsequence string kernel machine with Nystrom landmarks.

The kernel of two words compares all their subsequences of three letters, each
occurrence weighted by ``DECAY`` to the length it spans, so letters put in between or
left apart lower the weight and do not hide the word; both sides are scaled to unit
length, counting each occurrence. A letter run spelled out with spaces counts as one word. Spans beyond
``SPAN`` letters weigh next to nothing and are left out.

A word marks toxic documents if so many of them hold it that chance would do it for
none of all words tested (hypergeometric tail over documents, equal texts counted once,
at ``DOUBT`` for all words together). Training sentences carry labels: those of clean
documents are clean; in a toxic document, the sentences with a marking word are toxic,
and the others say nothing. Landmarks are marking words and common clean words; a word's
features are its kernels with the landmarks, whitened by their own kernel matrix
(Nystrom), and a linear support vector machine is trained on them by sentences, in rounds
that take up each sentence's worst word anew. A linear function of kernels with fixed
landmarks is one weight per letter triple, so scoring a word needs no landmark any more
and costs one lookup per subsequence.

A document is judged by its worst word, its worst sentence (the sum of what speaks for
toxicity in it), the sum over all of it and the share of such words: one clear insult is
enough, and so are many words that each say little. A logistic curve over these is fitted
to the documents' labels.

Fitting uses a bounded sample of labelled rows (``ROWS_PER_CLASS``), each with its whole
text; every whole text is scored. Null and empty texts score as a text without marked
words. Repeated rows score alike; extra columns are not looked at; an empty table gives
no row. With labels of one kind only, or none, every score is that kind's share (0.5 if
none); where no word marks anything, every score is the share of toxic documents.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.llm.training import fold, labelled_sample

ROWS_PER_CLASS = 1_500
LANDMARKS = 256
DECAY = 0.6
SPAN = 8
ROUNDS = 4
# Marking words that are also learned with characters put in.
SPOILT = 100
# Worst clean words taken up in a round.
HARD_WORDS = 4_000
# Letters: gap, a-z, word edge, other letters by code point.
OTHER_LETTERS = 20
LETTERS = 1 + 26 + 1 + OTHER_LETTERS
EDGE = 27
LONGEST = 28
REMEMBERED = 500_000
# A word in fewer documents is not tested.
MIN_DOCS = 3
# Chance that any word at all is taken for a marking one without being one.
DOUBT = 0.01
# Words scored at a time.
BLOCK = 8_192

_SPELLED = re.compile(r"\s(\S(?:\s+\S){2,})(?=\s)")


def units(text: str) -> list[str]:
    """Words of a text in lower case and order, then its spelled-out letter runs as words."""
    lowered = text.lower()
    return lowered.split() + ["".join(run.split()) for run in _SPELLED.findall(f" {lowered} ")]


def sentence_starts(words: list[str]) -> np.ndarray:
    """Places where sentences begin: a word that ends in a mark ends its sentence."""
    return np.array([0, *[i for i, w in enumerate(words[:-1], 1) if w[-1] in ".!?"]])


def log_tails(toxic_with: np.ndarray, all_with: np.ndarray, toxic: int, everything: int) -> np.ndarray:
    """Logarithm of the chance that so many or more of the documents with a word are toxic."""
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, everything + 1)))])

    def choose(n: int, k: np.ndarray | int) -> np.ndarray:
        return logs[n] - logs[k] - logs[n - k]

    known: dict[tuple[int, int], float] = {}
    out = np.empty(len(all_with))
    for i, (k, n) in enumerate(zip(toxic_with.tolist(), all_with.tolist())):
        if (k, n) not in known:
            j = np.arange(max(k, n - (everything - toxic)), min(n, toxic) + 1)
            terms = choose(toxic, j) + choose(everything - toxic, n - j) - choose(everything, n)
            most = terms.max(initial=-np.inf)
            known[k, n] = float(most + np.log(np.exp(terms - most).sum())) if len(j) else 0.0
        out[i] = known[k, n]
    return out


def spread(marking: list[str], documents: list[list[list[str]]], toxic: np.ndarray, times: int = 4) -> list[str]:
    """Marking words, those first that lie in toxic documents with few words before them:
    a kind of insult with few documents is not crowded out by one with many."""
    found: dict[str, list[int]] = {w: [] for w in marking}
    for n, (sentences, y) in enumerate(zip(documents, toxic)):
        if y:
            for w in {w for s in sentences for w in s} & found.keys():
                found[w].append(n)
    covered = np.zeros(len(documents), np.int64)
    early, late = [], []
    for w in marking:
        new = (covered[found[w]] < times).any()
        (early if new else late).append(w)
        if new:
            covered[found[w]] += 1
    return early + late


def evidence(scores: np.ndarray, starts: np.ndarray) -> tuple[float, float, float, float]:
    """What word scores say of a document: worst word, worst sentence, sum, share."""
    if not len(scores):
        return NO_WORD, 0.0, 0.0, 0.0
    positive = np.maximum(scores, 0.0)
    total = positive.sum()
    worst_sentence = np.add.reduceat(positive, starts).max() if total else 0.0
    return float(scores.max()), float(np.log1p(worst_sentence)), float(np.log1p(total)), float(np.mean(scores > 0))


def letter_codes(words: list[str]) -> np.ndarray:
    """One row of letter codes per piece of a word; 0 marks other characters and the end."""
    cut = [word[:LONGEST] for word in words]
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    codes = np.zeros((len(cut), int(lengths.max(initial=0)) + 2), np.int32)
    points = np.frombuffer("".join(cut).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(cut)), lengths)
    place = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    other = np.where(points >= 0xC0, EDGE + 1 + points % OTHER_LETTERS, 0)
    codes[row, place + 1] = np.where((points >= 97) & (points <= 122), points - 96, other)
    codes[:, 0] = EDGE
    codes[np.arange(len(cut)), lengths + 1] = EDGE
    return codes


def pieces(word: str) -> list[str]:
    """A long word in overlapping pieces, so that all of it is compared."""
    if len(word) <= LONGEST:
        return [word]
    half = LONGEST // 2
    return [word[i : i + LONGEST] for i in range(0, len(word) - half, half)]


def triples(codes: np.ndarray):
    """Subsequences by their two steps: (number of the letter triple, weight), 0 for none."""
    width = codes.shape[1]
    for b in range(2, SPAN + 1):
        if b >= width:
            break
        first, last = codes[:, : width - b], codes[:, b:]
        for a in range(1, b):
            middle = codes[:, a : a + width - b]
            there = (first > 0) & (middle > 0) & (last > 0)
            yield ((first * LETTERS + middle) * LETTERS + last) * there, there, DECAY ** (b + 1)


def scored_by(weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Sum of triple weights over the subsequences of each word, scaled to unit length."""
    scores = [np.empty(0)]
    for begin in range(0, len(words), BLOCK):
        codes = letter_codes(words[begin : begin + BLOCK])
        total, squares = np.zeros(len(codes), np.float32), np.zeros(len(codes), np.float32)
        for number, there, weight in triples(codes):
            total += np.float32(weight) * weights[number].sum(1)
            squares += np.float32(weight**2) * there.sum(1)
        scores.append(total / np.sqrt(np.maximum(squares, 1e-9)))
    return np.concatenate(scores).astype(np.float64)


def kernel_map(words: list[str]) -> np.ndarray:
    """Triple weights of a few words, one row each, scaled to unit length."""
    rows = np.zeros((len(words), LETTERS**3), np.float32)
    squares = np.zeros(len(words))
    at = np.arange(len(words))[:, None]
    for number, there, weight in triples(letter_codes(words)):
        np.add.at(rows, (np.broadcast_to(at, number.shape), number), weight * there)
        squares += weight**2 * there.sum(1)
    return rows / np.sqrt(np.maximum(squares, 1e-9))[:, None].astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    # Of the logistic curve over a document's evidence.
    slopes: np.ndarray
    shift: float

    def words(self, words: list[str]) -> np.ndarray:
        split = [pieces(w) for w in words]
        flat = scored_by(self.weights, [p for ps in split for p in ps]) - self.bias
        if len(flat) == len(words):
            return flat
        starts = np.cumsum([0, *map(len, split)])[:-1]
        return np.maximum.reduceat(flat, starts)

    def probability(self, evidences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.atleast_2d(evidences) @ self.slopes + self.shift, -30, 30)))


# The score of a text without any word.
NO_WORD = -3.0


def fit(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Model:
    """Train on whole documents' labels carried down to sentences."""
    flat = Model(np.zeros(LETTERS**3, np.float32), 0.0, np.zeros(4), 0.0)
    share = float(np.mean(toxic)) if len(toxic) else 0.5
    if not 0 < share < 1:
        flat.shift = 30.0 * (2 * share - 1)
        return flat
    documents = []
    for t in texts:
        own = units(t)
        documents.append([list(map(str, part)) for part in np.split(np.array(own, object), sentence_starts(own)[1:])] if own else [])
    # Equal texts are one document here.
    in_toxic, in_clean, seen = Counter(), Counter(), set()
    n_toxic = n_clean = 0
    for t, sentences, y in zip(texts, documents, toxic):
        if (t, int(y)) in seen:
            continue
        seen.add((t, int(y)))
        (in_toxic if y else in_clean).update({w for s in sentences for w in s})
        n_toxic, n_clean = n_toxic + int(y), n_clean + 1 - int(y)
    tested = sorted(w for w in in_toxic if len(w) > 2 and in_toxic[w] + in_clean[w] >= MIN_DOCS)
    of_toxic = np.array([in_toxic[w] for w in tested], np.int64)
    of_all = np.array([in_toxic[w] + in_clean[w] for w in tested], np.int64)
    tails = log_tails(of_toxic, of_all, n_toxic, n_toxic + n_clean)
    limit = np.log(DOUBT / max(1, len(tested)))
    marking = [tested[i] for i in np.argsort(tails, kind="stable").tolist() if tails[i] < limit]
    marks = set(marking)
    clean_words = sorted(w for w in in_clean if w not in marks)
    if not marking or not clean_words:
        flat.shift = float(np.log(share / (1 - share)))
        return flat

    common = sorted(clean_words, key=lambda w: (-in_clean[w], w))[: LANDMARKS // 3]
    landmarks = [*spread(marking, documents, toxic)[: LANDMARKS - len(common)], *common]
    rows = kernel_map([p for w in landmarks for p in pieces(w)])
    values, vectors = np.linalg.eigh((rows @ rows.T).astype(np.float64))
    kept = values > 1e-4 * values[-1]
    # Nystrom features as weights of the letter triples that landmarks have; all others
    # share the last row, of zeros.
    used = np.flatnonzero(rows.any(0))
    by_triple = np.zeros((len(used) + 1, int(kept.sum())), np.float32)
    by_triple[:-1] = rows[:, used].T @ (vectors[:, kept] / np.sqrt(values[kept])).astype(np.float32)
    place = np.full(LETTERS**3, len(used), np.int32)
    place[used] = np.arange(len(used))
    del rows

    # Sentences as lists of word numbers.
    words = sorted({p for ss in documents for s in ss for w in s for p in pieces(w)})
    number = {w: i for i, w in enumerate(words)}
    toxic_sentences, clean_sentences = [], []
    for sentences, y in zip(documents, toxic):
        for s in sentences:
            if not s:
                continue
            ids = np.array([number[p] for w in s for p in pieces(w)])
            if y and not marks.isdisjoint(s):
                toxic_sentences.append(ids)
            elif not y:
                clean_sentences.append(ids)

    def worst(sentences: list[np.ndarray], score: np.ndarray) -> np.ndarray:
        joined = np.concatenate(sentences)
        starts = np.cumsum([0, *map(len, sentences)])[:-1]
        best = np.maximum.reduceat(score[joined], starts)
        length = np.diff(np.append(starts, len(joined)))
        hit = score[joined] == np.repeat(best, length)
        first = np.full(len(sentences), len(joined))
        np.minimum.at(first, np.repeat(np.arange(len(sentences)), length)[hit], np.flatnonzero(hit))
        return joined[first]

    marked = np.zeros(len(words))
    marked[[number[p] for w in marking for p in pieces(w)]] = 1.0

    def features(of_words: list[str]) -> np.ndarray:
        """Nystrom features of words, in their order."""
        out = np.zeros((len(of_words), by_triple.shape[1]), np.float32)
        squares = np.zeros(len(of_words), np.float32)
        for of_triple, there, w in triples(letter_codes(of_words)):
            at = place[of_triple]
            squares += np.float32(w * w) * there.sum(1)
            for column in range(at.shape[1]):
                has = np.flatnonzero(at[:, column] < len(used))
                out[has] += np.float32(w) * by_triple[at[has, column]]
        return out / np.sqrt(np.maximum(squares, 1e-9))[:, None]

    # The best marking words again, with marks between their letters or inside.
    spoilt = [x for w in marking[:SPOILT] for x in (".".join(w), w[: len(w) // 2] + "*" + w[len(w) // 2 :], w[:2] + "-" + w[2:])]
    spoilt = [p for w in spoilt for p in pieces(w)]
    spoilt_features = features(spoilt)
    score = marked
    rng = np.random.default_rng(seed)
    hard: list[np.ndarray] = []
    for _ in range(ROUNDS):
        positive, times = np.unique(worst(toxic_sentences, np.where(marked > 0, score, -np.inf)), return_counts=True)
        clean = np.unique(worst(clean_sentences, score if hard else rng.random(len(words))))
        clean = clean[marked[clean] == 0]
        hard.append(clean[np.argsort(-score[clean], kind="stable")][:HARD_WORDS])
        negative = np.unique(np.concatenate(hard))
        # A rare kind of insult keeps some say beside a frequent one.
        times = np.sqrt(times)
        x = np.concatenate([spoilt_features, features([words[i] for i in (*positive, *negative)])])
        y = np.ones(len(x))
        y[len(x) - len(negative) :] = -1
        each = np.concatenate(
            [
                np.full(len(spoilt), 0.25 / len(spoilt)),
                0.25 * times / times.sum(),
                np.full(len(negative), 0.5 / max(1, len(negative))),
            ]
        )
        weight, bias = _svm(x.astype(np.float64), y, each)
        triple_weights = np.append(by_triple[:-1] @ weight, 0)[place].astype(np.float32)
        score = scored_by(triple_weights, words) - bias
    model = Model(triple_weights, float(bias), np.zeros(4), 0.0)
    known: dict[str, float] = {}
    model.slopes, model.shift = _calibrated(np.array([judged(model, units(t), known) for t in texts]), toxic)
    return model


def _svm(x: np.ndarray, y: np.ndarray, each: np.ndarray, penalty: float = 1e-5, steps: int = 250) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by accelerated descent."""
    whole = np.hstack([x, -np.ones((len(x), 1))])
    step = 1 / (2 * np.linalg.norm(whole * np.sqrt(each)[:, None], 2) ** 2 + penalty)
    w, ahead, t = np.zeros(whole.shape[1]), np.zeros(whole.shape[1]), 1.0
    for _ in range(steps):
        short = np.maximum(0, 1 - y * (whole @ ahead))
        slope = -2 * (whole.T @ (each * y * short)) + penalty * ahead
        new = ahead - step * slope
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1], float(w[-1])


def _calibrated(x: np.ndarray, toxic: np.ndarray, steps: int = 50) -> tuple[np.ndarray, float]:
    """Slopes (none below zero) and shift of a logistic curve over evidence, by Newton's method."""
    centre, scale = x.mean(0), x.std(0) + 1e-6
    used = list(range(x.shape[1]))
    while used:
        whole = np.hstack([(x[:, used] - centre[used]) / scale[used], np.ones((len(x), 1))])
        w = np.zeros(len(used) + 1)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(whole @ w, -30, 30)))
            curve = (whole.T * (p * (1 - p) + 1e-6)) @ whole + 1e-1 * np.eye(len(w))
            w -= np.linalg.solve(curve, whole.T @ (p - toxic) + 1e-1 * w * (np.arange(len(w)) < len(used)))
        if w[:-1].min() >= 0:
            break
        # More evidence never speaks against toxicity: what would is left out.
        del used[int(np.argmin(w[:-1]))]
    slopes = np.zeros(x.shape[1])
    if not used:
        share = float(np.mean(toxic))
        return slopes, float(np.log(share / (1 - share)))
    slopes[used] = w[:-1] / scale[used]
    return slopes, float(w[-1] - slopes @ centre)


def judged(model: Model, words: list[str], known: dict[str, float]) -> tuple[float, float, float, float]:
    """Evidence of a document's words; ``known`` remembers word scores up to a bound."""
    learn(model, set(words), known)
    scores = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
    return evidence(scores, sentence_starts(words))


def learn(model: Model, words: set[str], known: dict[str, float]) -> None:
    """Score the words that are not known yet."""
    new = [w for w in words if w not in known]
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = list(words)
    for begin in range(0, len(new), 20_000):
        part = new[begin : begin + 20_000]
        known.update(zip(part, model.words(part).tolist()))


def scored(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the held-out fold is never fitted."""
    held_out = fold("doc_id", folds) == held_out_fold
    sample = labelled_sample(docs, labels, "toxic", ~held_out, ROWS_PER_CLASS)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample["text"].tolist(), sample["y"].to_numpy()))
    known: dict[str, float] = {}

    def over(texts: pd.Series) -> pd.Series:
        held = model.value
        words = [units(t or "") for t in texts]
        learn(held, set().union(*words), known)
        found = [evidence(np.fromiter(map(known.__getitem__, ws), np.float64, len(ws)), sentence_starts(ws)) for ws in words]
        return pd.Series(held.probability(np.array(found)) if found else np.empty(0))

    over.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    score = F.pandas_udf(over, "double")("text")
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
