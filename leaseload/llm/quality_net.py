"""Quality by a small byte-level convolutional network, trained and run in numpy.

Filters look at ``WIDTH`` bytes in a row; a filter is a table of weights by place and
byte, so applying it is a sum of look-ups. Rectified responses are averaged over
chunks of ``CHUNK`` bytes that overlap by half and together cover the whole document.
A dense layer turns a chunk's averages into evidence, the strongest evidence of all
chunks is kept for each unit, and one logistic unit combines it into a probability.

Fitting uses a bounded sample (``ROWS_PER_CLASS`` labelled rows of each kind); of each
text, up to ``FIT_CHUNKS`` chunks spread evenly over the whole of it teach. Every byte of every text is scored, in
blocks, so a very long text needs no more memory. Null and empty texts are one empty
chunk. With labels of one kind only, or none, every score is that kind's share.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.llm.training import fold, labelled_sample

ROWS_PER_CLASS = 700
FIT_CHUNKS = 6
HALF = 192
CHUNK = 2 * HALF
WIDTH = 4
FILTERS = 16
UNITS = 12
EPOCHS = 14
BATCH = 32
RATE = 0.01
# Half chunks convolved at a time.
BLOCK = 512


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    dense: np.ndarray  # FILTERS x UNITS
    dense_bias: np.ndarray
    out: np.ndarray  # UNITS
    out_bias: np.ndarray
    constant: float | None = None
    order: tuple[str, ...] = field(default=("filters", "bias", "dense", "dense_bias", "out", "out_bias"), repr=False)


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts cut into half chunks: bytes with a lead-in, whether each is there, first rows.

    A half chunk's row starts with the ``WIDTH - 1`` bytes before it, so every run of
    bytes is seen once; before the text stand zeros.
    """
    counts = np.maximum(1, -(-np.fromiter(map(len, texts), np.int64, len(texts)) // HALF))
    firsts = np.cumsum(counts) - counts
    rows = np.zeros((int(counts.sum()), HALF + WIDTH - 1), np.uint8)
    there = np.zeros((len(rows), HALF), bool)
    for text, first, count in zip(texts, firsts.tolist(), counts.tolist()):
        data = np.frombuffer(text, np.uint8)
        body = np.zeros(count * HALF, np.uint8)
        body[: len(data)] = data
        rows[first : first + count, WIDTH - 1 :] = body.reshape(count, HALF)
        rows[first + 1 : first + count, : WIDTH - 1] = body.reshape(count, HALF)[:-1, HALF - WIDTH + 1 :]
        mask = np.zeros(count * HALF, bool)
        mask[: len(data)] = True
        there[first : first + count] = mask.reshape(count, HALF)
    return rows, there, firsts


def responses(net: Network, rows: np.ndarray) -> np.ndarray:
    """Filter responses before rectifying, half chunk by place by filter."""
    total = net.filters[0][rows[:, :HALF]]
    for k in range(1, WIDTH):
        total += net.filters[k][rows[:, k : k + HALF]]
    total += net.bias
    return total


def half_sums(net: Network, rows: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Rectified responses summed over each half chunk."""
    sums = np.zeros((len(rows), FILTERS), net.filters.dtype)
    for begin in range(0, len(rows), BLOCK):
        part = slice(begin, begin + BLOCK)
        got = np.maximum(responses(net, rows[part]), 0)
        got *= there[part, :, None]
        sums[part] = got.sum(1)
    return sums


def chunk_pairs(firsts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunks as pairs of half chunks (a single half: with itself), and their first rows."""
    last = np.append(firsts[1:], total) - 1
    left = np.ones(total, bool)
    left[last[last > firsts]] = False
    left = np.flatnonzero(left)
    single = np.isin(left, firsts[last == firsts])
    return np.stack([left, np.where(single, left, left + 1)], 1), np.searchsorted(left, firsts)


def averages(sums: np.ndarray, there: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    counts = there.sum(1).astype(np.float32)
    return (sums[pairs].sum(1)) / np.maximum(counts[pairs].sum(1), 1)[:, None]


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    rows, there, firsts = padded(texts)
    pairs, chunk_firsts = chunk_pairs(firsts, len(rows))
    chunks = averages(half_sums(net, rows, there), there, pairs)
    evidence = np.maximum.reduceat(np.maximum(chunks @ net.dense + net.dense_bias, 0), chunk_firsts)
    return 1 / (1 + np.exp(-np.clip(evidence @ net.out + net.out_bias, -30, 30)))


def gradients(net: Network, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss."""
    rows, there, firsts = padded(texts)
    pairs, chunk_firsts = chunk_pairs(firsts, len(rows))
    raw = responses(net, rows)
    open_ = (raw > 0) & there[:, :, None]
    sums = (raw * open_).sum(1)
    counts = np.maximum(there.sum(1).astype(np.float32)[pairs].sum(1), 1)[:, None]
    chunks = sums[pairs].sum(1) / counts
    units = chunks @ net.dense + net.dense_bias
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(chunk_firsts, len(chunks))))
    best = np.maximum.reduceat(units, chunk_firsts)
    evidence = np.maximum(best, 0)
    p = 1 / (1 + np.exp(-np.clip(evidence @ net.out + net.out_bias, -30, 30)))
    d_logit = ((p - y) / len(y)).astype(np.float32)
    d_evidence = d_logit[:, None] * net.out * (best > 0)
    d_units = np.where(units == best[owner], d_evidence[owner], 0).astype(np.float32)
    d_chunks = d_units @ net.dense.T / counts
    d_sums = np.zeros_like(sums)
    np.add.at(d_sums, pairs[:, 0], d_chunks)
    np.add.at(d_sums, pairs[:, 1], d_chunks)
    d_raw = open_ * d_sums[:, None, :]
    d_filters = np.zeros_like(net.filters)
    flat = d_raw.reshape(-1, FILTERS)
    for k in range(WIDTH):
        seen = rows[:, k : k + HALF].ravel()
        for f in range(FILTERS):
            d_filters[k, :, f] = np.bincount(seen, flat[:, f], 256)
    return {
        "filters": d_filters,
        "bias": flat.sum(0),
        "dense": chunks.T @ d_units,
        "dense_bias": d_units.sum(0),
        "out": evidence.T @ d_logit,
        "out_bias": d_logit.sum(keepdims=True),
    }


def excerpt(text: bytes) -> bytes:
    """At most ``FIT_CHUNKS`` chunks of a text, spread evenly over it."""
    if len(text) <= FIT_CHUNKS * CHUNK:
        return text
    starts = np.linspace(0, len(text) - CHUNK, FIT_CHUNKS).astype(int)
    return b"".join(text[s : s + CHUNK] for s in starts)


def fit(texts: list[str], good: np.ndarray, seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(
        filters=rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        bias=np.zeros(FILTERS, np.float32),
        dense=rng.normal(0, 0.5, (FILTERS, UNITS)).astype(np.float32),
        dense_bias=np.zeros(UNITS, np.float32),
        out=rng.normal(0, 0.5, UNITS).astype(np.float32),
        out_bias=np.zeros(1, np.float32),
    )
    share = float(np.mean(good)) if len(good) else 0.5
    if not 0 < share < 1:
        net.constant = share
        return net
    data = [excerpt(t.encode("utf-8", "surrogatepass")) for t in texts]
    mean = {name: np.zeros_like(getattr(net, name)) for name in net.order}
    square = {name: np.zeros_like(getattr(net, name)) for name in net.order}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(data))
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for begin in range(0, len(order), BATCH):
            part = order[begin : begin + BATCH]
            step += 1
            for name, g in gradients(net, [data[i] for i in part], good[part].astype(np.float32)).items():
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.01 * (g * g - square[name])
                size = np.sqrt(square[name] / (1 - 0.99**step)) + 1e-7
                value = getattr(net, name)
                value -= (rate * (mean[name] / (1 - 0.9**step)) / size).astype(np.float32)
    return net


def scored(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out_fold: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the held-out fold is never fitted."""
    held_out = fold("doc_id", folds) == held_out_fold
    sample = labelled_sample(docs, labels, "quality", ~held_out, ROWS_PER_CLASS)
    net = docs.sparkSession.sparkContext.broadcast(fit(sample["text"].tolist(), sample["y"].to_numpy()))

    def over(texts: pd.Series) -> pd.Series:
        whole = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        scores = np.empty(len(whole))
        begin = 0
        while begin < len(whole):
            end, size = begin, 0
            while end < len(whole) and (end == begin or size + len(whole[end]) <= HALF * BLOCK):
                size += len(whole[end])
                end += 1
            scores[begin:end] = probabilities(net.value, whole[begin:end])
            begin = end
        return pd.Series(scores)

    over.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    score = F.pandas_udf(over, "double")("text")
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
