"""Byte-level BPE by merge replay over the distinct words of many texts.

Texts are split into words by the vocabulary's pattern. The distinct words of a batch
of documents are laid out in one array of byte ids, and an inverted index holds, for
each merge rank, the places where a pair of that rank stands. The index is replayed
in rank order: all places of the lowest rank present are merged at once, and only the
pairs with the two touched neighbours are ranked anew. A word's ids are remembered by
the worker up to a bound and reused, so common words are replayed once.

Words are independent of each other, so a word gets the same ids in any batch, and a
text may be split over any number of tasks. Null text is empty: no ids. Equal texts
get equal ids. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of text whose words are replayed together.
BATCH_CHARS = 4 << 20
# Words a worker remembers the ids of.
REMEMBERED = 300_000
NONE = np.int32(np.iinfo(np.int32).max)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id from a rank file: one line per token, base64 and rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


def _ascending(places: np.ndarray) -> np.ndarray:
    """Distinct places in ascending order."""
    places = np.sort(places)
    return places[np.append(True, places[1:] != places[:-1])]


class Vocabulary:
    """Ids of single bytes, and the id each pair of ids merges to."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ids = {token: i for i, token in enumerate(tokens)}
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, merged in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = merged
        keys = np.array(sorted(pairs), np.int64)
        self.keys, self.merged = keys, np.array([pairs[k] for k in keys.tolist()], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair merges to, which is its rank; ``NONE`` where it does not."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.merged[at], NONE)


def replay(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, laid end to end, and how many each word has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    # A word's bytes are followed by a wall, id -1, that nothing merges with.
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    flat = np.frombuffer(b"\0".join(words) + b"\0", np.uint8) if words else np.empty(0, np.uint8)
    ids = vocabulary.of_byte[flat]
    ids[starts[1:] - 1] = -1
    n = len(ids)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank = np.full(n, NONE, np.int32)
    if n > 1:
        rank[:-1] = vocabulary.ranks(ids[:-1], ids[1:])

    # The inverted index: rank -> arrays of places, each array in ascending order.
    index: dict[int, list[np.ndarray]] = {}
    order = np.argsort(rank, kind="stable")
    order = order[: np.searchsorted(rank[order], NONE)]
    if len(order):
        cuts = np.flatnonzero(np.diff(rank[order])) + 1
        for places in np.split(order, cuts):
            index[int(rank[places[0]])] = [places]
    queue = list(index)
    heapq.heapify(queue)

    while queue:
        now = heapq.heappop(queue)
        lists = index.pop(now)
        places = lists[0] if len(lists) == 1 else _ascending(np.concatenate(lists))
        places = places[rank[places] == now]
        if not len(places):
            continue
        if len(places) > 1:
            # In a run of overlapping places every other one merges, from the left.
            joined = np.concatenate([[False], after[places[:-1]] == places[1:]])
            if joined.any():
                number = np.arange(len(places))
                first = np.maximum.accumulate(np.where(joined, 0, number))
                places = places[(number - first) % 2 == 0]
        eaten = after[places]
        ids[places], ids[eaten] = now, -2
        rank[eaten] = NONE
        behind = after[eaten]
        after[places] = behind
        inside = behind < n
        before[behind[inside]] = places[inside]
        ahead = before[places]
        ahead = ahead[ahead >= 0]
        touched = _ascending(np.concatenate([places, ahead]))
        follows = after[touched]
        fresh = vocabulary.ranks(ids[touched], ids[np.minimum(follows, n - 1)])
        rank[touched] = fresh
        live = fresh != NONE
        touched, fresh = touched[live], fresh[live]
        if len(touched):
            by = np.argsort(fresh, kind="stable")
            touched, fresh = touched[by], fresh[by]
            cuts = (np.flatnonzero(np.diff(fresh)) + 1).tolist()
            for begin, end in zip([0, *cuts], [*cuts, len(touched)]):
                new = int(fresh[begin])
                if new in index:
                    index[new].append(touched[begin:end])
                else:
                    index[new] = [touched[begin:end]]
                    heapq.heappush(queue, new)

    kept = ids >= 0
    counts = np.add.reduceat(kept, starts[:-1]) if len(words) else np.empty(0, np.int64)
    return ids[kept], counts


class Encoder:
    """Ids of whole texts; what words gave is remembered up to ``REMEMBERED`` words."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.vocabulary, self.split = Vocabulary(tokens), regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        words = [self.split(text or "") for text in texts]
        used = set(chain.from_iterable(words))
        if len(self.known) + len(used) > REMEMBERED:
            self.known = {word: self.known[word] for word in used & self.known.keys()}
        new = list(used.difference(self.known))
        whole = [w.encode("utf-8", "surrogatepass") for w in new]
        ids, counts = replay(whole, self.vocabulary)
        data = ids.astype("<i4").tobytes()
        ends = (np.cumsum(counts) * 4).tolist()
        begin = 0
        for word, raw, end in zip(new, whole, ends):
            one = self.vocabulary.ids.get(raw)
            self.known[word] = data[begin:end] if one is None else one.to_bytes(4, "little")
            begin = end
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, found)), "<i4") for found in words]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_of(tokens_path: str, pattern: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if (tokens_path, pattern) not in _encoders:
        _encoders[tokens_path, pattern] = Encoder(read_ranks(tokens_path), pattern)
    return _encoders[tokens_path, pattern]


def _arrays(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encoded(docs: DataFrame, tokens_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) for each row of ``docs``; the rank file is read where the tasks run."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokens_path, pattern)
        held, size = [], 0

        def done() -> pa.RecordBatch:
            texts = list(chain.from_iterable(b["text"].to_pylist() for b in held))
            keys = pa.chunked_array([b["key"] for b in held]).combine_chunks()
            return pa.RecordBatch.from_arrays([keys, _arrays(encoder.encode(texts))], ["key", "ids"])

        for batch in batches:
            held.append(batch)
            size += batch["text"].nbytes
            if size >= BATCH_CHARS:
                yield done()
                held, size = [], 0
        if held:
            yield done()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decoded(ids: Column, tokens_path: str) -> Column:
    """The bytes that an array of ids stands for, as a binary column."""
    import pandas as pd

    tokens: list[bytes] = []

    def decode(rows: pd.Series) -> pd.Series:
        if not tokens:
            tokens.extend(read_ranks(tokens_path))
        return pd.Series([None if r is None else b"".join(map(tokens.__getitem__, r.tolist())) for r in rows])

    decode.__annotations__ = {"rows": pd.Series, "return": pd.Series}
    return F.pandas_udf(decode, "binary")(ids)
