"""Benchmark decontamination by winnowing.

Both sides keep, of every window of ``SPAN`` words, the least hash of its
``GRAM``-word grams. Equal windows keep the same gram, so every shared span of
``SPAN`` or more words has a shared fingerprint: that is the guarantee. Training and
test fingerprints are joined, and each hit is extended to the left and right word by
word; spans of ``SPAN`` words or more are occurrences. The words are compared as
text, so a hash collision costs a candidate and never a wrong hit.

An item of fewer words than ``SPAN`` is one window as a whole. For each such length
that occurs, every gram of that length is a fingerprint of its own.

Before anything is shuffled, documents drop fingerprints that no test item can have:
the test hashes are marked in a bitmap whose size is bounded by ``BITMAP_BITS`` at
most, whatever the benchmark. A full bitmap lets more pass, never less, and the join
decides. Only fingerprints that pass carry their words.

Null text has no words; an item without words has no window. The words of an item
without an id count like any other's; only the list of ids does not name it. Verdicts are per row, so
repeated ids or rows are judged each. Extra columns are not looked at by
:func:`contamination` and pass through :func:`clean_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import free_name, written

SPAN = 13
GRAM = 9
# Of twenty words one hit is enough.
HIT_RATIO = 20
BITMAP_BITS = 1 << 26
BITS_PER_HASH = 64
# Words a worker remembers the hash of.
REMEMBERED = 500_000
BASE = np.uint64(0x9E3779B97F4A7C15)
LENGTH_SALT = np.uint64(0xC2B2AE3D27D4EB4F)

# 0-9, a-z and all bytes from 0x80 on make words; A-Z is lower-cased.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class WordHashes(dict):
    """Hash of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, from the word hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for i in range(1, size):
        total *= BASE
        total += hashes[i : i + n]
    total ^= total >> np.uint64(29)
    return (total + np.uint64(size * int(LENGTH_SALT) % (1 << 64))) * BASE


def winnowed(grams: np.ndarray, span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """Places of the grams kept: of each window the least, the last of equals."""
    width = span - gram + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, place = grams[:n].copy(), np.arange(n)
    for i in range(1, width):
        smaller = grams[i : i + n] <= best
        best[smaller] = grams[i : i + n][smaller]
        place[smaller] = np.flatnonzero(smaller) + i
    return np.unique(place)


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - (bits.bit_length() - 1))


def benchmark_windows(items: DataFrame, item_id: str = "item_id", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(hash, size, at, context, items): fingerprints of the test side.

    ``context`` holds the words around the gram that a window with it can reach, ``at``
    the place of the gram in it; equal contexts are one row with all their items.
    """
    reach = span - gram

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                if not words:
                    continue
                if len(words) < span:
                    h = gram_hashes(hashes.of(words), len(words))
                    rows.append((int(h.view(np.int64)[0]), len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass"), item))
                    continue
                grams = gram_hashes(hashes.of(words), gram)
                for p in winnowed(grams, span, gram).tolist():
                    begin = max(0, p - reach)
                    context = b" ".join(words[begin : p + gram + reach]).decode("utf-8", "surrogatepass")
                    rows.append((int(grams[p : p + 1].view(np.int64)[0]), span, p - begin, context, item))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("hash", "size", "at", "context", "item"), r)) for r in rows], schema=_TEST
            )

    source = items.select(F.col(item_id).cast("string").alias("item"), F.col("text"))
    found = source.mapInArrow(fingerprints, "hash bigint, size int, at int, context string, item string")
    return found.groupBy("hash", "size", "at", "context").agg(F.collect_set("item").alias("items"))


_TEST = pa.schema(
    [("hash", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("context", pa.string()), ("item", pa.string())]
)
_TRAIN = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([*list(_TEST)[:4], ("places", pa.list_(pa.int64()))]))),
    ]
)
_TRAIN_SQL = """row bigint, doc_id bigint, n_words bigint,
    hits array<struct<hash:bigint,size:int,at:int,context:string,places:array<bigint>>>"""


def bitmap_of(windows: DataFrame) -> tuple[bytes, list[int]]:
    """Bitmap of all test hashes and the lengths below the span that occur.

    The driver gets at most ``BITMAP_BITS / 8`` bytes, in words of 32 bits.
    """
    n = windows.select("hash").distinct().count()
    bits = 1 << 10
    while bits < min(BITMAP_BITS, n * BITS_PER_HASH):
        bits <<= 1
    slot = F.shiftrightunsigned("hash", 64 - (bits.bit_length() - 1))
    placed = windows.select(F.shiftright(slot, 5).alias("word"), slot.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
    words = placed.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    table = np.zeros(bits // 32, np.uint32)
    for word, value in words.toLocalIterator():
        table[word] = value
    sizes = [r.size for r in windows.select("size").distinct().collect()]
    return table.tobytes(), sorted(sizes)


def train_fingerprints(
    docs: DataFrame, bitmap: bytes, sizes: list[int], span: int = SPAN, gram: int = GRAM
) -> DataFrame:
    """(row, doc_id, n_words, hits): per document its words and the fingerprints that may match.

    ``docs`` has the columns row, doc_id and text.
    """
    reach = span - gram
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes = np.frombuffer(shared.value, np.uint32), WordHashes()
        bits = len(table) * 32

        def marked(grams: np.ndarray) -> np.ndarray:
            slot = _slots(grams, bits)
            return np.flatnonzero(table[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32) & np.uint32(1))

        for batch in batches:
            rows = []
            for row, doc_id, text in zip(*(batch[c].to_pylist() for c in ("row", "doc_id", "text"))):
                words = words_of(text)
                by_word = hashes.of(words)
                hits: dict[tuple, list[int]] = {}
                for size in sizes:
                    grams = gram_hashes(by_word, gram if size == span else size)
                    if not len(grams):
                        continue
                    places = marked(grams)
                    if size == span and len(places):
                        places = np.intersect1d(places, winnowed(grams, span, gram), assume_unique=True)
                    for p in places.tolist():
                        begin, end = (max(0, p - reach), p + gram + reach) if size == span else (p, p + size)
                        key = (int(grams[p : p + 1].view(np.int64)[0]), size, p - begin, b" ".join(words[begin:end]))
                        hits.setdefault(key, []).append(begin)
                listed = [
                    {"hash": h, "size": s, "at": a, "context": c.decode("utf-8", "surrogatepass"), "places": at}
                    for (h, s, a, c), at in hits.items()
                ]
                rows.append({"row": row, "doc_id": doc_id, "n_words": len(words), "hits": listed})
            yield pa.RecordBatch.from_pylist(rows, schema=_TRAIN)

    return docs.select("row", F.col("doc_id").cast("bigint"), "text").mapInArrow(fingerprints, _TRAIN_SQL)


def extended(train: str, train_at: int, test: str, test_at: int, size: int, gram: int, span: int) -> tuple[int, int]:
    """The widest run of equal words through the joined gram, as places in ``train``.

    (0, 0) if it is shorter than a window.
    """
    a, b = train.split(" "), test.split(" ")
    if size < span:
        return (0, size) if a == b else (0, 0)
    if a[train_at : train_at + gram] != b[test_at : test_at + gram]:
        return 0, 0
    begin, end = train_at, train_at + gram
    shift = test_at - train_at
    while begin > 0 and begin + shift > 0 and a[begin - 1] == b[begin + shift - 1]:
        begin -= 1
    while end < len(a) and end + shift < len(b) and a[end] == b[end + shift]:
        end += 1
    return (begin, end) if end - begin >= span else (0, 0)


def occurrences(prints: DataFrame, windows: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(row, begin, end, items): runs of document words that are inside test windows."""

    def extend(
        train: pd.Series, train_at: pd.Series, test: pd.Series, test_at: pd.Series, size: pd.Series
    ) -> pd.DataFrame:
        found = [extended(*x, gram, span) for x in zip(train, train_at, test, test_at, size)]
        return pd.DataFrame(found, columns=["begin", "end"])

    run = F.pandas_udf(extend, "begin bigint, end bigint")
    hits = prints.select("row", F.inline("hits"))
    joined = hits.alias("d").join(
        windows.alias("w"), (F.col("d.hash") == F.col("w.hash")) & (F.col("d.size") == F.col("w.size"))
    )
    return (
        joined.select(
            "row", "places", "items", run("d.context", "d.at", "w.context", "w.at", F.col("d.size")).alias("run")
        )
        .filter("run.end > run.begin")
        .select("row", "items", "run", F.explode("places").alias("place"))
        .select("row", (F.col("place") + F.col("run.begin")).alias("begin"), (F.col("place") + F.col("run.end")).alias("end"), "items")
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, n_hit, items, contaminated) for documents (row, doc_id, text).

    ``items`` is the sorted array of item ids, as text, with an occurring window. The
    texts are read once; what is kept of them is written, and with it the row numbers.
    """
    windows = written(benchmark_windows(items), "test-windows")
    bitmap, sizes = bitmap_of(windows)
    prints = written(train_fingerprints(docs, bitmap, sizes), "train-fingerprints")
    runs = occurrences(prints.filter(F.size("hits") > 0), windows)
    # Places hit by any run: sorted runs of a document, each counted beyond what is covered.
    by_run = runs.groupBy("row", "begin").agg(F.max("end").alias("end"))
    ordered = F.array_sort(F.collect_list(F.struct("begin", "end")))
    covered = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda acc, run: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), run["end"] - F.greatest(run["begin"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], run["end"]).alias("upto"),
        ),
    )
    hit = by_run.groupBy("row").agg(covered["n"].alias("n_hit"))
    named = runs.select("row", F.explode("items").alias("item")).distinct()
    named = named.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = prints.select("row", "doc_id", "n_words").join(hit.join(named, "row", "left"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return found.select(
        "row",
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (HIT_RATIO * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def judged(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id with its counts, the items found, and the verdict; one row per row of ``docs``."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return contamination(numbered, items).drop("row")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns.

    The rows to drop are written first, so that their size is known before the join is
    planned: few are sent to every task, many are shuffled with the documents.
    """
    row = free_name(docs, "row_of_table")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-documents")
    found = contamination(numbered.select(F.col(row).alias("row"), "doc_id", "text"), items)
    dirty = written(found.filter("contaminated").select(F.col("row").alias(row)), "contaminated-rows")
    return numbered.join(dirty, row, "left_anti").select(docs.columns)
