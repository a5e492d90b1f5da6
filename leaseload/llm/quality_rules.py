"""Quality rules whose limits follow the data: quantile sketches per language and source.

Signals of each whole text are counted once. For each share that can point to junk a
sketch is kept per (lang, source): counts of values by geometric bucket, so a value
is known within ``GAMMA``. Such sketches merge by adding counts, they do not depend
on partitions or order, and a hot source is reduced in its tasks before anything is
shuffled. From the merged sketches come the median and a high quantile (``HIGH``) of each
signal, and from those a fence

    high + REACH * max(high - median, EVENTS / median size)

above which a document fails. The size is what the signal is a share of (words, lines or
characters; it has a sketch as well): where nearly all documents are alike, a share may
still come from a few events in a text of the group's usual size, and no fixed share is
taken to be small; for the mean word length, which is no share, it is what the sketch can
tell apart. A group with fewer than ``ENOUGH`` documents takes the fence of its
language, and a small language that of all documents.

Null text counts as empty: no words, fails the base rule. Null ``lang`` or ``source``
is a group of its own. Repeated rows are each judged, alike. Extra columns, also ones
named like a signal, pass through :func:`kept_documents` untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaseload.llm.common import free_name, per_text, written

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\r\x0b\x0c"
WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

GAMMA = 1.05
ENOUGH = 200
REACH = 4.0
HIGH = 0.9
EVENTS = 3
# The judged signals and the size that each is a share of.
SIZE_OF = {
    "symbol_share": "word_chars",
    "dup_line_share": "n_lines",
    "repeat_share": "n_words",
    "upper_share": "n_words",
    "same_word_share": "n_words",
    "word_length": None,
}
SIGNALS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_same_words long"
)


def repeated_window_words(words: list[bytes], size: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``size`` words that occur twice or more, the first included."""
    if len(words) <= size:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Windows get exact numbers by pairing: 2 words, 4 words, then the fifth.
    windows, covered = ids, 1
    while covered < size:
        step = min(covered, size - covered)
        tail = windows if step == covered else ids
        if step not in (covered, 1):
            raise ValueError("window size must be a power of two, or one more")
        ahead = tail[covered : covered + len(windows) - step]
        pairs = windows[: len(ahead)] * (int(tail.max()) + 1) + ahead
        _, windows = np.unique(pairs, return_inverse=True)
        covered += step
    again = np.bincount(windows)[windows] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def signals_of(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    word_chars = len(text) - sum(text.count(c) for c in WHITE)
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    n_upper = sum(1 for w in words if w.isupper())
    same = sum(1 for a, b in zip(words, words[1:]) if a == b)
    return (
        len(words),
        word_chars,
        n_symbols,
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        n_upper,
        same,
    )


def signals(text: Column) -> Column:
    return per_text(signals_of, SIGNALS)(text)


def base_failed(at: str = "") -> Column:
    words, repeats = F.col(f"{at}n_words"), F.col(f"{at}n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def shares(at: str = "") -> Column:
    """The judged values and the sizes, by name, as a map; a text without words has none."""
    c = {name.split()[0]: F.col(f"{at}{name.split()[0]}") for name in SIGNALS.split(", ")}
    values = {
        "symbol_share": c["n_symbols"] / c["word_chars"],
        "dup_line_share": c["n_dup_lines"] / c["n_lines"],
        "repeat_share": c["n_repeat_words"] / c["n_words"],
        "upper_share": c["n_upper"] / c["n_words"],
        "same_word_share": c["n_same_words"] / c["n_words"],
        "word_length": c["word_chars"] / c["n_words"],
        **{name: c[name].cast("double") for name in ("word_chars", "n_lines", "n_words")},
    }
    listed = F.create_map(*[x for name, value in values.items() for x in (F.lit(name), value)])
    return F.when(c["n_words"] > 0, listed)


def sketches(rows: DataFrame, value_map: Column) -> DataFrame:
    """Sketch rows (lang, source, signal, bucket, n): the bucket of 0 is null."""
    long = rows.select("lang", "source", F.explode(value_map).alias("signal", "value"))
    bucket = F.when(F.col("value") > 0, F.ceil(F.log(F.col("value")) / F.log(F.lit(GAMMA))))
    return long.groupBy("lang", "source", "signal", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Merge sketches to groups ``by`` and read size, median and high quantile off them."""
    keys = [*by, "signal"]
    merged = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    ordered = Window.partitionBy(*keys).orderBy(F.col("bucket").asc_nulls_first())
    placed = merged.withColumns(
        {"upto": F.sum("n").over(ordered), "size": F.sum("n").over(Window.partitionBy(*keys))}
    )
    # The upper end of a bucket, so that no quantile is read below its true value.
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bucket")))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("size"), value))

    return placed.groupBy(*keys).agg(
        F.max("size").alias("size"), quantile(0.5).alias("median"), quantile(HIGH).alias("high")
    )


def by_signal(sketch: DataFrame, by: list[str], name: str) -> DataFrame:
    """One row per group, its quantiles as a map from signal to (size, median, high)."""
    entry = F.struct("signal", F.struct("size", "median", "high"))
    return quantiles(sketch, by).groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, fences): a map from signal to the value above which a document fails."""
    groups = by_signal(sketch, ["lang", "source"], "own")
    langs = by_signal(sketch, ["lang"], "of_lang").withColumnRenamed("lang", "its_lang")
    # One row: read as a value, not joined.
    of_all = by_signal(sketch, [], "of_all").scalar()
    near = groups.join(langs, F.col("lang").eqNullSafe(F.col("its_lang"))).withColumn("of_all", of_all)

    def taken(signal: str, quantile: str) -> Column:
        own, lang, every = (F.col(name)[signal] for name in ("own", "of_lang", "of_all"))
        return (
            F.when(own["size"] >= ENOUGH, own[quantile])
            .when(lang["size"] >= ENOUGH, lang[quantile])
            .otherwise(every[quantile])
        )

    def fence(signal: str, size: str | None) -> Column:
        high = taken(signal, "high")
        # What a few events make, or what the sketch can tell apart.
        least = high * (GAMMA - 1) if size is None else F.coalesce(EVENTS / F.nullif(taken(size, "median"), F.lit(0.0)), F.lit(0.0))
        return high + REACH * F.greatest(high - taken(signal, "median"), least)

    listed = [x for signal, size in SIZE_OF.items() for x in (F.lit(signal), fence(signal, size))]
    return near.select("lang", "source", F.create_map(*listed).alias("fences"))


def failed_rules(value_map: Column, fence_map: Column) -> Column:
    """Names of the signals beyond their fence, in fixed order."""
    return F.filter(
        F.array(*[F.lit(name) for name in SIZE_OF]),
        lambda name: F.coalesce(value_map[name] > fence_map[name], F.lit(False)),
    )


def _verdict(rows: DataFrame, at: str) -> tuple[DataFrame, Column, Column]:
    """Rows (as ``d``) beside the fences of their group, base rule, failed signals.

    The fences are written first: then their size is known before the join is planned,
    and only fences too large to be sent to every task make the rows move.
    """
    limits = written(fences(sketches(rows, shares(at))), "quality-fences").alias("f")
    same_group = F.col("d.lang").eqNullSafe(F.col("f.lang")) & F.col("d.source").eqNullSafe(F.col("f.source"))
    joined = rows.alias("d").join(limits, same_group, "left")
    return joined, base_failed(f"d.{at}"), failed_rules(shares(f"d.{at}"), F.col("f.fences"))


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source, all signals, base_failed, failed, kept."""
    counted = docs.select("doc_id", "lang", "source", signals(F.col("text")).alias("s"))
    counted = written(counted.select("doc_id", "lang", "source", "s.*"), "quality-signals")
    joined, base, failed = _verdict(counted, "")
    return joined.select("d.*", base.alias("base_failed"), failed.alias("failed")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    box = free_name(docs, "signals_of_text")
    counted = written(docs.withColumn(box, signals(F.col("text"))), "quality-documents")
    joined, base, failed = _verdict(counted, f"{box}.")
    return joined.filter(~base & (F.size(failed) == 0)).select(*[F.col(f"d.`{c}`") for c in docs.columns])
