"""Bit sets of bounded size over keys: rows whose key they rule out need no shuffled join.

A key sets three bits of one word, words lie in pages, and a page is a row. The whole set has
at most ``SIEVE_BITS`` bits whatever the keys, so Spark sends it to the tasks. It errs on one side
only: a key that was put in is never ruled out, and for the others a join still decides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.operators.keys import attach
from leaseload.sources.exports import stage

SIEVE_BITS = 1 << 26
BITS_PER_KEY = 16
# With fewer bits a key the set is so full that it rules out too little to be worth its cost.
LEAST_BITS_PER_KEY = 4
PAGE_WORDS = 1 << 10


@dataclass(frozen=True)
class Sieve:
    pages: DataFrame
    words: int

    def may_hold(self, rows: DataFrame, key: list[str], flag: str) -> DataFrame:
        """``rows`` with a flag: false where the key was not put in (or is null)."""
        held = F.col("_words")[F.col("_word").bitwiseAND(PAGE_WORDS - 1).cast("int")]
        hit = held.bitwiseAND(_mask(key)) == _mask(key)
        for k in key:
            hit = hit & F.col(k).isNotNull()
        # Stored and of bounded size, the set is below Spark's own limit for tables it sends.
        found = rows.withColumn("_word", _word(key, self.words)).join(self.pages, F.shiftright("_word", 10) == F.col("_page"), "left")
        return found.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_word", "_page", "_words")


def _word(key: list[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*key, F.lit(0)), F.lit(words)).cast("bigint")


def _mask(key: list[str]) -> Column:
    own, one = F.xxhash64(*key, F.lit(1)), F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(own, n).bitwiseAND(63).cast("int")) for n in (0, 6, 12)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def sieve(keys: DataFrame, key: list[str]) -> Sieve | None:
    """The set of stored ``keys``; None where they are too many for it to rule out much."""
    n, words = keys.count(), PAGE_WORDS
    while words * 64 < min(SIEVE_BITS, n * BITS_PER_KEY):
        words *= 2
    if words * 64 < n * LEAST_BITS_PER_KEY:
        return None
    marked = keys.dropna(subset=key).select(_word(key, words).alias("_word"), _mask(key).alias("_bits"))
    # Every word is there, so that a word's place in its page is its number.
    empty = keys.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    filled = marked.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")).unionByName(empty)
    filled = filled.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    # A page is gathered whole: it has PAGE_WORDS words, whatever the keys.
    listed = F.array_sort(F.array_agg(F.struct("_word", "_bits")))
    pages = filled.groupBy(F.shiftright("_word", 10).alias("_page")).agg(F.transform(listed, lambda w: w["_bits"]).alias("_words"))
    return Sieve(stage(pages), words)


def flag_missing(
    facts: DataFrame, held: DataFrame, on: tuple[str, str], narrow: Callable[..., DataFrame], flag: str
) -> DataFrame:
    """``narrow`` of the facts, stored, with a flag: whether no row of ``held`` (one row per key) has
    their key. A null key is missing; where no answer is needed the flag means nothing.

    Most facts do have a row there. The keys of the facts that have none are found from the
    distinct keys alone, and only facts whose key may be one of these are shuffled: what
    ``narrow(facts, where, flag)`` leaves of them. It has to keep the flag, and the key of rows
    that need an answer ``where`` that holds, null in all others.
    """
    key, b = on
    missing = stage(facts.select(key).dropna().distinct().join(held.select(F.col(b).alias(key)), key, "left_anti"))
    sifted = sieve(missing, [key])
    marked = facts.withColumn("_maybe", F.col(key).isNotNull()) if sifted is None else sifted.may_hold(facts, [key], "_maybe")
    rows = stage(narrow(marked, F.col("_maybe"), F.col(key).isNull().alias(flag)), compression="zstd")
    asked = rows.filter(F.col(key).isNotNull()).drop(flag)
    told = stage(attach(asked, missing.withColumn(flag, F.lit(True)), [(key, key)]), compression="zstd")
    return rows.filter(F.col(key).isNull()).unionByName(told.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))
