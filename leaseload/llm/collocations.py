"""Collocations: phrases whose words occur together far more often than apart.

Texts are lower-cased (A-Z), split into pieces at marks and line breaks, and pieces into
words; a phrase lies within a piece. Counts are per language (null: ``und``).

Fingerprints come from prefix polynomials over the words of a batch of texts: with
P[i] the sum of h(word j) * BASE ** j over j < i, modulo 2 ** 64, the fingerprint of the
k words at i is (P[i + k] - P[i]) * BASE ** -i, whatever comes before. Three passes read
the texts; what is shuffled is always reduced per task first.

1. Words: (language, fingerprint, count). Those below ``min_count`` go.
2. For each further length, the fingerprints whose shorter parts are all frequent, with
   their counts. The frequent ones are marked in a bitmap; a full bitmap lets more pass,
   never less.
3. Verification. Each batch keeps a pointer to an occurrence beside each marked
   fingerprint; it is followed where the text lies, and the phrase found there goes into
   the shuffle with its count and its document. Batches number their words exactly, so two
   phrases with one fingerprint are two rows here, and what is added up are the counts of
   the texts. Only here do phrases exist as text, and only frequent ones.

So a collision costs a candidate and never a wrong count. Counts are 64 bits; the products
in a score are decimals of 38 digits, exact up to counts of 10 ** 15.

Null and empty texts have no words. Repeated rows each count. Very long texts are cut into
batches between pieces, so no phrase is lost. Extra columns are not looked at. An empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import written
from leaseload.llm.ranking import ranked

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2_000
# A phrase goes if a longer candidate around it has this share of its occurrences.
COVERED_PERCENT = 50
SCALE = 1_000_000
NO_LANGUAGE = "und"

BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
LETTER_BASE = 0xC2B2AE3D27D4EB4F
# Bytes of text that are worked on at a time.
BATCH_BYTES = 8 << 20
BITMAP_BITS = 1 << 26
BITS_PER_PHRASE = 16
# A word that a hot part of a join stands for is spread over so many lanes.
LANES = 16

_BREAKS = b",;:!?\n\x0b\x0c\r"
_LOWER_AND_BREAKS = bytes.maketrans(_BREAKS + bytes(range(65, 91)), b"." * len(_BREAKS) + bytes(range(97, 123)))
BREAK = b"."


def words_and_breaks(text: str | None) -> bytes:
    """A text with its words and ``BREAK``, which no word can be, between blanks; a break ends it."""
    spelled = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER_AND_BREAKS)
    # What is left of white space: blanks and tabs only, line breaks are marks by now.
    return spelled.replace(BREAK, b" . ") + b" ."


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of fingerprints; low bits of a polynomial modulo 2 ** 64 are weak."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """Polynomial over the bytes of each word, none empty, all words at once by prefix sums."""
    if not len(words):
        return np.empty(0, np.uint64)
    lengths = pc.binary_length(words).to_numpy().astype(np.int64)
    points = np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), np.uint8).astype(np.uint64) + np.uint64(1)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(points)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(points * _powers(LETTER_BASE, int(lengths.max()))[place], starts)
    return _mixed(sums + lengths.astype(np.uint64))


class Batch:
    """Words of some texts of one language, numbered exactly, with prefix polynomials."""

    def __init__(self, texts: list[bytes], docs: list) -> None:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        self.vocabulary = coded.dictionary
        ids = coded.indices.to_numpy().astype(np.int64)
        # ``docs`` has the id of each text, ``text_of`` the text each word is from.
        text_of = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(split).to_numpy())
        there = pc.binary_length(self.vocabulary).to_numpy()[ids] > 0
        self.docs, self.text_of, self.ids = docs, text_of[there], ids[there]
        self.whole = self.ids != pc.index(self.vocabulary, BREAK.decode()).as_py()
        # The empty string between blanks is no word; it gets some hash and no place.
        filled = pc.if_else(pc.equal(self.vocabulary, ""), " ", self.vocabulary)
        hashes = word_hashes(filled)[self.ids]
        self.powers_back = _powers(UNBASE, len(self.ids))
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(BASE, len(self.ids))[:-1])])

    def fingerprints(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, fingerprints) of all phrases of ``k`` words within pieces."""
        n = len(self.ids) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        inside = self.whole[:n].copy()
        for i in range(1, k):
            inside &= self.whole[i : i + n]
        at = np.flatnonzero(inside)
        return at, _mixed((self.prefix[at + k] - self.prefix[at]) * self.powers_back[at] + np.uint64(k))

    def exact(self, at: np.ndarray, k: int) -> np.ndarray:
        """A number for each phrase, equal exactly if the phrases are."""
        n = len(self.vocabulary)
        numbers = self.ids[at]
        for i in range(1, k):
            if numbers.max(initial=0) >= (1 << 62) // n:
                numbers = np.unique(numbers, return_inverse=True)[1]
            numbers = numbers * n + self.ids[at + i]
        return numbers

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        parts = [self.vocabulary.take(pa.array(self.ids[at + i])) for i in range(k)]
        return parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " ")


def batches_of(rows: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[tuple[str, Batch]]:
    """Texts (columns doc_id, lang, text) by language, in batches of about ``limit`` bytes."""
    held: dict[str, tuple[list[bytes], list, int]] = {}

    def made(lang: str) -> tuple[str, Batch]:
        return lang, Batch(*held.pop(lang)[:2])

    for batch in rows:
        for doc_id, lang, text in zip(*[batch[c].to_pylist() for c in ("doc_id", "lang", "text")]):
            spelled = words_and_breaks(text)
            begin = 0
            while begin < len(spelled):
                # A long text goes on in the next batch after the end of a piece.
                end = len(spelled) if len(spelled) <= limit else spelled.find(BREAK, min(begin + limit, len(spelled) - 1)) + 1
                texts, docs, so_far = held.get(lang) or ([], [], 0)
                texts.append(spelled[begin:end])
                docs.append(doc_id)
                held[lang] = (texts, docs, so_far + end - begin)
                if held[lang][2] >= limit:
                    yield made(lang)
                begin = end
        # Many languages with little text each must not pile up.
        while sum(h[2] for h in held.values()) > 2 * limit:
            yield made(max(held, key=lambda name: held[name][2]))
    for lang in list(held):
        yield made(lang)


def language_seed(lang: str) -> np.uint64:
    return word_hashes(pa.array([f"language {lang}"]))[0]


class Marks:
    """Fingerprints marked in a bitmap; languages have fingerprints of their own."""

    def __init__(self, table: bytes) -> None:
        self.table = np.frombuffer(table, np.uint64)
        self.shift = np.uint64(64 - (len(self.table) * 64).bit_length() + 1)

    def hold(self, fingerprints: np.ndarray) -> np.ndarray:
        slots = fingerprints >> self.shift
        return (self.table[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) > 0


def marks_of(frequent: DataFrame) -> bytes:
    """Bitmap of the column ``fp``; the driver gets at most a quarter of ``BITMAP_BITS`` as bytes."""
    n = frequent.count()
    bits = 1 << 10
    while bits < min(BITMAP_BITS, n * BITS_PER_PHRASE):
        bits <<= 1
    slot = F.shiftrightunsigned("fp", 64 - (bits.bit_length() - 1))
    placed = frequent.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    words = placed.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    table = np.zeros(bits // 64, np.int64)
    for batch in words.toArrow().to_batches():
        table[batch["word"].to_numpy()] = batch["bits"].to_numpy()
    return table.tobytes()


_COUNTED = "fp long, n long"


def _with_parts(batch: Batch, seed: np.uint64, k: int, marks: Marks) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of ``k`` words both of whose parts of ``k - 1`` words are marked."""
    at, fps = batch.fingerprints(k)
    part_at, parts = batch.fingerprints(k - 1)
    marked = np.zeros(len(batch.ids) + 1, bool)
    marked[part_at] = marks.hold(parts ^ seed)
    both = marked[at] & marked[at + 1]
    return at[both], fps[both]


def counted(texts: DataFrame, k: int, marks: Broadcast | None = None) -> DataFrame:
    """(fp, n): fingerprints of ``k`` words and their counts, of all phrases or, with
    ``marks``, of those whose parts of ``k - 1`` words are marked. Languages differ in all
    their fingerprints, so they need no column here."""

    def over(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if marks is None else Marks(marks.value)
        for lang, batch in batches_of(rows):
            seed = language_seed(lang)
            fps = batch.fingerprints(k)[1] if held is None else _with_parts(batch, seed, k, held)[1]
            distinct, n = np.unique(fps, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((distinct ^ seed).view(np.int64)), pa.array(n)], names=["fp", "n"])

    return texts.mapInArrow(over, _COUNTED).groupBy("fp").agg(F.sum("n").alias("n"))


def verified(texts: DataFrame, marks: dict[int, Broadcast]) -> DataFrame:
    """(lang, k, phrase, n, example): marked phrases as text, exact counts, a document with
    each; and for ``k`` 0 the number of all words of a language, without a phrase."""
    schema = f"lang string, k int, phrase string, n long, example {texts.schema['doc_id'].dataType.simpleString()}"

    def over(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: Marks(m.value) for k, m in marks.items()}
        kinds: list[pa.DataType] = []
        for lang, batch in batches_of(_typed(rows, kinds)):
            seed = language_seed(lang)
            docs = pa.array(batch.docs, kinds[0])

            def made(k: int, phrases: pa.Array, n: np.ndarray, example: pa.Array) -> pa.RecordBatch:
                of_lang = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32)))
                columns = [of_lang, pa.array(np.full(len(n), k, np.int32)), phrases, pa.array(n), example]
                return pa.RecordBatch.from_arrays(columns, names=["lang", "k", "phrase", "n", "example"])

            yield made(0, pa.array([""]), np.array([batch.whole.sum()]), pa.nulls(1, kinds[0]))
            for k, own in held.items():
                at, fps = batch.fingerprints(k)
                at = at[own.hold(fps ^ seed)]
                _, first, n = np.unique(batch.exact(at, k), return_index=True, return_counts=True)
                pointers = at[first]
                yield made(k, batch.phrases(pointers, k), n, docs.take(pa.array(batch.text_of[pointers])))

    found = texts.mapInArrow(over, schema)
    return found.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"), F.min("example").alias("example"))


def _typed(rows: Iterator[pa.RecordBatch], kinds: list) -> Iterator[pa.RecordBatch]:
    """The batches as they are; the type of their ids goes into ``kinds``."""
    for batch in rows:
        if not kinds:
            kinds.append(batch.schema.field("doc_id").type)
        yield batch


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n, example) of all phrases with ``min_count`` or more occurrences,
    and (lang, total): words of each language."""
    context = docs.sparkSession.sparkContext
    texts = docs.select("doc_id", F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text").filter("text <> ''")
    marks: dict[int, Broadcast] = {}
    for k in range(1, max_words + 1):
        frequent = counted(texts, k, marks.get(k - 1)).filter(F.col("n") >= min_count).select("fp")
        marks[k] = context.broadcast(marks_of(written(frequent, "collocation-marks")))
    found = written(verified(texts, marks).filter((F.col("n") >= min_count) | (F.col("k") == 0)), "collocation-phrases")
    return found.filter("k > 0"), found.filter("k = 0").select("lang", F.col("n").alias("total"))


def _words(phrase: str, begin: int, n: int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), begin + 1, n), " ")


def scored(phrases: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, k, phrase, n, example, l, r, score): each candidate with its lowest-scoring cut."""
    candidates = phrases.filter("k > 1")
    cuts = reduce(
        DataFrame.unionByName,
        [
            candidates.filter(F.col("k") > cut).select(
                "lang", "k", "phrase", "n", "example", F.lit(cut).alias("cut"),
                _words("phrase", 0, cut).alias("left"), F.expr(f"array_join(slice(split(phrase, ' '), {cut + 1}, k), ' ')").alias("right"),
            )
            for cut in range(1, max_words)
        ],
    )
    # A word that very many phrases begin or end with is spread over lanes; there are far
    # fewer words than phrases, so they are repeated and not the phrases.
    lanes = F.explode(F.sequence(F.lit(0), F.when(F.col("k") == 1, LANES - 1).otherwise(0)))
    parts = phrases.filter(F.col("k") < max_words).select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"), lanes.alias("lane"))
    both = cuts.select("*", F.posexplode(F.array("left", "right")).alias("side", "part"))
    one_word = F.when(F.col("side") == 0, F.col("cut")).otherwise(F.col("k") - F.col("cut")) == 1
    both = both.withColumn("lane", F.when(one_word, F.abs(F.xxhash64("phrase")) % LANES).otherwise(0).cast("int"))
    found = both.join(parts, ["lang", "part", "lane"]).groupBy("lang", "k", "phrase", "n", "example", "cut").agg(
        F.max(F.when(F.col("side") == 0, F.col("part_n"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("part_n"))).alias("r"),
    )
    exact = "CAST(%s AS DECIMAL(16,0))"
    score = F.expr(f"({exact % 'n'} * {exact % 'n'} * {SCALE}) DIV ({exact % 'l'} * {exact % 'r'})")
    lowest = found.withColumn("score", score)
    return lowest.groupBy("lang", "k", "phrase", "n", "example").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("lowest")
    ).select("lang", "k", "phrase", "n", "example", "lowest.l", "lowest.r", "lowest.score")


def uncovered(candidates: DataFrame, max_words: int = MAX_WORDS, percent: int = COVERED_PERCENT) -> DataFrame:
    """Candidates without those whose words lie inside a longer one that has most of their occurrences."""
    inner = []
    for size in range(2, max_words):
        longer = candidates.filter(F.col("k") > size)
        places = F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda i: F.array_join(F.slice(F.split("phrase", " "), i, size), " "))
        inner.append(longer.select("lang", F.explode(places).alias("inside"), F.col("n").alias("around")))
    if not inner:
        return candidates
    around = reduce(DataFrame.unionByName, inner).groupBy("lang", "inside").agg(F.max("around").alias("around"))
    around = around.withColumnsRenamed({"lang": "around_lang"})
    same = (F.col("lang") == F.col("around_lang")) & (F.col("phrase") == F.col("inside"))
    joined = candidates.join(around, same, "left")
    return joined.filter(F.coalesce(100 * F.col("around") < percent * F.col("n"), F.lit(True))).drop("around_lang", "inside", "around")


def collocations(
    docs: DataFrame, top: int = TOP, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, example): the ``top`` collocations of each language."""
    phrases, totals = frequent_phrases(docs, max_words, min_count)
    candidates = written(scored(phrases, max_words), "collocation-scores")
    kept = uncovered(candidates, max_words)
    best = [F.col("score").desc(), F.col("n").desc(), F.col("phrase").asc()]
    placed = ranked(kept.drop("k"), ["lang"], best).filter(F.col("rank") < top)
    named = placed.withColumnsRenamed({"n": "a"}).join(totals.withColumnsRenamed({"total": "n"}), "lang")
    return named.select("lang", (F.col("rank") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score", "example")
