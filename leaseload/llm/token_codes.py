"""Token ids on disk as directly addressable codes.

The ids of all documents, in ascending document order, form one long sequence. It is
cut into segments, and a segment splits each id into chunks of eight bits. Level 0
holds the low chunk of every id and a continuation bitmap: a set bit says that the
id goes on in level 1, which holds the next chunk of those ids only, and so on. A
rank directory holds, for every 512 bits of a bitmap, the set bits before them, so

    place in the next level = directory[place / 512] + set bits since

and any single id is read with one lookup per level, without decoding its neighbours.

File format: a parquet folder (so that it can lie in any store Spark writes to) with
one row per segment: ``part`` and ``segment`` (order of the segments), ``first`` (ids
before the segment within its part), ``n_ids``, the documents of the segment with
their own lengths, and ``levels`` (chunks, bitmap, directory as little-endian bytes).
A second small folder, ``parts``, holds how many ids come before each part.

Documents keep together in a segment, which is closed at ``SEGMENT_IDS`` ids. Order
is doc_id, nulls first, then a digest of the text; equal rows are equal in either
order. A null text is empty and has only the end id. Empty table: empty folders.
"""

from __future__ import annotations

import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaseload.llm.common import shared_folder

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_IDS = 1 << 18
END_ID = 2
# Words a worker remembers the ids of.
REMEMBERED = 400_000

# Byte-level vocabularies spell a byte that prints as itself and any other from U+0100 on.
_PRINTS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_SPELLING = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTS)}

_LEVEL = pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("directory", pa.binary())])
_DOC = pa.struct([("doc_id", pa.int64()), ("n_ids", pa.int64())])
_SEGMENT = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("docs", pa.list_(_DOC)),
        ("levels", pa.list_(_LEVEL)),
    ]
)
_SEGMENT_SQL = """part int, segment int, first bigint, n_ids bigint, docs array<struct<doc_id:bigint,n_ids:bigint>>,
    levels array<struct<chunks:binary,bitmap:binary,directory:binary>>"""


def pack(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Levels of a sequence of ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest >> CHUNK_BITS > 0
        bits = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-max(1, len(rest)) // RANK_BITS) * RANK_BITS, np.int64)
        padded[: len(rest)] = goes_on
        sums = padded.reshape(-1, RANK_BITS).sum(1)
        directory = np.cumsum(sums) - sums
        levels.append(
            {
                "chunks": (rest & 0xFF).astype(np.uint8).tobytes(),
                "bitmap": bits.tobytes(),
                "directory": directory.astype("<u4").tobytes(),
            }
        )
        if not goes_on.any():
            return levels
        rest = rest[goes_on] >> CHUNK_BITS


def unpack(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment, from the highest level down."""
    above = np.empty(0, np.uint32)
    for level in reversed(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        goes_on = np.unpackbits(np.frombuffer(level["bitmap"], np.uint8), count=len(chunks), bitorder="little").view(bool)
        chunks[goes_on] |= above << CHUNK_BITS
        above = chunks
    return above


def id_at(levels: list[dict[str, bytes]], place: int) -> int:
    """One id by its place in the segment: a chunk, a bit and a rank per level."""
    value, shift = 0, 0
    for level in levels:
        value |= level["chunks"][place] << shift
        if not level["bitmap"][place >> 3] >> (place & 7) & 1:
            break
        block = place // RANK_BITS
        before = int.from_bytes(level["directory"][4 * block : 4 * block + 4], "little")
        since = int.from_bytes(level["bitmap"][block * RANK_BITS // 8 : (place >> 3) + 1], "little")
        since &= (1 << (place - block * RANK_BITS)) - 1
        place, shift = before + since.bit_count(), shift + CHUNK_BITS
    return value


def lowers_alike(piece: bytes) -> bool:
    """Whether composing changes nothing before and after A-Z are lower-cased."""
    return piece.isascii() or all(
        is_normalized("NFC", form.decode("utf-8", "surrogatepass")) for form in (piece, piece.lower())
    )


class WordIds(dict):
    """Ids of a word by a tokenizer file, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and works within what lies between, so a text's
    ids are those of its words in order. Words are remembered up to a bound: when it
    is reached, the remembered words become the older half and a new half begins.
    Where the tokenizer itself lower-cases and cuts off closing marks, a word is put
    together from its lower-case letters and its marks. Lower-case letters need no
    normalising and no cutting, so they go straight to the tokenizer's merge model,
    each byte spelled as the model's vocabulary spells it. These shortcuts are tried
    on sample words first and left out for a tokenizer they do not hold for. Letters
    are lower-cased ahead of the tokenizer only where composing changes nothing: it
    comes first there, and some letters are composed in lower case only.

    Special tokens quoted in a text count as text, or, without ``special_as_text``, have
    their own id as in the library's default: they are cut out of the text as it stands,
    before letters or words are looked at. A tokenizer with added tokens that take more
    than that to find gets whole texts.
    """

    MARKS = string.punctuation.replace("'", "").encode()

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if special_as_text:
            added = {i: token for i, token in added.items() if not token.special}
        # Tokens that stand in the raw text as they are spelled, and mean text elsewhere.
        self.added = {
            token.content.encode(): struct.pack("<I", i)
            for i, token in added.items()
            if token.special
            and not (token.normalized or token.single_word or token.lstrip or token.rstrip)
            and token.content.isascii()
            and len(token.content.split()) == 1
        }
        self.words_alone = len(self.added) == len(added)
        spelled = sorted(self.added, key=len, reverse=True)
        self.added_at = re.compile(b"(" + b"|".join(map(re.escape, spelled)) + b")") if spelled else None
        self.tokenizer.encode_special_tokens = special_as_text or self.words_alone
        self.merges = self.tokenizer.model.tokenize
        self.older: dict[bytes, bytes] = {}
        library = self.of_library
        self.lowers = all(library(w) == library(w.lower()) for w in (b"Ab", b"THE", "É-Gal".encode()))
        self.cuts = all(
            library(stem + mark) == library(stem) + library(mark)
            for stem in (b"ab", "señor".encode())
            for mark in (*(self.MARKS[i : i + 1] for i in range(len(self.MARKS))), b"...", b"?!")
        )
        samples = ("a", "word", "straße", "élève", "señor", "слово", "漢字", "übermäßig")
        self.plain = self.lowers and self.cuts and all(self.of_letters(w) == library(w.encode()) for w in samples)

    def of_library(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def of_letters(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = letters.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_SPELLING)
        ids = [token.id for token in self.merges(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def coded(self, word: bytes) -> bytes:
        if self.plain:
            stem = word.rstrip(self.MARKS)
            letters = stem.decode("utf-8", "surrogatepass")
            if stem.isalpha() or (
                # Letters that normalising and lower-casing leave letters.
                letters.isalpha() and is_normalized("NFC", letters) and letters.lower().isalpha()
            ):
                if len(stem) < len(word):
                    return self[stem] + self[word[len(stem) :]]
                if stem.isalpha() or letters == letters.lower():
                    return self.of_letters(letters)
        return self.of_library(word)

    def __missing__(self, word: bytes) -> bytes:
        value = self.older.get(word)
        if value is None:
            value = self.coded(word)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value

    def words_of(self, piece: bytes) -> list[bytes]:
        # bytes.lower changes A-Z only, bytes.split cuts at ASCII white space only.
        if not self.lowers:
            return piece.split()
        if lowers_alike(piece):
            return piece.lower().split()
        return [word.lower() if lowers_alike(word) else word for word in piece.split()]

    def encode(self, text: str | None) -> bytes:
        whole = (text or "").encode("utf-8", "surrogatepass")
        if not self.words_alone:
            return self.of_library(whole)
        if not any(token in whole for token in self.added):
            return b"".join(map(self.__getitem__, self.words_of(whole)))
        # Every other piece is an added token.
        pieces = self.added_at.split(whole)
        return b"".join(
            self.added[piece] if n % 2 else b"".join(map(self.__getitem__, self.words_of(piece)))
            for n, piece in enumerate(pieces)
        )


_encoders: dict[tuple[str, bool], WordIds] = {}


def encoder_of(path: str, special_as_text: bool) -> WordIds:
    key = path, special_as_text
    if key not in _encoders:
        _encoders[key] = WordIds(path, special_as_text)
    return _encoders[key]


def segments(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = END_ID,
    segment_ids: int = SEGMENT_IDS,
    special_as_text: bool = False,
) -> DataFrame:
    """Segments of the table, a part for each range of doc_id."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, end = encoder_of(tokenizer_path, special_as_text), np.array([end_id], "<u4").tobytes()
        number, first, size = 0, 0, 0
        docs_held: list[dict] = []
        ids_held: list[bytes] = []

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(ids_held), "<u4")
            row = {"part": part, "segment": number, "first": first, "n_ids": len(ids), "docs": docs_held, "levels": pack(ids)}
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                coded = encoder.encode(text)
                ids_held.append(coded + end)
                docs_held.append({"doc_id": doc_id, "n_ids": len(coded) // 4 + 1})
                size += docs_held[-1]["n_ids"]
                if size >= segment_ids:
                    yield closed()
                    number, first, size, docs_held, ids_held = number + 1, first + size, 0, [], []
        if docs_held:
            yield closed()

    tie = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), tie
    )
    return ordered.mapInArrow(code, _SEGMENT_SQL)


def write_codes(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    end_id: int = END_ID,
    special_as_text: bool = False,
) -> str:
    """Write the codes of all documents; returns their folder."""
    spark = docs.sparkSession
    target = folder or f"{shared_folder(spark)}/token-codes-{uuid.uuid4().hex}"
    # Level bytes are addressed as they are, so they are not compressed again.
    segments(docs, tokenizer_path, end_id, special_as_text=special_as_text).write.option("compression", "none").parquet(f"{target}/segments")
    totals = spark.read.parquet(f"{target}/segments").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")
    totals.select("part", before.alias("before")).coalesce(1).write.parquet(f"{target}/parts")
    return target


def placed_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start``, the ids of all segments before."""
    parts = spark.read.parquet(f"{folder}/parts")
    read = spark.read.parquet(f"{folder}/segments")
    # One row per part of the file: as many as the writing job had tasks.
    return read.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("first"))


def _documents(spark: SparkSession, folder: str, last: pa.Field, last_of: Callable) -> DataFrame:
    """doc_id, start, n_tokens and one more column per document, segment by segment.

    ``last_of`` gets a segment's ids and where its documents begin and end in them.
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["levels"])
                lengths = np.array([d["n_ids"] for d in row["docs"]], np.int64)
                ends = np.cumsum(lengths)
                columns = [
                    pa.array([d["doc_id"] for d in row["docs"]], pa.int64()),
                    pa.array(row["start"] + ends - lengths, pa.int64()),
                    pa.array(lengths),
                    last_of(ids, ends - lengths, ends),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", last.name])

    kind = {pa.int64(): "bigint", pa.list_(pa.int32()): "array<int>"}[last.type]
    rows = placed_segments(spark, folder).select("start", "docs", "levels")
    return rows.mapInArrow(documents, f"doc_id bigint, start bigint, n_tokens bigint, {last.name} {kind}")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document, its ids read back from the file."""

    def listed(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32)))

    return _documents(spark, folder, pa.field("ids", pa.list_(pa.int32())), listed)


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the file."""

    def crc(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
        data = memoryview(ids.astype("<u4").tobytes())
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
        return pa.array(sums, pa.int64())

    return _documents(spark, folder, pa.field("ids_crc32", pa.int64()), crc)


def tokens_at(spark: SparkSession, folder: str, places: DataFrame, place: str = "place") -> DataFrame:
    """(place, token) for places in the whole sequence; places beyond it get no row.

    Places and segments meet on blocks of ``SEGMENT_IDS`` places, and each id is then
    read from its segment by rank, without decoding the segment.
    """
    grain = SEGMENT_IDS
    held = placed_segments(spark, folder).filter("n_ids > 0").select("start", "n_ids", "levels")
    block = F.explode(
        F.sequence(F.floor(F.col("start") / grain), F.floor((F.col("start") + F.col("n_ids") - 1) / grain))
    )
    wanted = places.select(F.col(place).cast("bigint").alias("place"))
    wanted = wanted.withColumn("block", F.floor(F.col("place") / grain))
    met = wanted.join(held.withColumn("block", block), "block").filter("place >= start and place < start + n_ids")

    def read(levels: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([id_at([dict(x.asDict() if hasattr(x, "asDict") else x) for x in ls], p) for ls, p in zip(levels, at)])

    read.__annotations__ = {"levels": pd.Series, "at": pd.Series, "return": pd.Series}
    return met.select("place", F.pandas_udf(read, "int")("levels", F.col("place") - F.col("start")).alias("token"))
