"""Token ids as binary blocks with Elias-Fano coded document boundaries.

A folder holds ``blocks``: Parquet rows of about a million ids each, in order of document id, with
the ids of their documents one after the other in 2 or 4 bytes each, and the ends of the documents
as Elias-Fano code; and ``parts``: one row per id range with the number of ids before it. Offsets
of documents come from these, no table of 64-bit offsets is kept. Any storage that Spark reads
will do.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.llm.eliasfano import EliasFano
from stayflow.llm.running import id_part, numbered
from stayflow.llm.word_memory import WordMemory

#: Ids after which a block ends; a longer document is a block of its own.
BLOCK_IDS = 1_000_000
#: Chunks in one generation of an encoder's memory; there are two.
MAX_WORDS = 200_000


def _byte_letters() -> dict[int, str]:
    """What byte-level tokenizers write for each byte: printable ones as they are, the others from
    U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class LibraryEncoder:
    """Texts to ids with the tokenizers library, for byte-level vocabularies without a prefix space.

    New words go through the library's model, other new chunks through its pre-tokenizer and model
    where these are all there is, else its whole encoding. So does a whole text that holds the string
    of a special token, unless these are ordinary text.
    """

    def __init__(self, content: str, width: int, special_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = special_as_text
        added = () if special_as_text else self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.split, self.model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.kind, self.letter = np.dtype(f"<u{width}"), "H" if width == 2 else "I"
        plain = self.tokenizer.normalizer is None
        self.memory = WordMemory(MAX_WORDS, self.letters, self.pieces if plain else self.whole, plain)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        return self.memory.encode(text)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def letters(self, word: str) -> bytes:
        if word.isascii():
            return self.piece(word.replace(" ", BYTE_LETTERS[32]))
        return self.piece(word.encode().decode("latin-1").translate(BYTE_LETTERS))

    def pieces(self, chunk: str) -> bytes:
        return b"".join([self.piece(p) for p, _ in self.split.pre_tokenize_str(chunk)])

    def piece(self, written: str) -> bytes:
        """Ids of a piece, written in byte letters."""
        tokens = [t.id for t in self.model.tokenize(written)]
        return struct.pack(f"<{len(tokens)}{self.letter}", *tokens)


@lru_cache(maxsize=2)
def encoder_of(content: str, width: int, special_as_text: bool) -> LibraryEncoder:
    return LibraryEncoder(content, width, special_as_text)


def vocabulary_size(content: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(content).get_vocab_size(with_added_tokens=True)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    special_as_text: bool = False,
) -> None:
    """Encode every whole text, append ``end_id``, and write ``folder`` in ascending order of id.

    NULL texts are encoded as empty ones, NULL ids come last, rows that repeat an id are in order of
    their text. An empty table gives files without rows. Strings of special tokens inside a text become
    those tokens, as in the library; with ``special_as_text`` they are ordinary text. Texts are shuffled once, to ranges of ids; a task
    holds one block at a time.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        text = file.read()
    width = 2 if max(vocabulary_size(text) - 1, end_id) < 1 << 16 else 4
    content = spark.sparkContext.broadcast(text)
    end = np.array([end_id], f"<u{width}").tobytes()

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder_of(content.value, width, special_as_text).encode
        part, number, before = None, 0, 0
        ids: list[bytes] = []
        names: list = []
        size = 0

        def block() -> pd.DataFrame:
            ends = EliasFano.of(np.cumsum([len(x) // width for x in ids]))
            return pd.DataFrame(
                {"part": [part], "block": [number], "ids_before": [before], "n_ids": [size], "doc_ids": [names],
                 "width": [width], "ids": [b"".join(ids)], "low_bits": [ends.low_bits], "low": [ends.low],
                 "high": [ends.high], "samples": [ends.samples]}
            )

        for pdf in batches:
            for p, doc_id, text in zip(pdf["part"], pdf["doc_id"], pdf["text"]):
                if size >= BLOCK_IDS or (size and p != part):
                    yield block()
                    number, before = (number + 1, before + size) if p == part else (0, 0)
                    ids, names, size = [], [], 0
                part = p
                encoded = encode(text) + end
                ids.append(encoded)
                names.append(None if pd.isna(doc_id) else doc_id)
                size += len(encoded) // width
        if size:
            yield block()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows, number = numbered(rows, "doc_id")
    part, _ = id_part(rows, number, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select("doc_id", "text", part.alias("part")).repartition("part").sortWithinPartitions("part", "doc_id", "text")
    dealt.mapInPandas(
        blocks,
        f"part int, block int, ids_before long, n_ids long, doc_ids array<{kind}>, width int, ids binary, "
        "low_bits int, low binary, high binary, samples binary",
    ).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    # One row per id range: as many as partitions.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    totals.select(
        "part", "n_ids", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("start")
    ).write.parquet(f"{folder}/parts")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks, each with ``start``: the number of ids in all files before it."""
    parts = spark.read.parquet(f"{folder}/parts").select("part", F.col("start").alias("part_start"))
    return (
        spark.read.parquet(f"{folder}/blocks")
        .join(F.broadcast(parts), "part")
        .withColumn("start", F.col("part_start") + F.col("ids_before"))
        .drop("part_start", "ids_before")
    )


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, start, ids (with the end id) of the documents whose id is in ``wanted``.

    The wanted ids are joined with the blocks' lists of ids; a block that holds some of them gives
    their offsets by ``select``, without decoding the other boundaries. Ids that are not in the
    files have no row, an id that stands in the files several times has as many; repeated and
    NULL wanted ids count once and not at all.
    """
    blocks = read_tokens(spark, folder)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    asked = wanted.select(F.col(id_col).cast(kind).alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()
    places = blocks.select("part", "block", F.posexplode("doc_ids").alias("place", "doc_id")).join(asked, "doc_id")
    # No more places than documents of a block.
    lists = places.groupBy("part", "block").agg(F.sort_array(F.collect_list("place")).alias("places"))

    def picked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ends, names = block_ends(row), list(row.doc_ids)
                ids = np.frombuffer(row.ids, f"<u{row.width}")
                found = [(names[i], ends.select(i - 1) if i else 0, ends.select(i)) for i in map(int, row.places)]
                yield pd.DataFrame(
                    {"doc_id": [n for n, _, _ in found], "start": [row.start + a for _, a, _ in found],
                     "ids": [ids[a:b].astype(np.int64) for _, a, b in found]}
                )

    return blocks.join(lists, ["part", "block"]).mapInPandas(picked, f"doc_id {kind}, start long, ids array<long>")


def block_ends(row) -> EliasFano:
    """The boundaries of a block, for ``select`` or ``all``: document i has the ids from the end of
    the one before (0 for the first) to its own."""
    return EliasFano(len(row.doc_ids), int(row.low_bits), row.low, row.high, row.samples)


def read_document_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone."""

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ends = block_ends(row).all()
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(row.ids, f"<u{row.width}").astype("<u4")
                out = pd.DataFrame(
                    {"doc_id": list(row.doc_ids), "start": starts + row.start, "n_tokens": ends - starts,
                     "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]}
                )
                if out["doc_id"].isna().any():
                    out["doc_id"] = pd.array(list(row.doc_ids), "Int64") if kind == "bigint" else out["doc_id"]
                yield out

    blocks = read_tokens(spark, folder)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.mapInPandas(digested, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
