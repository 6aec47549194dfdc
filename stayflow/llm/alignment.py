"""Align the tokens of two tokenizers by the bytes they end at.

Both lists of token ends ascend. The shorter one gallops through the longer: from the place of its
last value by doubling steps, then by halving. Ends found in both cut the text into groups; the ranks
of a common end in the two lists give the range of tokens of its group.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm.store import checkpointed
from stayflow.llm.token_files import BYTE_LETTERS, LibraryEncoder
from stayflow.llm.word_memory import INNER_SPACE, PUNCTUATION, WordMemory

#: Values of the shorter list that one lane takes in turn.
LANE = 32
#: Chunks in one generation of the memory; there are two.
MAX_CHUNKS = 150_000
#: The mark of an id of the second tokenizer, and what stands for a chunk whose bytes it changes.
SECOND, NO_ID = 1 << 31, 2**32 - 1
CHANGED = pack("I", NO_ID)
#: Bytes of text that are aligned and handed on together.
UNIT_BYTES = 1 << 20
#: A space at which neither tokenizer's tokens go on: after another character, before a non-space.
CUT = re.compile(r"(?<! ) (?=\S)")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of one ascending list the first place in the other with none less.

    Lanes of ``LANE`` values go side by side; within a lane each search starts where the one before
    ended, doubles its step until it has passed the value, and halves the rest.
    """
    n, end = len(short), len(long)
    lanes = -(-n // LANE)
    if not n or not end:
        return np.zeros(n, np.int64)
    top = np.iinfo(np.int64).max
    wanted = np.full(lanes * LANE, short[-1], np.int64)
    wanted[:n] = short
    wanted = wanted.reshape(lanes, LANE).T.copy()
    long = np.append(long, top)
    found = np.empty((LANE, lanes), np.int64)
    low = np.searchsorted(long, wanted[0])
    for turn, want in enumerate(wanted):
        high, step = low, 1
        behind = long[high] < want
        while behind.any():
            low = np.where(behind, high + 1, low)
            high = np.where(behind, np.minimum(high + step, end), high)
            behind = long[high] < want
            step *= 2
        while True:
            open_ = low < high
            if not open_.any():
                break
            middle = (low + high) >> 1
            less = open_ & (long[middle] < want)
            low = np.where(less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        found[turn] = low
    return found.T.reshape(-1)[:n]


def letter_tokens(content: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary; added tokens are their own text."""
    stored = json.loads(content)
    byte = {letter: b for b, letter in BYTE_LETTERS.items()}
    out: dict[int, bytes] = {}
    for token, i in stored["model"]["vocab"].items():
        out[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
    for added in stored.get("added_tokens", []):
        out[added["id"]] = added["content"].encode()
    return [out.get(i, b"") for i in range(max(out) + 1)]


def piece_tokens(model) -> list[bytes]:
    """Bytes of each piece: U+2581 is a space, <0xHH> a byte."""
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        byte = BYTE_PIECE.fullmatch(piece)
        out.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return out


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """All id pairs (a << 32 | b, sorted) whose tokens can end together: one is the end of the other.

    Their number is bounded by the tokens' lengths, whatever the corpus: one for each end of a token
    that is a token of the other vocabulary.
    """
    ids_a: dict[bytes, list[int]] = {}
    ids_b: dict[bytes, list[int]] = {}
    for ids, tokens in ((ids_a, a), (ids_b, b)):
        for i, token in enumerate(tokens):
            ids.setdefault(token, []).append(i)
    pairs = {i << 32 | j for i, t in enumerate(a) for at in range(len(t)) for j in ids_b.get(t[at:], ())}
    pairs |= {i << 32 | j for j, t in enumerate(b) for at in range(len(t)) for i in ids_a.get(t[at:], ())}
    return np.array(sorted(pairs), np.int64)


class Aligner:
    """Both tokenizers, with a memory of the ids of chunks of text."""

    def __init__(self, letters: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.first = LibraryEncoder(letters, 4, True)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.a, self.b = letter_tokens(letters), piece_tokens(self.second)
        self.a_size = np.array([len(t) for t in self.a], np.int64)
        self.b_size = np.array([len(t) for t in self.b], np.int64)
        self.pairs = linkable(self.a, self.b)
        self.names = [f"{i}{end}" for n, ends in ((len(self.a), ",|"), (len(self.b), ",;")) for i in range(n) for end in ends]
        self.after_line = len(self.second.encode("\n"))
        self.memory = WordMemory(MAX_CHUNKS, self.packed, self.packed, True, self.cut)
        self.cuts = self.first.memory.plain and self.ends_at_marks()

    def ends_at_marks(self) -> bool:
        """Whether no piece of the second goes on after a space behind another character, from a
        letter to ASCII punctuation, or over a line feed: there it can be cut like the first."""
        names = [self.second.id_to_piece(i) for i in range(len(self.b)) if not self.second.is_control(i) and not self.second.is_unknown(i)]
        beside = {x for p in names if not BYTE_PIECE.fullmatch(p) for x in zip(p, p[1:])}
        return not any(
            "\n" in (x, y) or (y == "▁" and x != "▁") or (x.isalpha() and y in PUNCTUATION) for x, y in beside
        )

    def cut(self, text: str) -> tuple[str, list[str]]:
        """A text that starts with a space, cut at spaces where both tokenizers end a token."""
        if not INNER_SPACE.search(text):
            return "", text[1:].split(" ")
        cuts = [0, *(m.start() for m in CUT.finditer(text, 1)), len(text)]
        return "", [text[a + 1 : b] for a, b in zip(cuts[:-1], cuts[1:])]

    def packed(self, chunk: str) -> bytes:
        """Ids of both for a chunk, those of the second marked; ``CHANGED`` where a tokenizer changes
        its bytes."""
        first = self.first.letters if chunk.removeprefix(" ").isalpha() else self.first.pieces
        if chunk[0] == " ":
            second = self.second.encode(chunk[1:])
        else:
            # A line feed stands for what is before: no piece goes on after one.
            second = self.second.encode("\n" + chunk)[self.after_line :]
        return self.joined(chunk, first(chunk), second) or CHANGED

    def joined(self, text: str, a: bytes, b: list[int]) -> bytes | None:
        whole, ids = text.encode(), memoryview(a).cast("I")
        if b"".join([self.a[i] for i in ids]) != whole or b"".join([self.b[i] for i in b]) != whole:
            return None
        return a + pack(f"{len(b)}I", *[i | SECOND for i in b])

    def encode(self, text: str) -> np.ndarray:
        """Ids of both tokenizers, each in order, those of the second marked by ``SECOND``; none where
        a tokenizer changes the text's bytes."""
        found = self.memory.encode(" " + text) if self.cuts else CHANGED
        ids = np.frombuffer(found, np.uint32)
        if (ids == NO_ID).any():
            whole = self.joined(" " + text, self.first.whole(" " + text), self.second.encode(text))
            ids = np.frombuffer(whole or b"", np.uint32)
        return ids

    def align(self, texts: list[str | None]) -> pa.RecordBatch:
        """n_a, n_b, groups and links (numbers of id pairs) of each text."""
        found = [self.encode(t) if t else np.zeros(0, np.uint32) for t in texts]
        n_all = np.array([len(x) for x in found])
        ids = np.concatenate(found)
        second = ids >= SECOND
        n_b = np.diff(np.concatenate([[0], np.cumsum(second)])[np.concatenate([[0], np.cumsum(n_all)])])
        n_a = n_all - n_b
        a, b = ids[~second].astype(np.int64), (ids[second] ^ np.uint32(SECOND)).astype(np.int64)
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # Both lists of a document end at the same byte, so the documents can be laid end to end.
        fewer_a = n_a <= n_b
        side_a, side_b = np.repeat(fewer_a, n_a), np.repeat(fewer_a, n_b)
        common_a, common_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        for short, long, places_short, places_long, hit_short, hit_long in (
            (end_a[side_a], end_b[side_b], np.flatnonzero(side_a), np.flatnonzero(side_b), common_a, common_b),
            (end_b[~side_b], end_a[~side_a], np.flatnonzero(~side_b), np.flatnonzero(~side_a), common_b, common_a),
        ):
            at = gallop(short, long)
            met = at < len(long)
            met[met] = long[at[met]] == short[met]
            hit_short[places_short[met]] = True
            hit_long[places_long[at[met]]] = True
        at_a, at_b = np.flatnonzero(common_a), np.flatnonzero(common_b)
        pair = np.searchsorted(self.pairs, a[at_a] << 32 | b[at_b])
        # A group's tokens of the first, then of the second: each token moves by the ranks of the ends.
        group_a = np.cumsum(common_a) - common_a
        group_b = np.cumsum(common_b) - common_b
        before = np.concatenate([[0], at_b + 1])
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + before[group_a]] = 2 * a + common_a
        line[np.arange(len(b)) + at_a[group_b] + 1] = 2 * (len(self.a) + b) + common_b
        edges = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        line, name = line.tolist(), self.names.__getitem__
        groups = ["".join(map(name, line[x:y]))[:-1] for x, y in zip(edges[:-1], edges[1:])]
        starts = np.searchsorted(at_a, np.append(first_a, len(a)))
        links = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(pair.astype(np.int32)))
        return pa.RecordBatch.from_arrays(
            [pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(np.diff(starts), pa.int64()),
             pa.array(groups, pa.string()), links],
            ["n_a", "n_b", "n_groups", "groups", "links"],
        )


@lru_cache(maxsize=1)
def aligner_of(letters: str, pieces: bytes) -> Aligner:
    """One aligner in each Python worker, kept between tasks; its memory is bounded."""
    return Aligner(letters, pieces)


class Alignment:
    """Two vocabulary files, a byte-level one of the tokenizers library and one of sentencepiece.

    The driver reads both files and broadcasts them; their sizes do not depend on the corpus.
    """

    def __init__(self, spark: SparkSession, letters_path: str, pieces_path: str):
        with open(letters_path, encoding="utf-8") as file:
            self.letters = file.read()
        with open(pieces_path, "rb") as file:
            self.pieces = file.read()
        self.spark = spark

    def align(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_a, n_b, n_groups, groups and links of every row.

        The first tokenizer gets a space and the text, the second the text, before which it puts a
        space itself; strings of special tokens are plain text. ``groups`` is ``a1,a2|b1;a3|b2,b3``:
        ids of both between common ends. ``links`` numbers the id pairs that end together, one for
        each common end, among ``linkable`` pairs. NULL and empty texts, and those whose bytes a
        tokenizer changes, have no tokens: zeros, an empty text and an empty list. Rows that repeat
        are aligned each; ids are not looked at; other columns are dropped.
        """
        files = self.spark.sparkContext.broadcast((self.letters, self.pieces))

        def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = aligner_of(*files.value)
            for batch in batches:
                at, size, texts = 0, 0, []
                column = batch.column(1)
                for n in range(batch.num_rows):
                    texts.append(column[n].as_py())
                    size += len(texts[-1] or "")
                    if size >= UNIT_BYTES or n + 1 == batch.num_rows:
                        out = aligner.align(texts)
                        ids = batch.column(0).slice(at, len(texts))
                        yield pa.RecordBatch.from_arrays([ids, *out.columns], ["doc_id", *out.schema.names])
                        at, size, texts = n + 1, 0, []

        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        kind = rows.schema["doc_id"].dataType.simpleString()
        return rows.mapInArrow(
            aligned, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups string, links array<int>"
        )

    def pair_counts(self, aligned: DataFrame) -> DataFrame:
        """(a, b, links): how many links of the whole corpus hold each id pair. No more rows than
        ``linkable`` pairs, a number that the vocabularies fix. An empty table gives none."""
        pairs = self.spark.sparkContext.broadcast(aligner_of(self.letters, self.pieces).pairs)

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(pairs.value), np.int64)
            for batch in batches:
                links = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                total += np.bincount(links, minlength=len(total))
            met = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs.value[met] >> 32), pa.array(pairs.value[met] & 0xFFFFFFFF), pa.array(total[met])],
                ["a", "b", "n"],
            )

        found = aligned.select("links").mapInArrow(counted, "a long, b long, n long")
        return found.groupBy("a", "b").agg(F.sum("n").alias("links"))

    def scored(self, aligned: DataFrame) -> DataFrame:
        """Add n_links, n_best (links whose pair is the most frequent of its second id, ties
        included) and count_sum (over the links) to a stored result of ``align``; drop ``links``."""
        pairs = aligner_of(self.letters, self.pieces).pairs
        # As many rows as linkable pairs at most.
        counts: pd.DataFrame = self.pair_counts(aligned).toPandas()
        count = np.zeros(len(pairs), np.int64)
        met = np.searchsorted(pairs, counts["a"].to_numpy(np.int64) << 32 | counts["b"].to_numpy(np.int64))
        count[met] = counts["links"]
        second = pairs & 0xFFFFFFFF
        most = np.zeros(int(second.max(initial=0)) + 1, np.int64)
        np.maximum.at(most, second, count)
        table = self.spark.sparkContext.broadcast((count, count == most[second]))
        kept = [c for c in aligned.columns if c != "links"]

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, best = table.value
            for batch in batches:
                links = batch.column("links")
                edges = links.offsets.to_numpy() - links.offsets[0].as_py()
                flat = links.flatten().to_numpy(zero_copy_only=False)
                sums = [np.concatenate([[0], np.cumsum(x[flat])]) for x in (best, number)]
                columns = [pa.array(np.diff(edges), pa.int64())]
                columns += [pa.array(s[edges[1:]] - s[edges[:-1]], pa.int64()) for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *columns], [*kept, "n_links", "n_best", "count_sum"]
                )

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links")
        return aligned.mapInArrow(summed, f"{schema}, n_links long, n_best long, count_sum long")


def digests(docs: DataFrame, letters_path: str, pieces_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row; the digest
    of a row without tokens is ''. Links are stored once, in the shared folder: two passes read them."""
    alignment = Alignment(docs.sparkSession, letters_path, pieces_path)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    found = alignment.align(docs).select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "links")
    rows = alignment.scored(checkpointed(found))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
