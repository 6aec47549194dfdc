"""Byte-level BPE as a lazily determinised finite-state transducer; streaming decode.

For every prefix of a piece the greedy merges give one last token, and that token fits the
last token of the prefix before it. So encoding can run from left to right: the transducer
keeps every place where a token may still begin, with the trie node reached from there and the
token before it; a set of these is a state. An arc gives the last token of the prefix it ends.
Tokens are emitted once the chains of all open starts agree on them: at the end of a piece,
and inside a long one each time a few times the longest token has been read. States and arcs
are made when first met and then reused.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import regex
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.word_memory import WordMemory

#: More states or fitting pairs than this are dropped; more remembered chunks begin a new generation.
MAX_STATES, MAX_PAIRS, MAX_CHUNKS = 150_000, 300_000, 200_000
#: Rows of a batch that are handed on together.
ROWS = 256
#: Ids that a streaming decoder takes at a time.
DECODE_STEP = 4096


def read_ranks(path: str) -> bytes:
    """A rank file as it is: lines of a base64 token and its rank."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


class Transducer:
    """Encoder of pieces (matches of the splitting pattern) to ids, states made on demand."""

    def __init__(self, ranks: dict[bytes, int], max_states: int | None = None):
        self.ranks = ranks
        self.max_states = max_states or MAX_STATES
        self.token = {rank: token for token, rank in ranks.items()}
        #: The trie of the tokens: node << 8 | byte to the node below.
        self.below: dict[int, int] = {}
        self.ends: list[int] = [-1]
        self.depth: list[int] = [0]
        self.inner = bytearray(1)
        for token, rank in ranks.items():
            node = 0
            for depth, byte in enumerate(token, 1):
                self.inner[node] = 1
                node = self.below.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
                    self.depth.append(depth)
                    self.inner.append(0)
            self.ends[node] = rank
        self.size = [0] * (max(self.token, default=-1) + 1)
        for rank, token in self.token.items():
            self.size[rank] = len(token)
        #: Bytes after which certain tokens are emitted.
        self.window = 4 * max(map(len, ranks), default=1)
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget the states; they come back as they are needed."""
        #: A state is its open starts: trie node so far << 32 | token before the start + 1.
        self.keys: list[tuple[int, ...]] = [(0,)]
        self.numbers: dict[tuple[int, ...], int] = {self.keys[0]: 0}
        self.arcs: list[dict[int, tuple[int, int]]] = [{}]

    def merged(self, piece: bytes, below: int) -> list[bytes]:
        """The piece after all merges of a rank under ``below``, lowest first, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def parts(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; () for a byte, None if no merges make it."""
        if rank not in self._parts:
            token = self.token[rank]
            found = self.merged(token, rank) if len(token) > 1 else []
            self._parts[rank] = tuple(self.ranks[p] for p in found) if len(found) in (0, 2) else None
        return self._parts[rank]

    def spine(self, rank: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge (0 left, 1 right) of a token while it grows: (rank, rank of the next)."""
        out, after = [], float("inf")
        while True:
            out.append((rank, after))
            parts = self.parts(rank)
            if not parts:
                return out[::-1]
            rank, after = parts[side], rank

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges keep two adjacent tokens apart.

        At each time the edges that touch are one token of the left's right spine and one of the
        right's left spine. They merge if their pair comes before what else takes either of them;
        of equal merges the one further left goes first.
        """
        found = self._fits.get(left << 32 | right)
        if found is None:
            found, edge, other = True, self.spine(left, 1), self.spine(right, 0)
            i = j = 0
            while True:
                (a, a_end), (b, b_end) = edge[i], other[j]
                rank = self.ranks.get(self.token[a] + self.token[b])
                if rank is not None and rank < a_end and rank <= b_end:
                    found = False
                    break
                if a_end == b_end == float("inf"):
                    break
                if a_end <= b_end:
                    i += 1
                else:
                    j += 1
            if len(self._fits) > MAX_PAIRS:
                self._fits.clear()
            self._fits[left << 32 | right] = found
        return found

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """The arc of a state for a byte: the next state, and the last token of this prefix."""
        below, ends, inner, fits, parts = self.below, self.ends, self.inner, self._fits, self._parts
        going, reached = [], -1
        for start in self.keys[state]:
            node = below.get(start >> 32 << 8 | byte)
            if node is None:
                continue
            before = start & 0xFFFFFFFF
            if reached < 0:
                token = ends[node]
                if token >= 0 and (not before or fits.get(before - 1 << 32 | token, 0) or self.fits(before - 1, token)):
                    if token in parts or self.parts(token) is not None:
                        reached = token
            if inner[node]:
                going.append(node << 32 | before)
        if reached < 0:
            raise ValueError(f"byte {byte} is not in the vocabulary")
        going.append(reached + 1)
        key = tuple(going)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.keys)
            self.keys.append(key)
            self.arcs.append({})
        arc = self.arcs[state][byte] = (number, reached)
        return arc

    def certain(self, state: int, lasts: list[int]) -> list[int]:
        """Positions that all open starts' token chains pass, back from the latest they share."""
        tails = [len(lasts) - self.depth[start >> 32] for start in self.keys[state]]
        while min(tails) != max(tails):
            latest = max(tails)
            tails = [t - self.size[lasts[t - 1]] if t == latest else t for t in tails]
        return self.chain(lasts, tails[0])

    def chain(self, lasts: list[int], end: int) -> list[int]:
        """The tokens up to a position: its last token, then that of the place where it starts."""
        out = []
        while end > 0:
            out.append(lasts[end - 1])
            end -= self.size[out[-1]]
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:  # a whole piece is one token, whether or not merges make it
            return [self.ranks[piece]]
        if len(self.keys) > self.max_states:
            self.reset()
        arcs, out, lasts, state = self.arcs, [], [], 0
        for byte in piece:
            arc = arcs[state].get(byte) or self.step(state, byte)
            state = arc[0]
            lasts.append(arc[1])
            if len(lasts) >= self.window:
                sure = self.certain(state, lasts)
                out += sure
                del lasts[: sum(len(self.token[t]) for t in sure)]
        return out + self.chain(lasts, len(lasts))


class Encoder:
    """Texts to ids: the pattern's matches one by one, through the transducer.

    ``memory`` scales what is remembered; less costs time only.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: float = 1.0):
        self.transducer = Transducer(ranks, int(memory * MAX_STATES))
        self.find = regex.compile(pattern).findall
        self.memory = WordMemory(int(memory * MAX_CHUNKS), self.piece, self.pieces, pattern == PATTERN)

    def encode(self, text: str) -> np.ndarray:
        """Ids as uint32."""
        return np.frombuffer(self.memory.encode(text), np.uint32)

    def pieces(self, chunk: str) -> bytes:
        return b"".join([self.piece(p) for p in self.find(chunk)])

    def piece(self, match: str) -> bytes:
        ids = self.transducer.encode_piece(match.encode())
        return pack(f"{len(ids)}I", *ids)


class Decoder:
    """Ids to text as they come: bytes of a character that is not complete wait for the next ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.machine = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.token.__getitem__, ids)))

    def end(self) -> str:
        """What is left, U+FFFD for an incomplete character; the decoder can start anew."""
        return self.machine.decode(b"", final=True)

    def pieces(self, ids: np.ndarray) -> Iterator[str]:
        for at in range(0, len(ids), DECODE_STEP):
            yield self.feed(ids[at : at + DECODE_STEP].tolist())
        yield self.end()


@lru_cache(maxsize=2)
def encoder_of(content: bytes, pattern: str, memory: float = 1.0) -> Encoder:
    """One encoder for a vocabulary in each Python worker, kept between tasks."""
    return Encoder(parse_ranks(content), pattern, memory)


@lru_cache(maxsize=2)
def decoder_of(content: bytes) -> Decoder:
    return Decoder(parse_ranks(content))


class ByteBPE:
    """Encoding and decoding columns for one vocabulary file of ranks and its pattern.

    The driver reads the file (a few hundred kB, whatever the corpus) and broadcasts it.
    NULL texts encode like empty ones: to no ids. Texts are encoded whole.
    """

    def __init__(self, spark, path: str, pattern: str):
        self.content = spark.sparkContext.broadcast(read_ranks(path))
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """array<int> of ids."""
        content, pattern = self.content, self.pattern

        @F.pandas_udf("array<int>")
        def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode = encoder_of(content.value, pattern).encode
            for texts in batches:
                yield pd.Series([encode(t or "").view(np.int32) for t in texts], dtype=object)

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """Text of an array of ids; NULL gives the empty text."""
        content = self.content

        @F.pandas_udf("string")
        def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            decoder = decoder_of(content.value)
            for rows in batches:
                yield pd.Series(["" if x is None else "".join(decoder.pieces(x)) for x in rows], dtype=object)

        return decoded(ids)

    def digests(self, ids: Column) -> Column:
        """Struct of n_tokens, ids_sha256 (decimal ids, commas between) and decoded_sha256."""
        content = self.content

        @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
        def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            decoder = decoder_of(content.value)
            name = list(map(str, range(len(decoder.token))))
            for rows in batches:
                out = []
                for x in rows:
                    sha = hashlib.sha256()
                    for piece in decoder.pieces(x):
                        sha.update(piece.encode())
                    joined = ",".join(map(name.__getitem__, x.tolist()))
                    out.append((len(x), hashlib.sha256(joined.encode()).hexdigest(), sha.hexdigest()))
                yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

        return digested(ids)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ids of every row, repeated rows included; other columns are not looked at."""
    tokens = ByteBPE(docs.sparkSession, path, pattern)
    return docs.select(F.col(id_col).alias("doc_id"), tokens.encode(F.col(text_col)).alias("ids"))


def round_trip(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode, decode, and return doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    NULL and empty texts have no ids: 0 and the digests of nothing. Rows that repeat are encoded
    each; an empty table gives no rows; other columns are dropped. Both steps run in one Python
    worker per task without a shuffle.
    """
    tokens = ByteBPE(docs.sparkSession, path, pattern)
    digest = tokens.digests(tokens.encode(F.col(text_col)))
    return docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest")).select("doc_id", "digest.*")


def token_rows(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    memory: float = 0.4,
) -> DataFrame:
    """doc_id, ids, n_tokens, and whether the decoded ids are the text again, of every row.

    NULL and empty texts have no ids; rows that repeat are encoded each; an empty table gives no
    rows; other columns are dropped. Python workers stay alive between stages, so an encoder
    remembers little (``memory``) and goes with its task.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(parse_ranks(content.value), pattern, memory)
        encode, decoder = encoder.encode, Decoder(encoder.transducer.ranks)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                pdf = batch.iloc[at : at + ROWS]
                ids = [encode(t or "") for t in pdf["text"]]
                same = ["".join(decoder.pieces(x)) == (t or "") for x, t in zip(ids, pdf["text"])]
                yield pd.DataFrame(
                    {"doc_id": pdf["doc_id"].to_numpy(), "ids": [x.view(np.int32) for x in ids],
                     "n_tokens": [len(x) for x in ids], "restored": same}
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(encoded, f"doc_id {kind}, ids array<int>, n_tokens long, restored boolean")
