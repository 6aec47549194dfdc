"""Remove word passages that already stand earlier in the corpus.

Every window of ``window`` words belongs to the shard that the least hash among its short word grams
names, so equal windows always meet. Runs of neighbouring windows travel together as one piece of
text. A shard is an FM-index over its pieces; all of them are streamed through it by backward search
for their matching statistics, and windows whose interval holds an earlier place are reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.fm_index import FMIndex
from stayflow.llm.running import ordered_ids
from stayflow.llm.shingles import BYTE, HIGH, LOW, SPACE, mixed
from stayflow.llm.store import checkpointed

#: Words of a gram that names a shard, and of one that must repeat where a window repeats.
GRAM, FILTER_GRAM = 5, 8
#: Windows of one piece at most: bounds the steps of a search.
PIECE_WINDOWS = 64
#: Words that a task cuts into pieces at a time, and words of a shard (pieces overlap).
UNIT_WORDS, SHARD_WORDS = 2_000_000, 1_500_000
#: Bytes that are hashed at a time.
HASH_BYTES = 1 << 20
#: More grams than this are never treated as hot.
MAX_HOT = 1_000_000
#: Words a text of so many characters may have, for the number of shards only.
CHARS_A_WORD = 5
_STEP = len(LOW)
_ODD = 0x9E3779B97F4A7C15 | 1
_ODD_INVERSE = pow(_ODD, -1, 2**64)
KEY = ["place", "digest"]


@dataclass
class Words:
    """Words of a UTF-8 text: their hashes, and the bytes from which and to which they go."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words_of(data: bytes) -> Words:
    """Maximal runs of bytes that are not ASCII white space. Long data are hashed in parts that end
    at white space, so memory grows with the longest word only."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + HASH_BYTES)
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        parts.append(_words(np.frombuffer(data, np.uint8, end - at, at), at))
        at = end
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none)
    return Words(*(np.concatenate(column) for column in zip(*parts)))


def _words(data: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[True], SPACE[data], [True]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    lengths = np.diff(starts, append=len(data))
    inside = np.arange(starts[0], len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    weight = LOW[inside % _STEP]
    if lengths.max() > _STEP:
        weight = weight * HIGH[inside // _STEP % _STEP]
    sums = np.add.reduceat(BYTE[data[starts[0] :]] * weight, starts - starts[0])
    return mixed(sums), starts + offset, ends + offset


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


class Rolling:
    """Hashes of any run of words, from sums of word hashes times powers."""

    def __init__(self, hashes: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(_ODD, len(hashes)))])
        self.back = powers(_ODD_INVERSE, len(hashes) + 1)

    def grams(self, n: int) -> np.ndarray:
        """Of every n words in a row."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n])

    def runs(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        whole = (self.sums[starts + sizes] - self.sums[starts]) * self.back[starts]
        return mixed(whole + mixed(sizes.astype(np.uint64)))


def least_in(values: np.ndarray, n: int) -> np.ndarray:
    """The least of every n values in a row."""
    reach = 1
    while reach * 2 <= n:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = n - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Unit:
    """Documents that are cut together: their bytes, words, and the document of each word."""

    data: bytes
    words: Words
    doc: np.ndarray
    place: np.ndarray
    digest: np.ndarray
    first_word: np.ndarray


def units(batches: Iterator[pd.DataFrame]) -> Iterator[Unit]:
    texts, places, digests, size = [], [], [], 0

    def unit() -> Unit:
        data = b"\n".join(texts)
        words = words_of(data)
        ends = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(ends, words.starts, side="right")
        first = np.searchsorted(doc, np.arange(len(texts)))
        return Unit(data, words, doc, np.array(places, np.int64), np.array(digests, np.int64), first)

    for pdf in batches:
        for text, place, digest in zip(pdf["text"], pdf["place"], pdf["digest"]):
            texts.append(text.encode())
            places.append(place)
            digests.append(digest)
            size += len(texts[-1])
            if size >= UNIT_WORDS * CHARS_A_WORD:
                yield unit()
                texts, places, digests, size = [], [], [], 0
    if texts:
        yield unit()


@dataclass
class Pieces:
    """Runs of windows of one shard key: first word, number of words, key; ``copy_of`` is the piece
    with the same words that stands first among the unit's documents, itself where it is the one."""

    start: np.ndarray
    size: np.ndarray
    key: np.ndarray
    copy_of: np.ndarray


def cut(unit: Unit, window: int, hot: np.ndarray) -> Pieces:
    """All windows of the unit's documents, in pieces. Windows whose gram is hot go by the hash of
    the whole window, each for itself."""
    n = len(unit.words.hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none.astype(np.uint64), none)
    rolling = Rolling(unit.words.hashes)
    gram = min(GRAM, window)
    key = least_in(rolling.grams(gram), window - gram + 1)
    whole = unit.doc[:n] == unit.doc[window - 1 :]
    alone = np.zeros(n, bool)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        alone = hot[at] == key
        key = np.where(alone, mixed(rolling.grams(window) + np.uint64(1)), key)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | ~whole[:-1] | (unit.doc[1:n] != unit.doc[: n - 1])
    new |= alone
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    new |= (np.arange(n) - head) % PIECE_WINDOWS == 0
    new &= whole
    start = np.flatnonzero(new)
    stop = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True)) + 1
    size = stop - start + window - 1
    words = rolling.runs(start, size)
    doc = unit.doc[start]
    order = np.lexsort((start - unit.first_word[doc], unit.digest[doc], unit.place[doc], words))
    fresh = np.ones(len(start), bool)
    fresh[1:] = words[order][1:] != words[order][:-1]
    copy_of = np.empty(len(start), np.int64)
    copy_of[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(start)), 0))]
    return Pieces(start, size, key[start], copy_of)


def frequent(docs: DataFrame, window: int, shards: int) -> np.ndarray:
    """Grams that would fill much of a shard, sorted: at most ``MAX_HOT`` numbers on the driver.

    A task reports grams with at least a half of a hot one's share of its pieces, so no gram that is
    hot in all is missed.
    """
    share = max(1 / (2 * shards), 1 / MAX_HOT)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in units(batches):
            pieces = cut(unit, window, np.zeros(0, np.uint64))
            own = pieces.copy_of == np.arange(len(pieces.start))
            keys, counts = np.unique(pieces.key[own], return_counts=True)
            much = counts >= share / 2 * own.sum()
            yield pd.DataFrame({"gram": keys[much].view(np.int64), "n": counts[much], "pieces": 0})
            yield pd.DataFrame({"gram": [0], "n": [0], "pieces": [int(own.sum())]})

    counts = checkpointed(docs.mapInPandas(counted, "gram long, n long, pieces long"))
    pieces = counts.agg(F.sum("pieces")).first()[0] or 0
    most = counts.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > share * pieces)
    # At most 1 / share grams can have more than that share.
    found = [r["gram"] for r in most.collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def shard_rows(unit: Unit, pieces: Pieces, shards: int) -> Iterator[dict]:
    """Rows of a shard's pieces of this unit: their keys, sizes and text, and where copies stand."""
    pack = zstandard.ZstdCompressor(level=3).compress
    shard = (pieces.key % np.uint64(shards)).astype(np.int64)
    own = pieces.copy_of == np.arange(len(pieces.start))
    doc = unit.doc[pieces.start]
    place, digest, at = unit.place[doc], unit.digest[doc], pieces.start - unit.first_word[doc]
    low, high = unit.words.starts[pieces.start], unit.words.ends[pieces.start + pieces.size - 1]
    # Pieces in the order of their shards, copies after the pieces.
    order = np.lexsort((~own, shard))
    dealt = shard[order]
    edges = np.flatnonzero(np.concatenate([[True], dealt[1:] != dealt[:-1], [True]]))
    for a, b in zip(edges[:-1], edges[1:]):
        chosen = order[a:b]
        n = int(own[chosen].sum())
        head = chosen[:n]
        text = b"\n".join([unit.data[x:y] for x, y in zip(low[head].tolist(), high[head].tolist())])
        # Copies carry their own key; equal rows of one document are no copies of each other.
        rest = chosen[n:]
        first = pieces.copy_of[rest]
        rest = rest[(place[rest] != place[first]) | (digest[rest] != digest[first]) | (at[rest] != at[first])]
        keys = np.concatenate([head, rest])
        yield {
            "shard": int(dealt[a]), "n": n, "n_keys": len(keys),
            "keys": pack(b"".join(c[keys].astype(np.int64).tobytes() for c in (place, digest, at, pieces.size))),
            "words": pack(text),
        }


SHARD_ROW = "shard int, n int, n_keys int, keys binary, words binary"
SPANS = "place long, digest long, start int, stop int"


def judged(rows: list, window: int) -> Iterator[pd.DataFrame]:
    """The repeated passages of one shard: (place, digest, start, stop) in words."""
    unpack = zstandard.ZstdDecompressor().decompress
    kept, texts = [], []
    for row in rows:
        keys = np.frombuffer(unpack(row.keys), np.int64).reshape(4, row.n_keys)
        if row.n_keys > row.n:
            place, digest, at, size = keys[:, row.n :]
            yield pd.DataFrame({"place": place, "digest": digest, "start": at, "stop": at + size})
        kept.append(keys[:, : row.n])
        texts.append(unpack(row.words))
    place, digest, at, size = np.concatenate(kept, axis=1)
    hashes = words_of(b"\n".join(texts)).hashes
    del texts, kept
    # Pieces in the order of the corpus; equal rows bring a piece of one place twice.
    order = np.lexsort((at, digest, place))
    place, digest, at, size, first = place[order], digest[order], at[order], size[order], (np.cumsum(size) - size)[order]
    same = np.zeros(len(order), bool)
    same[1:] = (place[1:] == place[:-1]) & (digest[1:] == digest[:-1]) & (at[1:] == at[:-1])
    place, digest, at, size, first = (x[~same] for x in (place, digest, at, size, first))
    if not len(size):
        return
    begin = np.cumsum(size) - size
    piece = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(piece)) - begin[piece]
    hashes = hashes[first[piece] + inside]
    # A window can only repeat where each of its shorter grams does.
    gram = min(FILTER_GRAM, window)
    grams = Rolling(hashes).grams(gram)
    by_hash = np.argsort(grams)
    equal = grams[by_hash][1:] == grams[by_hash][:-1]
    twice = np.zeros(len(grams), bool)
    twice[by_hash] = np.append(equal, False) | np.append(False, equal)
    single = np.concatenate([[0], np.cumsum(~twice)])
    n = len(hashes) - window + 1
    span = window - gram + 1
    likely = (single[span:][:n] == single[:-span][:n]) & (size[piece[:n]] - inside[:n] >= window)
    if not likely.any():
        return
    joined = likely[1:] & likely[:-1] & (piece[1:n] == piece[: n - 1])
    start = np.flatnonzero(likely & ~np.append(False, joined))
    stop = np.flatnonzero(likely & ~np.append(joined, False)) + window
    # The text of the index: the passages left, each with a 0 after it.
    lengths = stop - start
    begin = np.cumsum(lengths + 1) - lengths - 1
    run = np.repeat(np.arange(len(start)), lengths)
    source = start[run] + np.arange(len(run)) - (np.cumsum(lengths) - lengths)[run]
    text = np.zeros(int(lengths.sum()) + len(start), np.int64)
    target = source - start[run] + begin[run]
    text[target] = np.unique(hashes[source], return_inverse=True)[1] + 1
    origin = np.zeros(len(text), np.int64)
    origin[target] = source
    index = FMIndex(text, window)
    repeated = np.zeros(len(hashes) + 1, bool)
    for at_text, low, high in index.matching_statistics(text, begin, begin + lengths):
        many = high - low > 1
        at_many = at_text[many]
        earlier = index.first[index.interval(low[many])] < at_many
        repeated[origin[at_many[earlier]]] = True
    joined = repeated[1:-1] & repeated[:-2] & (piece[1:] == piece[:-1])
    repeated = repeated[:-1]
    start = np.flatnonzero(repeated & ~np.append(False, joined))
    stop = np.flatnonzero(repeated & ~np.append(joined, False)) + window
    of = piece[start]
    yield pd.DataFrame(
        {"place": place[of], "digest": digest[of], "start": at[of] + inside[start],
         "stop": at[of] + inside[start] + stop - start}
    )


def repeated_spans(rows: DataFrame, window: int) -> DataFrame:
    """(place, digest, start, stop) of passages whose every window of words stands earlier; ``rows``
    has place, digest and text, without NULL. Spans of a document may touch or overlap."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(parts, -(-3 * chars // CHARS_A_WORD // SHARD_WORDS))
    hot = spark.sparkContext.broadcast(frequent(rows, window, shards))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in units(batches):
            held, size = [], 0
            for row in shard_rows(unit, cut(unit, window, hot.value), shards):
                held.append(row)
                size += len(row["words"])
                if size > HASH_BYTES:
                    yield pd.DataFrame(held)
                    held, size = [], 0
            if held:
                yield pd.DataFrame(held)

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if held and held[0].shard != row.shard:
                    yield from judged(held, window)
                    held = []
                held.append(row)
        if held:
            yield from judged(held, window)

    pieces = rows.mapInPandas(dealt, SHARD_ROW).repartition(shards, "shard").sortWithinPartitions("shard")
    return pieces.mapInPandas(searched, SPANS)


def without(text: Column, spans: Column) -> Column:
    """Struct of n_words, n_removed and kept: the words outside the spans, one space between."""

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def left(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, removed in batches:
            out = []
            for text, cuts in zip(texts, removed):
                words = text.encode().split()
                n = len(words)
                if cuts is not None:
                    stays = np.ones(n, bool)
                    for c in cuts:
                        stays[c["start"] : c["stop"]] = False
                    words = [words[i] for i in np.flatnonzero(stays).tolist()]
                out.append((n, n - len(words), b" ".join(words).decode()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    return left(text, spans)


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, one space between) of every row.

    A word goes if one of the windows of ``window`` words around it also starts earlier: in a
    document with a smaller id, or earlier in the same one. Windows are judged on the input. Words
    are runs without ASCII white space, unchanged; NULL and empty texts have none. A NULL id comes
    after all others. Rows that share an id are ordered by a hash of their text; equal rows are one
    document, each with its result. An empty table gives no rows; other columns are not looked at.

    Words are compared by 64-bit hashes, a window by all of its words' hashes. The pieces of text
    that the shards compare are about three times the text, compressed; documents with equal pieces
    in one task send them once, and a gram that would fill a shard is dealt by whole windows.
    """
    rows = ordered_ids(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id")
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    # Only rows that share an id need more than it to be told apart.
    shared = rows.groupBy("place").count().where(F.col("count") > 1).limit(1).count()
    rows = rows.withColumn("digest", F.xxhash64("text") if shared else F.lit(0).cast("long"))
    long_enough = rows.select(*KEY, "text").where(F.length("text") >= 2 * window - 1)
    spans = repeated_spans(long_enough, window)
    cuts = spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = rows.join(cuts, KEY, "left")
    return joined.select("doc_id", without(F.col("text"), F.col("spans")).alias("out")).select("doc_id", "out.*")
