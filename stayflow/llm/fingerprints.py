"""Lempel-Ziv phrase fingerprints: documents that would compress each other have many phrases in
common, which minimum hashes of their phrase sets estimate."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.running import numbered
from stayflow.llm.shingles import HIGH, LOW, mixed

#: Minimum hashes of a fingerprint. A likeness of j has a standard error of sqrt(j (1 - j) / SIZE).
SIZE = 128
_STEP = len(LOW)


class Phrases:
    """The dictionary of a text: each phrase is the shortest piece that is not in it yet."""

    def __init__(self):
        self.known: set[str] = set()
        self.open = ""
        self.lengths: list[int] = []

    def read(self, text: str) -> Phrases:
        known, phrase, add, note = self.known, self.open, self.known.add, self.lengths.append
        for char in text:
            phrase += char
            if phrase not in known:
                add(phrase)
                note(len(phrase))
                phrase = ""
        self.open = phrase
        return self

    def copy(self) -> Phrases:
        other = Phrases()
        other.known, other.open, other.lengths = self.known.copy(), self.open, self.lengths.copy()
        return other


def phrase_hashes(text: str, lengths: list[int]) -> np.ndarray:
    """64-bit hashes of the phrases of these lengths that begin the text."""
    if not lengths:
        return np.zeros(0, np.uint64)
    sizes = np.array(lengths)
    ends = np.cumsum(sizes)
    codes = np.frombuffer(text[: int(ends[-1])].encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.arange(len(codes)) - np.repeat(ends - sizes, sizes)
    weight = LOW[inside % _STEP]
    if sizes.max() > _STEP:
        weight = weight * HIGH[inside // _STEP % _STEP]
    return mixed(np.add.reduceat(mixed(codes.astype(np.uint64) + np.uint64(1)) * weight, ends - sizes))


def least(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest distinct upper halves, in order."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * size:
        # Equal halves of different phrases are rare; when too few are left, all are looked at.
        some = np.unique(np.partition(short, 2 * size)[: 2 * size])
        if len(some) >= size:
            return some[:size]
    return np.unique(short)[:size]


def written(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype(">u4").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u4").astype(np.uint32)


def signature_of(text: str) -> np.ndarray:
    return least(phrase_hashes(text, Phrases().read(text).lengths))


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity of two phrase sets: the share of the smallest hashes of both
    together that are in each. 1 for two empty sets, 0 for one."""
    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)[:size]
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum()) / len(both)


def fingerprint(text: Column) -> Column:
    """Fingerprint of each whole text; NULL is like the empty text, whose fingerprint is empty."""

    @F.pandas_udf("string")
    def fingerprinted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([written(signature_of(t or "")) for t in texts], dtype=object)

    return fingerprinted(text)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, after, doc_id, text), where each part of the table is in one task and in
    descending order of id, and the row after its last one follows with ``after`` true.

    Parts are ranges of ids between quantiles, twice as many as shuffle partitions; of each only
    the greatest id is looked at by the driver. The texts are shuffled once. NULL ids come last.
    Rows that repeat an id are in order of their text; the last row is followed by the first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, number = numbered(rows, "doc_id")
    marks = rows.where(F.col("doc_id").isNotNull()).select(F.col(number).cast("double").alias("id")).approxQuantile(
        "id", [i / parts for i in range(1, parts)], 1 / (4 * parts)
    )
    cuts = sorted(set(marks))
    above = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<double>")
    part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.size(F.filter(above, lambda c: c > F.col(number)))
    )
    rows = rows.select("doc_id", "text", part.alias("part"))
    heads = rows.groupBy("part").agg(F.max("doc_id").alias("head")).orderBy("part").collect()
    before = [heads[i - 1]["part"] for i in range(len(heads))]
    kind = rows.schema["doc_id"].dataType.simpleString()
    ends = spark.createDataFrame(
        [(h["part"], h["head"], b) for h, b in zip(heads, before)], f"part int, head {kind}, before int"
    )
    is_head = F.col("doc_id").eqNullSafe(F.col("head"))
    own = F.struct("part", F.lit(False).alias("after"))
    copy = F.struct(F.col("before").alias("part"), F.lit(True).alias("after"))
    places = F.when(is_head, F.array(own, copy)).otherwise(F.array(own))
    # One row per part: as small as the number of partitions.
    dealt = rows.join(F.broadcast(ends), "part").select(F.explode(places).alias("to"), "doc_id", "text")
    return (
        dealt.select("to.part", "to.after", "doc_id", "text")
        .repartition("part")
        .sortWithinPartitions("part", "after", F.col("doc_id").desc_nulls_last(), "text")
    )


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every whole text and its edited text, and compare it with that and with the next.

    The edited text has its last floor(n / 2) code points replaced by the first as many (or all)
    of the next document's, in descending order of id, the first after the last. One row per input
    row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    A text is parsed once; where the edit begins, the dictionary is copied and goes on with the
    new end. NULL texts count as empty. For ties and NULL ids see ``with_next``; a single document
    is its own next. Other columns are not looked at.
    """
    placed = with_next(docs, id_col, text_col)
    kind = placed.schema["doc_id"].dataType.simpleString()

    def parsed(text: str) -> tuple:
        """Dictionary at the cut, hashes of the phrases before it, signature of the text."""
        cut = len(text) - len(text) // 2
        start = Phrases().read(text[:cut])
        whole = start.copy().read(text[cut:])
        hashes = phrase_hashes(text, whole.lengths)
        return start, hashes[: len(start.lengths)], least(hashes)

    def row(doc_id, text: str, own: tuple, following: str, other: tuple) -> tuple:
        start, hashes, signature = own
        n = len(text)
        end = following[: n // 2]
        edited = text[: n - n // 2] + end
        count, done = len(start.lengths), n - n // 2 - len(start.open)
        start.read(end)
        new = phrase_hashes(edited[done:], start.lengths[count:])
        changed = least(np.concatenate([hashes, new]))
        return (
            doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), written(signature), written(changed),
            likeness(signature, changed), likeness(signature, other[2]),
        )

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        held = None
        for pdf in batches:
            out = []
            for part, after, doc_id, text in zip(pdf["part"], pdf["after"], pdf["doc_id"], pdf["text"]):
                if held is not None and held[0] != part:
                    held = None
                if held is None and after:
                    continue  # another copy of the row that has been used
                own = parsed(text)
                if held is not None:
                    out.append(row(held[1], held[2], held[3], text, own))
                held = None if after else (part, doc_id, text, own)
            if out:
                frame = pd.DataFrame(out, columns=names)
                if kind == "bigint":
                    frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame

    return placed.mapInPandas(
        compared,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
