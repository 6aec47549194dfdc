"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is the product of its letters'
vectors, each permuted by its place; a document or language is the sum of its n-grams; the
nearest language by cosine is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Texts are counted together up to so many characters or texts, which bounds memory.
CHUNK_CHARS, CHUNK_TEXTS, CHUNK_GRAMS = 250_000, 128, 4096

_letters: dict[tuple[int, int, int], np.ndarray] = {}


def letter_vector(code: int, dimension: int, seed: int) -> np.ndarray:
    """The random vector of a code point (0: the edge of a word), the same in every process."""
    found = _letters.get((code, dimension, seed))
    if found is None:
        if len(_letters) > 20_000:
            _letters.clear()
        bits = np.random.Generator(np.random.PCG64([seed, code])).integers(0, 2, dimension)
        found = _letters[code, dimension, seed] = (2 * bits - 1).astype(np.int8)
    return found


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are small enough together; a longer text is alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > CHUNK_CHARS or i - start >= CHUNK_TEXTS):
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def bundle(texts: list[str], groups: np.ndarray, n_groups: int, dimension: int, seed: int) -> np.ndarray:
    """Sums of the n-gram vectors of the texts in each group, as (n_groups, dimension).

    Letters are lower-cased; a run of anything else is one word edge. 3-grams have a letter in
    the middle, so a one-letter word counts. Each distinct n-gram's vector is made once and
    weighted with its count, which gives the same sum as adding it at each place.
    """
    lower = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lower])
    codes = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), sizes)])
    present = np.flatnonzero(np.bincount(codes))
    alphabet = [int(c) for c in present if chr(c).isalpha()]
    out = np.zeros((n_groups, dimension), np.float64)
    if not alphabet:
        return out
    place = np.zeros(int(present[-1]) + 1, np.int64)
    place[alphabet] = np.arange(1, len(alphabet) + 1)
    letters = place[codes]
    keep = np.flatnonzero((letters[1:] != 0) | (letters[:-1] != 0)) + 1
    keep = np.concatenate([[0], keep])
    letters, owner = letters[keep], owner[keep]
    middle = np.flatnonzero(letters[1:-1]) + 1
    base = len(alphabet) + 1
    grams = (letters[middle - 1] * base + letters[middle]) * base + letters[middle + 1]
    if base**3 <= 1 << 22:
        distinct = np.flatnonzero(np.bincount(grams))
        index = np.zeros(base**3, np.int64)
        index[distinct] = np.arange(len(distinct))
        gram_of = index[grams]
    else:
        distinct, gram_of = np.unique(grams, return_inverse=True)
    cells = np.asarray(groups)[owner[middle]] * len(distinct) + gram_of
    counts = np.bincount(cells, minlength=n_groups * len(distinct)).reshape(n_groups, len(distinct))
    vectors = np.stack([letter_vector(c, dimension, seed) for c in [0, *alphabet]])
    first, second = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1)
    for at in range(0, len(distinct), CHUNK_GRAMS):
        g = distinct[at : at + CHUNK_GRAMS]
        bound = first[g // (base * base)] * second[g // base % base] * vectors[g % base]
        out += counts[:, at : at + CHUNK_GRAMS].astype(np.float32) @ bound.astype(np.float32)
    return out


@dataclass(frozen=True)
class Profiles:
    """One prototype vector per language, languages in order."""

    languages: tuple[str, ...]
    prototypes: np.ndarray
    dimension: int
    seed: int

    def nearest(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and cosine (0 where negative) of each text."""
        names, scores = [], []
        plain = [t or "" for t in texts]
        for a, b in chunks(plain):
            sums = bundle(plain[a:b], np.arange(b - a), b - a, self.dimension, self.seed)
            length = np.linalg.norm(sums, axis=1)
            if self.languages:
                unit = self.prototypes / np.maximum(np.linalg.norm(self.prototypes, axis=1), 1e-9)[:, None]
                cosine = sums @ unit.T / np.maximum(length, 1e-9)[:, None]
                best = cosine.argmax(axis=1)
            for i, text in enumerate(plain[a:b]):
                if not self.languages or not any(map(str.isalpha, text)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    names.append(self.languages[best[i]])
                    scores.append(float(min(max(cosine[i, best[i]], 0.0), 1.0)))
        return names, scores


def learn(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimension: int = 1024, seed: int = 7
) -> Profiles:
    """Bundle all documents with a language into prototypes.

    Every task adds up its documents and returns one vector per language; Spark adds those by
    (language, place), and only languages x dimension numbers come to the driver. NULL texts
    and languages take no part. An empty table gives no language.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            texts, langs = pdf["text"].tolist(), pdf["lang"].tolist()
            for a, b in chunks(texts):
                names = sorted(set(langs[a:b]))
                groups = np.array([names.index(x) for x in langs[a:b]])
                for name, vector in zip(names, bundle(texts[a:b], groups, len(names), dimension, seed)):
                    total[name] = total.get(name, 0) + vector
        for name, vector in total.items():
            yield pd.DataFrame({"lang": [name], "vector": [vector.astype(np.int64)]})

    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    rows = (
        known.mapInPandas(sums, "lang string, vector array<long>")
        .select("lang", F.posexplode("vector").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    languages = sorted({r["lang"] for r in rows})
    prototypes = np.zeros((len(languages), dimension))
    for r in rows:
        prototypes[languages.index(r["lang"]), r["place"]] = r["value"]
    return Profiles(tuple(languages), prototypes, dimension, seed)


def detected(profiles: Profiles, text: Column) -> Column:
    """Struct (lang_pred, score) of a text column; ``und`` and 0 for NULL or no letter.

    A text is counted whole. Equal cosines go to the first language in order.
    """

    @F.pandas_udf("lang_pred string, score double")
    def nearest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            names, scores = profiles.nearest(series.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return nearest(text)


def held_out(id_column: Column) -> Column:
    """Whether the document is for testing only: crc32 of the id as text, modulo 4, is 2.

    A NULL id counts as the empty text.
    """
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    Rows that repeat are judged each; NULL and empty texts, and texts without a letter, are ``und``
    with score 0, as is every text where no language was learned. Equal cosines go to the first
    language in order. An empty table gives no rows; other columns are not looked at.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        detected(profiles, F.col(text_col)).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")
